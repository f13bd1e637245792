"""Geometries in their usual spelling, read a batch at a time, against the per-value codecs and the SQL expressions."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from geospan.functions import plain as P
from geospan.functions import wkb as W
from geospan.functions.envelope import bad_geojson, bad_wkt, env_geojson, env_wkt, geometry_kind, text_envelope

TEXTS = [
    "POINT (1 2)", "POINT(-1.5 2e3)", "LINESTRING (0 0, 1 1,2.25 -3)", "POLYGON ((0 0, 4 0, 4 4, 0 0))", "POLYGON((-81.6130 28.3444,-81.5 28.3,-81.6130 28.3444))",
    "POLYGON ((0 0, 9 0, 9 9, 0 0), (1 1, 2 1, 2 2, 1 1))", "MULTIPOINT (1 2, 3 4)", "MULTIPOINT ((1 2), (3 4))", "MULTILINESTRING ((0 0, 1 1), (5 5, 6 7))",
    "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))", "GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (0 0, 9 9))",
    '{"type":"Point","coordinates":[1,2.5]}', '{"type": "LineString", "coordinates": [[1, 2], [3, 4e-1]]}', '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,0]]]}',
    '{"type":"Polygon","coordinates":[[[0,0],[9,0],[9,9],[0,0]],[[1,1],[2,1],[2,2],[1,1]]]}', '{"type":"MultiPoint","coordinates":[[1,2],[3,4]]}',
    '{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}', '{"type":"Point","coordinates":[1,2,3]}',
    '{"bbox":[9,9,9,9],"type":"Point","coordinates":[1,2]}', '{"coordinates":[1,2],"type":"Point"}', '{"type":"Point","coordinates":[]}', '{"type":"Point","coordinates":[01,2]}',
    "POINT (-0 -0.0)", '{"type":"Point","coordinates":[-0,0]}', "POINT (1e999 2)", "POINT (+1 .5)", "POINT (01 2.)", "point (1 2)", " POINT (1 2) ", "POINT (1 2)\n", "POINT Z (1 2 3)",
    "POINT (1 2", "POLYGON EMPTY", "POLYGON ((0 0, 1 1)) x", "POINT (nan 1)", "SRID=4326;POINT (1 2)", "", " ", "abc", "{", "0101", "zz",
    W.geometry_text_to_wkb("POLYGON ((0 0, 4 0, 4 4, 0 0))").hex(), W.geometry_text_to_wkb("POINT (3 4)").hex().upper(), None,
]


def _one_by_one(f, values):
    return [None if v is None else W.readable(f, v) for v in values]


@pytest.mark.parametrize("texts", [TEXTS, TEXTS[:10], TEXTS[20:], [None], []])
def test_codecs_as_per_value(texts):
    column = pa.array(texts, pa.string())
    assert P.values_to_wkb(column).to_pylist() == _one_by_one(W.geometry_text_to_wkb, texts)
    assert P.values_to_geojson(column).to_pylist() == _one_by_one(W.geometry_to_geojson, texts)
    raw = _one_by_one(W.geometry_text_to_wkb, texts) + [b"", b"\x01", b"\x01\x03\x00\x00\x00" + b"\xff" * 30, None]
    assert P.values_to_geojson(pa.array(raw, pa.binary())).to_pylist() == _one_by_one(W.geometry_to_geojson, raw)
    assert P.values_to_wkb(column.slice(3)).to_pylist() == _one_by_one(W.geometry_text_to_wkb, texts[3:])


def test_usual_spellings_are_plain():
    rows = P.read_text(pa.array(TEXTS, pa.string()), P.ANY).rows.tolist()
    assert set(range(10)) | set(range(11, 17)) <= set(rows)
    assert not {k for k, t in enumerate(TEXTS) if t and (" Z " in t or "bbox" in t or t.startswith("GEOMETRYC"))} & set(rows)


def test_random_polygons():
    r = np.random.default_rng(5)
    texts = []
    for n in range(2000):
        p = [f"{x:.{n % 17}f} {y!r}" for x, y in r.uniform(-180, 180, (int(r.integers(1, 9)), 2)).tolist()]
        texts.append(f"POLYGON (({', '.join(p)}))")
    assert P.values_to_wkb(pa.array(texts)).to_pylist() == [W.geometry_text_to_wkb(t) for t in texts]
    assert P.values_to_geojson(pa.array(texts)).to_pylist() == [W.geometry_to_geojson(t) for t in texts]


def test_envelope_as_the_expressions(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "k long, t string")
    kind, (box, bad) = geometry_kind("t"), text_envelope("t")
    gj, wk = env_geojson("t"), env_wkt("t")
    rows = df.select("t", kind.alias("kind"), box.alias("box"), bad.alias("bad"), F.when(kind == "geojson", gj).when(kind == "wkt", wk).alias("box0"),
                     F.when(kind == "geojson", bad_geojson("t", gj)).when(kind == "wkt", bad_wkt("t", wk)).alias("bad0")).collect()
    for r in rows:
        if r["kind"] in ("geojson", "wkt"):
            assert (r["box"], r["bad"]) == (r["box0"], r["bad0"]), r["t"]
        elif r["kind"] == "wkb_hex":
            want = W.wkb_bounds(bytes.fromhex(r["t"]))
            assert (tuple(r["box"]) if r["box"] else (None,) * 4) + (r["bad"],) == want
        else:
            assert r["box"] is None and r["bad"] == (r["t"] is not None)


def test_boxes_of_plain_texts_need_no_expression(spark):
    """The patterns take several passes over a text, and a filter on a box repeats them for each bound."""
    got = P.text_bounds(pa.array(["POLYGON ((0 0, 4 0, 4 5, 0 0))", json.dumps({"type": "Point", "coordinates": [1, 2]}), "x"])).to_pylist()
    assert [g["plain"] for g in got] == [True, True, False]
    assert [got[0][b] for b in ("xmin", "ymin", "xmax", "ymax")] == [0, 0, 4, 5]
