import numpy as np
import struct

import pytest

from geospan.functions import wkb
from geospan.functions.envelope import env_geojson, env_text, env_wkb, env_wkt
from geospan.operators.geometry import (decode_geometry, points_from_lonlat,
                                        resolve_geometry_column, with_srid)


def _box(row):
    return None if row is None else (row.xmin, row.ymin, row.xmax, row.ymax)


@pytest.mark.parametrize("text,expected", [
    ("POINT Z (1 2 3)", (1, 2, 1, 2)),
    ("POINT M (-.5 1e-3 9)", (-0.5, 0.001, -0.5, 0.001)),
    ("GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (-3 4, 5 -6))", (-3, -6, 5, 4)),
    ("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((10 10, 11 10, 11 12, 10 10)))", (0, 0, 11, 12)),
    ("SRID=4326;POINT (7 8)", (7, 8, 7, 8)),
    ("POLYGON EMPTY", None),
    (None, None),
])
def test_env_wkt(spark, text, expected):
    r = spark.createDataFrame([(text,)], "g string").select(env_wkt("g").alias("b")).first()
    assert _box(r["b"]) == (None if expected is None else tuple(float(v) for v in expected))


def test_env_geojson_ignores_bbox_member_and_handles_collections(spark):
    g1 = '{"type":"Polygon","bbox":[-99,-99,99,99],"coordinates":[[[1,2],[3,2],[3,4,9],[1,2]]]}'
    g2 = ('{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[-1,-2]},'
          '{"type":"LineString","coordinates":[[5,6],[7,8]]}]}')
    rows = spark.createDataFrame([(g1,), (g2,)], "g string").select(
        env_geojson("g").alias("b")).collect()
    assert _box(rows[0]["b"]) == (1, 2, 3, 4)
    assert _box(rows[1]["b"]) == (-1, -2, 7, 8)


def _big_endian_point(x, y):
    return struct.pack(">BI2d", 0, 1, x, y)


def _ewkb_point_srid(x, y, srid=4326):
    return struct.pack("<BII2d", 1, 0x20000001, srid, x, y)


def test_env_wkb_variants(spark):
    poly = wkb.wkt_to_wkb("POLYGON Z ((0 0 1, 4 0 1, 4 3 1, 0 0 1))")
    rows = [(bytearray(_big_endian_point(1.5, -2.5)),), (bytearray(_ewkb_point_srid(3, 4)),),
            (bytearray(poly),), (bytearray(poly[:-5]),), (None,)]
    out = spark.createDataFrame(rows, "g binary").select(env_wkb("g").alias("b")).collect()
    assert _box(out[0]["b"]) == (1.5, -2.5, 1.5, -2.5)
    assert _box(out[1]["b"]) == (3, 4, 3, 4)
    assert _box(out[2]["b"]) == (0, 0, 4, 3)
    assert out[3]["b"] is None  # truncated -> flagged, no box
    assert out[4]["b"] is None


def test_decode_flags_truncated_wkb(spark):
    poly = wkb.wkt_to_wkb("POLYGON ((0 0, 4 0, 4 3, 0 0))")
    df = spark.createDataFrame([(1, bytearray(poly)), (2, bytearray(poly[:-5]))], "id int, geom binary")
    out = {r["id"]: r for r in decode_geometry(df).collect()}
    assert out[1]["_bad"] is False and out[2]["_bad"] is True
    with pytest.raises(ValueError):
        decode_geometry(df, mode="strict")


def test_envelope_equal_across_encodings(spark):
    wkt = "POLYGON ((-12.5 3.25, 7 3.25, 7 9, -12.5 3.25))"
    gj = wkb.json.dumps({"type": "Polygon", "coordinates": [[[-12.5, 3.25], [7, 3.25], [7, 9],
                                                               [-12.5, 3.25]]]})
    hexwkb = wkb.wkt_to_wkb(wkt).hex()
    rows = spark.createDataFrame([(wkt,), (gj,), (hexwkb,)], "g string").select(
        env_text("g").alias("b")).collect()
    assert len({_box(r["b"]) for r in rows}) == 1


def test_geometry_column_resolution(spark):
    df = spark.createDataFrame([(1, "POINT (1 2)")], "id int, Shape string")
    assert resolve_geometry_column(df, "geom") == "Shape"
    with pytest.raises(ValueError):
        resolve_geometry_column(spark.createDataFrame([(1,)], "id int"), "geom")


def test_points_and_srid(spark):
    df = spark.createDataFrame([(1.5, 2.0), (None, 1.0)], "lon double, lat double")
    out = with_srid(points_from_lonlat(df)).collect()
    assert out[0]["geometry"] == "POINT (1.5 2)"
    assert _box(out[0]["bbox"]) == (1.5, 2.0, 1.5, 2.0)
    assert out[1]["bbox"] is None
    assert out[0]["srid"] == 4326 and out[0]["assumed_srid"] is True
    with pytest.raises(ValueError):
        points_from_lonlat(spark.createDataFrame([(1,)], "id int"))


def test_wkb_roundtrip_to_geojson():
    g = wkb.geometry_to_geojson("MULTIPOINT ((1 2), (3 4))")
    assert wkb.json.loads(g) == {"type": "MultiPoint", "coordinates": [[1.0, 2.0], [3.0, 4.0]]}


from hypothesis import given, settings, strategies as st  # noqa: E402

coord = st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.tuples(coord, coord), min_size=3, max_size=12), min_size=1, max_size=3))
def test_envelope_equal_across_encodings_property(spark, polys):
    rows = []
    for i, ring in enumerate(polys):
        pts = ring + [ring[0]]
        wkt = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in pts) + "))"
        gj = wkb.json.dumps({"type": "Polygon", "coordinates": [[list(p) for p in pts]]})
        rows += [(i, "wkt", wkt), (i, "geojson", gj), (i, "hex", wkb.wkt_to_wkb(wkt).hex())]
    df = spark.createDataFrame(rows, "id int, enc string, g string")
    out = df.select("id", "enc", env_text("g").alias("b")).collect()
    by_id = {}
    for r in out:
        by_id.setdefault(r["id"], set()).add(_box(r["b"]))
    for i, ring in enumerate(polys):
        xs, ys = [p[0] for p in ring], [p[1] for p in ring]
        assert by_id[i] == {(min(xs), min(ys), max(xs), max(ys))}


def test_batch_wkb_kernel_matches_per_value():
    import random
    rnd = random.Random(3)
    vals = []
    for _ in range(300):
        k = rnd.randrange(7)
        x, y = rnd.uniform(-180, 180), rnd.uniform(-90, 90)
        if k == 0:
            vals.append(wkb.wkt_to_wkb(f"POINT ({x!r} {y!r})"))
        elif k == 1:
            n = rnd.randrange(3, 9)
            ring = [(x + rnd.random(), y + rnd.random()) for _ in range(n)]
            ring.append(ring[0])
            vals.append(wkb.wkt_to_wkb("POLYGON ((" + ", ".join(f"{a!r} {b!r}" for a, b in ring) + "))"))
        elif k == 2:
            vals.append(wkb.wkt_to_wkb(f"MULTIPOINT (({x!r} {y!r}), (1 2))"))
        elif k == 3:
            vals.append(_big_endian_point(x, y))
        elif k == 4:
            vals.append(wkb.wkt_to_wkb("POLYGON ((0 0, 1 0, 1 1, 0 0))")[:-4])
        elif k == 5:
            vals.append(None)
        else:
            vals.append(wkb.wkt_to_wkb("POINT EMPTY"))
    box, bad = wkb.wkb_bounds_arrays(vals)
    assert [(None,) * 4 + (bool(f),) if np.isnan(b[0]) else (*map(float, b), bool(f)) for b, f in zip(box, bad)] == [wkb.wkb_bounds(v) for v in vals]


def test_decode_spark_geometry_type(spark):
    old = spark.conf.get("spark.sql.geospatial.enabled", "false")
    spark.conf.set("spark.sql.geospatial.enabled", "true")
    try:
        poly = wkb.wkt_to_wkb("POLYGON ((1 2, 5 2, 5 7, 1 2))").hex()
        df = spark.sql(f"SELECT 1 AS id, st_geomfromwkb(X'{poly}') AS geom")
        out = decode_geometry(df).first()
        assert _box(out["bbox"]) == (1, 2, 5, 7) and out["_bad"] is False
    finally:
        spark.conf.set("spark.sql.geospatial.enabled", old)


def test_decode_forced_formats(spark):
    df = spark.createDataFrame([(1, "POINT (1 2)"), (2, "POLYGON EMPTY"), (3, "garbage")],
                               "id int, geom string")
    out = {r["id"]: r for r in decode_geometry(df, fmt="wkt").collect()}
    assert _box(out[1]["bbox"]) == (1, 2, 1, 2) and out[1]["_bad"] is False
    assert out[2]["bbox"] is None and out[2]["_bad"] is False   # EMPTY is not an error
    assert out[3]["_bad"] is True
    with pytest.raises(ValueError):
        decode_geometry(df, fmt="wkt", mode="strict")
    gj = spark.createDataFrame([(1, '{"type":"Point","coordinates":[3,4]}'), (2, "POINT (1 2)")],
                               "id int, geometry string")
    res = {r["id"]: r for r in decode_geometry(gj, fmt="geojson").collect()}
    assert _box(res[1]["bbox"]) == (3, 4, 3, 4) and res[2]["_bad"] is True
