"""The flat geometry columns and the exact box test against a brute force on integer coordinates."""

import json
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from geospan.functions import columnar
from geospan.operators.filters import bbox_filter, geometry_intersects_box

BOX = (-3, -2, 4, 5)


def rings(rng, n):
    out = []
    for _ in range(n):
        ring = [[rng.randrange(-12, 13), rng.randrange(-12, 13)] for _ in range(rng.randrange(3, 7))]
        out.append([*ring, ring[0]])
    return out


def geometry(rng, kind=None, deep=0):
    kind = kind or rng.choice(["Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon"] + ["GeometryCollection"] * (deep < 2))
    point = lambda: [rng.randrange(-12, 13), rng.randrange(-12, 13)]
    line = lambda: [point() for _ in range(rng.randrange(2, 6))]
    if kind == "GeometryCollection":
        return {"type": kind, "geometries": [geometry(rng, None, deep + 1) for _ in range(rng.randrange(1, 4))]}
    coordinates = {"Point": point, "LineString": line, "MultiPoint": line, "MultiLineString": lambda: [line() for _ in range(rng.randrange(1, 4))],
                   "Polygon": lambda: rings(rng, rng.randrange(1, 3)),
                   "MultiPolygon": lambda: [rings(rng, rng.randrange(1, 3)) for _ in range(rng.randrange(1, 4))]}[kind]()
    return {"type": kind, "coordinates": coordinates}


def meets(g, box):
    x0, y0, x1, y1 = box
    kind = g["type"]
    if kind == "GeometryCollection":
        return any(meets(x, box) for x in g["geometries"])
    c = g["coordinates"]
    if kind in ("Point", "MultiPoint"):
        return any(x0 <= p[0] <= x1 and y0 <= p[1] <= y1 for p in ([c] if kind == "Point" else c))
    lines = {"LineString": [c], "MultiLineString": c, "Polygon": c, "MultiPolygon": [r for p in c for r in p]}[kind] if kind != "LineString" else [c]

    def side(a, b, p):
        v = (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
        return (v > 0) - (v < 0)

    def on(a, b, p):
        return side(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])

    def cross(a, b, c, d):
        return (side(a, b, c) != side(a, b, d) and side(c, d, a) != side(c, d, b)) or on(a, b, c) or on(a, b, d) or on(c, d, a) or on(c, d, b)
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    for ln in lines:
        for a, b in zip(ln, ln[1:]):
            if x0 <= a[0] <= x1 and y0 <= a[1] <= y1 or x0 <= b[0] <= x1 and y0 <= b[1] <= y1:
                return True
            if any(cross(a, b, p, q) for p, q in zip(corners, corners[1:] + corners[:1])):
                return True
    polygons = {"Polygon": [c], "MultiPolygon": c}.get(kind, [])
    for p in polygons:
        odd = False
        for ring in p:
            for a, b in zip(ring, ring[1:]):
                if (a[1] > y0) != (b[1] > y0) and (b[0] - a[0]) * (y0 - a[1]) / (b[1] - a[1]) + a[0] > x0:
                    odd = not odd
        if odd:
            return True
    return False


def wkt(g):
    kind = g["type"]
    if kind == "GeometryCollection":
        return f"GEOMETRYCOLLECTION ({', '.join(map(wkt, g['geometries']))})"

    def text(c):
        return " ".join(map(str, c)) if not isinstance(c[0], list) else "(" + ", ".join(map(text, c)) + ")"
    c = g["coordinates"]
    return f"{kind.upper()} ({text(c)})" if kind == "Point" else f"{kind.upper()}{text(c)}"


CODES = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6, "GeometryCollection": 7}
PARTS = {"MultiPoint": "Point", "MultiLineString": "LineString", "MultiPolygon": "Polygon"}


def wkb(g, rng):
    e, mark = rng.choice([("<", 1), (">", 0)])
    kind = g["type"]
    z, srid, iso = rng.choice([(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 3)])
    dims = 2 + z + (iso > 0) + (iso == 3)
    code = CODES[kind] + 1000 * iso + (0x80000000 if z else 0) + (0x20000000 if srid else 0)
    head = struct.pack(e + "BI", mark, code) + (struct.pack(e + "I", 4326) if srid else b"")

    def points(ps):
        return b"".join(struct.pack(f"{e}{dims}d", *p[:2], *[7.0] * (dims - 2)) for p in ps)
    c = g.get("coordinates")
    if kind == "Point":
        return head + points([c])
    if kind == "LineString":
        return head + struct.pack(e + "I", len(c)) + points(c)
    if kind == "Polygon":
        return head + struct.pack(e + "I", len(c)) + b"".join(struct.pack(e + "I", len(r)) + points(r) for r in c)
    parts = g["geometries"] if c is None else [{"type": PARTS[kind], "coordinates": x} for x in c]
    return head + struct.pack(e + "I", len(parts)) + b"".join(wkb(p, rng) for p in parts)


def run(values, kind, box=BOX):
    n = len(values)
    return columnar.intersects_boxes(pa.array(values, kind), *[[b] * n for b in box]).to_pylist()


@pytest.mark.parametrize("seed", range(4))
def test_every_type_and_form_equals_brute_force(seed, monkeypatch):
    rng = random.Random(seed)
    gs = [geometry(rng) for _ in range(500)] + [geometry(rng, "Polygon") for _ in range(200)]
    want = [meets(g, BOX) for g in gs]
    assert 50 < sum(want) < len(want) - 50
    assert run([wkb(g, rng) for g in gs], pa.binary()) == want
    assert run([wkb(g, rng).hex() for g in gs], pa.string()) == want
    monkeypatch.setattr(columnar, "_read_one", None)  # the batch passes take all of these themselves
    assert run([wkt(g) for g in gs], pa.string()) == want
    assert run([json.dumps(g) for g in gs], pa.string()) == want
    assert run([json.dumps(dict(reversed(g.items())), separators=(",", ":")) for g in gs], pa.string()) == want


def test_mixed_forms_empty_and_broken_values():
    rng = random.Random(9)
    inside = geometry(rng, "Point") | {"coordinates": [0, 0]}
    values = ["POINT(0 0)", None, "", "nonsense", "POINT(0", json.dumps(inside), wkb(inside, rng).hex(), "POLYGON EMPTY", "POINT Z (0 0 9)", "point zm(1e0 .5 1 1)",
              "SRID=4326;POINT(-1.5e0 +2)", "LINESTRING(20 20, 30 30)", '{"type":"Point","coordinates":[]}', '{"type":"Point"', '{"type":"Point","bbox":[9,9,9,9],"coordinates":[0,0]}',
              "MULTIPOINT(20 20, 0 0)", "MULTIPOINT((20 20),(0 0))", "POLYGON((0 0,1 1),2 2)", "LINESTRING(0 0 1, 2 2)", "FOO(1 2)", "GEOMETRYCOLLECTION(POINT(0 0), POLYGON EMPTY)",
              '{"type":"P\\u006fint","coordinates":[0,0]}', "0" * 10, "ab"]
    want = [True, None, None, None, None, True, True, False, True, True, True, False, False, None, True, True, True, None, True, None, True, True, None, None]
    got = run(values, pa.string())
    assert [g for k, g in enumerate(got) if k != 18] == [w for k, w in enumerate(want) if k != 18]
    # one by one, too: a value's result doesn't hang on its neighbours
    assert [run([v], pa.string())[0] for v in values] == got
    whole = wkb(geometry(rng, "MultiPolygon"), rng)
    cut = [whole[:k] for k in range(len(whole))]
    assert run(cut, pa.binary()) == [None] * len(cut)
    assert run([struct.pack("<BI2d", 1, 1, float("nan"), float("nan")), b"\x05", struct.pack("<BII", 1, 4, 0xFFFFFFFF)], pa.binary()) == [False, None, None]
    assert run([], pa.string()) == [] and run([None, None], pa.binary()) == [None, None]


def test_touching_counts_and_a_hole_does_not():
    ring = "(-20 -20, 20 -20, 20 20, -20 20, -20 -20)"
    hole = "(-9 -9, 9 -9, 9 9, -9 9, -9 -9)"
    assert run([f"POLYGON({ring})", f"POLYGON({ring},{hole})", "LINESTRING(4 9, 4 5)", "POINT(4 5)", "POINT(4.001 5)", "LINESTRING(-9 5, 9 5)"],
               pa.string()) == [True, False, True, True, False, True]


def test_filter_in_spark(spark):
    rng = random.Random(1)
    gs = [geometry(rng) for _ in range(300)]
    df = spark.createDataFrame([(k, wkb(g, rng), wkt(g)) for k, g in enumerate(gs)], "k int, b binary, t string").repartition(3)
    box = [F.lit(float(v)) for v in BOX]
    got = {r["k"]: (r["b"], r["t"]) for r in df.select("k", geometry_intersects_box(F.col("b"), *box).alias("b"), geometry_intersects_box(F.col("t"), *box).alias("t")).collect()}
    assert got == {k: (meets(g, BOX),) * 2 for k, g in enumerate(gs)}
