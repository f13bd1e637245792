"""Broken geometries are flagged and survive filters and sinks; the grid join beyond degrees."""

import pytest
from pyspark.sql import functions as F

from geospan.operators.extract import extract_jobs
from geospan.operators.filters import bbox_filter, geometry_intersects_box
from geospan.operators.geometry import decode_geometry
from geospan.sinks.export import export_multiple

BROKEN = ["POINT (abc)", "POLYGON ((", "POLYGON ((0 0, 1 0, 1 1, 0 0)", "LINESTRING (0 0, x y)", '{"type":"Foo"}',
          "{garbage", '{"type":"Point"}', '{"type":"Point","coordinates":["a","b"]}', "0101000000000000000000F03F", "hello"]
SOUND = ["POINT (1 2)", "POINTZ (1 2 3)", "POINT ZM (1 2 3 4)", "srid=4326;LineString(0 0, 1e-3 2.5E2)", "POLYGON EMPTY",
         "GEOMETRYCOLLECTION (POINT (1 2), LINESTRING EMPTY)", '{"type":"Point","coordinates":[1,2]}',
         '{"type":"LineString","coordinates":[]}', '{"type":"GeometryCollection","geometries":[]}',
         "0101000000000000000000F03F0000000000000040", None]


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, geometry string")


def test_broken_text_is_flagged_and_sound_text_is_not(spark):
    got = decode_geometry(frame(spark, BROKEN + SOUND), "geometry").select("id", "_bad", "bbox").collect()
    assert {r["id"]: r["_bad"] for r in got} == {i: i < len(BROKEN) for i in range(len(BROKEN + SOUND))}
    assert all(r["bbox"] is None for r in got if r["_bad"])
    assert decode_geometry(frame(spark, SOUND), "geometry", mode="strict").count() == len(SOUND)
    with pytest.raises(ValueError):
        decode_geometry(frame(spark, SOUND + [BROKEN[2]]), "geometry", mode="strict")


def test_exact_test_of_a_broken_value_is_null(spark):
    hit = geometry_intersects_box(F.col("geometry"), F.lit(0.0), F.lit(0.0), F.lit(5.0), F.lit(5.0))
    got = frame(spark, ["POINT (1 2)", "POINT (abc)", "{garbage", "0101000000000000000000F03F0000000000000040", None]
                ).select("id", hit.alias("hit")).collect()
    assert [r["hit"] for r in sorted(got)] == [True, None, None, True, None]


def test_export_evaluates_once_and_counts_bad_rows(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def observed(i):
        seen.add(1)
        return f"POINT ({i} {i})" if i else "POINT (abc)"

    rows = spark.range(20).withColumn("geometry", observed("id"))
    got = export_multiple(decode_geometry(rows, "geometry"), str(tmp_path), "x", ["parquet", "geojson", "csv"]).collect()
    # the geometry and its box share one evaluation of the column, or have one each
    assert seen.value in (20, 40, 60)
    once = seen.value
    assert {(r["format"], r["status"], r["rows"], r["bad_rows"]) for r in got} == {
        ("parquet", "ok", 20, 1), ("geojson", "ok", 20, 1), ("csv", "ok", 20, None)}
    seen.add(-once)
    export_multiple(decode_geometry(rows, "geometry"), str(tmp_path), "y", ["csv"])
    assert seen.value <= once  # more formats, no more evaluations
    back = spark.read.parquet(str(tmp_path / "x.parquet"))
    assert back.where("geometry IS NULL").count() == 1 and back.count() == 20


def test_grid_in_projected_units_with_inverted_and_huge_boxes(spark):
    box = "struct<xmin: double, ymin: double, xmax: double, ymax: double>"
    feats = spark.createDataFrame(
        [(i, (i * 1e4, i * 5e3, i * 1e4 + s, i * 5e3 + s)) for i in range(40) for s in (0.0, 3e3, 1e5)]
        + [(100, (-1e9, -1e9, 1e9, 1e9)), (101, (2e5, 0.0, 1e5, 2e5)), (102, None)], f"id int, bbox {box}")
    boxes = [("a", (1e5, 5e4, 1.2e5, 6e4)), ("inverted", (1.5e5, 6e4, 1.4e5, 8e4)), ("wide", (-1e6, -1e6, 1e6, 1e6)),
             ("point", (2e5, 1e5, 2e5, 1e5)), ("far", (5e6, 5e6, 5.1e6, 5.1e6)), ("none", None)]
    jobs = spark.createDataFrame(boxes, f"job string, bbox {box}")

    def pairs(**kw):
        out = extract_jobs(feats, jobs, **kw).select("job", "id", "bbox")
        return sorted((r["job"], r["id"], tuple(r["bbox"])) for r in out.collect())
    want = sorted((name, r["id"], tuple(r["bbox"])) for name, b in boxes if b for r in bbox_filter(feats, b).collect())
    assert pairs(strategy="broadcast") == want
    assert pairs(strategy="grid_broadcast") == want
    assert pairs(strategy="grid", hot_parts=4) == want
    assert pairs(strategy="broadcast", broadcast_bytes=1) == want
