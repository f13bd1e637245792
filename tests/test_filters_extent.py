import math

from hypothesis import given, settings, strategies as st

from geospan.functions.bbox import expand_bbox, lit_bbox, make_bbox
from geospan.operators.extent import (bbox_intersection_agg, bbox_union_agg, extent,
                                      require_extent)
from geospan.operators.filters import attr_filter, bbox_filter, count_features, where_filter


def _frame(spark, rows):
    rows = [r[:2] + tuple(None if v is None else float(v) for v in r[2:]) for r in rows]
    df = spark.createDataFrame(rows, "id long, name string, x0 double, y0 double, x1 double, y1 double")
    return df.select("id", "name", make_bbox("x0", "y0", "x1", "y1").alias("bbox"))


def test_box_filter_closed_and_null(spark):
    df = _frame(spark, [(1, "a", 10, 10, 11, 11), (2, "b", 0, 0, 1, 1), (3, "c", 1, 1, 2, 2),
                        (4, "d", None, None, None, None)])
    ids = sorted(r["id"] for r in bbox_filter(df, [1, 1, 5, 5]).collect())
    assert ids == [2, 3]  # corner touch counts, null box excluded


def test_box_filter_pushdown(spark, scratch):
    df = _frame(spark, [(i, "x", i, i, i + 1, i + 1) for i in range(50)])
    df.write.parquet(f"{scratch}/f")
    plan = bbox_filter(spark.read.parquet(f"{scratch}/f"), [3, 3, 4, 4])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters" in plan and "bbox.xmin" in plan


def test_exact_filter_triangle(spark):
    df = spark.createDataFrame([(1, "POLYGON ((0 0, 10 0, 0 10, 0 0))")], "id int, wkt string") \
        .withColumn("bbox", lit_bbox([0, 0, 10, 10]))
    assert bbox_filter(df, [6, 6, 9, 9], exact=True, geometry="wkt").count() == 0
    assert bbox_filter(df, [4, 4, 9, 9], exact=True, geometry="wkt").count() == 1
    assert bbox_filter(df, [6, 6, 9, 9]).count() == 1


def test_attr_filter_type_strict(spark):
    df = _frame(spark, [(1, "a", 0, 0, 1, 1), (2, "b", 0, 0, 1, 1)])
    assert attr_filter(df, {"name": "a", "missing": 3}).count() == 1
    assert attr_filter(df, {"id": "1"}).count() == 0
    assert attr_filter(df, {"name": None}).count() == 0
    assert attr_filter(df, {"id": 2}).count() == 1
    assert where_filter(df, "id > 1").count() == 1
    assert count_features(df).first()["feature_count"] == 2


def test_extent_skips_null_and_nan(spark):
    df = _frame(spark, [(1, "a", 0, 0, 1, 1), (2, "a", float("nan"), 5, float("nan"), 6),
                        (3, "a", None, None, None, None)])
    r = extent(df).first()
    assert (r["xmin"], r["ymin"], r["xmax"], r["ymax"], r["feature_count"]) == (0, 0, 1, 6, 3)


def test_all_null_extent_is_null_or_error(spark):
    df = _frame(spark, [(1, "a", None, None, None, None)])
    ext = extent(df)
    assert ext.first()["xmin"] is None
    try:
        require_extent(ext)
        raise AssertionError("expected error")
    except ValueError:
        pass


def test_intersection_strict(spark):
    touching = _frame(spark, [(1, "g", 0, 0, 1, 1), (2, "g", 1, 0, 2, 1)])
    assert bbox_intersection_agg(touching).first()["xmin"] is None
    overlap = _frame(spark, [(1, "g", 0, 0, 2, 2), (2, "g", 1, 1, 3, 3)])
    r = bbox_intersection_agg(overlap).first()
    assert (r["xmin"], r["ymin"], r["xmax"], r["ymax"]) == (1, 1, 2, 2)


boxes = st.lists(st.tuples(st.floats(-170, 170), st.floats(-80, 80), st.floats(0, 5),
                           st.floats(0, 5)), min_size=1, max_size=8)


@settings(max_examples=5, deadline=None)
@given(boxes)
def test_union_contains_and_intersection_inside(spark, bs):
    rows = [(i, "g", x, y, x + w, y + h) for i, (x, y, w, h) in enumerate(bs)]
    df = _frame(spark, rows)
    u = bbox_union_agg(df).first()
    for _, _, x0, y0, x1, y1 in rows:
        assert u["xmin"] <= x0 and u["ymin"] <= y0 and u["xmax"] >= x1 and u["ymax"] >= y1
    i = bbox_intersection_agg(df).first()
    if i["xmin"] is not None:
        for _, _, x0, y0, x1, y1 in rows:
            assert x0 <= i["xmin"] and i["xmax"] <= x1 and y0 <= i["ymin"] and i["ymax"] <= y1


def test_expand_roundtrip(spark):
    r = spark.range(1).select(expand_bbox(expand_bbox(lit_bbox([1, 2, 3, 4]), 0.25), -0.25)
                              .alias("b")).first()["b"]
    assert all(math.isclose(a, b) for a, b in zip(r, (1, 2, 3, 4)))
    z = spark.range(1).select(expand_bbox(lit_bbox([1, 2, 3, 4]), 0).alias("b")).first()["b"]
    assert tuple(z) == (1, 2, 3, 4)


def test_negative_buffer_inverts_and_is_flagged(spark):
    from geospan.functions.bbox import bbox_inverted
    r = spark.range(1).select(expand_bbox(lit_bbox([0, 0, 1, 1]), -0.75).alias("b")).select(
        "b", bbox_inverted("b").alias("bad")).first()
    assert r["b"].xmin > r["b"].xmax and r["bad"] is True


def test_exact_filter_on_wkb(spark):
    from geospan.functions import wkb as W
    poly = bytearray(W.wkt_to_wkb("POLYGON ((0 0, 10 0, 0 10, 0 0))"))
    df = spark.createDataFrame([(1, poly)], "id int, geometry binary") \
        .withColumn("bbox", lit_bbox([0, 0, 10, 10]))
    assert bbox_filter(df, [6, 6, 9, 9], exact=True).count() == 0
    assert bbox_filter(df, [4, 4, 9, 9], exact=True).count() == 1
    assert bbox_filter(df, [-1, -1, 11, 11], exact=True).count() == 1


def test_strict_extent_is_computed_once(spark):
    """The test for bounds and the result share one pass over the features."""
    from pyspark.sql import functions as F

    from geospan.operators.extent import extent, require_extent

    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: seen.add(1) or x, "double")
    feats = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)] * 5, "a double, b double, c double, d double").repartition(2)
    feats = feats.withColumn("bbox", F.struct(count("a").alias("xmin"), F.col("b").alias("ymin"), F.col("c").alias("xmax"), F.col("d").alias("ymax")))
    got = require_extent(extent(feats)).collect()
    assert [tuple(r) for r in got] == [(1.0, 2.0, 3.0, 4.0, 5)]
    assert seen.value == 5
