import json
import random

from hypothesis import given, settings, strategies as st

from geospan.functions.bbox import make_bbox
from geospan.operators.extract import extract_jobs, job_summary
from geospan.operators.pages import assemble_linked_pages, assemble_offset_pages


def _boxes(spark, rows, key):
    rows = [(r[0],) + tuple(float(v) for v in r[1:]) for r in rows]
    df = spark.createDataFrame(rows, f"{key} long, x0 double, y0 double, x1 double, y1 double")
    return df.select(key, make_bbox("x0", "y0", "x1", "y1").alias("bbox"))


def _pairs(df):
    return sorted((r["fid"], r["jid"]) for r in df.select("fid", "jid").collect())


def _brute(f, j):
    return sorted((a[0], b[0]) for a in f for b in j
                  if a[1] <= b[3] and a[3] >= b[1] and a[2] <= b[4] and a[4] >= b[2])


rect = st.tuples(st.floats(-179, 170), st.floats(-89, 80), st.floats(0, 9), st.floats(0, 9))


@settings(max_examples=4, deadline=None)
@given(st.lists(rect, min_size=1, max_size=30), st.lists(rect, min_size=1, max_size=10),
       st.sampled_from([0.5, 2.0, 7.5]))
def test_grid_join_equals_brute_force(spark, fs, js, cell):
    f = [(i, x, y, x + w, y + h) for i, (x, y, w, h) in enumerate(fs)]
    j = [(i, x, y, x + w, y + h) for i, (x, y, w, h) in enumerate(js)]
    fdf, jdf = _boxes(spark, f, "fid"), _boxes(spark, j, "jid")
    want = _brute(f, j)
    for strategy in ("broadcast", "grid_broadcast", "grid"):
        got = _pairs(extract_jobs(fdf, jdf, strategy=strategy, cell_size=cell, max_cells=4,
                                  hot_parts=2, salts=3))
        assert got == want, strategy


def test_huge_and_tiny_objects_and_hot_cell(spark):
    rnd = random.Random(7)
    f = [(i, 10 + rnd.random() * 0.01, 10 + rnd.random() * 0.01, 10.02, 10.02) for i in range(300)]
    f.append((1000, -180, -90, 180, 90))  # world-sized feature
    j = [(0, 9.0, 9.0, 11.0, 11.0), (1, -180, -90, 180, 90), (2, 50, 50, 50, 50)]
    fdf, jdf = _boxes(spark, f, "fid"), _boxes(spark, j, "jid")
    want = _brute(f, j)
    got = _pairs(extract_jobs(fdf, jdf, strategy="grid", cell_size=1.0, hot_parts=4, salts=8))
    assert got == want


def test_job_summary_reports_empty_jobs(spark):
    fdf = _boxes(spark, [(1, 0, 0, 1, 1)], "fid")
    jdf = _boxes(spark, [(1, 0, 0, 2, 2), (2, 50, 50, 51, 51)], "jid")
    rows = {r["jid"]: r for r in job_summary(fdf, jdf, "jid").collect()}
    assert rows[1]["feature_count"] == 1 and rows[2]["feature_count"] == 0
    assert rows[2]["xmin"] is None


def _body(keys, links=None):
    feats = [{"type": "Feature", "properties": {"k": k},
              "geometry": {"type": "Point", "coordinates": [k, k]}} for k in keys]
    d = {"type": "FeatureCollection", "features": feats}
    if links is not None:
        d["links"] = links
    return json.dumps(d)


def test_offset_pages_edges(spark):
    rows = [("a", 0, _body([1, 2])), ("a", 2, _body([3])), ("a", 4, _body([9])),  # stop at 2
            ("b", 0, _body([])), ("b", 2, _body([5, 6])),                        # empty first
            ("c", 0, _body([1, 2])), ("c", 4, _body([7])),                       # gap -> incomplete
            ("d", 0, _body([1, 2])), ("d", 2, _body([3, 4]))]                    # no stop
    df = spark.createDataFrame(rows, "job string, off int, body string")
    out = assemble_offset_pages(df, limit=2, properties_schema="struct<k:int>").collect()
    got = {}
    for r in out:
        got.setdefault(r["job"], (r["complete"], []))[1].append(r["k"])
    assert sorted(got["a"][1]) == [1, 2, 3] and got["a"][0] is True
    assert "b" not in got
    assert got["c"][0] is False
    assert got["d"][0] is False and sorted(got["d"][1]) == [1, 2, 3, 4]


def test_linked_pages_cycle_and_missing(spark):
    def link(u):
        return [{"rel": "self", "href": "x"}, {"rel": "next", "href": u}]
    pages = [("p1", _body([1], link("p2"))), ("p2", _body([2], link("p3"))),
             ("p3", _body([3], link("p1"))),            # cycle back to p1
             ("q1", _body([10], link("q2"))), ("q2", _body([11], link("q3")))]  # q3 missing
    pdf = spark.createDataFrame(pages, "url string, body string")
    starts = spark.createDataFrame([("J", "p1"), ("K", "q1"), ("S", "p3")], "job string, url string")
    out = assemble_linked_pages(pdf, starts, properties_schema="struct<k:int>").collect()
    by = {}
    for r in out:
        by.setdefault(r["job"], []).append((r["step"], r["k"], r["complete"]))
    assert sorted(by["J"]) == [(0, 1, True), (1, 2, True), (2, 3, True)]
    assert sorted(by["S"]) == [(0, 3, True), (1, 1, True), (2, 2, True)]
    assert sorted(s for s, _, _ in by["K"]) == [0, 1] and by["K"][0][2] is False


def test_box_side_hot_cell(spark):
    rnd = random.Random(11)
    f = [(i, rnd.uniform(-50, 50), rnd.uniform(-50, 50), 0, 0) for i in range(200)]
    f = [(i, x, y, x + 0.5, y + 0.5) for i, x, y, _, _ in f]
    j = [(i, 1 + rnd.random() * 0.1, 1 + rnd.random() * 0.1, 1.2, 1.2) for i in range(300)]
    j.append((999, -60.0, -60.0, 60.0, 60.0))
    fdf, jdf = _boxes(spark, f, "fid"), _boxes(spark, j, "jid")
    got = _pairs(extract_jobs(fdf, jdf, strategy="grid", cell_size=1.0, hot_parts=4, salts=5))
    assert got == _brute(f, j)


def test_self_link_terminates(spark):
    link = [{"rel": "next", "href": "s1"}]
    pdf = spark.createDataFrame([("s1", _body([1], link))], "url string, body string")
    starts = spark.createDataFrame([("J", "s1")], "job string, url string")
    out = assemble_linked_pages(pdf, starts, properties_schema="struct<k:int>").collect()
    assert [(r["step"], r["k"]) for r in out] == [(0, 1)]


def test_offset_assembly_independent_of_order_and_partitioning(spark):
    rows = [("a", off, _body(list(range(off, off + (2 if off < 6 else 1)))))
            for off in range(0, 8, 2)]
    rows += [("b", off, _body([100 + off, 101 + off])) for off in range(0, 6, 2)] + \
        [("b", 6, _body([]))]
    base = spark.createDataFrame(rows, "job string, off int, body string")
    want = sorted((r["job"], r["k"], r["complete"]) for r in assemble_offset_pages(
        base, limit=2, properties_schema="struct<k:int>").collect())
    shuffled = spark.createDataFrame(list(reversed(rows)), base.schema).repartition(5)
    got = sorted((r["job"], r["k"], r["complete"]) for r in assemble_offset_pages(
        shuffled, limit=2, properties_schema="struct<k:int>").collect())
    assert got == want
    assert {c for _, _, c in got} == {True}


def test_column_clash_is_reported(spark):
    import pytest
    f = _boxes(spark, [(1, 0, 0, 1, 1)], "fid")
    j = _boxes(spark, [(1, 0, 0, 1, 1)], "fid")
    with pytest.raises(ValueError):
        extract_jobs(f, j)


def test_auto_strategy_respects_bounds(spark):
    rnd = random.Random(5)
    f = [(i, x, y, x + 1, y + 1) for i, (x, y) in
         enumerate((rnd.uniform(-100, 100), rnd.uniform(-60, 60)) for _ in range(120))]
    j = [(i, x, y, x + 3, y + 3) for i, (x, y) in
         enumerate((rnd.uniform(-100, 100), rnd.uniform(-60, 60)) for _ in range(30))]
    fdf, jdf = _boxes(spark, f, "fid"), _boxes(spark, j, "jid")
    want = _brute(f, j)
    for kw in ({}, {"broadcast_boxes": 5}, {"broadcast_boxes": 5, "broadcast_cells": 10},
               {"broadcast_boxes": 5, "broadcast_bytes": 100}):
        assert _pairs(extract_jobs(fdf, jdf, hot_parts=3, salts=3, **kw)) == want, kw
