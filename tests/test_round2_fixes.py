"""Inputs that must lose nothing: mixed file layouts, clashing names, repeated responses, reruns."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from geospan.functions.bbox import make_bbox
from geospan.operators.pages import assemble_linked_pages, assemble_offset_pages
from geospan.sinks.publish import publish_manifest
from geospan.sources import files as S
from geospan.sources.responses import parse_features


def feature(k, **props):
    return {"type": "Feature", "properties": {"k": k, **props}, "geometry": {"type": "Point", "coordinates": [k, 1]}}


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_mixed_layouts_keep_every_feature(spark, scratch):
    d = f"{scratch}/mixed"
    put(d, "lines.geojson", '{"type":"FeatureCollection","features":[\n' + ",\n".join(json.dumps(feature(k)) for k in range(30)) + "\n]}")
    put(d, "indented.geojson", json.dumps({"type": "FeatureCollection", "features": [feature(k) for k in range(30, 40)]}, indent=1))
    put(d, "header.geojson", '{"type":"FeatureCollection","features":[' + ",\n".join(json.dumps(feature(k)) for k in range(40, 44)) + "]}")
    put(d, "second.geojson", '{"type":"FeatureCollection","features":[\n' + json.dumps(feature(44)) + ",\n" + json.dumps(feature(45), indent=1) + "]}")
    put(d, "nd.geojson", "\n".join(json.dumps(feature(k)) for k in range(46, 50)))
    got = S.read_source(spark, d + "/*.geojson", geometry="geometry")
    assert sorted(r["k"] for r in got.collect()) == list(range(50))


def test_bad_feature_line_raises(spark, scratch):
    put(scratch, "bad.geojson", json.dumps(feature(1)) + "\n" + json.dumps(feature(2))[:-5])
    with pytest.raises(ValueError, match="no whole GeoJSON"):
        S.read_source(spark, f"{scratch}/bad.geojson")


def test_records_with_array_cells_stay_records(spark, scratch):
    put(scratch, "r.json", json.dumps([{"a": [1, 2]}, {"a": [3]}]))
    put(scratch, "c.json", json.dumps({"a": [1, 2, 3], "b": [4, 5, 6]}))
    assert S.read_json_records(spark, f"{scratch}/r.json").count() == 2
    assert S.read_json_records(spark, f"{scratch}/c.json").count() == 3


def test_lonlat_table_gets_points(spark, scratch):
    put(scratch, "p.csv", "id,Latitude,Longitude\n1,2.0,3.0\n")
    row = S.read_source(spark, f"{scratch}/p.csv").first()
    assert row["geometry"] == "POINT (3 2)" or row["bbox"]["xmin"] == 3.0


def test_clashing_properties_are_kept(spark):
    body = json.dumps({"type": "FeatureCollection", "features": [feature(7, job="x", off=3)]})
    rows = parse_features(spark.createDataFrame([("j", 0, body)], "job string, off long, body string"))
    row = rows.first()
    assert (row["job"], row["properties_job"], row["off"], row["properties_off"], row["k"]) == ("j", "x", 0, 3, 7)


def page(ks):
    return json.dumps({"type": "FeatureCollection", "features": [feature(k) for k in ks]})


def test_offset_pages_limits_repeats_and_errors(spark):
    rows = [("a", 0, page(range(5)), 5, 200), ("a", 0, page(range(5)), 5, 200), ("a", 5, page(range(5, 10)), 5, 200),
            ("a", 10, page([10, 11]), 5, 200), ("b", 0, page(range(3)), 3, 200), ("b", 3, '{"error": 1}', 3, 500),
            ("b", 3, page(range(3, 6)), 3, 200), ("b", 6, page([]), 3, 200), ("c", 0, page(range(4)), 4, 200), ("c", 4, page(range(4, 8)), 4, 200)]
    df = spark.createDataFrame(rows, "job string, off long, body string, size long, status int").withColumn("n", F.lit(8))
    out = assemble_offset_pages(df, limit="size", total="n", properties_schema="struct<k:int>")
    got = {j: (sorted(r["k"] for r in out.where(F.col("job") == j).collect()), out.where(F.col("job") == j).first()["complete"]) for j in "abc"}
    assert got == {"a": (list(range(12)), True), "b": (list(range(6)), True), "c": (list(range(8)), True)}


def test_linked_pages_recorded_twice(spark):
    n = 70
    bodies = [json.dumps({"features": [feature(k)], "links": [{"rel": "next", "href": f"u{k + 1}"}] if k < n - 1 else []}) for k in range(n)]
    pages = spark.createDataFrame([(f"u{k}", b) for k, b in enumerate(bodies)] * 2, "url string, body string")
    out = assemble_linked_pages(pages, spark.createDataFrame([("j", "u0")], "job string, url string"), properties_schema="struct<k:int>")
    rows = out.collect()
    assert sorted(r["k"] for r in rows) == list(range(n)) and all(r["complete"] for r in rows)


def test_publish_reduces_repeated_files(spark):
    cur = spark.createDataFrame([("f", "a", 1, 10, {"x": "1"})], "folder string, file_name string, version int, bytes long, metadata map<string,string>")
    batch = spark.createDataFrame([("f", "a", 5, {"y": "1"}, True, 1), ("f", "a", 7, {"y": "2"}, True, 2)],
                                  "folder string, file_name string, bytes long, metadata map<string,string>, exists boolean, sequence int")
    rows = publish_manifest(cur, batch).collect()
    assert [(r["version"], r["bytes"], r["metadata"]) for r in rows] == [(2, 7, {"x": "1", "y": "2"})]


def test_stream_checkpoint_is_the_configured_folder(spark, scratch):
    from geospan.streaming.bbox_stream import start_box_extraction

    base, name = spark.conf.get("spark.checkpoint.dir"), f"{os.path.basename(scratch)}-{uuid.uuid4().hex}"
    src, sink = f"{scratch}/src", f"{scratch}/sink"
    for lo in (0, 10):
        df = spark.range(lo, lo + 10).select("id", make_bbox(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)).alias("bbox"))
        df.write.mode("append").parquet(src)
        # what a new session does: another random sub-folder for RDD checkpoints
        spark.sparkContext.setCheckpointDir(base)
        start_box_extraction(spark, src, df.schema, [0, 0, 1, 1], sink, name).awaitTermination(120)
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == list(range(20))
    assert os.path.isdir(f"{base}/streams/{name}")
