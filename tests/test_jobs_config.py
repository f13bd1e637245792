"""Job tables: boxes, defaults, names of files, job files, lookups, routes."""

import json

from pyspark.sql import functions as F

import pytest

from geospan.functions.bbox import bbox_to_list, bbox_to_wkt, lit_bbox
from geospan.functions.envelope import env_wkt
from geospan.plans import jobs as J

HARBOUR = {"job_name": "harbour", "data_source": {"name": "Quays", "url": "hdfs://n/quays.parquet", "layer_name": "north", "geometry_column": "shape"},
           "bounding_box": {"min_lon": 9.9, "min_lat": 53.5, "max_lon": 10.1, "max_lat": 53.6}, "output_formats": ["csv", "parquet"],
           "output_prefix": "port", "metadata": {"owner": "dock office", "depth": 12}}


@pytest.mark.parametrize("box", [[3.5, -2, 8, 4.25], [0, 0, 0, 0], [5, 1, -5, -1]])
def test_a_box_as_list_and_as_polygon(spark, box):
    r = spark.range(1).select(bbox_to_list(lit_bbox(box)).alias("l"), bbox_to_wkt(lit_bbox(box)).alias("w")).first()
    assert r["l"] == [float(v) for v in box]
    b = spark.range(1).select(env_wkt(F.lit(r["w"])).alias("b")).first()["b"]
    x, y = sorted((box[0], box[2])), sorted((box[1], box[3]))
    assert tuple(b) == (x[0], y[0], x[1], y[1]) and r["w"].startswith(f"POLYGON (({box[2]:g} {box[1]:g}, ")


@pytest.mark.parametrize("box, want", [
    ("[1, 2, 3, 4]", (1.0, 2.0, 3.0, 4.0)), (" [1.5,2,3,4]", (1.5, 2.0, 3.0, 4.0)), ("[1, 2, 3]", None), ("[1, 2, 3, 4, 5]", None),
    ('{"min_lon": 1, "min_lat": 2, "max_lon": 3, "max_lat": 4}', (1.0, 2.0, 3.0, 4.0)), ('{"min_lon": 1, "min_lat": 2, "max_lon": 3}', (1.0, 2.0, 3.0, None)),
    ('"north"', None), ("null", None)])
def test_boxes_of_job_texts(spark, box, want):
    df = spark.createDataFrame([(f'{{"data_source": "s", "bounding_box": {box}}}',)], "text string")
    got = J.parse_job_text(df).first()["bbox"]
    assert (None if got is None else tuple(got)) == want


def test_defaults_of_a_bare_job(spark):
    j = J.parse_job_text(spark.createDataFrame([('{"data_source": {"url": "x.csv"}}',)], "text string"))
    r = J.resolve_jobs(j, J.builtin_sources(spark), J.builtin_locations(spark)).first()
    assert (r["job_name"], r["output_prefix"], r["output_formats"], r["metadata"]) == (J.DEFAULT_JOB_NAME, J.DEFAULT_PREFIX, J.DEFAULT_FORMATS, {})
    assert (r["layer_name"], r["geometry_column"], r["status"], r["url"]) == (None, J.DEFAULT_GEOMETRY_COLUMN, "no_bbox", "x.csv")


@pytest.mark.parametrize("fmt, end", [("GeoJSON", ".geojson"), ("filegdb", ".gdb"), ("shapefile", ".shp"), ("parquet", ".parquet"), ("odd", ".odd")])
def test_names_of_output_files(spark, fmt, end):
    ts = F.to_timestamp(F.lit("2031-12-30 23:59:07"))
    name = spark.range(1).select(J.output_filename(F.lit("port"), F.lit("harbour 7"), F.lit(fmt), ts)).first()[0]
    assert name == f"port_harbour 7_20311230_235907{end}"


def test_job_files_of_every_shape(spark, scratch):
    files = {"a": HARBOUR, "b": {"job_name": "park", "data_source": "fws_wetlands_fl", "location": "disney_animal_kingdom", "bounding_box": [0, 0, 1, 1]},
             "c": {"job_name": "nowhere", "data_source": "fws_wetlands_fl"}, "d": {"job_name": "lost", "data_source": "no such source", "bounding_box": [0, 0, 1, 1]}}
    for name, job in files.items():
        with open(f"{scratch}/{name}.json", "w") as f:
            json.dump(job, f, indent=2)
    jobs = J.read_jobs(spark, f"{scratch}/*.json")
    res = {r["job_name"]: r for r in J.resolve_jobs(jobs, J.builtin_sources(spark), J.builtin_locations(spark)).collect()}
    h = res["harbour"]
    assert (h["source_name"], h["url"], h["layer_name"], h["geometry_column"]) == ("Quays", "hdfs://n/quays.parquet", "north", "shape")
    assert tuple(h["bbox"]) == (9.9, 53.5, 10.1, 53.6) and h["metadata"] == {"owner": "dock office", "depth": "12"}
    assert {n: r["status"] for n, r in res.items()} == {"harbour": "ok", "park": "ok", "nowhere": "no_bbox", "lost": "unknown_source"}
    assert res["park"]["bbox"].xmin < -81 and res["park"]["url"].startswith("zip://")  # the named place wins over the box


def test_cli_style_unknown_source_is_url(spark):
    jobs = spark.createDataFrame([("j", "https://x.org/a.csv", None)],
                                 "job_name string, source_key string, location string") \
        .withColumn("bbox", lit_bbox([0, 0, 1, 1]))
    r = J.resolve_jobs(jobs, J.builtin_sources(spark), J.builtin_locations(spark),
                       unknown_source_as_url=True).first()
    assert r["url"] == "https://x.org/a.csv" and r["source_name"] == "custom"


def test_metadata_merge_later_wins(spark):
    r = spark.range(1).select(J.merge_maps(
        J.parse_metadata(F.lit('{"a": "1", "b": {"c": 2}}')),
        F.create_map(F.lit("a"), F.lit("2"))).alias("m"),
        J.parse_metadata(F.lit("not json")).alias("bad")).first()
    assert r["m"] == {"a": "2", "b": '{"c":2}'}
    assert r["bad"] == {}


def test_remote_paths():
    assert J.hadoop_path("s3://bucket/key/a.parquet") == "s3a://bucket/key/a.parquet"
    assert J.hadoop_path("gcs://b/x") == "gs://b/x"
    opts = J.hadoop_options("s3://b/k", {"key": "AK", "secret": "SK"})
    assert opts == {"fs.s3a.bucket.b.access.key": "AK", "fs.s3a.bucket.b.secret.key": "SK"}


def test_routing(spark):
    df = spark.createDataFrame([("https://services.example.com/api/v1",), ("s3://b/a.parquet",),
                                ("data/file.geojson",), ("https://host/file.CSV?x=1",)], "url string")
    rows = J.route_sources(df).collect()
    assert [r["route"] for r in rows] == ["api", "remote", "file", "file"]
    assert [r["file_kind"] for r in rows] == ["csv", "parquet", "json", "csv"]
    assert rows[1]["host"] == "b"
