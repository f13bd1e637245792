"""What a job table does with each feature: cut and parsed once, decoded once, shuffled once to its file."""

import json
import random
import threading
import zipfile

import pytest
from pyspark.sql import functions as F

from geospan.operators.geometry import decode_geometry
from geospan.plans import run as R
from geospan.session import side_by_side
from geospan.sources import files, ranges


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def number(rng):
    digits = rng.choice(["0", "7", "-12", "-0", "170.0000", "-3.1400", "0.5", "-0.0", "0.0005", "1e5", "12345678.5", "12345678901234567890", "0.001", "9999999.25"])
    return rng.choice([digits, f"{rng.uniform(-180, 180):.4f}", f"{rng.uniform(-180, 180):.{rng.randrange(1, 16)}f}", str(rng.uniform(-1, 1))])


def features(n):
    rng = random.Random(5)
    for i in range(n):
        xy = lambda sep=",": f"[{number(rng)}{sep}{number(rng)}]"
        ring = "[" + ",".join(xy() for _ in range(4)) + "]"
        geometry = rng.choice([f'{{"type":"Point","coordinates":{xy()}}}', f'{{"type":"Polygon","coordinates":[{ring}]}}', f'{{"type":"Point","coordinates":{xy(", ")}}}',
                               f'{{"type":"MultiPolygon","coordinates":[[{ring}]]}}', "null", '{"type":"GeometryCollection","geometries":[]}'])
        extra = rng.choice(['"s":"é } \\u0041"', '"s":"a{b"', '"s":null', '"s":[1]', '"s":{}', f'"s":{number(rng)}', '"s" : true', '"s":"[1.50]"'])
        properties = f'{{"i":{i},{extra}}}'
        yield rng.choice([f'{{"type":"Feature","properties":{properties},"geometry":{geometry}}}', f'{{"type":"Feature","geometry":{geometry},"properties":{properties}}}',
                          f'{{ "type": "Feature", "properties": {properties}, "geometry": {geometry} }}', f'{{"properties":{properties},"geometry":{geometry}}}',
                          f'{{"type":"Feature","properties":{properties},"geometry":{geometry},"id":{i}}}'])


@pytest.mark.parametrize("size", [700, 1 << 27])
def test_members_are_what_from_json_gives(spark, tmp_path, size):
    texts = list(features(400))
    for k in range(2):
        (tmp_path / f"{k}.geojson").write_text('{"type":"FeatureCollection","features":[' + ",".join(texts[k::2]) + "]}")
    with zipfile.ZipFile(tmp_path / "in.zip", "w") as z:
        z.writestr("a.geojson", '{"features":[' + ",\n".join(texts) + "]}\n")
    expected = spark.createDataFrame([(t,) for t in texts], "t string").select(F.from_json("t", ranges.FEATURE).alias("f")).select("f.properties", "f.geometry")
    key = lambda rows: sorted((str(r[0]), str(r[1])) for r in rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        got = files._scanned_features(spark, [str(tmp_path / f"{k}.geojson") for k in range(2)]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert key(got) == key(expected.collect())
    members = files.archive_members(spark, str(tmp_path / "in.zip"))
    assert key(files._features_of(ranges.scan_whole(members, files._cut_members(max(64, size >> 4)))).collect()) == key(expected.collect())


def test_features_are_parsed_once(spark, tmp_path):
    texts = [f'{{"type":"Feature","properties":{{"i":{i}}},"geometry":{{"type":"Point","coordinates":[{i},0.5]}}}}' for i in range(50)]
    (tmp_path / "a.geojson").write_text('{"features":[' + ",".join(texts) + "]}")
    read = files.read_geojson(spark, str(tmp_path / "a.geojson"))
    assert read.count() == 50
    told = plan(files.scan_features(spark, str(tmp_path / "a.geojson")).where("kind = 'element'").select("feature.geometry"))
    assert "Generate" not in told and told.count("from_json") <= 1  # of those that go over a range's end
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.write(tmp_path / "a.geojson", "a.geojson")
    members = files.read_archive_features(spark, str(tmp_path / "a.zip"), properties_schema="struct<i: bigint>")
    assert plan(members).count("from_json") == 1 and members.count() == 50  # the properties


@pytest.mark.parametrize("text", ['{"features":[{"type":"Feature","properties":{"i":1}', '{"features":[{"type":"Feature","properties":{"s":"open}}]}',
                                  '{"features":[{"type":"Feature",bad}]}', '{"features":[{"type":"Feature","properties":{"a":01},"geometry":{"type":bad}}]}'])
def test_broken_members_raise(spark, tmp_path, text):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("good.geojson", '{"features":[]}')
        z.writestr("bad.geojson", text)
    if "01" in text:  # Spark takes the type of such a member, and neither its properties nor its geometry
        assert [tuple(r) for r in files.read_archive_features(spark, str(tmp_path / "a.zip"), properties_schema="struct<a: bigint>").collect()] == [(None, None)]
        return
    with pytest.raises(Exception, match="don't close|no JSON"):
        files.read_archive_features(spark, str(tmp_path / "a.zip"), properties_schema="struct<i: bigint>").collect()


def test_a_filter_on_the_box_does_not_repeat_the_decoding(spark):
    texts = spark.createDataFrame([("POINT (1 2)",), ("POINT Z (1 2 3)",), ('{"type":"Point","coordinates":[5,5]}',), ("odd",), (None,)], "geom string")
    once = decode_geometry(texts)
    b = F.col("bbox")
    some = once.where(((b.xmin <= 3) & (b.xmax >= 0) & (b.ymin <= 3) & (b.ymax >= 0)) | (b.xmin > 100))
    assert plan(some).count("regexp_extract_all") == plan(once).count("regexp_extract_all")
    assert sorted(r["geometry"] for r in some.collect()) == ["POINT (1 2)", "POINT Z (1 2 3)"]
    assert once.columns == ["geometry", "bbox", "_bad"] and [r["_bad"] for r in once.collect()] == [False, False, False, True, False]


JOBS = "job_name string, output_formats array<string>, output_prefix string, bbox struct<xmin: double, ymin: double, xmax: double, ymax: double>"


def test_rows_are_shuffled_once_each_file_to_a_task(spark, tmp_path, monkeypatch):
    feats = spark.range(900).select("id", F.concat(F.lit("POINT ("), F.col("id") % 90, F.lit(" 1)")).alias("geometry")).repartition(5)
    feats = decode_geometry(feats, "geometry")
    jobs = spark.createDataFrame([(f"j{k}", ["csv", "geojson", "parquet"], "p", (float(15 * k), 0.0, float(15 * k + 14), 9.0)) for k in range(6)], JOBS)
    seen, frame = [], type(feats)
    deal = frame.repartitionById
    monkeypatch.setattr(frame, "repartitionById", lambda self, n, c: seen.append((n, plan(self))) or deal(self, n, c))
    got = R.run_jobs(feats, jobs, str(tmp_path / "out"), F.to_timestamp(F.lit("2024-01-02 03:04:05"))).collect()
    assert sorted(n for n, _ in seen) == [6, 6, 6] and all("Repartition" not in p for _, p in seen)
    assert all(r["feature_count"] == 150 and r["status"] == "ok" for r in got)
    for r in got:
        assert len(list((tmp_path / "out").glob(r["path"].split("/out/")[1] + "/part-*"))) == 1
    z = [r["id"] % 90 for r in spark.read.parquet(f"{tmp_path}/out/parquet/job_folder=*").coalesce(1).collect()]
    assert len(z) == 900
    one = spark.read.parquet(next(r["path"] for r in got if r["format"] == "parquet" and r["job_name"] == "j3"))
    x = [r["bbox"]["xmin"] for r in one.collect()]
    assert x == sorted(x)  # y is the same for all: along the curve x rises


def test_sources_are_run_side_by_side(spark):
    both = threading.Barrier(2, timeout=60)
    assert side_by_side(spark, lambda k: both.wait() * 0 + spark.range(k).count(), [3, 4]) == [3, 4]
    assert side_by_side(spark, lambda k: k, []) == []
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, lambda k: 1 // k, [1, 0])
