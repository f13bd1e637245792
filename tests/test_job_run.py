"""A job file to manifest, zip members as features, and Parquet columns called bbox."""

import json
import zipfile

import pytest

from pyspark.sql import functions as F

from geospan.plans.jobs import read_jobs
from geospan.plans import run as R
from geospan.plans.run import publish_batch, run_job_table, run_jobs
from geospan.sources.files import read_features_parquet, read_source


def point(x, **props):
    return {"type": "Feature", "properties": props, "geometry": {"type": "Point", "coordinates": [x, x]}}


def test_job_files_to_manifest(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "in.ZIP", "w") as z:
        z.writestr("a/one.geojson", json.dumps({"type": "FeatureCollection", "features": [point(1, n=1), point(2, n=2)]}))
        z.writestr("a/two.geojson", json.dumps({"type": "FeatureCollection", "features": [point(3, n=3)]}, indent=1))
        z.writestr("readme.txt", "no features")
    feats = read_source(spark, f"zip://{tmp_path}!a/*.geojson")
    assert sorted(r["n"] for r in feats.collect()) == [1, 2, 3]

    (tmp_path / "jobs").mkdir()
    for name, box, formats in (("low", [0, 0, 2, 2], ["csv", "GeoJSON"]), ("all", [0, 0, 9, 9], ["parquet", "gpkg", "odd"]),
                               ("none", [5, 5, 6, 6], ["csv"])):
        (tmp_path / "jobs" / f"{name}.json").write_text(json.dumps(
            {"job_name": name, "data_source": "x", "bounding_box": box, "output_formats": formats}))
    out = str(tmp_path / "out")
    ts = F.to_timestamp(F.lit("2024-01-02 03:04:05"))
    got = {(r["job_name"], r["format"]): r for r in run_jobs(feats, read_jobs(spark, str(tmp_path / "jobs")), out, ts).collect()}
    assert {k: (r["status"], r["feature_count"], r["xmax"]) for k, r in got.items()} == {
        ("low", "csv"): ("ok", 2, 2.0), ("low", "GeoJSON"): ("ok", 2, 2.0), ("all", "parquet"): ("ok", 3, 3.0),
        ("all", "gpkg"): ("unsupported", 3, 3.0), ("all", "odd"): ("unknown", 3, 3.0), ("none", "csv"): ("ok", 0, None)}
    assert got["none", "csv"]["path"] is None and got["all", "gpkg"]["path"] is None
    assert spark.read.option("header", True).csv(got["low", "csv"]["path"]).count() == 2
    assert spark.read.parquet(got["all", "parquet"]["path"]).count() == 3
    assert all(json.loads(r["value"])["type"] == "Feature" for r in spark.read.text(got["low", "GeoJSON"]["path"]).collect())


def test_a_bbox_column_of_another_type_is_kept_beside_the_box(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    spark.createDataFrame([("0 0 1 1", "POINT (1 2)")], "bbox string, geom string").write.parquet(path)
    row = read_features_parquet(spark, path).first()
    assert row["properties_bbox"] == "0 0 1 1" and row["bbox"]["ymax"] == 2.0


JOBS = ("job_name string, url string, layer_name string, geometry_column string, status string, output_formats array<string>, output_prefix string, "
        "bbox struct<xmin: double, ymin: double, xmax: double, ymax: double>")
TS = "2024-01-02 03:04:05"


def test_jobs_over_many_sources_in_one_manifest(spark, tmp_path, monkeypatch):
    feats = [point(x, n=x) for x in range(10)]
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": feats}))
    (tmp_path / "b.csv").write_text("n,lon,lat\n" + "".join(f"{x},{x},{x}\n" for x in range(10)))
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("x.geojson", json.dumps({"features": feats}))
    read_source(spark, str(tmp_path / "a.geojson")).write.parquet(str(tmp_path / "d.parquet"))
    urls = [str(tmp_path / "a.geojson"), str(tmp_path / "b.csv"), f"zip://{tmp_path}/c.zip!*.geojson", str(tmp_path / "d.parquet")]
    rows = [(f"job {k}/{u}:?=%", url, None, "geom", "ok", ["csv", "geojson", "parquet"], "p", tuple(map(float, (u, u, u + k, u + k)))) for u, url in enumerate(urls) for k in range(3)]
    rows += [("gone", str(tmp_path / "gone.geojson"), None, "geom", "ok", ["csv"], "p", (0.0, 0.0, 1.0, 1.0)),
             ("api", "https://x/api", None, "geom", "ok", ["csv"], "p", (0.0, 0.0, 1.0, 1.0)), ("table", "https://y/api", None, "geom", "ok", ["csv"], "p", (0.0, 0.0, 1.0, 1.0)),
             ("lost", None, None, None, "unknown_source", ["csv", "gpkg"], "p", None)]
    scans = []
    real = R.read_source
    monkeypatch.setattr(R, "read_source", lambda s, url, *a: scans.append(url) or real(s, url, *a))
    api = real(spark, urls[0])
    jobs = spark.createDataFrame(rows, JOBS)
    got = run_job_table(jobs, str(tmp_path / "out"), F.to_timestamp(F.lit(TS)), tables={"https://y/api": api})
    seen = {(r["job_name"], r["format"]): r for r in got.collect()}
    assert len(scans) == 5  # four sources and the one that isn't there; the table isn't read
    for u in range(4):
        for k in range(3):
            for fmt in ("csv", "geojson", "parquet"):
                r = seen[f"job {k}/{u}:?=%", fmt]
                assert (r["status"], r["feature_count"], r["xmax"]) == ("ok", k + 1, u + k)
                back = {"csv": spark.read.option("header", True).csv, "geojson": spark.read.text, "parquet": spark.read.parquet}[fmt](r["path"])
                assert back.count() == k + 1 and "job_name" not in back.columns
    assert seen["gone", "csv"]["status"].startswith("failed: ") and seen["api", "csv"]["status"] == "needs_responses"
    assert seen["table", "csv"]["feature_count"] == 2 and seen["lost", "gpkg"]["status"] == "unknown_source"
    batch = {r["file_name"]: r for r in publish_batch(got, "f").collect()}
    assert len(batch) == 4 * 3 * 3 + 1 and all(r["exists"] and r["bytes"] > 0 for r in batch.values())
    with pytest.raises(ValueError, match="twice"):
        run_job_table(jobs.union(jobs.limit(1)), str(tmp_path / "x"), F.to_timestamp(F.lit(TS)))


def test_a_failing_format_does_not_stop_the_others(spark, tmp_path, monkeypatch):
    feats = read_source(spark, str(_collection(tmp_path, 20)))
    jobs = spark.createDataFrame([("j", "u", None, None, "ok", ["csv", "geojson", "parquet"], "p", (0.0, 0.0, 99.0, 99.0))], JOBS)
    real = R._writers

    def broken(geometry):
        return real(geometry) | {"geojson": lambda rows: (rows.select("job_folder", "_job_files", F.raise_error(F.lit("no room")).alias("value")), "text", {})}
    monkeypatch.setattr(R, "_writers", broken)
    got = {r["format"]: r for r in run_jobs(feats, jobs, str(tmp_path / "out"), F.to_timestamp(F.lit(TS))).collect()}
    assert got["csv"]["status"] == got["parquet"]["status"] == "ok" and got["geojson"]["status"].startswith("failed") and got["geojson"]["path"] is None


def _collection(tmp_path, n):
    path = tmp_path / "many.geojson"
    path.write_text(json.dumps({"features": [point(x % 90, n=x, s="x" * 50) for x in range(n)]}))
    return path


def test_files_follow_jobs_and_bytes(spark, tmp_path):
    feats = read_source(spark, str(_collection(tmp_path, 4000))).repartition(8)
    rows = [(f"small {k}", "u", None, None, "ok", ["csv", "parquet"], "p", (float(k), float(k), float(k), float(k))) for k in range(40)]
    rows.append(("large", "u", None, None, "ok", ["csv", "parquet"], "p", (0.0, 0.0, 99.0, 99.0)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these are far below the size that Spark gives a task
    try:
        got = run_jobs(feats, spark.createDataFrame(rows, JOBS), str(tmp_path / "out"), F.to_timestamp(F.lit(TS)), file_bytes=1_000, strategy="broadcast").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for fmt in ("csv", "parquet"):
        per_job = {r["job_name"]: len(list((tmp_path / "out" / fmt / r["path"].rsplit("/", 1)[1]).glob("part-*"))) for r in got if r["format"] == fmt}
        assert len(per_job) == 41 and all(n == 1 for j, n in per_job.items() if j != "large") and 2 <= per_job["large"] <= 8
    assert sum(spark.read.parquet(r["path"]).count() for r in got if r["format"] == "parquet") == 4000 + sum(r["feature_count"] for r in got if r["job_name"] != "large" and r["format"] == "csv")
