"""Request waves: asking for what is left, again and again, ends with the whole recording."""

import json

import pytest
from pyspark.sql import functions as F

from geospan.operators.pages import assemble_linked_pages, assemble_offset_pages
from geospan.plans.requests import job_progress, next_requests

JOBS = ("job_name string, api_type string, url string, collection string, max_records int, feature_count long, "
        "bbox struct<xmin: double, ymin: double, xmax: double, ymax: double>")
ANSWERS = "job_name string, page int, request_url string, status int, body string"
SIZES = {"a": 0, "b": 7, "c": 10, "d": 25, "e": 40}


def page(job, k, n, size=10, link=None):
    feats = [{"type": "Feature", "properties": {"job": job, "i": i}, "geometry": None} for i in range(k * size, min(n, (k + 1) * size))]
    return json.dumps({"type": "FeatureCollection", "features": feats, "links": [{"rel": "next", "href": link}] if link else []})


def serve(row, wave):
    """A server that fails on some first tries."""
    job, k = row["job_name"], row["page"]
    kind, n = job.split("-")
    if kind == "gone" or (wave + k + len(job)) % 4 == 0 and row["attempt"] == 1:
        return 500, None
    n = SIZES[n]
    if kind == "linked":
        more = (k + 1) * 10 < n
        return 200, page(job, k, n, link=f"https://x/{job}?p={k + 1}" if more else f"https://x/{job}" if n == 40 else None)  # the last one closes a cycle
    if kind == "single":
        return 200, page(job, 0, n, 1000)
    return 200, page(job, k, n)


@pytest.mark.parametrize("ahead", [2])
def test_waves_end_with_everything(spark, ahead):
    rows = [(f"{kind}-{s}", api, f"https://x/{kind}/{s}", "c", 10, None if kind != "counted" else SIZES[s], None)
            for kind, api in (("offset", "ArcGIS"), ("counted", "arcgis"), ("linked", "ogcapi"), ("single", "wfs")) for s in SIZES]
    rows.append(("gone-a", "rest", "https://x/gone", None, None, None, None))
    jobs = spark.createDataFrame(rows, JOBS)
    answered, waves, asked_first = [], 0, None
    while True:
        responses = spark.createDataFrame(answered, ANSWERS)
        wave = next_requests(jobs, responses, ahead=ahead).collect()
        if not wave:
            break
        if asked_first is None:
            asked_first = {(r["job_name"], r["page"]) for r in wave}
        assert len({(r["job_name"], r["page"]) for r in wave}) == len(wave)
        answered += [(r["job_name"], r["page"], r["request_url"], *serve(r, waves)) for r in wave]
        waves += 1
        assert waves < 20
    assert {j for j, _ in asked_first} == {r[0] for r in rows} and ("counted-e", 3) in asked_first
    responses = spark.createDataFrame(answered, ANSWERS).where("body IS NOT NULL")
    offset = responses.where("job_name LIKE 'offset%' OR job_name LIKE 'counted%'").select(F.col("job_name").alias("job"), (F.col("page") * 10).alias("off"), "status", "body")
    got = {(r["job"], r["i"]) for r in assemble_offset_pages(offset, 10, properties_schema="struct<job: string, i: int>").select("job", "i", "complete").collect()}
    assert got == {(f"{k}-{s}", i) for k in ("offset", "counted") for s, n in SIZES.items() for i in range(n)}
    linked = responses.where("job_name LIKE 'linked%'")
    starts = linked.where("page = 0").select(F.col("job_name").alias("job"), F.col("request_url").alias("url"))
    out = assemble_linked_pages(linked.select(F.col("request_url").alias("url"), "status", "body"), starts, properties_schema="struct<i: int>").select("job", "i", "complete").collect()
    assert {(r["job"], r["i"]) for r in out} == {(f"linked-{s}", i) for s, n in SIZES.items() for i in range(n)} and all(r["complete"] for r in out if r["job"] != "linked-e")
    states = {r["job_name"]: (r["state"], r["failed"]) for r in job_progress(jobs, spark.createDataFrame(answered, ANSWERS)).collect()}
    assert states.pop("gone-a") == ("failed", 3) and {s for s, _ in states.values()} == {"complete"}


def test_repeated_and_wrong_answers(spark):
    jobs = spark.createDataFrame([("j", "arcgis", "u", None, 2, None, None)], JOBS)

    def left(*answers):
        return sorted((r["page"], r["attempt"]) for r in next_requests(jobs, spark.createDataFrame([("j", k, "u", s, b) for k, s, b in answers], ANSWERS)).collect())
    full, short = page("j", 0, 2, 2), page("j", 0, 1, 2)
    assert left() == [(0, 1)]
    assert left((0, 200, full)) == [(1, 1)]
    assert left((0, 200, full), (2, 200, short)) == [(1, 1)]
    assert left((0, 500, None), (0, None, full), (0, 200, full)) == [(1, 1)]
    assert left((0, 200, '{"error": 1}')) == [(0, 2)] and left(*[(0, 500, None)] * 3) == []
    assert left((0, 200, short), (5, 200, full)) == []
    nobody = next_requests(jobs.limit(0), spark.createDataFrame([], ANSWERS))
    assert nobody.count() == 0


def test_bodies_are_exchanged_once(spark):
    rows = spark.createDataFrame([("j", k * 2, page("j", k, 5, 2)) for k in range(3)] * 2, "job string, off int, body string")
    out = assemble_offset_pages(rows, 2, properties_schema="struct<i: int>")
    assert sorted(r["i"] for r in out.collect()) == list(range(5)) and all(r["complete"] for r in out.collect())
    once = assemble_offset_pages(rows.dropDuplicates(), 2, properties_schema="struct<i: int>")
    assert sorted(r["i"] for r in once.collect()) == list(range(5))
