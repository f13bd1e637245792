"""The grid join beside few continental boxes: equal to the broadcast join, cells built once."""

import random

import pytest
from pyspark.sql import functions as F

from geospan.operators import extract as X

BOX = "struct<xmin: double, ymin: double, xmax: double, ymax: double>"


def boxes(rng, n, side, prefix):
    out = []
    for k in range(n):
        x, y = rng.uniform(-170, 160), rng.uniform(-80, 70)
        out.append((f"{prefix}{k}", (x, y, x + rng.uniform(0, side), y + rng.uniform(0, side))))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    features = spark.createDataFrame(boxes(rng, 3000, 0.5, "f") + boxes(rng, 20, 90, "wide") + [("none", None)], f"fid string, bbox {BOX}")
    jobs = spark.createDataFrame(boxes(rng, 40, 120, "continent") + boxes(rng, 1500, 1.0, "small") + [("flipped", (10.0, 10.0, 5.0, 5.0)), ("nil", None)], f"job_name string, bbox {BOX}")
    return features.checkpoint(), jobs.checkpoint()


def pairs(df):
    rows = [(r["fid"], r["job_name"]) for r in df.select("fid", "job_name").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_every_plan_gives_the_same_pairs(tables):
    features, jobs = tables
    want = pairs(X.extract_jobs(features, jobs, strategy="broadcast", broadcast_boxes=10**6))
    for strategy in ("grid_broadcast", "grid"):
        for kw in ({}, {"coarse": False}, {"broadcast_boxes": 5}, {"broadcast_boxes": 10**6}, {"broadcast_bytes": 3000}):
            if strategy == "grid_broadcast" and "broadcast_bytes" in kw:
                continue  # falls back to the shuffled grid, tested there
            assert pairs(X.extract_jobs(features, jobs, strategy=strategy, **kw)) == want, (strategy, kw)


def test_features_are_not_copied_for_the_few(tables, monkeypatch):
    features, jobs = tables
    seen = []
    real = X.explode_cells
    monkeypatch.setattr(X, "explode_cells", lambda df, b, own, spec, levels=None: seen.append(levels) or real(df, b, own, spec, levels))
    X.extract_jobs(features, jobs, strategy="grid_broadcast")
    X.extract_jobs(features, jobs, strategy="grid_broadcast", coarse=False)
    assert len(seen[1]) < len(seen[3])  # levels that features are copied to


def test_cells_are_built_once(spark, tables):
    features, jobs = tables
    built = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        built.add(1)
        return x
    marked = features.select(counted("fid").alias("fid"), "bbox")
    out = X.extract_jobs(marked, jobs, strategy="grid", broadcast_boxes=0, hot_parts=2)
    assert out.count() > 0
    assert built.value <= features.count()


def test_columns_that_parquet_cannot_hold(tables):
    features, jobs = tables
    odd = features.limit(200).withColumn("nothing", F.lit(None)).withColumn("v", F.parse_json(F.lit("{}")))
    assert pairs(X.extract_jobs(odd, jobs, strategy="grid")) == pairs(X.extract_jobs(features.limit(200), jobs, strategy="broadcast", broadcast_boxes=10**6))
