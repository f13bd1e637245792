"""Extents from footers against scans, and files with the geo key."""

import json
import math
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from geospan.functions.bbox import make_bbox
from geospan.operators.extent import extent
from geospan.sinks.export import write_geoparquet
from geospan.sinks.geoparquet import FORMAT, GeoParquetSource
from geospan.sources.footers import geo_keys, stored_extent
from geospan.sources.files import read_features_parquet

BOX = "struct<xmin: double, ymin: double, xmax: double, ymax: double>"


def same(spark, path, by=None):
    got = sorted(map(tuple, stored_extent(spark, path, by=by).collect()), key=repr)
    rows = spark.read.parquet(path)
    want = sorted(map(tuple, extent(rows, by=by).select(*stored_extent(spark, path, by=by).columns).collect()), key=repr)
    assert got == want
    return got


def test_footers_equal_a_scan(spark, scratch):
    nan, inf = float("nan"), float("inf")
    rows = [(k, "a" if k % 3 else "b/c", (k * 1.5 - 40, -k, k * 1.5, 2.0 * k)) for k in range(60)] + [(100, "a", None), (101, "b/c", (nan, nan, nan, nan)), (102, "a", (nan, 1.0, 2.0, nan))]
    df = spark.createDataFrame([(i, n, None if b is None else tuple(map(float, b))) for i, n, b in rows], f"id int, layer string, bbox {BOX}")
    df.repartition(5).write.parquet(f"{scratch}/x")
    assert same(spark, f"{scratch}/x")[0][4] == 63
    df.repartition(3).write.partitionBy("layer").parquet(f"{scratch}/y")
    assert [r[0] for r in same(spark, f"{scratch}/y", "layer")] == ["a", "b/c"]
    df.where("bbox IS NULL").write.parquet(f"{scratch}/none")
    assert same(spark, f"{scratch}/none") == [(None, None, None, None, 1)]
    df.limit(0).write.parquet(f"{scratch}/empty")
    assert same(spark, f"{scratch}/empty") == [(None, None, None, None, 0)]
    df.select("id", "layer", F.when(F.col("id") == 5, make_bbox(F.lit(-inf), F.lit(0.0), F.lit(inf), F.lit(1.0))).otherwise(F.col("bbox")).alias("bbox")).write.parquet(f"{scratch}/inf")
    assert same(spark, f"{scratch}/inf")[0][0] == -inf


def test_files_without_statistics_are_scanned(spark, scratch):
    os.makedirs(f"{scratch}/z")
    box = pa.array([{"xmin": 1.0, "ymin": 2.0, "xmax": 3.0, "ymax": 4.0}, None])
    table = pa.table({"id": [1, 2], "bbox": box})
    pq.write_table(table, f"{scratch}/z/a.parquet", write_statistics=False)
    pq.write_table(table.set_column(1, "bbox", pa.array([{"xmin": -9.0, "ymin": 0.0, "xmax": 0.0, "ymax": 9.0}, None])), f"{scratch}/z/b.parquet")
    assert same(spark, f"{scratch}/z") == [(-9.0, 0.0, 3.0, 9.0, 4)]


def features(spark, n=500):
    x = F.col("id") % 90
    return (spark.range(n).select("id", F.concat(F.lit("POINT ("), x, F.lit(" "), x, F.lit(")")).alias("geometry"),
                                  make_bbox(x.cast("double"), x.cast("double"), x.cast("double"), x.cast("double")).alias("bbox")))


def test_every_file_has_its_key(spark, scratch):
    path = f"{scratch}/g"
    for n in (700, 500):  # the second write replaces the first
        write_geoparquet(features(spark, n), path, partitions=4, geo_key="footer")
    rows = geo_keys(spark, path).collect()
    assert sum(r["rows"] for r in rows) == 500 and len(rows) == 4
    boxes = []
    for r in rows:
        geo = json.loads(r["geo"])
        column = geo["columns"][geo["primary_column"]]
        assert column["geometry_types"] == ["Point"] and column["covering"]["bbox"]["xmax"] == ["bbox", "xmax"]
        md = pq.ParquetFile(r["path"].removeprefix("file:")).read().column("bbox").combine_chunks()
        assert column["bbox"] == [min(md.field("xmin").to_pylist()), min(md.field("ymin").to_pylist()), max(md.field("xmax").to_pylist()), max(md.field("ymax").to_pylist())]
        boxes.append(column["bbox"])
    assert sum(b[2] - b[0] for b in boxes) < 2 * 90  # files are clustered, each over its part
    back = read_features_parquet(spark, path)
    assert back.count() == 500 and back.select("bbox").distinct().count() == 90 and same(spark, path)[0][:4] == (0.0, 0.0, 89.0, 89.0)
    assert not [f for f in os.listdir(path) if f.startswith("_temporary")]
    write_geoparquet(features(spark, 0), f"{scratch}/none", partitions=2, geo_key="footer")
    assert spark.read.parquet(f"{scratch}/none").columns == ["id", "geometry", "bbox"]


def test_row_groups_and_failed_tasks(spark, scratch):
    from geospan.sinks.export import _as_wkb
    spark.dataSource.register(GeoParquetSource)
    df = _as_wkb(features(spark, 25_000), "geometry").coalesce(1)
    df.write.format(FORMAT).option("row_group", 4000).mode("overwrite").save(f"{scratch}/r")
    assert [r["row_groups"] for r in geo_keys(spark, f"{scratch}/r").collect()] == [math.ceil(25_000 / 4000)]
    broken = df.repartition(3).withColumn("id", F.when(F.col("id") == 17, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="no"):
        broken.write.format(FORMAT).mode("append").save(f"{scratch}/r")
    assert spark.read.parquet(f"{scratch}/r").count() == 25_000 and not [f for f in os.listdir(f"{scratch}/r") if "temporary" in f]
