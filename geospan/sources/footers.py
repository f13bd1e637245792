"""What the footers of Parquet files say: extents without reading rows (AG1, AG5), and ``geo`` keys (K2)."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geospan.functions.bbox import BBOX_FIELDS
from geospan.operators.extent import extent
from geospan.stores import file_system


def _files(spark: SparkSession, path) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
            .select("path", "length").where("length > 0"))


def _spread(files: DataFrame) -> DataFrame:
    """Many small rows over all tasks: a footer is a round trip to the store each."""
    return files.repartition(files.sparkSession.sparkContext.defaultParallelism * 4, "path")


def _bounds(column: str):
    import pyarrow.parquet as pq

    def read(batches):
        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                store, inner = file_system(path)
                with store.open_input_file(inner) as f:
                    md = pq.ParquetFile(f).metadata
                place = {md.schema.column(i).path: i for i in range(md.num_columns)}
                ids = [place.get(f"{column}.{b}") for b in BBOX_FIELDS]
                box, whole = [np.inf, np.inf, -np.inf, -np.inf], None not in ids
                for g in range(md.num_row_groups) if whole else ():
                    group = md.row_group(g)
                    for k, i in enumerate(ids):
                        s = group.column(i).statistics
                        if s is not None and s.has_min_max and np.isfinite(s.min if k < 2 else s.max):
                            box[k] = min(box[k], s.min) if k < 2 else max(box[k], s.max)
                        elif s is None or not s.has_null_count or s.null_count < group.column(i).num_values:
                            whole = False  # values without statistics
                box = [float(b) + 0.0 if np.isfinite(b) else None for b in box] if whole else [None] * 4
                rows.append((path, md.num_rows, whole, *box))
            yield pd.DataFrame(rows, columns=["path", "n", "whole", *BBOX_FIELDS])
    return read


def _decoded(text: Column) -> Column:
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _partition_value(path: Column, by: str) -> Column:
    """The value of a partition column in a path, as Spark writes it there."""
    raw = F.regexp_extract(path, rf"/{by}=([^/]*)/", 1)
    return F.when(raw != "__HIVE_DEFAULT_PARTITION__", _decoded(raw))


def stored_extent(spark: SparkSession, path, column: str = "bbox", by: str | None = None) -> DataFrame:
    """AG1 / AG5 over Parquet files with a box column: xmin, ymin, xmax, ymax, feature_count, as ``extent`` gives them,
    from the statistics in the files' footers.

    A footer per file is read, by many tasks; files whose statistics don't say (none written, an infinite bound, no such
    column in the file's statistics) are scanned, and only those.  NaN and NULL bounds count for nothing, in
    footers as in rows.  ``by``: a partition column of the folder (``by=value`` in the paths), a row per value."""
    found = _spread(_files(spark, path)).mapInPandas(_bounds(column), "path string, n long, whole boolean, " + ", ".join(f"{b} double" for b in BBOX_FIELDS)).checkpoint()
    value = _partition_value(F.col("path"), by) if by else None
    parts = found.where("whole").select(*([value.alias(by)] if by else []), *BBOX_FIELDS, F.col("n").alias("feature_count"))
    rest = [r["path"] for r in found.where("NOT whole").select("path").collect()]  # like the listing of a read
    if rest:
        rows = spark.read.parquet(*rest)
        # a row's own path is written as a URI
        rows = rows.withColumn(by, _partition_value(_decoded(F.col("_metadata.file_path")), by)) if by else rows
        scanned = extent(rows, column=column, by=by)
        parts = parts.unionByName(scanned.select(*parts.columns))
    parts = parts.groupBy(*([by] if by else [])).agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"),
                                                     F.max("ymax").alias("ymax"), F.coalesce(F.sum("feature_count"), F.lit(0)).alias("feature_count"))
    return parts


def geo_keys(spark: SparkSession, path) -> DataFrame:
    """(path, rows, row_groups, geo) of every Parquet file: the ``geo`` key of its footer as JSON text, or null."""
    import pyarrow.parquet as pq

    def read(batches):
        for pdf in batches:
            out = []
            for p in pdf["path"]:
                store, inner = file_system(p)
                with store.open_input_file(inner) as f:
                    md = pq.ParquetFile(f).metadata
                geo = (md.metadata or {}).get(b"geo")
                out.append((p, md.num_rows, md.num_row_groups, json.dumps(json.loads(geo)) if geo else None))
            yield pd.DataFrame(out, columns=["path", "rows", "row_groups", "geo"])
    return _spread(_files(spark, path)).mapInPandas(read, "path string, rows long, row_groups int, geo string")
