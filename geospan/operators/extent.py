"""Extents and box algebra as aggregates.

All of them are ``min``/``max``/``count`` aggregates, so Spark plans a partial
``HashAggregate`` in every task and shuffles only one row per group per task:
a group holding a third of all rows costs no more than any other group.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geospan.functions.bbox import BBOX_FIELDS
from geospan.session import ensure_checkpoint_dir


def _clean(x: Column) -> Column:
    # Spark orders NaN above every number, so max() would return NaN: map NaN
    # to NULL, which aggregates skip.
    return F.nanvl(x, F.lit(None).cast("double"))


def _by(by) -> list:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def extent(df: DataFrame, by: str | Sequence[str] | None = None, column: str = "bbox",
           with_count: bool = True, names: Sequence[str] = BBOX_FIELDS,
           count_geometries: bool = False, more: Sequence[Column] = ()) -> DataFrame:
    """AG1/AG2/AG5: ``min(xmin), min(ymin), max(xmax), max(ymax)`` of the
    feature boxes, optionally per group.  NULL and NaN bounds are skipped;
    ``feature_count`` counts every row, including those without geometry;
    ``geometry_count`` (optional) only rows with a box; ``more`` aggregates come last.
    An input with no boxes gives NULL bounds (see :func:`require_extent`)."""
    b = F.col(column)
    aggs = [F.min(_clean(b.xmin)).alias(names[0]), F.min(_clean(b.ymin)).alias(names[1]),
            F.max(_clean(b.xmax)).alias(names[2]), F.max(_clean(b.ymax)).alias(names[3])]
    if with_count:
        aggs.append(F.count(F.lit(1)).alias("feature_count"))
    if count_geometries:
        aggs.append(F.count(b).alias("geometry_count"))
    aggs += more
    keys = _by(by)
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def require_extent(ext: DataFrame, names: Sequence[str] = BBOX_FIELDS) -> DataFrame:
    """F5 / D12 strict mode: raise if any extent row has no bounds.

    The extent is computed once: its few rows are checkpointed for the test and for what follows."""
    ensure_checkpoint_dir(ext.sparkSession)
    ext = ext.checkpoint()
    if ext.where(F.col(names[0]).isNull()).limit(1).count():
        raise ValueError("No features found or unable to calculate bounds")
    return ext


def bbox_union_agg(df: DataFrame, by=None, column: str = "bbox") -> DataFrame:
    """AG3: union of boxes (min/min/max/max); NULL bounds when no rows."""
    return extent(df, by=by, column=column, with_count=False)


def bbox_intersection_agg(df: DataFrame, by=None, column: str = "bbox") -> DataFrame:
    """AG4: intersection of boxes (max/max/min/min).

    Strict rule: when ``xmin >= xmax`` or ``ymin >= ymax`` the boxes do not
    intersect and all four bounds are NULL, so touching or zero-area boxes give
    no intersection (unlike the closed box filter)."""
    b = F.col(column)
    keys = _by(by)
    aggs = [F.max(_clean(b.xmin)).alias("_x0"), F.max(_clean(b.ymin)).alias("_y0"),
            F.min(_clean(b.xmax)).alias("_x1"), F.min(_clean(b.ymax)).alias("_y1")]
    agg = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    ok = (F.col("_x0") < F.col("_x1")) & (F.col("_y0") < F.col("_y1"))
    return agg.select(*keys, *[F.when(ok, F.col(s)).alias(n)
                               for s, n in zip(("_x0", "_y0", "_x1", "_y1"), BBOX_FIELDS)])
