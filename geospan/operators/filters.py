"""Filters: box, exact intersects, attribute dict, SQL predicate; projections.

The box filter compares the four ``bbox`` struct fields with literals, which
Catalyst pushes into the Parquet reader (nested-field ``PushedFilters``), so
row groups whose min/max statistics miss the box are never decoded.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geospan.functions.bbox import bbox_within, lit_bbox
from geospan.functions.columnar import intersects_boxes

GEOMETRY_COLUMNS = ("geometry", "bbox", "srid", "assumed_srid", "_bad")


def bbox_filter(df: DataFrame, box: Sequence[float], column: str = "bbox",
                exact: bool = False, geometry: str = "geometry") -> DataFrame:
    """F1 (and F2 with ``exact=True``): keep features whose envelope meets the
    closed box.  Rows with a NULL box (null or EMPTY geometry) are dropped.

    With ``exact``, rows whose envelope lies inside the box are accepted
    without further work; only the rest go through the geometry test.
    """
    x0, y0, x1, y1 = (float(v) for v in box)
    b = F.col(column)
    cond = ((b.xmin <= x1) & (b.xmax >= x0) & (b.ymin <= y1) & (b.ymax >= y0))
    out = df.where(cond)
    if not exact:
        return out
    inside = bbox_within(b, lit_bbox(box))
    # Rows already inside the box send NULL to the geometry kernel: only the
    # rows whose envelope crosses the box edge ship their geometry to Python.
    test = geometry_intersects_box(F.when(~inside, F.col(geometry)),
                                   F.lit(x0), F.lit(y0), F.lit(x1), F.lit(y1))
    return out.where(inside | F.coalesce(test, F.lit(False)))


def attr_filter(df: DataFrame, conditions: Mapping[str, object] | None) -> DataFrame:
    """AND of ``column == value``.  Keys that are not columns are ignored;
    a NULL value matches nothing; a value whose Python type does not fit the
    column type matches nothing (no implicit string/number casts)."""
    if not conditions:
        return df
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    preds = []
    for key, value in conditions.items():
        if key not in types:
            continue
        preds.append(_typed_equals(F.col(key), types[key], value))
    if not preds:
        return df
    return df.where(reduce(lambda a, b: a & b, preds))


def _typed_equals(col: Column, dtype: T.DataType, value) -> Column:
    if value is None:
        return F.lit(False)
    if isinstance(value, bool):
        ok = isinstance(dtype, T.BooleanType)
    elif isinstance(value, (int, float)):
        ok = isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                                T.FloatType, T.DoubleType, T.DecimalType))
    elif isinstance(value, str):
        ok = isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))
    else:
        ok = False
    return (col == F.lit(value)) if ok else F.lit(False)


def where_filter(df: DataFrame, predicate: str | None) -> DataFrame:
    """free SQL predicate text (the one SQL-text input of the engine)."""
    return df.where(F.expr(predicate)) if predicate else df


def drop_geometry(df: DataFrame) -> DataFrame:
    """attributes only (the CSV projection)."""
    return df.drop(*[c for c in GEOMETRY_COLUMNS if c in df.columns])


def count_features(df: DataFrame) -> DataFrame:
    """F8: one-row feature count."""
    return df.agg(F.count(F.lit(1)).alias("feature_count"))


# ---------------------------------------------------------------------------
# exact "geometry intersects rectangle" on WKT / GeoJSON / WKB.
# ---------------------------------------------------------------------------

@F.arrow_udf(T.BooleanType())
def _intersects_box_udf(g: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    box = (b.to_numpy(zero_copy_only=False) for b in (x0, y0, x1, y1))
    return intersects_boxes(g, *box)


def geometry_intersects_box(geometry: Column, x0, y0, x1, y1) -> Column:
    """Exact intersects test of a geometry (WKT / GeoJSON / hex WKB text or WKB bytes)
    with a box, an Arrow batch at a time (:mod:`geospan.functions.columnar`); a NULL or
    unreadable geometry gives NULL."""
    return _intersects_box_udf(geometry, x0, y0, x1, y1)
