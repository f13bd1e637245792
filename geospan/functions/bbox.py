"""Column expressions over the ``bbox`` struct.

A box is ``STRUCT<xmin, ymin, xmax, ymax>`` of doubles, in lon/lat order.
Every function here is a native Spark expression, so it stays inside
whole-stage codegen and works on batch and streaming frames alike.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BBOX_FIELDS = ("xmin", "ymin", "xmax", "ymax")
BBOX_DDL = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def make_bbox(xmin, ymin, xmax, ymax) -> Column:
    """Box struct from four columns or literals."""
    vals = [F.lit(v) if isinstance(v, (int, float)) else _c(v) for v in (xmin, ymin, xmax, ymax)]
    return F.struct(*[v.cast("double").alias(n) for v, n in zip(vals, BBOX_FIELDS)])


def lit_bbox(box: Sequence[float]) -> Column:
    """Literal box from ``[minx, miny, maxx, maxy]``."""
    if len(box) != 4:
        raise ValueError("a box needs four numbers: minx, miny, maxx, maxy")
    return make_bbox(*[F.lit(float(v)) for v in box])


def bbox_from_array(arr) -> Column:
    a = _c(arr)
    return make_bbox(F.get(a, 0), F.get(a, 1), F.get(a, 2), F.get(a, 3))


def bbox_intersects(a, b) -> Column:
    """Closed box intersection: touching edges and corners count (F1 rule)."""
    a, b = _c(a), _c(b)
    return ((a.xmin <= b.xmax) & (a.xmax >= b.xmin)
            & (a.ymin <= b.ymax) & (a.ymax >= b.ymin))


def bbox_within(inner, outer) -> Column:
    i, o = _c(inner), _c(outer)
    return ((i.xmin >= o.xmin) & (i.xmax <= o.xmax)
            & (i.ymin >= o.ymin) & (i.ymax <= o.ymax))


def bbox_to_list(b) -> Column:
    """SC1: ``[minx, miny, maxx, maxy]``."""
    b = _c(b)
    return F.array(b.xmin, b.ymin, b.xmax, b.ymax)


def num_text(x) -> Column:
    """Shortest decimal text of a double, without a trailing ``.0``.

    Matches the coordinate style of common WKT writers (``-180`` not
    ``-180.0``) for ordinary magnitudes.
    """
    return F.regexp_replace(_c(x).cast("string"), r"\.0$", "")


def bbox_to_wkt(b) -> Column:
    """SC2: the box as a counter-clockwise polygon starting at (maxx, miny)."""
    b = _c(b)
    x0, y0, x1, y1 = (num_text(b[f]) for f in BBOX_FIELDS)

    def pt(x, y):
        return F.concat(x, F.lit(" "), y)

    ring = F.concat_ws(", ", pt(x1, y0), pt(x1, y1), pt(x0, y1), pt(x0, y0), pt(x1, y0))
    return F.when(b.isNull(), F.lit(None)).otherwise(
        F.concat(F.lit("POLYGON (("), ring, F.lit("))")))


def expand_bbox(b, degrees) -> Column:
    """SC3: grow (or, with a negative value, shrink) a box on all four sides."""
    b = _c(b)
    d = F.lit(float(degrees)) if isinstance(degrees, (int, float)) else _c(degrees)
    return make_bbox(b.xmin - d, b.ymin - d, b.xmax + d, b.ymax + d)


def bbox_inverted(b) -> Column:
    """True when a box has min > max on either axis (e.g. over-shrunk)."""
    b = _c(b)
    return (b.xmin > b.xmax) | (b.ymin > b.ymax)


def bbox_to_json(b) -> Column:
    """SC4: ``{"min_lon", "min_lat", "max_lon", "max_lat", "bbox_array"}``."""
    b = _c(b)
    return F.to_json(F.struct(
        b.xmin.alias("min_lon"), b.ymin.alias("min_lat"),
        b.xmax.alias("max_lon"), b.ymax.alias("max_lat"),
        bbox_to_list(b).alias("bbox_array")))


def bbox_to_text(b) -> Column:
    """SC5: human-readable block, one line per bound plus the array form."""
    b = _c(b)
    xs = [b[f].cast("string") for f in BBOX_FIELDS]
    # Fixed text of the block.
    return F.concat(
        F.lit("Bounding Box:\n  Min Longitude: "), xs[0],
        F.lit("\n  Min Latitude:  "), xs[1],
        F.lit("\n  Max Longitude: "), xs[2],
        F.lit("\n  Max Latitude:  "), xs[3],
        F.lit("\n  Array format:  ["), F.concat_ws(", ", *xs), F.lit("]"))


def bbox_to_csv(b, suffix: str | None = None) -> Column:
    """SC6: ``"minx,miny,maxx,maxy"`` (optionally with a trailing CRS item)."""
    b = _c(b)
    parts = [b[f].cast("string") for f in BBOX_FIELDS]
    if suffix:
        parts.append(F.lit(suffix))
    return F.concat_ws(",", *parts)


def bbox_cols(b, names: Iterable[str] = BBOX_FIELDS) -> list[Column]:
    """Flatten a box into four named columns."""
    b = _c(b)
    return [b[f].alias(n) for f, n in zip(BBOX_FIELDS, names)]


def _spread_bits(v: Column) -> Column:
    """Insert a zero bit between the low 16 bits of ``v`` (Morton helper)."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def zorder_key(b) -> Column:
    """Z-order (Morton) code of a box's lower-left corner on a 2^16 x 2^16
    grid over lon/lat.  Sorting by it keeps nearby boxes together in both axes,
    so per-file / per-row-group min-max statistics of ``bbox.*`` stay tight."""
    b = _c(b)
    top = (1 << 16) - 1
    gx = F.least(F.greatest(F.floor((b.xmin + 180.0) / 360.0 * top), F.lit(0)), F.lit(top))
    gy = F.least(F.greatest(F.floor((b.ymin + 90.0) / 180.0 * top), F.lit(0)), F.lit(top))
    return _spread_bits(gx.cast("long")).bitwiseOR(F.shiftleft(_spread_bits(gy.cast("long")), 1))
