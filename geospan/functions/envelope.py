"""Envelopes (2-D bounding boxes) of geometry values.

* WKT and GeoJSON envelopes are native expressions: the coordinate pairs are
  pulled out with ``regexp_extract_all`` and reduced with ``array_min`` /
  ``array_max``.  No Python; the array lambdas are evaluated outside whole-stage codegen.
* WKB envelopes need byte reinterpretation, which Spark SQL cannot do, so they
  run in an Arrow-batched ``pandas_udf`` (one vectorised call per batch).
* Text of unknown kind is first read by :mod:`geospan.functions.plain`, a batch at a time; only what isn't in its
  usual spelling is left to the expressions above, whose patterns cost several passes over a text each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geospan.functions.bbox import BBOX_FIELDS, make_bbox
from geospan.functions import plain as _plain
from geospan.functions import wkb as _wkb

# Fixed pattern of one number in WKT / GeoJSON text: accepts ``-.5``, ``1e-3``,
# ``+2`` and plain integers.  The SQL oracle (a linear-time RE2 engine) uses
# these portable forms.
NUM = r"[-+]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"
# One WKT coordinate: x and y, then up to two more ordinates (Z, M) ignored.
WKT_PAIR = rf"({NUM})\s+({NUM})(?:\s+{NUM}){{0,2}}"
# One innermost GeoJSON position array ``[x, y(, z(, m))]``.
GEOJSON_PAIR = rf"\[\s*({NUM})\s*,\s*({NUM})(?:\s*,\s*{NUM}){{0,2}}\s*\]"

# The same patterns for Spark's backtracking (java.util.regex) engine: a
# match may not start inside a number, and quantifiers are possessive, so
# long digit runs (hex WKB, big integers) are scanned in linear time.
_NUM_J = r"(?<![0-9.])[-+]?+(?:[0-9]++(?:\.[0-9]*+)?+|\.[0-9]++)(?:[eE][-+]?+[0-9]++)?+"
WKT_PAIR_J = rf"({_NUM_J})\s++({_NUM_J})(?:\s++{_NUM_J}){{0,2}}+"
GEOJSON_PAIR_J = (rf"\[\s*+({_NUM_J})\s*+,\s*+({_NUM_J})(?:\s*+,\s*+{_NUM_J}){{0,2}}+"
                  rf"\s*+\]")
# A GeoJSON ``"bbox": [...]`` member, which must never count as coordinates.
GEOJSON_BBOX_MEMBER = r'"bbox"\s*:\s*\[[^\]]*\]'

ENV_SCHEMA = T.StructType([T.StructField(n, T.DoubleType()) for n in BBOX_FIELDS]
                          + [T.StructField("bad", T.BooleanType())])


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _env_from_pairs(text: Column, pattern: str) -> Column:
    # The patterns match plain numbers only, so no NaN can come out.
    xs = F.transform(F.regexp_extract_all(text, F.lit(pattern), 1), lambda s: s.cast("double"))
    ys = F.transform(F.regexp_extract_all(text, F.lit(pattern), 2), lambda s: s.cast("double"))
    box = make_bbox(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))
    return F.when(F.size(xs) > 0, box)


def env_wkt(col) -> Column:
    """Envelope of WKT / EWKT text of any type; EMPTY or NULL -> NULL."""
    return _env_from_pairs(_c(col), WKT_PAIR_J)


def env_geojson(col) -> Column:
    """Envelope of a GeoJSON geometry object (any type, collections too).

    A ``bbox`` member is removed first so it is never read as a coordinate.
    """
    cleaned = F.regexp_replace(_c(col), GEOJSON_BBOX_MEMBER, "")
    return _env_from_pairs(cleaned, GEOJSON_PAIR_J)


def _arrays_frame(box, bad) -> pd.DataFrame:
    """Bounds arrays -> UDF result; NaN becomes NULL via nullable floats."""
    cols = {n: pd.array(box[:, i], dtype="Float64") for i, n in enumerate(BBOX_FIELDS)}
    cols["bad"] = bad
    return pd.DataFrame(cols)


@F.pandas_udf(ENV_SCHEMA)
def wkb_envelope(values: pd.Series) -> pd.DataFrame:
    """G8 kernel: ``struct<xmin,ymin,xmax,ymax,bad>`` for WKB / EWKB bytes.

    Handles both byte orders, ISO and EWKB Z/M/SRID flags and nested
    collections.  Truncated or unknown input sets ``bad`` instead of failing.
    """
    return _arrays_frame(*_wkb.wkb_bounds_arrays(values))


@F.arrow_udf(T.StructType([*ENV_SCHEMA.fields, T.StructField("plain", T.BooleanType())]))
def plain_envelope(values: pa.Array) -> pa.Array:
    """``struct<xmin,ymin,xmax,ymax,bad,plain>`` of texts in their usual spelling (``plain``) and of hex WKB."""
    return _plain.text_bounds(values)


def env_wkb(col) -> Column:
    """Envelope of WKB bytes (NULL for empty or unreadable values)."""
    env = wkb_envelope(_c(col))
    return F.when(env.xmin.isNotNull(), make_bbox(env.xmin, env.ymin, env.xmax, env.ymax))


# ---------------------------------------------------------------------------
# Text geometry classification (G3): GeoJSON -> WKT -> hex WKB, per row.
# ---------------------------------------------------------------------------

HEX_RE = r"^\s*(?:[0-9A-Fa-f]{2})+\s*$"
WKT_RE = (r"^\s*(?i:SRID=[0-9]+;)?\s*(?i:POINT|LINESTRING|POLYGON|MULTIPOINT|"
          r"MULTILINESTRING|MULTIPOLYGON|GEOMETRYCOLLECTION|TRIANGLE|TIN|"
          r"POLYHEDRALSURFACE)(?i:ZM|Z|M)?\b")
# Fixed words of WKT text, and the types of a GeoJSON geometry.
WKT_WORDS = ("SRID", "POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING",
             "MULTIPOLYGON", "GEOMETRYCOLLECTION", "TRIANGLE", "TIN", "POLYHEDRALSURFACE",
             "EMPTY", "NAN", "E")
GEOJSON_TYPES = ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString",
                 "MultiPolygon", "GeometryCollection")


def bad_wkt(col, box: Column) -> Column:
    """Text that starts like WKT but can't be read: unknown words or characters, brackets that
    don't match, or no coordinates although it isn't EMPTY."""
    c = _c(col)
    words = F.regexp_extract_all(F.upper(c), F.lit(r"[A-Z]+"), F.lit(0))
    words = F.transform(F.array_distinct(words), lambda w: F.regexp_replace(w, r"^(.{3,}?)(?:ZM|Z|M)$", "$1"))
    known = F.array(*[F.lit(w) for w in (*WKT_WORDS, "Z", "M", "ZM")])
    count = lambda ch: F.length(c) - F.length(F.replace(c, F.lit(ch)))
    empty = F.upper(c).rlike(r"\bEMPTY\b|\bNAN\b")
    return c.isNotNull() & ((F.size(F.array_except(words, known)) > 0) | c.rlike(r"[^-+0-9.,()\sA-Za-z;=]")
                            | (count("(") != count(")")) | (box.isNull() & ~empty))


def bad_geojson(col, box: Column) -> Column:
    """Text that starts like GeoJSON but can't be read: no JSON, no geometry type, or no coordinates
    although the coordinate array isn't empty."""
    c = _c(col)
    kind = F.get_json_object(c, "$.type")
    coords, members = F.get_json_object(c, "$.coordinates"), F.get_json_object(c, "$.geometries")
    empty = (F.when(kind == "GeometryCollection", F.coalesce(~members.rlike("[0-9]"), F.lit(False)))
             .otherwise(F.coalesce(coords.rlike(r"^[\[\]\s,]*$"), F.lit(False))))
    return c.isNotNull() & (F.try_parse_json(c).isNull() | ~F.coalesce(kind.isin(*GEOJSON_TYPES), F.lit(False))
                            | (box.isNull() & ~empty))


def geometry_kind(col) -> Column:
    """'geojson' | 'wkt' | 'wkb_hex' | NULL (unrecognised) for a text value."""
    c = _c(col)
    return (F.when(c.isNull(), F.lit(None))
            .when(F.ltrim(c).startswith("{"), F.lit("geojson"))
            .when(c.rlike(WKT_RE), F.lit("wkt"))
            .when(c.rlike(HEX_RE), F.lit("wkb_hex")))


def env_text(col, with_hex: bool = True) -> Column:
    """Envelope of mixed text geometry: GeoJSON, WKT, or hex WKB per row."""
    return text_envelope(col, with_hex)[0]


def text_envelope(col, with_hex: bool = True) -> tuple[Column, Column]:
    """(envelope, bad) of mixed text geometry; text of no known kind is bad."""
    c = _c(col)
    kind = geometry_kind(c)
    gj, wk = env_geojson(c), env_wkt(c)
    # plain texts are read a batch at a time; the expressions are for the others
    read = plain_envelope(c)
    found = make_bbox(read.xmin, read.ymin, read.xmax, read.ymax)
    box = F.when(read.plain, found).when(kind == "geojson", gj).when(kind == "wkt", wk)
    bad = F.when(read.plain, F.lit(False)).when(kind == "geojson", bad_geojson(c, gj)).when(kind == "wkt", bad_wkt(c, wk))
    if with_hex:
        box = box.when(kind == "wkb_hex", F.when(read.xmin.isNotNull(), found))
        bad = bad.when(kind == "wkb_hex", read.bad)
    return box, bad.otherwise(c.isNotNull())


@F.arrow_udf(T.BinaryType())
def text_to_wkb(values: pa.Array) -> pa.Array:
    """GeoJSON / WKT / hex-WKB text -> little-endian ISO WKB bytes; unreadable text -> NULL."""
    return _plain.values_to_wkb(values)
