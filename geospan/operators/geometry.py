"""Geometry normalisation: find the geometry column, decode it, add ``bbox``.

After these operators every feature frame has one canonical geometry column
(``geometry``), a ``bbox`` struct and an ``srid``; the source geometry column
is not kept next to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geospan.functions.bbox import make_bbox, num_text
from geospan.functions.envelope import (bad_geojson, bad_wkt, env_geojson, env_wkt,
                                        text_envelope, wkb_envelope)

# Fixed list of column names recognised as geometry when the configured one
# is absent (compared case-insensitively, first match in frame order wins).
GEOMETRY_NAMES = ("geom", "geometry", "shape", "wkb_geometry")
DEFAULT_SRID = 4326
#: Columns that are there while a text is decoded.
_READ = ("_read_box", "_read_bad")


def resolve_geometry_column(df: DataFrame, name: str | None = "geom") -> str:
    """G1: configured name if present, else the first recognised column."""
    if name and name in df.columns:
        return name
    for c in df.columns:
        if c.lower() in GEOMETRY_NAMES:
            return c
    raise ValueError(f"Geometry column '{name}' not found in data")


def decode_geometry(df: DataFrame, column: str | None = None, fmt: str = "auto",
                    mode: str = "permissive", out: str = "geometry") -> DataFrame:
    """Add ``bbox`` from the geometry column, whatever its encoding.

    Spark GEOMETRY / GEOGRAPHY columns are kept as they are; BINARY columns
    are WKB; STRING columns are GeoJSON, WKT or hex WKB, told apart per row.
    ``fmt`` can force one of ``wkb | wkt | geojson``.
    ``mode='permissive'`` keeps undecodable rows with a NULL box and
    ``_bad=true``: text of no known kind, broken JSON, WKT with unknown words or
    unmatched brackets, truncated WKB, or no coordinates in a value that isn't
    empty.  ``mode='strict'`` raises if any row is undecodable (this runs one
    counting job, like the all-or-nothing rule of the original).
    """
    column = resolve_geometry_column(df, column)
    dtype = df.schema[column].dataType
    g = F.col(column)
    if dtype.typeName() in ("geometry", "geography"):
        # Spark's own spatial type: kept as is; the box comes from its WKB.
        env = wkb_envelope(F.expr(f"st_asbinary(`{column}`)"))
        bbox = F.when(env.xmin.isNotNull(), make_bbox(env.xmin, env.ymin, env.xmax, env.ymax))
        bad = env.bad
    elif isinstance(dtype, T.BinaryType) or fmt == "wkb":
        env = wkb_envelope(g)
        bbox = F.when(env.xmin.isNotNull(), make_bbox(env.xmin, env.ymin, env.xmax, env.ymax))
        bad = env.bad
    elif fmt == "wkt":
        bbox = env_wkt(g)
        bad = bad_wkt(g, bbox)
    elif fmt == "geojson":
        bbox = env_geojson(g)
        bad = bad_geojson(g, bbox)
    else:
        # a row of its own for the long expressions: a filter on the box would repeat them for each of its comparisons
        bbox, bad = text_envelope(g)
        df = df.select("*", F.inline(F.array(F.struct(bbox.alias(_READ[0]), bad.alias(_READ[1])))))
        bbox, bad = (F.col(c) for c in _READ)
    bad = F.coalesce(bad, F.lit(False))
    res = df.withColumns({"bbox": F.when(~bad, bbox), "_bad": bad}).drop(*_READ)
    if column != out:
        res = res.withColumnRenamed(column, out) if out not in df.columns else \
            res.drop(out).withColumnRenamed(column, out)
    if mode == "strict":
        n_bad = res.where("_bad").limit(1).count()
        if n_bad:
            raise ValueError("geometry column could not be decoded")
    return res


def points_from_lonlat(df: DataFrame, lon: str = "lon", lat: str = "lat",
                       out: str = "geometry") -> DataFrame:
    """Point geometry (WKT) and box from lon/lat columns, in (lon, lat) order."""
    if lon not in df.columns or lat not in df.columns:
        raise ValueError(f"Could not find geometry column or lat/lon columns '{lon}', '{lat}'")
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    wkt = F.concat(F.lit("POINT ("), num_text(x), F.lit(" "), num_text(y), F.lit(")"))
    valid = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    return (df.withColumn(out, F.when(valid, wkt))
              .withColumn("bbox", F.when(valid, make_bbox(x, y, x, y))))


def with_srid(df: DataFrame, srid: int = DEFAULT_SRID) -> DataFrame:
    """Tag features with a CRS code if they carry none.  Never reprojects;
    ``assumed_srid`` records that the value was a default, not read."""
    if "srid" in df.columns:
        return (df.withColumn("assumed_srid", F.col("srid").isNull())
                  .withColumn("srid", F.coalesce(F.col("srid"), F.lit(srid))))
    return df.withColumn("srid", F.lit(srid)).withColumn("assumed_srid", F.lit(True))


def require_features(df: DataFrame | None) -> DataFrame:
    """Fail fast on a missing or empty feature set (runs one small job)."""
    if df is None or df.isEmpty():
        raise ValueError("No data extracted")
    return df
