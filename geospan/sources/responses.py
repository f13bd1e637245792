"""Parse recorded HTTP bodies (one row per response) into feature/record rows.

The engine never performs HTTP calls itself: requests are planned as a table
(:mod:`geospan.plans.requests`), fetched by whatever system the user runs, and
the bodies land in a ``responses`` table that these parsers explode in parallel.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Features keep ``properties`` and ``geometry`` as raw JSON text at this
# stage; Spark's JSON reader returns the original text for string fields.
FEATURES_SCHEMA = ("struct<features: array<struct<type: string, properties: string, "
                   "geometry: string>>>")


def features_array(body: Column) -> Column:
    """``features`` of a FeatureCollection body; NULL when absent/not JSON."""
    return F.from_json(body, FEATURES_SCHEMA).features


def infer_properties_schema(df: DataFrame, column: str = "properties") -> str | None:
    """DDL of the union of all property objects (one aggregate pass).

    Keys missing in some rows become NULL there; numbers that are integral in
    some rows and fractional in others widen to DECIMAL.  Callers that know the
    schema should pass it instead and skip this pass."""
    ddl = df.select(F.schema_of_variant_agg(F.try_parse_json(F.col(column))).alias("s")).first()
    if not ddl or not ddl["s"] or not ddl["s"].startswith("OBJECT<"):
        return None
    return re.sub(r"\bOBJECT<", "STRUCT<", ddl["s"])


def flatten_properties(df: DataFrame, column: str = "properties", schema: str | None = None,
                       drop: bool = True) -> DataFrame:
    """Turn a JSON-object text column into top-level columns (S2 flattening).  A property that is
    called like a column of ``df`` is kept as ``<column>_<name>``, with more underscores before it
    if that is taken too."""
    schema = schema or infer_properties_schema(df, column)
    if schema is None:
        return df.drop(column) if drop else df
    parsed = F.from_json(F.col(column), schema)
    out = df.withColumn("_props", parsed)
    fields = out.schema["_props"].dataType.fieldNames()
    keep = [c for c in df.columns if c != column or not drop]
    taken = {c.lower() for c in keep}
    names = {}
    for f in sorted(fields, key=lambda f: (f.lower() in taken, f)):
        name = f
        while name.lower() in taken:
            name = f"{column}_{name}" if name == f else f"_{name}"
        names[f] = name
        taken.add(name.lower())
    return out.select(*[F.col(f"`{c}`") for c in keep],
                      *[F.col("_props").getField(f).alias(names[f]) for f in fields])


def parse_features(responses: DataFrame, body: str = "body", keep=("*",),
                   properties_schema: str | None = None, flatten: bool = True) -> DataFrame:
    """FeatureCollection bodies -> one row per feature.

    Properties become columns (union of keys; absent key -> NULL); the
    geometry stays GeoJSON text in ``geometry``.  A body without features
    yields no rows.  ``_pos`` is the feature's index in its body.
    """
    base = responses.select(*keep, F.posexplode(features_array(F.col(body))).alias("_pos", "_f"))
    cols = [c for c in base.columns if c not in ("_f", body)]
    rows = base.select(*cols, F.col("_f.properties").alias("properties"),
                       F.col("_f.geometry").alias("geometry"))
    if not flatten:
        return rows
    return flatten_properties(rows, "properties", properties_schema)


def body_shape(body: Column) -> Column:
    """'list' | 'object' | 'raw' by the first non-blank character and JSON validity."""
    t = F.ltrim(body)
    valid = F.try_parse_json(body).isNotNull()
    return (F.when(t.startswith("[") & valid, F.lit("list"))
            .when(t.startswith("{") & valid, F.lit("object"))
            .otherwise(F.lit("raw")))


def parse_records(responses: DataFrame, body: str = "body", keep=("*",),
                  schema: str | None = None, flatten: bool = True) -> DataFrame:
    """S3: generic JSON bodies -> rows.

    A top-level list gives one row per element; an object gives one row (an
    object with ``features`` should go through :func:`parse_features`); a body
    that is not JSON is kept as one row with the text in ``_raw``.
    """
    b = F.col(body)
    shape = body_shape(b)
    elements = (F.when(shape == "list", F.from_json(b, "array<string>"))
                .when(shape == "object", F.array(b))
                .otherwise(F.array(F.lit(None).cast("string"))))
    base = responses.select(*keep, shape.alias("_shape"),
                            F.posexplode(elements).alias("_pos", "record"))
    out = base.withColumn("_raw", F.when(F.col("_shape") == "raw", b)).drop(body)
    if not flatten:
        return out
    return flatten_properties(out, "record", schema)
