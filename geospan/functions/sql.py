"""The pure-expression functions, offered to ``spark.sql`` users as SQL
functions (``CREATE TEMPORARY FUNCTION ... RETURN``).  They are inlined by
the analyzer like any built-in, so filters written in SQL still push down."""

from __future__ import annotations

from pyspark.sql import SparkSession

from geospan.functions.envelope import GEOJSON_BBOX_MEMBER, GEOJSON_PAIR_J, WKT_PAIR_J

BOX = "STRUCT<xmin: DOUBLE, ymin: DOUBLE, xmax: DOUBLE, ymax: DOUBLE>"


def _lit(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _env_body(text: str, pattern: str) -> str:
    """Each pair is found once, as text, and taken apart by its numbers."""
    number = r"[-+]?+(?:[0-9]++(?:\.[0-9]*+)?+|\.[0-9]++)(?:[eE][-+]?+[0-9]++)?+"
    pairs = (f"transform(regexp_extract_all({text}, {_lit(pattern)}, 0), "
             f"p -> transform(slice(regexp_extract_all(p, {_lit(number)}, 0), 1, 2), s -> CAST(s AS DOUBLE)))")
    start = ("CAST(NULL AS STRUCT<xmin: DOUBLE, ymin: DOUBLE, xmax: DOUBLE, ymax: DOUBLE>)")
    grow = ("named_struct('xmin', least(b.xmin, p[0]), 'ymin', least(b.ymin, p[1]), "
            "'xmax', greatest(b.xmax, p[0]), 'ymax', greatest(b.ymax, p[1]))")
    return f"aggregate({pairs}, {start}, (b, p) -> {grow})"


FUNCTIONS = {
    "make_bbox": (f"x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE", BOX,
                  "named_struct('xmin', x0, 'ymin', y0, 'xmax', x1, 'ymax', y1)"),
    "bbox_intersects": (f"a {BOX}, b {BOX}", "BOOLEAN",
                        "a.xmin <= b.xmax AND a.xmax >= b.xmin AND a.ymin <= b.ymax "
                        "AND a.ymax >= b.ymin"),
    "expand_bbox": (f"b {BOX}, d DOUBLE", BOX,
                    "named_struct('xmin', b.xmin - d, 'ymin', b.ymin - d, "
                    "'xmax', b.xmax + d, 'ymax', b.ymax + d)"),
    "bbox_to_list": (f"b {BOX}", "ARRAY<DOUBLE>", "array(b.xmin, b.ymin, b.xmax, b.ymax)"),
    "env_wkt": ("g STRING", BOX, _env_body("g", WKT_PAIR_J)),
    "env_geojson": ("g STRING", BOX,
                    _env_body(f"regexp_replace(g, {_lit(GEOJSON_BBOX_MEMBER)}, '')",
                              GEOJSON_PAIR_J)),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the session's temporary SQL functions; returns their names."""
    for name, (params, returns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) "
                  f"RETURNS {returns} RETURN {body}")
    return list(FUNCTIONS)
