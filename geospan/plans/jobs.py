"""Jobs as a table: read job files, resolve catalogue names, route sources,
merge metadata and name outputs (S8, S10-S13, M1-M3, SC7, SC8).

The original runs one job per process; here every step is a projection or a
small-side join over a jobs DataFrame, so thousands of jobs are prepared in
one plan.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geospan.functions.bbox import bbox_to_list, make_bbox

# --- fixed catalogue values (the built-in named source and location) ---------
BUILTIN_SOURCES = [
    # name, title, url, layer_name, geometry_column, description
    ("fws_wetlands_fl", "FWS Florida Wetlands",
     "zip://https://documentst.ecosphere.fws.gov/wetlands/data/State-Downloads/"
     "FL_geodatabase_wetlands.zip!FL_geodatabase_wetlands.gdb",
     None, "geom", "US Fish and Wildlife Service wetlands data for Florida"),
]
BUILTIN_LOCATIONS = [
    ("disney_animal_kingdom", -81.61303476507055, 28.34441345722594,
     -81.56830935354668, 28.3768179430727),
]
DEFAULT_JOB_NAME = "extraction"
DEFAULT_PREFIX = "extracted_data"
DEFAULT_FORMATS = ["geojson", "parquet"]
DEFAULT_GEOMETRY_COLUMN = "geom"
# Fixed URL routing rules.
REMOTE_SCHEMES = ("s3", "gcs", "azure", "ftp", "ssh", "hdfs")
HADOOP_SCHEMES = {"s3": "s3a", "gcs": "gs", "azure": "abfss"}
# Fixed output extensions; other formats use ``.{format}``.
FORMAT_EXTENSIONS = {"geojson": ".geojson", "filegdb": ".gdb", "shapefile": ".shp"}
SUPPORTED_FORMATS = ("geojson", "csv", "parquet")
KNOWN_FORMATS = ("geojson", "shapefile", "gpkg", "filegdb", "csv", "parquet")

SOURCE_DDL = ("struct<name:string,url:string,layer_name:string,geometry_column:string,"
              "description:string>")


def builtin_sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        BUILTIN_SOURCES, "source_key string, name string, url string, layer_name string, "
                         "geometry_column string, description string")


def builtin_locations(spark: SparkSession) -> DataFrame:
    rows = [(n, x0, y0, x1, y1) for n, x0, y0, x1, y1 in BUILTIN_LOCATIONS]
    df = spark.createDataFrame(rows, "location string, x0 double, y0 double, x1 double, y1 double")
    return df.select("location", make_bbox("x0", "y0", "x1", "y1").alias("location_bbox"))


# --- S12: job files -------------------------------------------------------------

def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Job JSON files (one object per file) -> one row per job.

    ``bounding_box`` may be a 4-number list or a ``{min_lon,..}`` object;
    ``data_source`` a catalogue name or an inline object.  Defaults: job name
    ``extraction``, prefix ``extracted_data``, formats ``[geojson, parquet]``,
    empty metadata.  Files are read in parallel (one row per file)."""
    raw = spark.read.text(path, wholetext=True).select(
        F.col("value").alias("text"), F.input_file_name().alias("job_file"))
    return parse_job_text(raw, "text")


def parse_job_text(df: DataFrame, text: str = "text") -> DataFrame:
    top = F.from_json(F.col(text), "struct<job_name:string, data_source:string, "
                      "bounding_box:string, output_formats:array<string>, "
                      "output_prefix:string, metadata:map<string,string>, location:string>")
    d = df.withColumn("_j", top)
    box_txt = F.ltrim(F.col("_j.bounding_box"))
    as_list = F.from_json(box_txt, "array<double>")
    as_obj = F.from_json(box_txt, "struct<min_lon:double,min_lat:double,max_lon:double,"
                                  "max_lat:double>")
    bbox = (F.when(box_txt.startswith("[") & (F.size(as_list) == 4),
                   make_bbox(F.get(as_list, 0), F.get(as_list, 1), F.get(as_list, 2),
                             F.get(as_list, 3)))
            .when(box_txt.startswith("{"), make_bbox(as_obj.min_lon, as_obj.min_lat,
                                                      as_obj.max_lon, as_obj.max_lat)))
    src_txt = F.ltrim(F.col("_j.data_source"))
    inline = F.from_json(src_txt, SOURCE_DDL)
    return d.select(
        *[c for c in df.columns if c != text],
        F.coalesce(F.col("_j.job_name"), F.lit(DEFAULT_JOB_NAME)).alias("job_name"),
        F.when(~src_txt.startswith("{"), F.col("_j.data_source")).alias("source_key"),
        F.when(src_txt.startswith("{"), inline).alias("inline_source"),
        F.col("_j.location").alias("location"),
        bbox.alias("bbox"),
        F.coalesce(F.col("_j.output_formats"),
                   F.array(*[F.lit(f) for f in DEFAULT_FORMATS])).alias("output_formats"),
        F.coalesce(F.col("_j.output_prefix"), F.lit(DEFAULT_PREFIX)).alias("output_prefix"),
        F.coalesce(F.col("_j.metadata"), F.create_map().cast("map<string,string>"))
        .alias("metadata"))


# --- S13: catalogue lookup ------------------------------------------------------

def _small(df: DataFrame, most_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast hint only where the measured text of all rows is small (a row counts 100 bytes at least)."""
    size = df.select(F.sum(F.length(F.to_json(F.struct(*df.columns))) + 100)).first()[0] or 0
    return F.broadcast(df) if size <= most_bytes else df


def resolve_jobs(jobs: DataFrame, sources: DataFrame, locations: DataFrame,
                 unknown_source_as_url: bool = False) -> DataFrame:
    """Attach source fields and the effective box to every job.

    * ``source_key`` found in the catalogue -> its fields; an inline source
      struct -> its fields; an unknown key -> ``status='unknown_source'``, or,
      with ``unknown_source_as_url`` (command-line style), used as the URL of
      a custom source.
    * A named ``location`` found in the catalogue wins over an explicit box;
      neither -> ``status='no_bbox'``.
    """
    j = jobs.join(_small(sources.withColumnRenamed("name", "_src_title")), "source_key", "left")
    j = j.join(_small(locations), "location", "left")
    inline = F.col("inline_source") if "inline_source" in jobs.columns else F.lit(None).cast(
        SOURCE_DDL)
    known = F.col("_src_title").isNotNull()
    key = F.col("source_key")
    as_url = F.lit(bool(unknown_source_as_url)) & key.isNotNull() & ~known
    url = F.coalesce(F.when(known, F.col("url")), inline["url"], F.when(as_url, key))
    name = F.coalesce(F.when(known, F.col("_src_title")), inline["name"],
                      F.when(as_url, F.lit("custom")))
    geom = F.coalesce(F.when(known, F.col("geometry_column")), inline["geometry_column"],
                      F.lit(DEFAULT_GEOMETRY_COLUMN))
    layer = F.coalesce(F.when(known, F.col("layer_name")), inline["layer_name"])
    bbox = F.coalesce(F.col("location_bbox"), F.col("bbox"))
    status = (F.when(url.isNull(), F.lit("unknown_source"))
              .when(bbox.isNull(), F.lit("no_bbox")).otherwise(F.lit("ok")))
    drop = [c for c in ("_src_title", "url", "layer_name", "geometry_column", "description",
                        "location_bbox", "bbox") if c in j.columns]
    return j.select(*[c for c in j.columns if c not in drop],
                    name.alias("source_name"), url.alias("url"), layer.alias("layer_name"),
                    geom.alias("geometry_column"), bbox.alias("bbox"), status.alias("status"))


# --- SC8 / S10 / S11 / S8: URLs -------------------------------------------------

SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*)://"
HOST_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#!]*)"
PATH_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#!]*([^?#]*)"
SUFFIX_RE = r"(\.[A-Za-z0-9]+)$"


def url_parts(url) -> list[Column]:
    """SC8: scheme, host, path and lower-case suffix of a URL (or a bare path)."""
    u = F.col(url) if isinstance(url, str) else url
    scheme = F.lower(F.regexp_extract(u, SCHEME_RE, 1))
    path = F.when(scheme == "", u).otherwise(F.regexp_extract(u, PATH_RE, 1))
    return [scheme.alias("scheme"), F.regexp_extract(u, HOST_RE, 1).alias("host"),
            path.alias("path"), F.lower(F.regexp_extract(path, SUFFIX_RE, 1)).alias("suffix")]


def route(url, api_type=None) -> Column:
    """S10: 'api' | 'remote' | 'file'.  An explicit API type wins; otherwise
    http(s) URLs containing 'api' go to the API reader (the original rule)."""
    u = F.col(url) if isinstance(url, str) else url
    scheme = F.lower(F.regexp_extract(u, SCHEME_RE, 1))
    explicit = (F.col(api_type).isNotNull() & (F.col(api_type) != "")) if api_type else F.lit(False)
    return (F.when(explicit, F.lit("api"))
            .when(scheme.isin("http", "https") & F.lower(u).contains("api"), F.lit("api"))
            .when(scheme.isin(*REMOTE_SCHEMES), F.lit("remote"))
            .otherwise(F.lit("file")))


def file_kind(url) -> Column:
    """Reader chosen by suffix; unknown suffixes fall back to CSV."""
    u = F.col(url) if isinstance(url, str) else url
    suffix = F.lower(F.regexp_extract(F.regexp_replace(u, r"[?#].*$", ""), SUFFIX_RE, 1))
    return (F.when(suffix.isin(".geojson", ".json"), F.lit("json"))
            .when(suffix == ".parquet", F.lit("parquet"))
            .when(suffix == ".csv", F.lit("csv"))
            .when(suffix.isin(".shp", ".gpkg", ".gdb"), F.lit("unsupported"))
            .otherwise(F.lit("csv")))


def route_sources(jobs: DataFrame, url: str = "url", api_type: str | None = None) -> DataFrame:
    return jobs.select("*", *url_parts(url), route(url, api_type).alias("route"),
                       file_kind(url).alias("file_kind"))


def hadoop_path(url: str) -> str:
    """Fsspec-style URL -> Hadoop filesystem path (bucket/host kept)."""
    scheme, sep, rest = url.partition("://")
    if not sep:
        return url
    return f"{HADOOP_SCHEMES.get(scheme.lower(), scheme.lower())}://{rest}"


def remote_path(url) -> Column:
    """S8 over a column of URLs: the Hadoop path of each, bucket and key kept."""
    u = F.col(url) if isinstance(url, str) else url
    scheme = F.lower(F.regexp_extract(u, SCHEME_RE, 1))
    mapped = scheme
    for k, v in HADOOP_SCHEMES.items():
        mapped = F.when(scheme == k, F.lit(v)).otherwise(mapped)
    return F.when(scheme == "", u).otherwise(F.concat(mapped, F.lit("://"), F.regexp_replace(u, SCHEME_RE, "")))


def option_prefix(url) -> Column:
    """What the Hadoop options of a URL's store begin with; those of S3 are its bucket's own."""
    u = F.col(url) if isinstance(url, str) else url
    path = remote_path(u)
    store = F.regexp_extract(path, SCHEME_RE, 1)
    bucket = F.when((store == "s3a") & (F.regexp_extract(path, HOST_RE, 1) != ""), F.concat(F.lit("bucket."), F.regexp_extract(path, HOST_RE, 1), F.lit(".")))
    return F.when(store != "", F.concat(F.lit("fs."), store, F.lit("."), F.coalesce(bucket, F.lit(""))))


def hadoop_options(url: str, storage_options: Mapping[str, str] | None) -> dict:
    """Storage options -> Hadoop filesystem options for one read.

    S3 credentials are scoped to the URL's bucket (``fs.s3a.bucket.<b>.*``),
    so jobs reading different buckets with different keys do not interfere.
    The result is passed as reader options, never stored in rows or logs."""
    opts = dict(storage_options or {})
    scheme, _, rest = url.partition("://")
    scheme = scheme.lower()
    fs = HADOOP_SCHEMES.get(scheme, scheme)
    out = {}
    if scheme == "s3":
        bucket = rest.split("/", 1)[0]
        prefix = f"fs.s3a.bucket.{bucket}." if bucket else "fs.s3a."
        for src, dst in (("key", "access.key"), ("secret", "secret.key"),
                         ("token", "session.token"), ("endpoint_url", "endpoint")):
            if src in opts:
                out[prefix + dst] = str(opts.pop(src))
    out.update({f"fs.{fs}.{k}": str(v) for k, v in opts.items()})
    return out


# --- M1-M3: metadata ----------------------------------------------------------

def merge_maps(a: Column, b: Column) -> Column:
    """M1: ``a`` updated by ``b`` (later keys win); ``map_concat`` would fail
    on duplicate keys."""
    empty = F.create_map().cast("map<string,string>")
    return F.map_zip_with(F.coalesce(a, empty), F.coalesce(b, empty),
                          lambda k, x, y: F.coalesce(y, x))


def parse_metadata(text) -> Column:
    """M2: JSON object text -> MAP<STRING,STRING>; invalid -> empty map.
    Non-string values keep their JSON text."""
    t = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.from_json(t, "map<string,string>"),
                      F.create_map().cast("map<string,string>"))


def default_metadata(extraction_date: Column, source_name: Column, bbox: Column) -> Column:
    """M3: ``extraction_date``, ``source`` and the box list (JSON text)."""
    return F.create_map(F.lit("extraction_date"), extraction_date,
                        F.lit("source"), source_name,
                        F.lit("bbox"), F.to_json(bbox_to_list(bbox)))


def map_text(m) -> Column:
    """Stable text of a map: ``k=v`` pairs sorted by key, joined by ``;``."""
    c = F.col(m) if isinstance(m, str) else m
    return F.array_join(F.array_sort(F.transform(
        F.map_entries(c), lambda e: F.concat(e.key, F.lit("="), F.coalesce(e.value, F.lit(""))))),
        ";")


# --- SC7: output names ----------------------------------------------------------

def output_filename(prefix: Column, job_name: Column, fmt: Column, ts: Column) -> Column:
    """``{prefix}_{job}_{yyyyMMdd_HHmmss}`` plus the format's extension."""
    f = F.lower(fmt)
    ext = F.concat(F.lit("."), f)
    for k, v in FORMAT_EXTENSIONS.items():
        ext = F.when(f == k, F.lit(v)).otherwise(ext)
    return F.concat(F.concat_ws("_", prefix, job_name, F.date_format(ts, "yyyyMMdd_HHmmss")), ext)


def format_status(fmt: Column) -> Column:
    f = F.lower(fmt)
    return (F.when(f.isin(*SUPPORTED_FORMATS), F.lit("supported"))
            .when(f.isin(*KNOWN_FORMATS), F.lit("unsupported")).otherwise(F.lit("unknown")))

