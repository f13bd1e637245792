"""File scans that produce feature frames (S1, S4-S7, S9, S10 dispatch).

Each reader returns a DataFrame with the attributes, one text/binary geometry
column and, after :func:`geospan.operators.geometry.decode_geometry`, a
``bbox`` struct.  GeoJSON splits across tasks in any layout: by lines where every
feature has its own, else by byte ranges.  Zip archives are listed per file and
their members are then read by many tasks.
"""

from __future__ import annotations

import csv
import fnmatch
import zipfile
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geospan.functions.bbox import BBOX_FIELDS
from geospan.operators.geometry import (decode_geometry, points_from_lonlat,
                                        resolve_geometry_column)
from geospan.plans.jobs import file_kind, hadoop_options, hadoop_path
from geospan.session import ensure_checkpoint_dir
from geospan.sources.ranges import cut_whole, fragments, scan_features, scan_whole
from geospan.sources.responses import flatten_properties
from geospan.stores import file_system


#: Column pairs that give points when a table has no geometry column, the first match counts.
LONLAT = (("lon", "lat"), ("longitude", "latitude"), ("lng", "lat"))


def read_geojson(spark: SparkSession, path, properties_schema: str | None = None,
                 options: dict | None = None) -> DataFrame:
    """S1 for any layout, in byte ranges of each file (see :mod:`geospan.sources.ranges`): one row
    per feature, geometry as GeoJSON text, properties as columns.

    Takes the members of ``features`` lists and top-level Features; a member whose text is no JSON raises."""
    return flatten_properties(_scanned_features(spark, path, options), "properties", properties_schema)


def _scanned_features(spark: SparkSession, path, options: dict | None = None) -> DataFrame:
    """(properties, geometry) of every feature."""
    return _features_of(scan_features(spark, path, options))


def _features_of(scanned: DataFrame) -> DataFrame:
    feature = F.col("feature")
    # a member without a type may still be a feature with properties; one that can't be read is an error
    readable = feature.type.isNotNull() | F.try_parse_json("text").isNotNull() | F.raise_error(
        F.concat(F.lit("a member of features that is no JSON in "), "file")).cast("boolean").isNull()
    return (scanned.where(((F.col("kind") == "element") & readable) | (feature.type == "Feature"))
            .select(feature.properties.alias("properties"), feature.geometry.alias("geometry")))


def read_geojson_lines(spark: SparkSession, path: str, properties_schema: str | None = None
                       ) -> DataFrame:
    """S1 for line-oriented GeoJSON, read in parallel splits of each file.

    Accepts newline-delimited Features (GeoJSONSeq / NDJSON) and the layout
    most writers use for FeatureCollections: a header line, one Feature per
    line followed by a comma, and a closing line.  Lines that are not a
    Feature (header, footer, blank) are skipped, so a multi-gigabyte
    collection is parsed by many tasks instead of one."""
    return flatten_properties(_line_features(spark.read.text(path)), "properties", properties_schema)


def _line_features(lines: DataFrame) -> DataFrame:
    """(properties, geometry) of the lines that hold a Feature."""
    # Drop an RFC 8142 record separator, surrounding blanks and a trailing comma.
    text = F.regexp_replace(F.trim(F.regexp_replace(F.col("value"), "^\x1e", "")), r",$", "")
    feat = F.from_json(text, "struct<type:string, properties:string, geometry:string>")
    return (lines.where(text.startswith("{"))
            .select(feat.alias("_f"))
            .where(F.col("_f.type") == "Feature")
            .select(F.col("_f.properties").alias("properties"),
                    F.col("_f.geometry").alias("geometry")))


def geojson_files(spark: SparkSession, path: str, options: dict | None = None) -> DataFrame:
    """(file, features, other, collection) per file: its lines that hold one whole Feature, its
    other lines that mention a Feature, and whether it has a ``features`` list.  One pass with
    partial counts over all lines."""
    lines = spark.read.options(**(options or {})).text(path)
    text = F.regexp_replace(F.trim(F.regexp_replace(F.col("value"), "^\x1e", "")), r",$", "")
    whole = F.coalesce((F.from_json(text, "struct<type:string>").type == "Feature") & text.startswith("{")
                       & F.try_parse_json(text).isNotNull(), F.lit(False))
    return lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count_if(whole).alias("features"),
        F.count_if(~whole & F.col("value").rlike('"Feature"')).alias("other"),
        (F.count_if(F.col("value").contains('"features"')) > 0).alias("collection"))


def geojson_layouts(spark: SparkSession, path: str, options: dict | None = None) -> DataFrame:
    """(file, collection, mentions, packed) per file, from the fragments between two ``}``, which are short
    whatever the layout: has it a list of features, does it mention a Feature, and does another object
    follow one on the same line.  One pass with partial counts."""
    value = F.col("value")  # a pattern is tried only where its fixed part is there
    return fragments(spark, path, options).groupBy("file").agg(
        (F.count_if(value.contains('"features"') & value.rlike(r'"features"\s*:\s*(\[|$)')) > 0).alias("collection"),
        (F.count_if(value.contains('"Feature"')) > 0).alias("mentions"),
        (F.count_if(F.ltrim(value, F.lit(" \t")).startswith(",") & value.rlike(r"^[ \t]*,[ \t]*\{")) > 0).alias("packed"))


def read_geojson_any(spark: SparkSession, path: str, options: dict | None = None,
                     properties_schema: str | None = None) -> DataFrame | None:
    """S1 for any layout, file by file; None if no file has features or a ``features`` list.

    A file whose features all stand on lines of their own is read line by line, in parallel splits; a
    collection with a feature laid out otherwise (packed, indented, on the header line) goes through
    the scanner of byte ranges.  Lines that mention a Feature but are none, outside a collection,
    raise, and so does a folder that mixes feature files with plain JSON records: no feature is
    left out silently.
    """
    found = geojson_layouts(spark, path, options).collect()  # a row per file, like Spark's own listing
    plain = [r["file"] for r in found if not (r["mentions"] or r["collection"])]
    scan = [r["file"] for r in found if r["collection"] and r["packed"]]
    by_line = [r["file"] for r in found if (r["mentions"] or r["collection"]) and not (r["collection"] and r["packed"])]
    split = []
    if by_line:
        lines = geojson_files(spark, by_line, options).collect()
        bad = [r["file"] for r in lines if r["other"] and not r["collection"]]
        if bad:
            raise ValueError(f"lines that are no whole GeoJSON Feature in {bad[:5]}")
        scan += [r["file"] for r in lines if r["other"]]
        split = [r["file"] for r in lines if not r["other"] and (r["features"] or r["collection"])]
        plain += [r["file"] for r in lines if not (r["other"] or r["features"] or r["collection"])]
    if len(plain) == len(found):
        return None
    if plain:
        raise ValueError(f"no GeoJSON features in {plain[:5]}, but in other files of {path}")
    parts = []
    if scan:
        parts.append(_scanned_features(spark, scan, options))
    if split:
        parts.append(_line_features(spark.read.options(**(options or {})).text(split)))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return flatten_properties(rows, "properties", properties_schema)


def read_json_records(spark: SparkSession, path: str, options: dict | None = None
                      ) -> DataFrame:
    """JSON without ``features``: a list of records -> row per record; an
    object of equal-length column arrays -> one row per position."""
    df = spark.read.options(**(options or {})).option("multiLine", True).json(path)
    fields = df.schema.fields
    # Only an object of columns is taken apart: a list of records may have array cells too.  A file
    # is an object if its first character says so; a folder that mixes both is ambiguous.
    head = fragments(spark, path, options).where(F.col("range") == 0).withColumn("place", F.monotonically_increasing_id())
    char = F.regexp_extract("value", r"^\s*(\S)", 1)
    first = (head.select("file", "place", char.alias("c")).where("c <> ''").groupBy("file")
             .agg(F.min_by("c", "place").alias("c")).select("c").distinct().collect())
    objects = {r["c"] for r in first} == {"{"}
    if objects and fields and all(f.dataType.typeName() == "array" for f in fields if not
                                  f.name.startswith("_corrupt")):
        names = [f.name for f in fields]
        z = df.select(F.explode(F.arrays_zip(*names)).alias("_z"))
        return z.select(*[F.col("_z")[n].alias(n) for n in names])
    return df


def read_features_parquet(spark: SparkSession, path: str, geometry: str | None = None
                          ) -> DataFrame:
    """Parquet / GeoParquet.  A stored ``bbox`` struct is used as is (its
    fields carry row-group statistics for pushdown); otherwise it is derived, and a
    column ``bbox`` of another type is kept as ``properties_bbox``."""
    return _with_box(spark.read.parquet(path), geometry)


def _with_box(df: DataFrame, geometry: str | None) -> DataFrame:
    if "bbox" in df.columns:
        kind = df.schema["bbox"].dataType
        if kind.typeName() == "struct" and {f.name: f.dataType.typeName() for f in kind.fields} == dict.fromkeys(BBOX_FIELDS, "double"):
            return df
        df = df.withColumnRenamed("bbox", "properties_bbox")
    return decode_geometry(df, resolve_geometry_column(df, geometry or "geom"))


def read_features_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with header; pass ``schema`` to skip the inference pass."""
    r = spark.read.option("header", True)
    return r.schema(schema).csv(path) if schema else r.option("inferSchema", True).csv(path)


def select_layer(df: DataFrame, layer: str | None = None, column: str = "layer") -> DataFrame:
    """Keep one layer.  With a layer-partitioned dataset the filter prunes
    partitions.  Without a name, the lowest layer name is taken (a scalar
    subquery, evaluated by Spark, not on the driver)."""
    if layer is not None:
        return df.where(F.col(column) == F.lit(layer))
    first = df.select(F.min(column)).scalar()
    return df.where(F.col(column) == first)


# --- S7: zip archive members ----------------------------------------------------

def _open(path: str):
    store, inner = file_system(path)
    return store.open_input_file(inner)


_MEMBERS = "archive string, member string, size long"
_CHUNKS = "archive string, member string, size long, chunk int, offset long, content binary"


def _list_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Read only each archive's central directory (random access); a file that is no archive gives
    a row without a member."""
    for pdf in batches:
        for path in pdf["path"]:
            with _open(path) as f:
                try:
                    fine = zipfile.is_zipfile(f)
                except ValueError:  # pyarrow's, for a file that is shorter than an archive's end
                    fine = False
                if not fine:
                    yield pd.DataFrame([(path, None, None)], columns=["archive", "member", "size"])
                    continue
                with zipfile.ZipFile(f) as z:
                    rows = [(path, i.filename, i.file_size) for i in z.infolist() if not i.is_dir()]
            for k in range(0, len(rows), 10_000):
                yield pd.DataFrame(rows[k:k + 10_000], columns=["archive", "member", "size"])


def member_chunks(stream, chunk_bytes: int, cut: bytes | None, whole: bool = False) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of a stream in pieces of at most ``chunk_bytes``, each cut after the last ``cut``
    inside it if there is one; holds one piece.  ``whole``: a piece without a ``cut`` grows until one comes."""
    offset, held = 0, bytearray()
    while True:
        more = stream.read(max(1, chunk_bytes - len(held)) if len(held) < chunk_bytes else chunk_bytes)
        held += more
        if not held:
            return
        end = len(held)
        if more and cut:
            at = held.rfind(cut)
            if at >= 0:
                end = at + len(cut)
            elif whole:
                continue
        yield offset, bytes(held[:end])
        offset += end
        del held[:end]


def _read_chunks(chunk_bytes: int, cut: bytes | None, whole: bool = False):
    import pyarrow as pa

    names = ["archive", "member", "size", "chunk", "offset", "content"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with _open(row["archive"]) as f, zipfile.ZipFile(f) as z, z.open(row["member"]) as stream:
                    k = -1
                    for k, (offset, content) in enumerate(member_chunks(stream, chunk_bytes, cut, whole)):
                        values = (row["archive"], row["member"], row["size"], k, offset, content)
                        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)
                    if k < 0:  # an empty member is still a member
                        values = (row["archive"], row["member"], row["size"], 0, 0, b"")
                        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)
    return run


def archive_members(spark: SparkSession, path: str, member_glob: str | None = None) -> DataFrame:
    """(archive, member, size): what the archives under ``path`` hold, from their central directories.

    ``path`` is a file of any name, a folder or a glob; files that aren't archives are left out, and it is an error if
    there is no archive at all.  ``member_glob`` is matched as ``fnmatch`` does it, with its case."""
    files = spark.read.format("binaryFile").load(path).select("path")
    ensure_checkpoint_dir(spark)
    members = files.mapInPandas(_list_members, _MEMBERS).checkpoint()  # archives are listed once
    if members.where("member IS NOT NULL").isEmpty():
        raise ValueError(f"no archive with members in {path}")
    members = members.where("member IS NOT NULL")
    if member_glob:
        pattern = fnmatch.translate(member_glob).replace(r"\Z", r"\z")
        members = members.where(F.col("member").rlike("^" + pattern))
    return members


def read_archive_chunks(spark: SparkSession, path: str, member_glob: str | None = None, chunk_bytes: int = 4 << 20,
                        cut: bytes | None = b"\n", whole: bool = False, partitions: int | None = None) -> DataFrame:
    """S7 for members of any size: (archive, member, size, chunk, offset, content), a row for each piece of
    at most ``chunk_bytes`` of a member, cut after the last ``cut`` in it (None: anywhere); with ``whole`` a
    piece without a ``cut`` grows until one comes.

    A task seeks to a member and inflates it piece by piece, so it holds a piece, not a member.  The member
    list is spread over ``partitions`` tasks; the pieces of a member come from one, in order."""
    members = archive_members(spark, path, member_glob)
    n = partitions or spark.sparkContext.defaultParallelism
    return members.repartition(n, "archive", "member").mapInArrow(_read_chunks(chunk_bytes, cut, whole), _CHUNKS)


def read_archive(spark: SparkSession, path: str, member_glob: str | None = None,
                 partitions: int | None = None, most_bytes: int = 256 << 20) -> DataFrame:
    """``zip://archive!member`` -> table (archive, member, size, content), one whole member a row.

    Archives are listed without reading their content; a member of more than ``most_bytes`` raises (use
    ``read_archive_chunks``), and a task holds one member at a time."""
    members = archive_members(spark, path, member_glob)
    small = members.where((F.col("size") <= most_bytes) | F.raise_error(F.concat(
        F.lit("too large for one row, use read_archive_chunks: "), "archive", F.lit("!"), "member")).cast("boolean"))
    n = partitions or spark.sparkContext.defaultParallelism
    chunks = small.repartition(n, "archive", "member").mapInArrow(_read_chunks(most_bytes + 1, None), _CHUNKS)
    return chunks.select("archive", "member", "size", "content")


def read_archive_features(spark: SparkSession, path: str, member_glob: str | None = None,
                          properties_schema: str | None = None, chunk_bytes: int = 4 << 20) -> DataFrame:
    """S7 + S1: the features of GeoJSON members of any layout and size (properties, geometry as text).

    A task reads a member piece by piece, each up to a ``}``, and cuts its features out as they come."""
    members = archive_members(spark, path, member_glob)
    members = members.repartition(spark.sparkContext.defaultParallelism, "archive", "member")
    return flatten_properties(_features_of(scan_whole(members, _cut_members(chunk_bytes))), "properties", properties_schema)


def _cut_members(chunk_bytes: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with _open(row["archive"]) as f, zipfile.ZipFile(f) as z, z.open(row["member"]) as stream:
                    pieces = (content for _, content in member_chunks(stream, chunk_bytes, b"}", True))
                    yield from cut_whole(f"{row['archive']}!{row['member']}", pieces)
    return run


def read_archive_csv(spark: SparkSession, path: str, member_glob: str | None = None, schema: str | None = None,
                     chunk_bytes: int = 4 << 20) -> DataFrame:
    """S7 + S6: the rows of CSV members (a header each, the same in all; no line breaks inside a cell, which raise).

    Columns are strings unless ``schema`` names their types."""
    chunks = read_archive_chunks(spark, path, member_glob, chunk_bytes, b"\n", whole=True)
    lines = chunks.select("chunk", F.posexplode(F.split(F.decode("content", "UTF-8"), r"\r?\n")).alias("place", "line")).where("line <> ''")
    is_header = (F.col("chunk") == 0) & (F.col("place") == 0)
    headers = [r["line"] for r in lines.where(is_header).select("line").distinct().limit(2).collect()]
    if len(headers) != 1:
        raise ValueError(f"members of {path} have no header, or several: {headers}")
    ddl = schema or ", ".join(f"`{n}` string" for n in next(csv.reader(headers)))
    odd = F.pmod(F.length("line") - F.length(F.replace("line", F.lit('"'))), F.lit(2)) == 1
    line = F.when(odd, F.raise_error(F.lit("a line break inside a cell of an archive's CSV"))).otherwise(F.col("line"))
    return lines.where(~is_header).select(F.from_csv(line, ddl).alias("r")).select("r.*")


def parse_zip_url(url: str) -> tuple[str, str | None]:
    """``zip://<archive>!<member>`` -> (archive path, member)."""
    body = url[len("zip://"):] if url.startswith("zip://") else url
    archive, _, member = body.partition("!")
    return archive, (member or None)


def read_source(spark: SparkSession, url: str, geometry: str | None = None,
                storage_options: dict | None = None) -> DataFrame:
    """S10/S11 for one file source: pick the reader by suffix, then decode
    the geometry column.  Remote URLs are mapped to Hadoop paths and their
    storage options become per-read Hadoop options (S8).  ``zip://archive!member``
    reads the GeoJSON members that match (a glob; default all), or the CSV ones (``*.csv``)."""
    if url.startswith("zip://"):
        archive, member = parse_zip_url(url)
        if (member or "").lower().endswith(".csv"):
            return _located(read_archive_csv(spark, hadoop_path(archive), member), geometry)
        return decode_geometry(read_archive_features(spark, hadoop_path(archive), member), "geometry")
    path = hadoop_path(url)
    opts = hadoop_options(url, storage_options)
    reader = spark.read.options(**opts)
    kind = spark.range(1).select(file_kind(F.lit(url)).alias("k")).first()["k"]
    if kind == "parquet":
        return _with_box(reader.parquet(path), geometry)
    if kind == "json":
        df = read_geojson_any(spark, path, opts)
        if df is None:
            df = read_json_records(spark, path, opts)
    elif kind == "unsupported":
        raise ValueError(f"single-file GIS format is not supported: {url}")
    else:
        df = reader.option("header", True).option("inferSchema", True).csv(path)
    return _located(df, geometry)


def _located(df: DataFrame, geometry: str | None) -> DataFrame:
    """Decoded by its geometry column, or as points of a pair of lon/lat columns."""
    try:
        col = resolve_geometry_column(df, geometry or "geom")
    except ValueError:
        names = {c.lower(): c for c in reversed(df.columns)}
        for lon, lat in LONLAT:
            if lon in names and lat in names:
                return points_from_lonlat(df, names[lon], names[lat])
        return df
    return decode_geometry(df, col)
