"""File sinks (K1-K5) and multi-format export with a manifest.

Every writer is a distributed ``DataFrame.write``; nothing is collected.  The
exported frame is written once to the shared checkpoint folder and every format
is made from that table, so the extraction runs once and a lost executor costs
no more than the stage that runs.  Each format is attempted independently: a
failing format is reported in the manifest while the others still run.
"""

from __future__ import annotations

import json
import math
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geospan.functions import plain as _plain
from geospan.functions.bbox import zorder_key
from geospan.functions.envelope import text_to_wkb, wkb_envelope
from geospan.operators.extent import extent
from geospan.operators.filters import drop_geometry
from geospan.plans.jobs import FORMAT_EXTENSIONS, KNOWN_FORMATS, SUPPORTED_FORMATS
from geospan.session import ensure_checkpoint_dir
from geospan.sinks.geoparquet import FORMAT, GeoParquetSource

#: Bytes of staged Parquet that go into one GeoParquet file.
FILE_BYTES = 256 << 20


@F.arrow_udf(T.StringType())
def to_geojson_geometry(values: pa.Array) -> pa.Array:
    """Geometry (GeoJSON / WKT / hex text, or WKB bytes) -> GeoJSON text; unreadable -> NULL."""
    return _plain.values_to_geojson(values)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: attributes only, with a header, no index column."""
    drop_geometry(df).write.mode(mode).option("header", True).csv(path)


def _as_wkb(df: DataFrame, geometry: str) -> DataFrame:
    if isinstance(df.schema[geometry].dataType, T.BinaryType):
        return df
    return df.withColumn(geometry, text_to_wkb(F.col(geometry)))


def count_bad(df: DataFrame, geometry: str = "geometry") -> int:
    """Rows whose geometry is there but can't be read; the sinks write NULL for these (GeoParquet
    keeps unreadable WKB as it is)."""
    g = F.col(geometry)
    if isinstance(df.schema[geometry].dataType, T.BinaryType):
        bad = wkb_envelope(g).bad
    else:
        bad = g.isNotNull() & text_to_wkb(g).isNull()
    return df.where(bad).count()


def stage(df: DataFrame) -> tuple[DataFrame, int]:
    """(``df`` written to the shared checkpoint folder and read again, its bytes there).  The folder
    stays until the owner of the checkpoint folder clears it."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/export-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    files = out.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(F.max("file_size").alias("n"))
    return out, files.agg(F.sum("n")).first()[0] or 0


def write_geoparquet(df: DataFrame, path: str, geometry: str = "geometry",
                     mode: str = "overwrite", partitions: int | None = None, geo_key: str = "sidecar") -> None:
    """K2: WKB geometry plus the ``bbox`` covering struct, clustered along a
    Z-order curve so that each file (and row group) covers a compact area
    and box filters on ``bbox.*`` skip most of them.  Spark's writer cannot
    set the file-level ``geo`` key, so its JSON goes to a ``_geo.json``
    sidecar; with ``geo_key="footer"`` the files are written by
    :mod:`geospan.sinks.geoparquet` and have the key in their footers (stores that pyarrow reaches).  The number of files follows the bytes of the staged rows
    (``FILE_BYTES`` each) unless ``partitions`` is given, which says that ``df``
    is staged or cheap to read twice; geometry that is text is staged as WKB first."""
    out = _as_wkb(df, geometry)
    if partitions is None or out is not df:  # the range partitioner reads its rows twice: texts are converted once
        out, size = stage(out)
        partitions = partitions or max(1, math.ceil(size / FILE_BYTES))
    # The hash tiebreaker lets the range partitioner split a Z-range that
    # holds a large share of all rows (a hot spot) over several tasks.
    tie = F.xxhash64(F.col("bbox.xmin"), F.col("bbox.ymin"), F.col("bbox.xmax"),
                     F.col("bbox.ymax"), F.col(geometry))  # of content, so that retries agree
    clustered = (out.withColumn("_z", zorder_key("bbox")).withColumn("_tie", tie)
                 .repartitionByRange(partitions, "_z", "_tie")
                 .sortWithinPartitions("_z").drop("_z", "_tie"))
    if geo_key == "footer":
        df.sparkSession.dataSource.register(GeoParquetSource)
        clustered.write.format(FORMAT).option("geometry", geometry).mode(mode).save(path)
        return
    if geo_key != "sidecar":
        raise ValueError("geo_key: sidecar or footer")
    clustered.write.mode(mode).parquet(path)
    ext = extent(df.sparkSession.read.parquet(path), with_count=False).first()
    geo = {"version": "1.1.0", "primary_column": geometry,
           "columns": {geometry: {"encoding": "WKB", "geometry_types": [],
                                  "bbox": [ext["xmin"], ext["ymin"], ext["xmax"], ext["ymax"]],
                                  "covering": {"bbox": {k: ["bbox", k] for k in
                                                        ("xmin", "ymin", "xmax", "ymax")}}}}}
    (df.sparkSession.createDataFrame([(json.dumps(geo),)], "value string")
     .coalesce(1).write.mode("overwrite").text(path.rstrip("/") + "_geo.json"))


def feature_json(df: DataFrame, geometry: str = "geometry") -> F.Column:
    attrs = [c for c in df.columns if c not in (geometry, "bbox", "srid", "assumed_srid", "_bad")]
    props = F.to_json(F.struct(*attrs)) if attrs else F.lit("{}")
    geom = F.coalesce(to_geojson_geometry(F.col(geometry)), F.lit("null"))
    return F.concat(F.lit('{"type":"Feature","properties":'), props,
                    F.lit(',"geometry":'), geom, F.lit("}"))


def write_geojson(df: DataFrame, path: str, geometry: str = "geometry",
                  mode: str = "overwrite", layout: str = "lines") -> None:
    """K3: newline-delimited GeoJSON Features, one shard per task; or (``layout="collection"``) a
    FeatureCollection per shard, on one line."""
    rows = df.select(feature_json(df, geometry).alias("value"))
    if layout == "lines":
        rows.write.mode(mode).text(path)
    elif layout == "collection":
        rows.mapInArrow(_as_collection, "value string").write.mode(mode).option("lineSep", " ").text(path)
    else:
        raise ValueError("layout: lines or collection")


def _as_collection(batches):
    """The features of a task between the head and the end of a collection."""
    def told(values):
        return pa.RecordBatch.from_arrays([values], names=["value"])
    begun = False
    for batch in batches:
        v = batch.column(0)
        if not len(v):
            continue
        rest = v if begun else v.slice(1)
        if not begun:
            yield told(pa.array(['{"type":"FeatureCollection","features":[' + v[0].as_py()]))
        begun = True
        if len(rest):
            yield told(pc.binary_join_element_wise(pa.scalar(","), rest, ""))
    yield told(pa.array(["]}" if begun else '{"type":"FeatureCollection","features":[]}']))


def zip_bytes(names, contents, level: int | None = None) -> bytes:
    """Names and texts of members -> the bytes of a zip archive; ``level``: of compression, 1 the fastest."""
    import io
    import zipfile

    box = io.BytesIO()
    with zipfile.ZipFile(box, "w", zipfile.ZIP_DEFLATED, compresslevel=level) as z:
        for n, c in zip(names, contents):
            z.writestr(n, c)
    return box.getvalue()


WRITERS = {"csv": write_csv, "parquet": write_geoparquet, "geojson": write_geojson}


def extension(fmt: str) -> str:
    return FORMAT_EXTENSIONS.get(fmt, f".{fmt}")


def export_multiple(df: DataFrame, output_dir: str, base_name: str, formats,
                    geometry: str = "geometry") -> DataFrame:
    """K4: write ``df`` once per format under ``{dir}/{base}{ext}``.

    The extraction is computed once, into a staged table from which all formats
    are written.

    Returns a manifest (format, path, status, rows, bad_rows): ``ok``, ``failed``
    with the message (the writer raised; other formats continue), ``unsupported``
    (single-file GIS formats such as shapefile / gpkg / filegdb), or ``unknown``.
    ``bad_rows`` counts the rows whose geometry can't be read; they are written
    with a NULL geometry (CSV has none and reports none)."""
    spark = df.sparkSession
    wanted = [(fmt, fmt.lower()) for fmt in formats]
    manifest = []

    def path_of(f):
        return f"{output_dir.rstrip('/')}/{base_name}{extension(f)}"

    if not any(f in SUPPORTED_FORMATS for _, f in wanted):
        source, size, rows = df, 0, None
    else:
        source, size = stage(df)
        rows = source.count()
    bad = count_bad(source, geometry) if any(f in ("parquet", "geojson") for _, f in wanted) else None
    for fmt, f in wanted:
        if f not in KNOWN_FORMATS:
            manifest.append((fmt, None, "unknown", None, None))
        elif f not in SUPPORTED_FORMATS:
            manifest.append((fmt, None, "unsupported", None, None))
        else:
            try:
                if f == "csv":
                    write_csv(source, path_of(f))
                elif f == "parquet":
                    write_geoparquet(source, path_of(f), geometry=geometry,
                                     partitions=max(1, math.ceil(size / FILE_BYTES)))
                else:
                    WRITERS[f](source, path_of(f), geometry=geometry)
                manifest.append((fmt, path_of(f), "ok", rows, None if f == "csv" else bad))
            except Exception as e:  # one failed format must not stop the rest
                manifest.append((fmt, None, f"failed: {type(e).__name__}: {e}", None, None))
    return spark.createDataFrame(manifest, "format string, path string, status string, rows long, bad_rows long")


def save_box_record(ext: DataFrame, path: str, source_file: str | None = None,
                    layer: str | None = None, feature_filter: str | None = None,
                    buffer: float | None = None) -> None:
    """K5: extent row(s) with provenance, written as JSON."""
    ext.select(F.struct(F.col("xmin").alias("min_lon"), F.col("ymin").alias("min_lat"),
                        F.col("xmax").alias("max_lon"), F.col("ymax").alias("max_lat")).alias("bbox"),
               F.lit(source_file).cast("string").alias("source_file"),
               F.lit(layer).cast("string").alias("layer"),
               F.lit(feature_filter).cast("string").alias("filter"),
               F.lit(buffer).cast("double").alias("buffer")).write.mode("overwrite").json(path)
