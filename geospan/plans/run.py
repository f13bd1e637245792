"""Tables of jobs from extraction to manifest: one scan per source, however many jobs there are."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geospan.functions.bbox import BBOX_FIELDS, zorder_key
from geospan.operators.extent import extent
from geospan.operators.extract import extract_jobs
from geospan.operators.filters import drop_geometry
from geospan.operators.geometry import resolve_geometry_column
from geospan.plans.jobs import SUPPORTED_FORMATS, format_status, output_filename, route
from geospan.session import ensure_checkpoint_dir, side_by_side
from geospan.sinks.export import FILE_BYTES, _as_wkb, feature_json, stage
from geospan.sources.files import read_source, select_layer

MANIFEST = ("job_name string, format string, file_name string, path string, status string, feature_count long, "
            "xmin double, ymin double, xmax double, ymax double")
#: Columns by which rows are dealt to files; the first is the name of the folders.
DEALT = ("job_folder", "_job_files", "_job_first", "_job_part")
#: Bytes of the table of jobs that may be broadcast.
BROADCAST_BYTES = 64 << 20
#: Boxes of a source's jobs that are pushed down one by one; of more, their common extent is.
PUSHED_BOXES = 64


def job_folder(job_name: Column) -> Column:
    """A folder name of letters, digits, dots, dashes and underscores that no other job has."""
    return F.concat(F.regexp_replace(job_name, r"[^A-Za-z0-9._-]", "_"), F.lit("-"), F.substring(F.sha2(job_name, 256), 1, 12))


def _writers(geometry: str) -> dict:
    """format -> rows to what is written of them (job_name may go: the folder names the job), and how."""
    def csv(rows):
        return drop_geometry(rows), "csv", {"header": True}

    def geojson(rows):
        keep = [c for c in rows.columns if c in DEALT]
        return rows.select(*keep, feature_json(rows.drop("job_name", *keep), geometry).alias("value")), "text", {}

    def parquet(rows):
        return _as_wkb(rows, geometry), "parquet", {}
    return {"csv": csv, "geojson": geojson, "parquet": parquet}


def _write_format(rows: DataFrame, sizes: DataFrame, path: str, write, order: list[Column]) -> None:
    """One distributed write of the rows of all jobs in ``sizes``, to ``{path}/job_folder=...``: a job's rows are dealt to as many
    files as its measured bytes ask for (``sizes``: job_name, _job_files, job_folder), so there are no more files than jobs plus bytes
    over the target size, and no job, however large, goes through one task.  The rows are shuffled once, to their files."""
    spark = rows.sparkSession
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    n, size = sizes.agg(F.coalesce(F.sum("_job_files"), F.lit(0)), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()
    few = n <= most
    if few:  # each file to a task of its own; the window is over these few rows
        before = F.sum("_job_files").over(Window.orderBy("job_name").rowsBetween(Window.unboundedPreceding, -1))
        sizes = sizes.withColumn("_job_first", F.coalesce(before, F.lit(0)))
    else:
        sizes = sizes.withColumn("_job_first", F.lit(0))
    out, kind, options = write(rows.join(F.broadcast(sizes) if size <= BROADCAST_BYTES else sizes, "job_name"))
    deal = F.pmod(F.xxhash64(*[c for c in out.columns if c not in DEALT]), F.col("_job_files"))
    # the order is computed once a row, not in each comparison of the sort
    order = {f"_job_order{k}": c for k, c in enumerate(order)}
    out = out.withColumns({"_job_part": deal, **order})
    out = out.repartitionById(n, (F.col("_job_first") + F.col("_job_part")).cast("int")) if few and n else out.repartition("job_folder", "_job_part")
    out = out.sortWithinPartitions("job_folder", "_job_part", *order)
    (out.drop("job_name", "_job_files", "_job_first", "_job_part", *order).write.mode("overwrite").partitionBy("job_folder")
     .options(**options).format(kind).save(path))


def run_jobs(features: DataFrame, jobs: DataFrame, output_dir: str, timestamp, geometry: str = "geometry",
             file_bytes: int = FILE_BYTES, **join) -> DataFrame:
    """Extracts every job's features from one source, writes them and returns the manifest.

    ``jobs``: job_name, bbox, output_formats, output_prefix (see ``read_jobs`` and
    ``resolve_jobs``); a job name that occurs twice raises.  The pairs of job and feature are
    computed once and staged in the shared checkpoint folder.  Each format is one
    distributed write of the rows of all jobs that ask for it, to
    ``{output_dir}/{format}/job_folder=...``, in files of about ``file_bytes``; a format that fails has
    the status ``failed: ...`` and the others are written.

    Manifest: a row per job and format (``MANIFEST``); a job that catches nothing has a count
    of 0 and no path.
    """
    base = output_dir.rstrip("/")
    twice = jobs.groupBy("job_name").count().where("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"job names that occur twice: {[r['job_name'] for r in twice]}")
    pairs, size = stage(extract_jobs(features, jobs.select("job_name", "bbox"), **join).drop("job_bbox"))
    # bytes of a job: its share of the staged bytes, by the length of its rows' texts
    length = F.length(F.to_json(F.struct(*drop_geometry(pairs).columns)))
    if geometry in pairs.columns:
        length = length + F.coalesce(F.length(geometry), F.lit(0))
    # a row per job, measured once, with the formats it asks for
    found = extent(pairs.withColumn("_bytes", length), by="job_name", more=[F.sum("_bytes").alias("_bytes")])
    found = found.join(jobs.select("job_name", F.transform("output_formats", F.lower).alias("_formats")), "job_name").checkpoint()
    sizes = found.select("job_name", "_bytes", "_formats")
    total = sizes.agg(F.sum("_bytes")).first()[0] or 1
    files = F.ceil(F.col("_bytes") * (size / total) / F.lit(file_bytes))
    sizes = sizes.select("job_name", "_formats", F.greatest(files, F.lit(1)).cast("int").alias("_job_files"), job_folder(F.col("job_name")).alias("job_folder"))
    wanted = jobs.select("job_name", "output_prefix", F.explode("output_formats").alias("format"))
    asked = {r["f"] for r in wanted.select(F.lower("format").alias("f")).distinct().where(F.col("f").isin(*SUPPORTED_FORMATS)).collect()}

    def write(fmt: str) -> str | None:
        of = sizes.where(F.array_contains("_formats", fmt)).drop("_formats")
        order = [zorder_key("bbox")] if fmt == "parquet" and "bbox" in pairs.columns else []
        try:
            _write_format(pairs, of, f"{base}/{fmt}", _writers(geometry)[fmt], order)
        except Exception as e:  # one failed format must not stop the rest
            return f"failed: {type(e).__name__}: {str(e).splitlines()[0][:300]}"
    formats = [fmt for fmt in SUPPORTED_FORMATS if fmt in asked]
    failed = {fmt: why for fmt, why in zip(formats, side_by_side(features.sparkSession, write, formats, most=2)) if why}
    count = F.coalesce("feature_count", F.lit(0))
    f = F.lower("format")
    status = F.when(format_status(f) == "supported", F.lit("ok")).otherwise(format_status(f))
    for fmt, why in failed.items():
        status = F.when(f == fmt, F.lit(why)).otherwise(status)
    path = F.concat(F.lit(base + "/"), f, F.lit("/job_folder="), job_folder(F.col("job_name")))
    return (wanted.join(found, "job_name", "left")
            .select("job_name", "format",
                    output_filename(F.col("output_prefix"), F.col("job_name"), F.col("format"), timestamp).alias("file_name"),
                    F.when((count > 0) & (status == "ok"), path).alias("path"),
                    status.alias("status"), count.alias("feature_count"), *BBOX_FIELDS))


def _pushed(features: DataFrame, jobs: DataFrame) -> DataFrame:
    """The features that some job's box, or beyond PUSHED_BOXES boxes their extent, meets: comparisons with
    literals, which a source that stores boxes skips row groups by."""
    b = F.col("bbox")
    boxes = [r["bbox"] for r in jobs.select("bbox").where("bbox IS NOT NULL").distinct().limit(PUSHED_BOXES + 1).collect()]
    if len(boxes) > PUSHED_BOXES:
        r = jobs.agg(F.min("bbox.xmin"), F.min("bbox.ymin"), F.max("bbox.xmax"), F.max("bbox.ymax")).first()
        boxes = [dict(zip(BBOX_FIELDS, r))]
    some = F.lit(False)
    for box in boxes:
        some |= (b.xmin <= box["xmax"]) & (b.xmax >= box["xmin"]) & (b.ymin <= box["ymax"]) & (b.ymax >= box["ymin"])
    return features.where(some)


def run_job_table(jobs: DataFrame, output_dir: str, timestamp, tables: Mapping[str, DataFrame] | None = None,
                  storage_options: Mapping[str, Mapping] | None = None, most_sources: int = 1000, **options) -> DataFrame:
    """Runs a table of jobs over any number of sources and returns one manifest.

    ``jobs``: as ``resolve_jobs`` gives them: job_name, url, layer_name, geometry_column, bbox, status,
    output_formats, output_prefix.  Jobs with the same url, layer and geometry column share one scan; the boxes of
    a source's jobs are pushed into it, and each job and feature meet in one join per source, so scans follow
    the sources, not the jobs (more than ``most_sources`` raise: each is a plan of its own).  Files are read by
    ``read_source``; ``tables`` may name the features of a url that isn't a file (assembled API pages);
    ``storage_options`` has the options of a url.

    Jobs that can't be run have a row per format with their status (``unknown_source``, ``no_bbox``,
    ``needs_responses`` for an API without a table, ``failed: ...`` for a source that can't be read), a count of 0 and no
    path; the others run.  Output of source k goes to ``{output_dir}/source_{k}/{format}/...``, in the order of the urls.
    """
    spark = jobs.sparkSession
    ensure_checkpoint_dir(spark)
    tables, storage_options = tables or {}, storage_options or {}
    jobs = jobs.checkpoint()
    twice = jobs.groupBy("job_name").count().where("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"job names that occur twice: {[r['job_name'] for r in twice]}")
    key = ["url", "layer_name", "geometry_column"]
    ready = jobs.where("status = 'ok'")
    sources = ready.select(*key, route("url").alias("route")).distinct().orderBy(*key).limit(most_sources + 1).collect()
    if len(sources) > most_sources:
        raise ValueError(f"over {most_sources} sources in one job table")

    def unrun(some: DataFrame, status: Column) -> DataFrame:
        return some.select("job_name", F.explode("output_formats").alias("format"), F.lit(None).cast("string").alias("file_name"),
                           F.lit(None).cast("string").alias("path"), status.alias("status"), F.lit(0).cast("long").alias("feature_count"),
                           *[F.lit(None).cast("double").alias(c) for c in BBOX_FIELDS])

    def part(source: tuple) -> DataFrame:
        k, s = source
        mine = ready.where(F.lit(True))
        for c in key:
            mine = mine.where(F.col(c).eqNullSafe(F.lit(s[c])))
        if s["url"] not in tables and s["route"] == "api":
            return unrun(mine, F.lit("needs_responses"))
        try:
            features = tables[s["url"]] if s["url"] in tables else read_source(spark, s["url"], s["geometry_column"], storage_options.get(s["url"]))
            if s["layer_name"] is not None and "layer" in features.columns:
                features = select_layer(features, s["layer_name"])
            geometry = resolve_geometry_column(features, s["geometry_column"])
            return run_jobs(_pushed(features, mine), mine, f"{output_dir.rstrip('/')}/source_{k}", timestamp, geometry, **options)
        except Exception as e:  # one broken source must not stop the others
            return unrun(mine, F.lit(f"failed: {type(e).__name__}: {str(e).splitlines()[0][:300]}"))
    parts = [unrun(jobs.where("status <> 'ok' OR status IS NULL"), F.coalesce("status", F.lit("no status"))),
             *side_by_side(spark, part, list(enumerate(sources)))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def publish_batch(manifest: DataFrame, folder: str, metadata: DataFrame | None = None) -> DataFrame:
    """The files of a manifest as a batch for ``publish`` (K6): a row for each file that a job asked for, missing
    where it wasn't written; bytes as Spark lists them.  ``metadata``: (job_name, metadata map)."""
    spark = manifest.sparkSession
    paths = [r["path"] for r in manifest.where("path IS NOT NULL").select(F.regexp_extract("path", "^(.*)/job_folder=", 1).alias("path")).distinct().collect()]
    listed = None
    if paths:  # one listing per source and format
        listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
                  .select(F.regexp_extract("path", "/([a-z]+/job_folder=[^/]+)/[^/]+$", 1).alias("_key"), "length")
                  .groupBy("_key").agg(F.sum("length").alias("bytes")))
    out = manifest.where("file_name IS NOT NULL").withColumn("_key", F.regexp_extract("path", "([a-z]+/job_folder=[^/]+)$", 1))
    out = out.join(listed, "_key", "left") if listed is not None else out.withColumn("bytes", F.lit(None).cast("long"))
    if metadata is not None:
        out = out.join(metadata.select("job_name", "metadata"), "job_name", "left")
    else:
        out = out.withColumn("metadata", F.create_map().cast("map<string,string>"))
    return out.select(F.lit(folder).alias("folder"), "file_name", "bytes", "metadata", F.col("path").isNotNull().alias("exists"))
