"""Publish bookkeeping (K6-K8): upsert a batch of exported files into a
manifest of published files, keyed by (folder, file name).

The original calls a file-store client once per file; the data semantics of
those calls are a full outer join of the current state with the batch:
update if present, create if not, leave the rest, report missing inputs.

A manifest is stored as versions: the state of each is a folder of Parquet, and an entry in the log names it.
Writing an entry is one rename that fails where the version is already there, so a publish either
takes effect whole or not at all, and never over one that it hasn't read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geospan.plans.jobs import merge_maps

KEYS = ["folder", "file_name"]


def publish_manifest(current: DataFrame, batch: DataFrame, metadata_template: bool = True,
                     keys=KEYS) -> DataFrame:
    """K6 + K7: new manifest state with an ``action`` per file.

    ``current``: keys, ``version``, ``bytes``, ``metadata`` (MAP).
    ``batch``:   keys, ``bytes``, ``metadata``, ``exists`` (false when the
    exported file is missing, like an upload of a path that is not there).

    action = ``insert`` (new file, version 1), ``update`` (version + 1,
    bytes replaced), ``keep`` (not in batch), ``missing`` (batch file absent;
    current row, if any, kept).  Metadata is merged (batch keys win) only when
    a metadata template is configured, as in the original.

    A batch may name a file more than once: the row with the largest ``sequence`` counts (without
    that column the one that exists, then the largest ``bytes`` and metadata).  A file that is
    missing and was never published is reported too, without a version.
    """
    order = [F.col("sequence")] if "sequence" in batch.columns else []
    order += [F.coalesce(F.col("exists"), F.lit(True)), F.col("bytes"),
              F.array_sort(F.map_entries("metadata"))]
    batch = (batch.groupBy(*keys)
             .agg(F.max_by(F.struct("bytes", "metadata", "exists"), F.struct(*order)).alias("_row"))
             .select(*keys, "_row.*"))
    c = current.select(*keys, F.col("version").alias("_cv"), F.col("bytes").alias("_cb"),
                       F.col("metadata").alias("_cm"))
    b = batch.select(*keys, F.col("bytes").alias("_bb"), F.col("metadata").alias("_bm"),
                     F.coalesce(F.col("exists"), F.lit(True)).alias("_ok"))
    j = c.join(b, keys, "full_outer")
    in_c, in_b = F.col("_cv").isNotNull(), F.col("_ok").isNotNull()
    action = (F.when(in_b & ~F.col("_ok"), F.lit("missing"))
              .when(in_b & in_c, F.lit("update"))
              .when(in_b, F.lit("insert"))
              .otherwise(F.lit("keep")))
    live = action.isin("insert", "update")
    meta = (merge_maps(F.col("_cm"), F.col("_bm")) if metadata_template
            else F.coalesce(F.col("_cm"), F.create_map().cast("map<string,string>")))
    return (j.select(*keys, action.alias("action"),
                     F.when(action == "update", F.col("_cv") + 1)
                     .when(action == "insert", F.lit(1)).otherwise(F.col("_cv")).alias("version"),
                     F.when(live, F.col("_bb")).otherwise(F.col("_cb")).alias("bytes"),
                     F.when(live, meta).otherwise(F.col("_cm")).alias("metadata")))


def folder_id(parent, name):
    """Deterministic folder id, so reruns create nothing new."""
    return F.concat(F.lit("f_"), F.substring(F.sha2(F.concat_ws("/", parent, name), 256), 1, 12))


def get_or_create_folders(existing: DataFrame, requested: DataFrame) -> DataFrame:
    """K8: folders by (parent, name); requested ones that do not exist are
    created (``created=true``); existing ones keep their id.  Idempotent."""
    req = requested.select("parent", "name").distinct()
    new = (req.join(existing.select("parent", "name"), ["parent", "name"], "left_anti")
           .select("parent", "name", folder_id(F.col("parent"), F.col("name")).alias("folder_id"),
                   F.lit(True).alias("created")))
    old = existing.select("parent", "name", "folder_id", F.lit(False).alias("created"))
    return old.unionByName(new)


# --- the stored manifest --------------------------------------------------------

STATE = "folder string, file_name string, version int, bytes long, metadata map<string,string>"


class ManifestMoved(RuntimeError):
    """Another publish has committed since the base version was read."""


class _Store:
    """The log of a manifest, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.sc = spark._jvm, spark.sparkContext
        self.conf = spark._jsc.hadoopConfiguration()
        root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = root.getFileSystem(self.conf)
        self.root = self.fs.makeQualified(root).toString().rstrip("/")

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def versions(self) -> list[int]:
        folder = self.path("log")
        if not self.fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self.fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def read(self, version: int) -> dict:
        stream = self.fs.open(self.path(f"log/{version:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def commit(self, version: int, entry: dict) -> None:
        """The entry, written beside the log and renamed into it; a version that is there already stays."""
        held = self.path(f"log/.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(held, False)
        try:
            out.write(bytearray(json.dumps(entry).encode()))
        finally:
            out.close()
        keep = self.sc._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)  # no overwriting
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            files.rename(held, self.path(f"log/{version:012d}.json"), keep)
        except Exception as e:
            self.fs.delete(held, False)
            if "FileAlreadyExists" in str(e):
                raise ManifestMoved(f"version {version} of {self.root} is there already") from None
            raise


def read_manifest(spark: SparkSession, path: str, version: int | None = None) -> tuple[DataFrame, int]:
    """(state, version) of a stored manifest, the last one by default; an empty state and 0 before the first publish.

    A publish that broke off before its log entry was written was never there."""
    store = _Store(spark, path)
    versions = store.versions()
    if version is None:
        version = versions[-1] if versions else 0
    if version == 0:
        return spark.createDataFrame([], STATE), 0
    if version not in versions:
        raise ValueError(f"no version {version} of {path}")
    return spark.read.schema(STATE).parquet(f"{store.root}/{store.read(version)['data']}"), version


def commit_manifest(spark: SparkSession, path: str, state: DataFrame, base: int) -> int:
    """Stores ``state`` (columns of ``STATE``) as the version after ``base`` and gives its number; raises
    ``ManifestMoved`` if ``base`` isn't the last version any more.  The state is written before the log entry."""
    store = _Store(spark, path)
    versions = store.versions()
    if (versions[-1] if versions else 0) != base:
        raise ManifestMoved(f"{path} is at version {versions[-1] if versions else 0}, not {base}")
    data = f"data/{uuid.uuid4().hex}"
    state.select(*[f.split(" ", 1)[0] for f in STATE.split(", ")]).write.parquet(f"{store.root}/{data}")
    store.commit(base + 1, {"data": data, "base": base})
    return base + 1


def publish(spark: SparkSession, path: str, batch: DataFrame, metadata_template: bool = True, attempts: int = 5) -> tuple[DataFrame, int]:
    """K6 + K7 on a stored manifest: (actions, version).  The batch is merged with the last version and committed; if
    another publish came first, it is merged again with that one's state, ``attempts`` times.

    actions: as ``publish_manifest`` gives them, for the files of the batch.  Files that are missing and were never
    published are reported, not stored."""
    for k in range(attempts):
        state, base = read_manifest(spark, path)
        merged = publish_manifest(state, batch, metadata_template).checkpoint()  # one result for the store and the caller
        try:
            version = commit_manifest(spark, path, merged.where("version IS NOT NULL").withColumn("version", F.col("version").cast("int")), base)
        except ManifestMoved:
            if k == attempts - 1:
                raise
            continue
        return merged.where("action <> 'keep'"), version


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Removes the states and log entries of all but the last ``keep`` versions, and states that no entry names (a
    publish that runs meanwhile must not be disturbed: call it when none does); gives how many folders went."""
    if keep < 1:
        raise ValueError("keep: one version at least")
    store = _Store(spark, path)
    versions = store.versions()
    named = {store.read(v)["data"].rpartition("/")[2] for v in versions[-keep:]}
    gone = 0
    for v in versions[:-keep]:
        store.fs.delete(store.path(f"log/{v:012d}.json"), False)
    data = store.path("data")
    for f in store.fs.listStatus(data) if store.fs.exists(data) else []:
        if f.getPath().getName() not in named:
            gone += bool(store.fs.delete(f.getPath(), True))
    return gone
