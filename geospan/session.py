"""Spark session helpers.

The engine never assumes a local machine: checkpoint data goes to the folder
named by ``spark.checkpoint.dir``.  Only when that setting is absent *and* the
master is local (tests, laptops) do we pick a scratch folder ourselves.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings every geospan job relies on.  AQE re-plans joins from runtime sizes
# and splits skewed shuffle partitions; the rest keep local runs quiet.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "geospan",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (builder.config("spark.driver.bindAddress", "127.0.0.1")
                       .config("spark.driver.host", "127.0.0.1"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the SparkContext at the shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session.  If it is unset and the
    master is local, a scratch folder is created (test runs only); on a cluster
    an unset value is an error, because a machine-local folder would not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="geospan-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder "
        "(HDFS, object store) before running iterative geospan operators")


def side_by_side(spark: SparkSession, do: Callable, things: Sequence, most: int = 4) -> list:
    """``do`` of each thing, in their order; the Spark jobs of up to ``most`` of them run at the same time, so that
    the last tasks and the planning of one leave no cores idle."""
    if len(things) < 2:
        return [do(x) for x in things]
    with ThreadPoolExecutor(min(most, len(things))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(do), things))
