"""Incremental box extraction with Structured Streaming.

The original tool re-runs a whole extraction on a daily schedule.  The box
filter and envelope operators are stateless, so the same plan runs on a
streaming DataFrame: new feature files are processed once, and
``Trigger.AvailableNow`` gives the batch-style "process what is there, then
stop" run that a scheduler can call.  Progress lives in a checkpoint under
the shared ``spark.checkpoint.dir``, so a rerun after a failure resumes
instead of starting over.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from geospan.operators.filters import bbox_filter
from geospan.session import ensure_checkpoint_dir


def stream_features(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def boxed_stream(features: DataFrame, box: Sequence[float], prepare=None) -> DataFrame:
    """Stateless plan: optional preparation (e.g. decode geometry), then F1."""
    df = prepare(features) if prepare else features
    return bbox_filter(df, box)


def start_box_extraction(spark: SparkSession, source_path: str, schema, box: Sequence[float],
                         sink_path: str, name: str, prepare=None, fmt: str = "parquet",
                         sink_format: str = "parquet", available_now: bool = True
                         ) -> StreamingQuery:
    """Run the box filter over new files in ``source_path`` into ``sink_path``.

    The stream checkpoint is ``{spark.checkpoint.dir}/streams/{name}``, by the folder as it is
    configured: the same in every session, so a rerun goes on where the last one stopped."""
    own = ensure_checkpoint_dir(spark).rstrip("/")  # the configured folder / one of this session
    base = (spark.conf.get("spark.checkpoint.dir", None) or own.rpartition("/")[0]).rstrip("/")
    out = boxed_stream(stream_features(spark, source_path, schema, fmt), box, prepare)
    writer = (out.writeStream.format(sink_format)
              .option("checkpointLocation", f"{base}/streams/{name}")
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start(sink_path)

