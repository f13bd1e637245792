"""Corpus pipeline over ``documents``: language ID, toxicity, line dedup, near-dedup, packing.

Each stage is a function of (spark, docs, sf_dir) over all rows that its predecessor kept; its
result is written as Parquet and read again as the next stage's ``docs``.  All stages but the last
return the columns of ``docs``.  doc_id is taken as the identity of a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geospan.llm import langid, simhash, templates, toxicity
from geospan.llm.common import fresh, table
from geospan.llm.queries import packed
from geospan.llm.warc import shared_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents of a learned language; null texts, texts without letters, texts whose language has a
    probability under one half and texts that are far from what is usual for every learned language go."""
    return langid.keep_known(docs, langid.fit(docs, with_usual=True))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that are more likely toxic than not; null and empty texts stay."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the lines whose template recurs across documents, except in the first of these (lines
    under five tokens if it recurs in 4, 6, 8 or 10 documents, the fewer the tokens the more), and
    the documents of which no other line with text is left."""
    lines, dropped = fresh(docs, "_lines"), fresh(docs, "_dropped")
    kept = templates.drop_recurring(docs, lines_as=lines, dropped_as=dropped, several=True, least_tokens=1, characters=True)
    kept = kept.where((F.col(dropped) == 0) | (F.trim("text") != ""))
    return kept.withColumn("n_chars", F.when(F.col(dropped) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near-duplicates the document with the smallest id.  A row without an id goes by its
    text's hash, after all ids.  Of rows with the same id and text one stays, the smallest by its other columns."""
    key, first, one = (fresh(docs, x) for x in ("_key", "_first", "_one"))
    unnamed = F.lit(1 << 62) + F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(1 << 62))
    named = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), unnamed))
    groups = simhash.simhash_groups(named.select(F.col(key).alias("doc_id"), "text"), shingle=3, radius=2)
    kept = named.join(groups.where("doc_id = component_id").select(F.col("doc_id").alias(first)).distinct(), F.col(key) == F.col(first), "left_semi")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    # by the key first, as the join has dealt the rows: no other exchange of texts
    return (kept.groupBy(key, "doc_id", "text").agg(F.min(F.struct(F.lit(0).alias(first), *rest)).alias(one))
            .select(*[F.col(c) if c in ("doc_id", "text") else F.col(one)[c].alias(c) for c in docs.columns]))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts that are left into sequences of 1024 tokens."""
    return packed(docs)


STAGES = [("language", language), ("toxicity", toxic), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("packing", packing)]

#: No SQL: language, toxicity and packing are learned or searched.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result goes to a new folder in the shared checkpoint
    folder, so a lost executor costs at most the stage that runs."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
