from geospan.session import ensure_checkpoint_dir
from geospan.sources.derived import balanced


def test_checkpoint_dir_is_set_and_stable(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and ensure_checkpoint_dir(spark) == d
    assert spark.sparkContext.getCheckpointDir() == d
    # reliable checkpoints work (used by linked-page assembly)
    assert spark.range(5).checkpoint(eager=True).count() == 5


def test_balanced_only_spreads_large_single_partition_scans(spark, scratch):
    spark.range(10).coalesce(1).write.parquet(f"{scratch}/small")
    small = spark.read.parquet(f"{scratch}/small")
    assert balanced(small) is small                     # tiny: left alone
    forced = balanced(small, min_bytes=0)
    assert forced.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(50)
    assert balanced(many, min_bytes=0) is many          # already split: left alone
