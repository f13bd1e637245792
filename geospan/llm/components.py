"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long) that isn't the smallest of its
    component; root is that smallest node.

    Each round hangs every node under the smallest neighbour it sees, in two directions; the edge
    list shrinks to stars.  A node's smallest neighbour is a partially aggregated ``min``, and the
    join back has one row per node on one side, so AQE can split a hub.  Every round is cut with
    ``checkpoint()`` and compared through a count and a hash of its edges.  Self loops and
    repeated edges are ignored; no edges give no rows.
    """
    e = (edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
         .distinct().checkpoint())
    before = _state(e)
    while before[0]:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
        large = (both.join(least, F.col("a") == F.col("k")).where("b > a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        least = large.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
        e = (large.join(least, F.col("a") == F.col("k"))
             .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                       F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("s"))
             .select("s.a", "s.b").where("a <> b").distinct().checkpoint())
        after = _state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
