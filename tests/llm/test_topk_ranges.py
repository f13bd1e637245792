"""Blocks by length: pairs of blocks that can't matter are never joined, and results stay exact."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geospan.llm import topk


def naive(rows, is_query, k):
    out = []
    for q, x in rows:
        if is_query(q):
            best = sorted((-int(np.dot(x, y)), i) for i, y in rows if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("block, queries", [(4096, 1024), (16, 8)])
def test_lengths_of_all_sizes(spark, monkeypatch, block, queries):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", queries)
    rng = random.Random(block)
    rows = [(i, [int(rng.gauss(0, 1) * 2 ** rng.randrange(12)) for _ in range(7)]) for i in range(400)]
    rows += [(1000 + i, [0] * 7) for i in range(20)] + [(2000 + i, [3, 4, 0, 0, 0, 0, 0]) for i in range(120)]  # no length, and many of one
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = topk.top_k(df.where("vec_id % 20 = 0"), df, 4)
    assert sorted(map(tuple, got.collect())) == naive(rows, lambda i: i % 20 == 0, 4)


def test_far_blocks_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    rng = random.Random(2)
    rows = [(i, [rng.randrange(-9, 9) for _ in range(4)]) for i in range(300)] + [(i, [rng.randrange(900, 999) for _ in range(4)]) for i in range(300, 310)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    met = spark.sparkContext.accumulator(0)
    real = topk._top

    def counted(q, c, k, floor):
        met.add(1)
        return real(q, c, k, floor)
    monkeypatch.setattr(topk, "_top", counted)
    queries = df.where("vec_id BETWEEN 300 AND 303")  # their best are the other long ones
    got = topk.top_k(queries, df, 3)
    assert sorted(map(tuple, got.collect())) == naive(rows, lambda i: 300 <= i <= 303, 3)
    assert met.value <= 6  # the first pass and the block or two of long vectors, of 20


def test_a_query_on_several_rows_is_answered_for_each(spark):
    rows = [(1, [1, 0]), (2, [5, 5]), (3, [0, 7]), (4, [2, 2])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    queries = spark.createDataFrame([(1, [1, 0]), (1, [0, 1]), (1, [1, 0])], "vec_id long, v array<long>")
    got = sorted(map(tuple, topk.top_k(queries, df, 2).collect()))
    assert got == sorted([(1, 1, 2, 5), (1, 2, 4, 2)] * 2 + [(1, 1, 3, 7), (1, 2, 2, 5)])
    assert topk.top_k(queries, df.limit(0)).count() == 0 and topk.top_k(df.where(F.lit(False)), df).count() == 0
