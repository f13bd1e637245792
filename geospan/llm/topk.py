"""Exact top-k inner products over norm-sorted vectors.

Candidates are dealt to blocks by descending length, and a block of queries only meets the blocks whose longest
vector can still reach the scores that its queries already have; inside a block, too, candidates come by descending length.  Vectors are turned by the
eigenvectors of the candidates' Gram matrix (the right singular vectors), so that the leading
coordinates carry most of a product; partial sums over them plus the Cauchy-Schwarz bound of the
rest discard candidates, and exact integer products decide among those left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geospan.llm.common import list_matrix, map_batches, sum_over_rows

BLOCK = 4096
QUERIES = 1024
#: Relative slack of the floating-point bounds; only exact integer scores are compared.
SLACK = 1e-6


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component as long; vectors that are null, empty of
    finite meaning (a null, NaN or infinite component) or without an id are left out."""
    v = F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    fine = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col))
            .where(F.col("vec_id").isNotNull() & F.col(vec_col).isNotNull() & fine).select("vec_id", v.alias("v")))


def _top(queries: dict, block: dict, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of each query's k best in a block, as far as they reach
    ``floor``, the score that k candidates elsewhere are known to have."""
    q, c = queries["turned"], block["turned"]
    d = q.shape[1]
    best: list[list[tuple[int, int, int]]] = [[] for _ in range(len(q))]
    need = floor.astype(float).copy()
    cuts = sorted({d, *(h for h in (8, 24) if h < d)})
    for lo in range(0, len(c), 512):
        hi = min(lo + 512, len(c))
        # by descending length: when the longest of the step can't reach it, no later one can
        live = np.flatnonzero(queries["norm"] * block["norm"][lo] * (1 + SLACK) + SLACK >= need)
        if not len(live):
            break
        part = np.zeros((len(live), hi - lo))
        keep = np.ones(part.shape, bool)
        done = 0
        for h in cuts:
            part += q[live, done:h] @ c[lo:hi, done:h].T
            done = h
            rest = queries["rest"][h][live][:, None] * block["rest"][h][None, lo:hi]
            room = SLACK * (1 + queries["norm"][live][:, None] * block["norm"][None, lo:hi])
            keep &= part + rest + room >= need[live][:, None]
            if not keep.any():
                break
        i, j = np.nonzero(keep)
        if not len(i):
            continue
        i, j = live[i], j + lo
        same = queries["id"][i] == block["id"][j]
        i, j = i[~same], j[~same]
        score = np.einsum("ij,ij->i", queries["v"][i], block["v"][j])
        for a in np.unique(i).tolist():
            rows = np.flatnonzero(i == a)
            best[a] = sorted(best[a] + [(-int(s), int(v), int(r)) for s, v, r in zip(score[rows], block["id"][j[rows]], j[rows])])[:k]
            if len(best[a]) == k:
                need[a] = max(need[a], -best[a][-1][0])
    out = [(a, r, -s) for a, rows in enumerate(best) for s, _, r in rows]
    return tuple(np.array(x, np.int64) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def _prepared(ids: np.ndarray, v: np.ndarray, turn: np.ndarray, by_length: bool) -> dict:
    norm = np.sqrt((v.astype(float) ** 2).sum(axis=1))
    order = np.lexsort((ids, -norm)) if by_length else np.arange(len(ids))
    ids, v, norm = ids[order], v[order], norm[order]
    turned = v @ turn
    tail = np.sqrt(np.maximum(0, np.cumsum((turned ** 2)[:, ::-1], axis=1)[:, ::-1]))
    rest = {h: tail[:, h] if h < v.shape[1] else np.zeros(len(v)) for h in range(v.shape[1] + 1)}
    return {"id": ids, "v": v, "norm": norm, "turned": turned, "rest": rest}


#: Ranges that rows are dealt by at most; a range with more rows than a block holds is split by a hash.
RANGES = 1000


def _dealt(df: DataFrame, by: str, rows: int, size: int, least: int, name: str) -> tuple[DataFrame, int]:
    """``df`` with the column ``name``, a block of about ``size`` rows or fewer that are near each other in ``by``, and the number of
    blocks.  ``df`` has a column ``salt`` (long), which tells rows with equal ``by`` apart."""
    n = max(1, least, -(-rows // size))
    shares = [k / min(n, RANGES) for k in range(1, min(n, RANGES))]
    cuts = np.array(sorted(set(df.agg(F.percentile_approx(by, shares, 10_000)).first()[0] or ())) if shares else [], float)

    def ranges(batches):
        for b in batches:
            yield {"k": pa.array(np.searchsorted(cuts, b.column(0).to_numpy(zero_copy_only=False), side="right"))}
    counts = np.zeros(len(cuts) + 1, np.int64)
    for r in map_batches(df.select(by), ranges, "k long").groupBy("k").agg(F.count("*").alias("n")).collect():
        counts[r["k"]] = r["n"]
    parts = np.maximum(1, -(-counts // size))
    first = np.concatenate([[0], np.cumsum(parts)])

    def number(batches):
        for b in batches:
            k = np.searchsorted(cuts, b.column(b.schema.get_field_index(by)).to_numpy(zero_copy_only=False), side="right")
            block = first[k] + b.column(b.schema.get_field_index("salt")).to_numpy() % parts[k]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(block)], names=[*b.schema.names, name])
    return df.mapInArrow(number, df.withColumn(name, F.lit(0).cast("long")).schema), int(first[-1])


def _packed(table: pa.Table, columns: dict) -> dict:
    """A block as one row: its values (``v``, ``width`` places a row) and the named columns as bytes."""
    v = table.column("v").combine_chunks()
    v = v.chunk(0) if isinstance(v, pa.ChunkedArray) else v
    width = int(np.diff(v.offsets.to_numpy()).max(initial=0))
    return {"width": width, "v": list_matrix(v, width).tobytes(), **{k: table.column(c).to_numpy().tobytes() for k, c in columns.items()}}


def _unpack(keys: bytes, v: bytes, width: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(keys, np.int64)
    m = np.frombuffer(v, np.int64).reshape(len(i), width)
    return i, np.pad(m, ((0, 0), (0, dim - width)))


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest inner products over all candidates but
    those of its own id, ties to the smaller vec_id; all, if there are fewer.

    queries, candidates: (vec_id, v array<long>), from ``integer_vectors``.  Shorter vectors count as
    ending in zeros; a row that repeats another candidate counts again, and a query on several rows is
    answered once for each.  Products have to fit in a long.

    A first pass over the longest candidates gives each query a score to beat, and so the least length
    that a candidate must have (score over the query's length).  Queries are dealt to blocks by that
    length, candidates by their own, so a block of queries meets a prefix of the candidates' blocks;
    the driver holds one number for each of these.  Vectors of equal length can't be told apart this way: then every
    block meets every one, and the bounds inside the blocks prune.
    """
    spark = candidates.sparkSession
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    candidates = candidates.select("vec_id", "v", F.sqrt(square).alias("norm")).checkpoint()
    queries = queries.select("vec_id", "v", F.sqrt(square).alias("norm")).withColumn("row", F.monotonically_increasing_id()).checkpoint()
    dim, n = candidates.agg(F.max(F.size("v")), F.count("*")).first()
    qdim, nq = queries.agg(F.max(F.size("v")), F.count("*")).first()
    if not n or not nq:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim = max(dim, qdim, 1)

    def gram(x):
        x = x.astype(float)
        return x.T @ x
    g = sum_over_rows(candidates.select("v"), dim, gram).reshape(dim, dim)
    turn = np.ascontiguousarray(np.linalg.eigh((g + g.T) / 2)[1][:, ::-1])

    parallel = spark.sparkContext.defaultParallelism

    def candidate_block(key, table):
        table = pa.concat_tables(table) if isinstance(table, list) else table
        told = {"cb": key[0].as_py(), **_packed(table, {"keys": "vec_id"}), "top": float(max(table.column("norm").to_numpy(), default=0.0))}
        return pa.table({c: pa.array([x]) for c, x in told.items()} | {"width": pa.array([told["width"]], pa.int32())})
    block_schema = "cb long, width int, v binary, keys binary, top double"
    salted = candidates.withColumn("salt", F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 40)))
    dealt, _ = _dealt(salted, "norm", n, BLOCK, min(parallel, -(-n // 256)), "cb")
    blocks = dealt.groupBy("cb").applyInArrow(candidate_block, block_schema).checkpoint()
    ranked = blocks.select("cb", "top").orderBy(F.desc("top"), "cb").collect()  # a number and a name for every block
    tops = [r["top"] for r in ranked]
    places = spark.createDataFrame([(r["cb"], k) for k, r in enumerate(ranked)], "cb long, place long")
    blocks = blocks.join(places, "cb")

    def compare(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rows, qv = _unpack(row["qkeys"], row["qv"], row["qwidth"], dim)
                ids = np.frombuffer(row["qids"], np.int64)
                floor = np.frombuffer(row["floor"], np.float64)
                ci, cv = _unpack(row["keys"], row["v"], row["width"], dim)
                q, c = _prepared(ids, qv, turn, False), _prepared(ci, cv, turn, True)
                a, r, s = _top(q, c, k, floor)
                yield {"row": pa.array(rows[a]), "query_id": pa.array(ids[a]), "vec_id": pa.array(c["id"][r]), "score": pa.array(s)}
    found_schema = "row long, query_id long, vec_id long, score long"

    def query_block(key, table):
        table = pa.concat_tables(table) if isinstance(table, list) else table
        told = _packed(table, {"qkeys": "row", "qids": "vec_id", "floor": "floor"})
        return pa.table({"qb": pa.array([key[0].as_py()]), "qwidth": pa.array([told.pop("width")], pa.int32()), "qv": pa.array([told.pop("v")]),
                         **{c: pa.array([x]) for c, x in told.items()}, "need": pa.array([float(min(table.column("need").to_numpy()))])})

    def query_blocks(q):
        salted = q.select("row", "v", "vec_id", "floor", "need", F.pmod(F.xxhash64("row"), F.lit(1 << 40)).alias("salt"))
        dealt, _ = _dealt(salted, "need", nq, QUERIES, min(parallel, -(-nq // 64)), "qb")
        return dealt.groupBy("qb").applyInArrow(query_block, "qb long, qwidth int, qv binary, qkeys binary, qids binary, floor binary, need double")
    none = float("-inf")
    start = candidates.orderBy(F.desc("norm"), "vec_id").limit(BLOCK // 4).select("vec_id", "v", "norm")  # a bounded start
    first = start.withColumn("cb", F.lit(0).cast("long")).groupBy("cb").applyInArrow(candidate_block, block_schema)
    begin = query_blocks(queries.withColumns({"floor": F.lit(none), "need": F.lit(none)}))
    seen = map_batches(begin.withColumn("one", F.lit(1)).join(F.broadcast(first.withColumn("one", F.lit(1))), "one"), compare, found_schema)
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    # the k-th best of the longest candidates: a score that every query can already have
    floors = (seen.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
              .select("row", F.col("score").cast("double").alias("floor")))
    # rounded down a little, as only exact scores decide
    need = F.when(F.col("norm") > 0, F.col("floor") / F.col("norm") * (1 - SLACK) - SLACK).otherwise(F.lit(none))
    known = (queries.join(floors, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(none)))
             .withColumn("need", F.when(F.col("floor") > 0, need).otherwise(F.lit(none))))
    qblocks = query_blocks(known.checkpoint()).checkpoint()
    # the blocks that a query block needs are the first ones, by length; the longest vectors of all blocks in falling order
    lengths = spark.createDataFrame([(tops,)], "tops array<double>")
    reach = F.size(F.filter("tops", lambda t: (t >= F.col("need")) | (F.col("need") == none)))
    qblocks = qblocks.withColumn("one", F.lit(1)).join(F.broadcast(lengths.withColumn("one", F.lit(1))), "one").drop("one")
    wanted = qblocks.withColumn("reach", reach).drop("tops").where("reach > 0")
    wanted = wanted.withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("reach").cast("long") - 1)))
    pairs = wanted.join(blocks, "place")
    pairs = pairs.repartition(max(1, min(wanted.count(), 20_000)), "qb", "cb")  # a pair is a task's work
    # equal rows of a query in several blocks stay apart: candidates that repeat count again
    found = map_batches(pairs, compare, found_schema)
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
