"""Hard negatives by Four-Russians scoring.

Anchors are met by all candidates in blocks.  For every eight dimensions of a block of anchors a table
holds each anchor's sum over each of the 256 subsets of them.  Candidates are packed as bit planes: one byte
is one bit of eight components, and so a place in a table.  The sum of the looked-up values of a plane
is that bit's share of the inner product; doubling between planes (the top one, two's complement's sign, counts
negative) gives full, exact integer scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geospan.llm.common import list_matrix, map_batches

#: Rows of a block at most; their packed form is what is shuffled.
ANCHORS, CANDIDATES = 4096, 8192
#: Anchors whose tables a task holds at once, candidates that are looked up at once.
TABLES, STEP = 256, 512


def labelled_integers(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None,
                      scale: int = 256) -> DataFrame:
    """(vec_id, label, v array<long>): floor(scale * x) of each component as double.  Rows with a null id,
    label or vector, or a null or non-finite component, are left out."""
    c = F.col(vec_col)
    fine = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    v = F.transform("_v", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"), c.alias("_v"))
            .where("vec_id IS NOT NULL AND label IS NOT NULL AND _v IS NOT NULL").where(fine).select("vec_id", "label", v.alias("v")))


def bit_planes(v: np.ndarray, bits: int) -> np.ndarray:
    """(groups, bits, rows) bytes: bit b of components 8g..8g+7, two's complement; the last group ends in zeros."""
    rows, dim = v.shape
    groups = -(-dim // 8)
    wide = np.zeros((rows, groups * 8), np.int64)
    wide[:, :dim] = v
    planes = (wide[None, :, :] >> np.arange(bits)[:, None, None]) & 1
    packed = np.packbits(planes.astype(np.uint8).reshape(bits, rows, groups, 8), axis=3, bitorder="little")[..., 0]
    return np.ascontiguousarray(packed.transpose(2, 0, 1))


def subset_sums(anchors: np.ndarray, groups: int, kind) -> np.ndarray:
    """(groups, 256, anchors): the sum of the components that a byte's bits name, by doubling the table bit by bit."""
    out = np.zeros((groups, 256, len(anchors)), kind)
    for d in range(anchors.shape[1]):
        g, k = divmod(d, 8)
        out[g, 1 << k:2 << k] = out[g, :1 << k] + anchors[:, d].astype(kind)
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidates, anchors) inner products, from the top plane down: twice the sum so far plus the next plane's."""
    groups, bits, rows = planes.shape
    out = np.zeros((rows, tables.shape[2]), tables.dtype)
    look = np.empty_like(out[:STEP])
    for a in range(0, rows, STEP):
        part, total = planes[:, :, a:a + STEP], out[a:a + STEP]
        seen = look[:len(total)]
        for b in range(bits - 1, -1, -1):
            if b < bits - 1:
                total += total
            for g in range(groups):
                np.take(tables[g], part[g, b], axis=0, out=seen, mode="clip")
                if b == bits - 1:
                    total -= seen
                else:
                    total += seen
    return out


def _blocks(rows: DataFrame, n: int, name: str, pack, schema: str) -> DataFrame:
    """``n`` blocks of rows dealt by a hash of the row number, each one row as ``pack`` gives it."""
    dealt = rows.withColumn(name, F.pmod(F.xxhash64("row", F.lit(name)), F.lit(n)))

    def glue(key, table):
        order = np.lexsort((table.column("row").to_numpy(), table.column("vec_id").to_numpy()))
        cols = {name: [key[0].as_py()], **pack(table.take(pa.array(order)))}
        return pa.table({k: pa.array(v) for k, v in cols.items()})
    return dealt.groupBy(name).applyInArrow(glue, f"{name} long, {schema}")


def hard_negatives(anchors: Column, rows: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score): for each row of ``rows``
    (vec_id, label, v) that meets the condition ``anchors`` and each of its ``positives`` best other rows of its
    label, the ``negatives`` best rows of another label with low * positive_score <= 100 * negative_score <=
    high * positive_score.  Best: larger inner product first, ties to the smaller vec_id; all, if there are fewer.

    A row is told apart by its place, not its id: rows that repeat an id are rows of their own, as anchors,
    positives and negatives (rows that agree in score and id come in any order).  Shorter vectors
    end in zeros.  No rows, no anchors or no positives give no rows.  Scores have to fit in a long.

    Candidates and anchors are packed into blocks of bounded size and every block of anchors meets every
    block of candidates, twice: for the positives, and for the negatives that these allow.  A pair of blocks gives
    at most ``positives`` (then positives * negatives) rows an anchor, and those are ranked per anchor.
    """
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, positive_rank int, rank int, negative_id long, positive_score long, negative_score long"
    rows = rows.select("vec_id", "label", "v", anchors.alias("anchor")).withColumn("row", F.monotonically_increasing_id()).checkpoint()
    top = F.max(F.aggregate("v", F.lit(0).cast("long"), lambda m, x: F.greatest(m, F.when(x < 0, -1 - x).otherwise(x))))
    n, na, dim, most = rows.agg(F.count("*"), F.count_if("anchor"), F.max(F.size("v")), top).first()
    if not n or not na or not dim:
        return spark.createDataFrame([], schema)
    bits = int(most).bit_length() + 1
    groups = -(-dim // 8)
    kind = np.int32 if dim * (most + 1) ** 2 < 1 << 31 else np.int64
    nab = -(-na // ANCHORS)
    ncb = max(-(-n // CANDIDATES), min(16, -(-n // 512)))

    def pack_candidates(t):
        return {"ids": [t["vec_id"].to_numpy().tobytes()], "labels": [t["label"].to_numpy().tobytes()], "rows": [t["row"].to_numpy().tobytes()],
                "planes": [bit_planes(list_matrix(t["v"], dim), bits).tobytes()]}

    def pack_anchors(t):
        return {"aids": [t["vec_id"].to_numpy().tobytes()], "alabels": [t["label"].to_numpy().tobytes()],
                "arows": [t["row"].to_numpy().tobytes()], "av": [list_matrix(t["v"], dim).tobytes()]}
    cblocks = _blocks(rows, ncb, "cb", pack_candidates, "ids binary, labels binary, rows binary, planes binary").checkpoint()
    ablocks = _blocks(rows.where("anchor"), nab, "ab", pack_anchors, "aids binary, alabels binary, arows binary, av binary").checkpoint()

    def meet(ablocks):
        every = ablocks.withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ncb - 1).cast("long"))))
        return every.join(cblocks, "cb").repartition(min(nab * ncb, 20_000), "ab", "cb")

    def unpacked(row):
        c = {k: np.frombuffer(row[k], np.int64) for k in ("ids", "labels", "rows")}
        c["planes"] = np.frombuffer(row["planes"], np.uint8).reshape(groups, bits, -1)
        a = {k: np.frombuffer(row[k], np.int64) for k in ("aids", "alabels", "arows")}
        return a, c, np.frombuffer(row["av"], np.int64).reshape(-1, dim)

    def find_positives(batches):
        for row in (r for b in batches for r in b.to_pylist()):
            a, c, av = unpacked(row)
            found = {k: [] for k in ("anchor", "vec_id", "row", "score")}
            for label in np.unique(a["alabels"]).tolist():
                ours, theirs = np.flatnonzero(a["alabels"] == label), np.flatnonzero(c["labels"] == label)
                planes = np.ascontiguousarray(c["planes"][:, :, theirs])
                for at in range(0, len(ours) if len(theirs) else 0, TABLES):
                    some = ours[at:at + TABLES]
                    s = scores(subset_sums(av[some], groups, kind), planes).T.astype(np.int64)
                    own = c["rows"][theirs][None, :] == a["arows"][some][:, None]
                    order = np.argsort(-s, axis=1, kind="stable")[:, :positives + 1]  # candidates are in the order of their ids
                    fine = ~np.take_along_axis(own, order, 1)
                    fine &= np.cumsum(fine, axis=1) <= positives
                    i, j = np.nonzero(fine)
                    pick = order[i, j]
                    found["anchor"].append(a["arows"][some[i]])
                    found["vec_id"].append(c["ids"][theirs[pick]])
                    found["row"].append(c["rows"][theirs[pick]])
                    found["score"].append(s[i, pick])
            if found["row"]:
                yield {k: np.concatenate(v) for k, v in found.items()}
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", "row")
    best = (map_batches(meet(ablocks), find_positives, "anchor long, vec_id long, row long, score long")
            .withColumn("prank", F.row_number().over(first)).where(F.col("prank") <= positives)
            .select("anchor", "prank", "vec_id", "score").checkpoint())
    # an anchor's block, as _blocks deals it; its list has at most ``positives`` entries an anchor
    listed = (best.withColumn("ab", F.pmod(F.xxhash64(F.col("anchor").alias("row"), F.lit("ab")), F.lit(nab)))
              .groupBy("ab").agg(F.collect_list(F.struct("anchor", "prank", "score")).alias("known")))

    def find_negatives(batches):
        for row in (r for b in batches for r in b.to_pylist()):
            a, c, av = unpacked(row)
            place = {r: i for i, r in enumerate(a["arows"].tolist())}
            lo = np.ones((len(place), positives), np.int64)
            hi = np.zeros((len(place), positives), np.int64)  # lo > hi: no such positive
            for k in row["known"]:
                i, j, p = place[k["anchor"]], k["prank"] - 1, k["score"]
                lo[i, j], hi[i, j] = -(-low * p // 100), high * p // 100
            found = {k: [] for k in ("anchor", "aid", "prank", "vec_id", "row", "score")}
            for at in range(0, len(av), TABLES):
                some = slice(at, at + TABLES)
                s = scores(subset_sums(av[some], groups, kind), c["planes"]).T.astype(np.int64)
                least = np.where(lo[some] <= hi[some], lo[some], np.iinfo(np.int64).max).min(axis=1)
                out = np.iinfo(np.int64).min + 1
                s = np.where((c["labels"][None, :] == a["alabels"][some][:, None]) | (s < least[:, None]), out, s)
                live = np.flatnonzero((s > out).any(axis=1))
                if not len(live):
                    continue
                s = s[live]
                order = np.argsort(-s, axis=1, kind="stable")
                s = np.take_along_axis(s, order, 1)
                rows_, l, h = live + at, lo[live + at], hi[live + at]
                for j in range(positives):
                    start = (s > h[:, j][:, None]).sum(axis=1)
                    span = start[:, None] + np.arange(negatives)[None, :]
                    inside = span < s.shape[1]
                    span = np.minimum(span, s.shape[1] - 1)
                    got = np.take_along_axis(s, span, 1)
                    i, r = np.nonzero(inside & (got >= l[:, j][:, None]) & (got <= h[:, j][:, None]))
                    pick = order[i, span[i, r]]
                    found["anchor"].append(a["arows"][rows_[i]])
                    found["aid"].append(a["aids"][rows_[i]])
                    found["prank"].append(np.full(len(i), j + 1))
                    found["vec_id"].append(c["ids"][pick])
                    found["row"].append(c["rows"][pick])
                    found["score"].append(got[i, r])
            if found["row"]:
                out = {k: np.concatenate(v) for k, v in found.items()}
                out["prank"] = out["prank"].astype(np.int32)
                yield out
    ranked = Window.partitionBy("anchor", "prank").orderBy(F.desc("score"), "vec_id", "row")
    negative = (map_batches(meet(ablocks.join(listed, "ab")), find_negatives, "anchor long, aid long, prank int, vec_id long, row long, score long")
                .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives))
    return (negative.join(best.select("anchor", "prank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), ["anchor", "prank"])
            .select(F.col("aid").alias("anchor_id"), "positive_id", F.col("prank").alias("positive_rank"), "rank", F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
