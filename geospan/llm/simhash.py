"""SimHash near-duplicates: 64-bit fingerprints, linked by a bit-sliced comparison."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geospan.llm.common import keyed_text, map_batches, slices
from geospan.llm.components import connected_components

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def simhash(text: str, shingle: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word shingles, as an unsigned number; 0 without words."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII only, both of them
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[:n - shingle + 1].tolist(), ends[shingle - 1:].tolist())],
                 dtype="<u8")
    count = np.zeros(64, np.int64)
    for i in range(0, len(h), 4096):  # bounded for texts of any length
        bits = np.unpackbits(h[i:i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row, as a signed long."""
    def run(batches):
        for batch, texts in slices(batches, "text"):
            fp = np.array([simhash(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield {"doc_id": batch.column(0), "fp": pa.array(fp)}
    return map_batches(keyed_text(docs, id_col, text_col), run, "doc_id long, fp long")


def _planes(fp: np.ndarray) -> np.ndarray:
    """(64, words): bit b of every fingerprint, row after row, in plane b; a spare word follows."""
    rows = np.zeros((-(-len(fp) // 64) + 1) * 64, np.uint64)
    rows[:len(fp)] = fp
    bits = np.unpackbits(rows.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _over(counter: list[np.ndarray], limit: int) -> np.ndarray:
    """Lanes whose vertical counter is above ``limit``."""
    more, same = np.zeros_like(counter[0]), np.full_like(counter[0], ALL)
    for j in range(len(counter) - 1, -1, -1):
        if limit >> j & 1:
            same &= counter[j]
        else:
            more |= same & counter[j]
            same &= ~counter[j]
    return more


def near_pairs(fp: np.ndarray, group: np.ndarray, radius: int):
    """Yield arrays (i, j), i < j, of rows of one group at most ``radius`` bits apart.

    Rows of a group are neighbours.  Row i meets row i + d for d = 1, 2, ...: each bit plane is
    laid over itself moved by d lanes, so one word operation compares 64 pairs.  Differing bits
    are added into vertical carry-save counters; words in which every lane is over the radius
    are given up, and all words of a step are once none is left.
    """
    size = np.bincount(group)[group]
    place = np.arange(len(group)) - np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1])[group]
    rest = size - 1 - place  # rows of the same group that follow
    planes, d = _planes(fp), 0
    lanes = planes.shape[1] * 64
    moved = planes
    for d in range(1, int(rest.max(initial=0)) + 1):
        moved = moved >> np.uint64(1) | np.concatenate([moved[:, 1:], np.zeros((64, 1), np.uint64)], axis=1) << np.uint64(63)
        here = np.zeros(lanes, bool)
        here[:len(rest)] = rest >= d
        alive = np.packbits(here, bitorder="little").view(np.uint64)
        words = np.flatnonzero(alive)
        alive = alive[words]
        counter = [np.zeros(len(words), np.uint64) for _ in range(radius.bit_length() + 1)]
        gone = np.zeros(len(words), np.uint64)
        for b in range(0, 64, 8):
            left, right = planes[b:b + 8, words], moved[b:b + 8, words]
            for x in left ^ right:
                for c in counter:
                    x, c[:] = c & x, c ^ x
                gone |= x
            keep = alive & ~(gone | _over(counter, radius))
            going = keep != 0
            if not going.all():
                words, alive, gone = words[going], keep[going], gone[going]
                counter = [c[going] for c in counter]
                if not len(words):
                    break
            else:
                alive = keep
        if len(words):
            lane = np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").reshape(len(words), 64)
            w, k = np.nonzero(lane)
            i = words[w] * 64 + k
            yield i, i + d


def _links(radius: int):
    """Streams (mask, value, fp) rows sorted by group; gives (a, b): every fingerprint with the
    first one that its group connects it to."""
    def run(batches):
        held = None
        for batch in _with_end(batches):
            if batch is not None:
                rows = np.stack([np.asarray(batch.column(i)) for i in range(3)])
                held = rows if held is None else np.concatenate([held, rows], axis=1)
                new = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0))
                if not len(new):
                    continue  # a group has a bounded number of rows
                done, held = held[:, :new[-1] + 1], held[:, new[-1] + 1:]
            else:
                done, held = held, None
            if done is None or done.shape[1] < 2:
                continue
            edge = (np.diff(done[0]) != 0) | (np.diff(done[1]) != 0)
            group = np.concatenate([[0], np.cumsum(edge)])
            parent = np.arange(len(group))

            def find(x):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x
            for i, j in near_pairs(done[2].view(np.uint64), group, radius):
                for x, y in zip(i[parent[i] != parent[j]].tolist(), j[parent[i] != parent[j]].tolist()):
                    x, y = find(x), find(y)
                    if x != y:
                        parent[max(x, y)] = min(x, y)
            tied = np.flatnonzero(parent != np.arange(len(parent)))
            if len(tied):
                root = np.array([find(x) for x in tied.tolist()])
                yield {"a": pa.array(done[2][tied]), "b": pa.array(done[2][root])}
    return run


def _with_end(batches):
    yield from batches
    yield None


def _parts(mask: int, n: int) -> list[int]:
    """Cut the bits that ``mask`` leaves free into n runs; each run joined with the mask."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(free, dtype=int), n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def link_fingerprints(distinct: DataFrame, radius: int = 2, most: int = 2048) -> DataFrame:
    """(a, b) edges that connect what chains of at most ``radius`` differing bits connect.

    distinct: fp long, no value twice.  Two values within the radius agree wholly on one of
    radius + 1 parts of their bits, so only values that share a part meet.  A part that more than
    ``most`` values share is cut again in its free bits (the same argument holds), until it is
    small; the free bits shrink each time, which bounds a group by 2^free whatever the data.
    """
    level, todo, edges = [0], distinct.select("fp", F.lit(0).cast("long").alias("mask")), None
    while True:
        cut = {m: _parts(m, radius + 1) for m in level}
        pairs = [F.lit(x) for m, parts in cut.items() for x in (_signed(m), [_signed(p) for p in parts])]
        todo = (todo.select("fp", F.explode(F.element_at(F.create_map(*pairs), F.col("mask"))).alias("mask"))
                .withColumn("value", F.col("fp").bitwiseAND(F.col("mask"))).checkpoint())
        count = todo.groupBy(F.col("mask").alias("cm"), F.col("value").alias("cv")).agg(F.count("*").alias("n")).where("n > 1")
        met = todo.join(count, (F.col("mask") == F.col("cm")) & (F.col("value") == F.col("cv"))).select("mask", "value", "fp", "n")
        level = [p for parts in cut.values() for p in parts]
        last = min(64 - bin(p).count("1") for p in level) <= most.bit_length() - 1
        small = met if last else met.where(F.col("n") <= most)
        small = small.repartition("mask", "value").sortWithinPartitions("mask", "value", "fp").select("mask", "value", "fp")
        found = map_batches(small, _links(radius), "a long, b long")
        edges = found if edges is None else edges.union(found)
        if last or count.where(F.col("n") > most).isEmpty():
            return edges
        todo = met.where(F.col("n") > most).select("fp", "mask").checkpoint()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id): the smallest id reachable over links of at most ``radius`` bits.

    Null texts are empty; texts without words have fingerprint zero and link like any other.
    Rows without an id get a row, and never name a component.  Rows that repeat an id stay.
    Equal fingerprints are one node, so a group of any number of copies is one row from the first
    (partial) aggregate on.  An empty table gives no rows.
    """
    fps = fingerprints(docs, id_col, text_col, shingle).checkpoint()
    first = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(link_fingerprints(first.select("fp"), radius))
    by_fp = first.join(roots, first.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = by_fp.groupBy("root").agg(F.min("first").alias("component_id"))
    named = by_fp.join(least, "root").select(F.col("fp").alias("key"), "component_id")
    return fps.join(named, fps.fp == F.col("key"), "left").select("doc_id", "fp", "component_id")


def hex64(fp) -> "F.Column":
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
