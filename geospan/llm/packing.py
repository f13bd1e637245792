"""Best-fit packing of tokenised documents into sequences, planned by bin completion.

Only piece lengths matter to a packing, and there are at most ``capacity`` of them.  So Spark
counts the lengths, a branch-and-bound search plans on these counts (its work does not depend on
the number of rows), and Spark hands each piece its place by its rank among pieces of its length.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from operator import neg

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geospan.llm.common import keyed_text, map_batches, process_state, slices


def byte_encoder(ranks_path: str, pattern: str, end_of_text: int):
    """text -> ids (uint32) of the byte-level vocabulary; its end-of-text string in a text is that
    one token, as the tokenizers library reads it."""
    import base64

    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    mark = "<|endoftext|>"

    def ordinary(text):
        return np.asarray(coder.encode_ordinary(text), dtype="<u4")

    def encode(text):
        if mark not in text:
            return ordinary(text)
        parts = [ordinary(p) for p in text.split(mark)]
        out = [parts[0]]
        for p in parts[1:]:
            out += [np.array([end_of_text], "<u4"), p]
        return np.concatenate(out)
    return encode


def tokenised_pieces(docs: DataFrame, ranks_path: str, pattern: str, end_of_text: int = 50256, end_id: int = 2,
                     capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and ``end_id``, cut into
    pieces of ``capacity`` where it is longer; its first piece takes what doesn't fill one."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids

    def run(batches):
        encode = process_state(f"byte_encoder {ranks_path}", lambda: byte_encoder(ranks_path, pattern, end_of_text))
        for batch, texts in slices(batches, "text"):
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32") + ("ids",) * with_ids}
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                ids = np.append(encode(text), np.uint32(end_id)).astype("<u4")
                head = len(ids) % capacity or capacity
                edges = [0, *range(head, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    out["doc_id"].append(doc_id)
                    out["piece"].append(k)
                    out["start"].append(a)
                    out["length"].append(b - a)
                    out["ids_crc32"].append(zlib.crc32(ids[a:b].tobytes()))
                    if with_ids:
                        out["ids"].append(ids[a:b].tolist())
            yield out
    return map_batches(keyed_text(docs, id_col, text_col), run, schema)


def completion(room: int, have: list[int], effort: int | None = 20_000) -> list[int]:
    """Lengths, largest first, that fill ``room`` with the least waste out of ``have`` (counts by length).

    The best-fit filling is the first incumbent.  The search enumerates fillings by descending
    length; it leaves out dominated ones (a filling to which another length could be added, and one
    whose next length repeats a choice already tried at that place) and branches that can't beat
    the incumbent's waste; a filling without waste ends it.  ``effort`` bounds the nodes visited (None: no bound),
    after which the incumbent stands: a fuller bin may be missed, never a piece.
    """
    def greedy(room, top):
        out = []
        while room > 0 and top > 0:
            top = min(top, room)
            while top and have[top] <= out.count(top):
                top -= 1
            if top:
                out.append(top)
                room -= top
        return out

    best = greedy(room, room)
    waste, left = room - sum(best), math.inf if effort is None else effort
    if not waste:
        return best
    lengths = [n for n in range(room, 0, -1) if have[n]]  # in falling order
    spare = [have[n] for n in lengths]
    place = {n: k for k, n in enumerate(lengths)}

    def search(room, first, chosen, rest):
        """Fillings of ``room`` by lengths from place ``first`` on; ``rest``: sum of what is spare."""
        nonlocal best, waste, left
        if room < waste:
            best, waste = chosen.copy(), room
        exact = place.get(room, -1)
        if exact >= first and spare[exact]:
            best, waste = [*chosen, room], 0
        # what is still to come can't fill more than there is
        if room - rest >= waste:
            return
        for k in range(max(first, bisect_left(lengths, -room, key=neg)), len(lengths)):
            if not waste or left <= 0:
                return
            if spare[k]:
                left -= 1
                n = lengths[k]
                spare[k] -= 1
                chosen.append(n)
                search(room - n, k, chosen, rest - n)
                chosen.pop()
                spare[k] += 1

    search(room, 0, [], sum(n * c for n, c in zip(lengths, spare)))
    return best


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """A lower bound: for every size k, pieces over capacity - k have sequences of their own, those over half fill
    one each, and what of the pieces from k to a half doesn't fit beside the latter needs more."""
    have = np.zeros(capacity + 1, dtype=object)
    for n, c in counts.items():
        have[n] = c
    number, total = np.cumsum(have), np.cumsum(have * np.arange(capacity + 1))
    half, best = capacity // 2, 0
    for k in range(half + 1):
        alone = number[capacity] - number[capacity - k]
        wide = number[capacity - k] - number[half]
        room = wide * capacity - (total[capacity - k] - total[half])
        small = total[half] - (total[k - 1] if k else 0)
        best = max(best, alone + wide + max(0, -(-(small - room) // capacity)))
    return best


def branch(counts: dict[int, int], capacity: int, most: int, effort: int | None = 100_000) -> list[list[int]] | None:
    """Fillings that pack all pieces into ``most`` sequences, by branch-and-bound over sequences; None if there are none,
    or if ``effort`` nodes (None: no bound) don't tell.

    The largest piece left is in some sequence: each branch is one of the fillings around it, the fuller ones
    first.  Branches whose waste, with that before them, is over what ``most`` sequences may waste in all are cut, and
    so are dominated fillings (a larger spare piece could take the place of a smaller one, or be added) and states that have
    failed before."""
    lengths = sorted((n for n, c in counts.items() if c), reverse=True)
    spare = [counts[n] for n in lengths]
    left = math.inf if effort is None else effort
    failed: dict[tuple, int] = {}

    def fillings(room, top, waste):
        found = []

        def fill(room, first, chosen):
            nonlocal left
            left -= 1
            if left < 0:
                return
            bigger = len(lengths)  # the largest spare piece that fits: it may be added
            for k in range(first, len(lengths)):
                if spare[k] and lengths[k] <= room:
                    bigger = k
                    break
            if bigger == len(lengths) or room <= waste:
                fits = next((k for k in range(top, len(lengths)) if spare[k] and lengths[k] <= room), None)
                if room <= waste and fits is None and not any(
                        spare[k] and k not in chosen and any(lengths[k] > lengths[c] >= lengths[k] - room for c in chosen) for k in range(top, len(lengths))):
                    found.append((room, tuple(chosen)))
            for k in range(bigger, len(lengths)):
                if spare[k] and lengths[k] <= room:
                    spare[k] -= 1
                    chosen.append(k)
                    fill(room - lengths[k], k, chosen)
                    chosen.pop()
                    spare[k] += 1
        fill(room, top, [])
        return sorted(set(found))

    def solve(bins, waste):
        top = next((k for k, c in enumerate(spare) if c), None)
        if top is None:
            return []
        state = tuple(spare)
        if waste < 0 or not bins or left < 0 or failed.get(state, -1) >= bins:
            return None
        spare[top] -= 1
        for room, chosen in fillings(capacity - lengths[top], top, waste):
            for k in chosen:
                spare[k] -= 1
            rest = solve(bins - 1, waste - room)
            for k in chosen:
                spare[k] += 1
            if rest is not None:
                spare[top] += 1
                return [[lengths[top], *(lengths[k] for k in chosen)], *rest]
        spare[top] += 1
        failed[state] = max(failed.get(state, -1), bins)
        return None
    return solve(most, most * capacity - sum(n * c for n, c in counts.items()))


#: Pieces of a part of the plan that is searched anew as a whole; recursion goes as deep as it has sequences.
TAIL = 300


def plan(counts: dict[int, int], capacity: int = 1024, effort: int | None = 20_000) -> list[tuple[list[int], int]]:
    """[(lengths of one sequence, number of such sequences)], in which every piece has a place.

    The incumbent takes the largest length left, completes it, and repeats that filling as often as the counts
    allow; each step uses up a length or a remainder of one, so there are few steps.  Where it has more
    sequences than ``least_sequences``, a branch-and-bound over sequences tries to save one, and another: over all of them if
    there are at most TAIL pieces, else over the last ones, which hold what was left over.  ``effort`` bounds the nodes of each
    search; with None plans of up to TAIL pieces are optimal, and slow in the worst case.
    """
    have = [0] * (capacity + 1)
    for n, c in counts.items():
        have[n] = c
    out = []
    for top in range(capacity, 0, -1):
        while have[top]:
            have[top] -= 1
            filling = [top, *completion(capacity - top, have, effort)]
            have[top] += 1
            times = min(have[n] // filling.count(n) for n in set(filling))
            for n in filling:
                have[n] -= times
            out.append((filling, times))
    spare = sum(t for _, t in out) - least_sequences(counts, capacity)
    while spare > 0:
        tail, pieces = [], 0
        while out and pieces + len(out[-1][0]) <= TAIL:
            filling, times = out.pop()
            some = min(times, (TAIL - pieces) // len(filling))
            tail += [filling] * some
            pieces += some * len(filling)
            if some < times:
                out.append((filling, times - some))
                break
        held: dict[int, int] = {}
        for filling in tail:
            for n in filling:
                held[n] = held.get(n, 0) + 1
        found = branch(held, capacity, len(tail) - 1, effort) if len(tail) > least_sequences(held, capacity) else None
        out += [(filling, 1) for filling in found or tail[::-1]]
        if found is None:
            break
        spare -= 1
    return out


def pack(pieces: DataFrame, capacity: int = 1024, effort: int | None = 20_000) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32, ...) with sequence_id and offset.

    Sequences are filled from 0 without gaps and hold at most ``capacity`` ids.  The rank of a piece
    among those of its length is counted in buckets; a length that many pieces share gets as many
    buckets as its share asks for, so none holds more than about 1/(4 x shuffle partitions) of all
    rows.  Rows that repeat another are pieces of their own.  No rows: no sequences.  ``effort``: see ``plan``.
    """
    spark = pieces.sparkSession
    pieces = pieces.checkpoint()  # tokenised once, read three times
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    most = max(1.0, sum(counts.values()) / (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cuts = F.create_map(*[F.lit(int(x)) for n, c in counts.items() for x in (n, math.ceil(c / most))])
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), cuts[F.col("length").cast("int")]))
    sizes = dealt.groupBy(F.col("length").alias("_length"), F.col("_bucket").alias("_b")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (dealt.withColumn("_rank", F.row_number().over(inside) - 1)
              .join(sizes, (F.col("length") == F.col("_length")) & (F.col("_bucket") == F.col("_b")))
              .withColumn("_rank", F.col("_rank") + F.col("_before"))
              .drop("_bucket", "_b", "_length", "_before"))

    slots: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for filling, times in plan(counts, capacity, effort):
        at = 0
        for n in filling:
            slots.setdefault(n, []).append((used.get(n, 0), sequence, at))
            used[n] = used.get(n, 0) + times
            at += n
        sequence += times
    table = spark.sparkContext.broadcast({n: np.array(s, dtype=np.int64).T for n, s in slots.items()})
    schema = ranked.drop("_rank").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def place(batches):
        for batch in batches:
            names = batch.schema.names
            length, rank = (np.asarray(batch.column(names.index(c))) for c in ("length", "_rank"))
            seq, off = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length).tolist():
                rows = np.flatnonzero(length == n)
                first, base, at = table.value[n]
                k = np.searchsorted(first, rank[rows], side="right") - 1
                seq[rows], off[rows] = base[k] + rank[rows] - first[k], at[k]
            kept = [batch.column(i) for i, c in enumerate(names) if c != "_rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(seq), pa.array(off)],
                                             names=[*(c for c in names if c != "_rank"), "sequence_id", "offset"])
    return ranked.mapInArrow(place, schema)
