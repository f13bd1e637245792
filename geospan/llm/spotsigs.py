"""SpotSigs document fingerprints.

A spot signature is a common word (the anchor) with the content words that follow it.  A text's
fingerprint is the set of its signatures, kept as sorted 32-bit hashes; texts are compared by the
Jaccard likeness of their sets, which their lengths alone often decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geospan.llm.common import Memo, keyed_text, map_batches, process_state, slices
from geospan.llm.components import connected_components

#: Common words of English, German, French and Spanish that start signatures (fixed values).
ANCHORS = frozenset("""
a about all also an and are as at be been but by can could did do for from had has have he her his how if in into is it its
may more no not of on one or she so some than that the their them then there these they this to was we were what when which
who will with would you
als am auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich ihr im ist mit nach nicht
noch nur oder sein sich sie sind über um und von war wie wird zu zum zur
au aux avec ce cette dans de du elle en est et il ils je la le les leur lui mais ne nous on ou où par pas plus pour qu que qui
sa se ses si son sont sur un une vous
al como con cuando del desde dos el ella ellos entre era esta este fue ha hay las lo los más mi muy o para pero por porque
quien sin sobre su sus también tiene todo y ya
""".split())
CHAIN = 2
EDGES = ".,;:!?\"'()[]{}<>«»„“”‘’…–—-*_|"


def _word(raw: str) -> tuple[int, bool]:
    """(hash, is an anchor) of a raw word; hash 0 for one that is punctuation only."""
    import xxhash

    bare = raw.lower().strip(EDGES)
    return (xxhash.xxh32_intdigest(bare.encode("utf-8", "surrogatepass")) or 1, bare in ANCHORS) if bare else (0, False)


def _mix(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    h = (h ^ x) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ h >> np.uint64(29)


def signature_sets(texts: list[str], chain: int = CHAIN) -> list[np.ndarray]:
    """The sorted signature hashes (uint32) of whole texts.

    An anchor's chain is the next ``chain`` content words; at the end of a text, those there are.  A
    text without any such signature is taken as one signature of all its words, one without words
    by its characters; only the empty text has an empty set.
    """
    import xxhash

    memo = process_state("spotsigs words", lambda: Memo(_word, 600_000))
    found = [[w for w in map(memo.__getitem__, t.split()) if w[0]] for t in texts]
    flat = [w for words in found for w in words]
    size = np.array([len(words) for words in found], np.int64)
    end = np.cumsum(size)
    h = np.fromiter((w[0] for w in flat), np.uint64, len(flat))
    anchor = np.fromiter((w[1] for w in flat), bool, len(flat))
    owner = np.repeat(np.arange(len(texts)), size)
    content = np.flatnonzero(~anchor)
    at = np.flatnonzero(anchor)
    sig = _mix(np.full(len(at), 7, np.uint64), h[at])
    some = np.zeros(len(at), bool)
    if len(content):
        place = np.searchsorted(content, at)
        for k in range(chain):
            nxt = content[np.minimum(place + k, len(content) - 1)]
            there = (place + k < len(content)) & (nxt < end[owner[at]] if len(at) else np.zeros(0, bool))
            sig = np.where(there, _mix(sig, h[nxt]), sig)
            some |= there
    sig, of = sig[some] >> np.uint64(32), owner[at[some]]
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    out = []
    for i, text in enumerate(texts):
        own = np.unique(sig[cuts[i]:cuts[i + 1]]).astype(np.uint32)
        if not len(own) and text:
            words = h[end[i] - size[i]:end[i]]
            raw = words.tobytes() if len(words) else text.encode("utf-8", "surrogatepass")
            own = np.array([xxhash.xxh32_intdigest(raw, 1)], np.uint32)
        out.append(own)
    return out


def to_text(signatures: np.ndarray) -> str:
    """Eight hex digits for each signature, in order."""
    return signatures.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard likeness of two signature sets; 1 for two empty ones.  Sets whose lengths alone put it
    under ``least`` count as 0 without being compared."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    small, large = sorted((len(a), len(b)))
    if small / large < least:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    value = common / (len(a) + len(b) - common)
    return value if value >= least else 0.0


def _in_order(rows: DataFrame) -> tuple[DataFrame, str]:
    """``rows`` (doc_id, text) in partitions of descending doc_id, each but the last row's successor in
    its own partition: every range ends with a copy (``mark``) of the next range's first row.

    Ranges come from approximate quantiles of the ids, so there are as many as shuffle partitions;
    only these bounds and one id per range pass through the driver.  Rows without an id come after
    all others, in a range of their own.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted({int(x) for x in rows.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.2 / parts)})
    steps = F.array(*[F.lit(x).cast("long") for x in bounds]) if bounds else F.array().cast("array<long>")
    # range 0 has the largest ids
    place = F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(F.size(F.filter(steps, lambda b: b > F.col("doc_id"))))
    ranged = rows.withColumn("part", place.cast("int"))
    heads = ranged.groupBy("part").agg(F.max("doc_id").alias("head")).orderBy("part").collect()  # a row per range
    if not heads:
        return ranged.withColumn("mark", F.lit(False)), ""
    ring = {heads[(k + 1) % len(heads)]["part"]: heads[k]["part"] for k in range(len(heads))}
    ids = [r["head"] for r in heads if r["head"] is not None]
    goes = F.create_map(*[F.lit(x) for pair in ring.items() for x in pair])
    first = ranged.where(F.col("doc_id").isin(ids) if ids else F.lit(False))
    if any(r["head"] is None for r in heads):
        first = first.union(ranged.where("doc_id is null"))
    first = (first.groupBy("part").agg(F.min("text").alias("text"), F.max("doc_id").alias("doc_id"))
             .select("doc_id", "text", goes[F.col("part")].alias("part"), F.lit(True).alias("mark")))
    return (ranged.withColumn("mark", F.lit(False)).unionByName(first)
            .repartitionByRange(len(heads), "part").sortWithinPartitions("part", "mark", F.desc_nulls_last("doc_id"), "text")), "part"


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text of a document is its own without the last floor(n / 2) code points, and as many
    of the next document's first ones (all, if there are fewer).  The next document has the next
    smaller doc_id (after the smallest: the largest); rows of one id are in order of their text,
    rows without one come last.  Null texts are empty.  A single document is its own next.
    """
    ordered, part = _in_order(keyed_text(docs, id_col, text_col))
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    if not part:
        return map_batches(ordered, lambda batches: iter(()), schema)

    def run(batches):
        import hashlib

        held = None  # the last row, which still lacks its next: (id, part, text, signatures)
        for batch, texts in slices(batches, "text", 2 << 20):
            ids, parts, marks = (batch.column(i).to_pylist() for i in (0, 2, 3))
            sets = signature_sets(texts)
            rows = [held] if held else []
            rows += list(zip(ids, parts, texts, sets, marks))
            held = rows.pop()
            out, edited = [], []
            for a, b in zip(rows, [*rows[1:], held]):
                if not a[4]:
                    half = len(a[2]) // 2
                    out.append((a, b))
                    edited.append(a[2][:len(a[2]) - half] + b[2][:half])
            if not out:
                continue
            edited_sets = signature_sets(edited)
            yield {"doc_id": [a[0] for a, _ in out], "n_chars": [len(a[2]) for a, _ in out],
                   "edited_sha256": [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
                   "fingerprint": [to_text(a[3]) for a, _ in out], "edited_fingerprint": [to_text(s) for s in edited_sets],
                   "near_edited": [likeness(a[3], s) for (a, _), s in zip(out, edited_sets)],
                   "near_next": [likeness(a[3], b[3]) for a, b in out]}
        # the last row of a partition is always a mark
    return map_batches(ordered.select("doc_id", "text", "part", "mark"), run, schema)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8) -> DataFrame:
    """(doc_id, component_id): the smallest id reachable over pairs of at least ``least`` likeness.

    Equal sets are one node.  Two sets of the wanted likeness have lengths within a factor of
    ``least``, so sets are dealt to length classes that grow by 1 / least, and meet only in their
    own and the next class.  There the rarest signatures of each set are its prefix: sets that
    share none of them can't be alike, so only sets with a common prefix signature are compared.
    """
    def run(batches):
        for batch, texts in slices(batches, "text"):
            yield {"doc_id": batch.column(0), "sigs": [s.astype(np.int64).tolist() for s in signature_sets(texts)]}
    rows = map_batches(keyed_text(docs, id_col, text_col), run, "doc_id long, sigs array<long>")
    rows = rows.withColumn("node", F.xxhash64("sigs")).checkpoint()
    sets = rows.groupBy("node").agg(F.first("sigs").alias("sigs"), F.min("doc_id").alias("first")).where("size(sigs) > 0").checkpoint()
    freq = sets.select(F.explode("sigs").alias("sig")).groupBy("sig").agg(F.count("*").alias("n"))
    ranked = (sets.select("node", F.size("sigs").alias("size"), F.explode("sigs").alias("sig")).join(freq, "sig")
              .withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy("n", "sig"))))
    prefix = ranked.where(F.col("place") <= F.col("size") - F.ceil(F.lit(least) * F.col("size")) + 1)
    group = F.floor(F.log("size") / float(np.log(1 / least))).cast("long")
    a = prefix.select(F.col("node").alias("a"), F.col("size").alias("sa"), "sig", F.explode(F.array(group, group + 1)).alias("g"))
    b = prefix.select(F.col("node").alias("b"), F.col("size").alias("sb"), "sig", group.alias("g"))
    met = a.join(b, ["sig", "g"]).where((F.col("a") != F.col("b")) & (F.least("sa", "sb") >= F.lit(least) * F.greatest("sa", "sb"))).select("a", "b").distinct()
    left, right = (sets.select(F.col("node").alias(k), F.col("sigs").alias("s" + k)) for k in "ab")
    common = F.size(F.array_intersect("sa", "sb"))
    alike = (met.join(left, "a").join(right, "b")
             .where(common >= F.lit(least) * (F.size("sa") + F.size("sb") - common)).select("a", "b"))
    roots = connected_components(alike)
    named = rows.select("doc_id", "node").join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root")).checkpoint()
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return named.join(smallest, "root").select("doc_id", "component_id")
