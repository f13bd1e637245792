"""Line dedup by a log-template tree."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geospan.llm.common import fresh, map_batches, slices

ANY = "<*>"
DIGIT = re.compile(rb"[0-9]")
#: Size of the filter of shared leaves: 1 MB, whatever the data.
FILTER_BITS = 1 << 23
#: Lines of fewer tokens have no variable fields but numbers, and must recur in more documents.
SHORT = 5
#: Lines of a leaf that are compared all with all; of more, those with a block of places in common.
FEW = 64
#: Characters of scripts that are written without spaces.
UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3000-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff])")


def _tokens(line: bytes, characters: bool = False) -> list[bytes]:
    """The tokens of a line, between ASCII white space (with ``characters``, each character of a
    script without spaces is one too); one that holds a digit is a variable field."""
    if characters and not line.isascii():
        line = UNSPACED.sub(r" \1 ", line.decode("utf-8", "surrogatepass").replace("\u3000", " ")).encode("utf-8", "surrogatepass")
    tokens = line.split()
    return tokens if not DIGIT.search(line) else [b"<*>" if DIGIT.search(t) else t for t in tokens]


def _parsed(text: str, depth: int, least_tokens: int, characters: bool = False):
    """(line_no, leaf, own, tokens) of the lines of a whole text that are long enough."""
    from xxhash import xxh64_intdigest

    for k, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
        tokens = _tokens(line, characters)
        if len(tokens) < SHORT and all(t == b"<*>" for t in tokens):  # different numbers don't recur
            tokens = line.split()
        if len(tokens) >= least_tokens:
            yield k, xxh64_intdigest(b" ".join(tokens[:depth]), len(tokens)), xxh64_intdigest(b" ".join(tokens), 42), tokens


def _signed(numbers: list[int]) -> pa.Array:
    return pa.array(np.array(numbers, np.uint64).view(np.int64))


def _filter(leaves: DataFrame) -> np.ndarray:
    """The bits that the leaves' hashes fall on, FILTER_BITS of them in all."""
    place = F.pmod(F.col("leaf"), F.lit(FILTER_BITS)) + 1
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in leaves.groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("b")).collect():
        part = np.frombuffer(r["b"], np.uint8)
        bits[(r["k"] - 1) * len(part):r["k"] * len(part)] = part
    return bits


def _several(lines: list[tuple[int, list[bytes]]], depth: int, share: float) -> dict[int, bytes]:
    """own -> general form, of the different lines (own, tokens) of one leaf that share a template.

    The first line left, by hash, gathers the lines of which ``share`` agrees with it; a place
    keeps the token that more than half of them have.  All lines left of which ``share`` agrees
    with that form take it, and the others go on without them, so neither a second template nor
    unrelated lines change the form.
    """
    size = len(lines[0][1])
    codes: dict[bytes, int] = {}
    lines = sorted(lines)
    grid = np.array([[codes.setdefault(t, len(codes) + 1) if t != b"<*>" else 0 for t in tokens] for _, tokens in lines], np.int32)
    words = [b"<*>", *codes]
    least = share * size
    # lines that agree in all but `apart` places have one of `apart` + 1 blocks of places in common, so a
    # line is only compared with those that share a block with it
    apart = size - int(np.ceil(least))
    blocks = []
    few = len(lines) <= FEW
    for places in np.array_split(np.arange(depth, size), apart + 1) if not few else ():
        parts, at = np.unique(grid[:, places], axis=0, return_inverse=True)
        at = at.reshape(-1)
        order = np.argsort(at, kind="stable")
        blocks.append((places, {p.tobytes(): k for k, p in enumerate(parts)}, order, np.searchsorted(at[order], np.arange(len(parts) + 1))))
    free, out = np.ones(len(lines), bool), {}

    def like(form):
        """The lines left of which the share agrees with a form, and how many places do."""
        found = []
        for places, names, order, edge in blocks:
            k = names.get(form[places].tobytes())
            if k is not None and (len(places) == 0 or form[places].all()):
                found.append(order[edge[k]:edge[k + 1]])
        if few:
            rows = np.flatnonzero(free)
        else:
            rows = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
            rows = rows[free[rows]]
        same = ((grid[rows] == form) & (form > 0)).sum(axis=1)
        return rows[same >= least], same[same >= least]
    for first in range(len(lines)):
        while free[first]:
            group, same = like(grid[first])
            if (group != first).sum() == 0:
                break
            middle = np.sort(grid[group], axis=0)[len(group) // 2]  # where what more than half have is
            form = np.where((grid[group] == middle).sum(axis=0) * 2 > len(group), middle, 0)
            taken, _ = like(form)
            if len(taken) < 2:  # then with the nearest line alone
                near = group[group != first][same[group != first].argmax()]
                form = np.where(grid[near] == grid[first], grid[first], 0)
                taken, _ = like(form)
            masked = b" ".join(words[c] for c in form)
            out.update((lines[i][0], masked) for i in taken)
            free[taken] = False
            if not len(taken):
                break
    return out


def _general(chosen: DataFrame, depth: int, share: float) -> DataFrame:
    """(gl, go, general): the leaf, own hash and form's hash of the lines that ``_several`` gives a form."""
    from xxhash import xxh64_intdigest

    def forms(held):
        for own, general in _several(held, depth, share).items():
            yield own, xxh64_intdigest(general, 42)

    def run(batches):
        leaf, held = None, []
        for batch in batches:
            out = []
            for at, own, line in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if at != leaf:
                    out += [(leaf, *x) for x in forms(held)] if len(held) > 1 else []
                    leaf, held = at, []
                held.append((own, line.encode("utf-8", "surrogatepass").split(b" ")))
            yield {"gl": [x[0] for x in out], "go": [x[1] for x in out], "general": _signed([x[2] for x in out])}
        if len(held) > 1:
            out = list(forms(held))
            yield {"gl": [leaf] * len(out), "go": [x[0] for x in out], "general": _signed([x[1] for x in out])}
    rows = (chosen.select("leaf", "own", F.array_join("tokens", " ").alias("line"))
            .repartition("leaf").sortWithinPartitions("leaf"))
    return map_batches(rows, run, "gl long, go long, general long")


def line_templates(docs: DataFrame, depth: int = 3, least_tokens: int = 5, share: float = 0.7,
                   id_col: str = "doc_id", text_col: str = "text", several: bool = False,
                   characters: bool = False) -> DataFrame:
    """(doc, line_no, template, size): the template of every line of at least ``least_tokens`` tokens; doc is
    the id and the hash of the text, size the number of tokens, at most ``SHORT``.

    The tree has a fixed depth: a line falls by its token count and its first ``depth`` tokens to a
    leaf.  In a leaf a position keeps the token that more than half of its different lines have
    there and is a variable field otherwise; a line's template is its tokens with the fields that
    don't agree left open.  A line of which less than ``share`` agrees, or whose leaf has one line,
    is a template of its own.  The result does not depend on the order of lines.  With ``several``
    a leaf holds as many templates as its lines form (``_several``), not the one of its majority.  With ``characters``
    text in scripts without spaces is taken character by character.  Lines of fewer than ``SHORT``
    tokens are templates of their own.

    Lines travel as hashes.  The tokens are read again only of lines in leaves that have several,
    which a bit filter of fixed size (and then a join) tells; counting them is by (leaf, place,
    token) with partial aggregates over different lines, so a line that a third of the documents
    share is counted once.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).cast("string").alias("text"))

    def hashes(batches):
        for batch, texts in slices(batches, "text"):
            ids, hs = batch.column(0), batch.column(1)
            found = [(i, *x[:3], min(SHORT, len(x[3]))) for i, t in enumerate(texts) for x in _parsed(t, depth, least_tokens, characters)]
            at = pa.array([f[0] for f in found], pa.int64())
            yield {"id": ids.take(at), "h": hs.take(at), "line_no": [f[1] for f in found],
                   "leaf": _signed([f[2] for f in found]), "own": _signed([f[3] for f in found]),
                   "size": [f[4] for f in found]}
    slim = map_batches(rows, hashes, "id long, h long, line_no int, leaf long, own long, size int")
    slim = (slim if least_tokens < SHORT else slim.drop("size")).checkpoint()
    leaves = (slim.select("leaf", "own").distinct().groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1")).checkpoint()
    shared = docs.sparkSession.sparkContext.broadcast(_filter(leaves))

    def words(batches):
        bits = shared.value
        for _, texts in slices(batches, "text"):
            found = {}
            for t in texts:
                for _, leaf, own, tokens in _parsed(t, depth, max(SHORT, least_tokens), characters):
                    place = leaf % FILTER_BITS
                    if bits[place >> 3] >> (place & 7) & 1:
                        found[own] = (leaf, tokens)
            yield {"leaf": _signed([v[0] for v in found.values()]), "own": _signed(list(found)),
                   "tokens": [[t.decode("utf-8", "surrogatepass") for t in v[1]] for v in found.values()]}
    chosen = (map_batches(rows.select("text"), words, "leaf long, own long, tokens array<string>")
              .join(leaves.withColumnRenamed("leaf", "_leaf"), F.col("leaf") == F.col("_leaf"))
              .select("leaf", "own", "n", "tokens").dropDuplicates(["leaf", "own"]).checkpoint())
    if several:
        general = _general(chosen, depth, share)
    else:
        steady = (chosen.select("leaf", "n", F.posexplode("tokens").alias("place", "token"))
                  .groupBy("leaf", "place", "token").agg(F.count("*").alias("c"), F.first("n").alias("n"))
                  .where((F.col("c") * 2 > F.col("n")) & (F.col("token") != ANY)))  # one token of a place at most
        fixed = steady.groupBy("leaf").agg(F.map_from_entries(F.collect_list(F.struct("place", "token"))).alias("fixed"))
        masked = F.transform("tokens", lambda t, i: F.when(t == F.col("fixed")[i], t).otherwise(ANY))
        general = (chosen.join(fixed, "leaf").withColumn("masked", masked)
                   .withColumn("agree", F.size(F.filter("masked", lambda t: t != ANY)))
                   .where(F.col("agree") >= F.lit(share) * F.size("tokens"))
                   .select(F.col("leaf").alias("gl"), F.col("own").alias("go"),
                           F.xxhash64(F.array_join("masked", " ")).alias("general")))
    # hashed as `own` is, so a line that already is the general form has its template
    return (slim.join(general, (F.col("leaf") == F.col("gl")) & (F.col("own") == F.col("go")), "left")
            .select(F.struct("id", "h").alias("doc"), "line_no", F.coalesce("general", "own").alias("template"),
                    F.col("size") if least_tokens < SHORT else F.lit(SHORT).alias("size")))


def recurring_lines(docs: DataFrame, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text", **tree) -> DataFrame:
    """(doc, lines): of every document the lines to drop, which are those whose template is found in
    ``min_docs`` documents or more, except in the first (smallest id) of these.  A line of fewer
    than ``SHORT`` tokens needs ``min_docs`` more for every token that is missing."""
    found = line_templates(docs, id_col=id_col, text_col=text_col, **tree).checkpoint()
    spread = (found.groupBy("template").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("n"),
                                            (min_docs * (SHORT + 1 - F.min("size"))).alias("need"))
              .where((F.col("first") != F.col("last")) & (F.col("n") >= F.col("need"))).select("template", "first", "need"))
    if min_docs > 2 or tree.get("least_tokens", SHORT) < SHORT:
        spread = spread.checkpoint()
        # documents are only counted of lines that need more than two, dealt by (template, document)
        asked = found if min_docs > 2 else found.where(F.col("size") < SHORT)
        wide = (asked.select("template", "doc").distinct()
                .groupBy("template").agg(F.count("*").alias("n")).withColumnRenamed("template", "wt"))
        spread = (spread.join(wide, F.col("template") == F.col("wt"), "left")
                  .where((F.col("need") <= 2) | (F.col("n") >= F.col("need"))))
    # written first, so that the join below reads both sides from exchanges and a hot template's
    # lines can be split among tasks
    spread = spread.select(F.col("template").alias("t"), "first").checkpoint()
    return (found.join(spread, F.col("template") == F.col("t")).where(F.col("doc") != F.col("first"))
            .groupBy("doc").agg(F.collect_set("line_no").alias("lines")))  # a document's own lines


def drop_recurring(docs: DataFrame, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text",
                   lines_as: str = "n_lines", dropped_as: str = "n_dropped", **tree) -> DataFrame:
    """``docs`` with ``lines_as`` and ``dropped_as`` (names that it doesn't have), the numbers of lines there were and that were dropped,
    and the text without the latter.

    Lines are dropped as ``recurring_lines`` says; lines of fewer than ``least_tokens`` tokens always stay.  All columns and rows
    stay: rows without an id or text are passed on as they are (their count of lines is null for a
    null text), rows that repeat another lose the same lines, and an empty text has one empty line.
    """
    own, h, drop = (fresh(docs, x) for x in ("_doc", "_hash", "_drop"))
    known = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    drops = recurring_lines(known, min_docs, id_col, text_col, **tree).select(
        F.col("doc.id").alias(own), F.col("doc.h").alias(h), F.col("lines").alias(drop))
    joined = docs.join(drops, (F.col(id_col).cast("long") == F.col(own)) & (F.xxhash64(text_col) == F.col(h)), "left")
    parts = F.split(F.col(text_col), "\n")
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(drop, i)), "\n")
    return (joined.withColumn(lines_as, F.size(parts)).withColumn(dropped_as, F.coalesce(F.size(drop), F.lit(0)))
            .withColumn(text_col, F.when(F.col(drop).isNull(), F.col(text_col)).otherwise(kept)).drop(own, h, drop))
