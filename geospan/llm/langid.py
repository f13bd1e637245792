"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geospan.llm.common import code_points, held_out, map_batches, process_state, slices

BITS = 14
BUCKETS = 1 << BITS
#: Odd multipliers of the n-gram hash.
MIX = np.array([40503, 27655, 10007], dtype=np.uint16)


def _letters() -> np.ndarray:
    """code point -> a 16-bit code of its lower-case letter; all that isn't a letter has code 0."""
    out = np.zeros(0x110000, np.uint16)
    code = np.random.RandomState(7).randint(1, 1 << 16, 0x110000).astype(np.uint16)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            out[cp] = code[ord(low)] if len(low) == 1 else code[cp]
    return out


def ngram_buckets(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(buckets of the 2- and 3-grams that start at each place, edges, letters of each text).

    Whole texts over lower-case letters; a run of anything else counts as one blank.  Text i owns
    the places edges[2i] to edges[2i + 1] of either list; blanks around each text keep n-grams of
    two texts out of these ranges."""
    table = process_state("letters", _letters)
    cps, at = code_points([" " + t + "   " for t in texts])
    c = table[cps]
    letter = c != 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    first, last = at[:-1], at[1:]
    for place in (first, last - 3, last - 2, last - 1):
        keep[place] = True
    places = np.concatenate([[0], np.cumsum(keep)])
    c = c[keep]
    letters = np.add.reduceat(letter, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    edges = np.stack([places[first], places[last] - 2], axis=1).ravel()
    pair = c[:-1] * MIX[0] ^ c[1:] * MIX[1]
    triple = pair[:-1] * MIX[2] ^ c[2:] * MIX[1]
    return [(g ^ g >> np.uint16(7)) * MIX[0] >> np.uint16(16 - BITS) for g in (pair, triple)], edges, letters


@dataclass
class LanguageModel:
    """langs in order and log_prob[l, bucket].  All languages are equally likely beforehand: a short
    text should not go to the largest one."""
    langs: list[str]
    log_prob: np.ndarray
    #: Of each language, over its labelled texts: the mean log-probability of an n-gram, the variance of one
    #: n-gram about its text's mean, and the variance of texts' means that this doesn't explain.
    usual: np.ndarray | None = None

    def strangeness(self, texts: list[str]) -> np.ndarray:
        """How many standard deviations the mean log-probability of a text's n-grams lies below what is usual for the
        language that fits it best; 0 where there is nothing to compare."""
        if self.usual is None or not self.langs or not texts:
            return np.zeros(len(texts))
        total, _, count = self.sums(texts)
        best = total.argmax(axis=1)
        mean, one, rest = self.usual[best].T
        with np.errstate(divide="ignore", invalid="ignore"):
            far = (mean - total[np.arange(len(texts)), best] / count) / np.sqrt(one / count + rest)
        return np.where((count > 0) & np.isfinite(far), far, 0.0)

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log-probability by text and language, letters, n-grams) of whole texts."""
        grams, edges, letters = ngram_buckets(texts)
        total = np.zeros((len(texts), len(self.langs)))
        for g in grams:
            g = g.astype(np.intp)
            for k, row in enumerate(self.log_prob):
                total[:, k] += np.add.reduceat(np.append(row.take(g), 0.0), edges)[::2]
        return total, letters, 2 * (edges[1::2] - edges[::2])

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(language, posterior probability) of whole texts; `und` and 0 where nothing was learned
        or a text has no letter.  Ties go to the language that sorts first."""
        if not self.langs or not texts:
            return ["und"] * len(texts), np.zeros(len(texts))
        total, letters, _ = self.sums(texts)
        best = total.argmax(axis=1)
        score = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        ok = letters > 0
        return [self.langs[b] if k else "und" for b, k in zip(best.tolist(), ok.tolist())], np.where(ok, score, 0.0)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_per_lang: int = 3000, smoothing: float = 0.5, with_usual: bool = False) -> LanguageModel:
    """Learn from the texts of non-null language outside the held-out fifth.

    max_per_lang bounds the labelled rows that are used of each language (about; they are picked by
    a hash of their id).  Counting runs in Spark: each task sends its own n-gram counts, summed by
    (language, bucket); the driver gets languages x 16384 numbers at most.  ``with_usual`` also measures how well the
    labelled texts fit their own language, which ``keep_known`` needs.
    """
    doc_id = F.col(id_col).cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LanguageModel([], np.zeros((0, BUCKETS)))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, max_per_lang / n))])
    picked = rows.where((F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 20)) / float(1 << 20)) < share[F.col("lang")])

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch, texts in slices(batches, "text"):
            lang = batch.column(1).to_pylist()
            grams, edges, _ = ngram_buckets(texts)
            for i, one in enumerate(lang):
                for g in grams:
                    sums[one] = sums.get(one, 0) + np.bincount(g[edges[2 * i]:edges[2 * i + 1]], minlength=BUCKETS)
        for one, n in sums.items():
            seen = np.flatnonzero(n)
            yield {"lang": [one] * len(seen), "bucket": pa.array(seen), "n": pa.array(n[seen])}

    counted = map_batches(picked.select("text", "lang"), count, "lang string, bucket long, n long")
    langs = sorted(sizes)
    counts = np.zeros((len(langs), BUCKETS))
    for r in counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():
        counts[langs.index(r["lang"]), r["bucket"]] = r["n"]
    probs = counts + smoothing
    model = LanguageModel(langs, np.log(probs / probs.sum(axis=1, keepdims=True)))
    if with_usual:
        model.usual = _usual(picked, model)
    return model


def _usual(picked: DataFrame, model: LanguageModel) -> np.ndarray:
    """What is usual for each language, from its labelled texts; a row per language reaches the driver."""
    shared = picked.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        m = shared.value
        for batch, texts in slices(batches, "text"):
            grams, edges, _ = ngram_buckets(texts)
            number = {x: k for k, x in enumerate(m.langs)}
            rows = [number[x] for x in batch.column(1).to_pylist()]
            out = {"lang": [], "n": [], "mean": [], "variance": []}
            for i, k in enumerate(rows):
                p = np.concatenate([m.log_prob[k].take(g[edges[2 * i]:edges[2 * i + 1]].astype(np.intp)) for g in grams])
                if len(p):
                    for name, v in (("lang", k), ("n", len(p)), ("mean", float(p.mean())), ("variance", float(p.var()))):
                        out[name].append(v)
            yield out
    seen = map_batches(picked.select("text", "lang"), measure, "lang int, n long, mean double, variance double")
    share = F.col("variance") / F.col("n")
    out = np.zeros((len(model.langs), 3))
    out[:, 1] = 1.0
    for r in seen.groupBy("lang").agg(F.avg("mean").alias("m"), F.avg("variance").alias("v"), F.var_pop("mean").alias("s"), F.avg(share).alias("e")).collect():
        out[r["lang"]] = r["m"], r["v"], max(0.0, r["s"] - r["e"])
    return out


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row; null text and texts without letters are `und`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch, texts in slices(batches, "text", 1 << 20):
            lang, score = shared.value.predict(texts)
            yield {"doc_id": batch.column(0), "lang_pred": lang, "score": pa.array(score)}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, model: LanguageModel, text_col: str = "text", min_score: float = 0.5, most_strange: float = 15.0) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with at least ``min_score`` and is one that was learned:
    texts that lie over ``most_strange`` standard deviations below what is usual for the best language (``strangeness``;
    needs a model ``with_usual``) are in another one, or in none.  Null texts and texts without letters go."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch, texts in slices(batches, text_col, 1 << 20):
            lang, score = shared.value.predict(texts)
            keep = np.array([x != "und" for x in lang], dtype=bool) & (score >= min_score) & (shared.value.strangeness(texts) <= most_strange)
            yield batch.filter(pa.array(keep))
    return docs.mapInArrow(run, docs.schema)
