"""Toxicity: a support vector machine on a subsequence string kernel with Nyström landmarks.

A sentence is a bag of units: its words, also without the characters set into them, letters
spelled out one by one joined to a word, adjacent words joined where a landmark's letters run on over the gap, and
overlapping windows of very long words.  The kernel
of two units counts their common subsequences of three characters (word ends are characters too),
each weighted by ``DECAY`` for every character it spans, up to ``SPAN``; so an insult with gaps or
inserted characters still meets its landmark.  A sentence is as toxic as its most toxic unit, and
a text as its most toxic sentence; the machine is trained on sentences in that sense: a toxic text
has to have one toxic unit, a clean text none.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geospan.llm.common import code_points, held_out, map_batches, process_state, slices

DECAY = 0.6
SPAN = 6
#: Kernel (0 to 1) with a toxic landmark that a unit must reach to be evidence at all.
FLOOR = 0.35
WINDOW = 24
OFFSETS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]

#: Letters of a landmark that must follow each other over a gap (of one as short as the first size, all), and the
#: characters that they and the gaps may take.
PIECES, GAPS = (4, 5), 14

SPELLED = re.compile(r"(?<!\S)\w(?:[ \t.*_-]+\w){2,}(?!\w)")
INSIDE = re.compile(r"[\W_]+")
EDGES = ".,;:!?\"'()[]{}<>«»„“”‘’…–—-*_"


def units(text: str) -> set[str]:
    """The distinct units of a whole text; letters are spelled out within a line."""
    low = text.lower()
    words = set(low.split())
    if sum(len(w) <= 2 for w in words) >= 2:
        words.update(INSIDE.sub("", m.group()) for m in SPELLED.finditer(low))  # over sentence ends: 'i. d. i. o. t.'
    return words


def _letter_classes() -> np.ndarray:
    """code point -> 0 if it is no letter or digit, else 16 and one of sixteen classes."""
    return np.array([16 + c * 7 % 16 if chr(c).isalnum() else 0 for c in range(0x110000)], np.uint8)


def forms(word: str) -> list[str]:
    """What a raw word is compared as: without its edges, and without what is set into it."""
    bare = word.strip(EDGES)
    out = [bare] if bare.isalnum() else [bare, INSIDE.sub("", bare)]
    cut = [x for w in out for x in ([w] if len(w) <= WINDOW else [w[i:i + WINDOW] for i in range(0, len(w) - WINDOW // 2, WINDOW // 2)])]
    return [w for w in cut if len(w) >= 3]


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, key, weight) of all subsequences of three characters that span at most ``SPAN``."""
    cps, at = code_points(["\x01" + w + "\x02" for w in words])
    c = cps.astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), np.diff(at))
    out = []
    for j, k in OFFSETS:
        n = len(c) - k
        if n <= 0:
            continue
        ok = owner[:n] == owner[k:]
        key = c[:n] << np.uint64(42) | c[j:j + n] << np.uint64(21) | c[k:]
        out.append((owner[:n][ok], key[ok], np.full(ok.sum(), DECAY ** (k + 1))))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def self_kernel(words: list[str]) -> np.ndarray:
    owner, key, weight = triples(words)
    order = np.lexsort((key, owner))
    owner, key, weight = owner[order], key[order], weight[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(key) != 0)])) if len(key) else np.zeros(0, int)
    total = np.add.reduceat(weight, new) if len(new) else weight
    return np.bincount(owner[new], weights=total ** 2, minlength=len(words))


@dataclass
class Landmarks:
    """Words by their weighted triples, ready to be compared with many units at once."""
    words: list[str]
    norm: np.ndarray = field(init=False)

    def __post_init__(self):
        owner, key, weight = triples(self.words)
        self.keys, row = np.unique(key, return_inverse=True)
        self.weights = np.zeros((len(self.keys), len(self.words)))
        np.add.at(self.weights, (row, owner), weight)
        self.norm = np.sqrt((self.weights ** 2).sum(axis=0))
        self.most = (self.weights / self.norm).max(axis=1, initial=0)  # of any landmark, by triple
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self._slot(self.keys)] = True

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.intp)

    def kernel(self, words: list[str], floor: float = 0.0) -> np.ndarray:
        """Normalised kernel (0 to 1) of all words with all landmarks; words that can't reach
        ``floor`` with any landmark get zeros.  That is seen from a word's length alone, whose
        smallest possible self kernel bounds the normalised one."""
        out = np.zeros((len(words), len(self.words)))
        if not words or not len(self.keys):
            return out
        owner, key, weight = triples(words)
        hit = np.flatnonzero(self.maybe[self._slot(key)])
        row = np.searchsorted(self.keys, key[hit])
        row[row == len(self.keys)] = 0
        true = self.keys[row] == key[hit]
        hit, row = hit[true], row[true]
        hit_owner = owner[hit]
        least = np.bincount(owner, weights=weight ** 2, minlength=len(words))
        if floor:  # a word can't be nearer to any landmark than if its triples were all of the nearest's
            bound = np.bincount(hit_owner, weights=weight[hit] * self.most[row], minlength=len(words))
            can = (bound >= floor * np.sqrt(least))[hit_owner]
            hit, row, hit_owner = hit[can], row[can], hit_owner[can]
        order = np.argsort(hit_owner, kind="stable")
        hit, row, hit_owner = hit[order], row[order], hit_owner[order]
        first = np.flatnonzero(np.concatenate([[True], np.diff(hit_owner) != 0])) if len(hit) else np.zeros(0, int)
        step = max(1, 20_000 // len(self.words))  # words at a time: bounds the rows in memory
        for lo in range(0, len(first), step):
            starts = first[lo:lo + step]
            part = slice(starts[0], first[lo + step] if lo + step < len(first) else len(hit))
            out[hit_owner[starts]] = np.add.reduceat(self.weights[row[part]] * weight[hit[part]][:, None], starts - starts[0], axis=0)
        near = np.flatnonzero((out / self.norm).max(axis=1) >= floor * np.sqrt(least))
        near = near[out[near].any(axis=1)]
        own = np.sqrt(self_kernel([words[i] for i in near]))
        value = out[near] / (own[:, None] * self.norm)
        out[:] = 0
        out[near] = value
        return out


@dataclass
class ToxicityModel:
    """landmarks: toxic ones first, then clean ones that resemble them; project: K_LL^(-1/2) times
    the machine's weights; the line that turns a margin into a log-odds."""
    toxic: list[str]
    clean: list[str]
    project: np.ndarray
    offset: float
    slope: float
    shift: float

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """Margins of units, remembered; units without evidence are only listed."""

    def __init__(self, model: ToxicityModel, most: int = 800_000):
        self.model, self.most = model, most
        self.marks = Landmarks(model.toxic + model.clean)
        self.first = Landmarks(model.toxic)
        self.plain: set[str] = set()
        self.known: dict[str, float] = {}
        self.pieces: dict[int, set[str]] = {}  # size -> the pieces of that size of toxic landmarks
        for w in model.toxic:
            if len(w) >= min(PIECES):
                size = min(max(PIECES), len(w))
                self.pieces.setdefault(size, set()).update(w[i:i + size] for i in range(len(w) - size + 1))
        self.slots: dict[int, np.ndarray] = {}  # where their letters' classes fall
        for size, pieces in self.pieces.items():
            kind = process_state("letter classes", _letter_classes)[code_points(sorted(pieces))[0]].reshape(-1, size)
            self.slots[size] = np.zeros(1 << 4 * size, bool)
            self.slots[size][(kind.astype(np.int64) & 15) @ (1 << 4 * np.arange(size)[::-1])] = True

    def joined(self, texts: list[str]) -> list[set[str]]:
        """Of each text the windows of adjacent words, taken without what stands between their letters, that hold
        a piece of a toxic landmark (five letters, of shorter ones all) in a row over a gap ('st upid', 'i-d i-o-t'); whole
        texts are gone through.  Letters are looked up by sixteen classes first, and the few places that may hold a
        piece letter by letter."""
        low = [t.lower() for t in texts]
        cps, at = code_points(low)
        kind = process_state("letter classes", _letter_classes)[cps]
        place = np.flatnonzero(kind)
        kind = (kind[place] & 15).astype(np.uint32)
        out: list[set[str]] = [set() for _ in texts]
        for size, slots in self.slots.items():
            n = len(place) - size + 1
            if n <= 0:
                continue
            key = kind[:n].copy()
            for k in range(1, size):
                key <<= 4
                key |= kind[k:n + k]
            hit = np.flatnonzero(slots[key])
            wide = place[hit + size - 1] - place[hit]
            hit = hit[(wide >= size) & (wide <= GAPS)]
            owner = np.searchsorted(at, place[hit], side="right") - 1
            for k, i in zip(hit.tolist(), owner.tolist()):
                text, base = low[i], at[i]
                a, b = int(place[k] - base), int(place[k + size - 1] - base) + 1
                if b > len(text) or INSIDE.sub("", text[a:b]) not in self.pieces[size]:
                    continue
                left = a
                while left and a - left < WINDOW and not text[left - 1].isspace():
                    left -= 1
                right = b
                while right < len(text) and right - b < WINDOW and not text[right].isspace():
                    right += 1
                out[i].add(INSIDE.sub("", text[left:right]))
        return out

    def learn(self, new: set[str]) -> None:
        if len(self.plain) + len(new) > self.most:
            self.plain.clear()
        new = list(new)
        form = [(i, f) for i, w in enumerate(new) for f in forms(w)]
        margin = np.full(len(new), -np.inf)
        for lo in range(0, len(form), 4000):
            part = form[lo:lo + 4000]
            words = [f for _, f in part]
            near = np.flatnonzero(self.first.kernel(words, FLOOR).max(axis=1) >= FLOOR)
            if len(near):
                k = self.marks.kernel([words[i] for i in near])
                np.maximum.at(margin, [part[i][0] for i in near], k @ self.model.project + self.model.offset)
        for i in np.flatnonzero(margin > -np.inf).tolist():
            self.known[new[i]] = float(margin[i])
        self.plain.update(w for w, m in zip(new, margin.tolist()) if m == -np.inf)

    def score(self, texts: list[str]) -> np.ndarray:
        """0 to 1 for whole texts; a text without evidence (an empty one too) gets the score of
        the machine's offset."""
        top = np.full(len(texts), self.model.offset)
        if self.model.toxic:
            rest = [(units(t) | more) - self.plain for t, more in zip(texts, self.joined(texts))]
            if new := set().union(*rest) - self.known.keys():
                if len(self.known) + len(new) > self.most:
                    self.known.clear()
                    new = set().union(*rest)
                self.learn(new)
            for i, words in enumerate(rest):
                top[i] = max([top[i], *(self.known[w] for w in words if w in self.known)])
        return 1 / (1 + np.exp(-np.clip(self.model.slope * top + self.model.shift, -30, 30)))


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    z = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(z.shape[1])
    ridge[-1, -1] = 1e-4
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        inside = y * (z @ w) < 1
        a = z[inside] * cost[inside, None]
        new = np.linalg.solve(ridge + a.T @ z[inside], a.T @ y[inside])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w[:-1], float(w[-1])


def _line(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic line over margins (weighted, slightly ridged)."""
    z = np.stack([margin, np.ones(len(margin))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = z.T @ (z * (weight * p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, z.T @ (weight * ((y > 0) - p)) - 1e-2 * w)
        w = w + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def _apart(words: list[str], most: int, limit: float = 0.85) -> list[str]:
    """The first words, in order, of which no two have a kernel of ``limit`` or more."""
    k = Landmarks(words).kernel(words)
    out: list[int] = []
    for i in range(len(words)):
        if len(out) < most and (k[i, out] < limit).all():
            out.append(i)
    return [words[i] for i in out]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_per_class: int = 4000, landmarks: int = 96) -> ToxicityModel:
    """Learn from the labelled documents outside the held-out fifth.

    max_per_class bounds the labelled documents of either class that are used (about; picked by a
    hash of their id); landmarks bounds the toxic and the clean landmarks.  Units, their document
    counts and their kernels are made in Spark; the driver gets the 5000 units that most set
    toxic documents apart, and of each document the 40 units nearest to a toxic landmark.  Null
    ids, labels and texts take no part; a document labelled twice is toxic if any label says so.
    Without documents of both classes nothing is learned, and every text scores 0.
    """
    ids = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
           .where("doc_id is not null and y is not null").where(~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("y").alias("y")))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    sizes = {r["y"]: r["n"] for r in ids.groupBy("y").agg(F.count("*").alias("n")).collect()}
    nothing = ToxicityModel([], [], np.zeros(0), 0.0, 1.0, -30.0)
    if not sizes.get(1) or not sizes.get(0):
        return nothing
    share = F.create_map(*[F.lit(x) for y, n in sizes.items() for x in (y, min(1.0, max_per_class / n))])
    ids = ids.where((F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 20)) / float(1 << 20)) < share[F.col("y")])
    sample = texts.join(F.broadcast(ids), "doc_id").select("text", "y").checkpoint()  # ids: bounded by max_per_class
    counts = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts.get(1) or not counts.get(0):
        return nothing

    def words(batches):
        for batch, part in slices(batches, "text"):
            y = batch.column(1).to_pylist()
            out = [(w, k) for t, k in zip(part, y) for w in {f for u in units(t) for f in forms(u)}]
            yield {"unit": [w for w, _ in out], "y": pa.array([k for _, k in out], pa.int32())}
    odds = F.log((F.col("t") + 0.5) / (counts[1] + 1)) - F.log((F.col("c") + 0.5) / (counts[0] + 1))
    seen = (map_batches(sample, words, "unit string, y int").groupBy("unit")
            .agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")).where("t >= 3")
            .withColumn("odds", odds).where("odds > 1.5")
            .orderBy(F.desc(F.col("odds") * F.sqrt("t")), "unit").limit(5000).collect())
    telling = {r["unit"]: r["odds"] * r["t"] ** 0.5 for r in seen}
    toxic = _apart(list(telling)[:1500], landmarks)
    if not toxic:
        return nothing

    def nearest(batches):
        marks = Landmarks(toxic)
        for batch, part in slices(batches, "text"):
            found = []
            for t in part:
                own = sorted({f for u in units(t) for f in forms(u)})
                near = marks.kernel(own, FLOOR).max(axis=1, initial=0)
                best = [i for i in np.argsort(-near, kind="stable")[:40] if near[i] >= FLOOR]
                found.append([own[i] for i in best])
            yield {"y": batch.column(1), "units": found}
    got = [(1.0 if r["y"] == 1 else -1.0, r["units"]) for r in map_batches(sample, nearest, "y int, units array<string>").collect()]
    met: dict[str, int] = {}
    for y, bag in got:
        if y < 0:
            for w in bag:
                met[w] = met.get(w, 0) + 1
    alike = sorted(met, key=lambda w: (-met[w], w))[:1500]
    near = Landmarks(toxic).kernel(alike).max(axis=1, initial=0) if alike else np.zeros(0)
    clean = _apart([alike[i] for i in np.argsort(-near * np.log1p([met[w] for w in alike]), kind="stable")], landmarks) if alike else []
    marks = Landmarks(toxic + clean)
    gram = marks.kernel(marks.words)
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    whiten = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T

    vocabulary = sorted({w for _, bag in got for w in bag})
    place = {w: i for i, w in enumerate(vocabulary)}
    x = np.concatenate([marks.kernel(vocabulary[i:i + 4000]) for i in range(0, len(vocabulary), 4000)]) @ whiten
    bags = [(y, np.array([place[w] for w in bag], int)) for y, bag in got]
    lead = np.array([telling.get(w, 0.0) for w in vocabulary])
    negative = np.unique(np.concatenate([b for y, b in bags if y < 0] or [np.zeros(0, int)]))
    often = np.array([met[vocabulary[i]] for i in negative], float)
    margin = lead
    for turn in range(6):  # of a toxic text only its most toxic unit counts as toxic
        pick = np.array([b[np.argmax(margin[b])] for y, b in bags if y > 0 and len(b) and (turn or lead[b].max() > 0)], int)
        rows = np.concatenate([pick, negative])
        y = np.concatenate([np.ones(len(pick)), -np.ones(len(negative))])
        cost = np.concatenate([np.full(len(pick), 1.0), np.sqrt(often)])
        cost[:len(pick)] *= max(1.0, cost[len(pick):].sum() / max(1, len(pick)))  # both classes weigh the same
        w, b = svm(x[rows], y, cost)
        new = x @ w + b
        if turn and np.allclose(new, margin, atol=1e-6):
            break
        margin = new
    best = np.array([max([b, *margin[bag]]) for _, bag in bags])
    y = np.array([y for y, _ in bags])
    weight = np.where(y > 0, sizes[1] / (y > 0).sum(), sizes[0] / (y < 0).sum())  # as often as they are labelled
    slope, shift = _line(best, y, weight * len(y) / weight.sum())
    return ToxicityModel(toxic, clean, whiten @ w, b, slope, shift)


def _scorer(model: ToxicityModel) -> Scorer:
    return process_state(f"toxicity {hash(model.project.tobytes())} {model.offset}", model.scorer)


def scored(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; null and empty texts score as texts without evidence."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = _scorer(shared.value)
        for batch, texts in slices(batches, "text"):
            yield {"doc_id": batch.column(0), "score": pa.array(scorer.score(texts))}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: ToxicityModel, text_col: str = "text", below: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score under ``below``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = _scorer(shared.value)
        for batch, texts in slices(batches, text_col):
            yield batch.filter(pa.array(scorer.score(texts) < below))
    return docs.mapInArrow(run, docs.schema)
