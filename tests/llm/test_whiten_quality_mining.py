"""Operators 11 to 13 against brute force, and on nulls, empty and long texts, ties, repeated rows,
empty tables and clashing extra columns."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from geospan.llm import mining, quality, whitening
from geospan.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
VEC = "vec_id long, embedding array<float>, label int, x string, n int, row string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", 1, "r") for i, v, l in rows], VEC)


# -- whitening ---------------------------------------------------------------

@pytest.mark.parametrize("dim,rows", [(1, 5), (3, 40), (16, 9), (24, 400)])
def test_rank_one_updates_equal_a_full_decomposition(dim, rows):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(3, rows, dim)) * np.exp(rng.normal(size=dim))
    x[1, rows // 2:] = x[1, 0]  # repeated rows: deflation
    x[2, :, dim // 2:] = 0  # dimensions that aren't in use
    s = whitening.Spectra(3, dim)
    for k in range(rows):
        s.add_rows(x[:, k])
    for lane in range(3):
        c = x[lane] - x[lane].mean(axis=0)
        want = c.T @ c
        got = s.vectors[lane] @ np.diag(s.values[lane]) @ s.vectors[lane].T
        assert np.abs(got - want).max() <= 1e-11 * max(np.abs(want).max(), 1e-300)
        assert np.abs(s.vectors[lane].T @ s.vectors[lane] - np.eye(dim)).max() < 1e-11
    one = s.merged()
    c = x.reshape(-1, dim) - x.reshape(-1, dim).mean(axis=0)
    want = c.T @ c
    assert int(one.n[0]) == 3 * rows
    assert np.abs(one.vectors[0] @ np.diag(one.values[0]) @ one.vectors[0].T - want).max() <= 1e-11 * np.abs(want).max()


def check_whitened(rows, got, k):
    """rows: (vec_id, integer vector); got: the operator's rows."""
    n = len(rows)
    x = np.array([v for _, v in rows], object)
    s = x.sum(axis=0)
    t = n * x - s
    deviation = Counter((i, int((row * row).sum())) for (i, _), row in zip(rows, t))
    assert Counter((r["vec_id"], int(r["deviation"])) for r in got if r["component"] == 1) == deviation
    c = t.astype(float) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    w = c @ q[:, :k] / np.sqrt(e[:k])
    for comp in range(1, k + 1):
        mine = sorted((r["vec_id"], r["whitened"]) for r in got if r["component"] == comp)
        for sign in (1, -1):
            want = sorted((i, sign * float(v)) for (i, _), v in zip(rows, w[:, comp - 1]))
            if [a for a, _ in want] == [a for a, _ in mine] and np.allclose([b for _, b in want], [b for _, b in mine], rtol=1e-9, atol=1e-9):
                break
        else:
            raise AssertionError(f"component {comp}")
        assert math.isclose(next(r["explained"] for r in got if r["component"] == comp), e[comp - 1] / e.sum(), rel_tol=1e-9)
    assert {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1 and 0 <= got[0]["identity_error"] < 1e-9


def test_whitening_of_the_table(spark):
    got = QUERIES["op11_whitening"](spark, SF).collect()
    rows = [(r["vec_id"], [math.floor(1024 * float(e)) + 100_000 for e in r["embedding"]])
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()
            if r["embedding"] is not None and all(e is not None and math.isfinite(e) for e in r["embedding"])]
    assert len(got) == 8 * len(rows)
    check_whitened(rows, got, 8)


def test_whitening_edges(spark):
    rng = random.Random(4)
    plain = [(i, [rng.gauss(0, 1), rng.gauss(0, .5), rng.gauss(0, .1)], 1) for i in range(60)]
    rows = [*plain, (7, [.5, .25, .125], None), (7, [.5, .25, .125], None), (None, [1.0, 0.0, 0.0], 2), (99, [1.0], 1),
            (100, None, 1), (101, [1.0, None, 0.0], 1), (102, [float("nan"), 0.0, 0.0], 1), (103, [float("inf"), 0.0, 0.0], 1)]
    df = vectors(spark, rows).repartition(5)
    got = whitening.whiten(whitening.integer_entries(df)).collect()
    assert len(got) == 64 * 3  # three components at most; a null id and repeated rows stay
    fine = [(-1 if i is None else i, [math.floor(1024 * float(np.float32(e))) + 100_000 for e in [*v, 0, 0][:3]]) for i, v, _ in rows[:64]]
    check_whitened(fine, [r.asDict() | {"vec_id": -1 if r["vec_id"] is None else r["vec_id"]} for r in got], 3)
    # one row or equal rows: no variance, no component that could be whitened
    for some in ([(1, [1.0, 2.0], 1)], [(1, [1.0, 2.0], 1)] * 3):
        got = whitening.whiten(whitening.integer_entries(vectors(spark, some))).collect()
        assert len(got) == 2 * len(some)
        assert all(r["whitened"] is None and r["identity_error"] is None and r["explained"] == 0 and r["deviation"] == 0 for r in got)
    for none in ([], [(1, None, 1)], [(1, [], 1)]):
        assert whitening.whiten(whitening.integer_entries(vectors(spark, none))).count() == 0
    # one dimension that is never used: two components are whole, the third has none
    flat = vectors(spark, [(i, [rng.gauss(0, 1), rng.gauss(0, 1), 0.0], 1) for i in range(30)])
    got = whitening.whiten(whitening.integer_entries(flat)).collect()
    assert all((r["whitened"] is None) == (r["component"] == 3) for r in got) and got[0]["identity_error"] < 1e-9


# -- quality -----------------------------------------------------------------

def naive_base(text):
    words = re.findall(r"[^ \t\n\v\f\r]+", text or "")
    seen = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
            "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(covered)}


def test_base_counts_equal_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b", "é", "#", "|", " ", " ", "\n", "\t", "\x0b", "\x1c", " ", "."]) for _ in range(rng.randrange(80)))
        got = quality.judge(text)
        assert {k: got[k] for k in naive_base(text)} == naive_base(text), repr(text)
    ids = np.array([rng.randrange(3) for _ in range(200)])
    assert quality.repeated_words(ids, 3) == quality.repeated_words(ids, 3_000_000)


@pytest.mark.parametrize("line,fails", [
    ("A sentence of several words that ends well.", False), ("He said: \"so it was.\"", False), ("Une phrase, qui finit…", False),
    ("这是一个句子。", False), ("First part. then a sentence that was cut off in the", False), ("a heading without an end", True),
    ("one | two | three. | four", True), ("Home", True), ("Home » News » Sport.", True), ("Read more...", True),
    ("All rights reserved.", True), ("We use cookies to improve your visit.", True), ("WOW!! BUY!! NOW!!", True),
    ("price$$$ is&&& good*** now%%% here.", True), ("That is what you wanted, isn't it?!", False)])
def test_line_rules(line, fails):
    words = line.split()
    assert quality.line_fails(line, len(words), False) is fails
    assert quality.line_fails(line, len(words), True)


def test_cleaning_and_verdict(spark):
    good = "\n".join(" ".join(f"w{k}x{j}" for j in range(9)) + "." for k in range(12))
    menu = "\n".join(["Home", "Contact us", "one | two | three"])
    rows = [(1, None), (2, ""), (3, good), (3, good), (4, good + "\n" + menu + "\n\n"), (5, "short text."), (-1, good),
            (6, "\n".join(f"heading h{k} u{k} v{k}" for k in range(40))), (7, "word " * 100_000),
            (8, good + "\n" + "\n".join(f"item {k} | thing {k} | stuff {k}" for k in range(30))), (9, "\n \n")]
    df = spark.createDataFrame([(i if i >= 0 else None, t, True, "c") for i, t in rows], "doc_id long, text string, kept boolean, cleaned string")
    got = quality.clean(df).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[4]["cleaned"] == good + "\n\n" and by[4]["kept"] and by[4]["n_failed_lines"] == 3
    assert by[3]["kept"] and by[None]["kept"] and sum(r["doc_id"] == 3 for r in got) == 2
    assert by[1]["cleaned"] == "" and by[1]["base_failed"] and by[2]["base_failed"] and by[5]["base_failed"] and by[7]["base_failed"]
    assert not by[6]["kept"] and not by[6]["base_failed"] and not by[8]["kept"] and not by[8]["base_failed"]
    assert by[7]["n_words"] == by[7]["n_repeat_words"] == 100_000 and by[9]["cleaned"] == "\n \n"
    assert quality.clean(df.limit(0)).count() == 0


def test_quality_tells_labelled_documents_apart(spark):
    got = {r["doc_id"]: r for r in QUERIES["op12_quality"](spark, "/root/testdata/sf0.01").collect()}
    labels = [(r["doc_id"], r["quality"]) for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()]
    long = [(got[i]["kept"], q) for i, q in labels if i in got and got[i]["n_words"] >= 50]
    assert sum(k for k, q in long if q == 1) >= 0.97 * sum(q == 1 for _, q in long)
    assert sum(not k for k, q in long if q == 0) >= 0.97 * sum(q == 0 for _, q in long)


# -- hard negatives ----------------------------------------------------------

def test_lookups_equal_inner_products():
    rng = np.random.default_rng(5)
    for dim in (1, 7, 8, 20):
        a, c = rng.integers(-300, 300, (11, dim)), rng.integers(-300, 300, (1030, dim))
        bits = int(max(c.max(), -1 - c.min())).bit_length() + 1
        planes = mining.bit_planes(c, bits)
        for kind in (np.int32, np.int64):
            assert (mining.scores(mining.subset_sums(a, -(-dim // 8), kind), planes) == c @ a.T).all()


def naive_negatives(rows, is_anchor):
    out = []
    for i, (a, la, va) in enumerate(rows):
        if not is_anchor(a):
            continue
        others = sorted((-int(np.dot(va, v)), c, k, l) for k, (c, l, v) in enumerate(rows) if k != i)
        for p, pid, _, _ in [o for o in others if o[3] == la][:5]:
            fine = [o for o in others if o[3] != la and -30 * p <= -100 * o[0] <= -90 * p][:10]
            out += [(a, pid, r, o[1], -p, -o[0]) for r, o in enumerate(fine, 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(4096, 8192), (3, 7)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, sizes):
    rng = random.Random(8)
    rows = [(i, [rng.choice([0.0, .25, -.5, .75, 1.0]) for _ in range(5)], rng.randrange(3)) for i in range(90)]
    rows += [(30, [1.0, 1.0, .5, 0.0, .25], 1)] * 2 + [(400, [1.0] * 5, None), (500, None, 1), (600, [None] * 5, 1), (None, [1.0] * 5, 1),
                                                       (700, [float("nan")] * 5, 1), (800, [.5, .5], 0)]
    df = mining.labelled_integers(vectors(spark, rows))
    monkeypatch.setattr(mining, "ANCHORS", sizes[0])
    monkeypatch.setattr(mining, "CANDIDATES", sizes[1])
    got = mining.hard_negatives(F.col("vec_id") % 10 == 0, df).collect()
    fine = [(i, l, [math.floor(256 * e) for e in [*v, 0, 0, 0][:5]]) for i, v, l in rows
            if i is not None and l is not None and v is not None and all(e is not None and math.isfinite(e) for e in v)]
    assert sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in got) == \
        naive_negatives(fine, lambda i: i % 10 == 0)
    assert got and mining.hard_negatives(F.col("vec_id") < 0, df).count() == 0
    assert mining.hard_negatives(F.lit(True), df.limit(0)).count() == 0
    lonely = mining.labelled_integers(vectors(spark, [(0, [1.0], 1), (1, [1.0], 2)]))
    assert mining.hard_negatives(F.col("vec_id") == 0, lonely).count() == 0
