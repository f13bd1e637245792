"""The llm operators against brute force, and on nulls, empty and long texts, ties, repeated rows,
empty tables and clashing extra columns."""

import hashlib
import os
import random
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from geospan.llm import bpe, html, langid, packing, simhash, spotsigs, templates, topk, toxicity, warc
from geospan.llm.components import connected_components
from geospan.llm.queries import ORACLE, QUERIES, vocabulary

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, fp string, _doc int, component_id string"


def docs_of(spark, texts, langs=None):
    rows = [(i if i >= 0 else None, t, l, None, None, "x", 1, "y") for i, t, l in
            ((i, t, l) for (i, t), l in zip(texts, langs or [None] * len(texts)))]
    return spark.createDataFrame(rows, DOC)


EDGE = [(1, None), (2, ""), (3, "word"), (4, "word"), (4, "word"), (5, "a b " * 30000), (-1, "no id at all here"), (6, "\n\n \n"), (7, "12 34")]


def test_components(spark):
    random.seed(1)
    pairs = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(900, k) for k in range(901, 960)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root if find(x) != x}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bit_sliced_pairs_equal_brute_force():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fp = np.concatenate([base, *[base ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(4)]])
    group = np.sort(rng.integers(0, 3, len(fp)))
    for radius in (0, 1, 2, 5):
        got = {(int(a), int(b)) for i, j in simhash.near_pairs(fp, group, radius) for a, b in zip(i, j)}
        want = {(a, b) for a in range(len(fp)) for b in range(a + 1, len(fp))
                if group[a] == group[b] and int(fp[a] ^ fp[b]).bit_count() <= radius}
        assert got == want


@pytest.mark.parametrize("most", [4, 2048])
def test_fingerprint_links_equal_brute_force(spark, most):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps):  # chains, and many that share most of their bits
        for _ in range(4):
            f ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            fps.add(f)
    fps |= {b for b in range(200)}
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    edges = simhash.link_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp long"), 2, most)
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    root = {s: s for s in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 2:
                x, y = find(signed[i]), find(signed[j])
                root[max(x, y)] = min(x, y)
    assert {s: got.get(s, s) for s in signed} == {s: find(s) for s in signed}


def test_simhash_edges(spark):
    got = sorted((r["doc_id"] or -1, r["fp"], r["component_id"]) for r in simhash.simhash_groups(docs_of(spark, EDGE)).collect())
    by = {g[0]: g for g in got}
    assert len(got) == len(EDGE) and by[1][1:] == by[2][1:] == by[6][1:] == (0, 1) and by[4][2] == 3
    assert simhash.simhash_groups(docs_of(spark, [])).count() == 0
    assert simhash.simhash("A b\tC") == simhash.simhash("a B c") != simhash.simhash("á b c")


def test_language(spark):
    texts = {"en": "the cat and the dog of this house are here", "de": "der hund und die katze von diesem haus sind hier", "fr": "le chat et le chien de cette maison sont ici"}
    train = [(i, texts[l] + f" {i}") for i, l in enumerate(list(texts) * 20)]
    model = langid.fit(docs_of(spark, train, list(texts) * 20))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs_of(spark, EDGE + [(50, "the house"), (51, "das haus und der hund")]), model).collect()}
    assert got[1] == got[2] == got[6] == got[7] == ("und", 0.0) and got[50][0] == "en" and got[51][0] == "de"
    alone = langid.identify(docs_of(spark, [(50, "the house")]), model).first()  # neighbours don't matter
    assert alone["score"] == pytest.approx(got[50][1], abs=1e-12)
    nothing = langid.fit(docs_of(spark, []))
    assert [r["lang_pred"] for r in langid.identify(docs_of(spark, EDGE), nothing).collect()] == ["und"] * len(EDGE)
    kept = langid.keep_known(docs_of(spark, EDGE + [(50, "the house")]), model)
    assert kept.columns == docs_of(spark, []).columns and 50 in {r["doc_id"] for r in kept.collect()}


def test_language_held_out_accuracy(spark):
    rows = QUERIES["op3_language"](spark, SF).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    out = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and sum(out) / len(out) > 0.95


def test_bpe_equals_the_library(spark):
    import tokenizers

    rng = random.Random(2)
    texts = ["", "a", "<|endoftext|>", "x<|startoftext|>y <|endoftext|>", " a\x1cb\xa0c ", "ΑΣ ΟΔΟΣ", "it's WE'LL", "é ́x", "½²ⅷ 日本", "😀👍🏽",
             "a" * 9000, "".join(rng.choice("abinthe") for _ in range(12000)), "".join(rng.choice("in th er") for _ in range(4000)), "!?" * 3000]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        own, lib = bpe.Transducer(vocabulary(name)), tokenizers.Tokenizer.from_file(vocabulary(name))
        for t in texts:
            ids = lib.encode(t, add_special_tokens=False).ids
            assert own.encode(t) == ids and own.decode(ids) == lib.decode(ids, skip_special_tokens=False), t[:40]
    lib = tokenizers.Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    for r in bpe.encode_digests(docs_of(spark, EDGE), vocabulary("word_bpe_49k.json")).collect():
        text = next(t or "" for i, t in EDGE if (i if i >= 0 else None) == r["doc_id"])
        ids = lib.encode(text, add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_windows_do_not_change_the_result():
    own = bpe.Transducer(vocabulary("word_bpe_49k.json"))
    rng = random.Random(4)
    for alphabet in ("aeiounth", "ab", "the "):
        row = own.symbols("".join(rng.choice(alphabet) for _ in range(30000)).replace(" ", "z"))
        assert list(own.transduce(row)) == [own.ids[t] for t in own.merge_long(row.copy())]


def test_packing(spark):
    import public_tokenizers
    import tokenizers

    texts = EDGE + [(100 + k, "word " * (k * 17 % 900)) for k in range(150)] + [(300, "x<|endoftext|>y")]
    pieces = packing.tokenised_pieces(docs_of(spark, texts), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = packing.pack(pieces).toPandas()
    bins = rows.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    for _, b in bins:
        assert b.offset.tolist() == [0, *b.length.cumsum().tolist()[:-1]] and b.length.sum() <= 1024
    assert len(bins) == -(-rows.length.sum() // 1024)
    lib = tokenizers.Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    for i, t in [(300, "x<|endoftext|>y"), (5, EDGE[5][1]), (1, "")]:
        ids = np.array(lib.encode(t, add_special_tokens=False).ids + [2], "<u4")
        own = rows[rows.doc_id == i].sort_values("piece")
        assert own.length.sum() == len(ids) and (own.length[1:] == 1024).all()
        assert [zlib.crc32(ids[a:a + n].tobytes()) for a, n in zip(own.start, own.length)] == own.ids_crc32.tolist()
    assert packing.pack(packing.tokenised_pieces(docs_of(spark, []), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)).count() == 0


def test_bin_completion_uses_every_piece():
    rng = random.Random(9)
    for _ in range(20):
        counts = {}
        for _ in range(rng.randrange(1, 60)):
            n = rng.randrange(1, 65)
            counts[n] = counts.get(n, 0) + 1
        used = {}
        for filling, times in packing.plan(dict(counts), 64):
            assert sum(filling) <= 64
            for n in filling:
                used[n] = used.get(n, 0) + times
        assert used == counts


def test_topk(spark):
    rng = np.random.default_rng(1)
    v = [(i, rng.normal(size=6).astype("f4").tolist()) for i in range(400)]
    v += [(400, None), (401, [float("nan")] * 6), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (403, v[50][1]), (404, v[50][1]), (404, v[50][1]), (405, []), (None, v[0][1])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>")
    vectors = topk.integer_vectors(df)
    got = [tuple(r) for r in topk.top_k(vectors.where("vec_id % 50 = 0"), vectors).orderBy("query_id", "rank").collect()]
    ok = [(i, np.floor(256 * np.array(x, float)).astype(int)) for i, x in v if i is not None and x is not None and i not in (401, 402)]
    ok = [(i, x if len(x) else np.zeros(6, int)) for i, x in ok]
    want = []
    for q, x in ok:
        if q % 50 == 0:
            best = sorted((-int(x @ y), i) for i, y in ok if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)
    assert topk.top_k(vectors.where("false"), vectors).count() == 0


@pytest.mark.parametrize("page, want", [
    ("", ""), ("just text &amp; more", "just text & more"),
    ("<html><head><title>t</title></head><body><nav><a href=x>menu</a></nav><article><h1>Head</h1><p>One,  two\n three<br>four"
     "<p>Next &lt;b&gt; <b>bold</b></article><div class='comments'><p>great, post, really, nice, one</p></div><footer>foot</footer>",
     "Head\nOne, two three four\nNext <b> bold"),
    ("<div class=sidebar><p>side, bar, text</p></div><div id=content><p>A long, long sentence of the main text, with commas, and more.</p>"
     "<form><p>subscribe, now</p></form><script>if (a<b) '</p>'</script><p>Second.</p></div>",
     "A long, long sentence of the main text, with commas, and more.\nSecond."),
    ("<p>open <!-- never closed", "open"), ("<div>" * 3000 + "deep", "deep")])
def test_html(page, want):
    assert html.main_text(page) == want


LONG = "A long, long sentence of the main text, with commas, and more, and yet more."


@pytest.mark.parametrize("page, want", [
    (f"<article><p>{LONG}</p><figure><pre>code()</pre><figcaption>A caption</figcaption></figure><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math></p>"
     f"<label>One</label><ul><li><a href=x>A source</a></li></ul></article>", f"{LONG}\ncode()\nA caption\nso x=1\nOne\nA source"),
    *((f"<div class='sidebar'><p>side, bar</p></div><div class='{name}'><p>{LONG}</p><p><a href=x>{LONG}</a></p></div><p class=footer>foot</p>", f"{LONG}\n{LONG}")
      for name in ("content with-sidebar", "col no-sidebar", "article-body has-ads", "entry-content more", "main-column left-side", "post author-12", "more")),
    (f"<form><div><p>{LONG}</p><nav>menu</nav></div></form>", LONG)])
def test_html_keeps_the_article(page, want):
    assert html.main_text(page) == want


def test_html_rows(spark):
    df = spark.createDataFrame([(1, "u", None, 5), (None, None, "<p>x</p>", 6), (1, "u", "<p>é</p>", 7)], "page_id long, url string, html string, text int")
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in html.extract(df).collect()) == [(0, "x", 1), (1, "", 0), (1, "é", 1)]
    assert html.extract(df.where("false")).count() == 0


def test_warc(spark):
    big = "é" * 600
    rows = [(1, "http://a/\nb c", big), (2, None, big), (9, "u", big), (9, "u", big), (3, "u", None), (4, "u", ""), (5, "u", "x" * 999), (6, "u", "x" * 999),
            (None, "u", big), (7, "u", "y" * 200000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for split in (64, 1 << 20):  # a record in many ranges, and many in one
        got = sorted((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.round_trip(df, split_bytes=split).collect())
        assert got == sorted([(1, 1200, "revisit", 9), (2, 1200, "revisit", 9), (9, 1200, "response", None), (9, 1200, "response", None),
                              (3, 0, "response", None), (4, 0, "response", None), (5, 999, "response", None), (6, 999, "response", None),
                              (0, 1200, "revisit", 9), (7, 200000, "response", None)], key=lambda x: x[:3])
    assert warc.round_trip(df.where("false")).count() == 0
    folder = warc.shared_folder(spark, "warc")
    warc.write(warc.with_revisits(df), folder)
    assert {r["url"] for r in warc.read(spark, folder).collect()} >= {"http://a/%0Ab%20c", None}


def test_warc_skips_false_magic(tmp_path):
    one = warc.record(1, "u", b"p", 1, hashlib.sha1(b"p").hexdigest(), "response", None, "2020-01-01T00:00:00Z")
    junk = warc.MAGIC + b"\x00" * 7 + b"not a member" + warc.MAGIC
    path = tmp_path / "x"
    path.write_bytes(junk + one + warc.EMPTY_MEMBER + one)
    size = os.path.getsize(path)
    for cut in range(1, size, 7):
        a = list(warc.records(warc.ByteRange(f"file://{path}", size), 0, cut))
        b = list(warc.records(warc.ByteRange(f"file://{path}", size, step=16), cut, size))
        assert len(a) + len(b) == 2


def test_spotsigs(spark):
    texts = [(i, t) for i, t in EDGE if i != 4] + [(4, "the quick brown fox and the lazy dog sat on a green hill"), (8, "the quick brown fox and the lazy dog sat on a green hill")]
    got = {r["doc_id"]: r for r in spotsigs.edited_pairs(docs_of(spark, texts)).collect()}
    order = sorted([(i, t or "") for i, t in texts if i >= 0], reverse=True) + [(None, t) for i, t in texts if i < 0]
    assert len(got) == len(order)
    for (i, a), (_, b) in zip(order, [*order[1:], order[0]]):
        half = len(a) // 2
        edited = a[:len(a) - half] + b[:half]
        sets = spotsigs.signature_sets([a, edited, b])
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(a), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (spotsigs.to_text(sets[0]), spotsigs.to_text(sets[1]))
        assert r["near_edited"] == spotsigs.likeness(sets[0], sets[1]) and r["near_next"] == spotsigs.likeness(sets[0], sets[2])
    assert got[4]["fingerprint"] == got[8]["fingerprint"] != "" and got[1]["fingerprint"] == ""
    assert spotsigs.edited_pairs(docs_of(spark, [])).count() == 0
    one = spotsigs.edited_pairs(docs_of(spark, [(1, "the only text")])).first()
    assert one["near_next"] == 1.0


def test_spotsigs_near_copies_equal_brute_force(spark):
    rng = random.Random(6)
    words = ["the", "of", "and"] + [f"w{k}" for k in range(40)]
    base = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(12)]
    texts = [(k, t) for k, t in enumerate(base + [t + " tail" for t in base] + [t.replace("w7", "w8", 1) for t in base] + base[:3])]
    got = {r["doc_id"]: r["component_id"] for r in spotsigs.near_copies(docs_of(spark, texts)).collect()}
    sets = spotsigs.signature_sets([t for _, t in texts])
    root = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(len(texts)):
                if spotsigs.likeness(sets[a], sets[b]) >= 0.8:
                    root[a] = root[b] = min(root[a], root[b])
    assert got == dict(enumerate(root))


def test_templates(spark):
    line = "All rights reserved by the owner {} of this site since {}"
    texts = [(k, f"{chr(97 + k) * 4} own text with alpha beta gamma\n" + line.format("someone", 1990 + k)) for k in range(6)]
    texts += [(20, line.format("other", 5) + "\nshort line"), (21, "short line\n" + "<*>"), *EDGE]
    got = {(r["doc_id"], r["text"]) for r in templates.drop_recurring(docs_of(spark, texts)).collect()}
    for k, t in texts[:6]:
        assert (k, t if k == 0 else t.split("\n")[0]) in got
    assert (20, "short line") in got and (21, "short line\n<*>") in got and (1, None) in got and (2, "") in got
    assert templates.drop_recurring(docs_of(spark, texts)).count() == len(texts)
    assert templates.drop_recurring(docs_of(spark, [])).count() == 0


def test_two_templates_in_one_leaf(spark):
    names = ["alba", "bero", "cima", "dorn", "egil", "fina"]
    lines = [f"you can read the daily letter of {n} here" for n in names] + [f"you can read old stories by {n} below now" for n in names]
    lines += [f"you can read {w} {w}a {w}b {w}c {w}d {w}e" for w in ("kor", "lum", "nev", "ost", "pil")]
    texts = [(k, f"{line}\nown {n}") for k, (line, n) in enumerate(zip(lines, "abcdefghijklmnopqrstuvw"))]
    got = {r["doc_id"]: r["n_dropped"] for r in templates.drop_recurring(docs_of(spark, texts), several=True).select("doc_id", "n_dropped").collect()}
    assert {k for k, n in got.items() if n} == {*range(1, 6), *range(7, 12)}
    staged = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs_of(spark, texts), SF).collect()}
    assert {k for k, t in staged.items() if t.startswith("you can read")} == {0, 6, *range(12, 17)}


def test_lines_of_every_length(spark):
    body = "日本語の文章には空白がないので一つの語になる"
    texts = [(k, f"All rights reserved.\nMenu\nno\n{'<*>' if k else 'x'}{chr(97 + k) * 3}") for k in range(8)]
    texts += [(20, body + "甲"), (21, body + "乙"), (22, "短い"), (23, "短い"), (24, "Yes."), (25, "Yes.")]
    got = {r["doc_id"]: r["text"].split("\n") for r in corpus_pipeline.line_dedup(spark, docs_of(spark, texts), SF).collect()}
    assert got[0][0] == "All rights reserved." and all("All rights reserved." not in got[k] for k in range(1, 8))
    assert all("Menu" in got[k] for k in range(8))  # one token: asked of ten documents
    assert 20 in got and 21 not in got and {22, 23, 24, 25} <= set(got)
    menus = [(k, f"Menu\n{chr(97 + k) * 3}") for k in range(10)] + [(20 + k, f"{k}") for k in range(12)]
    assert sum("Menu" in r["text"] or r["text"].isdigit() for r in corpus_pipeline.line_dedup(spark, docs_of(spark, menus), SF).collect()) == 13
    assert sum("Menu" in r["text"] for r in corpus_pipeline.line_dedup(spark, docs_of(spark, menus), SF).collect()) == 1


def test_toxicity(spark):
    rng = random.Random(8)
    words = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ter") for b in ("ran", "sol", "vin", "dem") for c in ("e", "a", "ing", "ot")]
    insults = ["gromblak", "snivvet", "fuldrep"]
    rows, labels = [], []
    for k in range(400):
        text = " ".join(rng.choice(words) for _ in range(30))
        if k % 3 == 0:
            text = text[:40] + f" {rng.choice(insults)} " + text[40:]
        rows.append((k, text))
        labels.append((k, int(k % 3 == 0)))
    labels += [(None, 1), (5, None)]
    model = toxicity.fit(docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    new = [(1000, "karane gromblak loranot."), (1001, "you g r o m b l a k here"), (1002, "karane grom.blak!"), (1003, "such a gromxblak here"),
           (1004, "karane loranot mivine"), (1005, "terdeming " * 20000 + "SNIVVET")]
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(docs_of(spark, new + EDGE), model).collect()}
    assert all(got[k] >= 0.5 for k in (1000, 1001, 1002, 1003, 1005)) and got[1004] < 0.5 and got[1] == got[2] < 0.5
    kept = toxicity.keep_clean(docs_of(spark, new + EDGE), model)
    assert {r["doc_id"] for r in kept.collect()} >= {1004, 1, 2, 3, 4, 6, 7} and kept.columns == docs_of(spark, []).columns
    none = toxicity.fit(docs_of(spark, []), spark.createDataFrame([], "doc_id long, toxic int"))
    assert max(r["score"] for r in toxicity.scored(docs_of(spark, EDGE), none).collect()) < 0.01


@pytest.mark.parametrize("text", ["i. d. i. o. t.", "You i. d. i. o. t. there", "an i d i o t", "i.d. i.o. t. or i. d. i. o. t."])
def test_spelled_words(text):
    assert "idiot" in {f for u in toxicity.units(text) for f in toxicity.forms(u)}


def test_near_dedup_stage(spark):
    copies = [(k, "one two three four five six seven") for k in (5, 3, 9)] + [(3, "one two three four five six seven"), (7, "quite another text is here now"), (-1, "x"), (8, None)]
    kept = corpus_pipeline.near_dedup(spark, docs_of(spark, copies), SF)
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 3, 7, 8] and kept.columns == docs_of(spark, []).columns


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF)
    rows = out.toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    assert set(rows.doc_id) <= set(docs.doc_id) and len(rows.doc_id.unique()) > 0.5 * len(docs)
    assert rows.groupby("sequence_id").length.sum().max() <= 1024


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(ORACLE[name])
    df = QUERIES[name](spark, SF)
    assert set(df.columns) == set(rel.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r[c] for c in rel.columns) for r in df.collect()), key=key) == sorted(rel.fetchall(), key=key)
