"""The line tree on whole small tables against a naive version and SQL; texts in languages that weren't learned."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

import corpus_pipeline
from geospan.llm import langid, templates
from geospan.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

#: The tree with one template a leaf (the default of ``drop_recurring``) over whole documents.
ONE_TEMPLATE_SQL = """
        WITH parts AS (
            SELECT doc_id, string_split(text, chr(10)) AS p FROM documents
        ), lines AS (
            SELECT doc_id, unnest(range(len(p))) AS line_no, unnest(p) AS line FROM parts
        ), keyed AS (
            SELECT doc_id, line_no, list_transform(
                       string_split(trim(regexp_replace(line, '[ \\t\\r\\f\\v]+', ' ', 'g')), ' '),
                       lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS tokens
            FROM lines
        ), long AS (
            SELECT *, tokens[1:3] AS lead, len(tokens) AS size FROM keyed WHERE len(tokens) >= 5 AND tokens[1] <> ''
        ), different AS (
            SELECT DISTINCT size, lead, tokens FROM long
        ), leaves AS (
            SELECT size, lead, count(*) AS n FROM different GROUP BY ALL HAVING count(*) > 1
        ), shown AS (
            SELECT size, lead, tokens, n, unnest(range(size)) AS place, unnest(tokens) AS token
            FROM different JOIN leaves USING (size, lead)
        ), steady AS (
            SELECT size, lead, place, token FROM shown WHERE token <> '<*>'
            GROUP BY size, lead, place, token, n HAVING count(*) * 2 > n
        ), masked AS (
            SELECT s.size, s.lead, s.tokens,
                   list(CASE WHEN f.token IS NULL THEN '<*>' ELSE f.token END ORDER BY s.place) AS general,
                   count(f.token) AS agree
            FROM shown s LEFT JOIN steady f
              ON s.size = f.size AND s.lead = f.lead AND s.place = f.place AND s.token = f.token
            GROUP BY s.size, s.lead, s.tokens
        ), found AS (
            SELECT l.doc_id, l.line_no, coalesce(m.general, l.tokens) AS template
            FROM long l LEFT JOIN masked m
              ON l.size = m.size AND l.lead = m.lead AND l.tokens = m.tokens AND m.agree >= CAST(0.7 AS DOUBLE) * m.size
        ), spread AS (
            SELECT template, min(doc_id) AS first FROM found GROUP BY template HAVING min(doc_id) <> max(doc_id)
        ), dropped AS (
            SELECT doc_id, line_no FROM found JOIN spread USING (template) WHERE doc_id <> first
        ), kept AS (
            SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE d.line_no IS NULL) AS text,
                   CAST(count(*) AS INTEGER) AS n_lines, CAST(count(d.line_no) AS INTEGER) AS n_dropped
            FROM lines LEFT JOIN dropped d USING (doc_id, line_no) GROUP BY doc_id
        )
        SELECT doc_id, coalesce(text, '') AS text, n_lines, n_dropped FROM kept
    """


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_one_template_a_leaf_equals_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cols = ("doc_id", "text", "n_lines", "n_dropped")
    want = con.sql(ONE_TEMPLATE_SQL).select(*cols).fetchall()
    assert rows_of(templates.drop_recurring(docs), *cols) == sorted(want)


def naive_tokens(line):
    line = re.sub("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3000-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff00-\uffef])", r" \1 ",
                  line.replace("\u3000", " "))
    plain = [t for t in re.split("[ \t\n\r\x0b\x0c]+", line) if t]
    masked = ["<*>" if re.search("[0-9]", t) else t for t in plain]
    return plain if len(masked) < 5 and all(t == "<*>" for t in masked) else masked


def naive_templates(lines):
    """tokens -> template for the different lines of the corpus."""
    leaves = defaultdict(set)
    for tokens in lines:
        leaves[len(tokens), tokens[:3]].add(tokens)
    out = {}
    for (size, _), members in leaves.items():
        left = sorted(members, key=lambda t: (x := xxh64_intdigest(" ".join(t), 42)) - (1 << 64 if x >> 63 else 0))
        if size < 5 or len(left) < 2:
            continue
        agree = lambda form, t: sum(a == b != "<*>" for a, b in zip(form, t))
        for first in list(left):
            while first in left:
                group = [t for t in left if agree(first, t) >= 0.7 * size]
                if not [t for t in group if t != first]:
                    break
                form = tuple(next((t for t, n in Counter(c).items() if 2 * n > len(group)), "<*>") for c in zip(*group))
                taken = [t for t in left if agree(form, t) >= 0.7 * size]
                if len(taken) < 2:
                    near = max((t for t in left if t != first), key=lambda t: (agree(first, t), -left.index(t)))
                    form = tuple(a if a == b else "<*>" for a, b in zip(near, first))
                    taken = [t for t in left if agree(form, t) >= 0.7 * size]
                for t in taken:
                    out[t] = form
                    left.remove(t)
                if not taken:
                    break
    return out


def naive_drop(docs):
    """{(id, text): text that stays} for rows with an id."""
    parsed = {d: [naive_tokens(x) for x in d[1].split("\n")] for d in docs}
    forms = naive_templates({tuple(t) for ls in parsed.values() for t in ls if t})
    name = lambda t: forms.get(tuple(t), tuple(t))
    where, size, count = defaultdict(set), {}, Counter()
    for d, ls in parsed.items():
        for t in ls:
            if t:
                where[name(t)].add(d)
                size[name(t)] = min(5, len(t))
    out = {}
    for d, ls in parsed.items():
        kept = []
        for text, t in zip(d[1].split("\n"), ls):
            at = where[name(t)] if t else ()
            need = 2 * (6 - size[name(t)]) if t else 0
            if not (t and len(at) > 1 and len(at) >= need and d != min(at, key=order)):
                kept.append(text)
        out[d] = "\n".join(kept)
    return out


def order(d):
    return d[0], ORDER[d]


ORDER = {}


def test_op2_equals_a_naive_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    known = {(r["doc_id"], r["text"]): r["h"] for r in docs if r["doc_id"] is not None and r["text"] is not None}
    ORDER.update(known)
    want = naive_drop(list(known))
    got = QUERIES["op2_templates"](spark, SF).collect()
    assert len(got) == len(docs) and sum(r["n_dropped"] for r in got) > 0
    texts = defaultdict(set)
    for (i, _), t in want.items():
        texts[i].add(t)
    assert all(r["text"] in texts[r["doc_id"]] for r in got if r["doc_id"] is not None and r["text"] is not None)
    assert Counter((r["doc_id"], r["text"]) for r in got if r["text"] is not None and r["doc_id"] is not None) == Counter(
        (r["doc_id"], want[r["doc_id"], r["text"]]) for r in docs if r["doc_id"] is not None and r["text"] is not None)


def test_a_large_leaf_takes_bounded_time():
    rng = random.Random(5)
    forms = [[b"w%d" % rng.randrange(9000) for _ in range(12)] for _ in range(3000)]
    lines = {}
    for _ in range(60_000):
        t = [b"a", b"b", b"c", *rng.choice(forms)[3:]]
        t[rng.randrange(3, 12)] = b"v%d" % rng.randrange(10_000)
        lines[tuple(t)] = rng.getrandbits(60)
    found = templates._several([(h, list(t)) for t, h in lines.items()], 3, 0.7)
    assert len(found) > 0.9 * len(lines) and len(set(found.values())) < 4000


OTHER = ["Suomen kieli on uralilaisten kielten itämerensuomalaiseen ryhmään kuuluva kieli, jota puhuvat suomalaiset.",
         "日本語は、主に日本国内や日本人同士の間で使用されている言語である。", "asdfghjkl qwertyuiop zxcvbnm poiuytrewq lkjhgfdsa",
         "Język polski należy do grupy języków zachodniosłowiańskich, stanowiących część rodziny języków.",
         "Xin chào các bạn, hôm nay trời đẹp quá, chúng ta đi chơi nhé.", "Русский язык относится к восточнославянской группе.",
         "Türk dili ya da Türkçe, çoğunlukla Anadolu'da konuşulan bir dildir.", "A magyar nyelv az uráli nyelvcsalád tagja, a finnugor nyelvek közé tartozik.",
         "Kiswahili ni lugha ya Kibantu yenye misamiati mingi ya Kiarabu.", "Ελληνική γλώσσα είναι μία ινδοευρωπαϊκή γλώσσα."]


def test_languages_that_were_not_learned_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, with_usual=True)
    held = docs.where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0) & F.col("text").rlike("[a-z]{3}"))
    assert langid.keep_known(held, model).count() >= 0.99 * held.count()
    others = spark.createDataFrame([(t,) for t in OTHER], "text string")
    assert langid.keep_known(others, model).count() <= 0.1 * len(OTHER)
    assert (model.strangeness(["", "12 34", "x"]) < 15).all() and langid.LanguageModel([], None).strangeness(["a"]).tolist() == [0.0]


DOC = "doc_id long, text string, lang string, source string, n_chars long"


def test_near_dedup_names_rows_without_an_id_by_their_text(spark):
    text = " ".join(f"word{k}" for k in range(60))
    rows = [(7, text, "en", "a", 1), (None, text, "en", "b", 1), (None, "lonely words here", "en", "c", 1), (None, "lonely words here", "en", "d", 1),
            (9, text, "de", "z", 1), (9, text, "de", "y", 1), (11, None, None, None, None), (12, "", "en", "e", 0)]
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, DOC), SF).collect()
    assert sorted((r["doc_id"] or 0, r["source"] or "") for r in got) == [(0, "c"), (7, "a"), (11, "")]
    twice = corpus_pipeline.near_dedup(spark, spark.createDataFrame([(9, text, "de", "z", 1), (9, text, "de", "y", 1)], DOC), SF).collect()
    assert [(r["doc_id"], r["source"]) for r in twice] == [(9, "y")]


def test_stages_on_empty_tables_and_clashing_columns(spark, tmp_path):
    docs = spark.createDataFrame([], DOC + ", _key int, _first int, _one int, kept int, template int")
    for name, stage in corpus_pipeline.STAGES[2:4]:
        assert stage(spark, docs, SF).count() == 0 and stage(spark, docs, SF).columns == docs.columns, name


def test_comparing_by_blocks_changes_nothing(monkeypatch):
    rng = random.Random(6)
    for _ in range(150):
        size, base = rng.randrange(5, 14), [[b"w%d" % rng.randrange(4) for _ in range(14)] for _ in range(4)]
        lines = {}
        for _ in range(rng.randrange(2, 90)):
            t = [b"a", b"b", b"c", *rng.choice(base)[3:size]]
            for _ in range(rng.randrange(3)):
                t[rng.randrange(3, size)] = rng.choice([b"<*>", b"v%d" % rng.randrange(9)])
            lines[tuple(t)] = rng.getrandbits(62)
        rows = [(h, list(t)) for t, h in lines.items()]
        found = []
        for few in (0, 64, 10**9):
            monkeypatch.setattr(templates, "FEW", few)
            found.append(templates._several(rows, 3, 0.7) if len(rows) > 1 else {})
        assert found[0] == found[1] == found[2]
