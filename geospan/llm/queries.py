"""Registered queries of the llm operators: one opN_<name> for each, over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from geospan.llm import bpe, html, langid, mining, packing, quality, simhash, spotsigs, templates, topk, toxicity, warc, whitening
from geospan.llm.common import held_out, table


def op1_spotsigs(spark, sf_dir):
    return spotsigs.edited_pairs(table(spark, sf_dir, "documents"))


def op2_templates(spark, sf_dir):
    kept = templates.drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"), several=True, least_tokens=1, characters=True)
    return kept.select("doc_id", "text", "n_lines", "n_dropped")


def op3_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_topk(spark, sf_dir):
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.where("vec_id % 50 = 0"), vectors, k=5)


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_bpe(spark, sf_dir):
    return bpe.encode_digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def packed(docs):
    import public_tokenizers

    return packing.pack(packing.tokenised_pieces(docs, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


def op6_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"))


def op7_html(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


def op8_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_simhash(spark, sf_dir):
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return groups.select("doc_id", simhash.hex64(F.col("fp")).alias("fingerprint"), "component_id")


def op11_whitening(spark, sf_dir):
    found = whitening.whiten(whitening.integer_entries(table(spark, sf_dir, "embeddings")), components=8)
    # exact at any size; a sum beyond the longs (about a million rows of 64 entries) is null here
    return found.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def op12_quality(spark, sf_dir):
    found = quality.clean(table(spark, sf_dir, "documents"), keep_text=False)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                        "n_lines", "n_failed_lines", "lost_chars")


def op13_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    rows = mining.labelled_integers(table(spark, sf_dir, "embeddings"), label=label)
    return mining.hard_negatives(F.col("vec_id") % 100 == 0, rows).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _text(pattern: str) -> str:
    """A pattern as an SQL string."""
    return "'" + pattern.replace("'", "''") + "'"


QUERIES = {f.__name__: f for f in (op1_spotsigs, op2_templates, op3_language, op4_topk, op5_bpe, op6_packing, op7_html, op8_warc,
                                    op9_toxicity, op10_simhash, op11_whitening, op12_quality, op13_negatives)}
ORACLE: dict[str, str] = {
    "op8_warc": """
        WITH p AS (
            SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                   sha1(encode(coalesce(html, ''))) AS payload_digest
            FROM pages
        ), kept AS (
            SELECT payload_digest, max(page_id) AS kept FROM p WHERE payload_bytes >= 1000 GROUP BY 1
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN kept IS NULL OR page_id IS NOT DISTINCT FROM kept THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN kept END AS refers_to
        FROM p LEFT JOIN kept USING (payload_digest)
    """,
    "op4_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op12_quality": f"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
        ), parts AS (
            SELECT r, string_split(text, chr(10)) AS p FROM docs
        ), lines AS (
            SELECT r, unnest(range(len(p))) AS place, unnest(p) AS line FROM parts
        ), worded AS (
            SELECT r, place, line, regexp_extract_all(line, {_text(quality.WORD)}) AS w FROM lines
        ), counted AS (
            SELECT r, place, line, len(w) AS n, len(array_to_string(w, '')) AS chars,
                   len(regexp_extract_all(line, {_text(quality.SYMBOL)})) AS symbols,
                   len(regexp_extract_all(line, {_text(quality.MARKS)})) AS marks,
                   len(list_filter(w, lambda x: regexp_full_match(x, {_text(quality.SEPARATOR)}))) AS parted,
                   row_number() OVER (PARTITION BY r, line ORDER BY place) > 1 AS again
            FROM worded WHERE len(w) > 0
        ), judged AS (
            SELECT *, again OR NOT (regexp_matches(line, {_text(quality.ENDS)}) OR regexp_matches(line, {_text(quality.HOLDS)}))
                      OR 10 * (symbols - 1) > n OR 10 * (marks - 1) > n OR (parted >= 2 AND n - parted <= 4 * (parted + 1))
                      OR (n <= {quality.NOTICE_WORDS} AND (regexp_matches(line, {_text(quality.MENU)}) OR regexp_matches(line, {_text(quality.NOTICE)}))) AS fails
            FROM counted
        ), by_line AS (
            SELECT r, sum(n) AS n_words, sum(chars) AS word_chars, sum(symbols) AS n_symbols, count(*) FILTER (WHERE again) AS n_dup_lines,
                   count(*) AS n_lines, count(*) FILTER (WHERE fails) AS n_failed_lines, coalesce(sum(chars) FILTER (WHERE fails), 0) AS lost_chars
            FROM judged GROUP BY r
        ), whole AS (
            SELECT r, regexp_extract_all(text, {_text(quality.WORD)}) AS w FROM docs
        ), windows AS (
            SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_zip(w[1:len(w) - 2], w[2:len(w) - 1], w[3:len(w)])) AS g FROM whole WHERE len(w) > 2
        ), twice AS (
            SELECT r, i, count(*) OVER (PARTITION BY r, g) > 1 AS again FROM windows
        ), repeated AS (
            SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(3) AS t(k) WHERE again GROUP BY r
        ), found AS (
            SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
                   CAST(coalesce(n_symbols, 0) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
                   CAST(coalesce(n_failed_lines, 0) AS BIGINT) AS n_failed_lines, CAST(coalesce(lost_chars, 0) AS BIGINT) AS lost_chars
            FROM docs LEFT JOIN by_line USING (r) LEFT JOIN repeated USING (r)
        ), based AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM found
        )
        SELECT *, NOT base_failed AND 100 * lost_chars <= 30 * word_chars AS kept FROM based
    """,
    "op13_negatives": """
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ), pairs AS (
            SELECT a.r AS ar, a.vec_id AS anchor_id, c.r AS cr, c.vec_id, a.label = c.label AS same,
                   CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.r <> c.r
        ), positive AS (
            SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, cr) AS p FROM pairs WHERE same QUALIFY p <= 5
        ), ranked AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
                   CAST(row_number() OVER (PARTITION BY p.ar, p.p ORDER BY n.score DESC, n.vec_id, n.cr) AS INTEGER) AS rank
            FROM positive p JOIN pairs n ON p.ar = n.ar AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
    """,
}
