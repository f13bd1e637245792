"""Page assembly for paged GIS web APIs.

Responses arrive as a table, in any order and any partitioning.  Assembly is
expressed with aggregates and joins keyed by job, so thousands of jobs are
assembled at once and no job's pages pass through one task or the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geospan.session import ensure_checkpoint_dir
from geospan.sources.responses import parse_features

DEFAULT_LIMIT = 1000  # features per page (ArcGIS ``max_records``, OGC ``limit``)


def usable(responses: DataFrame, valid) -> F.Column:
    """Status 200, where there is a ``status`` column, and a body for which ``valid`` holds."""
    ok = F.coalesce(valid, F.lit(False))
    if "status" in responses.columns:
        ok &= F.coalesce(F.col("status").cast("int") == 200, F.lit(True))
    return ok


def chosen(responses: DataFrame, keys: list[str], body: str, valid, facts: dict) -> DataFrame:
    """One usable response per key: (keys, ``facts``, _hash, _copies), without its body.  Recorded more than once, the
    one with the smallest body hash counts; _copies is how many usable ones there are.

    Bodies are read and summed up where they lie; only these slim rows are shuffled.  The table is
    checkpointed, as several steps use it."""
    slim = responses.where(usable(responses, valid)).select(*keys, F.xxhash64(body).alias("_hash"), *[c.alias(n) for n, c in facts.items()])
    best = F.min(F.struct("_hash", *facts))
    return slim.groupBy(*keys).agg(best.alias("_best"), F.count("*").alias("_copies")).select(*keys, "_best.*", "_copies").checkpoint()


def with_bodies(responses: DataFrame, slim: DataFrame, kept: DataFrame, keys: list[str], body: str) -> DataFrame:
    """The bodies of the responses in ``kept``, a part of ``slim``, the ``chosen`` ones: one join on the keys, the only
    exchange of bodies (none where ``kept`` is small enough that Spark broadcasts it).  The body's hash tells the chosen
    response from others of its key, so no body is parsed for that."""
    rows = responses.where(usable(responses, F.col(body).isNotNull())).select(*keys, *[c for c in responses.columns if c not in kept.columns and c not in keys])
    same = rows.join(kept.drop("_copies"), keys).where(F.xxhash64(body) == F.col("_hash"))
    if (slim.agg(F.max("_copies")).first()[0] or 0) > 1:
        # equal bodies of a row of ``kept``
        same = same.dropDuplicates([c for c in kept.columns if c not in ("_hash", "_copies")])
    return same.drop("_hash")


def assemble_offset_pages(responses: DataFrame, limit: int | str = DEFAULT_LIMIT, job: str = "job",
                          off: str = "off", body: str = "body",
                          properties_schema: str | None = None,
                          total: str | None = None) -> DataFrame:
    """Concatenate offset pages per job, stopping at the first page that
    is empty or shorter than ``limit``.  Pages after the stop are ignored.

    ``limit`` is a number, or the name of a column with each job's own page
    size.  A page recorded twice counts once; an error response or a body
    without ``features`` never ends a job.  ``total`` may name a column with the
    job's feature count: full pages that reach it are complete without a
    short page after them.

    ``complete`` is false when the job has no terminating page or when an
    offset between 0 and the stop is missing.  The per-job stop is a partial
    aggregate (one row per job), joined back to the pages.
    """
    # Counting only needs the array length: parsing features as raw strings
    # is cheaper than splitting them into properties and geometry.
    count = F.size(F.from_json(F.col(body), "struct<features: array<string>>").features)
    size = F.col(limit) if isinstance(limit, str) else F.lit(limit)
    slim = chosen(responses, [job, off], body, count >= 0, {
        "_n": count, "_size": size.cast("long"), "_total": (F.col(total) if total else F.lit(None)).cast("long")})
    stops = slim.groupBy(job).agg(F.min(F.when(F.col("_n") < F.col("_size"), F.col(off))).alias("_stop"))
    full = ((F.col("_stop").isNull() | (F.col(off) < F.col("_stop"))) & (F.col("_n") >= F.col("_size"))
            & (F.pmod(F.col(off), F.col("_size")) == 0))
    status = (slim.join(stops, job)
              .groupBy(job, "_stop")  # an offset is one row by now, so counting is a partial sum
              .agg(F.count_if(full).alias("_full"), F.max("_size").alias("_size"), F.max("_total").alias("_total"),
                   F.max(F.col(off)).alias("_last"))
              .withColumn("complete", F.when(F.col("_stop").isNotNull(),
                                             F.col("_full") == (F.col("_stop") / F.col("_size")).cast("long"))
                          .otherwise(F.coalesce((F.col("_full") * F.col("_size") >= F.col("_total"))
                                                & (F.col("_full") == F.col("_last") / F.col("_size") + 1), F.lit(False))))
              .drop("_full", "_size", "_total", "_last"))
    kept = (slim.select(job, off, "_hash", "_copies").join(status, job)
            .where(F.col("_stop").isNull() | (F.col(off) <= F.col("_stop"))).drop("_stop"))
    return parse_features(with_bodies(responses, slim, kept, [job, off], body), body=body, properties_schema=properties_schema)


def next_link(body: F.Column) -> F.Column:
    """The first ``links[rel=next].href`` of a page."""
    links = F.from_json(body, "struct<links: array<struct<rel: string, href: string>>>").links
    return F.get(F.filter(links, lambda l: l.rel == "next"), 0).href


def next_links(pages: DataFrame, url: str = "url", body: str = "body") -> DataFrame:
    """(url, next) edges of the pages."""
    return pages.select(F.col(url).alias("src"), next_link(F.col(body)).alias("dst")).distinct()


def chain_steps(edges: DataFrame, starts: DataFrame, job: str = "job", max_rounds: int = 64,
                checkpoint: bool = True) -> DataFrame:
    """Distance of every page reachable from each job's start url.

    Pointer doubling: round k joins the reached set with the 2^k-hop jump
    table, then squares the jump table by a self-join; ceil(log2(pages))
    rounds.  Both tables are checkpointed each round (to the shared
    ``spark.checkpoint.dir``) so plans stay flat and lost executors only
    recompute one round.  A cycle yields each page once and terminates.
    """
    jump = edges.where(F.col("dst").isNotNull()).select("src", "dst")
    reached = starts.select(job, F.col("url"), F.lit(0).cast("long").alias("step"))
    if checkpoint:
        ensure_checkpoint_dir(edges.sparkSession)
        jump = jump.checkpoint(eager=True)
        reached = reached.checkpoint(eager=True)
    hop = 1
    n_prev = reached.count()
    for _ in range(max_rounds):
        new = (reached.join(jump, reached.url == jump.src)
               .select(job, F.col("dst").alias("url"), (F.col("step") + hop).alias("step")))
        nxt_reached = (reached.unionByName(new).groupBy(job, "url")
                       .agg(F.min("step").alias("step")))
        a, b = jump.alias("a"), jump.alias("b")
        nxt_jump = a.join(b, F.col("a.dst") == F.col("b.src")).select(
            F.col("a.src").alias("src"), F.col("b.dst").alias("dst")).distinct()
        if checkpoint:
            nxt_reached = nxt_reached.checkpoint(eager=True)
            nxt_jump = nxt_jump.checkpoint(eager=True)
        # One small job gives both stopping signals: the size of the reached
        # set (unchanged -> a cycle closed) and whether any page still has a
        # successor 2*hop links ahead (none -> every chain is covered).
        stats = (nxt_reached.select(F.lit(1).alias("r"), F.lit(0).alias("j"))
                 .unionByName(nxt_jump.limit(1).select(F.lit(0).alias("r"), F.lit(1).alias("j")))
                 .agg(F.count_if(F.col("r") == 1).alias("n"),
                      F.count_if(F.col("j") == 1).alias("more"))).first()
        reached, jump, hop = nxt_reached, nxt_jump, hop * 2
        if stats["n"] == n_prev or stats["more"] == 0:
            return reached
        n_prev = stats["n"]
    raise RuntimeError(f"next links go on after {max_rounds} rounds of doubling")


def assemble_linked_pages(pages: DataFrame, starts: DataFrame, job: str = "job",
                          url: str = "url", body: str = "body",
                          properties_schema: str | None = None) -> DataFrame:
    """Follow ``rel=next`` links from each job's start url.

    Output: one row per feature with ``step`` (page order) and ``_pos``
    (order in page), plus ``complete`` = no reached link points at a missing
    page.
    """
    valid = (F.from_json(F.col(body), "struct<features: array<string>>").isNotNull()
             & F.get_json_object(body, "$.features").isNotNull())
    slim = chosen(pages, [url], body, valid, {"_next": next_link(F.col(body))})
    edges = slim.select(F.col(url).alias("src"), F.col("_next").alias("dst"))
    steps = chain_steps(edges, starts.select(job, F.col(url).alias("url")), job).withColumnRenamed("url", url)
    reached = steps.join(slim.select(url, "_hash", "_copies"), url, "left")
    status = reached.groupBy(job).agg((F.count_if(F.col("_copies").isNull()) == 0).alias("complete"))
    kept = reached.where("_copies IS NOT NULL").join(status, job)
    found = with_bodies(pages.select(url, body, *[c for c in pages.columns if c == "status"]), slim, kept, [url], body)
    return parse_features(found.drop("status"), body=body, properties_schema=properties_schema)


def assemble_single_page(responses: DataFrame, body: str = "body",
                         properties_schema: str | None = None) -> DataFrame:
    """A9 (WFS): each response is the whole answer; no features -> no rows."""
    return parse_features(responses, body=body, properties_schema=properties_schema)
