"""Request planning for spatial web APIs.

The HTTP call itself is outside the engine.  What the original tool computes
around it is data: for each job, the URL and ordered query parameters of
every page request.  Here that is one projection (plus an ``explode`` for
offset pages) over a table of jobs, so any number of jobs is planned at once.

Parameters are an ordered ``array<struct<k, v>>`` with dictionary-update
semantics: overriding an existing key keeps its position, new keys are
appended, exactly like updating an insertion-ordered dict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geospan.operators.pages import next_link, usable

PARAM_TYPE = "array<struct<k:string,v:string>>"

# Fixed request constants of the supported API families.
ARCGIS_BASE = (("f", "geojson"), ("outFields", "*"), ("where", "1=1"), ("returnGeometry", "true"))
ARCGIS_SPATIAL = (("geometryType", "esriGeometryEnvelope"),
                  ("spatialRel", "esriSpatialRelIntersects"))
WFS_DEFAULT_VERSION = "2.0.0"
WFS_OUTPUT_FORMAT = "application/json"
WFS_CRS = "EPSG:4326"
DEFAULT_PAGE_LIMIT = 1000


def drop_null_params(params: Column) -> Column:
    return F.filter(params, lambda e: e.v.isNotNull())


def rfc3986(s: Column) -> Column:
    """Percent-encode like RFC 3986 (unreserved ``A-Z a-z 0-9 - . _ ~`` kept,
    space as ``%20``) on top of Spark's form encoder."""
    enc = F.url_encode(s)
    return F.replace(F.replace(F.replace(enc, F.lit("+"), F.lit("%20")),
                               F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def query_string(params: Column) -> Column:
    """SC9: ``k1=v1&k2=v2`` with both sides percent-encoded, in order."""
    return F.array_join(F.transform(drop_null_params(params), lambda e: F.concat(
        rfc3986(e.k), F.lit("="), rfc3986(e.v))), "&")


def _opt(col_name: str, jobs: DataFrame, default=None) -> Column:
    if col_name in jobs.columns:
        c = F.col(col_name)
        return F.coalesce(c, F.lit(default)) if default is not None else c
    return F.lit(default)


# --- SQL-text builders --------------------------------------------------------
# The planners below write their parameter logic as SQL expression text: one
# ``expr`` call per step instead of hundreds of Py4J calls to assemble nested
# lambdas, so planning stays fast.  A key that is there keeps its
# place and takes the new value; new keys come after, in their order.

def _sq(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _arr_sql(pairs) -> str:
    """``pairs``: (key, value-SQL) -> ordered param array SQL."""
    items = ", ".join(f"named_struct('k', {_sq(k)}, 'v', CAST({v} AS STRING))" for k, v in pairs)
    return f"CAST(array({items}) AS {PARAM_TYPE})"


def _update_sql(p: str, u: str) -> str:
    return (f"concat(transform({p}, e -> named_struct('k', e.k, 'v', "
            f"coalesce(get(filter({u}, x -> x.k = e.k), 0).v, e.v))), "
            f"filter({u}, x -> NOT array_contains(transform({p}, e -> e.k), x.k)))")


def _map_sql(m: str) -> str:
    return (f"CAST(transform(map_entries(coalesce({m}, map())), "
            f"e -> named_struct('k', e.key, 'v', e.value)) AS {PARAM_TYPE})")


_EMPTY = f"CAST(array() AS {PARAM_TYPE})"
_CSV = ("concat_ws(',', CAST(bbox.xmin AS STRING), CAST(bbox.ymin AS STRING), "
        "CAST(bbox.xmax AS STRING), CAST(bbox.ymax AS STRING))")


def _col_or(jobs: DataFrame, name: str, default_sql: str) -> str:
    return f"coalesce(`{name}`, {default_sql})" if name in jobs.columns else default_sql


def _steps(df: DataFrame, first: str, *updates: str) -> DataFrame:
    """Build the ordered params in ``_p`` one update per projection, so each
    step references a column instead of re-inlining the previous one."""
    out = df.withColumn("_p", F.expr(first))
    for u in updates:
        out = out.withColumn("_p", F.expr(_update_sql("_p", u)))
    return out


def _custom_sql(jobs: DataFrame) -> str:
    return _map_sql("params") if "params" in jobs.columns else _EMPTY


_ARCGIS_SPATIAL_SQL = (f"CASE WHEN bbox IS NULL THEN {_EMPTY} ELSE "
                       + _arr_sql([("geometry", _CSV)] + [(k, _sq(v)) for k, v in ARCGIS_SPATIAL])
                       + " END")


def plan_arcgis(jobs: DataFrame, n_pages: int | str = 1) -> DataFrame:
    """A1: one request per page offset: ``{url}/query`` with the fixed
    GeoJSON query params, the envelope filter, custom params, and finally
    ``resultOffset`` / ``resultRecordCount``.  ``n_pages``: a number, or the name of a column with each
    job's number of pages, or with an array of the pages to ask for.  Where the number isn't known,
    ``next_requests`` goes on from the answers until a page is short, without a limit."""
    limit = _col_or(jobs, "max_records", str(DEFAULT_PAGE_LIMIT))
    if isinstance(n_pages, str) and isinstance(jobs.schema[n_pages].dataType, T.ArrayType):
        listed = f"`{n_pages}`"  # the pages themselves
    else:
        listed = f"sequence(0, {f'`{n_pages}`' if isinstance(n_pages, str) else int(n_pages)} - 1)"
    out = _steps(jobs, _arr_sql([(k, _sq(v)) for k, v in ARCGIS_BASE]),
                 _ARCGIS_SPATIAL_SQL, _custom_sql(jobs))
    out = out.withColumn("page", F.explode(F.expr(f"CAST({listed} AS ARRAY<INT>)")))
    paging = _arr_sql([("resultOffset", f"page * CAST({limit} AS BIGINT)"),
                       ("resultRecordCount", f"CAST({limit} AS BIGINT)")])
    return (out.withColumn("request_base", F.concat(F.col("url"), F.lit("/query")))
               .withColumn("request_params", F.expr(_update_sql("_p", paging))).drop("_p"))


def plan_arcgis_count(jobs: DataFrame) -> DataFrame:
    """A1, step 0: one ``returnCountOnly=true`` request per job.  Its answer
    (``{"count": n}``) gives the number of offset pages to plan, so all pages
    of all jobs can be requested in parallel instead of one after another."""
    out = _steps(jobs, _arr_sql([(k, _sq(v)) for k, v in ARCGIS_BASE]),
                 _ARCGIS_SPATIAL_SQL, _custom_sql(jobs),
                 _arr_sql([("returnCountOnly", "'true'")]))
    return out.withColumn("count_url", F.concat(F.col("url"), F.lit("/query?"),
                                                query_string(F.col("_p")))).drop("_p")


def pages_from_count(count_body: Column, limit) -> Column:
    """Number of offset pages from a count response body ``{"count": n}``.
    At least one page is planned so an empty answer is still confirmed."""
    n = F.get_json_object(count_body, "$.count").cast("long")
    lim = F.lit(int(limit)) if isinstance(limit, int) else limit
    return F.greatest(F.ceil(n / lim), F.lit(1)).cast("int")


def plan_wfs(jobs: DataFrame) -> DataFrame:
    """A2: a single GetFeature request; the box carries the CRS as 5th item."""
    first = _arr_sql([("service", "'WFS'"),
                      ("version", _col_or(jobs, "version", _sq(WFS_DEFAULT_VERSION))),
                      ("request", "'GetFeature'"),
                      ("typeName", "`layer_name`" if "layer_name" in jobs.columns else "NULL"),
                      ("outputFormat", _sq(WFS_OUTPUT_FORMAT))])
    box = (f"CASE WHEN bbox IS NULL THEN {_EMPTY} ELSE "
           + _arr_sql([("bbox", f"concat({_CSV}, ',', {_sq(WFS_CRS)})")]) + " END")
    out = _steps(jobs, first, box, _custom_sql(jobs))
    return (out.withColumn("page", F.lit(0)).withColumn("request_base", F.col("url"))
               .withColumnRenamed("_p", "request_params"))


def plan_ogc(jobs: DataFrame) -> DataFrame:
    """A3: ``{url}/collections/{collection}/items?f=json&limit=..[&bbox=..]``;
    later pages follow ``next`` links (see ``assemble_linked_pages``)."""
    first = _arr_sql([("f", "'json'"), ("limit", _col_or(jobs, "limit", str(DEFAULT_PAGE_LIMIT)))])
    box = f"CASE WHEN bbox IS NULL THEN {_EMPTY} ELSE " + _arr_sql([("bbox", _CSV)]) + " END"
    out = _steps(jobs, first, box, _custom_sql(jobs))
    coll = "`collection`" if "collection" in jobs.columns else "NULL"
    return (out.withColumn("page", F.lit(0))
               .withColumn("request_base", F.expr(f"concat(url, '/collections/', {coll}, '/items')"))
               .withColumnRenamed("_p", "request_params"))


def bbox_params_sql(box: str = "bbox", api_type: str = "''") -> str:
    """A5: box -> params; ``bbox=minx,miny,maxx,maxy`` for WFS / OGC API, otherwise ``minx``, ``miny``,
    ``maxx``, ``maxy``; none without a box."""
    four = _arr_sql([("minx", f"{box}.xmin"), ("miny", f"{box}.ymin"), ("maxx", f"{box}.xmax"), ("maxy", f"{box}.ymax")])
    return (f"CASE WHEN {box} IS NULL THEN {_EMPTY} WHEN lower({api_type}) IN ('wfs', 'ogcapi') THEN "
            + _arr_sql([("bbox", _CSV.replace("bbox.", f"{box}."))]) + f" ELSE {four} END")


def plan_generic(jobs: DataFrame) -> DataFrame:
    """A4: user params, then the box params (box wins on a clash); headers
    stay in their own MAP column and are never folded into the URL."""
    box = bbox_params_sql("bbox", "`api_type`" if "api_type" in jobs.columns else "''")
    out = _steps(jobs, _EMPTY, _custom_sql(jobs), box)
    return (out.withColumn("page", F.lit(0)).withColumn("request_base", F.col("url"))
               .withColumnRenamed("_p", "request_params"))


def plan_requests(jobs: DataFrame, arcgis_pages: int | str = 1) -> DataFrame:
    """Dispatch on ``lower(api_type)`` and union the four planners.

    Output adds ``page``, ``request_base``, ``request_params`` and the full
    ``request_url``."""
    t = F.lower(_opt("api_type", jobs, ""))
    parts = [plan_arcgis(jobs.where(t == "arcgis"), arcgis_pages),
             plan_wfs(jobs.where(t == "wfs")),
             plan_ogc(jobs.where(t == "ogcapi")),
             plan_generic(jobs.where(~t.isin("arcgis", "wfs", "ogcapi")))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    qs = query_string(F.col("request_params"))
    return out.withColumn("request_url", F.when(qs == "", F.col("request_base")).otherwise(
        F.concat(F.col("request_base"), F.lit("?"), qs)))


def answers(responses: DataFrame) -> DataFrame:
    """(job_name, page, ok, tried, failed, n, next, url) per request of a recording: has it a usable answer, how often was it
    tried and how often without success, its number of features, its next link and its own URL.

    ``responses``: job_name, page, request_url, body, and maybe status (200 or none is fine).  Bodies stay where they lie."""
    body = F.col("body")
    n = F.size(F.from_json(body, "struct<features: array<string>>").features)
    row = responses.select("job_name", "page", F.col("request_url").alias("url"), usable(responses, body.isNotNull()).alias("got"),
                           F.when(n >= 0, n).alias("n"), next_link(body).alias("next"))
    first = F.min(F.when(F.col("got"), F.struct(F.col("n").isNull().alias("odd"), "n", "next", "url")))
    return (row.groupBy("job_name", "page").agg(F.max("got").alias("ok"), F.count("*").alias("tried"), F.count_if(~F.col("got")).alias("failed"), first.alias("a"))
            .select("job_name", "page", "ok", "tried", "failed", "a.n", "a.next", "a.url"))


def next_requests(jobs: DataFrame, responses: DataFrame, ahead: int = 1, attempts: int = 3) -> DataFrame:
    """The requests that are still to be made, given the recorded answers: job_name, page, api_type, request_url, attempt.

    Without answers these are the first pages of all jobs; asked again and again, with what came in
    between, they end when every job is complete or has failed ``attempts`` times on some page.

    * ArcGIS: until a page has fewer features than the job's page size (``max_records``, default 1000), all
      pages up to the last answered one and ``ahead`` more, those without a usable answer; with a column
      ``feature_count``, all that it asks for at once.  Pages after the first short one aren't asked for.
    * OGC API: the next link of every answered page, unless the job has it already (a cycle ends).
    * WFS and generic: the one page.

    A usable answer has status 200 and a body, with ``features`` for ArcGIS, WFS and OGC.  An error never ends a
    job.  ``responses``: see ``answers``.  One aggregate over slim rows, then joins by job.
    """
    kind = F.lower(_opt("api_type", jobs, ""))
    seen = answers(responses)
    known = jobs.select("job_name", kind.alias("_kind"), F.expr(_col_or(jobs, "max_records", str(DEFAULT_PAGE_LIMIT))).cast("long").alias("_size"),
                        _opt("feature_count", jobs).cast("long").alias("_total"))
    strict = F.col("_kind").isin("arcgis", "wfs", "ogcapi")
    seen = seen.join(known.select("job_name", "_kind", "_size"), "job_name").withColumn("ok", F.col("ok") & (~strict | F.col("n").isNotNull())).checkpoint()
    done = seen.where("ok")

    # offset pages
    per = done.where("_kind = 'arcgis'").groupBy("job_name").agg(
        F.min(F.when(F.col("n") < F.col("_size"), F.col("page"))).alias("_stop"), F.max("page").alias("_top"))
    wanted = known.where("_kind = 'arcgis'").join(per, "job_name", "left")
    last = F.coalesce(F.col("_stop"), F.when(F.col("_total").isNotNull(), F.greatest(F.ceil(F.col("_total") / F.col("_size")) - 1, F.lit(0))),
                      F.coalesce("_top", F.lit(-1)) + ahead).cast("int")
    offsets = wanted.select("job_name", F.explode(F.sequence(F.lit(0), last)).alias("page"))
    # links; the first page of everything else
    links = done.where("_kind = 'ogcapi' AND next IS NOT NULL").select("job_name", (F.col("page") + 1).cast("int").alias("page"), F.col("next").alias("_url"))
    links = links.join(done.select("job_name", F.col("url").alias("_url")), ["job_name", "_url"], "left_anti")
    firsts = known.where("_kind <> 'arcgis'").select("job_name", F.lit(0).alias("page"), F.lit(None).cast("string").alias("_url"))
    asked = (offsets.withColumn("_url", F.lit(None).cast("string")).unionByName(links).unionByName(firsts)
             .join(seen.select("job_name", F.col("page").cast("int").alias("page"), "ok", "tried"), ["job_name", "page"], "left")
             .where(~F.coalesce("ok", F.lit(False)) & (F.coalesce("tried", F.lit(0)) < attempts))
             .select("job_name", "page", "_url", (F.coalesce("tried", F.lit(0)) + 1).cast("int").alias("attempt")))
    pages = asked.groupBy("job_name").agg(F.array_sort(F.collect_set("page")).alias("_pages"))  # of one job
    planned = plan_requests(jobs.join(pages, "job_name"), arcgis_pages="_pages").select("job_name", "page", "api_type", "request_url")
    linked = (asked.where("_url IS NOT NULL").join(jobs.select("job_name", "api_type"), "job_name")
              .select("job_name", "page", "api_type", F.col("_url").alias("request_url"), "attempt"))
    return planned.join(asked.where("_url IS NULL").drop("_url"), ["job_name", "page"]).unionByName(linked)


def job_progress(jobs: DataFrame, responses: DataFrame, attempts: int = 3) -> DataFrame:
    """(job_name, requests, failed, state) per job: ``complete`` when nothing is left to ask for and nothing was given
    up, ``failed`` when nothing is left but a page was given up, else ``open``."""
    left = next_requests(jobs, responses, attempts=attempts).groupBy("job_name").agg(F.count("*").alias("_left"))
    ever = next_requests(jobs, responses, attempts=2**31 - 1).groupBy("job_name").agg(F.count("*").alias("_ever"))
    tried = answers(responses).groupBy("job_name").agg(F.sum("tried").alias("requests"), F.sum("failed").alias("failed"))
    return (jobs.select("job_name").join(left, "job_name", "left").join(ever, "job_name", "left").join(tried, "job_name", "left")
            .select("job_name", F.coalesce("requests", F.lit(0)).alias("requests"), F.coalesce("failed", F.lit(0)).alias("failed"),
                    F.when(F.col("_left") > 0, "open").when(F.col("_ever") > 0, "failed").otherwise("complete").alias("state")))


# --- A10: presets that produce job rows ---------------------------------------

def arcgis_layer_url(service_url: Column, layer_id: Column) -> Column:
    return F.concat(service_url, F.lit("/"), layer_id.cast("string"))


def arcgis_jobs(df: DataFrame, service_url: str = "service_url", layer_id: str = "layer_id"
                ) -> DataFrame:
    """ArcGIS preset: one job per (service, layer id), url ``{service}/{layer}``."""
    return df.withColumn("url", arcgis_layer_url(F.col(service_url), F.col(layer_id))) \
             .withColumn("api_type", F.lit("arcgis"))


def wfs_jobs(df: DataFrame, wfs_url: str = "wfs_url", layer_name: str = "layer_name"
             ) -> DataFrame:
    """WFS preset: version 2.0.0, the layer as ``typeName``."""
    return (df.withColumn("url", F.col(wfs_url)).withColumn("api_type", F.lit("wfs"))
              .withColumn("version", F.lit(WFS_DEFAULT_VERSION))
              .withColumn("layer_name", F.col(layer_name)))


def s3_jobs(df: DataFrame, bucket: str = "bucket", key: str = "key") -> DataFrame:
    """S3 preset: ``s3://bucket/key`` file jobs (read through the Hadoop
    ``s3a`` connector; credentials go to Hadoop options, never to rows)."""
    return df.withColumn("url", F.concat(F.lit("s3://"), F.col(bucket), F.lit("/"), F.col(key)))
