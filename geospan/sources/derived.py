"""Spatial inputs derived from the driver's tables (see FIXTURES.md part 3).

The test tables hold no geometry, so features and job boxes are computed from
keys with integer arithmetic in units of 1e-4 degree, then written as decimal
text.  Every builder is a plain projection (or a bounded per-block window) of
its source table, so its work grows linearly with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geospan.functions.bbox import make_bbox
from geospan.functions.envelope import text_to_wkb
from geospan.stores import file_system

UNIT = 10000  # integer units per degree

# Fixed derivation constants (FIXTURES.md part 3).
X_MULT, Y_MULT = 7919, 104729
X_SPAN, Y_SPAN = 3400000, 1600000
W_MULT, H_MULT, SIDE_MOD = 31, 17, 5000
BOX_SIDE_MOD = 50000           # F-G: boxes up to 5 degrees
PAGE_SIZE = 100                # F-H / F-I: features per page
KEY_BLOCK = 10000              # pages are numbered within blocks of keys


# Tables small enough that spreading them over tasks is not worth a shuffle.
SMALL_TABLES = ("region", "nation")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df if name in SMALL_TABLES else balanced(df)


BALANCE_MIN_BYTES = 1 << 20


def balanced(df: DataFrame, min_partitions: int | None = None,
             min_bytes: int = BALANCE_MIN_BYTES) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has cores
    (e.g. one file with a single row group) with a round-robin repartition.

    Inputs that already split into many tasks are returned unchanged, and so
    are inputs smaller than ``min_bytes`` by the optimizer's size estimate
    (no job is run): spreading a tiny table costs more than it saves."""
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # estimate unavailable: fall back to the partition test
        size = min_bytes
    if size < min_bytes:
        return df
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def _deg(units: Column) -> Column:
    return units.cast("double") / UNIT


# The rectangle builders below are written as SQL expression text: one
# ``expr`` call per column keeps driver-side planning cheap (a Column tree
# built call by call costs hundreds of Py4J round trips per query).

def _rect_sql(key: str, size_key: str, side_mod: int = SIDE_MOD) -> dict:
    x0 = f"(pmod({key} * {X_MULT}, {X_SPAN}) - {X_SPAN // 2})"
    y0 = f"(pmod({key} * {Y_MULT}, {Y_SPAN}) - {Y_SPAN // 2})"
    return {"x0": x0, "y0": y0,
            "x1": f"({x0} + pmod({size_key} * {W_MULT}, {side_mod}) + 1)",
            "y1": f"({y0} + pmod({size_key} * {H_MULT}, {side_mod}) + 1)"}


def _deg_sql(u: str) -> str:
    return (f"concat(CASE WHEN {u} < 0 THEN '-' ELSE '' END, "
            f"CAST(CAST(abs({u}) DIV {UNIT} AS BIGINT) AS STRING), '.', "
            f"lpad(CAST(pmod(abs({u}), {UNIT}) AS STRING), 4, '0'))")


def _pt_sql(x: str, y: str, sep: str = " ") -> str:
    return f"{_deg_sql(x)}, '{sep}', {_deg_sql(y)}"


def _ring_wkt_sql(pts) -> str:
    inner = ", ', ', ".join(_pt_sql(x, y) for x, y in pts)
    return f"concat('POLYGON ((', {inner}, '))')"


def _ring_geojson_sql(pts) -> str:
    inner = ", ',', ".join(f"'[', {_pt_sql(x, y, ',')}, ']'" for x, y in pts)
    return f"""concat('{{"type":"Polygon","coordinates":[[', {inner}, ']]}}')"""


def _rect_pts(r):
    return [(r["x0"], r["y0"]), (r["x1"], r["y0"]), (r["x1"], r["y1"]),
            (r["x0"], r["y1"]), (r["x0"], r["y0"])]


def _bbox_sql(r) -> str:
    return (f"named_struct('xmin', CAST({r['x0']} AS DOUBLE) / {UNIT}, "
            f"'ymin', CAST({r['y0']} AS DOUBLE) / {UNIT}, "
            f"'xmax', CAST({r['x1']} AS DOUBLE) / {UNIT}, "
            f"'ymax', CAST({r['y1']} AS DOUBLE) / {UNIT})")


_ORDER_RECT = _rect_sql("o_orderkey", "o_custkey")


def rect_wkt() -> Column:
    """WKT of the order rectangle (F-A)."""
    return F.expr(_ring_wkt_sql(_rect_pts(_ORDER_RECT)))


def rect_geojson() -> Column:
    """GeoJSON geometry text of the order rectangle (F-C)."""
    return F.expr(_ring_geojson_sql(_rect_pts(_ORDER_RECT)))


def polygon_features(orders: DataFrame, keep=()) -> DataFrame:
    """F-A: one rectangle per order; layer = order priority."""
    return orders.select(
        "o_orderkey", *keep, F.col("o_orderpriority").alias("layer"),
        rect_wkt().alias("wkt"), F.expr(_bbox_sql(_ORDER_RECT)).alias("bbox"))


def triangle_features(orders: DataFrame) -> DataFrame:
    """F-A variant: right triangles (x0,y0),(x1,y0),(x0,y1) for exact tests."""
    r = _ORDER_RECT
    tri = [(r["x0"], r["y0"]), (r["x1"], r["y0"]), (r["x0"], r["y1"]), (r["x0"], r["y0"])]
    return orders.select(
        "o_orderkey", F.col("o_orderpriority").alias("layer"),
        F.expr(_ring_wkt_sql(tri)).alias("wkt"), F.expr(_bbox_sql(r)).alias("bbox"))


def geojson_features(orders: DataFrame) -> DataFrame:
    """F-C: F-A rectangles written as GeoJSON geometry text."""
    return orders.select("o_orderkey", F.col("o_orderpriority").alias("layer"),
                         rect_geojson().alias("geometry"))


def wkb_features(orders: DataFrame) -> DataFrame:
    """F-D: F-A rectangles as WKB bytes."""
    return polygon_features(orders).select("o_orderkey", "layer",
                                           text_to_wkb(F.col("wkt")).alias("geometry"))


def mixed_geometry(orders: DataFrame) -> DataFrame:
    """F-J: key mod 3 picks the encoding: GeoJSON, WKT, or hex WKB."""
    kind = F.pmod(F.col("o_orderkey"), F.lit(3))
    wkt = rect_wkt()
    geom = (F.when(kind == 0, rect_geojson())
            .when(kind == 1, wkt)
            .otherwise(F.hex(text_to_wkb(F.when(kind == 2, wkt)))))
    return orders.select("o_orderkey", F.col("o_orderpriority").alias("layer"),
                         geom.alias("geometry"))


def point_features(events: DataFrame, keep=()) -> DataFrame:
    """F-B: one point per event."""
    k = F.col("event_id")
    x = F.pmod(k * X_MULT, F.lit(X_SPAN)) - X_SPAN // 2
    y = F.pmod(k * Y_MULT, F.lit(Y_SPAN)) - Y_SPAN // 2
    return events.select("event_id", _deg(x).alias("lon"), _deg(y).alias("lat"),
                         "event_type", "value", *keep)


def job_boxes(nation: DataFrame) -> DataFrame:
    """F-E: 5 x 5 overlapping 80 x 40 degree boxes, one job per nation."""
    col = F.pmod(F.col("n_nationkey"), F.lit(5))
    row = (F.col("n_nationkey") / 5).cast("int")
    x0 = F.lit(-180) + col * 70
    y0 = F.lit(-90) + row * 34
    return nation.select(
        F.concat(F.lit("job_"), F.lower(F.col("n_name"))).alias("job_name"),
        F.col("n_name").alias("location"), F.col("n_regionkey"),
        make_bbox(x0, y0, x0 + 80, y0 + 40).alias("bbox"))


def many_boxes(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """F-G: one box (up to 5 x 5 degrees) per supplier / customer key."""
    r = _rect_sql(key, key, BOX_SIDE_MOD)
    return df.select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("job_name"),
                     F.expr(_bbox_sql(r)).alias("bbox"))


# ---------------------------------------------------------------------------
# Recorded API pages (F-H offset pages, F-I linked pages).
# ---------------------------------------------------------------------------

def _page_rows(orders: DataFrame) -> DataFrame:
    """Features numbered within their job.  A job is (layer, key block), so a
    window partition never holds more than ``KEY_BLOCK`` rows at any scale."""
    job = F.concat(F.col("o_orderpriority"), F.lit("/"),
                   (F.col("o_orderkey") / KEY_BLOCK).cast("long").cast("string"))
    w = Window.partitionBy("job").orderBy("o_orderkey")
    feat = F.concat(F.lit('{"type":"Feature","properties":{"o_orderkey":'),
                    F.col("o_orderkey").cast("string"), F.lit(',"layer":"'),
                    F.col("o_orderpriority"), F.lit('"},"geometry":'),
                    rect_geojson(), F.lit("}"))
    return (orders.select("o_orderkey", "o_orderpriority", job.alias("job"), feat.alias("feature"))
            .withColumn("rn", F.row_number().over(w) - 1)
            .withColumn("page", (F.col("rn") / PAGE_SIZE).cast("int")))


def _collection(features: Column, extra: Column | None = None) -> Column:
    parts = [F.lit('{"type":"FeatureCollection","features":['),
             F.array_join(features, ","), F.lit("]")]
    if extra is not None:
        parts += [F.lit(","), extra]
    return F.concat(*parts, F.lit("}"))


def _pages(orders: DataFrame) -> DataFrame:
    rows = _page_rows(orders)
    return (rows.groupBy("job", "page")
            .agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "feature"))).alias("fs"),
                 F.count(F.lit(1)).alias("n"))
            .withColumn("features", F.transform("fs", lambda s: s.feature)).drop("fs"))


def offset_pages(orders: DataFrame) -> DataFrame:
    """F-H: (job, off, status, body) pages of ``PAGE_SIZE`` features, plus one
    spurious page after each job's short last page (which must be ignored)."""
    pages = _pages(orders)
    real = pages.select("job", (F.col("page") * PAGE_SIZE).alias("off"),
                        F.lit(200).alias("status"), _collection(F.col("features")).alias("body"))
    last = pages.groupBy("job").agg(F.max(F.struct("page", "n", "features")).alias("l"))
    # After a short last page: a spurious page repeating it (must be ignored).
    # After a full last page: the empty page that ends the paging.
    tail = last.select(
        "job", ((F.col("l.page") + 1) * PAGE_SIZE).alias("off"), F.lit(200).alias("status"),
        _collection(F.when(F.col("l.n") < PAGE_SIZE, F.col("l.features"))
                    .otherwise(F.array().cast("array<string>"))).alias("body"))
    return real.unionByName(tail)


PAGE_URL_PREFIX = "https://features.example.org/collections/"


def page_url(job: Column, page: Column) -> Column:
    return F.concat(F.lit(PAGE_URL_PREFIX), F.regexp_replace(job, "[^A-Za-z0-9/]", "_"),
                    F.lit("/items?page="), page.cast("string"))


def linked_pages(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """F-I: (url, body) pages whose ``links`` carry ``rel=next`` to the next
    page; plus the start table (job, url) of page 0 per job."""
    pages = _pages(orders)
    last = pages.groupBy("job").agg(F.max("page").alias("last_page"))
    p = pages.join(last, "job")
    url = page_url(F.col("job"), F.col("page"))
    nxt = page_url(F.col("job"), F.col("page") + 1)
    self_link = F.concat(F.lit('{"rel":"self","href":"'), url, F.lit('"}'))
    next_link = F.concat(F.lit('{"rel":"next","href":"'), nxt, F.lit('"}'))
    links = F.concat(F.lit('"links":['), self_link,
                     F.when(F.col("page") < F.col("last_page"),
                            F.concat(F.lit(","), next_link)).otherwise(F.lit("")), F.lit("]"))
    body = p.select(url.alias("url"), _collection(F.col("features"), links).alias("body"))
    starts = last.select("job", page_url(F.col("job"), F.lit(0)).alias("url"))
    return body, starts


# ---------------------------------------------------------------------------
# API jobs and generic responses.
# ---------------------------------------------------------------------------

API_BASE_URL = "https://gis.example.com/services/"


def api_jobs(nation: DataFrame) -> DataFrame:
    """One API job per nation; the family cycles through the four supported
    types (with mixed case, as users write them)."""
    k = F.col("n_nationkey")
    kind = F.pmod(k, F.lit(4))
    api_type = (F.when(kind == 0, "ArcGIS").when(kind == 1, "wfs")
                .when(kind == 2, "OGCAPI").otherwise("rest"))
    params = (F.when(kind == 0, F.create_map(F.lit("where"), F.concat(
                  F.lit("n_regionkey = "), F.col("n_regionkey").cast("string"))))
              .when(kind == 1, F.create_map(F.lit("srsName"), F.lit("EPSG:4326")))
              .when(kind == 2, F.create_map(F.lit("limit"), F.lit("100")))
              .otherwise(F.create_map(F.lit("format"), F.lit("json"), F.lit("minx"), F.lit("0"))))
    boxes = job_boxes(nation)
    return nation.select(
        F.concat(F.lit("job_"), F.lower(F.col("n_name"))).alias("job_name"),
        api_type.alias("api_type"),
        F.concat(F.lit(API_BASE_URL), F.lower(F.col("n_name"))).alias("url"),
        F.col("n_name").alias("layer_name"), F.lower(F.col("n_name")).alias("collection"),
        params.alias("params")).join(boxes.select("job_name", "bbox"), "job_name")


def record_responses(events: DataFrame) -> DataFrame:
    """Generic HTTP bodies of three shapes: a JSON object, a JSON list of two
    objects, and plain text (shape chosen by event id)."""
    kind = F.pmod(F.col("event_id"), F.lit(3))
    body = (F.when(kind == 0, F.col("props"))
            .when(kind == 1, F.concat(F.lit("["), F.col("props"), F.lit(","), F.col("props"),
                                      F.lit("]")))
            .otherwise(F.concat(F.lit("status="), F.col("event_type"))))
    return events.select("event_id", body.alias("body"))


def extraction_jobs(nation: DataFrame) -> DataFrame:
    """Jobs of every shape the job reader accepts: a catalogue source name, an
    inline source, an unknown name; a named location, an explicit box, or
    neither (shape chosen by nation key)."""
    k = F.col("n_nationkey")
    kind = F.pmod(k, F.lit(3))
    inline = F.struct(
        F.concat(F.lit("Nation "), F.col("n_name")).alias("name"),
        F.concat(F.lit("s3://bucket-"), F.col("n_regionkey").cast("string"), F.lit("/nation_"),
                 k.cast("string"), F.lit(".parquet")).alias("url"),
        F.lit(None).cast("string").alias("layer_name"),
        F.lit("geometry").alias("geometry_column"), F.lit("").alias("description"))
    boxes = job_boxes(nation).select("job_name", "bbox")
    jobs = nation.select(
        F.concat(F.lit("job_"), F.lower(F.col("n_name"))).alias("job_name"),
        F.when(kind == 0, F.lit("fws_wetlands_fl")).when(kind == 2, F.lit("no_such_source"))
        .alias("source_key"),
        F.when(kind == 1, inline).alias("inline_source"),
        F.when(F.pmod(k, F.lit(5)) == 0, F.lit("disney_animal_kingdom")).alias("location"),
        (F.pmod(k, F.lit(4)) == 3).alias("_no_box"),
        F.create_map(F.lit("owner"), F.col("n_name")).alias("metadata"),
        F.array(F.lit("geojson"), F.lit("filegdb"), F.lit("csv"), F.lit("GPKG"),
                F.lit("xlsx")).alias("output_formats"),
        F.lit("extracted_data").alias("output_prefix"))
    return (jobs.join(boxes, "job_name")
            .withColumn("bbox", F.when(~F.col("_no_box"), F.col("bbox"))).drop("_no_box"))


def write_archives(orders: DataFrame, folder: str) -> None:
    """A zip archive per (layer, block of keys), each with a packed GeoJSON member of its features
    (``data/<block>_a.geojson``), the same under another name (``data/<block>xa.geojson``) and a CSV member.

    The features of a job come to one task next to each other; it holds those of one archive (KEY_BLOCK keys at most)
    and a batch, however many archives it writes."""
    import re

    import pyarrow as pa
    import pyarrow.compute as pc

    from geospan.sinks.export import zip_bytes

    rows = (_page_rows(orders).select("job", "feature", F.concat_ws(",", "o_orderkey", "o_orderpriority").alias("line"), "o_orderkey")
            .repartition("job").sortWithinPartitions("job", "o_orderkey").drop("o_orderkey"))

    def text(held, column, between):
        """The texts of a column that are there, joined."""
        return between.join(v for b in held for v in b.column(column).drop_null().to_pylist())

    def write(job, held):
        path, block = f"{folder}/{re.sub('[^A-Za-z0-9]', '_', job)}.zip", re.search("[0-9]*$", job)[0]
        body = '{"type":"FeatureCollection","features":[' + text(held, 1, ",") + "]}"
        write_file(path, zip_bytes((f"data/{block}_a.geojson", f"data/{block}xa.geojson", f"{block}.csv"),
                                   (body, body, "o_orderkey,layer\n" + text(held, 2, "\n") + "\n"), level=1))

    def put(batches):
        job, held, n = None, [], 0
        for batch in batches:
            jobs = batch.column(0)
            change = pc.fill_null(pc.not_equal(jobs[1:], jobs[:-1]), True).to_numpy(zero_copy_only=False)
            edges = [0, *(change.nonzero()[0] + 1).tolist(), batch.num_rows]
            for a, z in zip(edges, edges[1:]):
                if a == z:
                    continue
                if held and jobs[a].as_py() != job:
                    write(job, held)
                    held, n = [], n + 1
                job = jobs[a].as_py()
                held.append(batch.slice(a, z - a))
        if held:
            write(job, held)
            n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int32())})
    rows.mapInArrow(put, "n int").agg(F.sum("n")).collect()


def write_file(uri: str, content: bytes) -> None:
    """A file in a store that pyarrow reaches; written whole, so a task that runs again writes the same."""
    store, path = file_system(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(path) as f:
        f.write(content)


def publish_state(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """F-K: the published manifest (files of order years up to 1998) and a new
    batch (years from 1997): one file per (priority, year).  Batch files of the
    ``5-LOW`` folder are missing on disk."""
    year = F.year("o_orderdate")
    per = (orders.groupBy(F.col("o_orderpriority").alias("folder"), year.alias("year"))
           .agg(F.count(F.lit(1)).alias("n")))
    name = F.concat(F.lit("orders_"), F.col("year").cast("string"), F.lit(".geojson"))
    current = per.where(F.col("year") <= 1998).select(
        "folder", name.alias("file_name"), (F.pmod(F.col("year"), F.lit(3)) + 1).alias("version"),
        (F.col("n") * 100).alias("bytes"),
        F.create_map(F.lit("rows"), F.col("n").cast("string"),
                     F.lit("year"), F.col("year").cast("string")).alias("metadata"))
    batch = per.where(F.col("year") >= 1997).select(
        "folder", name.alias("file_name"), (F.col("n") * 120).alias("bytes"),
        F.create_map(F.lit("rows"), F.col("n").cast("string"),
                     F.lit("batch"), F.lit("r2")).alias("metadata"),
        (F.col("folder") != "5-LOW").alias("exists"))
    return current, batch
