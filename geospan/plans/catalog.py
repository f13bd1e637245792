"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory.  Every query reads the driver's tables (or data
Spark derives from them) in full; see :mod:`geospan.plans.oracle` for the
matching DuckDB SQL."""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geospan.functions.bbox import (BBOX_FIELDS, bbox_cols, bbox_to_csv, bbox_to_json, bbox_to_list,
                                    bbox_to_text, bbox_to_wkt, expand_bbox)
from geospan.functions.envelope import env_geojson, env_wkb, env_wkt, geometry_kind
from geospan.operators.extent import bbox_intersection_agg, bbox_union_agg, extent
from geospan.operators.extract import extract_jobs, job_summary
from geospan.operators.filters import attr_filter, where_filter
from geospan.operators.filters import bbox_filter as box_filter
from geospan.operators.extent import require_extent
from geospan.operators.geometry import (decode_geometry, points_from_lonlat, require_features,
                                        resolve_geometry_column, with_srid)
from geospan.plans.oracle import FILTER_BOX, _EXACT_BOX
from geospan.operators.pages import (assemble_linked_pages, assemble_offset_pages,
                                     assemble_single_page)
from geospan.plans import jobs as J
from geospan.plans.requests import arcgis_jobs, next_requests, plan_requests, s3_jobs, wfs_jobs
from geospan.plans.run import run_job_table, run_jobs
from geospan.session import ensure_checkpoint_dir, side_by_side
from geospan.sinks import export as X
from geospan.sinks.publish import (commit_manifest, folder_id, get_or_create_folders, publish,
                                   publish_manifest, read_manifest)
from geospan.sources import derived as D
from geospan.sources import files as S
from geospan.sources.footers import geo_keys, stored_extent
from geospan.sources.responses import parse_records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _t(spark, sf_dir, name):
    return D.table(spark, sf_dir, name)


def _fa(spark, sf_dir):
    return D.polygon_features(_t(spark, sf_dir, "orders"))


def _fe(spark, sf_dir):
    return D.job_boxes(_t(spark, sf_dir, "nation"))


# --- joins (J1-J3) ----------------------------------------------------------

@register
def extract_job_summary(spark, sf_dir):
    """J3 flagship: per job box, features caught and their extent."""
    return job_summary(_fa(spark, sf_dir), _fe(spark, sf_dir), "job_name")


def _pairs(spark, sf_dir, **kw):
    pairs = extract_jobs(_fa(spark, sf_dir), _fe(spark, sf_dir).select("job_name", "bbox"), **kw)
    return pairs.select("job_name", "o_orderkey", "layer")


@register
def extract_jobs_broadcast(spark, sf_dir):
    """Every (job, feature) pair, few boxes -> broadcast nested loop."""
    return _pairs(spark, sf_dir, strategy="broadcast")


@register
def extract_jobs_grid(spark, sf_dir):
    """Same pairs through the grid join with broadcast box cells."""
    return _pairs(spark, sf_dir, strategy="grid_broadcast", cell_size=7.5)


@register
def extract_jobs_grid_shuffle(spark, sf_dir):
    """Same pairs through the shuffled, hot-cell-salted grid join."""
    return _pairs(spark, sf_dir, strategy="grid", cell_size=5.0, hot_parts=64, salts=8)


@register
def extract_many_boxes(spark, sf_dir):
    """J3 with one box per customer (thousands of boxes): auto strategy."""
    boxes = D.many_boxes(_t(spark, sf_dir, "customer"), "c_custkey", "cust_")
    return job_summary(_fa(spark, sf_dir), boxes, "job_name")


# --- filters (F1-F8) ---------------------------------------------------------

@register
def bbox_filter(spark, sf_dir):
    """closed box filter; pushed into the Parquet scan when the features
    are stored with a bbox column."""
    out = box_filter(_fa(spark, sf_dir), FILTER_BOX)
    return out.select("o_orderkey", "layer", *bbox_cols("bbox"))


@register
def bbox_filter_points(spark, sf_dir):
    pts = points_from_lonlat(D.point_features(_t(spark, sf_dir, "events")))
    return box_filter(pts, FILTER_BOX).select("event_id", "lon", "lat", "event_type")


@register
def bbox_filter_exact(spark, sf_dir):
    """exact intersects on triangles (envelope test, then geometry test
    only for envelopes that cross the box edge)."""
    tri = D.triangle_features(_t(spark, sf_dir, "orders"))
    return box_filter(tri, _EXACT_BOX, exact=True, geometry="wkt").select("o_orderkey", "layer")


# --- extents (AG1-AG5) -------------------------------------------------------

@register
def extent_all(spark, sf_dir):
    return extent(_fa(spark, sf_dir))


@register
def extent_attr_filter(spark, sf_dir):
    # Unknown keys are ignored, as in the original dict filter.
    return extent(attr_filter(_fa(spark, sf_dir), {"layer": "1-URGENT", "no_such_column": 5}))


@register
def extent_where(spark, sf_dir):
    return extent(where_filter(_fa(spark, sf_dir),
                               "layer IN ('1-URGENT', '2-HIGH') AND bbox.xmin > 0"))


@register
def extent_by_layer(spark, sf_dir):
    return extent(_fa(spark, sf_dir), by="layer")


@register
def feature_count_by_layer(spark, sf_dir):
    fa = _fa(spark, sf_dir)
    return fa.groupBy("layer").agg(F.count(F.lit(1)).alias("feature_count"))


@register
def bbox_union_by_region(spark, sf_dir):
    return bbox_union_agg(_fe(spark, sf_dir), by="n_regionkey")


@register
def bbox_intersection_by_region(spark, sf_dir):
    return bbox_intersection_agg(_fe(spark, sf_dir), by="n_regionkey")


# --- scalar box functions (SC1-SC6) -----------------------------------------

@register
def bbox_scalars(spark, sf_dir):
    fe = _fe(spark, sf_dir)
    exp = expand_bbox("bbox", 0.5)
    return fe.select(
        "job_name", bbox_to_list("bbox").alias("bbox_list"), bbox_to_wkt("bbox").alias("bbox_wkt"),
        exp.xmin.alias("exp_xmin"), exp.ymin.alias("exp_ymin"),
        exp.xmax.alias("exp_xmax"), exp.ymax.alias("exp_ymax"),
        bbox_to_json("bbox").alias("bbox_json"), bbox_to_csv("bbox").alias("bbox_csv"),
        bbox_to_text("bbox").alias("bbox_text"))


# --- geometry normalisation (G1-G8) ------------------------------------------

@register
def envelope_wkt(spark, sf_dir):
    fa = _fa(spark, sf_dir)
    return fa.select("o_orderkey", *bbox_cols(env_wkt("wkt")))


@register
def envelope_geojson(spark, sf_dir):
    fc = D.geojson_features(_t(spark, sf_dir, "orders"))
    return fc.select("o_orderkey", *bbox_cols(env_geojson("geometry")))


@register
def envelope_wkb(spark, sf_dir):
    fd = D.wkb_features(_t(spark, sf_dir, "orders"))
    return decode_geometry(fd, "geometry").select("o_orderkey", *bbox_cols("bbox"))


@register
def envelope_mixed(spark, sf_dir):
    fj = D.mixed_geometry(_t(spark, sf_dir, "orders"))
    return decode_geometry(fj, "geometry").select(
        "o_orderkey", geometry_kind("geometry").alias("kind"), *bbox_cols("bbox"))


@register
def points_lonlat(spark, sf_dir):
    pts = with_srid(points_from_lonlat(D.point_features(_t(spark, sf_dir, "events"))))
    return pts.select("event_id", *bbox_cols("bbox"), "srid")


# --- web API request planning and page assembly (A1-A9, S2, S3) --------------

PAGE_PROPS = "struct<o_orderkey: bigint, layer: string>"


@register
def api_requests(spark, sf_dir):
    """Request URLs for every page of every API job."""
    jobs = D.api_jobs(_t(spark, sf_dir, "nation"))
    return plan_requests(jobs, arcgis_pages=3).select("job_name", "page", "request_url")


@register
def offset_pages(spark, sf_dir):
    """ArcGIS-style offset pages -> features, ignoring the page after the
    short one."""
    # Derived responses are read twice by the assembly (page statistics and
    # bodies): materialise them once in the shared checkpoint folder.
    pages = D.offset_pages(_t(spark, sf_dir, "orders")).checkpoint(eager=True)
    out = assemble_offset_pages(pages, limit=D.PAGE_SIZE, properties_schema=PAGE_PROPS)
    return out.select("job", "off", "o_orderkey", "layer", "complete")


@register
def linked_pages(spark, sf_dir):
    """OGC-style next-link chains -> features in page order."""
    pages, starts = D.linked_pages(_t(spark, sf_dir, "orders"))
    # The recorded pages are derived data used three times by the assembly
    # (links, start pages, bodies): materialise them once in the shared
    # checkpoint folder instead of recomputing the derivation.
    pages, starts = pages.checkpoint(eager=True), starts.checkpoint(eager=True)
    out = assemble_linked_pages(pages, starts, properties_schema=PAGE_PROPS)
    return out.select("job", "step", "o_orderkey", "complete")


@register
def single_page_features(spark, sf_dir):
    """A9 + S2 + G7: each page parsed on its own (property schema inferred),
    geometry envelope from the GeoJSON text."""
    pages, _ = D.linked_pages(_t(spark, sf_dir, "orders"))
    out = assemble_single_page(pages)
    return out.select("o_orderkey", "layer", *bbox_cols(env_geojson("geometry")))


@register
def parse_record_bodies(spark, sf_dir):
    """S3: JSON list -> row per element, object -> one row, text -> raw row."""
    out = parse_records(D.record_responses(_t(spark, sf_dir, "events")))
    return out.select("event_id", "_shape", "_pos", "k", "_raw")


# --- jobs: resolve, route, metadata, names (S10-S13, M1-M3, SC7, SC8) ------------

@register
def resolve_jobs(spark, sf_dir):
    """S13 + S10 + S11: catalogue lookup, then routing of the resolved URL."""
    jobs = D.extraction_jobs(_t(spark, sf_dir, "nation"))
    res = J.resolve_jobs(jobs, J.builtin_sources(spark), J.builtin_locations(spark))
    return res.select("job_name", "status", "source_name", "url", "geometry_column",
                      J.route("url").alias("route"), J.file_kind("url").alias("file_kind"),
                      *bbox_cols("bbox"))


@register
def route_page_urls(spark, sf_dir):
    """SC8 + S10 + S11 over every recorded page URL."""
    pages = _t(spark, sf_dir, "pages").select("page_id", "url")
    return J.route_sources(pages).drop("url")


@register
def output_filenames(spark, sf_dir):
    """SC7 + K4 format status: one name per job and requested format, for a
    fixed run timestamp (reruns give the same names)."""
    jobs = D.extraction_jobs(_t(spark, sf_dir, "nation"))
    ts = F.to_timestamp(F.lit("2024-01-02 03:04:05"))
    x = jobs.select("job_name", "output_prefix", F.explode("output_formats").alias("format"))
    return x.select("job_name", "format",
                    J.output_filename(F.col("output_prefix"), F.col("job_name"), F.col("format"),
                                      ts).alias("file_name"),
                    J.format_status(F.col("format")).alias("status"))


@register
def metadata_merge(spark, sf_dir):
    """M1-M3: user metadata JSON (invalid text -> empty map) updated by the
    default keys (extraction date, source, box), later keys winning."""
    ev = _t(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "error", F.lit("not json {")).otherwise(F.col("props"))
    user = J.merge_maps(J.parse_metadata(text),
                        F.create_map(F.lit("source"), F.lit("user value")))
    d = D.point_features(ev, keep=("ts", "props")).withColumn(
        "bbox", F.struct(F.col("lon").alias("xmin"), F.col("lat").alias("ymin"),
                         F.col("lon").alias("xmax"), F.col("lat").alias("ymax")))
    defaults = J.default_metadata(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
                                  F.col("event_type"), F.col("bbox"))
    return d.select("event_id", J.map_text(J.merge_maps(user, defaults)).alias("metadata"))


# --- publish bookkeeping (K6-K8) ---------------------------------------------------

@register
def publish_upsert(spark, sf_dir):
    """K6 + K7: upsert the new batch into the published manifest."""
    current, batch = D.publish_state(_t(spark, sf_dir, "orders"))
    out = publish_manifest(current, batch)
    return out.select("folder", "file_name", "action", "version", "bytes",
                      J.map_text("metadata").alias("metadata"))


@register
def folder_get_or_create(spark, sf_dir):
    """K8: folders for the batch (one per priority and per year) created only
    where they do not exist yet."""
    current, batch = D.publish_state(_t(spark, sf_dir, "orders"))
    existing = current.select(F.lit("root").alias("parent"), F.col("folder").alias("name")
                              ).distinct().withColumn("folder_id",
                                                      folder_id(F.col("parent"), F.col("name")))
    req = batch.select(F.lit("root").alias("parent"), F.col("folder").alias("name")).unionByName(
        batch.select(F.lit("root").alias("parent"),
                     F.concat(F.lit("y"), F.regexp_extract("file_name", r"(\d{4})", 1)).alias("name")))
    return get_or_create_folders(existing, req)


# --- SQL surface (section 2.9) and layers (S9) ------------------------------------

@register
def sql_box_filter(spark, sf_dir):
    """F1 + G6 through ``spark.sql`` with the registered SQL functions."""
    from geospan.functions.sql import register_sql_functions
    register_sql_functions(spark)
    _fa(spark, sf_dir).createOrReplaceTempView("geospan_features")
    x0, y0, x1, y1 = FILTER_BOX
    return spark.sql(f"""
        SELECT o_orderkey, layer, e.xmin, e.ymin, e.xmax, e.ymax
        FROM (SELECT o_orderkey, layer, env_wkt(wkt) AS e FROM geospan_features)
        WHERE bbox_intersects(e, make_bbox({x0}, {y0}, {x1}, {y1}))""")


@register
def select_first_layer(spark, sf_dir):
    """No layer named -> the first (lowest) layer; extent of its features."""
    from geospan.sources.files import select_layer
    return extent(select_layer(_fa(spark, sf_dir)), by="layer")


@register
def extract_points_summary(spark, sf_dir):
    """J3 on zero-area features (event points) through the grid join."""
    pts = points_from_lonlat(D.point_features(_t(spark, sf_dir, "events")))
    return job_summary(pts, _fe(spark, sf_dir), "job_name", strategy="grid_broadcast",
                       cell_size=10.0)


@register
def extent_with_empty_geometry(spark, sf_dir):
    """AG2 / D12: orders in status P carry ``POLYGON EMPTY``; they count as
    features but add nothing to the extent."""
    fa = D.polygon_features(_t(spark, sf_dir, "orders"), keep=("o_orderstatus",))
    geom = F.when(F.col("o_orderstatus") == "P", F.lit("POLYGON EMPTY")).otherwise(F.col("wkt"))
    feats = decode_geometry(fa.drop("bbox").withColumn("wkt", geom), "wkt")
    return extent(feats, by="layer", count_geometries=True)


@register
def csv_projection(spark, sf_dir):
    """F7 (+F6): decoded GeoJSON features projected to their attributes, as
    written by the CSV sink."""
    from geospan.operators.filters import drop_geometry
    fc = decode_geometry(D.geojson_features(_t(spark, sf_dir, "orders")), "geometry")
    return drop_geometry(fc)


# --- files and sinks (S1, S4-S6, S12, K1-K5), presets and strict checks (A10, G1, G9, F5) ------

def _scratch(spark, name):
    """A new folder in the shared checkpoint folder; the result is read from it."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register
def read_geojson(spark, sf_dir):
    """S1 + K3: features written as GeoJSON lines and read back with their boxes."""
    path = _scratch(spark, "geojson")
    X.write_geojson(D.geojson_features(_t(spark, sf_dir, "orders")).select("o_orderkey", "layer", "geometry"), path)
    back = S.read_geojson_any(spark, path, properties_schema=PAGE_PROPS)
    return decode_geometry(back, "geometry").select("o_orderkey", "layer", *bbox_cols("bbox"))


@register
def read_geojson_packed(spark, sf_dir):
    """S1 in byte ranges: collections on one line each, cut into features by the range scanner."""
    path = _scratch(spark, "packed")
    feats = D.geojson_features(_t(spark, sf_dir, "orders")).select("o_orderkey", "layer", "geometry")
    X.write_geojson(feats, path, layout="collection")
    back = S.read_geojson(spark, path, PAGE_PROPS)
    return decode_geometry(back, "geometry").select("o_orderkey", "layer", *bbox_cols("bbox"))


@register
def read_archive_members(spark, sf_dir):
    """Zip archives (one per layer and block of keys, with a GeoJSON, a GeoJSON of another name and a CSV member)
    and the features of the members that a glob names, read in pieces."""
    path = _scratch(spark, "archives")
    D.write_archives(_t(spark, sf_dir, "orders"), path)
    feats = S.read_archive_features(spark, path, "data/*_a.geojson", PAGE_PROPS, chunk_bytes=1 << 16)
    return decode_geometry(feats, "geometry").select("o_orderkey", "layer", *bbox_cols("bbox"))


@register
def read_archive_tables(spark, sf_dir):
    """S7 + S6: the CSV members of the same archives."""
    path = _scratch(spark, "archives")
    D.write_archives(_t(spark, sf_dir, "orders"), path)
    return S.read_archive_csv(spark, path, "*.csv", "o_orderkey bigint, layer string", chunk_bytes=1 << 16)


@register
def remote_paths(spark, sf_dir):
    """URLs of every scheme as Hadoop paths, and the names of their options."""
    c = _t(spark, sf_dir, "customer")
    schemes = F.array(*[F.lit(s) for s in ("s3", "gcs", "azure", "hdfs", "ftp", "file", "S3")])
    url = F.concat(F.get(schemes, F.pmod("c_custkey", F.lit(7)).cast("int")), F.lit("://store-"), F.lower("c_mktsegment"),
                   F.lit("/key="), F.col("c_custkey").cast("string"), F.lit(".parquet"))
    c = c.select("c_custkey", url.alias("url"))
    return c.select("c_custkey", J.remote_path("url").alias("path"), J.option_prefix("url").alias("prefix"))


@register
def read_json_records(spark, sf_dir):
    """Lists of records, one list per file (a file per 20,000 event ids)."""
    path = _scratch(spark, "records")
    ev = _t(spark, sf_dir, "events")
    block = F.floor(F.col("event_id") / 20000)
    (ev.groupBy(block.alias("block")).agg(F.to_json(F.collect_list(F.struct("event_id", "event_type"))).alias("value"))
     .write.partitionBy("block").text(path))
    return S.read_json_records(spark, path).select(F.col("event_id").cast("long").alias("event_id"), "event_type")


@register
def read_features_parquet(spark, sf_dir):
    """S5 + K2: GeoParquet written and read back; the stored box equals that of the WKB."""
    path = _scratch(spark, "geoparquet")
    X.write_geoparquet(_fa(spark, sf_dir).select("o_orderkey", "layer", F.col("wkt").alias("geometry"), "bbox"), path)
    back = S.read_features_parquet(spark, path)
    return back.select("o_orderkey", "layer", *bbox_cols("bbox"), (env_wkb("geometry") == F.col("bbox")).alias("same"))


@register
def read_features_csv(spark, sf_dir):
    """S6 + K1 + G4: a CSV with lon and lat columns, written and read back as points."""
    path = _scratch(spark, "points") + ".csv"
    pts = points_from_lonlat(D.point_features(_t(spark, sf_dir, "events")))
    X.write_csv(pts.select("event_id", "lon", "lat", "event_type", "geometry", "bbox"), path)
    return S.read_source(spark, path).select(F.col("event_id").cast("long").alias("event_id"), "event_type", *bbox_cols("bbox"))


@register
def parse_job_files(spark, sf_dir):
    """Job texts with the box as a list or an object, with and without formats."""
    boxes = D.many_boxes(_t(spark, sf_dir, "customer"), "c_custkey", "cust_")
    b = F.col("bbox")
    odd = F.pmod(F.regexp_extract("job_name", "[0-9]+", 0).cast("long"), F.lit(2)) == 1
    as_list = F.to_json(F.array(b.xmin, b.ymin, b.xmax, b.ymax))
    as_obj = F.to_json(F.struct(b.xmin.alias("min_lon"), b.ymin.alias("min_lat"), b.xmax.alias("max_lon"), b.ymax.alias("max_lat")))
    text = F.concat(F.lit('{"job_name":"'), "job_name", F.lit('","data_source":"src","bounding_box":'),
                    F.when(odd, F.concat(as_obj, F.lit(',"output_formats":["csv"]'))).otherwise(as_list), F.lit("}"))
    got = J.parse_job_text(boxes.select(text.alias("text")))
    return got.select("job_name", "source_key", *bbox_cols("bbox"), F.array_join("output_formats", ",").alias("formats"), "output_prefix")


@register
def preset_jobs(spark, sf_dir):
    """A10: one ArcGIS, WFS and S3 job per customer."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    url = F.concat(F.lit("https://gis.example.org/"), F.lower("segment"))
    parts = [arcgis_jobs(c.withColumns({"service_url": url, "layer_id": F.col("c_custkey")})).withColumn("version", F.lit("")),
             wfs_jobs(c.withColumns({"wfs_url": url, "layer_name": F.col("segment")})),
             s3_jobs(c.withColumns({"bucket": F.lower("segment"), "key": F.concat(F.col("c_custkey").cast("string"), F.lit(".parquet"))}))
             .withColumns({"api_type": F.lit("file"), "version": F.lit("")})]
    cols = ["c_custkey", "api_type", "url", "version"]
    return parts[0].select(*cols).unionByName(parts[1].select(*cols)).unionByName(parts[2].select(*cols))


@register
def extent_strict(spark, sf_dir):
    """G1 + G9 + F5: the geometry column found by its name, every row decoded or an error, and an
    error for an empty data set or an extent without bounds."""
    raw = _fa(spark, sf_dir).select("layer", F.col("wkt").alias("SHAPE"))
    feats = require_features(decode_geometry(raw, resolve_geometry_column(raw), mode="strict"))
    return require_extent(extent(feats, by="layer"))


@register
def export_formats(spark, sf_dir):
    """K4: every status of the manifest."""
    feats = _fa(spark, sf_dir).select("o_orderkey", "layer", F.col("wkt").alias("geometry"), "bbox")
    got = X.export_multiple(feats, _scratch(spark, "export"), "orders", ["parquet", "geojson", "csv", "filegdb", "foo"])
    return got.select("format", "status", "rows", "bad_rows")


@register
def box_record(spark, sf_dir):
    """K5: the extent with its provenance, written and read back."""
    path = _scratch(spark, "box")
    X.save_box_record(extent(_fa(spark, sf_dir)), path, source_file="orders", layer="all")
    schema = "bbox struct<min_lon: double, min_lat: double, max_lon: double, max_lat: double>, source_file string, layer string"
    return spark.read.schema(schema).json(path).select("bbox.*", "source_file", "layer")


@register
def job_run(spark, sf_dir):
    """J1-K4 in one plan: all jobs extracted and written, and their manifest."""
    jobs = _fe(spark, sf_dir).select("job_name", "bbox", F.array(F.lit("csv"), F.lit("geojson"), F.lit("filegdb")).alias("output_formats"),
                                     F.lit("run").alias("output_prefix"))
    feats = _fa(spark, sf_dir).select("o_orderkey", F.col("wkt").alias("geometry"), "bbox")
    ts = F.to_timestamp(F.lit("2024-01-02 03:04:05"))
    got = run_jobs(feats, jobs, _scratch(spark, "run"), ts)
    return got.select("job_name", "format", "status", "feature_count", *BBOX_FIELDS, F.col("path").isNotNull().alias("written"))


@register
def job_table_run(spark, sf_dir):
    """S10 + S13 + J1-K4: jobs over four sources (collections, GeoParquet, a CSV of points, members of archives) and two kinds
    that can't run, one scan per source; what the manifest says beside what is in the files."""
    base = _scratch(spark, "sources")
    orders, feats = _t(spark, sf_dir, "orders"), D.geojson_features(_t(spark, sf_dir, "orders"))
    polygons = _fa(spark, sf_dir).select("o_orderkey", "layer", F.col("wkt").alias("geom"), "bbox")
    points = points_from_lonlat(D.point_features(_t(spark, sf_dir, "events"))).select("event_id", "lon", "lat")
    side_by_side(spark, lambda write: write(), [
        lambda: D.write_archives(orders, f"{base}/zips"),
        lambda: X.write_geojson(feats, f"{base}/a.geojson", layout="collection"),
        lambda: X.write_geoparquet(polygons, f"{base}/b.parquet", geometry="geom", partitions=4),
        lambda: X.write_csv(points, f"{base}/c.csv")])
    urls = F.array(*[F.lit(u) for u in (f"{base}/a.geojson", f"{base}/b.parquet", f"{base}/c.csv", f"zip://{base}/zips!data/*_a.geojson", "https://gis.example.org/api/x")])
    k = F.pmod("n_nationkey", F.lit(6)).cast("int")
    n = _t(spark, sf_dir, "nation").withColumn("job_name", F.concat(F.lit("job_"), F.lower("n_name"))).select("job_name", "n_nationkey")
    jobs = (_fe(spark, sf_dir).select("job_name", "bbox").join(n, "job_name")
            .select("job_name", "bbox", F.when(k < 5, F.get(urls, k)).alias("url"), F.lit(None).cast("string").alias("layer_name"),
                    F.lit("geom").alias("geometry_column"), F.when(k < 5, "ok").otherwise("unknown_source").alias("status"),
                    F.array(F.lit("csv"), F.lit("GeoJSON"), F.lit("parquet"), F.lit("filegdb")).alias("output_formats"), F.lit("run").alias("output_prefix")))
    out = _scratch(spark, "table_run")
    got = run_job_table(jobs, out, F.to_timestamp(F.lit("2024-01-02 03:04:05")), strategy="broadcast")
    files = spark.read.option("recursiveFileLookup", True).text(f"{out}/*/geojson")
    lines = files.groupBy(F.regexp_extract("_metadata.file_path", "job_folder=([^/]+)", 1).alias("folder")).agg(F.count("*").alias("lines"))
    got = got.withColumn("folder", F.when(F.col("format") == "GeoJSON", F.regexp_extract("path", "job_folder=(.*)$", 1)))
    return got.join(lines, "folder", "left").select("job_name", "format", "status", "feature_count", *BBOX_FIELDS, F.col("path").isNotNull().alias("written"), "lines")


@register
def request_waves(spark, sf_dir):
    """A1 + A7: the requests that a recording with gaps and errors leaves to be made: of every job's pages a third is
    not there, and of the others some are errors."""
    pages = D.offset_pages(_t(spark, sf_dir, "orders")).withColumn("page", (F.col("off") / D.PAGE_SIZE).cast("int"))
    jobs = pages.select(F.col("job").alias("job_name")).distinct().select(
        "job_name", F.lit("ArcGIS").alias("api_type"), F.concat(F.lit("https://gis.example.org/"), F.regexp_replace("job_name", "[^A-Za-z0-9]", "_")).alias("url"),
        F.lit(None).cast("struct<xmin: double, ymin: double, xmax: double, ymax: double>").alias("bbox"), F.lit(D.PAGE_SIZE).alias("max_records"))
    bad = F.pmod("page", F.lit(5)) == 4
    responses = pages.where(F.pmod("page", F.lit(3)) != 1).select(
        F.col("job").alias("job_name"), "page", F.lit("").alias("request_url"), F.when(bad, 500).otherwise(200).alias("status"), F.when(~bad, F.col("body")).alias("body"))
    return next_requests(jobs, responses.checkpoint(), ahead=2).select("job_name", "page", "attempt", "request_url")


@register
def publish_commits(spark, sf_dir):
    """K6 + K7 stored: a first state, the same batch published twice, and the last version read back from the store."""
    path = _scratch(spark, "manifest")
    current, batch = D.publish_state(_t(spark, sf_dir, "orders"))
    commit_manifest(spark, path, current, 0)
    for _ in range(2):
        _, version = publish(spark, path, batch)
    state, last = read_manifest(spark, path)
    return state.select("folder", "file_name", "version", "bytes", J.map_text("metadata").alias("metadata"), F.lit(last == version).alias("is_last"))


@register
def extent_from_footers(spark, sf_dir):
    """AG1 + AG5: the extent of each layer of stored features, from the footers of their files."""
    path = _scratch(spark, "stored")
    _fa(spark, sf_dir).select("o_orderkey", "layer", "bbox").write.partitionBy("layer").parquet(path)
    return stored_extent(spark, path, by="layer")


@register
def geoparquet_footers(spark, sf_dir):
    """K2: the rows and the box that the ``geo`` keys in the footers of all files give together."""
    path = _scratch(spark, "geo")
    feats = _fa(spark, sf_dir).select("o_orderkey", "layer", F.col("wkt").alias("geometry"), "bbox")
    X.write_geoparquet(feats, path, partitions=4, geo_key="footer")
    geo = F.from_json("geo", "struct<primary_column: string, columns: struct<geometry: struct<encoding: string, geometry_types: array<string>, bbox: array<double>>>>")
    g = F.col("g.columns.geometry")
    return (geo_keys(spark, path).select("rows", geo.alias("g"))
            .groupBy("g.primary_column", g.encoding.alias("encoding"), F.array_join(g.geometry_types, ",").alias("types"))
            .agg(F.sum("rows").alias("feature_count"), *[(F.min if k < 2 else F.max)(F.get(g.bbox, k)).alias(b) for k, b in enumerate(BBOX_FIELDS)]))


def _fg(spark, sf_dir):
    """A box per customer, with the customer's segment."""
    c = _t(spark, sf_dir, "customer")
    names = c.select(F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("job_name"), F.col("c_mktsegment").alias("segment"),
                     F.pmod("c_custkey", F.lit(50)).alias("part"))
    return D.many_boxes(c, "c_custkey", "cust_").join(names, "job_name")


@register
def bbox_algebra_by_segment(spark, sf_dir):
    """AG3 + AG4 + SC3 over a box per customer: the union of each part of a segment, and the intersection of its
    boxes grown by 60 degrees (some are empty)."""
    boxes = _fg(spark, sf_dir)
    union = bbox_union_agg(boxes, by=["segment", "part"])
    grown = bbox_intersection_agg(boxes.withColumn("bbox", expand_bbox("bbox", 60)), by=["segment", "part"])
    return union.join(grown.select("segment", "part", *[F.col(b).alias(f"i{b}") for b in BBOX_FIELDS]), ["segment", "part"])


@register
def bbox_scalars_many(spark, sf_dir):
    """SC1 + SC3 over a box per customer."""
    exp = expand_bbox("bbox", 0.25)
    return _fg(spark, sf_dir).select("job_name", *[F.get(bbox_to_list("bbox"), k).alias(f"b{k}") for k in range(4)], *bbox_cols(exp))
