"""Independent DuckDB SQL for every checked query in :mod:`geospan.plans.catalog`.

Each string runs on the driver's pre-registered views (orders, nation, ...).
The derived spatial inputs are re-derived here in plain SQL from the same
rules, so a mistake in a Spark builder shows up as a mismatch.
"""

from __future__ import annotations

# Coordinates in text, written for this file alone: a number, then pairs of them.
_N = r"[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[Ee][+-]?[0-9]+)?"
WKT_PAIR = rf"({_N})[ \t\n]+({_N})(?:[ \t\n]+{_N})?(?:[ \t\n]+{_N})?"
GEOJSON_PAIR = rf"\[[ \t\n]*({_N})[ \t\n]*,[ \t\n]*({_N})(?:[ \t\n]*,[ \t\n]*{_N})*[ \t\n]*\]"
GEOJSON_BBOX_MEMBER = r'"bbox"[ \t\n]*:[ \t\n]*\[[^\]]*\]'


def _deg_text(u: str) -> str:
    return (f"((CASE WHEN {u} < 0 THEN '-' ELSE '' END) || (abs({u}) // 10000)::VARCHAR"
            f" || '.' || lpad((abs({u}) % 10000)::VARCHAR, 4, '0'))")


def _pt(x: str, y: str, sep: str = " ") -> str:
    return f"{_deg_text(x)} || '{sep}' || {_deg_text(y)}"


# F-A rectangles in integer units, and as doubles.
FA_UNITS = """fa_u AS (
  SELECT o_orderkey, o_orderpriority AS layer, o_custkey, o_orderstatus,
         (o_orderkey * 7919) % 3400000 - 1700000 AS ux0,
         (o_orderkey * 104729) % 1600000 - 800000 AS uy0,
         (o_orderkey * 7919) % 3400000 - 1700000 + (o_custkey * 31) % 5000 + 1 AS ux1,
         (o_orderkey * 104729) % 1600000 - 800000 + (o_custkey * 17) % 5000 + 1 AS uy1
  FROM orders)"""

FA = FA_UNITS + """,
fa AS (
  SELECT o_orderkey, layer, o_orderstatus, ux0, uy0, ux1, uy1,
         ux0::DOUBLE / 10000 AS xmin, uy0::DOUBLE / 10000 AS ymin,
         ux1::DOUBLE / 10000 AS xmax, uy1::DOUBLE / 10000 AS ymax
  FROM fa_u)"""

FA_WKT = f"""'POLYGON ((' || {_pt('ux0', 'uy0')} || ', ' || {_pt('ux1', 'uy0')} || ', '
  || {_pt('ux1', 'uy1')} || ', ' || {_pt('ux0', 'uy1')} || ', ' || {_pt('ux0', 'uy0')} || '))'"""


def _gj_pos(x, y):
    return f"'[' || {_pt(x, y, ',')} || ']'"


FA_GEOJSON = ("""'{"type":"Polygon","coordinates":[[' || """
              + " || ',' || ".join(_gj_pos(x, y) for x, y in
                                   (("ux0", "uy0"), ("ux1", "uy0"), ("ux1", "uy1"),
                                    ("ux0", "uy1"), ("ux0", "uy0")))
              + """ || ']]}'""")

FE = """fe AS (
  SELECT 'job_' || lower(n_name) AS job_name, n_name AS location, n_regionkey,
         (-180 + (n_nationkey % 5) * 70)::DOUBLE AS bx0,
         (-90 + (n_nationkey // 5) * 34)::DOUBLE AS by0,
         (-180 + (n_nationkey % 5) * 70 + 80)::DOUBLE AS bx1,
         (-90 + (n_nationkey // 5) * 34 + 40)::DOUBLE AS by1
  FROM nation)"""

FG_CUSTOMER = """fg AS (
  SELECT 'cust_' || c_custkey::VARCHAR AS job_name,
         ((c_custkey * 7919) % 3400000 - 1700000)::DOUBLE / 10000 AS bx0,
         ((c_custkey * 104729) % 1600000 - 800000)::DOUBLE / 10000 AS by0,
         ((c_custkey * 7919) % 3400000 - 1700000 + (c_custkey * 31) % 50000 + 1)::DOUBLE / 10000 AS bx1,
         ((c_custkey * 104729) % 1600000 - 800000 + (c_custkey * 17) % 50000 + 1)::DOUBLE / 10000 AS by1
  FROM customer)"""

FB = """fb AS (
  SELECT event_id,
         ((event_id * 7919) % 3400000 - 1700000)::DOUBLE / 10000 AS lon,
         ((event_id * 104729) % 1600000 - 800000)::DOUBLE / 10000 AS lat,
         event_type, value
  FROM events)"""

INTERSECTS = "f.xmin <= j.bx1 AND f.xmax >= j.bx0 AND f.ymin <= j.by1 AND f.ymax >= j.by0"

FILTER_BOX = (-20.5, -10.25, 30.75, 25.5)


def _box_pred(x0, y0, x1, y1, box=FILTER_BOX):
    a, b, c, d = box
    return f"{x0} <= {c} AND {x1} >= {a} AND {y0} <= {d} AND {y1} >= {b}"


def _env(text: str, pattern: str) -> str:
    def agg(fn, g):
        return (f"{fn}(list_filter(list_transform(regexp_extract_all({text}, '{pattern}', {g}),"
                f" lambda v: v::DOUBLE), lambda v: NOT isnan(v)))")
    return (f"{agg('list_min', 1)} AS xmin, {agg('list_min', 2)} AS ymin, "
            f"{agg('list_max', 1)} AS xmax, {agg('list_max', 2)} AS ymax")


def _sql_str(s: str) -> str:
    return s.replace("'", "''")


ORACLE: dict[str, str] = {}

ORACLE["extract_job_summary"] = f"""
WITH {FA}, {FE}
SELECT j.job_name, min(f.xmin) AS xmin, min(f.ymin) AS ymin, max(f.xmax) AS xmax,
       max(f.ymax) AS ymax, count(f.o_orderkey) AS feature_count
FROM fe j LEFT JOIN fa f ON {INTERSECTS}
GROUP BY j.job_name"""

_PAIRS = f"""
WITH {FA}, {FE}
SELECT j.job_name, f.o_orderkey, f.layer
FROM fa f JOIN fe j ON {INTERSECTS}"""
ORACLE["extract_jobs_broadcast"] = _PAIRS
ORACLE["extract_jobs_grid"] = _PAIRS
ORACLE["extract_jobs_grid_shuffle"] = _PAIRS

ORACLE["extract_many_boxes"] = f"""
WITH {FA}, {FG_CUSTOMER}
SELECT j.job_name, min(f.xmin) AS xmin, min(f.ymin) AS ymin, max(f.xmax) AS xmax,
       max(f.ymax) AS ymax, count(f.o_orderkey) AS feature_count
FROM fg j LEFT JOIN fa f ON {INTERSECTS}
GROUP BY j.job_name"""

ORACLE["bbox_filter"] = f"""
WITH {FA}
SELECT o_orderkey, layer, xmin, ymin, xmax, ymax FROM fa
WHERE {_box_pred('xmin', 'ymin', 'xmax', 'ymax')}"""

ORACLE["bbox_filter_points"] = f"""
WITH {FB}
SELECT event_id, lon, lat, event_type FROM fb
WHERE {_box_pred('lon', 'lat', 'lon', 'lat')}"""

# Right triangles (x0,y0),(x1,y0),(x0,y1) meet the box iff their envelopes meet
# and the box corner nearest the right angle lies on or under the hypotenuse;
# decided in exact integer arithmetic on a box snapped to half units.
_EXACT_BOX = (-20.00005, -10.00005, 30.00005, 25.00005)
ORACLE["bbox_filter_exact"] = f"""
WITH {FA}
SELECT o_orderkey, layer FROM fa
WHERE {_box_pred('xmin', 'ymin', 'xmax', 'ymax', _EXACT_BOX)}
  AND (greatest(-400001, ux0 * 2) - ux0 * 2) * (uy1 - uy0)
      + (greatest(-200001, uy0 * 2) - uy0 * 2) * (ux1 - ux0)
      <= 2 * (ux1 - ux0) * (uy1 - uy0)"""

_EXTENT = """min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax,
       count(*) AS feature_count"""

ORACLE["extent_all"] = f"WITH {FA} SELECT {_EXTENT} FROM fa"
ORACLE["extent_attr_filter"] = f"WITH {FA} SELECT {_EXTENT} FROM fa WHERE layer = '1-URGENT'"
ORACLE["extent_where"] = (f"WITH {FA} SELECT {_EXTENT} FROM fa "
                          "WHERE layer IN ('1-URGENT', '2-HIGH') AND xmin > 0")
ORACLE["extent_by_layer"] = f"WITH {FA} SELECT layer, {_EXTENT} FROM fa GROUP BY layer"
ORACLE["feature_count_by_layer"] = (f"WITH {FA} SELECT layer, count(*) AS feature_count "
                                    "FROM fa GROUP BY layer")

ORACLE["bbox_union_by_region"] = f"""
WITH {FE}
SELECT n_regionkey, min(bx0) AS xmin, min(by0) AS ymin, max(bx1) AS xmax, max(by1) AS ymax
FROM fe GROUP BY n_regionkey"""

ORACLE["bbox_intersection_by_region"] = f"""
WITH {FE}, agg AS (
  SELECT n_regionkey, max(bx0) AS x0, max(by0) AS y0, min(bx1) AS x1, min(by1) AS y1
  FROM fe GROUP BY n_regionkey)
SELECT n_regionkey,
       CASE WHEN x0 < x1 AND y0 < y1 THEN x0 END AS xmin,
       CASE WHEN x0 < x1 AND y0 < y1 THEN y0 END AS ymin,
       CASE WHEN x0 < x1 AND y0 < y1 THEN x1 END AS xmax,
       CASE WHEN x0 < x1 AND y0 < y1 THEN y1 END AS ymax
FROM agg"""


def _num(x):
    return f"regexp_replace({x}::VARCHAR, '\\.0$', '')"


ORACLE["bbox_scalars"] = f"""
WITH {FE}
SELECT job_name,
       [bx0, by0, bx1, by1] AS bbox_list,
       'POLYGON ((' || {_num('bx1')} || ' ' || {_num('by0')} || ', ' || {_num('bx1')} || ' '
         || {_num('by1')} || ', ' || {_num('bx0')} || ' ' || {_num('by1')} || ', '
         || {_num('bx0')} || ' ' || {_num('by0')} || ', ' || {_num('bx1')} || ' '
         || {_num('by0')} || '))' AS bbox_wkt,
       bx0 - 0.5 AS exp_xmin, by0 - 0.5 AS exp_ymin, bx1 + 0.5 AS exp_xmax, by1 + 0.5 AS exp_ymax,
       '{{"min_lon":' || bx0::VARCHAR || ',"min_lat":' || by0::VARCHAR || ',"max_lon":'
         || bx1::VARCHAR || ',"max_lat":' || by1::VARCHAR || ',"bbox_array":['
         || bx0::VARCHAR || ',' || by0::VARCHAR || ',' || bx1::VARCHAR || ',' || by1::VARCHAR
         || ']}}' AS bbox_json,
       bx0::VARCHAR || ',' || by0::VARCHAR || ',' || bx1::VARCHAR || ',' || by1::VARCHAR
         AS bbox_csv,
       'Bounding Box:' || chr(10) || '  Min Longitude: ' || bx0::VARCHAR || chr(10)
         || '  Min Latitude:  ' || by0::VARCHAR || chr(10) || '  Max Longitude: '
         || bx1::VARCHAR || chr(10) || '  Max Latitude:  ' || by1::VARCHAR || chr(10)
         || '  Array format:  [' || bx0::VARCHAR || ', ' || by0::VARCHAR || ', '
         || bx1::VARCHAR || ', ' || by1::VARCHAR || ']' AS bbox_text
FROM fe"""

ORACLE["envelope_wkt"] = f"""
WITH {FA_UNITS}, w AS (SELECT o_orderkey, {FA_WKT} AS wkt FROM fa_u)
SELECT o_orderkey, {_env('wkt', WKT_PAIR)} FROM w"""

ORACLE["envelope_geojson"] = f"""
WITH {FA_UNITS}, g AS (SELECT o_orderkey, {FA_GEOJSON} AS geometry FROM fa_u)
SELECT o_orderkey, {_env(f"regexp_replace(geometry, '{_sql_str(GEOJSON_BBOX_MEMBER)}', '', 'g')",
                         GEOJSON_PAIR)} FROM g"""

# WKB and mixed encodings decode to the rectangle the key defines.
ORACLE["envelope_wkb"] = f"WITH {FA} SELECT o_orderkey, xmin, ymin, xmax, ymax FROM fa"
ORACLE["envelope_mixed"] = f"""
WITH {FA} SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'geojson' WHEN 1 THEN 'wkt'
  ELSE 'wkb_hex' END AS kind, xmin, ymin, xmax, ymax FROM fa"""

ORACLE["points_lonlat"] = f"""
WITH {FB}
SELECT event_id, lon AS xmin, lat AS ymin, lon AS xmax, lat AS ymax, 4326 AS srid FROM fb"""


# --- web API planning and pages -------------------------------------------------

_CSV = "bx0::VARCHAR || ',' || by0::VARCHAR || ',' || bx1::VARCHAR || ',' || by1::VARCHAR"
ORACLE["api_requests"] = f"""
WITH {FE}, j AS (
  SELECT fe.*, n.n_nationkey % 4 AS kind, lower(n.n_name) AS lname, n.n_name
  FROM fe JOIN nation n ON fe.job_name = 'job_' || lower(n.n_name)),
pages AS (SELECT j.*, unnest(CASE WHEN kind = 0 THEN [0, 1, 2] ELSE [0] END) AS page FROM j)
SELECT job_name, page,
  CASE kind
  WHEN 0 THEN 'https://gis.example.com/services/' || lname || '/query?f=geojson&outFields=%2A&where='
    || url_encode('n_regionkey = ' || n_regionkey::VARCHAR) || '&returnGeometry=true&geometry='
    || url_encode({_CSV}) || '&geometryType=esriGeometryEnvelope'
    || '&spatialRel=esriSpatialRelIntersects&resultOffset=' || (page * 1000)::VARCHAR
    || '&resultRecordCount=1000'
  WHEN 1 THEN 'https://gis.example.com/services/' || lname || '?service=WFS&version=2.0.0'
    || '&request=GetFeature&typeName=' || url_encode(n_name) || '&outputFormat='
    || url_encode('application/json') || '&bbox=' || url_encode({_CSV} || ',EPSG:4326')
    || '&srsName=' || url_encode('EPSG:4326')
  WHEN 2 THEN 'https://gis.example.com/services/' || lname || '/collections/' || lname
    || '/items?f=json&limit=100&bbox=' || url_encode({_CSV})
  ELSE 'https://gis.example.com/services/' || lname || '?format=json&minx='
    || url_encode(bx0::VARCHAR) || '&miny=' || url_encode(by0::VARCHAR) || '&maxx='
    || url_encode(bx1::VARCHAR) || '&maxy=' || url_encode(by1::VARCHAR)
  END AS request_url
FROM pages"""

_PAGED = """paged AS (
  SELECT o_orderkey, o_orderpriority AS layer,
         o_orderpriority || '/' || (o_orderkey // 10000)::VARCHAR AS job,
         row_number() OVER (PARTITION BY o_orderpriority, o_orderkey // 10000
                            ORDER BY o_orderkey) - 1 AS rn
  FROM orders)"""

ORACLE["offset_pages"] = f"""
WITH {_PAGED}
SELECT job, CAST((rn // 100) * 100 AS INTEGER) AS off, o_orderkey, layer, true AS complete
FROM paged"""

ORACLE["linked_pages"] = f"""
WITH {_PAGED}
SELECT job, rn // 100 AS step, o_orderkey, true AS complete FROM paged"""

ORACLE["single_page_features"] = f"WITH {FA} SELECT o_orderkey, layer, xmin, ymin, xmax, ymax FROM fa"

ORACLE["parse_record_bodies"] = """
WITH r AS (
  SELECT event_id, props, event_type,
         CASE event_id % 3 WHEN 0 THEN 'object' WHEN 1 THEN 'list' ELSE 'raw' END AS _shape
  FROM events),
e AS (SELECT r.*, unnest(CASE WHEN _shape = 'list' THEN [0, 1] ELSE [0] END) AS _pos FROM r)
SELECT event_id, _shape, _pos,
       CASE WHEN _shape <> 'raw' THEN json_extract(props, '$.k')::BIGINT END AS k,
       CASE WHEN _shape = 'raw' THEN 'status=' || event_type END AS _raw
FROM e"""


# --- jobs ---------------------------------------------------------------------------

_SCHEME = "lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.\\-]*)://', 1))"
_ROUTE = """CASE WHEN {s} IN ('http', 'https') AND contains(lower({u}), 'api') THEN 'api'
  WHEN {s} IN ('s3', 'gcs', 'azure', 'ftp', 'ssh', 'hdfs') THEN 'remote' ELSE 'file' END"""
_SUFFIX_OF = "lower(regexp_extract({p}, '(\\.[A-Za-z0-9]+)$', 1))"
_KIND = """CASE WHEN {x} IN ('.geojson', '.json') THEN 'json' WHEN {x} = '.parquet' THEN 'parquet'
  WHEN {x} = '.csv' THEN 'csv' WHEN {x} IN ('.shp', '.gpkg', '.gdb') THEN 'unsupported'
  ELSE 'csv' END"""


def _route_sql(u):
    return _ROUTE.format(s=_SCHEME.format(u=u), u=u)


def _kind_sql(u):
    return _KIND.format(x=_SUFFIX_OF.format(p=f"regexp_replace({u}, '[?#].*$', '')"))


ORACLE["resolve_jobs"] = f"""
WITH {FE}, j AS (
  SELECT fe.*, n.n_nationkey % 3 AS kind, n.n_nationkey % 5 = 0 AS named_loc,
         n.n_nationkey % 4 = 3 AS no_box, n.n_regionkey AS rk, n.n_nationkey AS nk, n.n_name
  FROM fe JOIN nation n ON fe.job_name = 'job_' || lower(n.n_name)),
-- fixed values of the built-in source and location: name, address, corners
r AS (
  SELECT job_name,
    CASE kind WHEN 0 THEN 'FWS Florida Wetlands' WHEN 1 THEN 'Nation ' || n_name END AS source_name,
    CASE kind WHEN 0 THEN 'zip://https://documentst.ecosphere.fws.gov/wetlands/data/State-Downloads/FL_geodatabase_wetlands.zip!FL_geodatabase_wetlands.gdb'
      WHEN 1 THEN 's3://bucket-' || rk::VARCHAR || '/nation_' || nk::VARCHAR || '.parquet' END AS url,
    CASE kind WHEN 0 THEN 'geom' WHEN 1 THEN 'geometry' ELSE 'geom' END AS geometry_column,
    CASE WHEN named_loc THEN -81.61303476507055 WHEN NOT no_box THEN bx0 END AS xmin,
    CASE WHEN named_loc THEN 28.34441345722594 WHEN NOT no_box THEN by0 END AS ymin,
    CASE WHEN named_loc THEN -81.56830935354668 WHEN NOT no_box THEN bx1 END AS xmax,
    CASE WHEN named_loc THEN 28.3768179430727 WHEN NOT no_box THEN by1 END AS ymax
  FROM j)
SELECT job_name,
  CASE WHEN url IS NULL THEN 'unknown_source' WHEN xmin IS NULL THEN 'no_bbox' ELSE 'ok' END AS status,
  source_name, url, geometry_column,
  {_route_sql('url')} AS route, {_kind_sql('url')} AS file_kind, xmin, ymin, xmax, ymax
FROM r"""

ORACLE["route_page_urls"] = f"""
WITH p AS (
  SELECT page_id, url,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#!]*)', 1) AS host,
    CASE WHEN {_SCHEME.format(u='url')} = '' THEN url
      ELSE regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#!]*([^?#]*)', 1) END AS path
  FROM pages)
SELECT page_id, {_SCHEME.format(u='url')} AS scheme, host, path,
  {_SUFFIX_OF.format(p='path')} AS suffix, {_route_sql('url')} AS route,
  {_kind_sql('url')} AS file_kind
FROM p"""

ORACLE["output_filenames"] = """
WITH j AS (SELECT 'job_' || lower(n_name) AS job_name,
                  unnest(['geojson', 'filegdb', 'csv', 'GPKG', 'xlsx']) AS format FROM nation)
SELECT job_name, format,
  'extracted_data_' || job_name || '_20240102_030405' ||
  CASE lower(format) WHEN 'geojson' THEN '.geojson' WHEN 'filegdb' THEN '.gdb'
    WHEN 'shapefile' THEN '.shp' ELSE '.' || lower(format) END AS file_name,
  CASE WHEN lower(format) IN ('geojson', 'csv', 'parquet') THEN 'supported'
    WHEN lower(format) IN ('shapefile', 'gpkg', 'filegdb') THEN 'unsupported'
    ELSE 'unknown' END AS status
FROM j"""

ORACLE["metadata_merge"] = f"""
WITH {FB}, e AS (
  SELECT ev.event_id, ev.event_type, ev.ts, fb.lon, fb.lat,
    CASE WHEN ev.event_type = 'error' THEN NULL
      ELSE json_extract_string(ev.props, '$.k') END AS k
  FROM events ev JOIN fb ON ev.event_id = fb.event_id)
SELECT event_id,
  'bbox=' || to_json([lon, lat, lon, lat]::DOUBLE[])::VARCHAR
  || ';extraction_date=' || strftime(ts, '%Y-%m-%dT%H:%M:%S')
  || CASE WHEN k IS NOT NULL THEN ';k=' || k ELSE '' END
  || ';source=' || event_type AS metadata
FROM e"""


# --- publish --------------------------------------------------------------------

_PER = """per AS (SELECT o_orderpriority AS folder, year(o_orderdate) AS year, count(*) AS n
  FROM orders GROUP BY 1, 2)"""

ORACLE["publish_upsert"] = f"""
WITH {_PER},
c AS (SELECT folder, 'orders_' || year::VARCHAR || '.geojson' AS file_name, year % 3 + 1 AS v,
             n * 100 AS b, n, year FROM per WHERE year <= 1998),
bt AS (SELECT folder, 'orders_' || year::VARCHAR || '.geojson' AS file_name, n * 120 AS b, n,
              folder <> '5-LOW' AS ok FROM per WHERE year >= 1997),
j AS (SELECT coalesce(c.folder, bt.folder) AS folder, coalesce(c.file_name, bt.file_name) AS file_name,
             c.v, c.b AS cb, c.n AS cn, c.year AS cy, bt.b AS bb, bt.n AS bn, bt.ok
      FROM c FULL OUTER JOIN bt ON c.folder = bt.folder AND c.file_name = bt.file_name),
a AS (SELECT *, CASE WHEN ok = false THEN 'missing' WHEN ok AND v IS NOT NULL THEN 'update'
                     WHEN ok THEN 'insert' ELSE 'keep' END AS action FROM j)
SELECT folder, file_name, action,
  CAST(CASE action WHEN 'update' THEN v + 1 WHEN 'insert' THEN 1 ELSE v END AS INTEGER)
    AS version,
  CASE WHEN action IN ('insert', 'update') THEN bb ELSE cb END AS bytes,
  CASE action WHEN 'update' THEN 'batch=r2;rows=' || bn::VARCHAR || ';year=' || cy::VARCHAR
    WHEN 'insert' THEN 'batch=r2;rows=' || bn::VARCHAR
    ELSE 'rows=' || cn::VARCHAR || ';year=' || cy::VARCHAR END AS metadata
FROM a"""

ORACLE["folder_get_or_create"] = f"""
WITH {_PER},
ex AS (SELECT DISTINCT 'root' AS parent, folder AS name FROM per WHERE year <= 1998),
rq AS (SELECT 'root' AS parent, folder AS name FROM per WHERE year >= 1997
       UNION SELECT 'root', 'y' || year::VARCHAR FROM per WHERE year >= 1997)
SELECT parent, name, 'f_' || substr(sha256(parent || '/' || name), 1, 12) AS folder_id,
       false AS created FROM ex
UNION ALL
SELECT parent, name, 'f_' || substr(sha256(parent || '/' || name), 1, 12), true
FROM rq WHERE (parent, name) NOT IN (SELECT parent, name FROM ex)"""


ORACLE["sql_box_filter"] = f"""
WITH {FA}
SELECT o_orderkey, layer, xmin, ymin, xmax, ymax FROM fa
WHERE {_box_pred('xmin', 'ymin', 'xmax', 'ymax')}"""

ORACLE["select_first_layer"] = f"""
WITH {FA}
SELECT layer, {_EXTENT} FROM fa WHERE layer = (SELECT min(layer) FROM fa) GROUP BY layer"""

ORACLE["extract_points_summary"] = f"""
WITH {FB}, {FE}
SELECT j.job_name, min(f.lon) AS xmin, min(f.lat) AS ymin, max(f.lon) AS xmax,
       max(f.lat) AS ymax, count(f.event_id) AS feature_count
FROM fe j LEFT JOIN fb f ON f.lon <= j.bx1 AND f.lon >= j.bx0 AND f.lat <= j.by1 AND f.lat >= j.by0
GROUP BY j.job_name"""


ORACLE["extent_with_empty_geometry"] = f"""
WITH {FA}
SELECT layer,
  min(CASE WHEN o_orderstatus <> 'P' THEN xmin END) AS xmin,
  min(CASE WHEN o_orderstatus <> 'P' THEN ymin END) AS ymin,
  max(CASE WHEN o_orderstatus <> 'P' THEN xmax END) AS xmax,
  max(CASE WHEN o_orderstatus <> 'P' THEN ymax END) AS ymax,
  count(*) AS feature_count,
  count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS geometry_count
FROM fa GROUP BY layer"""

ORACLE["csv_projection"] = "SELECT o_orderkey, o_orderpriority AS layer FROM orders"


# --- files, sinks, presets, strict checks, job run ---------------------------------------------

_FA_ROWS = f"WITH {FA} SELECT o_orderkey, layer, xmin, ymin, xmax, ymax"
ORACLE["read_geojson"] = f"{_FA_ROWS} FROM fa"
ORACLE["read_features_parquet"] = f"{_FA_ROWS}, true AS same FROM fa"
ORACLE["read_json_records"] = "SELECT event_id, event_type FROM events"
ORACLE["read_features_csv"] = f"""WITH {FB}
SELECT event_id, event_type, lon AS xmin, lat AS ymin, lon AS xmax, lat AS ymax FROM fb"""
ORACLE["parse_job_files"] = f"""WITH {FG_CUSTOMER}
SELECT job_name, 'src' AS source_key, bx0 AS xmin, by0 AS ymin, bx1 AS xmax, by1 AS ymax,
       CASE WHEN replace(job_name, 'cust_', '')::BIGINT % 2 = 1 THEN 'csv' ELSE 'geojson,parquet' END AS formats,
       'extracted_data' AS output_prefix
FROM fg"""
ORACLE["preset_jobs"] = """
SELECT c_custkey, 'arcgis' AS api_type,
       'https://gis.example.org/' || lower(c_mktsegment) || '/' || c_custkey::VARCHAR AS url, '' AS version FROM customer
UNION ALL
SELECT c_custkey, 'wfs', 'https://gis.example.org/' || lower(c_mktsegment), '2.0.0' FROM customer
UNION ALL
SELECT c_custkey, 'file', 's3://' || lower(c_mktsegment) || '/' || c_custkey::VARCHAR || '.parquet', '' FROM customer"""
ORACLE["extent_strict"] = ORACLE["extent_by_layer"]
ORACLE["export_formats"] = """
SELECT v.format, v.status, CASE WHEN v.status = 'ok' THEN o.n END AS rows,
       CASE WHEN v.format IN ('parquet', 'geojson') THEN 0::BIGINT END AS bad_rows
FROM (VALUES ('parquet', 'ok'), ('geojson', 'ok'), ('csv', 'ok'), ('filegdb', 'unsupported'), ('foo', 'unknown')) v(format, status),
     (SELECT count(*) AS n FROM orders) o"""
ORACLE["box_record"] = f"""WITH {FA}
SELECT min(xmin) AS min_lon, min(ymin) AS min_lat, max(xmax) AS max_lon, max(ymax) AS max_lat,
       'orders' AS source_file, 'all' AS layer FROM fa"""
ORACLE["job_run"] = f"""WITH {FA}, {FE}
SELECT j.job_name, v.format, v.status, count(f.o_orderkey) AS feature_count,
       min(f.xmin) AS xmin, min(f.ymin) AS ymin, max(f.xmax) AS xmax, max(f.ymax) AS ymax,
       v.status <> 'unsupported' AND count(f.o_orderkey) > 0 AS written
FROM fe j CROSS JOIN (VALUES ('csv', 'ok'), ('geojson', 'ok'), ('filegdb', 'unsupported')) v(format, status)
LEFT JOIN fa f ON {INTERSECTS}
GROUP BY j.job_name, v.format, v.status"""

ORACLE["read_geojson_packed"] = f"WITH {FA} SELECT o_orderkey, layer, xmin, ymin, xmax, ymax FROM fa"
ORACLE["read_archive_members"] = ORACLE["read_geojson_packed"]
ORACLE["read_archive_tables"] = "SELECT o_orderkey, o_orderpriority AS layer FROM orders"
ORACLE["remote_paths"] = """
WITH u AS (
  SELECT c_custkey, ['s3', 'gcs', 'azure', 'hdfs', 'ftp', 'file', 'S3'][c_custkey % 7 + 1] AS scheme,
         'store-' || lower(c_mktsegment) AS host, '/key=' || c_custkey::VARCHAR || '.parquet' AS rest FROM customer),
m AS (SELECT *, CASE lower(scheme) WHEN 's3' THEN 's3a' WHEN 'gcs' THEN 'gs' WHEN 'azure' THEN 'abfss' ELSE lower(scheme) END AS fs FROM u)
SELECT c_custkey, fs || '://' || host || rest AS path,
       'fs.' || fs || '.' || CASE WHEN fs = 's3a' THEN 'bucket.' || host || '.' ELSE '' END AS prefix FROM m"""

ORACLE["job_table_run"] = f"""
WITH {FA}, {FB}, {FE},
src AS (SELECT xmin, ymin, xmax, ymax, unnest([0, 1, 3]) AS s FROM fa
        UNION ALL SELECT lon, lat, lon, lat, 2 FROM fb),
k AS (SELECT 'job_' || lower(n_name) AS job_name, n_nationkey % 6 AS k FROM nation),
v AS (SELECT * FROM (VALUES ('csv', 'ok'), ('GeoJSON', 'ok'), ('parquet', 'ok'), ('filegdb', 'unsupported')) v(format, can)),
c AS (SELECT j.job_name, k.k, count(f.s) AS n, min(f.xmin) AS xmin, min(f.ymin) AS ymin, max(f.xmax) AS xmax, max(f.ymax) AS ymax
      FROM fe j JOIN k USING (job_name) LEFT JOIN src f ON f.s = k.k AND {INTERSECTS} GROUP BY j.job_name, k.k)
SELECT job_name, format, CASE WHEN k = 4 THEN 'needs_responses' WHEN k = 5 THEN 'unknown_source' ELSE can END AS status,
       n AS feature_count, xmin, ymin, xmax, ymax, k < 4 AND can = 'ok' AND n > 0 AS written,
       CASE WHEN k < 4 AND format = 'GeoJSON' AND n > 0 THEN n END AS lines
FROM c CROSS JOIN v"""

ORACLE["request_waves"] = f"""
WITH {_PAGED},
jobs AS (SELECT job, count(*) AS n, (count(*) + 99) // 100 AS pages FROM paged GROUP BY job),
recorded AS (
  SELECT job, n, pages, p, p % 3 <> 1 AS there, p % 3 <> 1 AND p % 5 <> 4 AS ok,
         p = pages OR (p = pages - 1 AND n % 100 <> 0) AS short
  FROM (SELECT *, unnest(range(pages + 1)) AS p FROM jobs)),
per AS (SELECT job, min(p) FILTER (WHERE ok AND short) AS stop, coalesce(max(p) FILTER (WHERE ok), -1) AS top FROM recorded GROUP BY job),
wanted AS (SELECT job, unnest(range(coalesce(stop, top + 2) + 1)) AS p FROM per)
SELECT w.job AS job_name, CAST(w.p AS INTEGER) AS page, CASE WHEN r.there THEN 2 ELSE 1 END AS attempt,
       'https://gis.example.org/' || regexp_replace(w.job, '[^A-Za-z0-9]', '_', 'g')
         || '/query?f=geojson&outFields=%2A&where=1%3D1&returnGeometry=true&resultOffset=' || (w.p * 100)::VARCHAR || '&resultRecordCount=100' AS request_url
FROM wanted w LEFT JOIN recorded r ON w.job = r.job AND w.p = r.p
WHERE NOT coalesce(r.ok, false)"""

ORACLE["publish_commits"] = f"""
WITH {_PER},
c AS (SELECT folder, 'orders_' || year::VARCHAR || '.geojson' AS file_name, year % 3 + 1 AS v, n * 100 AS b, n, year FROM per WHERE year <= 1998),
bt AS (SELECT folder, 'orders_' || year::VARCHAR || '.geojson' AS file_name, n * 120 AS b, n FROM per WHERE year >= 1997 AND folder <> '5-LOW')
SELECT coalesce(c.folder, bt.folder) AS folder, coalesce(c.file_name, bt.file_name) AS file_name,
       CAST(coalesce(c.v, 0) + CASE WHEN bt.b IS NULL THEN 0 ELSE 2 END AS INTEGER) AS version, coalesce(bt.b, c.b) AS bytes,
       CASE WHEN c.v IS NULL THEN 'batch=r2;rows=' || bt.n::VARCHAR
            WHEN bt.b IS NULL THEN 'rows=' || c.n::VARCHAR || ';year=' || c.year::VARCHAR
            ELSE 'batch=r2;rows=' || bt.n::VARCHAR || ';year=' || c.year::VARCHAR END AS metadata, true AS is_last
FROM c FULL OUTER JOIN bt ON c.folder = bt.folder AND c.file_name = bt.file_name"""

ORACLE["extent_from_footers"] = f"WITH {FA} SELECT layer, {_EXTENT} FROM fa GROUP BY layer"
ORACLE["geoparquet_footers"] = f"WITH {FA} SELECT 'geometry' AS primary_column, 'WKB' AS encoding, 'Polygon' AS types, {_EXTENT} FROM fa"

_FG_PARTS = FG_CUSTOMER + """,
g AS (SELECT fg.*, c.c_mktsegment AS segment, c.c_custkey % 50 AS part FROM fg JOIN customer c ON fg.job_name = 'cust_' || c.c_custkey::VARCHAR)"""
ORACLE["bbox_algebra_by_segment"] = f"""
WITH {_FG_PARTS},
a AS (SELECT segment, part, min(bx0) AS xmin, min(by0) AS ymin, max(bx1) AS xmax, max(by1) AS ymax,
             max(bx0 - 60) AS x0, max(by0 - 60) AS y0, min(bx1 + 60) AS x1, min(by1 + 60) AS y1 FROM g GROUP BY segment, part)
SELECT segment, part, xmin, ymin, xmax, ymax,
       CASE WHEN x0 < x1 AND y0 < y1 THEN x0 END AS ixmin, CASE WHEN x0 < x1 AND y0 < y1 THEN y0 END AS iymin,
       CASE WHEN x0 < x1 AND y0 < y1 THEN x1 END AS ixmax, CASE WHEN x0 < x1 AND y0 < y1 THEN y1 END AS iymax FROM a"""
ORACLE["bbox_scalars_many"] = f"""
WITH {FG_CUSTOMER}
SELECT job_name, bx0 AS b0, by0 AS b1, bx1 AS b2, by1 AS b3, bx0 - 0.25 AS xmin, by0 - 0.25 AS ymin, bx1 + 0.25 AS xmax, by1 + 0.25 AS ymax FROM fg"""
