import pytest
from pyspark.sql import functions as F

from geospan.functions.bbox import lit_bbox
from geospan.functions.sql import register_sql_functions
from geospan.operators.geometry import require_features
from geospan.plans.jobs import route
from geospan.plans.requests import arcgis_jobs, plan_requests, s3_jobs, wfs_jobs


def test_sql_functions(spark):
    names = register_sql_functions(spark)
    assert "env_wkt" in names
    r = spark.sql("""SELECT env_wkt('MULTIPOINT ((1 2), (-3 4))') AS e,
                            env_geojson('{"type":"Point","bbox":[9,9,9,9],"coordinates":[5,6]}') AS g,
                            bbox_intersects(make_bbox(0, 0, 1, 1), make_bbox(1, 1, 2, 2)) AS touch,
                            bbox_to_list(expand_bbox(make_bbox(0, 0, 1, 1), 1)) AS grown""").first()
    assert tuple(r["e"]) == (-3, 2, 1, 4)
    assert tuple(r["g"]) == (5, 6, 5, 6)
    assert r["touch"] is True
    assert r["grown"] == [-1, -1, 2, 2]


def test_sql_filter_pushdown(spark, scratch):
    register_sql_functions(spark)
    df = spark.range(20).select(F.col("id"), F.struct(
        F.col("id").cast("double").alias("xmin"), F.lit(0.0).alias("ymin"),
        (F.col("id") + 1).cast("double").alias("xmax"), F.lit(1.0).alias("ymax")).alias("bbox"))
    df.write.parquet(f"{scratch}/p")
    spark.read.parquet(f"{scratch}/p").createOrReplaceTempView("boxes_t")
    q = spark.sql("SELECT id FROM boxes_t WHERE bbox_intersects(bbox, make_bbox(3, 0, 4, 1))")
    assert sorted(r["id"] for r in q.collect()) == [2, 3, 4]
    assert "PushedFilters: [IsNotNull(bbox)" in q._jdf.queryExecution().executedPlan().toString() \
        or "bbox.xmin" in q._jdf.queryExecution().executedPlan().toString()


def test_presets(spark):
    df = spark.createDataFrame([("https://h/arcgis/rest/services/x/FeatureServer", 3)],
                               "service_url string, layer_id int").withColumn("bbox", lit_bbox([-81.5, 28.3, -81.2, 28.6]))
    req = plan_requests(arcgis_jobs(df)).first()
    assert req["request_url"].startswith("https://h/arcgis/rest/services/x/FeatureServer/3/query?f=geojson")
    assert "geometry=-81.5%2C28.3%2C-81.2%2C28.6" in req["request_url"]
    w = spark.createDataFrame([("https://h/wfs", "ns:layer")], "wfs_url string, layer_name string") \
        .withColumn("bbox", lit_bbox([-82, 28, -81, 29]))
    wr = plan_requests(wfs_jobs(w)).first()["request_url"]
    assert "version=2.0.0" in wr and "typeName=ns%3Alayer" in wr and "EPSG%3A4326" in wr
    s = s3_jobs(spark.createDataFrame([("b", "k/a.parquet")], "bucket string, key string"))
    row = s.select("url", route("url").alias("r")).first()
    assert (row["url"], row["r"]) == ("s3://b/k/a.parquet", "remote")


def test_ogc_and_generic_requests(spark):
    df = spark.createDataFrame([
        ("j1", "ogcapi", "https://h/ogc", "lakes", {"limit": "100"}),
        ("j2", "rest", "https://h/api", None, {"format": "json"})],
        "job_name string, api_type string, url string, collection string, params map<string,string>") \
        .withColumn("bbox", lit_bbox([-0.2, 51.4, -0.1, 51.5]))
    out = {r["job_name"]: r["request_url"] for r in plan_requests(df).collect()}
    assert out["j1"] == ("https://h/ogc/collections/lakes/items?f=json&limit=100"
                         "&bbox=-0.2%2C51.4%2C-0.1%2C51.5")
    assert out["j2"] == "https://h/api?format=json&minx=-0.2&miny=51.4&maxx=-0.1&maxy=51.5"


def test_require_features(spark):
    with pytest.raises(ValueError):
        require_features(spark.range(0))
    with pytest.raises(ValueError):
        require_features(None)
    assert require_features(spark.range(2)).count() == 2


def test_arcgis_count_then_pages(spark):
    from geospan.plans.requests import pages_from_count, plan_arcgis, plan_arcgis_count
    jobs = spark.createDataFrame([("j", "https://h/FeatureServer/0", '{"count": 2500}')],
                                 "job_name string, url string, count_body string") \
        .withColumn("bbox", lit_bbox([0, 0, 1, 1])).withColumn("max_records", F.lit(1000))
    cu = plan_arcgis_count(jobs).first()["count_url"]
    assert cu.endswith("returnCountOnly=true") and "/query?f=geojson" in cu
    planned = plan_arcgis(jobs.withColumn("n_pages", pages_from_count(F.col("count_body"), 1000)),
                          n_pages="n_pages")
    offs = sorted(r["page"] for r in planned.collect())
    assert offs == [0, 1, 2]


def test_params_override_in_place_and_box_params(spark):
    from geospan.plans.requests import bbox_params_sql, plan_generic, query_string
    jobs = spark.createDataFrame([("j", "rest", "u"), ("k", "WFS", "u")], "job_name string, api_type string, url string").withColumns(
        {"bbox": lit_bbox([1, 2, 3, 4]), "params": F.expr("CASE WHEN job_name = 'j' THEN map('a', 'x y*', 'minx', '7', 'c', '3') END")})
    got = {r["job_name"]: r["q"] for r in plan_generic(jobs).select("job_name", query_string(F.col("request_params")).alias("q")).collect()}
    assert got == {"j": "a=x%20y%2A&minx=1.0&c=3&miny=2.0&maxx=3.0&maxy=4.0", "k": "bbox=1.0%2C2.0%2C3.0%2C4.0"}
    row = jobs.where("job_name = 'j'").withColumn("other", F.lit(None).cast("struct<xmin: double, ymin: double, xmax: double, ymax: double>")).select(
        query_string(F.expr(bbox_params_sql("bbox", "'OGCAPI'"))).alias("one"), F.size(F.expr(bbox_params_sql("other"))).alias("none")).first()
    assert (row["one"], row["none"]) == ("bbox=1.0%2C2.0%2C3.0%2C4.0", 0)
