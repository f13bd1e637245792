import io
import json
import uuid
import zipfile

from pyspark.sql import functions as F

from geospan.functions.bbox import make_bbox
from geospan.operators.geometry import decode_geometry
from geospan.sinks.export import export_multiple, save_box_record
from geospan.sinks.publish import publish_manifest
from geospan.sources import files as S
from geospan.sources.responses import parse_features, parse_records
from geospan.streaming.bbox_stream import start_box_extraction

FC = {"type": "FeatureCollection", "features": [
    {"type": "Feature", "properties": {"name": "A", "pop": 1},
     "geometry": {"type": "Polygon", "coordinates": [[[-81.61, 28.34], [-81.56, 28.34],
                                                      [-81.56, 28.38], [-81.61, 28.34]]]}},
    {"type": "Feature", "properties": {"name": "B", "extra": True},
     "geometry": {"type": "Point", "coordinates": [1, 2]}},
    {"type": "Feature", "properties": None, "geometry": None}]}


def test_read_geojson_ragged_properties(spark, scratch):
    with open(f"{scratch}/a.geojson", "w") as f:
        json.dump(FC, f)
    df = decode_geometry(S.read_geojson(spark, f"{scratch}/a.geojson"), "geometry")
    rows = {r["name"]: r for r in df.collect()}
    assert set(df.columns) >= {"name", "pop", "extra", "geometry", "bbox"}
    assert rows["A"]["extra"] is None and rows["B"]["pop"] is None
    assert rows["A"]["bbox"].xmin == -81.61 and rows["A"]["bbox"].ymax == 28.38
    assert rows[None]["bbox"] is None


def test_parse_features_empty_and_records(spark):
    df = spark.createDataFrame([('{"type":"FeatureCollection","features":[]}',)], "body string")
    assert parse_features(df).count() == 0
    rec = spark.createDataFrame([('[{"a":1},{"a":2}]',), ('{"a":3}',), ("oops",)], "body string")
    rows = parse_records(rec).collect()
    assert sorted((r["_shape"], r["a"]) for r in rows if r["_shape"] != "raw") == \
        [("list", 1), ("list", 2), ("object", 3)]
    assert [r["_raw"] for r in rows if r["_shape"] == "raw"] == ["oops"]


def test_read_json_records_both_shapes(spark, scratch):
    with open(f"{scratch}/l.json", "w") as f:
        json.dump([{"a": 1, "b": "x"}, {"a": 2, "b": "y"}], f)
    with open(f"{scratch}/d.json", "w") as f:
        json.dump({"a": [1, 2, 3], "b": ["x", "y", "z"]}, f)
    assert S.read_json_records(spark, f"{scratch}/l.json").count() == 2
    d = S.read_json_records(spark, f"{scratch}/d.json").orderBy("a").collect()
    assert [(r["a"], r["b"]) for r in d] == [(1, "x"), (2, "y"), (3, "z")]


def test_archive_members(spark, scratch):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("data/a.csv", "id,geom\n1,POINT (1 2)\n")
        z.writestr("data/b.geojson", json.dumps(FC))
    with open(f"{scratch}/x.zip", "wb") as f:
        f.write(buf.getvalue())
    m = S.read_archive(spark, scratch, member_glob="data/*.geojson").collect()
    assert len(m) == 1 and json.loads(bytes(m[0]["content"]))["type"] == "FeatureCollection"
    assert S.parse_zip_url("zip://https://h/x.zip!a.gdb") == ("https://h/x.zip", "a.gdb")


def test_select_layer(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 3)], "layer string, v int")
    assert sorted(r["v"] for r in S.select_layer(df).collect()) == [2, 3]
    assert S.select_layer(df, "b").count() == 1


def _features(spark):
    df = spark.createDataFrame([(1, "a", "POLYGON ((0 0, 2 0, 2 2, 0 0))"),
                                (2, "b", "POINT (5 6)")], "id long, name string, geometry string")
    return decode_geometry(df, "geometry").drop("_bad")


def test_export_multiple_roundtrip(spark, scratch):
    df = _features(spark)
    man = {r["format"]: r for r in export_multiple(
        df, scratch, "out", ["geojson", "csv", "parquet", "filegdb", "xlsx"]).collect()}
    assert man["filegdb"]["status"] == "unsupported" and man["xlsx"]["status"] == "unknown"
    assert all(man[f]["status"] == "ok" and man[f]["rows"] == 2 for f in ("geojson", "csv", "parquet"))
    csv = spark.read.option("header", True).csv(man["csv"]["path"])
    assert sorted(csv.columns) == ["id", "name"]
    gj = [json.loads(r["value"]) for r in spark.read.text(man["geojson"]["path"]).collect()]
    assert sorted(g["properties"]["id"] for g in gj) == [1, 2]
    pq = spark.read.parquet(man["parquet"]["path"])
    back = decode_geometry(pq, "geometry").orderBy("id").collect()
    assert (back[0]["bbox"].xmax, back[1]["bbox"].ymin) == (2.0, 6.0)
    assert json.loads(spark.read.text(man["parquet"]["path"] + "_geo.json").first()["value"]
                      )["columns"]["geometry"]["encoding"] == "WKB"


def test_box_record(spark, scratch):
    ext = spark.createDataFrame([(0.0, 1.0, 2.0, 3.0)], "xmin double, ymin double, xmax double, ymax double")
    save_box_record(ext, f"{scratch}/box", source_file="a.geojson", buffer=0.1)
    r = spark.read.json(f"{scratch}/box").first()
    assert r["bbox"]["max_lat"] == 3.0 and r["source_file"] == "a.geojson"


def test_publish_rerun_is_idempotent(spark):
    cur = spark.createDataFrame([("f", "a.csv", 1, 10, {"x": "1"})],
                                "folder string, file_name string, version int, bytes long, "
                                "metadata map<string,string>")
    batch = spark.createDataFrame([("f", "a.csv", 12, {"y": "2"}, True),
                                   ("f", "b.csv", 5, {}, True), ("f", "c.csv", 5, {}, False)],
                                  "folder string, file_name string, bytes long, "
                                  "metadata map<string,string>, exists boolean")
    out = {r["file_name"]: r for r in publish_manifest(cur, batch).collect()}
    assert out["a.csv"]["action"] == "update" and out["a.csv"]["version"] == 2
    assert out["a.csv"]["metadata"] == {"x": "1", "y": "2"}
    assert out["b.csv"]["action"] == "insert" and out["c.csv"]["action"] == "missing" and out["c.csv"]["version"] is None


def test_streaming_box_filter_equals_batch(spark, scratch):
    src = f"{scratch}/src"
    df = spark.range(100).select(F.col("id"), make_bbox(F.col("id") - 50, F.lit(0.0),
                                                        F.col("id") - 49, F.lit(1.0)).alias("bbox"))
    df.repartition(4).write.parquet(src)
    q = start_box_extraction(spark, src, df.schema, [0, 0, 10, 10], f"{scratch}/sink", f"t1-{uuid.uuid4().hex}")
    q.awaitTermination(120)
    got = sorted(r["id"] for r in spark.read.parquet(f"{scratch}/sink").collect())
    assert got == list(range(49, 61))


def test_read_source_dispatch(spark, scratch):
    with open(f"{scratch}/a.geojson", "w") as f:
        json.dump(FC, f)
    with open(f"{scratch}/p.csv", "w") as f:
        f.write("id,geom\n1,POINT (3 4)\n2,\n")
    g = S.read_source(spark, f"{scratch}/a.geojson", geometry="geometry")
    assert g.where("bbox IS NOT NULL").count() == 2
    c = S.read_source(spark, f"{scratch}/p.csv").orderBy("id").collect()
    assert c[0]["bbox"].xmin == 3.0 and c[1]["bbox"] is None
    _features(spark).write.parquet(f"{scratch}/f.parquet")
    assert S.read_source(spark, f"{scratch}/f.parquet").count() == 2


def test_export_without_parquet_and_geojson_geometry(spark, scratch):
    df = _features(spark)
    man = {r["format"]: r for r in export_multiple(df, scratch, "g", ["geojson", "csv"]).collect()}
    assert man["geojson"]["status"] == "ok" and man["csv"]["rows"] == 2
    feats = sorted((json.loads(r["value"]) for r in spark.read.text(man["geojson"]["path"]).collect()),
                   key=lambda g: g["properties"]["id"])
    assert feats[0]["geometry"]["type"] == "Polygon"
    assert feats[1]["geometry"] == {"type": "Point", "coordinates": [5.0, 6.0]}


def test_line_oriented_feature_collection(spark, scratch):
    feats = [f for f in FC["features"] if f["properties"]]
    with open(f"{scratch}/big.geojson", "w") as f:
        f.write('{\n"type": "FeatureCollection",\n"features": [\n')
        f.write(",\n".join(json.dumps(x) for x in feats))
        f.write("\n]\n}\n")
    with open(f"{scratch}/seq.geojsons", "w") as f:
        for x in feats:
            f.write("\x1e" + json.dumps(x) + "\n")
    a = S.read_geojson_lines(spark, f"{scratch}/big.geojson").orderBy("name").collect()
    b = S.read_geojson_lines(spark, f"{scratch}/seq.geojsons").orderBy("name").collect()
    assert [r["name"] for r in a] == ["A", "B"] and [r["name"] for r in b] == ["A", "B"]
    src = S.read_source(spark, f"{scratch}/big.geojson", geometry="geometry")
    assert src.where("bbox IS NOT NULL").count() == 2


def test_many_archives_many_members(spark, scratch):
    for a in range(3):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            for m in range(4):
                z.writestr(f"d/{m}.csv", f"id,geom\n{a * 10 + m},POINT ({a} {m})\n")
        with open(f"{scratch}/a{a}.zip", "wb") as f:
            f.write(buf.getvalue())
    rows = S.read_archive(spark, scratch, member_glob="d/*.csv", partitions=5).collect()
    assert len(rows) == 12
    assert sorted(int(bytes(r["content"]).decode().split("\n")[1].split(",")[0]) for r in rows) == \
        sorted(a * 10 + m for a in range(3) for m in range(4))
