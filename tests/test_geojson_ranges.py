"""The scanner of byte ranges against json.loads, for any layout and any size of the splits."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from geospan.sources import files, ranges

PROPS = "struct<i: bigint, s: string>"


def features(n, seed=3):
    rng = random.Random(seed)
    odd = ['}', '{', '"', '\\', '\\\\"', '[', ']', '},{"type":"Feature"', 'é😀', '\n', '"features":[', ' ', '\\u0041', "x" * 90]
    out = []
    for i in range(n):
        s = "".join(rng.choice(odd) for _ in range(rng.randrange(5)))
        geometry = rng.choice([None, {"type": "Point", "coordinates": [i, -i]},
                               {"type": "Polygon", "coordinates": [[[0, 0], [i, 0], [i, i], [0, 0]]]},
                               {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [i, 1]}]}])
        out.append({"type": "Feature", "properties": {"i": i, "s": s, "deep": {"a": [{"b": {}}, []]}}, "geometry": geometry})
    return out


def layouts(feats):
    head = {"type": "FeatureCollection", "name": 'a "quoted" {name}', "crs": {"type": "name", "properties": {"name": "x"}},
            "links": [{"rel": "next", "href": "}"}]}
    last = {"features": feats, "after": [{"type": "Feature", "properties": {"i": -1}, "geometry": None}], "bbox": [0, 0, 1, 1]}
    yield "packed", json.dumps({**head, **last}, separators=(",", ":"))
    yield "unicode", json.dumps({**head, "features": feats}, ensure_ascii=False) + "\n"
    yield "indented", json.dumps({"features": feats, **head}, indent=2)
    yield "several", "\n".join(json.dumps({**head, "features": feats[k::3]}) for k in range(3))
    yield "sequence", "".join("\x1e" + json.dumps(f) + "\n" for f in feats)


def expected(feats):
    return sorted((f["properties"]["i"], f["properties"]["s"], json.dumps(f["geometry"]) if f["geometry"] else None) for f in feats)


def read(df):
    return sorted((r["i"], r["s"], json.dumps(json.loads(r["geometry"])) if r["geometry"] else None) for r in df.collect())


@pytest.mark.parametrize("size", [64, 1000, 1 << 27])
def test_any_layout_in_any_split(spark, scratch, size):
    feats = features(12 if size == 64 else 40)
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        for name, text in layouts(feats):
            path = os.path.join(scratch, f"{name}.geojson")
            with open(path, "w", encoding="utf-8", newline="") as f:
                f.write(text)
            if size < 1 << 20:
                assert ranges.fragments(spark, path).select("range").distinct().count() > min(20, len(text) // size // 2)
            assert read(files.read_geojson(spark, path, PROPS)) == expected(feats), (name, size)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def test_several_files_and_an_empty_collection(spark, scratch):
    for k in range(3):
        with open(f"{scratch}/{k}.geojson", "w") as f:
            json.dump({"type": "FeatureCollection", "features": features(20, k)[:10 * k]}, f)
    got = read(files.read_geojson(spark, scratch, PROPS))
    assert got == sorted(expected(features(20, 1)[:10]) + expected(features(20, 2)))
    assert read(files.read_geojson_any(spark, scratch, properties_schema=PROPS)) == got
    assert files.read_geojson(spark, f"{scratch}/0.geojson", PROPS).count() == 0


def test_a_feature_over_many_ranges_and_one_line_over_many_tasks(spark, scratch):
    feats = features(3000)
    feats[5]["properties"]["s"] = "}" * 300_000  # one feature longer than ten ranges
    path = f"{scratch}/one_line.geojson"
    with open(path, "w") as f:
        json.dump({"type": "FeatureCollection", "features": feats}, f, separators=(",", ":"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        found = ranges.scan_features(spark, path)
        assert ranges.fragments(spark, path).select(F.spark_partition_id()).distinct().count() > 8
        assert found.count() == 3000
        assert read(files.read_geojson_any(spark, path, properties_schema=PROPS)) == expected(feats)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("text", ['{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"i":1}',
                                  '{"features":[{"type":"Feature","properties":{"s":"open}}]}',
                                  '{"features":[{"type":"Feature",bad}]}'])
def test_broken_files_raise(spark, scratch, text):
    path = f"{scratch}/broken.geojson"
    with open(path, "w") as f:
        f.write(text)
    with pytest.raises(Exception, match="don't close|no JSON"):
        files.read_geojson(spark, path, PROPS).collect()
