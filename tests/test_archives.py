"""Archives: members in pieces, globs with their case, files of any name, and bounded memory."""

import io
import json
import os
import subprocess
import sys
import zipfile

import pytest

from geospan.plans import jobs as J
from geospan.sources import files as S


def put(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in members.items():
            z.writestr(name, content)


@pytest.mark.parametrize("size,whole", [(1, False), (7, False), (7, True), (1000, True)])
def test_pieces_of_a_stream(size, whole):
    data = b"one\ntwo longer line\n\nthree\nno end"
    got = list(S.member_chunks(io.BytesIO(data), size, b"\n", whole))
    assert b"".join(c for _, c in got) == data and [o for o, _ in got] == [sum(len(c) for _, c in got[:k]) for k in range(len(got))]
    if whole:
        assert all(c.endswith(b"\n") for _, c in got[:-1])
    else:
        assert all(len(c) <= size for _, c in got)
    assert list(S.member_chunks(io.BytesIO(b""), size, b"\n", whole)) == []


def test_globs_names_and_errors(spark, scratch):
    put(f"{scratch}/in.kmz", {"a_b.geojson": "1", "aXb.geojson": "2", "A_B.geojson": "3", "d%e.txt": "4", "d/f.txt": "", "x[1].csv": "6"})
    with open(f"{scratch}/readme.txt", "w") as f:
        f.write("no archive")
    read = lambda path, glob=None: {r["member"]: bytes(r["content"]) for r in S.read_archive(spark, path, glob).collect()}
    assert read(f"{scratch}/in.kmz", "a_b.geojson") == {"a_b.geojson": b"1"}
    assert set(read(scratch, "*.geojson")) == {"a_b.geojson", "aXb.geojson", "A_B.geojson"}
    assert set(read(scratch, "[aA]?[bB].geojson")) == {"a_b.geojson", "aXb.geojson", "A_B.geojson"}
    assert set(read(scratch, "d%e.txt")) == {"d%e.txt"} and set(read(scratch, "x[[]1].csv")) == {"x[1].csv"}
    assert read(scratch, "d/*") == {"d/f.txt": b""} and len(read(scratch)) == 6
    with pytest.raises(ValueError, match="no archive"):
        S.read_archive(spark, f"{scratch}/readme.txt")
    with pytest.raises(Exception, match="too large for one row"):
        S.read_archive(spark, f"{scratch}/in.kmz", "a_b*", most_bytes=0).collect()


@pytest.mark.parametrize("chunk", [40, 1 << 20])
def test_features_and_tables_of_members(spark, scratch, chunk):
    feats = [{"type": "Feature", "properties": {"i": i, "s": "}" * (i % 5) + "é"}, "geometry": {"type": "Point", "coordinates": [i, 0]}} for i in range(60)]
    for k in range(3):
        put(f"{scratch}/{k}.zip", {"p.geojson": json.dumps({"type": "FeatureCollection", "features": feats[k::3]}, ensure_ascii=False),
                                   "l.geojson": "\n".join(map(json.dumps, feats[k::3])), "e.geojson": '{"features":[]}',
                                   "t.csv": "i,name\n" + "".join(f'{i},"a, {i}"\r\n' for i in range(k, 60, 3))})
    got = S.read_archive_features(spark, scratch, "*.geojson", "struct<i: bigint, s: string>", chunk_bytes=chunk).collect()
    assert sorted((r["i"], r["s"]) for r in got) == sorted((f["properties"]["i"], f["properties"]["s"]) for f in feats + feats)
    rows = S.read_archive_csv(spark, scratch, "*.csv", chunk_bytes=chunk).collect()
    assert sorted((int(r["i"]), r["name"]) for r in rows) == [(i, f"a, {i}") for i in range(60)]
    assert S.read_source(spark, f"zip://{scratch}/0.zip!t.csv").columns == ["i", "name"]
    assert S.read_source(spark, f"zip://{scratch}/0.zip!p.*").count() == 20


def test_broken_cells_raise(spark, scratch):
    put(f"{scratch}/x.zip", {"t.csv": 'a,b\n1,"x\ny"\n'})
    with pytest.raises(Exception, match="line break inside a cell"):
        S.read_archive_csv(spark, scratch, "*.csv").collect()
    put(f"{scratch}/y.zip", {"t.csv": "c,d\n1,2\n"})
    with pytest.raises(ValueError, match="header"):
        S.read_archive_csv(spark, scratch, "*.csv")


def test_a_large_member_in_a_small_process(scratch):
    """A member of 300 MB is read in pieces by a process that never grows by a quarter of it."""
    with zipfile.ZipFile(f"{scratch}/big.zip", "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z, z.open("big.ndjson", "w") as f:
        line = (json.dumps({"type": "Feature", "properties": {"s": "x" * 900}}) + "\n").encode() * 1000
        for _ in range(330):
            f.write(line)
    code = f"""
import resource, sys, zipfile
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
import pyarrow as pa
from geospan.sources import files as S
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
batch = pa.RecordBatch.from_pylist([{{"archive": "file://{scratch}/big.zip", "member": "big.ndjson", "size": 1}}])
total = sum(b.column(5)[0].as_buffer().size for b in S._read_chunks(4 << 20, b"\\n")([batch]))
print(total, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    total, grown = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=200).stdout.split())
    assert total > 300e6 and grown < 75_000  # KB


def test_remote_paths_equal_the_mapping_of_one_url(spark):
    urls = ["s3://b/k.parquet", "S3://B/k", "gcs://x/y?z", "azure://c@a/p", "hdfs://n:1/p", "/local/path", "ftp://h/f"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select("url", J.remote_path("url").alias("p"), J.option_prefix("url").alias("o")).collect()
    assert [r["p"] for r in rows] == [J.hadoop_path(u) for u in urls]
    for r in rows:
        keys = J.hadoop_options(r["url"], {"key": "k", "other": "v"})
        assert all(k.startswith("fs.") for k in keys) and (r["o"] is None or any(k.startswith(r["o"]) for k in keys))


def test_the_first_character_decides_wherever_it_is(spark, scratch):
    with open(f"{scratch}/cols.json", "w") as f:
        f.write(" " * 3000 + "\n" * 2000 + json.dumps({"a": [1, 2], "b": ["x", "y"]}))
    assert sorted(map(tuple, S.read_json_records(spark, f"{scratch}/cols.json").collect())) == [(1, "x"), (2, "y")]
    with open(f"{scratch}/rows.json", "w") as f:
        f.write("\n" * 5000 + json.dumps([{"a": [1, 2]}, {"a": [3]}]))
    assert S.read_json_records(spark, f"{scratch}/rows.json").count() == 2


def test_an_archive_is_written_as_its_features_come(spark, tmp_path, monkeypatch):
    """A task holds the features of one archive, not a batch of archives."""
    from geospan.sources import derived as D

    plans, frame = [], type(spark.range(0))
    put = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *a, **k: plans.append(self) or put(self, *a, **k))
    orders = spark.createDataFrame([(k, k % 7, f"{k % 3}-LAYER") for k in (*range(1, 61), 10_001, 20_001, 20_001)], "o_orderkey long, o_custkey long, o_orderpriority string")
    D.write_archives(orders, str(tmp_path / "zips"))
    assert plans and not any("array" in t for _, t in plans[0].dtypes)  # a row per feature, none per archive
    found = {}
    for path in (tmp_path / "zips").iterdir():
        with zipfile.ZipFile(path) as z:
            block = path.stem.rsplit("_", 1)[1]
            assert z.namelist() == [f"data/{block}_a.geojson", f"data/{block}xa.geojson", f"{block}.csv"]
            assert z.read(z.namelist()[0]) == z.read(z.namelist()[1])
            keys = sorted(f["properties"]["o_orderkey"] for f in json.loads(z.read(z.namelist()[0]))["features"])
            head, *lines = z.read(f"{block}.csv").decode().splitlines()
            assert head == "o_orderkey,layer" and sorted(int(x.split(",")[0]) for x in lines) == keys
            found[path.stem] = keys
    assert found["0_LAYER_0"] == list(range(3, 61, 3)) and found["2_LAYER_1"] == [10_001] and found["0_LAYER_2"] == [20_001, 20_001]
