"""The stored manifest: versions, refused commits, broken-off publishes, concurrent ones."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from geospan.sinks import publish as P

BATCH = "folder string, file_name string, bytes long, metadata map<string,string>, exists boolean"


def batch(spark, *names, folder="f", size=1, exists=True):
    return spark.createDataFrame([(folder, n, size, {"by": n}, exists) for n in names], BATCH)


def state(spark, path, version=None):
    df, v = P.read_manifest(spark, path, version)
    return {r["file_name"]: (r["version"], r["bytes"]) for r in df.collect()}, v


def test_versions_follow_publishes(spark, scratch):
    path = f"{scratch}/m"
    assert state(spark, path) == ({}, 0)
    actions, v = P.publish(spark, path, batch(spark, "a", "b"))
    assert v == 1 and {r["file_name"]: r["action"] for r in actions.collect()} == {"a": "insert", "b": "insert"}
    P.publish(spark, path, batch(spark, "b", "c", size=5))
    actions, v = P.publish(spark, path, batch(spark, "a", "z", exists=False))
    assert {r["file_name"]: r["action"] for r in actions.collect()} == {"a": "missing", "z": "missing"}
    assert state(spark, path) == ({"a": (1, 1), "b": (2, 5), "c": (1, 5)}, 3)
    assert state(spark, path, 1)[0] == {"a": (1, 1), "b": (1, 1)}
    with pytest.raises(ValueError, match="no version"):
        P.read_manifest(spark, path, 9)
    assert P.remove_old_versions(spark, path, 1) == 2 and state(spark, path)[1] == 3
    P.publish(spark, path, batch(spark, "d"))
    assert set(state(spark, path)[0]) == {"a", "b", "c", "d"}


def test_a_commit_over_an_unread_version_is_refused_and_retried(spark, scratch, monkeypatch):
    path = f"{scratch}/m"
    base, v = P.read_manifest(spark, path)
    first = P.publish_manifest(base, batch(spark, "a")).drop("action")
    second = P.publish_manifest(base, batch(spark, "b")).drop("action")
    assert P.commit_manifest(spark, path, first, v) == 1
    with pytest.raises(P.ManifestMoved):
        P.commit_manifest(spark, path, second, v)
    # the other publish comes between reading and committing: the log entry is there already
    real, done = P._Store.commit, []

    def late(self, version, entry):
        if not done:
            done.append(version)
            P.commit_manifest(spark, path, P.publish_manifest(P.read_manifest(spark, path)[0], batch(spark, "x")).drop("action"), version - 1)
        return real(self, version, entry)
    monkeypatch.setattr(P._Store, "commit", late)
    actions, version = P.publish(spark, path, batch(spark, "b"))
    assert version == 3 and set(state(spark, path)[0]) == {"a", "x", "b"}


def test_a_publish_that_breaks_off_leaves_the_old_state(spark, scratch, monkeypatch):
    path = f"{scratch}/m"
    P.publish(spark, path, batch(spark, "a"))

    def broken(self, version, entry):
        raise OSError("gone")
    monkeypatch.setattr(P._Store, "commit", broken)
    with pytest.raises(OSError):
        P.publish(spark, path, batch(spark, "b"))
    monkeypatch.undo()
    assert state(spark, path) == ({"a": (1, 1)}, 1) and len(os.listdir(f"{path}/data")) == 2
    P.publish(spark, path, batch(spark, "c"))
    assert set(state(spark, path)[0]) == {"a", "c"} and P.remove_old_versions(spark, path, 2) == 1


def test_publishes_at_the_same_time_lose_nothing(spark, scratch):
    path, errors = f"{scratch}/m", []

    def run(k):
        try:
            P.publish(spark, path, batch(spark, f"n{k}"), attempts=10)
        except Exception as e:
            errors.append(e)
    threads = [threading.Thread(target=run, args=(k,)) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and state(spark, path) == ({f"n{k}": (1, 1) for k in range(3)}, 3)
    assert not [f for f in os.listdir(f"{path}/log") if "tmp" in f and not f.endswith(".crc")]
    assert P.read_manifest(spark, path)[0].where(F.col("metadata")["by"] != F.col("file_name")).count() == 0
