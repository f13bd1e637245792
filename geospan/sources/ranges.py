"""GeoJSON of any layout in byte ranges (S1): packed on one line, indented, a feature a line.

Spark's text source cuts files into ranges and hands out fragments between two ``}``, whole, in
the range where they begin.  Whether a range begins inside a string, how deep, and in which list, isn't known
from the range itself, so the first pass sums a range up for both cases (quotes, change of depth,
what was opened last at each level), a running sum over the ranges of a file gives each its state, and
the second pass cuts the features out.  Features inside one range leave it whole; those that go over its
end are put together from pieces, so nothing is held but a batch and the features it begins.  What one task reads
from its begin to its end (a member of an archive) needs no first pass.
"""

from __future__ import annotations

import re
import uuid
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geospan.functions import plain as _plain
from geospan.session import ensure_checkpoint_dir

_LIST = re.compile(rb'"features"\s*:\s*\[')
_QUOTE, _OPEN, _CLOSE, _ESCAPE = 1, 2, 3, 4
_CLASS = np.zeros(256, np.uint8)
_CLASS[ord('"')] = _QUOTE
_CLASS[[ord("{"), ord("[")]] = _OPEN
_CLASS[[ord("}"), ord("]")]] = _CLOSE
_CLASS[ord("\\")] = _ESCAPE

#: What is read of a feature, each member as its text.
FEATURE = "struct<type:string, properties:string, geometry:string>"
#: Bytes of the table of ranges that may be broadcast; a row counts as 200.
BROADCAST_BYTES = 256 << 20


def fragments(spark: SparkSession, path, options: dict | None = None) -> DataFrame:
    """(file, range, value): the text before every ``}``; range is where the fragment's split of the file begins."""
    return (spark.read.options(**(options or {})).option("lineSep", "}").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), "value"))


def _brackets(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(places, +1 or -1, quotes before) of every bracket, and the number of quotes that aren't escaped."""
    raw = np.frombuffer(data, np.uint8)
    kind = _CLASS[raw]
    quotes = np.flatnonzero(kind == _QUOTE)
    slashes = np.flatnonzero(kind == _ESCAPE)
    if len(slashes) and len(quotes):
        first = np.flatnonzero(np.diff(slashes, prepend=-2) != 1)  # runs of backslashes
        size = np.diff(np.append(first, len(slashes)))
        after = slashes[first] + size
        quotes = np.setdiff1d(quotes, after[size % 2 == 1], assume_unique=True)
    at = np.flatnonzero((kind == _OPEN) | (kind == _CLOSE))
    return at, np.where(kind[at] == _OPEN, 1, -1), np.searchsorted(quotes, at), len(quotes)


def _runs(batches: Iterator[pa.RecordBatch], more: tuple[str, ...] = ()) -> Iterator[tuple]:
    """(batch columns of the first row, data) for rows that follow each other in one range; data has the ``}`` back."""
    for b in batches:
        if not b.num_rows:
            continue
        file, start = b.column(0), b.column(1)
        change = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(start[1:], start[:-1])).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), b.num_rows]
        for a, z in zip(edges, edges[1:]):
            part = b.slice(a, z - a)
            value = part.column(2).cast(pa.binary())
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), value), b"}")[0].as_py()
            yield {n: part.column(n)[0].as_py() for n in ("file", "range", *more)}, joined + b"}"


def _lists(data: bytes) -> set[int]:
    """Places where a list of features begins."""
    return {m.end() - 1 for m in _LIST.finditer(data)} if b'"features"' in data else set()


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each run: its quotes, bytes, and for a run that begins outside (0) or inside (1) a string the change of depth
    and, by depth against the run's begin, whether what was opened there last is a list of features."""
    rows: list[dict] = []
    for place, data in _runs(batches):
        at, step, before, quotes = _brackets(data)
        lists = _lists(data)
        row = {"file": place["file"], "range": place["range"], "quotes": quotes, "bytes": len(data)}
        for inside in (0, 1):
            live = (before + inside) % 2 == 0
            pos, change = at[live], step[live]
            depth = np.cumsum(change)
            opened = change > 0
            level, where = depth[opened][::-1] - 1, pos[opened][::-1]
            levels, last = np.unique(level, return_index=True)
            row[f"delta{inside}"] = int(depth[-1]) if len(depth) else 0
            row[f"levels{inside}"] = levels.tolist()
            row[f"lists{inside}"] = [int(where[k]) in lists for k in last]
        rows.append(row)
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=_SUMS)


_SUMS = pa.schema([("file", pa.string()), ("range", pa.int64()), ("quotes", pa.int64()), ("bytes", pa.int64())] + [
    (f"{n}{k}", t) for k in (0, 1) for n, t in (("delta", pa.int64()), ("levels", pa.list_(pa.int64())), ("lists", pa.list_(pa.bool_())))])
_SUMS_DDL = "file string, range long, quotes long, bytes long" + "".join(
    f", delta{k} long, levels{k} array<long>, lists{k} array<boolean>" for k in (0, 1))


def range_states(cut: DataFrame) -> DataFrame:
    """(file, range, inside, depth, in_list, root_from, element_from, ...): the state in which each range begins.

    inside: in a string; depth: open brackets; in_list: whether what is open at depth 2 is a list of
    features; root_from, element_from: the range where the object at depth 1 (3) was opened.
    A file that doesn't end at depth 0, outside a string, raises when the result is used.
    """
    # a range may come in several batches: number them as they come, each is a small range of its own
    runs = (cut.mapInArrow(_sum_up, _SUMS_DDL).withColumn("run", F.monotonically_increasing_id()).checkpoint())
    past = Window.partitionBy("file").orderBy("range", "run").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    runs = runs.withColumn("inside", F.pmod(F.coalesce(F.sum("quotes").over(past), F.lit(0)), F.lit(2)) == 1)
    maps = [F.map_from_arrays(f"levels{k}", f"lists{k}") for k in (0, 1)]
    runs = (runs.withColumn("delta", F.when(F.col("inside"), F.col("delta1")).otherwise(F.col("delta0")))
            .withColumn("opened", F.when(F.col("inside"), maps[1]).otherwise(maps[0]))
            .withColumn("depth", F.coalesce(F.sum("delta").over(past), F.lit(0))))

    def at(level):
        return F.try_element_at("opened", F.lit(level).cast("long") - F.col("depth"))
    end = F.sum("delta").over(whole)  # -1: the last fragment is what follows the last bracket
    broken = ~end.isin(0, -1) | (F.pmod(F.sum("quotes").over(whole), F.lit(2)) == 1)
    stated = runs.select(
        "file", "range", "run", "bytes", "inside", "depth",
        F.coalesce(F.last(at(1), ignorenulls=True).over(past), F.lit(False)).alias("in_list"),
        F.last(F.when(at(0).isNotNull(), F.col("range")), ignorenulls=True).over(past).alias("root_from"),
        F.last(F.when(at(2).isNotNull(), F.col("range")), ignorenulls=True).over(past).alias("element_from"),
        broken.alias("broken"), (F.max(F.coalesce(at(1), F.lit(False))).over(whole)).alias("collection"))
    return (stated.withColumn("first", F.row_number().over(Window.partitionBy("file", "range").orderBy("run")))
            .withColumn("bytes", F.sum("bytes").over(Window.partitionBy("file", "range")))
            .where("first = 1").drop("first", "run"))


_STATE = ("inside", "depth", "in_list", "root_from", "element_from")
_CUT_DDL = f"file string, kind string, origin long, range long, text string, list boolean, feature {FEATURE}"
_FEATURE = pa.struct([("type", pa.string()), ("properties", pa.string()), ("geometry", pa.string())])
_CUT = pa.schema([("file", pa.string()), ("kind", pa.string()), ("origin", pa.int64()), ("range", pa.int64()),
                  ("text", pa.string()), ("list", pa.bool_()), ("feature", _FEATURE)])
#: What stands before, between and after the properties and the geometry of a feature in the tersest spelling.
_TERSE = ('{"type":"Feature","properties":', ',"geometry":', "}")


def _between(data: bytes, *edges: np.ndarray) -> list[pa.Array]:
    """The texts from each edge to the next, for rows of edges in rising order: an array over ``data`` whose texts follow each other,
    of which those between two rows are left out."""
    k, n = len(edges), len(edges[0])
    offsets = np.stack(edges, axis=1).astype(np.int32).ravel()
    every = pa.StringArray.from_buffers(max(0, k * n - 1), pa.py_buffer(offsets), pa.py_buffer(data))
    return [every.take(pa.array(np.arange(n) * k + j)) for j in range(k - 1)]


def _terse(data: bytes, first: np.ndarray, end: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(places of the features in the tersest spelling among some, their members); ``inner``: the brackets of what lies right inside them."""
    at = np.searchsorted(inner, first)
    some = np.flatnonzero(np.searchsorted(inner, end) - at == 4)
    a, z, b, y = (inner[at[some] + k] + k % 2 for k in range(4))
    fits = (a - first[some] == len(_TERSE[0])) & (b - z == len(_TERSE[1])) & (end[some] - y == len(_TERSE[2]))
    some = some[fits]
    head, properties, middle, geometry, tail = _between(data, first[some], a[fits], z[fits], b[fits], y[fits], end[some])
    geometry, plain = _plain.feature_members(properties, geometry)
    for text, spelled in zip((head, middle, tail), _TERSE):
        plain &= pc.equal(text, spelled).to_numpy(zero_copy_only=False)
    keep = pa.array(plain)
    kinds = pa.repeat(pa.scalar("Feature"), int(plain.sum()))
    return some[plain], pa.StructArray.from_arrays([kinds, properties.filter(keep), geometry.filter(keep)], fields=list(_FEATURE))


class _Cutter:
    """Cuts the features out of one range; fed run by run, in order."""

    def __init__(self, place: dict):
        self.file, self.range = place["file"], place["range"]
        self.quotes, self.depth, self.in_list = int(place["inside"]), place["depth"], bool(place["in_list"])
        # what is open: (where it began, its text so far); None: nothing
        inside = self.in_list and self.depth >= 3
        self.element = (place["element_from"], []) if inside and place["element_from"] is not None else None
        self.root = (place["root_from"], []) if self.depth >= 1 and place["root_from"] is not None else None
        self.is_list = self.in_list and self.depth >= 2  # the open root has a list of features
        self.rows: list[tuple] = []

    def feed(self, data: bytes) -> pa.RecordBatch | None:
        """The elements that lie whole in ``data``; all others come to ``rows``."""
        at, step, before, quotes = _brackets(data)
        live = (before + self.quotes) % 2 == 0
        at, step = at[live], step[live]
        depth = self.depth + np.cumsum(step)
        lists = _lists(data)
        # only what happens at the edge of roots, lists and elements
        edge = np.flatnonzero(((step > 0) & ((depth == 1) | (depth == 2) | (depth == 3))) | ((step < 0) & ((depth >= 0) & (depth <= 2))))
        inner = at[((step > 0) & (depth == 4)) | ((step < 0) & (depth == 3))]
        at, step, level = at[edge], step[edge], depth[edge]
        # elements that follow each other between edges of roots and lists are taken together
        turns = np.flatnonzero(~(((step > 0) & (level == 3)) | ((step < 0) & (level == 2))))
        begin = 0  # where the open element's text goes on in data
        root, done, whole = 0, 0, []
        for turn in (*turns.tolist(), len(edge)):
            if self.in_list and turn > done:
                begin = self._elements(data, at[done:turn], step[done:turn], begin, whole)
            done = turn + 1
            if turn == len(edge):
                break
            p, s, d = int(at[turn]), int(step[turn]), int(level[turn])
            if s > 0:
                if d == 1:
                    self.root, self.is_list, root = ((self.range, []) if data[p] == 0x7B else None), False, p
                else:
                    self.in_list = p in lists
                    if self.in_list:
                        self.is_list = True
            elif d == 1:
                self.in_list = False
            elif self.root:
                if not self.is_list:
                    self.root[1].append(data[root:p + 1])
                self._done("root", self.root, self.is_list)
                self.root = None
        if self.element:
            self.element[1].append(data[begin:])
        if self.root and not self.is_list:
            self.root[1].append(data[root:])
        self.quotes += quotes
        self.depth = int(depth[-1]) if len(depth) else self.depth
        return self._whole(data, whole, inner) if whole else None

    def _elements(self, data: bytes, at: np.ndarray, step: np.ndarray, begin: int, whole: list) -> int:
        """Members of an open list by their brackets, which open and close in turn: those that begin and end here go to ``whole``."""
        if step[0] < 0:  # begun before
            if self.element and data[at[0]] == 0x7D:
                self.element[1].append(data[begin:int(at[0]) + 1])
                self._done("element", self.element)
            self.element = None
            at = at[1:]
        first, last = at[0::2], at[1::2]
        raw = np.frombuffer(data, np.uint8)
        objects = (raw[first[:len(last)]] == 0x7B) & (raw[last] == 0x7D)
        whole.append((first[:len(last)][objects], last[objects] + 1))
        if len(first) > len(last) and data[first[-1]] == 0x7B:
            self.element, begin = (self.range, []), int(first[-1])
        return begin

    def _whole(self, data: bytes, whole: list, inner: np.ndarray) -> pa.RecordBatch | None:
        first, end = (np.concatenate(c) for c in zip(*whole))
        if not len(first):
            return None
        try:
            data[int(first[0]):int(end[-1])].decode("utf-8")
        except UnicodeDecodeError:
            self.rows += [(self.file, "element", None, self.range, data[a:b], False) for a, b in zip(first.tolist(), end.tolist())]
            return None
        terse, members = _terse(data, first, end, inner)
        other = np.setdiff1d(np.arange(len(first)), terse, assume_unique=True)
        (text,), n = _between(data, first[other], end[other]), len(first)
        same = {"file": self.file, "kind": "element", "origin": None, "range": self.range, "list": False}
        several = {"text": pa.concat_arrays([pa.nulls(len(terse), pa.string()), text]),
                   "feature": pa.concat_arrays([members, pa.nulls(len(other), _FEATURE)])}
        columns = [several[f.name] if f.name in several else pa.repeat(pa.scalar(same[f.name], f.type), n) for f in _CUT]
        return pa.RecordBatch.from_arrays(columns, schema=_CUT)

    def _done(self, kind: str, what: tuple, is_list: bool = False) -> None:
        origin, text = what
        if origin == self.range:  # begun here: whole, unless it's the root of a collection
            if not is_list:
                self.rows.append((self.file, kind, None, self.range, b"".join(text), False))
        else:
            self.rows.append((self.file, kind, origin, self.range, b"".join(text), is_list))

    def told(self) -> Iterator[pa.RecordBatch]:
        """The rows so far."""
        if self.rows:
            file, kind, origin, begin, text, is_list = zip(*self.rows)
            self.rows = []
            text = [t.decode("utf-8", "replace") for t in text]
            columns = [pa.array(c, t.type) for c, t in zip((file, kind, origin, begin, text, is_list), _CUT)]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(text), _FEATURE)], schema=_CUT)

    def cut(self, data: bytes) -> Iterator[pa.RecordBatch]:
        whole = self.feed(data)
        if whole is not None:
            yield whole
        yield from self.told()

    def end(self) -> Iterator[pa.RecordBatch]:
        """What is left open goes on in the next range."""
        for kind, what, is_list in (("element", self.element, False), ("root", self.root, self.is_list)):
            if what:
                self.rows.append((self.file, kind, what[0], self.range, b"" if is_list else b"".join(what[1]), is_list))
        yield from self.told()


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter, seen = None, 0
    for place, data in _runs(batches, (*_STATE, "bytes")):
        if place["bytes"] is None:
            raise RuntimeError("the splits of a file changed between two reads; read it again")
        if cutter is None or (cutter.file, cutter.range) != (place["file"], place["range"]):
            if cutter is not None:
                yield from cutter.end()
            cutter, seen = _Cutter(place), 0
        seen += len(data)
        yield from cutter.cut(data)
        if seen > place["bytes"]:
            raise RuntimeError("the splits of a file changed between two reads; read it again")
    if cutter is not None:
        yield from cutter.end()


def cut_whole(file: str, pieces: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    """The features of a file that is read from its begin to its end, as ``_cut_out`` gives them, and a row of the kind ``broken``
    if its brackets or quotes don't close.  ``pieces``: its bytes, each piece but the last up to a ``}``."""
    cutter = _Cutter({"file": file, "range": 0, "inside": False, "depth": 0, "in_list": False, "root_from": None, "element_from": None})
    for data in pieces:
        data.decode("utf-8")
        yield from cutter.cut(data if data.endswith(b"}") else data + b"}")  # as the scanner of ranges has it
    if cutter.depth not in (0, -1) or cutter.quotes % 2:
        cutter.rows.append((file, "broken", None, 0, b"", False))
        yield from cutter.told()


def scan_features(spark: SparkSession, path, options: dict | None = None) -> DataFrame:
    """(file, kind, text, feature) of the features of some files, in any number of ranges; see ``scan_fragments``.

    A change of Spark's splits between the two reads raises (their number may follow the number of cores; set
    spark.sql.files.minPartitionNum where cores come and go)."""
    return scan_fragments(fragments(spark, path, options))


def scan_fragments(cut: DataFrame) -> DataFrame:
    """(file, kind, text, feature): the objects of every list ``features`` of a top-level object (kind element), and the top-level
    objects without one (root; newline-delimited files and text sequences), each as ``feature``, its members type, properties and
    geometry as text, and as its JSON text where it has no type.

    ``cut``: (file, range, value) as ``fragments`` gives it, the rows of a range next to each other and in their
    order.  It is evaluated twice; the result is written once to the shared checkpoint folder, where it stays until the
    owner of that folder clears it.  Rows come in no order.  Brackets and quotes inside strings, escapes, other members of the
    collection in any place, several objects in one file and any white space are taken as JSON takes them.  A
    file whose brackets or quotes don't close raises.
    """
    states = range_states(cut).checkpoint()
    _closed(states.where("broken"))
    known = states.select("file", "range", *_STATE, "bytes")
    if states.count() * 200 <= BROADCAST_BYTES:
        stated = cut.join(F.broadcast(known), ["file", "range"], "left")
    else:  # the rows of a range together again, in their order
        stated = (cut.withColumn("place", F.monotonically_increasing_id()).join(known, ["file", "range"], "left")
                  .repartition("file", "range").sortWithinPartitions("file", "range", "place"))
    found = _staged(stated.select("file", "range", "value", *_STATE, "bytes").mapInArrow(_cut_out, _CUT_DDL))
    # whole features have no origin; the pieces of the others, a feature for each end of a range at most, are put together
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("range", "text"))), lambda p: p.text), "")
    joined = (found.where("origin IS NOT NULL").groupBy("file", "kind", "origin").agg(text.alias("text"), F.max("list").alias("list"))
              .where("NOT list").select("file", "kind", "text", F.from_json("text", FEATURE).alias("feature")))
    return found.where("origin IS NULL").select("file", "kind", "text", "feature").unionByName(joined)


def scan_whole(files: DataFrame, read) -> DataFrame:
    """``scan_fragments`` in one pass, for files that a task reads from their begin to their end: ``read`` makes rows of
    ``cut_whole`` of a task's batches of ``files``."""
    found = _staged(files.mapInArrow(read, _CUT_DDL))
    _closed(found.where("kind = 'broken'"))
    return found.select("file", "kind", "text", "feature")


def _closed(broken: DataFrame) -> None:
    names = [r["file"] for r in broken.select("file").distinct().limit(5).collect()]
    if names:
        raise ValueError(f"brackets or quotes that don't close in {names}")


def _staged(found: DataFrame) -> DataFrame:
    """What was cut, written once, with the members of whole features beside or instead of their text, so that they are parsed once."""
    spark = found.sparkSession
    parsed = found.withColumn("feature", F.coalesce("feature", F.when(F.col("origin").isNull(), F.from_json("text", FEATURE))))
    parsed = parsed.withColumn("text", F.when(F.col("feature.type").isNull(), F.col("text")))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/features-{uuid.uuid4().hex}"
    parsed.write.parquet(path)
    return spark.read.schema(parsed.schema).parquet(path)
