"""Helpers shared by the llm operators."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geospan.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string): the only columns the operators read; a null text is empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def process_state(name: str, make):
    """One value for the life of a Python worker, so that its tasks share it (vocabularies,
    memos).  Kept on ``sys`` because geospan's own modules are shipped by value and are made
    anew for every task."""
    state = vars(sys).setdefault("_geospan_llm_state", {})
    if name not in state:
        state[name] = make()
    return state[name]


class Memo(dict):
    """key -> make(key), remembered; forgets everything when it holds ``most`` keys, so that its
    memory is bounded.  Never changes a result."""

    def __init__(self, make, most: int = 400_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self.make(key)
        if len(self) >= self.most:
            self.clear()
        if len(key) <= 64:
            self[key] = value
        return value


def slices(batches: Iterator[pa.RecordBatch], column: str,
           max_bytes: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut record batches into pieces of about ``max_bytes`` of text (a row at least); gives each
    piece with its texts, null as empty.  Bounds the memory of a task by its longest text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(np.cumsum(size, dtype=np.int64) // max_bytes)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a), [t or "" for t in texts.slice(a, b - a).to_pylist()]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts end to end (uint32), and where each text starts (with the end)."""
    joined = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return joined, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def map_batches(df: DataFrame, make, schema: str) -> DataFrame:
    """``df.mapInArrow`` of a generator that gives dicts of columns; the columns get the types of
    ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kind = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for columns in make(batches):
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, type=f.type, from_pandas=False)
                 for x, f in ((columns[f.name], f) for f in kind)], schema=kind)

    return df.mapInArrow(run, schema)


#: Rows that one step of a tree combines.
FAN = 8


def list_matrix(column, dim: int, fill: int = 0) -> np.ndarray:
    """A column of lists as rows of int64; shorter lists end in ``fill``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at = column.offsets.to_numpy()
    size = np.diff(at)
    out = np.full((len(column), dim), fill, np.int64)
    row = np.repeat(np.arange(len(column)), size)
    out[row, np.arange(len(row)) - np.repeat(at[:-1] - at[0], size)] = column.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]]
    return out


def tree(parts: DataFrame, combine, schema: str) -> DataFrame:
    """Rows (slot, ...) combined by FAN at a time until one is left; ``combine`` takes a pandas frame in the order of slots."""
    slots = parts.agg(F.max("slot")).first()[0] or 0
    while slots > 0:
        def step(key, pdf):
            out = combine(pdf.sort_values("slot"))
            out["slot"] = [key[0]]
            return out
        parts = parts.withColumn("slot", F.floor(F.col("slot") / FAN).cast("int")).groupBy("slot").applyInPandas(step, schema)
        slots //= FAN
    return parts


def sum_over_rows(lists: DataFrame, dim: int, of, fill: int = 0) -> np.ndarray:
    """Sum over the rows of a column of lists of what ``of`` gives for a matrix of some of them; a row of one array per
    task, added up in a tree."""
    import pandas as pd

    def part(batches):
        total = None
        for b in batches:
            x = list_matrix(b.column(0), dim, fill)
            for a in range(0, len(x), 4096):
                one = of(x[a:a + 4096])
                total = one if total is None else total + one
        if total is not None:
            yield {"slot": [TaskContext.get().partitionId()], "m": [total.ravel().tolist()]}

    def combine(pdf):
        return pd.DataFrame({"slot": [0], "m": [np.sum(np.stack(pdf["m"].to_numpy()), axis=0)]})
    parts = map_batches(lists, part, "slot int, m array<double>").checkpoint()
    return np.array(tree(parts, combine, "slot int, m array<double>").first()["m"])
