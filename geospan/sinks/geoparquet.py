"""GeoParquet files with the file-level ``geo`` key (K2), as a Python data source writer.

Spark's own Parquet writer has no option for that key.  Here every task writes one file with pyarrow, its
``geo`` key with the file's own box and geometry types in the footer, under a temporary folder; the driver's
commit moves the files of the tasks that Spark accepted, and an abort leaves nothing.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from geospan.stores import file_system

FORMAT = "geospan-geoparquet"
BOUNDS = ("xmin", "ymin", "xmax", "ymax")
#: Fixed names of the geometry types, by their code.
TYPE_NAMES = ("", "Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon", "GeometryCollection")


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class Summary:
    """Box and geometry types of the rows of a file."""

    def __init__(self):
        self.box, self.types = [np.inf, np.inf, -np.inf, -np.inf], set()

    def add(self, batch: pa.RecordBatch, geometry: str) -> None:
        names = batch.schema.names
        if "bbox" in names:
            box = batch.column(names.index("bbox"))
            for k, bound in enumerate(BOUNDS):
                v = box.field(bound).filter(box.is_valid()).drop_null().to_numpy(zero_copy_only=False)
                v = v[~np.isnan(v)]
                if len(v):
                    self.box[k] = min(self.box[k], float(v.min())) if k < 2 else max(self.box[k], float(v.max()))
        g = batch.column(names.index(geometry)).drop_null()
        if len(g):
            at = np.frombuffer(g.buffers()[1], np.int32)[g.offset:g.offset + len(g) + 1].astype(np.int64)
            raw = np.frombuffer(g.buffers()[2], np.uint8) if g.buffers()[2] else np.zeros(0, np.uint8)
            at = at[:-1][np.diff(at) >= 5]
            b = raw[at[:, None] + np.arange(5)].astype(np.int64)
            code = np.where(b[:, 0] == 1, b[:, 1:] @ (1 << np.array([0, 8, 16, 24])), b[:, 1:] @ (1 << np.array([24, 16, 8, 0])))
            kind = code & 0x0FFFFFFF
            flat, z = kind % 1000, ((code & 0x80000000) != 0) | np.isin(kind // 1000, (1, 3))
            self.types.update(TYPE_NAMES[f] + " Z" * bool(h) for f, h in set(zip(flat.tolist(), z.tolist())) if 1 <= f <= 7)

    def key(self, geometry: str) -> str:
        column = {"encoding": "WKB", "geometry_types": sorted(self.types),
                  "covering": {"bbox": {b: ["bbox", b] for b in BOUNDS}}}
        if all(np.isfinite(self.box)):
            column["bbox"] = self.box
        return json.dumps({"version": "1.1.0", "primary_column": geometry, "columns": {geometry: column}})


class GeoParquetWriter(DataSourceArrowWriter):
    def __init__(self, path: str, geometry: str, row_group: int, schema: pa.Schema, overwrite: bool):
        self.path, self.geometry, self.row_group, self.schema, self.overwrite = path.rstrip("/"), geometry, row_group, schema, overwrite
        self.held = f"{self.path}/_temporary-{uuid.uuid4().hex}"

    def _write(self, place: str, batches) -> None:
        import pyarrow.parquet as pq

        store, inner = file_system(place)
        store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        summary = Summary()
        with store.open_output_stream(inner) as out, pq.ParquetWriter(out, self.schema, compression="zstd") as w:
            for b in batches:
                b = b.cast(self.schema)
                summary.add(b, self.geometry)
                w.write_batch(b, row_group_size=self.row_group)
            w.add_key_value_metadata({"geo": summary.key(self.geometry)})

    def write(self, batches) -> Written:
        held, rows = [], 0

        def groups():
            """Batches of a row group's size, whatever size Spark sends."""
            nonlocal held, rows
            for b in batches:
                held.append(b)
                rows += b.num_rows
                while rows >= self.row_group:
                    t = pa.Table.from_batches(held).combine_chunks()
                    yield from t.slice(0, self.row_group).to_batches()
                    held, rows = t.slice(self.row_group).to_batches(), rows - self.row_group
            if rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
        found = groups()
        first = next(found, None)
        if first is None:
            return Written(None)
        name = f"part-{uuid.uuid4().hex}.parquet"

        def every():
            yield first
            yield from found
        self._write(f"{self.held}/{name}", every())
        return Written(name)

    def commit(self, messages) -> None:
        store, root = file_system(self.path)
        _, held = file_system(self.held)
        names = [m.name for m in messages if m is not None and m.name]
        if not names:  # the schema of no rows
            names = ["part-empty.parquet"]
            self._write(f"{self.held}/{names[0]}", [])
        if self.overwrite:
            from pyarrow import fs
            for f in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if f.path.rstrip("/") != held.rstrip("/"):
                    store.delete_dir(f.path) if f.type == fs.FileType.Directory else store.delete_file(f.path)
        for name in names:
            store.move(f"{held}/{name}", f"{root}/{name}")
        store.delete_dir(held)
        with store.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages) -> None:
        from pyarrow import fs
        store, held = file_system(self.held)
        if store.get_file_info(held).type == fs.FileType.Directory:
            store.delete_dir(held)


class GeoParquetSource(DataSource):
    """Options: path; geometry (the WKB column, default ``geometry``); row_group (rows, default 65536)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> GeoParquetWriter:
        from pyspark.sql.pandas.types import to_arrow_schema

        return GeoParquetWriter(self.options["path"], self.options.get("geometry", "geometry"), int(self.options.get("row_group", 1 << 16)),
                                to_arrow_schema(schema), overwrite)
