"""WARC archives: a writer on Spark's text sink and a splittable reader.

Each record is a gzip member of its own.  The writer hands members as rows to the text sink, which
commits them like any Spark output on any file system; the sink's row separator is an empty gzip
member, so a file is a plain sequence of members.  The reader deals byte ranges of the files to
tasks: a task looks for gzip magic in its range, takes a candidate as a record only if it
decodes to a WARC header, and owns the records that start inside its range.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geospan.llm.common import map_batches
from geospan.session import ensure_checkpoint_dir

MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  least_bytes: int = 1000) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to).

    Of rows with equal payloads of at least ``least_bytes`` the largest page_id is the response
    and the others revisit it; all smaller payloads, and rows whose payload no other row has, are
    responses.  A null html is an empty payload, a null page_id never is the largest; rows that
    repeat the largest page_id are responses too.  The first row of a payload is found by a
    partially aggregated max, so a payload that many pages share is a row per task.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    kept = (rows.where(F.col("payload_bytes") >= least_bytes).groupBy(F.col("payload_digest").alias("_digest"))
            .agg(F.max("page_id").alias("_kept"), F.count("*").alias("_n")).where("_n > 1"))
    again = F.coalesce((F.col("payload_bytes") >= least_bytes) & F.col("_kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_kept")), F.lit(False))
    return (rows.join(kept, F.col("payload_digest") == F.col("_digest"), "left")
            .withColumn("record_type", F.when(again, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(again, F.col("_kept"))).drop("_digest", "_kept", "_n"))


def _urn(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def record(page_id, url, payload: bytes, size: int, digest: str, kind: str, refers_to, date: str) -> bytes:
    """The gzip member of one record.  A revisit holds the HTTP header alone, which names the length
    of the payload it leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", _urn(page_id, digest)), ("WARC-Date", date),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if url is not None:
        head.append(("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)))
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if kind == "revisit":
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to, digest)), ("X-Refers-To-Page-Id", str(refers_to))]
    head.append(("Content-Length", str(len(block))))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(text.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + packer.flush()


def write(records: DataFrame, folder: str, date: str = "2020-01-01T00:00:00Z") -> None:
    """Write the rows of ``with_revisits`` as archives, one per task, into a new folder."""
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256).to_pylist()
                yield {"member": [record(r["page_id"], r["url"], r["payload"], r["payload_bytes"], r["payload_digest"],
                                         r["record_type"], r["refers_to"], date) for r in part]}
    members = map_batches(records, run, "member binary")
    (members.select(F.col("member").cast("string").alias("value")).write
     .option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(folder))


class ByteRange:
    """Reads a file anywhere through pyarrow's file systems (local, HDFS, object stores); keeps one
    stretch of it in memory."""

    def __init__(self, uri: str, size: int, step: int = 1 << 20):
        from pyarrow import fs

        if uri.startswith("file:/") and not uri.startswith("file://"):
            uri = "file://" + uri[len("file:"):]
        store, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
        self.file, self.size, self.step = store.open_input_file(path), size, step
        self.start, self.data = 0, b""

    def at(self, place: int) -> memoryview:
        """The stretch from ``place`` on (empty at the end of the file), not copied."""
        if not self.start <= place < self.start + len(self.data):
            self.start, self.data = place, self.file.read_at(min(self.step, max(0, self.size - place)), place)
        return memoryview(self.data)[place - self.start:]

    def find(self, place: int, end: int) -> int:
        """Where the next magic starts, from ``place`` to before ``end``; -1: nowhere."""
        while place < end:
            self.at(place)
            k = self.data.find(MAGIC, place - self.start)
            if k >= 0:
                return self.start + k if self.start + k < end else -1
            after = self.start + len(self.data)
            if after >= self.size:
                return -1
            place = max(place + 1, after - len(MAGIC) + 1)
            self.start, self.data = place, b""
        return -1


class Damaged(ValueError):
    """A record that begins but can't be read to its end."""


def member(source: ByteRange, place: int, sure: bool = False) -> tuple[bytes | None, int]:
    """(content, end) of the member at ``place``; content None where no WARC record or empty member starts.

    A candidate is given up as soon as what it decodes to can't be a header.  Once a header has been decoded, and
    from the start where a member must begin (``sure``: right after another one), whatever stops the decoding is damage."""
    unpack, out, at = zlib.decompressobj(31), bytearray(), place
    try:
        while not unpack.eof:
            part = source.at(at)[:1 << 16]
            if not part:
                if sure or _is_record(out):
                    raise Damaged(f"record at byte {place} ends in the midst")
                return None, place
            out += unpack.decompress(part)
            at += len(part)
            if out and not bytes(out[:5]) == b"WARC/"[:len(out)]:
                if sure:
                    raise Damaged(f"member at byte {place} is no record")
                return None, place
    except zlib.error as e:
        if sure or _is_record(out):
            raise Damaged(f"record at byte {place}: {e}") from None
        return None, place
    return bytes(out), at - len(unpack.unused_data)


def _is_record(out: bytearray) -> bool:
    return out[:5] == b"WARC/" and b"\r\n\r\n" in out


def parse_record(content: bytes) -> dict:
    """Header fields and payload of a decoded record."""
    head, _, block = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:] if ": " in line)
    fields = {k.lower(): v for k, v in fields.items()}
    block = block[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), len(payload))
    return {"fields": fields, "payload": payload, "length": length}


def records(source: ByteRange, start: int, end: int, flag: bool = False) -> Iterator[dict]:
    """The records that start in [start, end), whole, in order.

    A member must be followed by another one or the end of the file, also where that is beyond ``end``; so each
    beginning but a file's first is checked by the reader of the record before it.  Damage raises, or with ``flag`` gives a
    record with the key ``damaged``, after which the search goes on."""
    place, sure = source.find(start, end), False
    while 0 <= place < end:
        try:
            content, after = member(source, place, sure)
            if content:
                yield parse_record(content)
            if content is not None and after < source.size:
                if bytes(source.at(after)[:1]) != MAGIC[:1]:
                    raise Damaged(f"no member follows the one before byte {after}")
                if after >= end:
                    _check_begin(source, after)
        except Damaged as e:
            if not flag:
                raise
            yield {"damaged": str(e)}
            content, after = None, place
        sure = content is not None
        place = after if sure else source.find(place + 1, end)


def _check_begin(source: ByteRange, place: int) -> None:
    """The first bytes of the member at ``place``, which another reader owns, decode to a record's."""
    unpack, head = zlib.decompressobj(31), source.file.read_at(min(1 << 12, source.size - place), place)
    try:
        out = unpack.decompress(head, 64)
    except zlib.error as e:
        raise Damaged(f"record at byte {place}: {e}") from None
    if not out and not unpack.eof:
        raise Damaged(f"record at byte {place} ends in the midst")
    if out and out[:5] != b"WARC/"[:len(out)]:
        raise Damaged(f"member at byte {place} is no record")


def read(spark: SparkSession, folder: str, split_bytes: int = 16 << 20, with_payload: bool = True, damaged: str = "raise") -> DataFrame:
    """The records of all archives in a folder, as ``RECORD`` rows; digest and size of a response are
    taken from the payload that was read, and a payload that differs from its digest raises.  So does a record that is
    damaged or cut off; with ``damaged="flag"`` it gives a row of record_type ``damaged`` with the reason as its url
    (found by the reader of the record before it, it may give two), and the others are read."""
    if damaged not in ("raise", "flag"):
        raise ValueError("damaged: raise or flag")
    files = spark.read.format("binaryFile").load(folder).select("path", "length").where("length > 0")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    # a number of its own, because rows this small would be coalesced into one task
    ranges = ranges.repartition(max(1, min(ranges.count(), 20_000)), "path", "start")

    def run(batches):
        import hashlib

        for batch in batches:
            for row in batch.to_pylist():
                source = ByteRange(row["path"], row["length"])
                held: list[dict] = []
                size = 0
                for r in records(source, row["start"], min(row["start"] + split_bytes, row["length"]), damaged == "flag"):
                    if "damaged" in r:
                        held.append(dict.fromkeys(("page_id", "refers_to", "payload_bytes", "payload_digest", "payload")) | {
                            "url": f"{row['path']}: {r['damaged']}", "record_type": "damaged"})
                        continue
                    f, whole = r["fields"], r["fields"]["warc-type"] == "response"
                    digest = f["warc-payload-digest"].partition(":")[2]
                    if whole and hashlib.sha1(r["payload"]).hexdigest() != digest:
                        raise ValueError(f"payload of {f.get('warc-record-id')} in {row['path']} does not match its digest")
                    held.append({"page_id": int(f["x-page-id"]) if "x-page-id" in f else None, "url": f.get("warc-target-uri"),
                                 "record_type": f["warc-type"], "refers_to": int(f["x-refers-to-page-id"]) if "x-refers-to-page-id" in f else None,
                                 "payload_bytes": len(r["payload"]) if whole else r["length"], "payload_digest": digest,
                                 "payload": r["payload"] if whole and with_payload else None})
                    size += len(r["payload"])
                    if size > 8 << 20:
                        yield _columns(held)
                        held, size = [], 0
                if held:
                    yield _columns(held)
    return map_batches(ranges, run, RECORD)


def _columns(rows: list[dict]) -> dict:
    return {k: [r[k] for r in rows] for k in rows[0]}


def round_trip(pages: DataFrame, folder: str | None = None, split_bytes: int = 16 << 20) -> DataFrame:
    """Write ``pages`` as archives and read these back: (page_id, payload_bytes, payload_digest,
    record_type, refers_to).  The archives stay in ``folder`` (default: a new one in the shared
    checkpoint folder), because the result is read from them."""
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    write(with_revisits(pages), folder)
    return read(spark, folder, split_bytes, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
