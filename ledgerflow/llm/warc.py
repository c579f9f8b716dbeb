"""WARC: write archives, normalise monolithic gzip files, read back by offset.

``write_monolithic`` writes one gzip stream per archive. ``normalise`` inflates each
such stream once, front to back, writes every record as a gzip member of its own and
puts a sidecar index (one JSON line per record with offset and length) beside the
archive. ``read_indexed`` opens single members by those offsets.

Files go to a folder that all executors share, through pyarrow's file systems. A
task writes under a name of its own attempt and moves the finished file into place,
so a lost executor or a second attempt leaves one whole file.

Defined results: null html is an empty payload; a null page_id writes a record without
an id and never becomes the response that others refer to; rows that repeat both
id and payload are all responses if theirs is the largest id; an empty table gives no
archives and no rows; a very long payload is one record, held by one task; other columns are ignored.
"""
from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, shared_path

# Fixed values.
MIN_REVISIT_BYTES = 1000
VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 1 << 20
ARCHIVE_BYTES = 64 << 20  # an archive is closed when so many bytes went in


def _filesystem(path: str):
    from pyarrow import fs
    got, at = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return got, at


def _qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme of the store that Spark would write it to, so that executors open the same one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and not whole.startswith("file://") else whole


def plan_records(pages: DataFrame) -> DataFrame:
    """pages with payload, payload_bytes, payload_digest, record_type and refers_to.

    Digests are grouped without the payloads (partial aggregation keeps a group of
    copies from meeting in one task); only digests with a revisit are joined back.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digest = F.sha1(payload)
    size = F.octet_length(payload).cast("long")
    twins = (pages.select("page_id", digest.alias("payload_digest"), size.alias("n"))
             .where(F.col("n") >= MIN_REVISIT_BYTES)
             .groupBy("payload_digest").agg(F.max("page_id").alias("winner"), F.min("page_id").alias("least"),
                                            F.count(F.lit(1)).alias("n"))
             .where((F.col("n") > 1) & F.col("winner").isNotNull()).select("payload_digest", "winner"))
    twins = materialise(twins, "warc-twins")  # its size is known to the planner from here on
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"),
                        size.alias("payload_bytes"), digest.alias("payload_digest"))
    revisit = F.col("winner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    return (rows.join(twins, "payload_digest", "left")
            .select("page_id", "url", "payload", "payload_bytes", "payload_digest",
                    F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("winner")).alias("refers_to")))


def record_bytes(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One uncompressed WARC record; a revisit keeps the HTTP header only."""
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = [("WARC-Type", kind), ("WARC-Record-ID", name(page_id)), ("WARC-Date", DATE),
            ("WARC-Target-URI", "".join((url or "").split())), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if kind == "revisit":
        head += [("WARC-Refers-To", name(refers_to)), ("WARC-Profile", PROFILE)]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict, bytes]:
    """Header fields (lower-case names) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[:int(fields["content-length"])]


class _Out:
    """A file that appears under its name only when it is whole."""

    def __init__(self, folder: str, name: str):
        self.fs, at = _filesystem(folder)
        self.fs.create_dir(at, recursive=True)
        self.uri, self.final = f"{folder}/{name}", f"{at}/{name}"
        self.tmp = f"{at}/.{name}.{TaskContext.get().taskAttemptId()}"
        self.file, self.at = self.fs.open_output_stream(self.tmp, compression=None), 0

    def write(self, data: bytes) -> None:
        self.file.write(data)
        self.at += len(data)

    def close(self) -> None:
        self.file.close()
        self.fs.move(self.tmp, self.final)


def write_monolithic(records: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Write the records of each partition as archives of one gzip stream each;
    returns (archive, records), a row per archive."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n, raw, done = None, 0, 0, 0

        def close():
            out.write(zipper.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [out.uri], "records": pa.array([n], pa.int64())})

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in
                           ("page_id", "url", "payload", "payload_digest", "record_type", "refers_to"))):
                if out is None:
                    out = _Out(folder, f"part-{TaskContext.get().partitionId():06d}-{done:04d}.warc.gz")
                    zipper, n, raw = zlib.compressobj(level, zlib.DEFLATED, 31), 0, 0
                data = record_bytes(*r)
                out.write(zipper.compress(data))
                n, raw = n + 1, raw + len(data)
                if raw >= ARCHIVE_BYTES:
                    yield close()
                    out, done = None, done + 1
        if out is not None:
            yield close()

    return materialise(records.mapInArrow(task, "archive string, records long"), "warc-written")


def inflate(stream) -> Iterator[bytes]:
    """Inflate a gzip file (one member or many) chunk by chunk."""
    z, fresh = zlib.decompressobj(31), True
    while chunk := stream.read(READ_BYTES):
        while chunk:
            if z.eof:
                z, fresh = zlib.decompressobj(31), True
            data = z.decompress(chunk)
            fresh = False
            chunk = z.unused_data
            if data:
                yield data
    if not z.eof and not fresh:
        raise ValueError("the gzip stream ends early")


def split_records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Cut an inflated stream into records; holds one record and one chunk."""
    held = bytearray()
    need = None
    for chunk in chunks:
        held += chunk
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                head = held[:end].decode("utf-8").lower().split("\r\n")
                length = next(int(x.partition(":")[2]) for x in head if x.startswith("content-length:"))
                need = end + 4 + length + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held.strip():
        raise ValueError("the archive ends inside a record")


def _each_file(archives: DataFrame) -> DataFrame:
    """The archive names dealt out, one or few to a task."""
    n = archives.count()
    return archives.select("archive").repartition(max(1, min(n, 100_000)))


def normalise(archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrite each archive with a member per record and a sidecar index;
    returns (archive, index, records)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                fs, at = _filesystem(uri)
                name = uri.rsplit("/", 1)[1]
                out, index, n = _Out(folder, name), _Out(folder, name + ".idx"), 0
                with fs.open_input_stream(at, compression=None) as stream:
                    for data in split_records(inflate(stream)):
                        fields, _ = parse_record(data)
                        z = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = z.compress(data) + z.flush()
                        index.write((json.dumps({
                            "id": fields["warc-record-id"], "type": fields["warc-type"], "offset": out.at,
                            "length": len(member), "url": fields["warc-target-uri"]}) + "\n").encode())
                        out.write(member)
                        n += 1
                out.close()
                index.close()
                yield pa.RecordBatch.from_pydict({"archive": [out.uri], "index": [index.uri],
                                                  "records": pa.array([n], pa.int64())})

    return materialise(_each_file(archives).mapInArrow(task, "archive string, index string, records long"),
                       "warc-normalised")


READ_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
               "archive string, record_offset long, record_length long")


def read_indexed(archives: DataFrame) -> DataFrame:
    """Every record of the normalised archives, each opened by its index entry."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()),
                        ("record_offset", pa.int64()), ("record_length", pa.int64())])

    def page(urn: str | None):
        digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                fs, at = _filesystem(uri)
                rows = []
                with fs.open_input_file(at) as f, fs.open_input_stream(at + ".idx", compression=None) as index:
                    lines = index.read().splitlines()
                    for entry in map(json.loads, lines):
                        f.seek(entry["offset"])
                        fields, block = parse_record(zlib.decompress(f.read(entry["length"]), 31))
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(http.rpartition(b"Content-Length:")[2])
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        if fields["warc-type"] == "response" and (
                                len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                            raise ValueError(f"{uri}: payload differs from its digest at {entry['offset']}")
                        rows.append((page(fields["warc-record-id"]), size, digest, fields["warc-type"],
                                     page(fields.get("warc-refers-to")), uri, entry["offset"], entry["length"]))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)],
                                                     schema=schema)

    return _each_file(archives).mapInArrow(task, READ_SCHEMA)


def round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as monolithic archives, normalise them, read them back."""
    folder = _qualified(spark, folder or shared_path(spark, "warc"))
    written = write_monolithic(plan_records(pages), f"{folder}/monolithic")
    return read_indexed(normalise(written, f"{folder}/normalised"))
