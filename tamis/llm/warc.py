"""WARC archives written from and read into a table of record chunks.

A record travels as rows (record, chunk number, bytes), never as one value: payloads are cut where they leave the scan,
their SHA-1 digests are carried from chunk to chunk, and writer and reader hold one chunk at a time. Records with equal
payloads are decided by digests alone; then decisions and chunks of a record are brought together and sorted, so that
the writer meets a record's decision, then its chunks in order.

Archives are gzip members, one per record, in files of about ``archive_bytes`` below the shared folder. A task writes
files with names of their own and reports them; only reported files are in the manifest, so a task that is lost or run
twice leaves nothing that is read. The folder must be reachable by pyarrow's file systems (a mounted folder, HDFS or an
object store).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import written
from tamis.session import scratch_path

TASKS = 20000
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = ("page_id long, url string, record_type string, refers_to long, chunk_no long, data binary, "
          "bytes_so_far long, digest_so_far string, payload_bytes long, payload_digest string, last boolean")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunk_table(rows: DataFrame, payload: str, chunk_bytes: int, *keep: str) -> DataFrame:
    """One row per chunk: ``keep``, ``chunk_no``, ``n_chunks`` and ``data``; an empty payload has one empty chunk."""
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    last = F.floor((F.greatest(F.octet_length(data), F.lit(1)) - 1) / chunk_bytes)
    cut = rows.select(*keep, data.alias("__payload"), (last + 1).alias("n_chunks"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("chunk_no"))
    start = (F.col("chunk_no") * chunk_bytes + 1).cast("int")
    return cut.select(*keep, "chunk_no", "n_chunks", F.substring(F.col("__payload"), start, F.lit(chunk_bytes)).alias("data"))


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``page_id, x, payload_bytes, payload_digest`` from chunks that come in order."""
    state, size = hashlib.sha1(), 0
    for batch in batches:
        out = []
        pages, keys, numbers, counts, chunks = (batch.column(k) for k in ("page_id", "x", "chunk_no", "n_chunks", "data"))
        for i in range(batch.num_rows):
            chunk = chunks[i].as_buffer()
            state.update(chunk)
            size += chunk.size
            if numbers[i].as_py() + 1 == counts[i].as_py():
                out.append((pages[i].as_py(), keys[i].as_py(), size, base32(state.digest())))
                state, size = hashlib.sha1(), 0
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(
                zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                names=["page_id", "x", "payload_bytes", "payload_digest"])


def record_uri(page_id, x) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}:{x & 0xFFFFFFFFFFFFFFFF:016x}>"


def page_of(uri: str) -> int | None:
    found = uri.strip("<>").split(":")[2]
    return None if found == "null" else int(found)


def head(row: dict, date: str) -> bytes:
    """Header of a record and the HTTP header that begins its block; the payload follows for a response."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}"
            "\r\n\r\n").encode()
    length = len(http) + (row["payload_bytes"] if row["record_type"] == "response" else 0)
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", record_uri(row["page_id"], row["x"])),
              ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", "sha1:" + row["payload_digest"])]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", "".join(f"%{ord(c):02X}" if c < " " else c for c in row["url"])))
    if row["record_type"] == "revisit":
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_uri(row["refers_to"], row["refers_x"]))]
    fields.append(("Content-Length", str(length)))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + http


class Archive:
    """Files in the folder, each closed at the first record end beyond ``limit`` bytes."""

    def __init__(self, folder: str, limit: int, level: int):
        self.system, self.root = fs.FileSystem.from_uri(folder)
        self.folder, self.limit, self.level = folder.rstrip("/"), limit, level
        self.file, self.done = None, []

    def begin(self) -> None:
        if self.file is None:
            self.system.create_dir(self.root, recursive=True)
            self.name = f"{uuid.uuid4().hex}.warc.gz"
            self.file, self.records, self.size = self.system.open_output_stream(f"{self.root}/{self.name}", compression=None), 0, 0
        self.gz = zlib.compressobj(self.level, zlib.DEFLATED, 31)

    def write(self, data) -> None:
        packed = self.gz.compress(data)
        self.size += len(packed)
        self.file.write(packed)

    def end(self) -> None:
        packed = self.gz.compress(b"\r\n\r\n") + self.gz.flush()
        self.size += len(packed)
        self.file.write(packed)
        self.records += 1
        if self.size >= self.limit:
            self.close()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.done.append((f"{self.folder}/{self.name}", self.records, self.size))
            self.file = None

    def reported(self) -> Iterator[pa.RecordBatch]:
        if self.done:
            path, records, size = zip(*self.done)
            self.done = []
            yield pa.record_batch({"path": pa.array(path), "records": pa.array(records, pa.int64()), "bytes": pa.array(size, pa.int64())})


def write_records(folder: str, limit: int, level: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, decision = Archive(folder, limit, level), None
        for batch in batches:
            numbers, counts, data = batch.column("chunk_no"), batch.column("n_chunks"), batch.column("data")
            fields = batch.drop_columns(["data", "chunk_no", "n_chunks"])
            for i in range(batch.num_rows):
                number = numbers[i].as_py()
                if number < 0:  # the decision comes before the chunks of its record
                    decision = fields.slice(i, 1).to_pylist()[0]
                    continue
                if number == 0:
                    archive.begin()
                    row = decision | {"url": fields.column("url")[i].as_py()}
                    archive.write(head(row, date))
                if decision["record_type"] == "response":
                    archive.write(data[i].as_buffer())
                if number + 1 == counts[i].as_py():
                    archive.end()
            yield from archive.reported()
        archive.close()
        yield from archive.reported()

    return run


def write_archives(
    pages: DataFrame, folder: str | None = None, min_bytes: int = 0, chunk_bytes: int = 1 << 20,
    archive_bytes: int = 128 << 20, level: int = 6, date: str = "2024-01-01T00:00:00Z",
    id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
) -> DataFrame:
    """Writes one record per row and returns the manifest: ``path, records, bytes`` of every archive.

    Of records with equal payloads of at least ``min_bytes`` bytes, that with the largest id is a response and the others
    revisit it; smaller payloads are responses all. A null payload is empty, a null url leaves the target out, a null id
    counts as smaller than any other. Rows that share the largest id are responses all, since none can refer to itself;
    identical rows give one record each, with the same record id. An empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    if "://" not in folder and folder.startswith("file:"):
        folder = "file://" + folder.removeprefix("file:")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(payload_col).alias("payload"),
        F.xxhash64(F.coalesce(F.col(url_col), F.lit("")), F.coalesce(F.col(payload_col), F.lit(""))).alias("x"),
    ).withColumn("row", F.monotonically_increasing_id())
    chunks = chunk_table(rows, "payload", chunk_bytes, "page_id", "x", "row", "url")
    sums = chunks.select("page_id", "x", "chunk_no", "n_chunks", "data").mapInArrow(
        digests, "page_id long, x long, payload_bytes long, payload_digest string")
    sums = written(sums, "warc-digests").distinct()

    alike = ["payload_digest", "payload_bytes"]
    leaders = sums.filter(F.col("payload_bytes") >= min_bytes).groupBy(*alike).agg(
        F.max(F.struct("page_id", "x")).alias("leader"), F.count("*").alias("records")).filter("records > 1")
    decided = sums.join(leaders, alike, "left")
    first = F.col("leader").isNull() | F.col("page_id").eqNullSafe(F.col("leader.page_id"))
    refers = F.when(~first, F.col("leader"))
    decided = decided.select(
        "page_id", "x", F.lit(-1).cast("long").alias("row"), F.lit(None).cast("string").alias("url"),
        F.lit(-1).cast("long").alias("chunk_no"), F.lit(0).cast("long").alias("n_chunks"), F.lit(None).cast("binary").alias("data"),
        *alike, F.when(first, F.lit("response")).otherwise(F.lit("revisit")).alias("record_type"),
        refers["page_id"].alias("refers_to"), refers["x"].alias("refers_x"))
    ordered = decided.unionByName(chunks, allowMissingColumns=True)
    ordered = ordered.repartition("page_id", "x").sortWithinPartitions("page_id", "x", "row", "chunk_no")
    manifest = ordered.mapInArrow(write_records(folder, archive_bytes, level, date), "path string, records long, bytes long")
    return written(manifest, "warc-manifest")


def records_of(stream: io.BufferedIOBase, chunk_bytes: int) -> Iterator[tuple[dict, int, bytes, int, str, bool]]:
    """Chunks of all records of an archive: header fields, number, bytes, running length and digest, whether it is the last."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(":")
            fields[name.lower()] = value.strip()
        left = int(fields["content-length"])
        while (line := stream.readline()) not in (b"\r\n", b""):  # the HTTP header
            left -= len(line)
            if line.lower().startswith(b"content-length:"):
                fields["payload-length"] = line.split(b":")[1].strip().decode()
        left -= len(line)
        state, size, number = hashlib.sha1(), 0, 0
        while True:
            data = stream.read(min(left, chunk_bytes))
            if len(data) < min(left, chunk_bytes):
                raise ValueError(f"record {fields['warc-record-id']} is cut off")
            left -= len(data)
            size += len(data)
            state.update(data)
            yield fields, number, data, size, base32(state.digest()), left == 0
            number += 1
            if left == 0:
                break


def read_chunks(manifest: DataFrame, chunk_bytes: int = 1 << 20, with_data: bool = True) -> DataFrame:
    """The chunk table of the archives of a manifest; ``data`` is null unless ``with_data``.

    ``bytes_so_far`` and ``digest_so_far`` cover a record's chunks up to the row. A response whose bytes do not give the
    digest and length in its header stops the read. A revisit has one empty chunk. Every archive is a unit of work: the rows
    of the manifest are counted, and dealt to as many tasks, ``TASKS`` at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for batch in batches for p in batch.column("path").to_pylist()):
            system, name = fs.FileSystem.from_uri(path)
            rows, held = [], 0
            with system.open_input_stream(name, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                for fields, number, data, size, digest, last in records_of(io.BufferedReader(stream, 1 << 18), chunk_bytes):
                    kind, length = fields["warc-type"], int(fields["payload-length"])
                    stated = fields["warc-payload-digest"].removeprefix("sha1:")
                    if last and kind == "response" and (digest, size) != (stated, length):
                        raise ValueError(f"record {fields['warc-record-id']} does not match its digest")
                    refers = fields.get("warc-refers-to")
                    rows.append((page_of(fields["warc-record-id"]), fields.get("warc-target-uri"), kind,
                                 page_of(refers) if refers else None, number, data if with_data else None, size, digest,
                                 length, stated, last))
                    held += len(data) if with_data else 200
                    if held >= 1 << 22:
                        yield batch_of(rows)
                        rows, held = [], 0
            if rows:
                yield batch_of(rows)

    # By number: partitions dealt by column alone are tiny in bytes and would be merged to a single task.
    tasks = max(1, min(manifest.count(), TASKS))
    return manifest.select("path").repartitionByRange(tasks, "path").mapInArrow(run, CHUNKS)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    names, kinds = zip(*(field.split() for field in CHUNKS.split(", ")))
    return pa.record_batch([pa.array(c, types[k]) for c, k in zip(zip(*rows), kinds)], names=list(names))
