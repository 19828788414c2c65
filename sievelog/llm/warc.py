"""WARC archives as a PySpark Python data source.

``spark.dataSource.register(WarcSource)``, then ``spark.read.format("warc").load(folder)`` and
``df.write.format("warc").save(folder)``. A reader plans one partition per file (several for a file over ``splitBytes``,
cut where a record begins), pushes equality and IN predicates on record type and header columns down, reads a record's
headers first and skips its block by its length unless the record is wanted and its payload asked for.

Folders are found by scheme: local paths and file:// by the operating system, others by pyarrow's file systems.
"""

from __future__ import annotations

import gzip
import io
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from .common import Scratch

SCHEMA = "record_type string, record_id string, target_uri string, date string, payload_digest string, refers_to string, page_id string, content_type string, content_length long, payload binary"
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To", "page_id": "X-Page-ID", "content_type": "Content-Type",
}
VERSION = b"WARC/1.1"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    scheme = urlparse(path).scheme
    if scheme in ("", "file"):
        return pafs.LocalFileSystem(), urlparse(path).path if scheme else path
    return pafs.FileSystem.from_uri(path)


def clean(value: object) -> str:
    """A header's value on one line: control characters percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(value))


def record(headers: dict[str, object], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {clean(v)}".encode("utf-8", "surrogatepass") for k, v in headers.items() if v is not None), f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def http_block(payload: bytes) -> bytes:
    """An HTTP response whose body is the payload in gzip."""
    body = gzip.compress(payload, 1, mtime=0)
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Encoding: gzip\r\nContent-Length: %d\r\n\r\n" % len(body) + body


def payload_of(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    if not head.startswith(b"HTTP/"):
        return block
    fields = dict(x.lower().split(b":", 1) for x in head.split(b"\r\n")[1:] if b":" in x)
    return gzip.decompress(body) if fields.get(b"content-encoding", b"").strip() == b"gzip" else body


def read_headers(f) -> dict[str, str] | None:
    """Headers of the record at the file's position, by lower-case name; None at its end. Blank lines are passed over."""
    line = f.readline()
    while line in (b"\r\n", b"\n"):
        line = f.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record begins with {line[:40]!r}")
    out, last = {}, ""
    while (line := f.readline()).strip():
        text = line.rstrip(b"\r\n").decode("utf-8", "surrogatepass")
        if text[0] in " \t" and last:
            out[last] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        last = name.strip().lower()
        out[last] = value.strip()
    return out


@dataclass
class Piece(InputPartition):
    path: str
    start: int
    end: int


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.names = [f.name for f in schema.fields]
        self.types = schema
        self.path = options["path"]
        self.split = int(options.get("splitBytes", 128 << 20))
        self.payload = options.get("payload", "true").lower() != "false"
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column in HEADERS:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, path = file_system(self.path)
        info = fs.get_file_info(path)
        found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(path, recursive=True))
        files = sorted((x for x in found if x.is_file and not os.path.basename(x.path).startswith(("_", "."))), key=lambda x: x.path)
        cut = lambda x: max(1, -(-x.size // self.split)) if not x.path.endswith(".gz") else 1
        return [Piece(x.path, i * self.split, (i + 1) * self.split if i + 1 < cut(x) else 1 << 62) for x in files for i in range(cut(x))]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        rows: list[tuple] = []
        size = 0
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.types)
        as_batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
        with fs.open_input_file(partition.path) as raw:
            f = gzip.GzipFile(fileobj=raw) if partition.path.endswith(".gz") else io.BufferedReader(raw, 1 << 20)
            if partition.start:
                self._to_record(f, partition.start)
            while f.tell() < partition.end and (head := read_headers(f)) is not None:
                length = int(head["content-length"])
                row = {c: head.get(h.lower()) for c, h in HEADERS.items()}
                if any(row[c] not in values for c, values in self.wanted.items()):
                    f.seek(length, 1)
                    continue
                row["content_length"] = length
                if self.payload and "payload" in self.names:
                    row["payload"] = payload_of(f.read(length))
                    size += len(row["payload"])
                else:
                    f.seek(length, 1)
                rows.append(tuple(row.get(n) for n in self.names))
                if len(rows) >= 1000 or size > 8 << 20:
                    yield as_batch()
                    rows, size = [], 0
        if rows:
            yield as_batch()

    @staticmethod
    def _to_record(f, start: int) -> None:
        """Go to the first record that begins at or after ``start``: every block before it is passed by its length, so
        bytes of a block that look like a record don't count."""
        f.seek(0)
        while f.tell() < start and (head := read_headers(f)) is not None:
            f.seek(int(head["content-length"]) + 4, 1)


@dataclass
class Written(WriterCommitMessage):
    name: str


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite):
        self.path = options["path"]
        self.job = uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        fs, path = file_system(self.path)
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{self.job}.warc"
        waiting = f"{path}/_waiting-{task.taskAttemptId()}-{name}"
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(waiting) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    payload = row.pop("payload", None)
                    row.pop("content_length", None)
                    out.write(record({HEADERS[k]: v for k, v in row.items() if k in HEADERS}, b"" if payload is None else http_block(payload)))
        return Written(f"{waiting}\n{path}/{name}")

    def commit(self, messages: list[Written | None]) -> None:
        fs, path = file_system(self.path)
        fs.create_dir(path, recursive=True)
        for m in messages:
            if m is not None:
                fs.move(*m.name.split("\n"))
        with fs.open_output_stream(f"{path}/_SUCCESS"):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        fs, _ = file_system(self.path)
        for m in messages:
            if m is not None:
                fs.delete_file(m.name.split("\n")[0])


class WarcSource(DataSource):
    """Options: path, splitBytes (for reading), payload (false: never read blocks)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def page_records(pages: DataFrame, least: int = 100) -> DataFrame:
    """Records of ``pages`` (page_id, url, html) in the source's schema: of equal payloads of at least ``least`` bytes that
    with the smallest page_id is a response and the others are revisits of it; all other payloads are responses.

    A null html is empty. Null page_ids count as larger than any; where all of a group are null, all are responses. Rows
    that repeat the smallest page_id with one payload are responses each, with one record id.
    """
    scratch = Scratch(pages.sparkSession, "warc-plan")
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("page_id").alias("id"), F.col("url").cast("string").alias("target_uri"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    groups = rows.filter(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = rows.join(scratch.save(groups, "groups"), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.concat(F.lit("none-"), F.col("digest"))), F.lit(">"))
    return rows.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), name(F.col("id")).alias("record_id"), "target_uri", F.lit("2024-01-01T00:00:00Z").alias("date"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"), F.when(again, name(F.col("first"))).alias("refers_to"), "page_id",
        F.when(again, "message/http").otherwise("application/http; msgtype=response").alias("content_type"), F.when(~again, F.col("payload")).alias("payload"),
    )


def archive_round_trip(pages: DataFrame, least: int = 100) -> DataFrame:
    """Write ``pages`` to archives and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Responses are read with their payloads, from which bytes and digest are computed; revisits are read by their headers
    alone and take both from the response that they refer to.
    """
    spark = pages.sparkSession
    register(spark)
    scratch = Scratch(spark, "warc")
    folder = f"{scratch.base}/archive"
    page_records(pages, least).write.format("warc").mode("append").save(folder)
    read = spark.read.format("warc").load(folder)
    kind = pages.schema["page_id"].dataType.simpleString()
    responses = read.filter("record_type = 'response'").select("record_id", "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("string").alias("refers_to"))
    responses = scratch.save(responses, "responses")
    revisits = spark.read.format("warc").option("payload", "false").load(folder).filter("record_type = 'revisit'").select("page_id", "refers_to", "record_type")
    revisits = scratch.save(revisits, "revisits")
    named = scratch.save(responses.join(revisits.select(F.col("refers_to").alias("record_id")).distinct(), "record_id", "left_semi").groupBy("record_id").agg(F.first("page_id").alias("target"), F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest")), "named")
    later = revisits.join(named.withColumnRenamed("record_id", "refers_to"), "refers_to").select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("target").alias("refers_to"))
    out = responses.drop("record_id").unionByName(later)
    return out.withColumns({"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)}).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
