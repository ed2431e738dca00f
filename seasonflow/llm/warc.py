"""WARC archives as a PySpark data source (format ``warc``), reader and writer.

Reading plans whole files into partitions, takes pushed predicates on record
headers, parses headers first, and neither inflates nor decodes the payload of a
record that the predicates rule out: each record is its own gzip member whose
header carries the member's compressed length (the ``sl`` field of the WARC
annex), so the reader steps over it.

A folder's manifest names the files of committed tasks.  Files of lost or
repeated tasks are in no manifest and so are never read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition,
                                    IsNotNull, IsNull, StringStartsWith, WriterCommitMessage)

from .common import filesystem, new_path, own_columns, prepare

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:x-page:"
GZIP_HEAD = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff"    # deflate, with an extra field

SCHEMA = ("page_id long, record_type string, target_uri string, payload_digest string, payload_bytes long, "
          "refers_to long, payload binary")
HEADER_COLUMNS = {"record_type", "target_uri", "payload_digest", "page_id", "refers_to"}
MANIFEST = "manifest.json"
BATCH_BYTES = 4 << 20


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(name: str, value: object) -> bytes:
    # a header value is one line: control characters are percent-encoded
    text = "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in str(value))
    return f"{name}: {text}\r\n".encode()


def record(page_id, url, payload: bytes, sha1_base32: str, refers_to) -> bytes:
    """One WARC record.  A revisit keeps the HTTP head, whose Content-Length is
    that of the full payload, and has no payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + _line("Content-Length", len(payload))
            + b"\r\n")
    block = http if refers_to is not None else http + payload
    name = "none" if page_id is None else page_id
    head = [VERSION + b"\r\n", _line("WARC-Type", "response" if refers_to is None else "revisit"),
            _line("WARC-Record-ID", f"<{ID_PREFIX}{name}>"), _line("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        head.append(_line("WARC-Target-URI", url))
    head.append(_line("WARC-Payload-Digest", f"sha1:{sha1_base32}"))
    if refers_to is not None:
        head += [_line("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>"), _line("WARC-Profile", REVISIT_PROFILE)]
    head += [_line("Content-Type", "application/http; msgtype=response"), _line("Content-Length", len(block)), b"\r\n"]
    return b"".join(head) + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member with its own compressed and plain length in its header."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    size = len(GZIP_HEAD) + 2 + 12 + len(body) + 8
    return (GZIP_HEAD + struct.pack("<H2sHII", 12, b"sl", 8, size, len(data)) + body
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


# -- writing -----------------------------------------------------------------------
class _Written(WriterCommitMessage):
    def __init__(self, files):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    """Rows: page_id, url, html, refers_to.  A task writes files of its own name,
    each up to ``fileBytes``; the driver's commit lists them in the manifest."""

    def __init__(self, options):
        self.path = options["path"]
        self.level = int(options.get("level", 4))
        self.limit = int(options.get("filebytes", 1 << 30))
        fs, path = filesystem(self.path)
        fs.create_dir(path, recursive=True)

    def write(self, iterator):
        fs, path = filesystem(self.path)
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                for page_id, url, html, refers in zip(*(batch.column(batch.schema.get_field_index(c))
                                                        for c in ("page_id", "url", "html", "refers_to")), strict=True):
                    payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                    data = member(record(page_id.as_py(), url.as_py(), payload, digest(payload), refers.as_py()), self.level)
                    if out is None or size + len(data) > self.limit:
                        if out is not None:
                            out.close()
                        files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = fs.open_output_stream(f"{path}/{files[-1]}", compression=None), 0
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return _Written(files)

    def commit(self, messages):
        fs, path = filesystem(self.path)
        files = sorted(f for m in messages if m is not None for f in m.files)
        with fs.open_output_stream(f"{path}/{MANIFEST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages):
        fs, path = filesystem(self.path)
        for m in messages:
            for f in m.files if m is not None else ():
                fs.delete_file(f"{path}/{f}")


# -- reading -----------------------------------------------------------------------
class _Files(InputPartition):
    def __init__(self, files):
        self.files = files


def _page_number(value: str | None):
    text = (value or "").strip("<>").removeprefix(ID_PREFIX)
    return int(text) if text.lstrip("-").isdigit() else None


class WarcReader(DataSourceReader):
    """Options: ``path``; ``payload`` is ``full`` (default), ``verify`` (payloads
    are read and checked against their digests, but not returned) or ``skip``;
    ``partitionBytes`` bounds the small files that share a partition."""

    def __init__(self, options):
        self.path, self.payload = options["path"], options.get("payload", "full")
        self.limit = int(options.get("partitionbytes", 32 << 20))
        self.tests = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADER_COLUMNS and isinstance(f, (EqualTo, In, IsNotNull, IsNull, StringStartsWith)):
                self.tests.append((type(f).__name__, name, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        fs, path = filesystem(self.path)
        with fs.open_input_stream(f"{path}/{MANIFEST}") as f:
            names = json.loads(f.read())
        plan, size = [[]], 0
        for name, info in zip(names, fs.get_file_info([f"{path}/{n}" for n in names]), strict=True):
            if plan[-1] and size + info.size > self.limit:
                plan.append([])
                size = 0
            plan[-1].append(name)
            size += info.size
        return [_Files(p) for p in plan if p] or [_Files([])]

    def wanted(self, row: dict) -> bool:
        for kind, name, value in self.tests:
            got = row[name]
            if kind == "IsNull" and got is not None or kind == "IsNotNull" and got is None:
                return False
            if kind == "EqualTo" and got != value or kind == "In" and got not in value:
                return False
            if kind == "StringStartsWith" and not (got or "").startswith(value):
                return False
        return True

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(self.path)
        rows, size = [], 0
        for name in partition.files:
            with fs.open_input_file(f"{path}/{name}") as f:
                for row in read_records(f, self.wanted, self.payload):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 200
                    if size > BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)


_ARROW = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("target_uri", pa.string()),
                    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
                    ("payload", pa.binary())])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def read_records(f, wanted, payload: str) -> Iterator[dict]:
    """Records of one open file.  Headers come from the first kilobytes of a
    member; the rest of an unwanted record is stepped over."""
    at, end = 0, f.size()
    while at < end:
        f.seek(at)
        start = f.read(2048)
        if start[:4] != GZIP_HEAD[:4]:
            raise ValueError(f"no WARC gzip member at {at}")
        extra, tag, _, size, _ = struct.unpack_from("<H2sHII", start, len(GZIP_HEAD))
        if tag != b"sl":
            raise ValueError("a member's length field is missing")
        body = len(GZIP_HEAD) + 2 + extra
        z = zlib.decompressobj(-15)
        taken = min(len(start), size)
        plain = z.decompress(start[body:taken])
        f.seek(at + taken)
        while b"\r\n\r\n" not in plain:
            more = f.read(min(2048, size - taken))
            if not more:
                raise ValueError(f"a record header at {at} does not end")
            taken += len(more)
            plain += z.decompress(more)
        head, _, tail = plain.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        row = {"page_id": _page_number(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"],
               "target_uri": fields.get("WARC-Target-URI"),
               "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
               "refers_to": _page_number(fields.get("WARC-Refers-To")), "payload": None, "payload_bytes": None}
        if wanted(row):
            # all that is left, or just up to the end of the HTTP head
            while taken < size and (payload != "skip" or b"\r\n\r\n" not in tail):
                more = f.read(min(2048, size - taken) if payload == "skip" else size - taken)
                taken += len(more)
                tail += z.decompress(more)
            http, _, content = tail.partition(b"\r\n\r\n")
            heads = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
            row["payload_bytes"] = int(heads["Content-Length"])
            if payload != "skip" and row["record_type"] == "response":
                content = content[:row["payload_bytes"]]
                if len(content) != row["payload_bytes"] or digest(content) != row["payload_digest"]:
                    raise ValueError(f"payload of page {row['page_id']} does not match its digest")
                row["payload"] = content if payload == "full" else None
            yield row
        at += size


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    prepare(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# -- pages to archives and back ------------------------------------------------------
def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to``.  Of rows with equal payloads of at least
    ``min_bytes`` bytes the smallest id is stored; ``refers_to`` of the others is
    that id.  Rows that share the smallest id are all stored.  Null html is an
    empty payload; rows without an id are stored themselves unless some row with
    an id has their payload.
    """
    own_columns(pages, id_col, url_col, html_col)
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    base = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        html.alias("html"))
    keys = base.where(F.octet_length("html") >= min_bytes).select("page_id", F.sha1("html").alias("sha"))
    stored = keys.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # narrow rows only: the pages themselves are joined once, by their own id
    again = (keys.join(stored, "sha").where(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))
             .select(F.col("page_id").alias("p"), F.col("sha").alias("s"), F.col("first").alias("refers_to")).distinct())
    marked = base.withColumn("sha", F.sha1("html"))
    return (marked.join(again, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha") == F.col("s")), "left")
            .select("page_id", "url", "html", "refers_to"))


def write_pages(pages: DataFrame, path: str | None = None, **how) -> str:
    """Writes pages as WARC files to a shared folder and returns its path."""
    spark = pages.sparkSession
    register(spark)
    path = path or new_path(spark, "warc")
    with_revisits(pages, **how).write.format("warc").mode("append").option("path", path).save()
    return path


def read_archive(spark: SparkSession, path: str, payload: str = "full") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("path", path).option("payload", payload).load()
