"""Helpers shared by the training-data operators.

Every operator cuts its lineage by writing narrow intermediate tables into the
shared folder that the cluster names in ``spark.checkpoint.dir``; executors may
be lost at any time, and a lost one then costs only the retry of its tasks.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words, and the word pattern.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

# Rows of a text table handed to a Python worker at once (whole texts; a long
# text is one row, so this bounds a batch to a few MB on ordinary documents).
ARROW_ROWS = 512
# Raw text bytes that the vectorised byte kernels work on at once.
KERNEL_BYTES = 1 << 20

_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(ARROW_ROWS),
    # shuffle files of a finished statement go at once, so the disk an operator
    # needs is that of its largest step and not the sum of all steps
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on (runtime SQL settings only)."""
    for k, v in _SETTINGS.items():
        spark.conf.set(k, v)
    _ship(spark)


def narrow_batches(spark: SparkSession, rows: int = 8192) -> None:
    """Larger Arrow batches, for statements that run now over rows of bounded
    size; the next operator's ``prepare`` sets the usual number again."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


_SHIPPED: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that Python
    workers can import it wherever the driver found it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="seasonflow-code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It is read from the session.  A local master without one gets a fresh
    temporary folder; a cluster without one is an error, because executors
    could not read each other's files.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="seasonflow-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that tasks read and write themselves."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


class Scratch:
    """Intermediate tables of one operator run; ``drop`` removes those that no
    later step reads any more."""

    def __init__(self, spark: SparkSession):
        prepare(spark)
        self.spark = spark
        self.paths: dict[int, str] = {}

    def save(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        path = new_path(self.spark, name)
        df.write.option("compression", compression).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        out._scratch = self          # keeps ids unique while the table is in use
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            path = self.paths.pop(id(t), None)
            if path:
                p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else.  ``lower`` does just that on pure ASCII
    text and is far cheaper than a character map, so the map is kept for text
    that holds other characters."""
    upper, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, upper, low))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, even where ``body``
    uses it inside a lambda (a plain column would be expanded there and computed
    again for every element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def key128(c: Column) -> list[Column]:
    """Two independently seeded 64-bit hashes: a 128-bit key of a string."""
    return [F.xxhash64(c).alias("k1"), F.xxhash64(F.lit(7919), c).alias("k2")]


def own_columns(df: DataFrame, *needed: str) -> None:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")


# -- Arrow / numpy ---------------------------------------------------------------
def text_slices(batches: Iterable[pa.RecordBatch], column: str,
                limit: int = KERNEL_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cuts batches into row slices of about ``limit`` text bytes (a longer text
    is a slice of its own) and yields ``(slice, bytes, offsets)``; null texts are
    empty.  ``bytes`` is one flat uint8 array, ``offsets`` has n + 1 entries."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.schema.get_field_index(column))
        size = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(size)
        at = 0
        while at < batch.num_rows:
            start = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, start + limit, "right")))
            part = batch.slice(at, to - at)
            yield part, *flat_text(part.column(part.schema.get_field_index(column)))
            at = to


def flat_text(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if text.null_count:
        text = pc.fill_null(text, "" if pa.types.is_string(text.type) or pa.types.is_large_string(text.type) else b"")
    wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
    offsets = np.frombuffer(text.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[text.offset:text.offset + len(text) + 1].astype(np.int64)
    data = text.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole 64-bit word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(seed: int) -> np.ndarray:
    """256 random odd 64-bit words, one for each byte value, made from ``seed``."""
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * seed)) | np.uint64(1)


def binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of a text column (one narrow aggregate)."""
    return int(df.agg(F.sum(F.octet_length(column).cast("long"))).first()[0] or 0)


def release() -> None:
    """Gives memory that a Python worker has freed back to the system: workers live
    on between tasks and stages, next to an executor of a fixed size."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


try:
    _TRIM = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):      # another C library
    _TRIM = None


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    prepare(df.sparkSession)

    def run(batches):
        yield from fn(batches)
        release()
    return df.mapInArrow(run, schema)


def per_group(fn):
    """A function of (key, table) for ``applyInArrow`` over groups of megabytes."""
    def run(key, table):
        out = fn(key, table)
        release()
        return out
    return run


def per_cogroup(fn):
    """The same for (key, left, right)."""
    def run(key, left, right):
        out = fn(key, left, right)
        release()
        return out
    return run


# -- words of many texts at once -------------------------------------------------------
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTES = byte_table(1)
_powers: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, KERNEL_BYTES)
        for k, x in enumerate((_BASE, _BASE_INVERSE)):
            p = np.full(size, x, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def hash_words(flat: np.ndarray, offsets: np.ndarray, lower: bool = False):
    """Words (runs without the fixed white space) of the texts in ``flat``:
    ``(text index, start, 64-bit hash)`` in order.  ``lower`` maps A-Z to a-z.
    The hash is a polynomial over random words for the bytes, mixed with the
    word's length."""
    n = len(flat)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    space = (flat == 32) | ((flat >= 9) & (flat <= 13))
    begin = np.zeros(n + 1, bool)
    begin[offsets[:-1]] = True
    after = np.r_[True, space] | begin
    starts = np.flatnonzero(~space & after[:n])
    closes = np.r_[space, True] | begin
    ends = np.flatnonzero(~space & closes[1:]) + 1
    if lower:
        flat = np.where((flat >= 65) & (flat <= 90), flat + np.uint8(32), flat)
    up, down = powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[flat] * up, out=total[1:])
    h = mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return np.searchsorted(offsets, starts, "right") - 1, starts, h
