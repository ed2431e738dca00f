"""Load modes, schema evolution, tolerant reads and upserts (S04–S11, S15) on plain folders
that any Parquet reader can read.

A full replace is written beside the table and swapped in; an append is done once for
each batch.  Both leave the old table where a write stops half-way.  A plain folder
cannot show a reader all of a load at one moment: ``tables.Table`` can, and has the ledgers
and the key index of the loads that need them.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from seasonflow.operators import quality
from seasonflow.operators.dedup import dedup_latest
from seasonflow.session import file_system
from seasonflow.sources.tables import content_id

LOADED_AT = "_loaded_at"


def stamp_load(df: DataFrame, ts: _dt.datetime) -> DataFrame:
    """Audit timestamp per batch — injected, never read from the wall clock."""
    return df.withColumn(LOADED_AT, F.lit(ts).cast("timestamp"))


def load_full_replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """S04 / S10 truncate: the table is replaced by this load.  The new files are written
    beside it and swapped in by two renames, so a write that stops leaves the old table;
    one that stops between the renames is put right by the next load."""
    fs, at = file_system(df.sparkSession, path)
    path = path.rstrip("/")
    fresh, old = at(f"{path}.__new"), at(f"{path}.__old")
    if not fs.exists(at(path)) and fs.exists(old):
        fs.rename(old, at(path))
    fs.delete(fresh, True)
    w = df.write
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{path}.__new")
    fs.delete(old, True)
    if fs.exists(at(path)):
        fs.rename(at(path), old)
    fs.rename(fresh, at(path))
    fs.delete(old, True)


def load_append(df: DataFrame, path: str, partition_by: Sequence[str] = (), batch_id: str | None = None) -> bool:
    """S05 / S10 append: create when missing, then append; whether the rows were added.

    A batch (known by ``batch_id``, else by its content) is added once: its files are
    staged, moved under names that begin with the batch, and then entered in the ledger
    ``_batches``.  A second call finds the entry; a call after one that stopped half-way
    removes that one's files first.  Duplicates across batches are resolved downstream
    by latest-wins dedup on the natural key."""
    fs, at = file_system(df.sparkSession, path)
    path, batch = path.rstrip("/"), batch_id or content_id(df)
    entry, staged = at(f"{path}/_batches/{batch}"), f"{path}/_staged-{batch}"
    if fs.exists(entry):
        return False
    fs.delete(at(staged), True)
    for f in _files(fs, at(path)):
        if f.getName().startswith(f"{batch}-"):
            fs.delete(f, False)
    w = df.write
    (w.partitionBy(*partition_by) if partition_by else w).parquet(staged)
    root = fs.makeQualified(at(staged)).toString()
    for f in _files(fs, at(staged)):
        if f.getName().endswith(".parquet"):
            folder = at(path + f.getParent().toString().removeprefix(root))
            fs.mkdirs(folder)
            fs.rename(f, at(f"{folder.toString()}/{batch}-{f.getName()}"))
    fs.mkdirs(entry.getParent())
    fs.create(entry).close()
    fs.delete(at(staged), True)
    return True


def _files(fs, folder) -> list:
    out = []
    if fs.exists(folder):
        it = fs.listFiles(folder, True)
        while it.hasNext():
            out.append(it.next().getPath())
    return out


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def evolve_schema(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; columns missing on either side are NULL-filled."""
    return old.unionByName(new, allowMissingColumns=True)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read files written with drifting schemas as one table."""
    return spark.read.option("mergeSchema", True).parquet(path)


def tolerant_json(spark: SparkSession, path: str, schema: T.StructType,
                  corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """Bad rows are set aside (ON_ERROR = CONTINUE).

    Returns (good rows, reject count as a one-row DataFrame).  Lines are read as
    text and parsed in the plan, so each result is one scan and nothing is cached.
    """
    parsed = _parsed(spark, path, schema, corrupt_col)
    good = parsed.filter(F.col(corrupt_col).isNull()).drop(corrupt_col)
    rejects = parsed.agg(F.count_if(F.col(corrupt_col).isNotNull()).alias("rejected_rows"))
    return good, rejects


def _parsed(spark: SparkSession, path: str, schema: T.StructType, corrupt_col: str) -> DataFrame:
    s = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType(), True)])
    return spark.read.text(path).where(F.trim("value") != "").select(
        F.from_json("value", s, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col}).alias("r")).select("r.*")


def load_tolerant(spark: SparkSession, path: str, schema: T.StructType, out: str, rules: Sequence = (),
                  corrupt_col: str = "_corrupt_record") -> quality.Split:
    """S08 with the rejects kept: one scan of the JSON lines writes good rows and rejected
    ones (unreadable text, or a broken rule of ``quality.split``) and counts both."""
    rows = _parsed(spark, path, schema, corrupt_col)
    readable = ("readable", F.col(corrupt_col).isNotNull())
    return quality.split(rows, [readable, *rules], out)


def merge_upsert(target: DataFrame, delta: DataFrame, keys: Sequence[str],
                 order_by: Sequence[Column] | None = None) -> DataFrame:
    """Update existing keys and insert new ones.

    The delta is first reduced to its latest row per key (W01) when ``order_by``
    is given; target rows whose key is in the delta are replaced.  Both sides
    are shuffled on the key once; AQE splits skewed keys.
    """
    d = dedup_latest(delta, keys, order_by) if order_by else delta
    kept = target.join(d.select(*keys), list(keys), "left_anti")
    return kept.unionByName(d, allowMissingColumns=True)


def date_partitioned_load(df: DataFrame, path: str, date_col: str, start: _dt.date,
                          end: _dt.date) -> DataFrame:
    """One slice per day from ``start`` to ``end`` inclusive, each record
    stamped with its slice date; dynamic partition overwrite replaces only the
    slices present, so re-running a day is idempotent."""
    sliced = (df.withColumn("slice_date", F.col(date_col).cast("date"))
                .filter(F.col("slice_date").between(F.lit(start), F.lit(end))))
    (sliced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("slice_date").parquet(path))
    return sliced


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], partitions: int | None = None) -> None:
    """Ordered table output without a global sort on one task — range
    partitioned on the keys, each partition sorted locally (files come out in
    key order, file by file)."""
    n = partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    (df.repartitionByRange(int(n), *keys).sortWithinPartitions(*keys)
       .write.mode("overwrite").parquet(path))
