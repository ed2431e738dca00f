"""X01 — incremental ingest of file drops with latest-wins upsert.

The reference appends every re-extraction and lets the latest load per key
win.  The streaming form: ``readStream`` over the landing folder and one
``foreachBatch`` per micro-batch that keeps the latest row per key of the batch
and the stored rows together, so late rows of an older state change nothing.  ``dropDuplicates`` is
deliberately not used: it keeps the *first* row seen, the model needs the
*latest*.

Three table layouts:

* indexed (default): a ``sources.tables.Table`` with a key index.  A batch reads and
  rewrites only the files that hold one of its keys, and commits its id with them, so a
  replayed batch is not merged again and a reader never sees half of one.
* bucketed (a number of buckets): the table is partitioned by ``pmod(hash(keys), B)``; a
  batch reads the buckets it touches and replaces them with dynamic partition
  overwrite.  A batch of n keys touches up to min(n, B) buckets, so B should be well
  above the keys of a batch; a task lost while the overwrite is committed can leave
  a bucket behind, which a replay puts right only if its rows come again.
* versioned (``buckets=None``): batch N reads version N-1 and writes version
  ``v=N`` whole — simple and idempotent, O(table) per batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonflow.operators.dedup import dedup_latest
from seasonflow.session import path_exists
from seasonflow.sources.tables import Table

INDEXED = "indexed"


def latest_of_both(stored: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The latest row per key of stored rows and batch together: a late row that is
    older than the stored one does not replace it.  ``order_by`` must decide ties."""
    return dedup_latest(stored.unionByName(batch), keys, order_by)


def _version_path(target: str, batch_id: int) -> str:
    return f"{target.rstrip('/')}/v={batch_id}"


def upsert_batch_writer(target: str, schema: T.StructType, keys: Sequence[str],
                        order_by: Sequence[Column]):
    """foreachBatch function: latest-wins within the batch, merged into v=N-1."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # batch 0 starts from an empty table; later batches must find v=N-1
        # (a missing version is an error, never silently treated as empty)
        prev = (spark.read.schema(schema).parquet(_version_path(target, batch_id - 1))
                if batch_id > 0 else spark.createDataFrame([], schema))
        merged = latest_of_both(prev, batch.select(*schema.fieldNames()), keys, order_by)
        merged.write.mode("overwrite").parquet(_version_path(target, batch_id))
    return write


def _bucketed_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField("bucket", T.IntegerType(), True)])


def bucket_upsert_writer(target: str, schema: T.StructType, keys: Sequence[str],
                         order_by: Sequence[Column], buckets: int):
    """foreachBatch function for the bucketed layout."""
    from pyspark.sql.utils import AnalysisException
    full = _bucketed_schema(schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        b = batch.select(*schema.fieldNames()).withColumn(
            "bucket", F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int"))
        latest = dedup_latest(b, keys, order_by)
        touched = latest.select("bucket").distinct()          # at most ``buckets`` rows
        if path_exists(spark, target) is False:               # first batch: no table yet
            cur = spark.createDataFrame([], full)
        else:
            try:
                cur = spark.read.schema(full).parquet(target).join(F.broadcast(touched), "bucket", "left_semi")
            except AnalysisException:
                cur = spark.createDataFrame([], full)
        merged = latest_of_both(cur, latest, keys, order_by)
        (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("bucket").parquet(target))
    return write


def indexed_upsert_writer(target: str, schema: T.StructType, keys: Sequence[str], order_by: Sequence[Column]):
    """foreachBatch function for the indexed layout."""
    def write(batch: DataFrame, batch_id: int) -> None:
        Table(batch.sparkSession, target, keys).upsert(batch.select(*schema.fieldNames()), order_by, f"stream-{batch_id}")
    return write


def incremental_ingest(spark: SparkSession, source: str, schema: T.StructType, target: str,
                       checkpoint: str, keys: Sequence[str], order_by: Sequence[Column],
                       max_files_per_trigger: int | None = None,
                       buckets: int | str | None = INDEXED) -> int | None:
    """Process everything available now and return the last batch id (None if none ran)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = r.parquet(source)
    writer = (indexed_upsert_writer(target, schema, keys, order_by) if buckets == INDEXED
              else bucket_upsert_writer(target, schema, keys, order_by, buckets) if buckets
              else upsert_batch_writer(target, schema, keys, order_by))
    q = (stream.writeStream.foreachBatch(writer)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    last = None
    for p in q.recentProgress:
        bid = p.get("batchId") if isinstance(p, dict) else getattr(p, "batchId", None)
        rows = p.get("numInputRows") if isinstance(p, dict) else getattr(p, "numInputRows", 0)
        if bid is not None and rows:
            last = bid if last is None else max(last, bid)
    return last


def read_current(spark: SparkSession, target: str, schema: T.StructType, last_batch: int | None,
                 buckets: int | str | None = INDEXED) -> DataFrame:
    """The current table: the newest manifest's files, all buckets, or the last version."""
    from pyspark.sql.utils import AnalysisException
    if buckets == INDEXED:
        table = Table(spark, target)
        return table.read() if table.versions() else spark.createDataFrame([], schema)
    if buckets:
        if path_exists(spark, target) is False:
            return spark.createDataFrame([], schema)
        try:
            return spark.read.schema(_bucketed_schema(schema)).parquet(target).drop("bucket")
        except AnalysisException:
            return spark.createDataFrame([], schema)
    if last_batch is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_version_path(target, last_batch))
