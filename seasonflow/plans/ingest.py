"""Ingestion patterns bound to the events table: schema drift, merge upsert,
nested payload round trip, streaming incremental ingest, ledgers, rejects
(S05, S06, S08, S09, S12, S15, S17, X01)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonflow.functions import exprs as X
from seasonflow.operators import quality
from seasonflow.session import shared_path
from seasonflow.sources.loads import evolve_schema, merge_upsert
from seasonflow.sources.readers import table_path
from seasonflow.sources.tables import Table
from seasonflow.sources.shaping import flatten_structs, nested_to_json, parse_json
from seasonflow.streaming.incremental import incremental_ingest as run_incremental
from seasonflow.streaming.incremental import read_current
from seasonflow.plans import latest as _latest  # noqa: F401  registers the oracle reused below
from seasonflow.plans.registry import ORACLE, register, sql
from seasonflow.plans.testbed import Bed

SPLIT = dt.datetime(2024, 1, 15)   # the feed gained a column from this load on


def union_schema_drift(spark: SparkSession, root: str) -> DataFrame:
    """Loads before the split lack ``k``; later loads carry it.  Union by
    name, the missing column NULL-filled."""
    e = Bed(spark, root).t("events", "event_id", "ts", "user_id", "event_type", "value", "props")
    base = ["event_id", "ts", "user_id", "event_type", "value"]
    early = e.filter(F.col("ts") < X.ntz(SPLIT)).select(*base)
    late = (e.filter(F.col("ts") >= X.ntz(SPLIT))
              .select(*base, F.get_json_object("props", "$.k").try_cast("int").alias("k")))
    return evolve_schema(early, late)


register("union_schema_drift", sql(f"""
SELECT event_id, ts, user_id, event_type, value,
       CASE WHEN ts >= TIMESTAMP '{SPLIT:%Y-%m-%d %H:%M:%S}' THEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k
FROM events
"""))(union_schema_drift)


def merge_upsert_q(spark: SparkSession, root: str) -> DataFrame:
    """target = loads before day 20; delta = re-extraction from day 15 with
    corrected values (x 2, two decimals) -> updated keys replaced, new keys inserted."""
    e = Bed(spark, root).t("events", "event_id", "ts", "user_id", "event_type", "value")
    target = e.filter(F.col("ts") < X.ntz(dt.datetime(2024, 1, 20)))
    delta = (e.filter(F.col("ts") >= X.ntz(SPLIT))
               .withColumn("value", (F.col("value").cast("decimal(18,2)") * 2).cast("double")))
    return merge_upsert(target, delta, ["event_id"], [F.col("ts").desc()])


register("merge_upsert", sql(f"""
SELECT event_id, ts, user_id, event_type,
       CASE WHEN ts >= TIMESTAMP '{SPLIT:%Y-%m-%d %H:%M:%S}' THEN CAST(CAST(value AS DECIMAL(18,2)) * 2 AS DOUBLE)
            ELSE value END AS value
FROM events
"""))(merge_upsert_q)


PAYLOAD = T.StructType([
    T.StructField("event", T.StructType([T.StructField("id", T.LongType()), T.StructField("type", T.StringType())])),
    T.StructField("details", T.StructType([T.StructField("value", T.DoubleType()),
                                           T.StructField("k", T.IntegerType())])),
])


def flatten_nested(spark: SparkSession, root: str) -> DataFrame:
    """S12 -> S03 -> S17: a nested payload per event is landed as JSON text, parsed
    back with an explicit schema and flattened to upper-case joined names."""
    p = Bed(spark, root).plays()
    nested = p.select(F.struct(F.struct(F.col("play_id").alias("id"), F.col("type").alias("type")).alias("event"),
                               F.struct("value", "k").alias("details")).alias("payload"))
    landed = nested_to_json(nested)
    parsed = landed.select(parse_json("payload", PAYLOAD).alias("p")).select("p.*")
    return flatten_structs(parsed, upper=True)


register("flatten_nested", sql("""
SELECT play_id AS EVENT_ID, type AS EVENT_TYPE, value AS DETAILS_VALUE, k AS DETAILS_K FROM plays
"""))(flatten_nested)


EVENT_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                             T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                             T.StructField("value", T.DoubleType())])


def incremental_ingest(spark: SparkSession, root: str) -> DataFrame:
    """The events drop folder streamed with ``trigger(availableNow)``; each
    micro-batch keeps the latest event per user and upserts it into a key-indexed
    table under the shared checkpoint folder.  Equals the batch latest-wins."""
    base = shared_path(spark, "incremental-events")
    # the file source watches folders; a one-file glob points it at the drop
    drop = table_path(root, "events").replace("events.parquet", "event[s].parquet")
    last = run_incremental(spark, drop, EVENT_SCHEMA, f"{base}/table", f"{base}/_checkpoint",
                           ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return read_current(spark, f"{base}/table", EVENT_SCHEMA, last)


register("incremental_ingest", ORACLE["dedup_latest"])(incremental_ingest)


def upsert_indexed(spark: SparkSession, root: str) -> DataFrame:
    """S09 on a keyed table: the loads before day 20 are published, the re-extraction from
    day 15 rewrites only files that hold its keys; the same batch again changes nothing."""
    e = Bed(spark, root).t("events", "event_id", "ts", "user_id", "event_type", "value")
    table = Table(spark, shared_path(spark, "upsert"), keys=["event_id"])
    table.replace(e.filter(F.col("ts") < X.ntz(dt.datetime(2024, 1, 20))))
    delta = (e.filter(F.col("ts") >= X.ntz(SPLIT))
               .withColumn("value", (F.col("value").cast("decimal(18,2)") * 2).cast("double")))
    for _ in range(2):
        table.upsert(delta, [F.col("ts").desc(), F.col("value").desc()], batch_id="re-extraction")
    return table.read()


register("upsert_indexed", ORACLE["merge_upsert"])(upsert_indexed)


def append_once(spark: SparkSession, root: str) -> DataFrame:
    """Two halves of the feed, each appended twice; the ledger lets each in once."""
    e = Bed(spark, root).t("events", "event_id", "ts", "user_id", "event_type", "value")
    table = Table(spark, shared_path(spark, "append"))
    for half in (e.filter(F.col("ts") < X.ntz(SPLIT)), e.filter(F.col("ts") >= X.ntz(SPLIT))):
        table.append(half)
        table.append(half)
    return table.read()


register("append_once", "SELECT event_id, ts, user_id, event_type, value FROM events")(append_once)


def slice_resume(spark: SparkSession, root: str) -> DataFrame:
    """All days but a lost one are in the ledger; the next load brings that day alone."""
    e = Bed(spark, root).t("events", "event_id", "ts", "event_type")
    low, high = e.agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    table = Table(spark, shared_path(spark, "slices"))
    if low is not None:
        table.load_slices(e, "ts", low, high)
        table.drop_slice(low)
        assert table.load_slices(e, "ts", low, high) == [low]
    else:
        table.replace(e.withColumn("slice_date", F.col("ts").cast("date")))
    return table.read().groupBy("slice_date", "event_type").agg(F.count(F.lit(1)).alias("events"), F.min("event_id").alias("first_id"))


register("slice_resume", """
SELECT CAST(ts AS DATE) AS slice_date, event_type, count(*) AS events, min(event_id) AS first_id
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""")(slice_resume)


def violating_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows that break a rule, with the rules' names, kept by the pass that
    writes the good ones."""
    li = Bed(spark, root).t("lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")
    rules = [("range", (F.col("l_quantity") < 2) | (F.col("l_quantity") > 48)), ("accepted_values", ~F.col("l_returnflag").isin("A", "N")),
             ("returned_at_a_discount", (F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.08))]
    out = quality.split(li, rules, shared_path(spark, "split"))
    return out.violations.select("l_orderkey", "l_linenumber", F.array_join("broken", ",").alias("broken"))


register("violating_rows", """
SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN l_quantity < 2 OR l_quantity > 48 THEN 'range' END,
       CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'accepted_values' END,
       CASE WHEN l_returnflag = 'R' AND l_discount >= 0.08 THEN 'returned_at_a_discount' END) AS broken
FROM lineitem WHERE l_quantity < 2 OR l_quantity > 48 OR l_returnflag NOT IN ('A', 'N') OR (l_returnflag = 'R' AND l_discount >= 0.08)
""")(violating_rows)
