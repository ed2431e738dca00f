"""Latest-wins family (W01–W04, W15, A07, T04, T05; M01–M10 staging dedup,
M54 team form, C06, C08)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.functions import exprs as X
from seasonflow.operators import dedup as D
from seasonflow.operators import ranking as R
from seasonflow.plans.registry import register, sql
from seasonflow.plans.testbed import Bed

CARD_ROWS = 2000      # fixed value: rows the standings card shows

def dedup_latest(spark: SparkSession, root: str) -> DataFrame:
    """One row per user — the latest event (ts desc, event id desc)."""
    e = Bed(spark, root).t("events", "event_id", "ts", "user_id", "event_type", "value")
    return D.dedup_latest(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])


register("dedup_latest", sql("""
SELECT event_id, ts, user_id, event_type, value FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events f WHERE f.user_id = e.user_id
                  AND (f.ts > e.ts OR (f.ts = e.ts AND f.event_id > e.event_id)))
"""))(dedup_latest)


def dedup_latest_tiebreak(spark: SparkSession, root: str) -> DataFrame:
    """Per (supplier, ship day) the top line by price, then order and line
    number and part (secondary keys make the order total)."""
    li = Bed(spark, root).t("lineitem", "l_suppkey", "l_shipdate", "l_extendedprice", "l_orderkey",
                            "l_linenumber", "l_partkey")
    li = li.withColumn("ship_date", F.col("l_shipdate").cast("date")).drop("l_shipdate")
    return D.dedup_latest(li, ["l_suppkey", "ship_date"],
                          [F.col("l_extendedprice").desc(), F.col("l_orderkey").desc(),
                           F.col("l_linenumber").desc(), F.col("l_partkey").desc()])


register("dedup_latest_tiebreak", sql("""
, r AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS ship_date, l_extendedprice, l_orderkey, l_linenumber,
               l_partkey,
               row_number() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
                                  ORDER BY l_extendedprice DESC, l_orderkey DESC, l_linenumber DESC,
                                           l_partkey DESC) AS rn
        FROM lineitem)
SELECT l_suppkey, l_extendedprice, l_orderkey, l_linenumber, l_partkey, ship_date FROM r WHERE rn = 1
"""))(dedup_latest_tiebreak)


def dedup_preference(spark: SparkSession, root: str) -> DataFrame:
    """One customer per nation, preferring segment BUILDING, then by name."""
    c = Bed(spark, root).t("customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return D.dedup_preference(c, ["c_nationkey"], F.col("c_mktsegment") == "BUILDING",
                              [F.col("c_name"), F.col("c_custkey")])


register("dedup_preference", sql("""
SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey
            ORDER BY CAST(c_mktsegment = 'BUILDING' AS INTEGER) DESC, c_name, c_custkey) AS rn
  FROM customer) WHERE rn = 1
"""))(dedup_preference)


def latest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The latest daily snapshot per (season, player) plus form text."""
    s = Bed(spark, root).snapshots()
    top = D.dedup_latest(s, ["season", "player"], [F.col("play_date").desc()])
    return top.select("season", "player", F.col("play_date").alias("as_of_date"), "cum_n", "cum_value",
                      F.concat(F.col("cum_n").cast("string"), F.lit(" buys")).alias("form_text"))


register("latest_snapshot", sql("""
SELECT s.season, s.player, s.play_date AS as_of_date, cum_n, cum_value,
       CAST(cum_n AS VARCHAR) || ' buys' AS form_text
FROM snapshots s
WHERE s.play_date = (SELECT max(t.play_date) FROM snapshots t WHERE t.season = s.season AND t.player = s.player)
"""))(latest_snapshot)


def latest_attributes(spark: SparkSession, root: str) -> DataFrame:
    """Value at the latest / earliest (date, key) per customer via max_by/min_by."""
    o = Bed(spark, root).t("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
                           "o_orderstatus")
    order = F.struct(F.col("o_orderdate"), F.col("o_orderkey"))
    return o.groupBy("o_custkey").agg(
        F.max_by("o_orderpriority", order).alias("latest_priority"),
        F.min_by("o_orderstatus", order).alias("first_status"),
        F.max("o_orderdate").cast("date").alias("last_order_date"),
        F.count(F.lit(1)).alias("orders"))


register("latest_attributes", sql("""
, r AS (SELECT o_custkey, o_orderpriority, o_orderstatus, o_orderdate,
          row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rd,
          row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC, o_orderkey ASC) AS ra,
          count(*) OVER (PARTITION BY o_custkey) AS n
        FROM orders)
SELECT o_custkey, max(CASE WHEN rd = 1 THEN o_orderpriority END) AS latest_priority,
       max(CASE WHEN ra = 1 THEN o_orderstatus END) AS first_status,
       CAST(max(o_orderdate) AS DATE) AS last_order_date, max(n) AS orders
FROM r GROUP BY o_custkey
"""))(latest_attributes)


def latest_date_rows(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the latest date (ties kept), mixed-direction sort."""
    o = Bed(spark, root).t("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    o = o.withColumn("order_date", F.col("o_orderdate").cast("date")).drop("o_orderdate")
    top = D.latest_rows_per_group(o, [], "order_date")
    return top.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc())


register("latest_date_rows", sql("""
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)
ORDER BY o_totalprice DESC, o_orderkey
"""))(latest_date_rows)


def limited_series(spark: SparkSession, root: str) -> DataFrame:
    """The newest snapshot rows up to the card's own limit, then
    re-sorted oldest first."""
    s = Bed(spark, root).snapshots()
    return R.top_k(s, CARD_ROWS, [F.col("play_date").desc(), F.col("player").asc()]).orderBy("play_date", "player")


register("limited_series", sql(f"""
SELECT * FROM (SELECT * FROM snapshots ORDER BY play_date DESC, player ASC LIMIT {CARD_ROWS}) ORDER BY play_date, player
"""))(limited_series)


def staged_dedup_keyed(spark: SparkSession, root: str) -> DataFrame:
    """M01–M10 shape: typed rename projection + latest-wins per natural key, with
    a composite surrogate key over the grain (orders re-extracted per day)."""
    o = Bed(spark, root).t("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    staged = o.select(F.col("o_custkey").alias("customer_id"),
                      F.col("o_orderdate").cast("date").alias("load_date"),
                      F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))
    top = D.dedup_latest(staged, ["customer_id"], [F.col("load_date").desc(), F.col("order_id").desc()])
    return top.withColumn("row_key", X.surrogate_key("customer_id", "load_date"))


register("staged_dedup", sql("""
SELECT customer_id, load_date, order_id, status,
       md5(CAST(customer_id AS VARCHAR) || '-' || CAST(load_date AS VARCHAR)) AS row_key
FROM (SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS load_date, o_orderkey AS order_id,
             o_orderstatus AS status,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1
"""))(staged_dedup_keyed)
