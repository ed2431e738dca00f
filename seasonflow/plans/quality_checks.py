"""Data-quality checks bound to the test tables (Q01–Q08).  Each returns the
violation groups as a DataFrame (never collected)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.operators import quality as Q
from seasonflow.plans.registry import register, rr, sql
from seasonflow.plans.testbed import Bed

FRESHNESS_AS_OF = dt.datetime(2024, 2, 1)   # job parameter: "now" for the freshness check


def _winners(bed: Bed) -> DataFrame:
    g = bed.universe()
    return g.select("game_id", F.when(g.home_score > g.away_score, g.home_team)
                    .when(g.home_score < g.away_score, g.away_team).alias("winner"))


def dq_not_null(spark: SparkSession, root: str) -> DataFrame:
    """Q01 over several targets; the game winner is NULL on level scores."""
    bed = Bed(spark, root)
    checks = [Q.not_null(bed.t("lineitem", "l_suppkey"), "l_suppkey"),
              Q.not_null(bed.t("orders", "o_custkey"), "o_custkey"),
              Q.not_null(_winners(bed), "winner", severity=Q.WARN)]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


register("dq_not_null", sql("""
SELECT * FROM (
  SELECT 'not_null' AS "check", 'l_suppkey' AS target, 'error' AS severity, count_if(l_suppkey IS NULL) AS violations FROM lineitem
  UNION ALL SELECT 'not_null', 'o_custkey', 'error', count_if(o_custkey IS NULL) FROM orders
  UNION ALL SELECT 'not_null', 'winner', 'warn', count_if(home_score = away_score) FROM universe)
WHERE violations > 0
"""))(dq_not_null)


def dq_unique(spark: SparkSession, root: str) -> DataFrame:
    """Q02: duplicated part names with their multiplicity."""
    return Q.unique(Bed(spark, root).t("part", "p_name"), ["p_name"])


register("dq_unique", sql("""
SELECT 'unique' AS "check", 'p_name' AS target, 'error' AS severity, p_name, count(*) AS violations
FROM part GROUP BY p_name HAVING count(*) > 1
"""))(dq_unique)


def dq_unique_combo(spark: SparkSession, root: str) -> DataFrame:
    """Q03: the (order, line number) grain is not unique in the test data."""
    return Q.unique(Bed(spark, root).t("lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


register("dq_unique_combo", sql("""
SELECT 'unique_combination' AS "check", 'l_orderkey,l_linenumber' AS target, 'error' AS severity,
       l_orderkey, l_linenumber, count(*) AS violations
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""))(dq_unique_combo)


def dq_relationships(spark: SparkSession, root: str) -> DataFrame:
    """Q04: orders whose key has no line (orphans per key)."""
    bed = Bed(spark, root)
    return Q.relationships(bed.t("orders", "o_orderkey"), "o_orderkey", bed.t("lineitem", "l_orderkey"), "l_orderkey")


register("dq_relationships", sql("""
SELECT 'relationships' AS "check", 'o_orderkey' AS target, 'error' AS severity, o_orderkey, count(*) AS violations
FROM orders WHERE o_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
GROUP BY o_orderkey
"""))(dq_relationships)


def dq_accepted_values(spark: SparkSession, root: str) -> DataFrame:
    """Q05: order status outside {F, O}."""
    return Q.accepted_values(Bed(spark, root).t("orders", "o_orderstatus"), "o_orderstatus", ["F", "O"])


register("dq_accepted_values", sql("""
SELECT 'accepted_values' AS "check", 'o_orderstatus' AS target, 'error' AS severity, o_orderstatus, count(*) AS violations
FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O') GROUP BY o_orderstatus
"""))(dq_accepted_values)


def dq_range(spark: SparkSession, root: str) -> DataFrame:
    """Q06: returned lines must carry 1..45 units (row condition + range)."""
    li = Bed(spark, root).t("lineitem", "l_quantity", "l_returnflag")
    return Q.in_range(li, "l_quantity", 1, 45, where=F.col("l_returnflag") == "R")


register("dq_range", sql("""
SELECT * FROM (SELECT 'range' AS "check", 'l_quantity' AS target, 'error' AS severity,
                      count_if(l_quantity < 1 OR l_quantity > 45) AS violations
               FROM lineitem WHERE l_returnflag = 'R') WHERE violations > 0
"""))(dq_range)


def dq_freshness(spark: SparkSession, root: str) -> DataFrame:
    """Q07: newest event load against ``as_of``; warn after 24 h, error after 48 h."""
    e = Bed(spark, root).t("events", "ts")
    return Q.freshness(e, "ts", FRESHNESS_AS_OF, 24, 48, target="events").select(
        "check", "target", F.col("latest_load").cast("string").alias("latest_load"), "age_hours", "severity")


register("dq_freshness", sql(f"""
, a AS (SELECT max(ts) AS latest_load,
               CAST(date_sub('second', max(ts), TIMESTAMP '{FRESHNESS_AS_OF:%Y-%m-%d %H:%M:%S}') AS BIGINT) AS s
        FROM events)
SELECT 'freshness' AS "check", 'events' AS target, CAST(latest_load AS VARCHAR) AS latest_load,
       """ + rr("s", "3600") + """ AS age_hours,
       CASE WHEN s > 48 * 3600 THEN 'error' WHEN s > 24 * 3600 THEN 'warn' ELSE 'pass' END AS severity
FROM a
"""))(dq_freshness)


def dq_summary(spark: SparkSession, root: str) -> DataFrame:
    """Q08: one row per check with its violation total and warn / fail / pass."""
    bed = Bed(spark, root)
    status = F.col("o_orderstatus")
    counted = [Q.row_checks(_winners(bed), [("not_null", "winner", Q.WARN, F.col("winner").isNull())]),
               Q.row_checks(bed.t("orders", "o_orderstatus"), [
                   ("accepted_values", "o_orderstatus", Q.ERROR, ~status.isin("F", "O", "P"))])]
    checks = [("unique_combination", "l_orderkey,l_linenumber", Q.ERROR,
               Q.unique(bed.t("lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])),
              ("relationships", "o_orderkey", Q.WARN,
               Q.relationships(bed.t("orders", "o_orderkey"), "o_orderkey", bed.t("lineitem", "l_orderkey"),
                               "l_orderkey", severity=Q.WARN))]
    return Q.summary(checks, counted)


register("dq_summary", sql("""
, c AS (
  SELECT 'not_null' AS "check", 'winner' AS target, 'warn' AS severity, count_if(home_score = away_score) AS v FROM universe
  UNION ALL SELECT 'unique_combination', 'l_orderkey,l_linenumber', 'error', coalesce(sum(n), 0) FROM
     (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
  UNION ALL SELECT 'accepted_values', 'o_orderstatus', 'error', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P')
  UNION ALL SELECT 'relationships', 'o_orderkey', 'warn', count(*) FROM orders
     WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey))
SELECT "check", target, severity, CAST(v AS BIGINT) AS violations,
       CASE WHEN v > 0 THEN CASE WHEN severity = 'error' THEN 'fail' ELSE 'warn' END ELSE 'pass' END AS status
FROM c
"""))(dq_summary)
