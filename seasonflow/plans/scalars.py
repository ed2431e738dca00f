"""Projections, predicates and scalar formats.

All narrow: no shuffle, filters pushed to the parquet scan, only the needed
columns read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.functions import exprs as X
from seasonflow.plans.registry import register, sql
from seasonflow.plans.testbed import Bed


# --------------------------------------------------------- typed projection
def typed_projection(spark: SparkSession, root: str) -> DataFrame:
    """P01 rename + cast, P02 ``*`` plus computed columns, C13 full listing."""
    p = Bed(spark, root).t("part")
    return p.select("*",
                    F.col("p_partkey").alias("part_id"),
                    F.upper("p_brand").alias("brand_code"),
                    F.col("p_size").cast("bigint").alias("size_units"),
                    (F.col("p_retailprice") * 100).cast("bigint").alias("price_cents"))


register("typed_projection", sql("""
SELECT *, p_partkey AS part_id, upper(p_brand) AS brand_code, CAST(p_size AS BIGINT) AS size_units,
       CAST(trunc(p_retailprice * 100) AS BIGINT) AS price_cents
FROM part
"""))(typed_projection)


def lateral_alias(spark: SparkSession, root: str) -> DataFrame:
    """Later expressions reuse aliases defined in the same projection.

    Money math runs in exact decimals (rounding a binary double at a .5 tie
    is engine-dependent); the results are published as doubles.
    """
    li = Bed(spark, root).t("lineitem", "l_orderkey", "l_linenumber", "l_extendedprice",
                            "l_discount", "l_tax")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    out = (li.withColumn("disc_price", price * (1 - disc))
             .withColumn("charge", F.col("disc_price") * (1 + tax))
             .withColumn("charge_rounded", F.round("charge", 2))
             .withColumn("is_big", F.col("charge_rounded") > 50000))
    return out.select("l_orderkey", "l_linenumber",
                      *[F.col(c).cast("double").alias(c) for c in ("disc_price", "charge", "charge_rounded")],
                      "is_big")


register("lateral_alias", sql("""
, la AS (
  SELECT l_orderkey, l_linenumber,
         CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS dp,
         dp * (1 + CAST(l_tax AS DECIMAL(4,2))) AS ch, round(ch, 2) AS chr
  FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(dp AS DOUBLE) AS disc_price, CAST(ch AS DOUBLE) AS charge,
       CAST(chr AS DOUBLE) AS charge_rounded, chr > 50000 AS is_big
FROM la
"""))(lateral_alias)


def case_buckets(spark: SparkSession, root: str) -> DataFrame:
    """P04 threshold ladder and P09 BETWEEN (inclusive) buckets."""
    p = Bed(spark, root).t("part", "p_partkey", "p_size", "p_retailprice")
    size = (F.when(F.col("p_size").between(1, 10), "small")
             .when(F.col("p_size").between(11, 30), "medium")
             .otherwise("large"))
    price = (F.when(F.col("p_retailprice") >= 1900, "premium")
              .when(F.col("p_retailprice") >= 1400, "standard")
              .when(F.col("p_retailprice") >= 1000, "value")
              .otherwise("budget"))
    return p.select("p_partkey", size.alias("size_bucket"), price.alias("price_tier"))


register("case_buckets", sql("""
SELECT p_partkey,
  CASE WHEN p_size BETWEEN 1 AND 10 THEN 'small' WHEN p_size BETWEEN 11 AND 30 THEN 'medium'
       ELSE 'large' END AS size_bucket,
  CASE WHEN p_retailprice >= 1900 THEN 'premium' WHEN p_retailprice >= 1400 THEN 'standard'
       WHEN p_retailprice >= 1000 THEN 'value' ELSE 'budget' END AS price_tier
FROM part
"""))(case_buckets)


# Game-type enum 1 preseason/other, 2 regular, 3 playoff.
GAME_TYPE_LABEL = {2: "regular", 3: "playoff"}


def code_label_map(spark: SparkSession, root: str) -> DataFrame:
    """P05 simple CASE / literal map lookup, P07 enum decode with and without ELSE."""
    o = Bed(spark, root).t("orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    code = F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "P", 3).otherwise(1)
    prio = F.create_map(*[F.lit(x) for kv in [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3)]
                          for x in kv])
    return o.select(
        "o_orderkey", code.alias("game_type"),
        F.when(code == 2, "regular").when(code == 3, "playoff").otherwise("other").alias("type_label"),
        F.when(code == 2, "regular").when(code == 3, "playoff").alias("type_label_strict"),
        F.element_at(prio, F.col("o_orderpriority")).alias("priority_rank"))


register("code_label_map", sql("""
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 3 ELSE 1 END AS game_type,
  CASE o_orderstatus WHEN 'F' THEN 'regular' WHEN 'P' THEN 'playoff' ELSE 'other' END AS type_label,
  CASE o_orderstatus WHEN 'F' THEN 'regular' WHEN 'P' THEN 'playoff' END AS type_label_strict,
  CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END AS priority_rank
FROM orders
"""))(code_label_map)


def flag_columns(spark: SparkSession, root: str) -> DataFrame:
    """Comparisons stored as booleans; NULL inputs give NULL, not false."""
    li = Bed(spark, root).t("lineitem", "l_orderkey", "l_linenumber", "l_discount", "l_tax",
                            "l_returnflag")
    tax = F.when(F.col("l_tax") != 0, F.col("l_tax"))   # nullif(l_tax, 0)
    return li.select("l_orderkey", "l_linenumber",
                     (F.col("l_discount") > 0.05).alias("is_discounted"),
                     (F.col("l_returnflag") == "R").alias("is_returned"),
                     (tax > 0.04).alias("is_high_tax"))


register("flag_columns", sql("""
SELECT l_orderkey, l_linenumber, l_discount > 0.05 AS is_discounted, l_returnflag = 'R' AS is_returned,
       nullif(l_tax, 0) > 0.04 AS is_high_tax
FROM lineitem
"""))(flag_columns)


def filter_in_list(spark: SparkSession, root: str) -> DataFrame:
    """P08 IN / NOT IN literal lists, P12 NULL guards."""
    o = Bed(spark, root).t("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
                    & ~F.col("o_orderstatus").isin("O")
                    & F.col("o_custkey").isNotNull())


register("filter_in_list", sql("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('O') AND o_custkey IS NOT NULL
"""))(filter_in_list)


def like_prefix(spark: SparkSession, root: str) -> DataFrame:
    """P10: LIKE / NOT LIKE prefix tests."""
    p = Bed(spark, root).t("part", "p_partkey", "p_name", "p_type")
    return (p.filter(F.col("p_name").like("blue%") | F.col("p_name").startswith("red"))
             .filter(~F.col("p_type").like("ECON%"))
             .select("p_partkey", "p_name", F.col("p_name").like("%bolt").alias("is_bolt")))


register("like_prefix", sql("""
SELECT p_partkey, p_name, p_name LIKE '%bolt' AS is_bolt FROM part
WHERE (p_name LIKE 'blue%' OR starts_with(p_name, 'red')) AND p_type NOT LIKE 'ECON%'
"""))(like_prefix)


def regulation_adjust(spark: SparkSession, root: str) -> DataFrame:
    """Ending from the margin (1 OT, 2 SO, else REG); regulation score =
    final for REG, winner's score - 1 after OT/SO; duration; result flags."""
    g = Bed(spark, root).universe()
    margin = F.abs(F.col("home_score") - F.col("away_score"))
    ending = F.when(margin == 1, "OT").when(margin == 2, "SO").otherwise("REG")
    g = g.withColumn("ending", ending)

    def reg(own, opp):
        return (F.when(F.col("ending") == "REG", F.col(own))
                 .otherwise(F.when(F.col(own) > F.col(opp), F.col(own) - 1).otherwise(F.col(own))))
    return g.select(
        "game_id", "season", "home_team", "away_team", "home_score", "away_score", "ending",
        reg("home_score", "away_score").alias("home_reg_score"),
        reg("away_score", "home_score").alias("away_reg_score"),
        F.when(F.col("ending") == "REG", 60).otherwise(65).alias("duration_min"),
        F.when(F.col("home_score") > F.col("away_score"), F.col("home_team"))
         .when(F.col("home_score") < F.col("away_score"), F.col("away_team")).alias("winner"),
        (margin >= 20).alias("is_blowout"),
        F.initcap(F.when(F.col("game_type") == 2, "regular").otherwise("playoff")).alias("type_display"))


register("regulation_adjust", sql("""
, g AS (
  SELECT *, CASE abs(home_score - away_score) WHEN 1 THEN 'OT' WHEN 2 THEN 'SO' ELSE 'REG' END AS ending
  FROM universe)
SELECT game_id, season, home_team, away_team, home_score, away_score, ending,
  CASE WHEN ending = 'REG' THEN home_score
       ELSE CASE WHEN home_score > away_score THEN home_score - 1 ELSE home_score END END AS home_reg_score,
  CASE WHEN ending = 'REG' THEN away_score
       ELSE CASE WHEN away_score > home_score THEN away_score - 1 ELSE away_score END END AS away_reg_score,
  CASE WHEN ending = 'REG' THEN 60 ELSE 65 END AS duration_min,
  CASE WHEN home_score > away_score THEN home_team WHEN home_score < away_score THEN away_team END AS winner,
  abs(home_score - away_score) >= 20 AS is_blowout,
  CASE WHEN game_type = 2 THEN 'Regular' ELSE 'Playoff' END AS type_display
FROM g
"""))(regulation_adjust)


# ------------------------------------------------------------ text formats
def display_strings(spark: SparkSession, root: str) -> DataFrame:
    """F03 season display, F07 record text, F08 URL fallback, F09 signed text."""
    from seasonflow.plans.league import league_table
    bed = Bed(spark, root)
    t = league_table(bed).join(bed.teams().select("team", "team_name"), "team", "left")
    key = X.season_key_from_year("season")
    logo = F.when(F.col("team_name") != "NATION_3", F.concat(F.lit("logo/"), F.col("team_name")))
    return t.select("season", "team",
                    key.alias("season_key"),
                    X.season_display(key).alias("season_display"),
                    X.record_string("wins", "losses", "ties").alias("record"),
                    X.signed_string("goal_diff").alias("goal_diff_text"),
                    X.url_fallback(logo, "default/", "team").alias("logo_url"))


register("display_strings", sql("""
, lt AS (
  SELECT season, team,
         count(*) FILTER (WHERE goals_for > goals_against) AS wins,
         count(*) FILTER (WHERE goals_for < goals_against) AS losses,
         count(*) FILTER (WHERE goals_for = goals_against) AS ties,
         CAST(sum(goals_for) - sum(goals_against) AS BIGINT) AS goal_diff
  FROM sides WHERE game_type = 2 GROUP BY season, team)
SELECT season, lt.team, season * 10000 + season + 1 AS season_key,
       substr(CAST(season * 10000 + season + 1 AS VARCHAR), 1, 4) || '-' ||
         substr(CAST(season * 10000 + season + 1 AS VARCHAR), 7, 2) AS season_display,
       CAST(wins AS VARCHAR) || '-' || CAST(losses AS VARCHAR) || '-' || CAST(ties AS VARCHAR) AS record,
       CASE WHEN goal_diff > 0 THEN '+' || CAST(goal_diff AS VARCHAR) ELSE CAST(goal_diff AS VARCHAR) END AS goal_diff_text,
       coalesce(CASE WHEN team_name <> 'NATION_3' THEN 'logo/' || team_name END,
                'default/' || CAST(lt.team AS VARCHAR)) AS logo_url
FROM lt LEFT JOIN teams t ON lt.team = t.team
"""))(display_strings)


def ordinal_suffix_q(spark: SparkSession, root: str) -> DataFrame:
    """F10 over every distinct part size (covers 11-13 and 21-23)."""
    p = Bed(spark, root).t("part", "p_size").distinct()
    return p.select("p_size", X.ordinal_suffix("p_size").alias("size_ordinal"))


register("ordinal_suffix", sql("""
SELECT DISTINCT p_size, CAST(p_size AS VARCHAR) || CASE WHEN p_size % 100 IN (11, 12, 13) THEN 'th'
  WHEN p_size % 10 = 1 THEN 'st' WHEN p_size % 10 = 2 THEN 'nd' WHEN p_size % 10 = 3 THEN 'rd'
  ELSE 'th' END AS size_ordinal
FROM part
"""))(ordinal_suffix_q)


def clock_to_seconds_q(spark: SparkSession, root: str) -> DataFrame:
    """F01 / F06: 'MM:SS' text built from the event time, parsed back to seconds."""
    e = Bed(spark, root).t("events", "event_id", "ts")
    clock = F.date_format("ts", "mm:ss")
    return e.select("event_id", clock.alias("clock"),
                    X.clock_to_seconds(clock).alias("clock_seconds"),
                    X.seconds_to_clock(X.clock_to_seconds(clock) + 5).alias("clock_plus_5"))


register("clock_to_seconds", sql("""
, c AS (SELECT event_id, strftime(ts, '%M:%S') AS clock FROM events)
, s AS (SELECT event_id, clock,
               CAST(split_part(clock, ':', 1) AS INTEGER) * 60 + CAST(split_part(clock, ':', -1) AS INTEGER)
                 AS clock_seconds FROM c)
SELECT event_id, clock, clock_seconds,
       lpad(CAST((clock_seconds + 5) // 60 AS VARCHAR), 2, '0') || ':' ||
       lpad(CAST((clock_seconds + 5) % 60 AS VARCHAR), 2, '0') AS clock_plus_5
FROM s
"""))(clock_to_seconds_q)


def fraction_parse(spark: SparkSession, root: str) -> DataFrame:
    """F04 / F05: 'saved/against' text -> two ints and a guarded ratio."""
    li = Bed(spark, root).t("lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    against = F.floor("l_quantity") + F.col("l_linenumber")
    text = X.fraction_text(F.floor("l_quantity"), against)
    saved, shots = X.fraction_part(text, 1), X.fraction_part(text, 2)
    return li.select("l_orderkey", "l_linenumber", text.alias("saves_text"),
                     saved.alias("saves"), shots.alias("shots"),
                     F.round(X.safe_divide(saved, shots), 3).alias("save_pct"))


register("fraction_parse", sql("""
, f AS (SELECT l_orderkey, l_linenumber,
               CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || '/' ||
               CAST(CAST(floor(l_quantity) AS BIGINT) + l_linenumber AS VARCHAR) AS saves_text
        FROM lineitem)
SELECT l_orderkey, l_linenumber, saves_text,
       TRY_CAST(split_part(saves_text, '/', 1) AS INTEGER) AS saves,
       TRY_CAST(split_part(saves_text, '/', 2) AS INTEGER) AS shots,
       round(CAST(TRY_CAST(split_part(saves_text, '/', 1) AS INTEGER) AS DOUBLE)
             / nullif(CAST(TRY_CAST(split_part(saves_text, '/', 2) AS INTEGER) AS DOUBLE), 0), 3) AS save_pct
FROM f
"""))(fraction_parse)


def date_parts(spark: SparkSession, root: str) -> DataFrame:
    """Date key, calendar parts, ISO weekday/week, names, date arithmetic."""
    o = Bed(spark, root).t("orders", "o_orderdate").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return o.select(
        "d", X.date_key("d").alias("date_key"),
        F.year("d").alias("year"), F.month("d").alias("month"), F.dayofmonth("d").alias("day"),
        F.quarter("d").alias("quarter"), F.weekofyear("d").alias("iso_week"),
        X.iso_dow("d").alias("iso_dow"), X.is_weekend("d").alias("is_weekend"),
        X.is_monday("d").alias("is_monday"),
        F.date_format("d", "EEE").alias("day_abbr"), F.date_format("d", "MMM").alias("month_abbr"),
        F.date_format("d", "yyyy-MM").alias("year_month"),
        X.days_between(F.lit("1995-01-01").cast("date"), "d").alias("day_number"),
        F.date_add("d", 365).alias("plus_365"))


register("date_parts", sql("""
, d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT d, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(weekofyear(d) AS INTEGER) AS iso_week,
       CAST(isodow(d) AS INTEGER) AS iso_dow, isodow(d) >= 6 AS is_weekend, isodow(d) = 1 AS is_monday,
       strftime(d, '%a') AS day_abbr, strftime(d, '%b') AS month_abbr, strftime(d, '%Y-%m') AS year_month,
       CAST(date_diff('day', DATE '1995-01-01', d) AS INTEGER) AS day_number,
       CAST(d + INTERVAL 365 DAY AS DATE) AS plus_365
FROM d
"""))(date_parts)


def geometry(spark: SparkSession, root: str) -> DataFrame:
    """Shot distance and angle from rink coordinates, distance band."""
    p = Bed(spark, root).plays()
    x = (F.col("k") - 50).cast("double")
    y = (F.col("value") % 40 - 20)
    p = p.select("play_id", x.alias("x"), y.alias("y"))
    return p.select("play_id", "x", "y",
                    F.round(X.shot_distance("x", "y"), 4).alias("shot_distance"),
                    F.round(X.shot_angle("x", "y"), 4).alias("shot_angle"),
                    X.distance_band(X.shot_distance("x", "y")).alias("distance_band"))


register("geometry", sql("""
, p AS (SELECT play_id, CAST(k - 50 AS DOUBLE) AS x, fmod(value, 40) - 20 AS y FROM plays)
SELECT play_id, x, y,
       round(sqrt(power(abs(89 - abs(x)), 2) + power(y, 2)), 4) AS shot_distance,
       round(degrees(atan2(y, abs(89 - abs(x)))), 4) AS shot_angle,
       CASE WHEN sqrt(power(abs(89 - abs(x)), 2) + power(y, 2)) <= 10 THEN 'Close'
            WHEN sqrt(power(abs(89 - abs(x)), 2) + power(y, 2)) <= 25 THEN 'Medium' ELSE 'Long' END AS distance_band
FROM p
"""))(geometry)


def surrogate_key_q(spark: SparkSession, root: str) -> DataFrame:
    """md5 surrogate key over a composite grain with NULL sentinel."""
    li = Bed(spark, root).t("lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return li.select("l_orderkey", "l_linenumber", "l_suppkey",
                     X.surrogate_key("l_orderkey", "l_linenumber", "l_suppkey", flag).alias("line_key"))


register("surrogate_key", sql("""
SELECT l_orderkey, l_linenumber, l_suppkey,
       md5(concat_ws('-', coalesce(CAST(l_orderkey AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
                          coalesce(CAST(l_linenumber AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
                          coalesce(CAST(l_suppkey AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
                          coalesce(nullif(l_returnflag, 'N'), '_dbt_utils_surrogate_key_null_'))) AS line_key
FROM lineitem
"""))(surrogate_key_q)
