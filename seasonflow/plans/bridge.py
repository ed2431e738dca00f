"""Entity-period bridge and entity universe (M33, M34; A07, A09, A18, J15,
J20, U03, W03, W09, W16).

Analogue: player = customer, team = order priority, season = order year,
game = order.  Stint windows are partitioned by player over *stint-grain*
rows (bounded by teams x seasons per player), never over raw facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonflow.functions import exprs as X
from seasonflow.operators import joins as J
from seasonflow.operators.reshape import union_distinct
from seasonflow.plans.registry import register, sql
from seasonflow.plans.testbed import Bed


def appearances(bed: Bed) -> DataFrame:
    o = bed.t("orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    return o.select(F.col("o_custkey").alias("player"), F.col("o_orderpriority").alias("team"),
                    F.year("o_orderdate").cast("int").alias("season"), F.col("o_orderkey").alias("game_id"),
                    F.col("o_orderdate").cast("date").alias("game_date"))


def stints(bed: Bed) -> DataFrame:
    """First and last game per (player, team, season); their dates ride
    along in the same aggregate (max_by / min_by) instead of two joins back."""
    a = appearances(bed)
    s = a.groupBy("player", "team", "season").agg(
        F.min("game_id").alias("first_game"), F.max("game_id").alias("last_game"),
        F.count(F.lit(1)).alias("games"),
        F.min_by("game_date", "game_id").alias("start_date"),
        F.max_by("game_date", "game_id").alias("end_date"))
    return s.withColumn("stint_days", F.datediff("end_date", "start_date") + 1)


_STINT_SQL = """
, app AS (SELECT o_custkey AS player, o_orderpriority AS team, CAST(year(o_orderdate) AS INTEGER) AS season,
                 o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date FROM orders)
, st0 AS (SELECT player, team, season, min(game_id) AS first_game, max(game_id) AS last_game, count(*) AS games
          FROM app GROUP BY 1, 2, 3)
, stints AS (SELECT st0.*, f.game_date AS start_date, l.game_date AS end_date,
                    CAST(date_diff('day', f.game_date, l.game_date) + 1 AS INTEGER) AS stint_days
             FROM st0 LEFT JOIN app f ON f.game_id = st0.first_game LEFT JOIN app l ON l.game_id = st0.last_game)
"""


def stint_bounds(spark: SparkSession, root: str) -> DataFrame:
    return stints(Bed(spark, root))


register("stint_bounds", sql(_STINT_SQL + "SELECT * FROM stints"))(stint_bounds)


def trades(bed: Bed) -> DataFrame:
    """``count(distinct team) > 1`` per (player, season)."""
    a = appearances(bed)
    return a.groupBy("player", "season").agg(F.count_distinct("team").alias("teams_in_season")) \
            .withColumn("was_traded", F.col("teams_in_season") > 1)


def traded_flag(spark: SparkSession, root: str) -> DataFrame:
    return trades(Bed(spark, root))


register("traded_flag", sql("""
SELECT o_custkey AS player, CAST(year(o_orderdate) AS INTEGER) AS season,
       count(DISTINCT o_orderpriority) AS teams_in_season, count(DISTINCT o_orderpriority) > 1 AS was_traded
FROM orders GROUP BY 1, 2
"""))(traded_flag)


def _with_acquisition(bed: Bed) -> DataFrame:
    s = stints(bed).join(trades(bed), ["player", "season"], "left")
    order = [F.col("season"), F.col("start_date"), F.col("first_game"), F.col("team")]
    wp = Window.partitionBy("player").orderBy(*order)
    ws = Window.partitionBy("player", "season").orderBy(F.col("start_date"), F.col("first_game"), F.col("team"))
    s = s.select("*", F.lag("team").over(wp).alias("prev_team"), F.lag("season").over(wp).alias("prev_season"),
                 F.row_number().over(ws).alias("stint_in_season"))
    acq = (F.when(F.col("was_traded") & (F.col("stint_in_season") > 1), "Trade")
            .when(F.col("prev_team") != F.col("team"), "Free Agent")
            .when(F.col("prev_season").isNull(), "Draft/Entry")
            .otherwise("Retained"))
    return s.withColumn("acquisition_type", acq)


_ACQ_SQL = _STINT_SQL + """
, tr AS (SELECT player, season, count(DISTINCT team) AS teams_in_season, count(DISTINCT team) > 1 AS was_traded
         FROM app GROUP BY 1, 2)
, lagged AS (
  SELECT s.*, tr.teams_in_season, tr.was_traded,
         lag(team) OVER (PARTITION BY player ORDER BY season, start_date, first_game, team) AS prev_team,
         lag(season) OVER (PARTITION BY player ORDER BY season, start_date, first_game, team) AS prev_season,
         row_number() OVER (PARTITION BY player, season ORDER BY start_date, first_game, team) AS stint_in_season
  FROM stints s LEFT JOIN tr USING (player, season))
, acq AS (
  SELECT *, CASE WHEN was_traded AND stint_in_season > 1 THEN 'Trade' WHEN prev_team <> team THEN 'Free Agent'
                 WHEN prev_season IS NULL THEN 'Draft/Entry' ELSE 'Retained' END AS acquisition_type
  FROM lagged)
"""


def acquisition_type(spark: SparkSession, root: str) -> DataFrame:
    """Lag over the player's stints + n-th stint in a traded season."""
    return _with_acquisition(Bed(spark, root)).select(
        "player", "team", "season", "prev_team", "prev_season", "stint_in_season", "acquisition_type")


register("acquisition_type", sql(_ACQ_SQL + """
SELECT player, team, season, prev_team, prev_season, CAST(stint_in_season AS INTEGER) AS stint_in_season,
       acquisition_type FROM acq
"""))(acquisition_type)


def current_stint_flag(spark: SparkSession, root: str) -> DataFrame:
    """Current team = a stint of the league's latest season ending on the
    player's latest end date (per-player max as a window, league max as a
    broadcast scalar)."""
    s = stints(Bed(spark, root))
    s = s.withColumn("__player_end", F.max("end_date").over(Window.partitionBy("player")))
    s = J.scalar_join(s, s.agg(F.max("season").alias("__max_season")))
    return s.select("player", "team", "season", "end_date",
                    ((F.col("season") == F.col("__max_season")) &
                     (F.col("end_date") == F.col("__player_end"))).alias("is_current_team"))


register("current_stint_flag", sql(_STINT_SQL + """
SELECT player, team, season, end_date,
       season = (SELECT max(season) FROM stints)
       AND end_date = (SELECT max(end_date) FROM stints s2 WHERE s2.player = s.player) AS is_current_team
FROM stints s
"""))(current_stint_flag)


def entity_period_bridge(spark: SparkSession, root: str) -> DataFrame:
    """The full bridge — key, stint dates, acquisition, trade flag, current
    flag, participation level."""
    bed = Bed(spark, root)
    s = _with_acquisition(bed)
    s = s.withColumn("__player_end", F.max("end_date").over(Window.partitionBy("player")))
    s = J.scalar_join(s, s.agg(F.max("season").alias("__max_season")))
    g = F.col("games")
    level = (F.when(g >= 41, "Full Season").when(g >= 20, "Significant").when(g >= 10, "Regular")
              .when(g >= 1, "Limited").otherwise("None"))
    return s.select(
        X.surrogate_key("player", "team", "season").alias("bridge_key"),
        "player", "team", "season", "start_date", "end_date", "acquisition_type",
        ((F.col("season") == F.col("__max_season")) & (F.col("end_date") == F.col("__player_end")))
        .alias("is_current_team"),
        F.col("games").alias("games_for_team"), F.col("was_traded").alias("traded_mid_season"),
        "teams_in_season", "stint_days", level.alias("participation_level"))


register("entity_period_bridge", sql(_ACQ_SQL + """
SELECT md5(CAST(player AS VARCHAR) || '-' || team || '-' || CAST(season AS VARCHAR)) AS bridge_key,
       player, team, season, start_date, end_date, acquisition_type,
       season = (SELECT max(season) FROM acq)
       AND end_date = (SELECT max(end_date) FROM acq a2 WHERE a2.player = a.player) AS is_current_team,
       games AS games_for_team, was_traded AS traded_mid_season, teams_in_season, stint_days,
       CASE WHEN games >= 41 THEN 'Full Season' WHEN games >= 20 THEN 'Significant' WHEN games >= 10 THEN 'Regular'
            WHEN games >= 1 THEN 'Limited' ELSE 'None' END AS participation_level
FROM acq a
"""))(entity_period_bridge)


def entity_universe(spark: SparkSession, root: str) -> DataFrame:
    """players = roster UNION appearances; last-seen team (max_by over a total
    order), preferred roster row, career games and experience level, active flag
    (last season = the league's latest)."""
    bed = Bed(spark, root)
    roster = bed.t("customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    a = appearances(bed)
    ids = union_distinct(roster.select(F.col("c_custkey").alias("player")), a.select("player"))
    seen = a.groupBy("player").agg(
        F.max_by("team", F.struct("game_date", "game_id")).alias("last_team"),
        F.max("season").alias("last_season"), F.count_distinct("season").alias("seasons_played"),
        F.count(F.lit(1)).alias("career_games"))
    latest = a.agg(F.max("season").alias("__latest"))
    out = (ids.join(roster, ids.player == roster.c_custkey, "left").join(seen, "player", "left"))
    out = J.scalar_join(out, latest)
    cg = F.coalesce(F.col("career_games"), F.lit(0))
    level = (F.when(cg == 0, "Prospect").when(cg.between(1, 25), "Rookie").when(cg.between(26, 100), "Sophomore")
              .when(cg.between(101, 300), "Experienced").when(cg.between(301, 500), "Veteran")
              .when(cg > 500, "Elite Veteran").otherwise("Unknown"))
    return out.select(
        "player", F.col("c_name").alias("name"),
        F.coalesce(F.col("last_team"), F.col("c_mktsegment")).alias("current_team"),
        F.coalesce(F.col("seasons_played"), F.lit(0)).alias("seasons_played"), cg.alias("career_games"),
        (cg > 0).alias("has_experience"),
        F.coalesce(F.col("last_season") == F.col("__latest"), F.lit(False)).alias("is_active"),
        level.alias("experience_level"))


register("entity_universe", sql("""
, app AS (SELECT o_custkey AS player, o_orderpriority AS team, CAST(year(o_orderdate) AS INTEGER) AS season,
                 o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date FROM orders)
, ids AS (SELECT c_custkey AS player FROM customer UNION SELECT player FROM app)
, lastrow AS (SELECT player, team AS last_team FROM (
    SELECT player, team, row_number() OVER (PARTITION BY player ORDER BY game_date DESC, game_id DESC) AS rn FROM app)
    WHERE rn = 1)
, seen AS (SELECT player, max(season) AS last_season, count(DISTINCT season) AS seasons_played, count(*) AS career_games
           FROM app GROUP BY player)
SELECT ids.player, c_name AS name, coalesce(last_team, c_mktsegment) AS current_team,
       coalesce(seasons_played, 0) AS seasons_played, coalesce(career_games, 0) AS career_games,
       coalesce(career_games, 0) > 0 AS has_experience,
       coalesce(last_season = (SELECT max(season) FROM app), false) AS is_active,
       CASE WHEN coalesce(career_games, 0) = 0 THEN 'Prospect' WHEN coalesce(career_games, 0) BETWEEN 1 AND 25 THEN 'Rookie'
            WHEN coalesce(career_games, 0) BETWEEN 26 AND 100 THEN 'Sophomore'
            WHEN coalesce(career_games, 0) BETWEEN 101 AND 300 THEN 'Experienced'
            WHEN coalesce(career_games, 0) BETWEEN 301 AND 500 THEN 'Veteran'
            WHEN coalesce(career_games, 0) > 500 THEN 'Elite Veteran' ELSE 'Unknown' END AS experience_level
FROM ids LEFT JOIN customer ON ids.player = c_custkey LEFT JOIN lastrow USING (player) LEFT JOIN seen USING (player)
"""))(entity_universe)
