"""League-table family on the game analogue: universe, unpivot, opponent join,
pivot, head-to-head, ranks, percentiles, ordinals (M05, M19, M28, M37, M45,
M48, M51; U02, J04, J07, A02, A03, W05–W08)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.functions import exprs as X
from seasonflow.operators import joins as J
from seasonflow.operators import ranking as R
from seasonflow.operators.reshape import conditional_pivot
from seasonflow.plans.registry import register, sql
from seasonflow.plans.testbed import Bed


def league_table(bed: Bed, game_types=(2,)) -> DataFrame:
    """(season, team) record from the two-sided game rows."""
    s = bed.sides().filter(F.col("game_type").isin(*game_types))
    t = s.groupBy("season", "team").agg(
        F.count(F.lit(1)).alias("gp"),
        F.count_if(F.col("goals_for") > F.col("goals_against")).alias("wins"),
        F.count_if(F.col("goals_for") < F.col("goals_against")).alias("losses"),
        F.count_if(F.col("goals_for") == F.col("goals_against")).alias("ties"),
        F.sum("goals_for").alias("goals_for"),
        F.sum("goals_against").alias("goals_against"))
    return t.withColumns({
        "points": F.col("wins") * 2 + F.col("ties"),
        "goal_diff": F.col("goals_for") - F.col("goals_against"),
    })


LEAGUE_TABLE_SQL = """
, league_table AS (
  SELECT season, team, count(*) AS gp,
         count(*) FILTER (WHERE goals_for > goals_against) AS wins,
         count(*) FILTER (WHERE goals_for < goals_against) AS losses,
         count(*) FILTER (WHERE goals_for = goals_against) AS ties,
         CAST(sum(goals_for) AS BIGINT) AS goals_for,
         CAST(sum(goals_against) AS BIGINT) AS goals_against
  FROM sides WHERE game_type = 2 GROUP BY season, team),
league AS (
  SELECT *, wins * 2 + ties AS points, goals_for - goals_against AS goal_diff FROM league_table)
"""


def latest_season_table(bed: Bed) -> DataFrame:
    return (J.keep_max(league_table(bed), "season")
              .join(bed.teams().select("team", "conference"), "team", "left"))


# ---------------------------------------------------------------- metric_ranks
def metric_ranks(spark: SparkSession, root: str) -> DataFrame:
    """Latest-season league table with global and per-conference ranks."""
    bed = Bed(spark, root)
    t = latest_season_table(bed).withColumn(
        "points_pct", F.round(X.safe_divide("points", F.col("gp") * 2), 4))
    t = R.rank_metrics(t, {"points": False, "wins": False, "goals_for": False,
                           "goals_against": True, "goal_diff": False, "points_pct": False})
    t = R.rank_metrics(t, {"points": False}, partition=["conference"], suffix="_conference_rank")
    return t


register("metric_ranks", sql(LEAGUE_TABLE_SQL + """
, cur AS (
  SELECT l.*, t.conference, round(CAST(points AS DOUBLE) / CAST(gp * 2 AS DOUBLE), 4) AS points_pct
  FROM league l LEFT JOIN teams t USING (team)
  WHERE season = (SELECT max(season) FROM league))
SELECT *,
  CAST(rank() OVER (ORDER BY points DESC) AS INTEGER) AS points_rank,
  CAST(rank() OVER (ORDER BY wins DESC) AS INTEGER) AS wins_rank,
  CAST(rank() OVER (ORDER BY goals_for DESC) AS INTEGER) AS goals_for_rank,
  CAST(rank() OVER (ORDER BY goals_against ASC) AS INTEGER) AS goals_against_rank,
  CAST(rank() OVER (ORDER BY goal_diff DESC) AS INTEGER) AS goal_diff_rank,
  CAST(rank() OVER (ORDER BY points_pct DESC) AS INTEGER) AS points_pct_rank,
  CAST(rank() OVER (PARTITION BY conference ORDER BY points DESC) AS INTEGER) AS points_conference_rank
FROM cur
"""))(metric_ranks)


# ------------------------------------------------------ universe and unpivot
def league_universe(spark: SparkSession, root: str) -> DataFrame:
    """regular/playoff games whose two sides are both season participants."""
    return Bed(spark, root).universe()


register("league_universe", sql("SELECT * FROM universe"))(league_universe)


def two_sided_unpivot_q(spark: SparkSession, root: str) -> DataFrame:
    """One row per (game, team) with own and opponent scores."""
    return Bed(spark, root).sides()


register("two_sided_unpivot", sql("SELECT * FROM sides"))(two_sided_unpivot_q)


# ---------------------------------------------------------- side lines
def side_lines(bed: Bed) -> DataFrame:
    """Per (game, side) counts from the game's lines (materialised by the bed)."""
    return bed.side_lines()


SIDE_LINES_SQL = """
, side_lines AS (
  SELECT game_id, season, game_type, (l_linenumber % 2 = 1) AS is_home,
         CASE WHEN l_linenumber % 2 = 1 THEN home_team ELSE away_team END AS team,
         count(*) AS shots, CAST(sum(floor(l_quantity)) AS BIGINT) AS goals,
         count(*) FILTER (WHERE l_returnflag = 'R') AS shorthanded,
         count(*) FILTER (WHERE l_discount >= 0.05) AS pp_goals
  FROM lineitem JOIN universe ON l_orderkey = game_id
  GROUP BY ALL)
"""


def opponent_join_q(spark: SparkSession, root: str) -> DataFrame:
    """Each side paired with the other side of the same game."""
    s = side_lines(Bed(spark, root))
    return J.opponent_join(s, ["game_id"], "is_home", ["team", "shots", "goals", "shorthanded", "pp_goals"])


register("opponent_join", sql(SIDE_LINES_SQL + """
SELECT a.*, b.is_home AS opp_is_home, b.team AS opp_team, b.shots AS opp_shots, b.goals AS opp_goals,
       b.shorthanded AS opp_shorthanded, b.pp_goals AS opp_pp_goals
FROM side_lines a LEFT JOIN side_lines b ON a.game_id = b.game_id AND a.is_home <> b.is_home
"""))(opponent_join_q)


def team_game_line(spark: SparkSession, root: str) -> DataFrame:
    """own/opponent sums, special-teams fractions, shot share."""
    o = opponent_join_q(spark, root)
    z = lambda c: F.coalesce(F.col(c), F.lit(0))  # noqa: E731  missing side -> 0
    pp_att, pk_att, pk_ga = z("opp_shorthanded"), z("shorthanded"), z("opp_pp_goals")
    tot = F.col("shots") + z("opp_shots")
    return o.select(
        "game_id", "season", "team", "is_home", "goals", "shots",
        z("opp_goals").alias("goals_against"), z("opp_shots").alias("shots_against"),
        "pp_goals", pp_att.alias("pp_attempts"), pk_att.alias("pk_attempts"),
        pk_ga.alias("pk_goals_against"),
        F.round(X.safe_divide(F.col("pp_goals"), pp_att), 4).alias("pp_pct"),
        F.round(X.safe_divide(pk_att - pk_ga, pk_att), 4).alias("pk_pct"),
        X.fraction_text("pp_goals", pp_att).alias("pp_text"),
        F.when(tot == 0, F.lit(0.5)).otherwise(F.round(X.safe_divide(F.col("shots"), tot), 4))
         .alias("shot_share"))


register("team_game_line", sql(SIDE_LINES_SQL + """
, paired AS (
  SELECT a.*, b.goals AS opp_goals, b.shots AS opp_shots, b.shorthanded AS opp_shorthanded,
         b.pp_goals AS opp_pp_goals
  FROM side_lines a LEFT JOIN side_lines b ON a.game_id = b.game_id AND a.is_home <> b.is_home)
SELECT game_id, season, team, is_home, goals, shots,
       coalesce(opp_goals, 0) AS goals_against, coalesce(opp_shots, 0) AS shots_against,
       pp_goals, coalesce(opp_shorthanded, 0) AS pp_attempts, shorthanded AS pk_attempts,
       coalesce(opp_pp_goals, 0) AS pk_goals_against,
       round(CAST(pp_goals AS DOUBLE) / nullif(CAST(coalesce(opp_shorthanded, 0) AS DOUBLE), 0), 4) AS pp_pct,
       round(CAST(shorthanded - coalesce(opp_pp_goals, 0) AS DOUBLE) / nullif(CAST(shorthanded AS DOUBLE), 0), 4) AS pk_pct,
       CAST(pp_goals AS VARCHAR) || '/' || CAST(coalesce(opp_shorthanded, 0) AS VARCHAR) AS pp_text,
       CASE WHEN shots + coalesce(opp_shots, 0) = 0 THEN 0.5
            ELSE round(CAST(shots AS DOUBLE) / CAST(shots + coalesce(opp_shots, 0) AS DOUBLE), 4) END AS shot_share
FROM paired
"""))(team_game_line)


def home_away_pivot(spark: SparkSession, root: str) -> DataFrame:
    """Side lines pivoted back to one row per game."""
    s = side_lines(Bed(spark, root)).withColumn(
        "side", F.when(F.col("is_home"), F.lit("home")).otherwise(F.lit("away")))
    return conditional_pivot(s, ["game_id", "season"], "side", ["home", "away"],
                             {"shots": "shots", "goals": "goals", "pp_goals": "pp_goals"})


register("home_away_pivot", sql(SIDE_LINES_SQL + """
SELECT game_id, season,
       CAST(sum(CASE WHEN is_home THEN shots END) AS BIGINT) AS home_shots,
       CAST(sum(CASE WHEN is_home THEN goals END) AS BIGINT) AS home_goals,
       CAST(sum(CASE WHEN is_home THEN pp_goals END) AS BIGINT) AS home_pp_goals,
       CAST(sum(CASE WHEN NOT is_home THEN shots END) AS BIGINT) AS away_shots,
       CAST(sum(CASE WHEN NOT is_home THEN goals END) AS BIGINT) AS away_goals,
       CAST(sum(CASE WHEN NOT is_home THEN pp_goals END) AS BIGINT) AS away_pp_goals
FROM side_lines GROUP BY game_id, season
"""))(home_away_pivot)


# ------------------------------------------------------------- head to head
def head_to_head(spark: SparkSession, root: str) -> DataFrame:
    """Series record per (season, game type, team, opponent) with count_if."""
    s = Bed(spark, root).sides()
    return s.groupBy("season", "game_type", "team", "opponent").agg(
        F.count(F.lit(1)).alias("games"),
        F.count_if(F.col("goals_for") > F.col("goals_against")).alias("wins"),
        F.count_if(F.col("goals_for") < F.col("goals_against")).alias("losses"),
        F.count_if(F.col("goals_for") == F.col("goals_against")).alias("ties"),
        F.count_if(F.col("is_home")).alias("home_games"),
        F.sum("goals_for").alias("goals_for"), F.sum("goals_against").alias("goals_against"))


register("head_to_head", sql("""
SELECT season, game_type, team, opponent, count(*) AS games,
       count_if(goals_for > goals_against) AS wins, count_if(goals_for < goals_against) AS losses,
       count_if(goals_for = goals_against) AS ties, count_if(is_home) AS home_games,
       CAST(sum(goals_for) AS BIGINT) AS goals_for, CAST(sum(goals_against) AS BIGINT) AS goals_against
FROM sides GROUP BY season, game_type, team, opponent
"""))(head_to_head)


# ------------------------------------------------------ percentiles, ordinals
def percentiles(spark: SparkSession, root: str) -> DataFrame:
    """round(100 * percent_rank, 1), best = 100 (lower-is-better inverted)."""
    t = latest_season_table(Bed(spark, root)).drop("conference")
    return R.percentile_metrics(t, {"points": False, "goals_for": False, "goals_against": True,
                                    "goal_diff": False, "wins": False, "ties": False})


register("percentiles", sql(LEAGUE_TABLE_SQL + """
SELECT *,
  round(100.0 * percent_rank() OVER (ORDER BY points), 1) AS points_pctile,
  round(100.0 * percent_rank() OVER (ORDER BY goals_for), 1) AS goals_for_pctile,
  round(100.0 * percent_rank() OVER (ORDER BY goals_against DESC), 1) AS goals_against_pctile,
  round(100.0 * percent_rank() OVER (ORDER BY goal_diff), 1) AS goal_diff_pctile,
  round(100.0 * percent_rank() OVER (ORDER BY wins), 1) AS wins_pctile,
  round(100.0 * percent_rank() OVER (ORDER BY ties), 1) AS ties_pctile
FROM league WHERE season = (SELECT max(season) FROM league)
"""))(percentiles)


def statwise_ordinals(spark: SparkSession, root: str) -> DataFrame:
    """Per-season row_number per stat (team id breaks ties) + ordinal text."""
    t = league_table(Bed(spark, root))
    stats = {"points": False, "goals_for": False, "goals_against": True, "wins": False, "losses": True}
    t = R.ordinals(t, stats, ["season"], ["team"], suffix="_rank")
    return t.select("*", *[X.ordinal_suffix(f"{m}_rank").alias(f"{m}_rank_ordinal") for m in stats])


def _ord_sql(c: str) -> str:
    return (f"CAST({c} AS VARCHAR) || CASE WHEN {c} % 100 IN (11, 12, 13) THEN 'th' "
            f"WHEN {c} % 10 = 1 THEN 'st' WHEN {c} % 10 = 2 THEN 'nd' WHEN {c} % 10 = 3 THEN 'rd' "
            f"ELSE 'th' END AS {c}_ordinal")


register("statwise_ordinals", sql(LEAGUE_TABLE_SQL + """
, r AS (
  SELECT *,
    CAST(row_number() OVER (PARTITION BY season ORDER BY points DESC, team) AS INTEGER) AS points_rank,
    CAST(row_number() OVER (PARTITION BY season ORDER BY goals_for DESC, team) AS INTEGER) AS goals_for_rank,
    CAST(row_number() OVER (PARTITION BY season ORDER BY goals_against ASC, team) AS INTEGER) AS goals_against_rank,
    CAST(row_number() OVER (PARTITION BY season ORDER BY wins DESC, team) AS INTEGER) AS wins_rank,
    CAST(row_number() OVER (PARTITION BY season ORDER BY losses ASC, team) AS INTEGER) AS losses_rank
  FROM league)
SELECT *, """ + ", ".join(_ord_sql(c) for c in
                          ["points_rank", "goals_for_rank", "goals_against_rank", "wins_rank", "losses_rank"])
    + " FROM r"))(statwise_ordinals)
