"""Aggregation family on the player-game analogue (A01–A21, C03, C04, C09, C12,
M20, M24, M25, M29/M30, M35, M49/M50, M57–M60, M62/M63).

Every group-by here is a hash aggregate with a map-side partial step, so a hot
key (one player with a third of all lines) is combined per input partition
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonflow.functions import exprs as X
from seasonflow.operators import distinct as D
from seasonflow.plans.registry import register, rr, sql
from seasonflow.plans.testbed import Bed
from seasonflow.session import cut_lineage

_SUMS = ("goals", "assists", "points", "shots", "toi_seconds", "pim")


def season_totals_df(bed: Bed, game_types=(2,)) -> DataFrame:
    """(season, player) totals; A04 conditional count; A17 min(name)."""
    pg = bed.player_games().filter(F.col("game_type").isin(*game_types))
    return pg.groupBy("season", "player").agg(
        F.min("player_name").alias("player_name"),
        F.count(F.lit(1)).alias("gp"),
        *[F.sum(c).alias(c) for c in _SUMS],
        F.count(F.when(F.col("goals") > 0, F.lit(1))).alias("goal_games"))


def season_totals(spark: SparkSession, root: str) -> DataFrame:
    return season_totals_df(Bed(spark, root))


_TOT_SQL = """
, totals AS (
  SELECT season, player, min(player_name) AS player_name, count(*) AS gp,
         CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(assists) AS BIGINT) AS assists,
         CAST(sum(points) AS BIGINT) AS points, CAST(sum(shots) AS BIGINT) AS shots,
         CAST(sum(toi_seconds) AS BIGINT) AS toi_seconds, CAST(sum(pim) AS BIGINT) AS pim,
         count(CASE WHEN goals > 0 THEN 1 END) AS goal_games
  FROM player_games WHERE game_type = 2 GROUP BY 1, 2)
"""
register("season_totals", sql(_TOT_SQL + "SELECT * FROM totals"))(season_totals)


def season_averages(spark: SparkSession, root: str) -> DataFrame:
    """Per-game averages rounded to 2 (exact HALF_UP)."""
    t = season_totals_df(Bed(spark, root), (2, 3))
    return t.select("season", "player", "gp",
                    *[X.round_ratio(c, "gp", 2).alias(f"{c}_per_game") for c in ("goals", "points", "shots", "pim")])


register("season_averages", sql(_TOT_SQL.replace("WHERE game_type = 2", "WHERE game_type IN (2, 3)") +
                                "SELECT season, player, gp, " +
                                ", ".join(f"{rr(c, 'gp')} AS {c}_per_game" for c in ("goals", "points", "shots", "pim")) +
                                " FROM totals"))(season_averages)


def ratio_of_sums(spark: SparkSession, root: str) -> DataFrame:
    """Team shooting pct = sum(goals) / nullif(sum(shots), 0) — a ratio
    of sums, never an average of ratios; both raw and rounded forms."""
    pg = Bed(spark, root).player_games()
    t = pg.groupBy("season", "team").agg(F.sum("goals").alias("goals"), F.sum("shots").alias("shots"),
                                         F.sum("pim").alias("pim"))
    return t.select("season", "team", "goals", "shots",
                    X.safe_divide("goals", "shots").alias("shooting_pct_raw"),
                    X.round_ratio(F.col("goals") * 100, "shots", 2).alias("shooting_pct"),
                    X.safe_divide("pim", "goals").alias("pim_per_goal"))


register("ratio_of_sums", sql("""
, t AS (SELECT season, team, CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(shots) AS BIGINT) AS shots,
               CAST(sum(pim) AS BIGINT) AS pim FROM player_games GROUP BY 1, 2)
SELECT season, team, goals, shots, CAST(goals AS DOUBLE) / nullif(CAST(shots AS DOUBLE), 0) AS shooting_pct_raw,
       """ + rr("goals * 100", "shots") + """ AS shooting_pct,
       CAST(pim AS DOUBLE) / nullif(CAST(goals AS DOUBLE), 0) AS pim_per_goal
FROM t"""))(ratio_of_sums)


def rate_per_unit(spark: SparkSession, root: str) -> DataFrame:
    """Per-60 rates, round(sum * 3600 / nullif(seconds, 0), 2)."""
    t = season_totals_df(Bed(spark, root))
    return t.select("season", "player", "toi_seconds",
                    X.round_ratio(F.col("goals") * 3600, "toi_seconds", 2).alias("goals_per_60"),
                    X.round_ratio(F.col("points") * 3600, "toi_seconds", 2).alias("points_per_60"),
                    X.round_ratio(F.col("pim") * 3600, "toi_seconds", 2).alias("pim_per_60"))


register("rate_per_unit", sql(_TOT_SQL + "SELECT season, player, toi_seconds, " +
                              ", ".join(f"{rr(c, 'toi_seconds', 2, 3600)} AS {c}_per_60"
                                        for c in ("goals", "points", "pim")) + " FROM totals"))(rate_per_unit)


_COUNTED = {"players": "player", "games": "game_id", "teams": "team"}


def distinct_counts(spark: SparkSession, root: str) -> DataFrame:
    """Exact distinct players, games and teams per season, from bitmaps."""
    maps = D.bitmaps(Bed(spark, root).player_games(), ["season"], _COUNTED)
    return D.counts(maps, ["season"], list(_COUNTED))


register("distinct_counts", sql("""
SELECT season, count(DISTINCT player) AS players, count(DISTINCT game_id) AS games,
       count(DISTINCT team) AS teams FROM player_games GROUP BY season"""))(distinct_counts)


def distinct_counts_merged(spark: SparkSession, root: str) -> DataFrame:
    """The bitmaps kept per season and game type, merged to seasons and to all seasons
    (-1): a player of two seasons counts once in the total."""
    kept = D.bitmaps(Bed(spark, root).player_games(), ["season", "game_type"], _COUNTED)
    kept = cut_lineage(kept)                              # as a closed season's table would be
    names = list(_COUNTED)
    season = D.counts(D.merge(kept, ["season"]), ["season"], names)
    return season.unionByName(D.counts(D.merge(kept), [], names).withColumn("season", F.lit(-1)))


register("distinct_counts_merged", sql("""
SELECT coalesce(season, -1) AS season, count(DISTINCT player) AS players, count(DISTINCT game_id) AS games,
       count(DISTINCT team) AS teams FROM player_games GROUP BY GROUPING SETS ((season), ())"""))(distinct_counts_merged)


def distinct_pairs(spark: SparkSession, root: str) -> DataFrame:
    """Players history — distinct (player, team, season) triples."""
    return Bed(spark, root).player_games().select("player", "team", "season").distinct()


register("distinct_pairs", sql("SELECT DISTINCT player, team, season FROM player_games"))(distinct_pairs)


def season_dimension(spark: SparkSession, root: str) -> DataFrame:
    """Conditional counts and conditional min/max per season (games are
    unique by id, so only the teams need a distinct count)."""
    g = Bed(spark, root).games()
    reg, po = F.col("game_type") == 2, F.col("game_type") == 3
    d = g.groupBy("season").agg(
        F.count_if(reg).alias("regular_games"), F.count_if(po).alias("playoff_games"),
        F.min(F.when(reg, F.col("game_date"))).alias("regular_start"),
        F.max(F.when(reg, F.col("game_date"))).alias("regular_end"),
        F.min(F.when(po, F.col("game_date"))).alias("playoff_start"),
        F.max(F.when(po, F.col("game_date"))).alias("playoff_end"),
        F.count_distinct("home_team").alias("teams"))
    key = X.season_key_from_year("season")
    return d.select("*", key.alias("season_key"), X.season_display(key).alias("season_display"),
                    (F.datediff("regular_end", "regular_start") + 1).alias("regular_days"),
                    (F.col("regular_games") < 1230).alias("is_shortened"))


register("season_dimension", sql("""
, d AS (
  SELECT season,
         count(DISTINCT CASE WHEN game_type = 2 THEN game_id END) AS regular_games,
         count(DISTINCT CASE WHEN game_type = 3 THEN game_id END) AS playoff_games,
         min(CASE WHEN game_type = 2 THEN game_date END) AS regular_start,
         max(CASE WHEN game_type = 2 THEN game_date END) AS regular_end,
         min(CASE WHEN game_type = 3 THEN game_date END) AS playoff_start,
         max(CASE WHEN game_type = 3 THEN game_date END) AS playoff_end,
         count(DISTINCT home_team) AS teams
  FROM games GROUP BY season)
SELECT *, season * 10000 + season + 1 AS season_key,
       CAST(season AS VARCHAR) || '-' || substr(CAST(season + 1 AS VARCHAR), 3, 2) AS season_display,
       CAST(date_diff('day', regular_start, regular_end) + 1 AS INTEGER) AS regular_days,
       regular_games < 1230 AS is_shortened
FROM d"""))(season_dimension)


def share_of_group(spark: SparkSession, root: str) -> DataFrame:
    """Per (game, side) line counts and their share of the game total
    — ``sum(count(*)) over (partition by game)``."""
    from seasonflow.plans.league import side_lines
    s = side_lines(Bed(spark, root)).select("game_id", "team", "is_home", "shots")
    w = Window.partitionBy("game_id")
    return s.select("*", F.sum("shots").over(w).alias("game_shots"),
                    X.round_ratio("shots", F.sum("shots").over(w), 4).alias("shot_share"))


register("share_of_group", sql("""
, sl AS (
  SELECT game_id, (l_linenumber % 2 = 1) AS is_home,
         CASE WHEN l_linenumber % 2 = 1 THEN home_team ELSE away_team END AS team, count(*) AS shots
  FROM lineitem JOIN universe ON l_orderkey = game_id GROUP BY ALL)
SELECT sl.*, CAST(g.total AS BIGINT) AS game_shots, """ + rr("shots", "g.total", 4) + """ AS shot_share
FROM sl JOIN (SELECT game_id, sum(shots) AS total FROM sl GROUP BY game_id) g USING (game_id)
"""))(share_of_group)


# ---------------------------------------------------------------- dashboard
def skater_detail_table(spark: SparkSession, root: str) -> DataFrame:
    """Totals left-joined to the player and team dimensions, breakout of
    (season, team, player), 12 measures incl. avg(toi / 60) (A21), not-null filter."""
    bed = Bed(spark, root)
    pg = bed.player_games().filter(F.col("game_type") == 2)
    teams = bed.teams().select("team", "team_name", "conference")
    j = pg.join(teams, "team", "left").filter(F.col("team_name").isNotNull())
    t = j.groupBy("season", "team_name", "player").agg(
        F.count(F.lit(1)).alias("gp"), F.sum("goals").alias("goals"), F.sum("assists").alias("assists"),
        F.sum("points").alias("points"), F.sum("shots").alias("shots"), F.sum("pim").alias("pim"),
        F.max("points").alias("best_game_points"), F.min("toi_seconds").alias("min_toi"),
        F.max("toi_seconds").alias("max_toi"), F.count_if(F.col("goals") >= 3).alias("hat_tricks"),
        F.sum("toi_seconds").alias("__toi"),
        F.count_distinct("game_date").alias("game_days"))
    # avg(toi / 60) == sum(toi) / (60 * n), divided exactly once
    return t.withColumn("avg_toi_min", X.round_ratio("__toi", F.col("gp") * 60, 4)).drop("__toi")


register("skater_detail_table", sql("""
SELECT season, team_name, player, count(*) AS gp, CAST(sum(goals) AS BIGINT) AS goals,
       CAST(sum(assists) AS BIGINT) AS assists, CAST(sum(points) AS BIGINT) AS points,
       CAST(sum(shots) AS BIGINT) AS shots, CAST(sum(pim) AS BIGINT) AS pim, max(points) AS best_game_points,
       min(toi_seconds) AS min_toi, max(toi_seconds) AS max_toi, count_if(goals >= 3) AS hat_tricks,
       """ + rr("sum(toi_seconds)", "count(*) * 60", 4) + """ AS avg_toi_min,
       count(DISTINCT game_date) AS game_days
FROM player_games LEFT JOIN teams USING (team)
WHERE game_type = 2 AND team_name IS NOT NULL GROUP BY ALL"""))(skater_detail_table)


def player_compare(spark: SparkSession, root: str) -> DataFrame:
    """``sum(toi) / count(distinct game) / 60`` per player and season; the
    lines are unique per (game, player), so counting rows counts games."""
    pg = Bed(spark, root).player_games()
    t = pg.groupBy("season", "player").agg(F.sum("toi_seconds").alias("toi"), F.count(F.lit(1)).alias("games"))
    return t.select("season", "player", "games",
                    X.round_ratio("toi", F.col("games") * 60, 2).alias("toi_min_per_game"))


register("player_compare", sql("""
, t AS (SELECT season, player, sum(toi_seconds) AS toi, count(DISTINCT game_id) AS games
        FROM player_games GROUP BY 1, 2)
SELECT season, player, games, """ + rr("toi", "games * 60") + """ AS toi_min_per_game FROM t"""))(player_compare)


def efficiency_scatter(spark: SparkSession, root: str) -> DataFrame:
    """Computed-column filter (TOI minutes > 30) and GP > 2."""
    t = season_totals_df(Bed(spark, root))
    t = t.withColumn("toi_min", X.round_ratio("toi_seconds", F.lit(60), 1))
    return (t.filter((F.col("toi_min") > 30) & (F.col("gp") > 2))
             .select("season", "player", "gp", "toi_min",
                     X.round_ratio(F.col("points") * 3600, "toi_seconds", 2).alias("points_per_60")))


register("efficiency_scatter", sql(_TOT_SQL + """
, e AS (SELECT *, """ + rr("toi_seconds", "60", 1) + """ AS toi_min FROM totals)
SELECT season, player, gp, toi_min, """ + rr("points", "toi_seconds", 2, 3600) + """ AS points_per_60
FROM e WHERE toi_min > 30 AND gp > 2"""))(efficiency_scatter)


def scalar_stat(spark: SparkSession, root: str) -> DataFrame:
    """Scalar lookup by season — the league's goals per game, one value per season."""
    pg = Bed(spark, root).player_games().filter(F.col("game_type") == 2)
    t = pg.groupBy("season").agg(F.sum("goals").alias("g"), F.count_distinct("game_id").alias("n"))
    return t.select("season", X.round_ratio("g", "n", 2).alias("goals_per_game"))


register("scalar_stat", sql("""
, t AS (SELECT season, sum(goals) AS g, count(DISTINCT game_id) AS n FROM player_games
        WHERE game_type = 2 GROUP BY season)
SELECT season, """ + rr("g", "n") + """ AS goals_per_game FROM t"""))(scalar_stat)
