"""Game-sequence family: partition counts, leaderboards, decisive event, score
state, last-N form, goalie game line (W12–W14, T02, T03; M38, M39, M42, M44
step 5, M56; C02, C07)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonflow.functions import exprs as X
from seasonflow.operators import joins as J
from seasonflow.operators import ranking as R
from seasonflow.operators import windows as W
from seasonflow.operators.reshape import unpivot_structs
from seasonflow.plans.aggregates import season_totals_df
from seasonflow.plans.registry import register, rr, sql
from seasonflow.plans.testbed import Bed


def partition_counts(spark: SparkSession, root: str) -> DataFrame:
    """Per row, the player's appearances and scoring games that season."""
    pg = Bed(spark, root).player_games().select("season", "game_id", "player", "goals")
    return W.partition_counts(pg, ["season", "player"],
                              {"season_games": None, "season_scoring_games": F.col("goals") > 0})


register("partition_counts", sql("""
SELECT season, game_id, player, goals, count(*) OVER (PARTITION BY season, player) AS season_games,
       count_if(goals > 0) OVER (PARTITION BY season, player) AS season_scoring_games
FROM player_games
"""))(partition_counts)


def _latest_totals(bed: Bed) -> DataFrame:
    return J.keep_max(season_totals_df(bed), "season")


def top_k_leaders(spark: SparkSession, root: str) -> DataFrame:
    """Top-5 point leaders of the latest season (id breaks ties) —
    planned as TakeOrderedAndProject (k rows per task)."""
    t = _latest_totals(Bed(spark, root))
    return R.top_k(t.select("season", "player", "player_name", "points", "goals", "assists"), 5,
                   [F.col("points").desc(), F.col("player").asc()])


register("top_k_leaders", sql("""
, t AS (SELECT season, player, min(player_name) AS player_name, CAST(sum(points) AS BIGINT) AS points,
               CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(assists) AS BIGINT) AS assists
        FROM player_games WHERE game_type = 2 GROUP BY 1, 2)
SELECT * FROM t WHERE season = (SELECT max(season) FROM t) ORDER BY points DESC, player LIMIT 5
"""))(top_k_leaders)


# Fixed values of the leaderboard card: minimum workload 100 shots; two
# excluded names.
EXCLUDED_NAMES = ("Supplier#000000001", "Supplier#000000002")


def top_k_qualified(spark: SparkSession, root: str) -> DataFrame:
    """Top-5 shooting pct among players with >= 100 shots, names not in a list."""
    t = _latest_totals(Bed(spark, root))
    t = t.filter((F.col("shots") >= 100) & ~F.col("player_name").isin(*EXCLUDED_NAMES))
    t = t.select("season", "player", "player_name", "goals", "shots",
                 X.safe_divide("goals", "shots").alias("__pct"),
                 X.round_ratio("goals", "shots", 3).alias("shooting_pct"))
    return R.top_k(t, 5, [F.col("__pct").desc(), F.col("player").asc()]).drop("__pct")


register("top_k_qualified", sql("""
, t AS (SELECT season, player, min(player_name) AS player_name, CAST(sum(goals) AS BIGINT) AS goals,
               CAST(sum(shots) AS BIGINT) AS shots
        FROM player_games WHERE game_type = 2 GROUP BY 1, 2)
SELECT season, player, player_name, goals, shots, """ + rr("goals", "shots", 3) + """ AS shooting_pct
FROM t WHERE season = (SELECT max(season) FROM t) AND shots >= 100
  AND player_name NOT IN ('Supplier#000000001', 'Supplier#000000002')
ORDER BY CAST(goals AS DOUBLE) / CAST(shots AS DOUBLE) DESC, player LIMIT 5
"""))(top_k_qualified)


# ------------------------------------------------------------ goal events
def goal_events(bed: Bed) -> DataFrame:
    """Each line of a league game is a goal: side from the line number parity,
    scorer = supplier, elapsed order = (ship date, line number, part, supplier),
    period = 1 for lines 1-2, 2 for 3-4, 3 after."""
    li = bed.t("lineitem", "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")
    u = bed.universe().select("game_id")
    g = li.join(u, li.l_orderkey == u.game_id, "left_semi")
    return g.select(F.col("l_orderkey").alias("game_id"),
                    ((F.col("l_linenumber") % 2) == 1).alias("is_home"),
                    F.col("l_suppkey").alias("scorer"),
                    F.col("l_shipdate").cast("date").alias("t_date"), F.col("l_linenumber").alias("t_line"),
                    F.col("l_partkey").alias("t_part"),
                    F.when(F.col("l_linenumber") <= 2, 1).when(F.col("l_linenumber") <= 4, 2)
                     .otherwise(3).alias("period"))


_GOALS_SQL = """
, goals_ev AS (
  SELECT l_orderkey AS game_id, (l_linenumber % 2 = 1) AS is_home, l_suppkey AS scorer,
         CAST(l_shipdate AS DATE) AS t_date, l_linenumber AS t_line, l_partkey AS t_part,
         CASE WHEN l_linenumber <= 2 THEN 1 WHEN l_linenumber <= 4 THEN 2 ELSE 3 END AS period
  FROM lineitem WHERE l_orderkey IN (SELECT game_id FROM universe))
"""
_ORDER = ["t_date", "t_line", "t_part", "scorer"]


def decisive_event(spark: SparkSession, root: str) -> DataFrame:
    """The game-winning goal is the winner's (loser total + 1)-th goal."""
    ev = goal_events(Bed(spark, root))
    seq = W.nth_in_group(ev, ["game_id", "is_home"], [F.col(c) for c in _ORDER], "goal_number")
    tot = ev.groupBy("game_id").agg(F.count_if("is_home").alias("home_goals"),
                                    F.count_if(~F.col("is_home")).alias("away_goals"))
    win = tot.filter(F.col("home_goals") != F.col("away_goals")).select(
        "game_id", (F.col("home_goals") > F.col("away_goals")).alias("is_home"),
        F.least("home_goals", "away_goals").alias("loser_goals"))
    return (seq.join(win, ["game_id", "is_home"], "inner")
               .filter(F.col("goal_number") == F.col("loser_goals") + 1)
               .select("game_id", "is_home", F.col("scorer").alias("gwg_scorer"), "goal_number", "period"))


register("decisive_event", sql(_GOALS_SQL + """
, seq AS (SELECT *, row_number() OVER (PARTITION BY game_id, is_home ORDER BY t_date, t_line, t_part, scorer) AS goal_number
          FROM goals_ev)
, tot AS (SELECT game_id, count_if(is_home) AS hg, count_if(NOT is_home) AS ag FROM goals_ev GROUP BY game_id)
SELECT s.game_id, s.is_home, s.scorer AS gwg_scorer, CAST(s.goal_number AS INTEGER) AS goal_number, s.period
FROM seq s JOIN tot t ON s.game_id = t.game_id
WHERE t.hg <> t.ag AND s.is_home = (t.hg > t.ag) AND s.goal_number = least(t.hg, t.ag) + 1
"""))(decisive_event)


def score_state(spark: SparkSession, root: str) -> DataFrame:
    """Per (game, side) result, first-goal flag (min_by over the elapsed
    order), leads after periods 1 and 2, comeback win."""
    ev = goal_events(Bed(spark, root))
    order = F.struct(*[F.col(c) for c in _ORDER])
    per = ev.groupBy("game_id").agg(
        F.count_if("is_home").alias("hg"), F.count_if(~F.col("is_home")).alias("ag"),
        F.min_by("is_home", order).alias("first_home"),
        F.count_if(F.col("is_home") & (F.col("period") <= 1)).alias("h1"),
        F.count_if(~F.col("is_home") & (F.col("period") <= 1)).alias("a1"),
        F.count_if(F.col("is_home") & (F.col("period") <= 2)).alias("h2"),
        F.count_if(~F.col("is_home") & (F.col("period") <= 2)).alias("a2"))
    names = ("gf", "ga", "f1", "x1", "f2", "x2")
    home = dict(zip(names, ("hg", "ag", "h1", "a1", "h2", "a2")))
    away = dict(zip(names, ("ag", "hg", "a1", "h1", "a2", "h2")))
    sides = unpivot_structs(per, ["game_id", "first_home"],
                            [{"is_home": F.lit(True), **home}, {"is_home": F.lit(False), **away}])
    win = F.col("gf") > F.col("ga")
    return sides.select(
        "game_id", "is_home", "gf", "ga",
        F.when(win, "W").when(F.col("gf") < F.col("ga"), "L").otherwise("T").alias("result"),
        (F.col("first_home") == F.col("is_home")).alias("scored_first"),
        (F.col("f1") > F.col("x1")).alias("led_after_p1"),
        (F.col("f2") > F.col("x2")).alias("led_after_p2"),
        (win & ((F.col("f1") < F.col("x1")) | (F.col("f2") < F.col("x2")))).alias("comeback_win"))


register("score_state", sql(_GOALS_SQL + """
, firsts AS (SELECT game_id, is_home AS first_home FROM (
    SELECT game_id, is_home, row_number() OVER (PARTITION BY game_id ORDER BY t_date, t_line, t_part, scorer) AS rn
    FROM goals_ev) WHERE rn = 1)
, sides2 AS (SELECT DISTINCT game_id, b AS is_home FROM goals_ev, (VALUES (true), (false)) v(b))
, agg AS (
  SELECT s.game_id, s.is_home,
         (SELECT count(*) FROM goals_ev e WHERE e.game_id = s.game_id AND e.is_home = s.is_home) AS gf,
         (SELECT count(*) FROM goals_ev e WHERE e.game_id = s.game_id AND e.is_home <> s.is_home) AS ga,
         (SELECT count(*) FROM goals_ev e WHERE e.game_id = s.game_id AND e.is_home = s.is_home AND period = 1) AS f1,
         (SELECT count(*) FROM goals_ev e WHERE e.game_id = s.game_id AND e.is_home <> s.is_home AND period = 1) AS x1,
         (SELECT count(*) FROM goals_ev e WHERE e.game_id = s.game_id AND e.is_home = s.is_home AND period <= 2) AS f2,
         (SELECT count(*) FROM goals_ev e WHERE e.game_id = s.game_id AND e.is_home <> s.is_home AND period <= 2) AS x2
  FROM sides2 s)
SELECT a.game_id, a.is_home, gf, ga, CASE WHEN gf > ga THEN 'W' WHEN gf < ga THEN 'L' ELSE 'T' END AS result,
       f.first_home = a.is_home AS scored_first, f1 > x1 AS led_after_p1, f2 > x2 AS led_after_p2,
       gf > ga AND (f1 < x1 OR f2 < x2) AS comeback_win
FROM agg a JOIN firsts f USING (game_id)
"""))(score_state)


def last_n_form(spark: SparkSession, root: str) -> DataFrame:
    """W14 / M44 step 5: each team's last five games (newest first, id breaks
    ties) aggregated to wins, losses and goal difference."""
    s = Bed(spark, root).sides()
    last5 = W.last_n(s, ["team"], [F.col("game_date").desc(), F.col("game_id").desc()], 5)
    return last5.groupBy("team").agg(
        F.count(F.lit(1)).alias("games"),
        F.count_if(F.col("goals_for") > F.col("goals_against")).alias("wins"),
        F.count_if(F.col("goals_for") < F.col("goals_against")).alias("losses"),
        F.sum(F.col("goals_for") - F.col("goals_against")).alias("goal_diff"))


register("last_n_form", sql("""
, r AS (SELECT *, row_number() OVER (PARTITION BY team ORDER BY game_date DESC, game_id DESC) AS rn FROM sides)
SELECT team, count(*) AS games, count_if(goals_for > goals_against) AS wins,
       count_if(goals_for < goals_against) AS losses, CAST(sum(goals_for - goals_against) AS BIGINT) AS goal_diff
FROM r WHERE rn <= 5 GROUP BY team
"""))(last_n_form)


# ---------------------------------------------------------- goalie line
def goalie_game_line(spark: SparkSession, root: str) -> DataFrame:
    """Keeper line per (game, player) — saves, save pct, GA per 60, sole
    keeper shutout (window count of keepers with time), tier, starter / relief,
    quality and bad starts, saves above the league average (0.910)."""
    pg = Bed(spark, root).player_games().select(
        "game_id", "player", "season", F.col("shots").alias("shots_against"),
        F.col("goals").alias("goals_against"),
        F.when(F.col("pim") > 0, F.lit(0)).otherwise(F.col("toi_seconds")).alias("toi"))
    w = Window.partitionBy("game_id")
    g = pg.select("*", F.count_if(F.col("toi") > 0).over(w).alias("keepers_used"),
                  (F.col("player") == F.min("player").over(w)).alias("starter"))
    saves = F.col("shots_against") - F.col("goals_against")
    sa = F.col("shots_against")

    def pct_at_least(num, den):   # saves / shots >= num / den, exactly
        return (sa > 0) & (saves * den >= sa * num)
    tier = (F.when(pct_at_least(950, 1000), "Elite").when(pct_at_least(920, 1000), "Excellent")
             .when(pct_at_least(900, 1000), "Good").when(pct_at_least(880, 1000), "Average").otherwise("Below Average"))
    avg = F.lit(Decimal("0.910")).cast("decimal(4,3)")
    return g.select(
        "game_id", "player", "season", "shots_against", "goals_against", saves.alias("saves"), "toi",
        X.round_ratio(saves, sa, 3).alias("save_pct"),
        F.coalesce(X.round_ratio(F.col("goals_against") * 3600, "toi", 2), F.lit(0.0)).alias("ga_per_60"),
        ((F.col("goals_against") == 0) & (F.col("toi") > 0) & (F.col("keepers_used") == 1)).alias("is_shutout"),
        tier.alias("save_tier"), "starter",
        (~F.col("starter") & (F.col("toi") > 0)).alias("is_relief"),
        (F.col("starter") & pct_at_least(917, 1000) & (F.col("goals_against") <= 2)).alias("quality_start"),
        (F.col("starter") & (sa > 0) & ~pct_at_least(850, 1000)).alias("bad_start"),
        F.round(saves - sa * avg, 1).cast("double").alias("saves_above_avg"))


register("goalie_game_line", sql("""
, g AS (SELECT game_id, player, season, shots AS shots_against, goals AS goals_against,
               CASE WHEN pim > 0 THEN 0 ELSE toi_seconds END AS toi FROM player_games)
, k AS (SELECT g.*, (SELECT count(*) FROM g g2 WHERE g2.game_id = g.game_id AND g2.toi > 0) AS keepers_used,
               player = (SELECT min(player) FROM g g2 WHERE g2.game_id = g.game_id) AS starter FROM g)
SELECT game_id, player, season, shots_against, goals_against, shots_against - goals_against AS saves, toi,
       """ + rr("shots_against - goals_against", "shots_against", 3) + """ AS save_pct,
       coalesce(""" + rr("goals_against", "toi", 2, 3600) + """, 0.0) AS ga_per_60,
       goals_against = 0 AND toi > 0 AND keepers_used = 1 AS is_shutout,
       CASE WHEN shots_against > 0 AND (shots_against - goals_against) * 1000 >= shots_against * 950 THEN 'Elite'
            WHEN shots_against > 0 AND (shots_against - goals_against) * 1000 >= shots_against * 920 THEN 'Excellent'
            WHEN shots_against > 0 AND (shots_against - goals_against) * 1000 >= shots_against * 900 THEN 'Good'
            WHEN shots_against > 0 AND (shots_against - goals_against) * 1000 >= shots_against * 880 THEN 'Average'
            ELSE 'Below Average' END AS save_tier,
       starter, NOT starter AND toi > 0 AS is_relief,
       starter AND shots_against > 0 AND (shots_against - goals_against) * 1000 >= shots_against * 917
         AND goals_against <= 2 AS quality_start,
       starter AND shots_against > 0 AND NOT ((shots_against - goals_against) * 1000 >= shots_against * 850) AS bad_start,
       CAST(round((shots_against - goals_against) - shots_against * 0.910, 1) AS DOUBLE) AS saves_above_avg
FROM k
"""))(goalie_game_line)
