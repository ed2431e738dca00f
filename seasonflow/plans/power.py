"""Composite power score (M44 / M52) and its building blocks: latest and
previous period, previous final ranking with playoff carry-over, opponent
strength, min-max scaling, games-played blend, weighted composite (J08, J16,
W11, W14, W18, W19, A19).

All frames after the first aggregation are at (team) grain — bounded by the
league size — so the global windows and the one-row min/max broadcast never
see fact-grain data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.operators import joins as J
from seasonflow.plans import power_model as PM
from seasonflow.plans.registry import register, rr, sql
from seasonflow.plans.testbed import Bed


def written_team_games(bed: Bed) -> DataFrame:
    """The standard team-game table for models that read it many times."""
    return bed.written("team_games")


def team_games(bed: Bed) -> DataFrame:
    """The standard team-game table bound to the test tables (materialised by the bed)."""
    return bed.team_games()


def result_games(bed: Bed) -> DataFrame:
    """Games with results and points only, for models that need no line counts (a
    left join to them would not be pruned)."""
    return bed.results()


def latest_period_filter(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the latest season via a broadcast one-row global max."""
    return J.keep_max(Bed(spark, root).sides(), "season")


register("latest_period_filter", sql("""
SELECT * FROM sides WHERE season = (SELECT max(season) FROM sides)
"""))(latest_period_filter)


_PREV_SQL = """
, sc AS (SELECT max(season) AS cur_season, (SELECT max(season) FROM sides s2
                                             WHERE s2.season < (SELECT max(season) FROM sides)) AS prev_season FROM sides)
, ptab AS (SELECT team, count(*) AS gp, count_if(goals_for > goals_against) AS wins,
                  count_if(goals_for = goals_against) AS ties, sum(goals_for) AS gf, sum(goals_against) AS ga
           FROM sides WHERE game_type = 2 AND season = (SELECT prev_season FROM sc) GROUP BY team)
, ppo AS (SELECT team, count(*) AS p_gp, count_if(goals_for > goals_against) AS p_wins,
                 CAST(count_if(goals_for > goals_against) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS p_win_pct,
                 CAST(sum(goals_for) - sum(goals_against) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS p_gd_pg
          FROM sides WHERE game_type = 3 AND season = (SELECT prev_season FROM sc) GROUP BY team)
, pr AS (SELECT *, CAST(wins * 2 + ties AS DOUBLE) / CAST(gp * 2 AS DOUBLE) AS pct FROM ptab)
, prk AS (SELECT *, CAST(row_number() OVER (ORDER BY pct DESC, wins DESC, gf - ga DESC, team) AS INTEGER) AS final_rank FROM pr)
, prev AS (
  SELECT team, gp, wins, pct, final_rank,
         100.0::DOUBLE * CAST(32 - final_rank AS DOUBLE) / 31.0::DOUBLE AS rank100,
         coalesce(p_gp, 0) AS playoff_games,
         CASE WHEN p_wins >= 12 THEN 4 WHEN p_wins >= 8 THEN 3 WHEN p_wins >= 4 THEN 2 WHEN p_gp > 0 THEN 1 ELSE 0 END
           AS playoff_round_reached,
         CASE WHEN p_gp > 0 THEN
              (100.0::DOUBLE * CAST(32 - final_rank AS DOUBLE) / 31.0::DOUBLE) * 0.5::DOUBLE
              + ((CAST(p_wins AS DOUBLE) / 16.0::DOUBLE) * 100.0::DOUBLE * 0.6::DOUBLE
                 + p_win_pct * 100.0::DOUBLE * 0.2::DOUBLE
                 + (p_gd_pg + 2.0::DOUBLE) * 10.0::DOUBLE * 0.2::DOUBLE) * 0.5::DOUBLE
              ELSE (100.0::DOUBLE * CAST(32 - final_rank AS DOUBLE) / 31.0::DOUBLE) * 0.8::DOUBLE END AS prev_power_score
  FROM prk LEFT JOIN ppo USING (team))
"""


def previous_period_final(spark: SparkSession, root: str) -> DataFrame:
    """W19 + playoff carry-over for the previous season."""
    return PM.previous_final(result_games(Bed(spark, root)))


register("previous_period_final", sql(_PREV_SQL + "SELECT * FROM prev"))(previous_period_final)


# ------------------------------------------------------- opponent strength
def opponent_strength(spark: SparkSession, root: str) -> DataFrame:
    """Mean opponent points share per (season, team), exact to 4 decimals."""
    return PM.opponent_strength(result_games(Bed(spark, root)))


_OPP_SQL = """
, otab AS (SELECT season, team, count(*) AS gp,
                  sum(CASE WHEN goals_for > goals_against THEN 2 WHEN goals_for = goals_against THEN 1 ELSE 0 END) AS pts
           FROM sides WHERE game_type = 2 GROUP BY 1, 2)
, oshare AS (SELECT season, team AS opponent, """ + rr("pts * 10000", "gp * 2", 0) + """ AS e4 FROM otab)
, ostr AS (SELECT s.season, s.team, sum(CAST(e4 AS BIGINT)) AS se, count(*) AS n
           FROM sides s JOIN oshare o ON s.season = o.season AND s.opponent = o.opponent GROUP BY 1, 2)
, opp AS (SELECT season, team, """ + rr("se", "n * 10000", 4) + """ AS opponent_avg_points_pct FROM ostr)
"""
register("opponent_strength", sql(_OPP_SQL + "SELECT * FROM opp"))(opponent_strength)


_METRICS = PM.METRICS


_CUR_SQL = _PREV_SQL + _OPP_SQL + """
, cs AS (SELECT * FROM sides WHERE season = (SELECT cur_season FROM sc))
, creg AS (SELECT team, count(*) AS gp, count_if(goals_for > goals_against) AS wins,
                  count_if(goals_for < goals_against) AS losses, count_if(goals_for = goals_against) AS ties,
                  sum(goals_for) AS gf, sum(goals_against) AS ga FROM cs WHERE game_type = 2 GROUP BY team)
, clines AS (SELECT CASE WHEN l_linenumber % 2 = 1 THEN home_team ELSE away_team END AS team,
                    count(*) AS shots, count_if(l_discount >= 0.05) AS pp_goals, count_if(l_returnflag = 'R') AS sh
             FROM lineitem JOIN universe ON l_orderkey = game_id
             WHERE season = (SELECT cur_season FROM sc) AND game_type = 2 GROUP BY 1)
, crn AS (SELECT *, row_number() OVER (PARTITION BY team ORDER BY game_date DESC, game_id DESC) AS rn FROM cs)
, cl10 AS (SELECT team, sum(CASE WHEN goals_for > goals_against THEN 2 WHEN goals_for = goals_against THEN 1 ELSE 0 END) AS l10_pts,
                  count(*) AS l10_n
           FROM (SELECT *, row_number() OVER (PARTITION BY team ORDER BY game_date DESC, game_id DESC) AS back FROM cs WHERE game_type = 2)
           WHERE back <= 10 GROUP BY team)
, cl5 AS (SELECT team, count_if(goals_for > goals_against) AS r_w, count_if(goals_for < goals_against) AS r_l,
                 count(*) AS r_n, sum(goals_for - goals_against) AS recent_gd FROM crn WHERE rn <= 5 GROUP BY team)
, cur AS (
  SELECT team, gp, wins, losses,
         CAST(wins * 2 + ties AS DOUBLE) / CAST(gp * 2 AS DOUBLE) AS points_pct,
         CAST(gf AS DOUBLE) / CAST(gp AS DOUBLE) AS goals_for_pg, CAST(ga AS DOUBLE) / CAST(gp AS DOUBLE) AS goals_against_pg,
         CAST(gf - ga AS DOUBLE) / CAST(gp AS DOUBLE) AS goal_diff_pg, CAST(shots AS DOUBLE) / CAST(gp AS DOUBLE) AS shots_pg,
         CAST(pp_goals AS DOUBLE) / nullif(CAST(shots AS DOUBLE), 0) AS pp_pct,
         CAST(shots - sh AS DOUBLE) / nullif(CAST(shots AS DOUBLE), 0) AS pk_pct,
         opp.opponent_avg_points_pct AS sos, CAST(l10_pts AS DOUBLE) / CAST(l10_n * 2 AS DOUBLE) AS last10_pct,
         CAST(recent_gd AS DOUBLE) AS recent_gd, CAST(r_w - r_l AS DOUBLE) / CAST(r_n AS DOUBLE) AS trend
  FROM creg LEFT JOIN clines USING (team) LEFT JOIN cl10 USING (team) LEFT JOIN cl5 USING (team)
       LEFT JOIN (SELECT * FROM opp WHERE season = (SELECT cur_season FROM sc)) opp USING (team))
"""


def _scale_sql(c: str, invert: bool) -> str:
    num = f"(max({c}) OVER () - {c})" if invert else f"({c} - min({c}) OVER ())"
    return (f"coalesce({num} / nullif(max({c}) OVER () - min({c}) OVER (), 0) * 100.0::DOUBLE, 50.0::DOUBLE)"
            f" AS {c}_scaled")


_SCALED_SQL = _CUR_SQL + """
, scaled AS (SELECT *, """ + ", ".join(_scale_sql(c, c == "goals_against_pg") for c in _METRICS) + """,
                    coalesce((trend + 1.0::DOUBLE) * 50.0::DOUBLE, 50.0::DOUBLE) AS trend_scaled FROM cur)
"""


def minmax_normalize(spark: SparkSession, root: str) -> DataFrame:
    """Ten metrics min-max scaled to 0-100 over the league (goals against
    inverted); zero range or NULL -> 50."""
    return PM.scaled(written_team_games(Bed(spark, root)))


register("minmax_normalize", sql(_SCALED_SQL + "SELECT * FROM scaled"))(minmax_normalize)


def weighted_blend(spark: SparkSession, root: str) -> DataFrame:
    """M44 step 8: weight of the current season grows linearly with games / 20;
    blended points = cw * current + pw * previous (previous default 50)."""
    b = PM.blended(written_team_games(Bed(spark, root)))
    return b.select("team", "gp", "current_weight", "previous_weight", "prev_score",
                    (F.col("points_pct_scaled") * F.col("current_weight")
                     + F.col("prev_points_scaled") * F.col("previous_weight")).alias("blended_points"))


_BLEND_SQL = _SCALED_SQL + """
, prevs AS (SELECT team, prev_power_score, playoff_round_reached,
                   coalesce((pct - min(pct) OVER ()) / nullif(max(pct) OVER () - min(pct) OVER (), 0) * 100.0::DOUBLE,
                            50.0::DOUBLE) AS prev_pct_scaled FROM prev)
, blended AS (
  SELECT s.*, p.prev_power_score,
         CASE WHEN gp >= 20 THEN 1.0::DOUBLE WHEN gp = 0 THEN 0.0::DOUBLE ELSE CAST(gp AS DOUBLE) / 20.0::DOUBLE END AS current_weight,
         CASE WHEN gp >= 20 THEN 0.0::DOUBLE WHEN gp = 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - CAST(gp AS DOUBLE) / 20.0::DOUBLE END AS previous_weight,
         coalesce(p.prev_power_score, 50.0::DOUBLE) AS prev_score,
         p.playoff_round_reached AS prev_playoff_round,
         coalesce(p.prev_pct_scaled, 50.0::DOUBLE) AS prev_points_scaled
  FROM scaled s LEFT JOIN prevs p USING (team))
"""
register("weighted_blend", sql(_BLEND_SQL + """
SELECT team, gp, current_weight, previous_weight, prev_score,
       points_pct_scaled * current_weight + prev_points_scaled * previous_weight AS blended_points
FROM blended
"""))(weighted_blend)


def composite_score(spark: SparkSession, root: str) -> DataFrame:
    """M44 steps 9-11 / M52 / W18: five components with activation thresholds,
    final weights by games played, rank with team tie-break, rounded display."""
    return PM.composite(written_team_games(Bed(spark, root)))


def _mix_sql(w) -> str:
    return (f"points_component * {w[0]}::DOUBLE + goal_component * {w[1]}::DOUBLE + advanced_component * {w[2]}::DOUBLE"
            f" + schedule_component * {w[3]}::DOUBLE + momentum_component * {w[4]}::DOUBLE")


register("composite_score", sql(_BLEND_SQL + """
, comp AS (
  SELECT team, gp, current_weight, previous_weight, prev_score, prev_playoff_round,
         points_pct_scaled AS points_component,
         goal_diff_pg_scaled * 0.5::DOUBLE + goals_for_pg_scaled * 0.3::DOUBLE + goals_against_pg_scaled * 0.2::DOUBLE AS goal_component,
         CASE WHEN gp >= 5 THEN shots_pg_scaled * 0.4::DOUBLE + pp_pct_scaled * 0.3::DOUBLE + pk_pct_scaled * 0.3::DOUBLE
              ELSE 50.0::DOUBLE END AS advanced_component,
         CASE WHEN gp >= 5 THEN sos_scaled ELSE 50.0::DOUBLE END AS schedule_component,
         CASE WHEN gp >= 10 THEN last10_pct_scaled * 0.6::DOUBLE + recent_gd_scaled * 0.4::DOUBLE
              WHEN gp >= 5 THEN trend_scaled * 0.5::DOUBLE + recent_gd_scaled * 0.5::DOUBLE ELSE 50.0::DOUBLE END AS momentum_component
  FROM blended)
, fin AS (
  SELECT *, CASE WHEN gp = 0 THEN prev_score
                 WHEN gp < 5 THEN prev_score * previous_weight + (""" + _mix_sql((0.35, 0.30, 0.15, 0.10, 0.10)) + """) * current_weight
                 WHEN gp < 10 THEN prev_score * previous_weight + (""" + _mix_sql((0.32, 0.28, 0.18, 0.12, 0.10)) + """) * current_weight
                 WHEN gp < 20 THEN prev_score * previous_weight + (""" + _mix_sql((0.30, 0.25, 0.20, 0.15, 0.10)) + """) * current_weight
                 ELSE """ + _mix_sql((0.30, 0.25, 0.20, 0.15, 0.10)) + """ END AS power_score
  FROM comp)
SELECT *, CAST(row_number() OVER (ORDER BY power_score DESC, team) AS INTEGER) AS power_rank,
       round(power_score, 1) AS power_score_display,
       CASE prev_playoff_round WHEN 4 THEN 'Cup Finals' WHEN 3 THEN 'Conference Finals' WHEN 2 THEN 'Second Round'
            WHEN 1 THEN 'First Round' WHEN 0 THEN 'Missed Playoffs' END AS prev_playoff_label
FROM fin
"""))(composite_score)


def overtime_team_games(bed: Bed) -> DataFrame:
    """The team-game table with an overtime analogue: games with an id divisible by
    four went past regulation, where a loss still gives a point; level games, which
    a finished game never is, are left out."""
    g = bed.team_games().filter(F.col("goals_for") != F.col("goals_against"))
    return g.withColumn("points", F.when(F.col("goals_for") > F.col("goals_against"), 2)
                        .when(F.col("game_id") % 4 == 0, 1).otherwise(0))


def season_points_otl(spark: SparkSession, root: str) -> DataFrame:
    """The latest season's record, points = 2 W + OTL, points percentage, special
    teams and shooting to two decimals, and the league rank of points."""
    m = PM.season_metrics(overtime_team_games(Bed(spark, root)))
    return m.select("team", F.col("gp").alias("games_played"), "wins", "regulation_losses", "ot_losses", "points",
                    "points_pct", "power_play_pct", "penalty_kill_pct", "shooting_pct", "points_rank")


register("season_points_otl", sql(f"""
, tg AS (SELECT s.season, s.team, s.game_id, s.goals_for, s.goals_against, s.game_type, s.is_home
         FROM sides s WHERE s.goals_for <> s.goals_against)
, ln AS (SELECT l_orderkey AS game_id, l_linenumber % 2 = 1 AS is_home, count(*) AS shots,
                count_if(l_returnflag = 'R') AS sh, count_if(l_discount >= 0.05) AS pp
         FROM lineitem GROUP BY 1, 2)
, cur AS (SELECT tg.*, ln.shots, ln.sh, ln.pp FROM tg LEFT JOIN ln ON ln.game_id = tg.game_id AND ln.is_home = tg.is_home
          WHERE game_type = 2 AND season = (SELECT max(season) FROM tg))
, agg AS (SELECT team, count(*) AS games_played, count_if(goals_for > goals_against) AS wins,
                 count_if(goals_for < goals_against AND game_id % 4 <> 0) AS regulation_losses,
                 count_if(goals_for < goals_against AND game_id % 4 = 0) AS ot_losses,
                 CAST(sum(goals_for) AS BIGINT) AS gf, CAST(coalesce(sum(shots), 0) AS BIGINT) AS shots,
                 CAST(coalesce(sum(sh), 0) AS BIGINT) AS sh, CAST(coalesce(sum(pp), 0) AS BIGINT) AS pp
          FROM cur GROUP BY team)
SELECT team, games_played, wins, regulation_losses, ot_losses, wins * 2 + ot_losses AS points,
       {rr("wins * 2 + ot_losses", "games_played * 2", 3, 100)} AS points_pct,
       coalesce({rr("pp", "shots", 2, 100)}, 0.0) AS power_play_pct,
       coalesce({rr("shots - sh", "shots", 2, 100)}, 100.0) AS penalty_kill_pct,
       coalesce({rr("gf", "shots", 2, 100)}, 0.0) AS shooting_pct,
       CAST(rank() OVER (ORDER BY wins * 2 + ot_losses DESC) AS INTEGER) AS points_rank
FROM agg
"""))(season_points_otl)
