"""Season models on feed-shaped frames derived from the given tables, each against
an oracle written from the model's definition (M27, M38, M41, M44).

The frames have the feed's own column names, so the very functions that build the
season warehouse run here; only their input is an analogue.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonflow.operators import windows as W
from seasonflow.operators.ranking import multi_key_rank
from seasonflow.params import Params
from seasonflow.plans.registry import register, rr, sql
from seasonflow.plans.season import facts
from seasonflow.plans.season import intermediate as I
from seasonflow.plans.season import power_rankings as PR
from seasonflow.plans.season import schemas as S
from seasonflow.plans.testbed import Bed

GAMES = 82      # fixed value: regular-season games
AS_OF = dt.date(2026, 1, 15)


def daily_feed(bed: Bed, with_form: bool = False) -> DataFrame:
    """A daily standings feed: a snapshot per team on the days it played, cumulative
    over its season's regular games (a loss in a game with an id divisible by four
    is an overtime loss), with its place in the conference that day.  ``with_form``
    adds the split of the last ten regular games."""
    s = bed.sides().filter((F.col("game_type") == 2) & (F.col("goals_for") != F.col("goals_against")))
    win, late = F.col("goals_for") > F.col("goals_against"), F.col("game_id") % 4 == 0
    day = s.groupBy("season", "team", "game_date").agg(
        F.count(F.lit(1)).alias("d_gp"), F.count_if(win).alias("d_w"), F.count_if(~win & ~late).alias("d_l"),
        F.count_if(~win & late).alias("d_o"), F.sum("goals_for").alias("d_gf"), F.sum("goals_against").alias("d_ga"))
    cum = W.running_totals(day, ["season", "team"], [F.col("game_date")],
                           {"GAMESPLAYED": "d_gp", "WINS": "d_w", "LOSSES": "d_l", "OTLOSSES": "d_o", "GOALFOR": "d_gf",
                            "GOALAGAINST": "d_ga"})
    cum = cum.withColumn("POINTS", F.col("WINS") * 2 + F.col("OTLOSSES")).join(bed.teams(), "team")
    order = [F.col("POINTS").desc(), F.col("WINS").desc(), F.col("team")]
    cum = multi_key_rank(cum, order, name="DIVISIONSEQUENCE", partition=["season", "game_date", "conference"])
    known = {"GAMESPLAYED", "WINS", "LOSSES", "OTLOSSES", "GOALFOR", "GOALAGAINST", "POINTS", "DIVISIONSEQUENCE"}
    if with_form:
        ten = (Window.partitionBy("season", "team").orderBy("game_date", "game_id").rowsBetween(-9, Window.currentRow))
        form = s.select("season", "team", "game_date", "game_id", *[F.count_if(x).over(ten).alias(n) for n, x in (
            ("L10WINS", win), ("L10LOSSES", ~win & ~late), ("L10OTLOSSES", ~win & late))])
        form = form.groupBy("season", "team", "game_date").agg(*[F.max_by(n, "game_id").alias(n) for n in (
            "L10WINS", "L10LOSSES", "L10OTLOSSES")]).withColumn("L10POINTS", F.col("L10WINS") * 2 + F.col("L10OTLOSSES"))
        cum = cum.join(form, ["season", "team", "game_date"])
        known |= {"L10WINS", "L10LOSSES", "L10OTLOSSES", "L10POINTS"}
    return cum.select(
        F.col("season").alias("SEASONID"), F.col("team_name").alias("TEAMABBREV_DEFAULT"), F.col("game_date").alias("DATE"),
        *[F.col(c).cast("int").alias(c) for c in S.STANDING_INT_COLS if c in known],
        *[F.lit(None).cast("int").alias(c) for c in S.STANDING_INT_COLS if c not in known],
        F.col("conference").alias("DIVISIONNAME"), F.col("conference").alias("DIVISIONABBREV"),
        F.col("conference").alias("CONFERENCENAME"), F.col("conference").alias("CONFERENCEABBREV"),
        F.col("team_name").alias("TEAMNAME_DEFAULT"), F.lit(None).cast("string").alias("STREAKCODE"))


def standings_daily_model(spark: SparkSession, root: str) -> DataFrame:
    """M27 + M41: every team on every day of its season, last snapshot carried
    forward, places NULL before the first; playoff position, distance, pace."""
    by_day = I.standings_by_day(daily_feed(Bed(spark, root)))
    out = facts.fct_standings_daily(by_day, Params(regular_season_games=GAMES))
    return out.select("season", "date", "team_abv", "conference", "games_played", "points", "wins", "losses", "ot_losses",
                      "in_playoff_position", "points_from_playoff_line", "games_remaining", "max_possible_points",
                      "points_pace", "record")


register("standings_daily_model", sql(f"""
, s AS (SELECT s.*, t.team_name, t.conference FROM sides s JOIN teams t USING (team)
        WHERE game_type = 2 AND goals_for <> goals_against)
, day AS (SELECT season, team_name, conference, team, game_date AS date, count(*) AS gp, count_if(goals_for > goals_against) AS w,
                 count_if(goals_for < goals_against AND game_id % 4 <> 0) AS l,
                 count_if(goals_for < goals_against AND game_id % 4 = 0) AS o
          FROM s GROUP BY ALL)
, cum AS (SELECT season, team_name, conference, team, date, sum(gp) OVER t AS gp, sum(w) OVER t AS w, sum(l) OVER t AS l, sum(o) OVER t AS o
          FROM day WINDOW t AS (PARTITION BY season, team ORDER BY date))
, snap AS (SELECT *, 2 * w + o AS pts, row_number() OVER (PARTITION BY season, date, conference ORDER BY 2 * w + o DESC, w DESC, team) AS place
           FROM cum)
, grid AS (SELECT b.season, CAST(unnest(generate_series(b.lo, b.hi, INTERVAL 1 DAY)) AS DATE) AS date, t.team_name, t.conference
           FROM (SELECT season, min(date) AS lo, max(date) AS hi FROM snap GROUP BY season) b
           JOIN (SELECT DISTINCT season, team_name, conference FROM snap) t ON t.season = b.season)
, f AS (SELECT g.season, g.date, g.team_name, g.conference,
               coalesce(last_value(s.gp IGNORE NULLS) OVER r, 0) AS gp, coalesce(last_value(s.pts IGNORE NULLS) OVER r, 0) AS pts,
               coalesce(last_value(s.w IGNORE NULLS) OVER r, 0) AS w, coalesce(last_value(s.l IGNORE NULLS) OVER r, 0) AS l,
               coalesce(last_value(s.o IGNORE NULLS) OVER r, 0) AS o, last_value(s.place IGNORE NULLS) OVER r AS place
        FROM grid g LEFT JOIN snap s ON s.season = g.season AND s.team_name = g.team_name AND s.date = g.date
        WINDOW r AS (PARTITION BY g.season, g.team_name ORDER BY g.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
, cut AS (SELECT season, date, conference, min(pts) AS line FROM f WHERE place = 3 GROUP BY ALL)
SELECT f.season, f.date, team_name AS team_abv, f.conference, CAST(gp AS INTEGER) AS games_played, CAST(pts AS INTEGER) AS points,
       CAST(w AS INTEGER) AS wins, CAST(l AS INTEGER) AS losses, CAST(o AS INTEGER) AS ot_losses,
       coalesce(place <= 3, false) AS in_playoff_position,
       CAST(CASE WHEN place <= 3 THEN 0 ELSE line - pts END AS INTEGER) AS points_from_playoff_line,
       CAST({GAMES} - gp AS INTEGER) AS games_remaining, CAST(pts + ({GAMES} - gp) * 2 AS INTEGER) AS max_possible_points,
       coalesce({rr("pts", "gp", 1, GAMES)}, 0.0) AS points_pace, concat(w, '-', l, '-', o) AS record
FROM f LEFT JOIN cut ON cut.season = f.season AND cut.date = f.date AND cut.conference = f.conference
"""))(standings_daily_model)


def goalie_lines(bed: Bed, player_games: DataFrame | None = None) -> DataFrame:
    """Goalie box lines: a player's line with goals conceded and shots faced; nobody
    is on the ice in a line with penalty minutes; the lowest player starts."""
    pg = (bed.player_games() if player_games is None else player_games).filter(F.col("game_type").isin(2, 3))
    first = F.min("player").over(Window.partitionBy("game_id"))
    faced, conceded = F.col("shots").cast("int"), F.col("goals").cast("int")
    return pg.withColumn("first", first).select(
        "game_id", "season", F.when(F.col("game_type") == 2, "regular").otherwise("playoff").alias("game_type"),
        F.when(F.col("player") % 2 == 0, "home").otherwise("away").alias("type"), F.col("team").cast("string").alias("team_abv"),
        F.col("player").alias("player_id"), F.col("player_name").alias("name"),
        (F.col("player") == F.col("first")).alias("starter"), F.lit(None).cast("string").alias("result"),
        conceded.alias("goals_against"), (faced - conceded).alias("shots_saved"), faced.alias("shots_against"),
        *[F.lit(None).cast("int").alias(f"{k}_{c}") for k in ("even", "pp", "sh")
          for c in ("shots_saved", "shots_against", "goals_against")],
        F.col("pim").cast("int").alias("pim"),
        F.when(F.col("pim") > 0, 0).otherwise(F.col("toi_seconds")).cast("int").alias("toi_seconds"))


def goalie_game_model(spark: SparkSession, root: str) -> DataFrame:
    """Goals against per 60 minutes, shutout (the team's only goalie with ice
    time), performance category, relief, quality and bad starts, saves above an
    average goalie's."""
    out = facts.fct_goalie_game(goalie_lines(Bed(spark, root)), Params())
    return out.select("game_id", "player_id", "team_abv", "shots_saved", "shots_against", "goals_against", "toi_seconds",
                      F.round("goals_against_per_60", 6).alias("goals_against_average"), "is_shutout",
                      F.col("save_tier").alias("performance_category"), "is_relief", "quality_start", "bad_start",
                      F.round("saves_above_average", 6).alias("saves_above_average"))


register("goalie_game_model", sql("""
, g AS (SELECT game_id, player, team, goals AS ga, shots AS sa, CASE WHEN pim > 0 THEN 0 ELSE toi_seconds END AS toi,
               player = min(player) OVER (PARTITION BY game_id) AS starter
        FROM player_games WHERE game_type IN (2, 3))
, k AS (SELECT *, sum(CASE WHEN toi > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY game_id, team) AS used,
               CASE WHEN sa > 0 THEN CAST(sa - ga AS DOUBLE) / sa END AS pct FROM g)
SELECT game_id, player AS player_id, CAST(team AS VARCHAR) AS team_abv, CAST(sa - ga AS INTEGER) AS shots_saved,
       CAST(sa AS INTEGER) AS shots_against, CAST(ga AS INTEGER) AS goals_against, CAST(toi AS INTEGER) AS toi_seconds,
       round(CASE WHEN toi > 0 THEN ga * 3600.0::DOUBLE / toi ELSE 0.0 END, 6) AS goals_against_average,
       ga = 0 AND toi > 0 AND used = 1 AS is_shutout,
       CASE WHEN pct >= 0.950 THEN 'Elite' WHEN pct >= 0.920 THEN 'Excellent' WHEN pct >= 0.900 THEN 'Good'
            WHEN pct >= 0.880 THEN 'Average' ELSE 'Below Average' END AS performance_category,
       NOT starter AND toi > 0 AS is_relief, starter AND pct >= 0.917 AND ga <= 2 AS quality_start,
       starter AND pct < 0.850 AS bad_start, round(CAST(sa - ga - sa * 0.910 AS DOUBLE), 6) AS saves_above_average
FROM k
"""))(goalie_game_model)


def decided_lines(bed: Bed) -> DataFrame:
    """Team game lines of regular and playoff games that have a winner."""
    g = bed.written("team_games").filter(F.col("goals_for") != F.col("goals_against"))
    names = bed.teams().select("team", F.col("team_name").alias("team_abv"))
    return g.join(names, "team").withColumnRenamed("goals_for", "goals")


def power_rankings_model(spark: SparkSession, root: str) -> DataFrame:
    """Points shares, last ten and final order from standings snapshots, schedule
    over all games, last five games of any type, playoff carry-over; all published
    columns (scores to 8 decimals, for sums may differ in their last bits)."""
    bed = Bed(spark, root)
    lines = decided_lines(bed)
    by_day = I.standings_by_day(daily_feed(bed, with_form=True))
    t = bed.teams()
    u = bed.universe().filter(F.col("home_score") != F.col("away_score"))
    games = (u.join(t.select(F.col("team").alias("home_team"), F.col("team_name").alias("home_abv")), "home_team")
             .join(t.select(F.col("team").alias("away_team"), F.col("team_name").alias("away_abv")), "away_team"))
    teams = t.select(F.col("team").alias("team_id"), F.col("team_name").alias("team_abv"), "team_name")
    out = PR.power_rankings(lines, by_day, games, lines.select("season"), teams, p=Params(as_of=AS_OF))
    eight = [c for c in out.columns if c.endswith("_component") or c == "power_score"]
    return out.withColumns({c: F.round(c, 8) for c in eight})


def _scale(name: str, invert: bool = False) -> str:
    low, high = f"(SELECT min({name}) FROM tm)", f"(SELECT max({name}) FROM tm)"
    x = f"({name} - {low}) / nullif({high} - {low}, 0) * 100"
    return f"CASE WHEN games_played > 0 THEN {'100 - (' + x + ')' if invert else x} ELSE 0 END"


register("power_rankings", sql(f"""
, w AS (SELECT s.*, t.team_name AS abv, o.team_name AS opp FROM sides s JOIN teams t USING (team)
        JOIN teams o ON o.team = s.opponent WHERE goals_for <> goals_against)
, ln AS (SELECT l_orderkey AS game_id, l_linenumber % 2 = 1 AS is_home, count(*) AS shots,
                count_if(l_returnflag = 'R') AS sh, count_if(l_discount >= 0.05) AS pp FROM lineitem GROUP BY 1, 2)
, cur AS (SELECT max(season) AS s FROM w), prv AS (SELECT max(season) AS s FROM w WHERE season < (SELECT s FROM cur))
, regular AS (SELECT *, game_id % 4 = 0 AS late, row_number() OVER (PARTITION BY season, abv ORDER BY game_date DESC, game_id DESC) AS back
              FROM w WHERE game_type = 2)
, st AS (SELECT season, abv, count(*) AS gp, count_if(goals_for > goals_against) AS wins,
                2 * count_if(goals_for > goals_against) + count_if(goals_for < goals_against AND late) AS pts,
                sum(goals_for - goals_against) AS gd,
                2 * count_if(back <= 10 AND goals_for > goals_against) + count_if(back <= 10 AND goals_for < goals_against AND late) AS l10p,
                count_if(back <= 10) AS l10n
         FROM regular GROUP BY season, abv)
, cs AS (SELECT abv, gp, CAST(pts AS DOUBLE) / (2 * gp) AS pct, CAST(l10p AS DOUBLE) / (2.0::DOUBLE * l10n) AS l10
         FROM st WHERE season = (SELECT s FROM cur))
, sos AS (SELECT w.abv, avg(cs.pct) AS v FROM w JOIN cs ON cs.abv = w.opp WHERE w.season = (SELECT s FROM cur) GROUP BY w.abv)
, tot AS (SELECT abv, sum(goals_for) AS gf, sum(goals_against) AS ga, sum(shots) AS shots, sum(pp) AS pp, sum(sh) AS sh
          FROM regular LEFT JOIN ln USING (game_id, is_home) WHERE season = (SELECT s FROM cur) GROUP BY abv)
, five AS (SELECT abv, count_if(goals_for > goals_against) AS rw, count_if(goals_for < goals_against) AS rl, count(*) AS rn,
                  sum(goals_for - goals_against) AS rgd
           FROM (SELECT *, row_number() OVER (PARTITION BY abv ORDER BY game_date DESC, game_id DESC) AS back
                 FROM w WHERE season = (SELECT s FROM cur)) WHERE back <= 5 GROUP BY abv)
, fin AS (SELECT abv, row_number() OVER (ORDER BY CAST(pts AS DOUBLE) / (2 * gp) DESC, wins DESC, gd DESC, abv) AS final_rank
          FROM st WHERE season = (SELECT s FROM prv))
, po AS (SELECT abv, count(*) AS n, count_if(goals_for > goals_against) AS wins,
                round(avg(goals_for), 2) - round(avg(goals_against), 2) AS diff
         FROM w WHERE game_type = 3 AND season = (SELECT s FROM prv) GROUP BY abv)
, prev AS (SELECT fin.abv, coalesce(po.n, 0) AS playoff_games, coalesce(po.wins, 0) AS playoff_wins,
                  coalesce(CAST(po.wins AS DOUBLE) / po.n, 0) AS playoff_win_pct,
                  CASE WHEN wins >= 12 THEN 4 WHEN wins >= 8 THEN 3 WHEN wins >= 4 THEN 2 WHEN n > 0 THEN 1 ELSE 0 END AS playoff_round,
                  CASE WHEN po.n > 0 THEN 100.0::DOUBLE * (32 - final_rank) / 31.0::DOUBLE * 0.5::DOUBLE
                         + (wins / 16.0::DOUBLE * 60.0::DOUBLE + CAST(wins AS DOUBLE) / n * 20.0::DOUBLE + (diff + 2) * 2.0::DOUBLE) * 0.5::DOUBLE
                       ELSE 100.0::DOUBLE * (32 - final_rank) / 31.0::DOUBLE * 0.8::DOUBLE END AS score
           FROM fin LEFT JOIN po USING (abv))
, tm AS (SELECT t.team AS team_id, t.team_name, cs.gp AS games_played, pct, CAST(gf AS DOUBLE) / gp AS gpg, CAST(ga AS DOUBLE) / gp AS gapg,
                CAST(gf - ga AS DOUBLE) / gp AS gdpg, CAST(shots AS DOUBLE) / gp AS spg, CAST(pp AS DOUBLE) / nullif(shots, 0) AS ppp,
                CAST(shots - sh AS DOUBLE) / nullif(shots, 0) AS pkp, coalesce(l10, pct, 0) AS l10, rw, rl, rn, CAST(rgd AS DOUBLE) AS rgd,
                coalesce(sos.v, 0.5::DOUBLE) AS opp_pct, coalesce(prev.score, 50.0::DOUBLE) AS prev_score, playoff_round, playoff_win_pct,
                playoff_wins, playoff_games
         FROM teams t JOIN cs ON cs.abv = t.team_name JOIN tot ON tot.abv = t.team_name LEFT JOIN five ON five.abv = t.team_name
              LEFT JOIN sos ON sos.abv = t.team_name LEFT JOIN prev ON prev.abv = t.team_name)
, comp AS (SELECT *, {_scale("pct")} AS points_component,
                  ({_scale("gdpg")}) * 0.5::DOUBLE + ({_scale("gpg")}) * 0.3::DOUBLE + ({_scale("gapg", True)}) * 0.2::DOUBLE AS goal_component,
                  CASE WHEN games_played >= 5 THEN ({_scale("spg")}) * 0.4::DOUBLE + ({_scale("ppp")}) * 0.3::DOUBLE
                       + ({_scale("pkp")}) * 0.3::DOUBLE ELSE 50.0::DOUBLE END AS advanced_stats_component,
                  CASE WHEN games_played >= 5 THEN {_scale("opp_pct")} ELSE 50.0::DOUBLE END AS schedule_component,
                  CASE WHEN games_played >= 10 THEN ({_scale("l10")}) * 0.6::DOUBLE + ({_scale("rgd")}) * 0.4::DOUBLE
                       WHEN games_played >= 5 THEN CASE WHEN rn >= 3 THEN CAST(rw - rl AS DOUBLE) / rn * 100 ELSE 0 END * 0.5::DOUBLE
                            + ({_scale("rgd")}) * 0.5::DOUBLE
                       ELSE 50.0::DOUBLE END AS momentum_component,
                  CASE WHEN games_played >= 20 THEN 1.0::DOUBLE ELSE games_played / 20.0::DOUBLE END AS cw
           FROM tm)
, own AS (SELECT *, CASE WHEN games_played < 5 THEN [0.35, 0.30, 0.15, 0.10, 0.10] WHEN games_played < 10 THEN [0.32, 0.28, 0.18, 0.12, 0.10]
                         ELSE [0.30, 0.25, 0.20, 0.15, 0.10] END::DOUBLE[] AS k FROM comp)
, scored AS (SELECT *, prev_score * (1 - cw) + cw * (points_component * k[1] + goal_component * k[2] + advanced_stats_component * k[3]
                       + schedule_component * k[4] + momentum_component * k[5]) AS power_score FROM own)
SELECT DATE '{AS_OF}' AS ranking_date, team_id, team_name AS team_abv, team_name, round(power_score, 8) AS power_score,
       CAST(row_number() OVER (ORDER BY power_score DESC NULLS LAST, team_name) AS INTEGER) AS power_rank,
       round(points_component, 8) AS points_component, round(goal_component, 8) AS goal_component,
       round(advanced_stats_component, 8) AS advanced_stats_component, round(schedule_component, 8) AS schedule_component,
       round(momentum_component, 8) AS momentum_component, round(pct, 3) AS point_pct, round(gpg, 2) AS goals_per_game,
       round(gapg, 2) AS goals_against_per_game, round(gdpg, 2) AS goal_differential_per_game, round(spg, 1) AS shots_per_game,
       round(ppp * 100, 1) AS pp_pct, round(pkp * 100, 1) AS pk_pct, round(l10, 3) AS last_10_points_pct,
       CAST(coalesce(rw, 0) AS BIGINT) AS last_5_wins, CAST(coalesce(rl, 0) AS BIGINT) AS last_5_losses,
       CAST(coalesce(rgd, 0) AS BIGINT) AS last_5_goal_diff, round(opp_pct, 3) AS strength_of_schedule,
       CAST(games_played AS INTEGER) AS games_played, round(cw * 100, 1) AS current_season_weight_pct,
       round((1 - cw) * 100, 1) AS previous_season_weight_pct, playoff_round AS prev_playoff_round,
       CASE playoff_round WHEN 4 THEN 'Cup Finals' WHEN 3 THEN 'Conference Finals' WHEN 2 THEN 'Second Round' WHEN 1 THEN 'First Round'
            WHEN 0 THEN 'Missed Playoffs' END AS prev_playoff_result, round(playoff_win_pct * 100, 1) AS prev_playoff_win_pct,
       CAST(playoff_wins AS BIGINT) AS prev_playoff_wins, CAST(playoff_games AS BIGINT) AS prev_playoff_games
FROM scored
"""))(power_rankings_model)
