"""Calendar family: spine, date dimension, gap-fill, forward fill, weekly
snapshots, playoff cutoff distance, date slices, running totals, latest
standings card (F31, J09–J11, J14, W10, W17, P13–P15; M26, M27, M32, M41,
M53, M58, M61; S15; C01, C14).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonflow.functions import exprs as X
from seasonflow.operators import gapfill as G
from seasonflow.operators import joins as J
from seasonflow.operators import windows as W
from seasonflow.plans.registry import register, sql
from seasonflow.plans.testbed import Bed


def date_spine(spark: SparkSession, root: str) -> DataFrame:
    """Season bounds from the data, one row per day in them."""
    s = Bed(spark, root).snapshots()
    b = G.period_bounds(s, "season", "play_date")
    return b.select("season", "start_date", "end_date",
                    F.explode(F.sequence("start_date", "end_date")).alias("date")) \
            .withColumn("day_of_season", F.datediff("date", "start_date") + 1)


register("date_spine", sql("""
, b AS (SELECT season, min(play_date) AS start_date, max(play_date) AS end_date FROM snapshots GROUP BY season)
SELECT season, start_date, end_date, CAST(d AS DATE) AS date,
       CAST(date_diff('day', start_date, CAST(d AS DATE)) + 1 AS INTEGER) AS day_of_season
FROM b, LATERAL (SELECT unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS d)
"""))(date_spine)


# Fixed values (season model): a season runs October..June and is keyed by
# both years (Oct 2025 -> 20252026, Mar 2026 -> 20252026, Jul-Sep -> none).
# Phases: Jul-Sep offseason, Oct-Mar regular_season, Apr-Jun playoff_period.
# Holiday period: Dec 24-26, or February ISO weeks 7-8.  Prime days: Friday,
# Saturday, and Thursday in Oct-Mar.


def season_key_of(d) -> F.Column:
    y, m = F.year(d), F.month(d)
    return (F.when(m >= 10, y * 10000 + y + 1).when(m <= 6, (y - 1) * 10000 + y)
             .otherwise(F.lit(None).cast("int")))


def date_dimension(spark: SparkSession, root: str) -> DataFrame:
    """Calendar from the first game day to the last + 365 (data-derived
    ``as_of``), calendar parts, season key and phase, in-season counters, flags."""
    g = Bed(spark, root).games()
    lim = g.agg(F.min("game_date").alias("lo"), F.max("game_date").alias("hi"))
    spine = lim.select(F.explode(F.sequence("lo", F.date_add("hi", 365))).alias("date"))
    m, dow = F.month("date"), X.iso_dow("date")
    d = spine.select(
        "date", X.date_key("date").alias("date_key"), F.year("date").alias("year"), m.alias("month"),
        F.dayofmonth("date").alias("day"), dow.alias("iso_dow"), F.weekofyear("date").alias("week_of_year"),
        F.quarter("date").alias("quarter"), (dow >= 6).alias("is_weekend"),
        season_key_of(F.col("date")).alias("season_key"),
        F.when(m.isin(7, 8, 9), "offseason").when(m.isin(10, 11, 12, 1, 2, 3), "regular_season")
         .otherwise("playoff_period").alias("season_phase"))
    bounds = (g.filter(F.col("game_type") == 2)
               .groupBy(season_key_of(F.col("game_date")).alias("season_key"))
               .agg(F.min("game_date").alias("season_start"), F.max("game_date").alias("season_end")))
    d = d.join(F.broadcast(bounds), "season_key", "left")   # one row per season
    inside = (F.col("date") >= F.col("season_start")) & (F.col("date") <= F.col("season_end"))
    return d.select(
        "*", F.coalesce(inside, F.lit(False)).alias("is_in_season"),
        F.when(inside, F.datediff("date", "season_start")).alias("days_from_season_start"),
        F.when(inside, F.datediff("season_end", "date")).alias("days_to_season_end"),
        (((F.col("month") == 12) & F.col("day").between(24, 26)) |
         ((F.col("month") == 2) & F.col("week_of_year").isin(7, 8))).alias("is_holiday_period"),
        (F.col("iso_dow").isin(5, 6) |
         ((F.col("iso_dow") == 4) & F.col("month").isin(10, 11, 12, 1, 2, 3))).alias("is_prime_game_day"))


register("date_dimension", sql("""
, lim AS (SELECT min(game_date) AS lo, max(game_date) AS hi FROM games)
, spine AS (SELECT CAST(unnest(generate_series(lo, hi + INTERVAL 365 DAY, INTERVAL 1 DAY)) AS DATE) AS date FROM lim)
, sk AS (SELECT *, CASE WHEN month(date) >= 10 THEN CAST(year(date) * 10000 + year(date) + 1 AS INTEGER)
                        WHEN month(date) <= 6 THEN CAST((year(date) - 1) * 10000 + year(date) AS INTEGER) END AS season_key
         FROM spine)
, bounds AS (SELECT CASE WHEN month(game_date) >= 10 THEN CAST(year(game_date) * 10000 + year(game_date) + 1 AS INTEGER)
                         WHEN month(game_date) <= 6 THEN CAST((year(game_date) - 1) * 10000 + year(game_date) AS INTEGER) END AS season_key,
                    min(game_date) AS season_start, max(game_date) AS season_end
             FROM games WHERE game_type = 2 GROUP BY 1)
SELECT sk.season_key, date, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
       CAST(isodow(date) AS INTEGER) AS iso_dow, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
       CAST(quarter(date) AS INTEGER) AS quarter, isodow(date) >= 6 AS is_weekend,
       CASE WHEN month(date) IN (7, 8, 9) THEN 'offseason' WHEN month(date) IN (10, 11, 12, 1, 2, 3) THEN 'regular_season'
            ELSE 'playoff_period' END AS season_phase,
       season_start, season_end,
       coalesce(date BETWEEN season_start AND season_end, false) AS is_in_season,
       CASE WHEN date BETWEEN season_start AND season_end THEN CAST(date_diff('day', season_start, date) AS INTEGER) END AS days_from_season_start,
       CASE WHEN date BETWEEN season_start AND season_end THEN CAST(date_diff('day', date, season_end) AS INTEGER) END AS days_to_season_end,
       (month(date) = 12 AND day(date) BETWEEN 24 AND 26) OR (month(date) = 2 AND weekofyear(date) IN (7, 8)) AS is_holiday_period,
       isodow(date) IN (5, 6) OR (isodow(date) = 4 AND month(date) IN (10, 11, 12, 1, 2, 3)) AS is_prime_game_day
FROM sk LEFT JOIN bounds USING (season_key)
"""))(date_dimension)


# ------------------------------------------------------------- gap fill
_FILL = {"cum_n": 0, "cum_value": 0.0}


def gap_fill_scaffold(spark: SparkSession, root: str) -> DataFrame:
    """Every (season, player, day) of the season bounds, left-joined to
    the sparse snapshots; missing days stay NULL."""
    s = Bed(spark, root).snapshots()
    grid = G.scaffold(s, G.period_bounds(s, "season", "play_date"), "season", "player", "play_date")
    return grid.join(s.select("season", "player", "play_date", "cum_n", "cum_value"),
                     ["season", "player", "play_date"], "left")


_GRID_SQL = """
, b AS (SELECT season, min(play_date) AS start_date, max(play_date) AS end_date FROM snapshots GROUP BY season)
, grid AS (SELECT DISTINCT s.season, s.player, CAST(d AS DATE) AS play_date
           FROM snapshots s JOIN b USING (season),
                LATERAL (SELECT unnest(generate_series(b.start_date, b.end_date, INTERVAL 1 DAY)) AS d))
"""
register("gap_fill_scaffold", sql(_GRID_SQL + """
SELECT g.season, g.player, g.play_date, s.cum_n, s.cum_value
FROM grid g LEFT JOIN snapshots s USING (season, player, play_date)
"""))(gap_fill_scaffold)


def filled_snapshots(bed: Bed) -> DataFrame:
    s = bed.snapshots()
    return G.gap_fill(s.select("season", "player", "play_date", "cum_n", "cum_value"),
                      "season", "player", "play_date", _FILL)


def forward_fill(spark: SparkSession, root: str) -> DataFrame:
    """Carry the last snapshot forward (value, carried, default 0)."""
    f = filled_snapshots(Bed(spark, root))
    return f.withColumn("has_snapshot", F.col("cum_n") > 0)


_FILLED_SQL = _GRID_SQL + """
, filled AS (
  SELECT g.season, g.player, g.play_date, coalesce(s.cum_n, 0) AS cum_n, coalesce(s.cum_value, 0.0) AS cum_value
  FROM grid g ASOF LEFT JOIN snapshots s
    ON g.season = s.season AND g.player = s.player AND g.play_date >= s.play_date)
"""
register("forward_fill", sql(_FILLED_SQL + """
SELECT *, cum_n > 0 AS has_snapshot FROM filled
"""))(forward_fill)


def weekly_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Filled rows on Mondays OR on the season's final day."""
    f = filled_snapshots(Bed(spark, root))
    last = f.groupBy("season").agg(F.max("play_date").alias("__last"))
    f = f.join(F.broadcast(last), "season")     # one row per season
    return (f.filter(X.is_monday("play_date") | (F.col("play_date") == F.col("__last")))
             .select("season", "player", "play_date", "cum_n", "cum_value",
                     (F.col("play_date") == F.col("__last")).alias("is_final")))


register("weekly_snapshots", sql(_FILLED_SQL + """
SELECT season, player, play_date, cum_n, cum_value,
       play_date = (SELECT max(play_date) FROM filled f2 WHERE f2.season = f.season) AS is_final
FROM filled f
WHERE isodow(play_date) = 1 OR play_date = (SELECT max(play_date) FROM filled f2 WHERE f2.season = f.season)
"""))(weekly_snapshots)


# -------------------------------------------------------- team standings
def team_standings_daily(bed: Bed) -> DataFrame:
    """M27 on teams."""
    return bed.team_standings()


_TEAM_STANDINGS_SQL = """
, tday AS (
  SELECT season, team, game_date, count(*) AS d_gp, count_if(goals_for > goals_against) AS d_w,
         sum(CASE WHEN goals_for > goals_against THEN 2 WHEN goals_for = goals_against THEN 1 ELSE 0 END) AS d_pts,
         sum(goals_for - goals_against) AS d_gd
  FROM sides WHERE game_type = 2 GROUP BY 1, 2, 3)
, tb AS (SELECT season, min(game_date) AS s0, max(game_date) AS s1 FROM tday GROUP BY season)
, tgrid AS (SELECT DISTINCT t.season, t.team, CAST(d AS DATE) AS date
            FROM tday t JOIN tb USING (season), LATERAL (SELECT unnest(generate_series(tb.s0, tb.s1, INTERVAL 1 DAY)) AS d))
, tstand AS (
  SELECT g.season, g.team, g.date,
         CAST(coalesce((SELECT sum(d_gp) FROM tday x WHERE x.season = g.season AND x.team = g.team AND x.game_date <= g.date), 0) AS BIGINT) AS gp,
         CAST(coalesce((SELECT sum(d_w) FROM tday x WHERE x.season = g.season AND x.team = g.team AND x.game_date <= g.date), 0) AS BIGINT) AS wins,
         CAST(coalesce((SELECT sum(d_pts) FROM tday x WHERE x.season = g.season AND x.team = g.team AND x.game_date <= g.date), 0) AS BIGINT) AS points,
         CAST(coalesce((SELECT sum(d_gd) FROM tday x WHERE x.season = g.season AND x.team = g.team AND x.game_date <= g.date), 0) AS BIGINT) AS goal_diff
  FROM tgrid g)
, tstand_c AS (SELECT s.*, t.team_name, t.conference FROM tstand s JOIN teams t USING (team))
"""


def cutoff_distance(spark: SparkSession, root: str) -> DataFrame:
    """Playoff line per (date, conference) = the 3rd-highest points
    (``rank() <= 3`` ties share); in = points >= line; distance to the line,
    remaining games, max points and pace.

    The line is a top-3-per-group (planned as a WindowGroupLimit, so each task
    keeps 3 rows per group before the shuffle) aggregated and joined back —
    no task ever ranks a whole hot group.
    """
    st = Bed(spark, root).written("team_standings")       # read twice
    w = Window.partitionBy("date", "conference").orderBy(F.col("points").desc())
    top = (st.select("date", "conference", "points", F.rank().over(w).alias("__r"))
             .filter(F.col("__r") <= 3)
             .groupBy("date", "conference").agg(F.min("points").alias("cutoff_points")))
    out = st.join(top, ["date", "conference"], "left")
    inside = F.col("points") >= F.col("cutoff_points")
    return out.select(
        "season", "date", "team", "conference", "gp", "points", "cutoff_points",
        inside.alias("in_playoffs"),
        F.when(inside, F.lit(0)).otherwise(F.col("cutoff_points") - F.col("points")).alias("points_from_cutoff"),
        (F.lit(82) - F.col("gp")).alias("games_remaining"),
        (F.col("points") + 2 * (F.lit(82) - F.col("gp"))).alias("max_points"),
        X.round_ratio(F.col("points") * 82, "gp", 1).alias("points_pace"))


register("cutoff_distance", sql(_TEAM_STANDINGS_SQL + """
, cut AS (
  SELECT s.*, (SELECT min(points) FROM tstand_c o
               WHERE o.date = s.date AND o.conference = s.conference
                 AND (SELECT count(*) FROM tstand_c p WHERE p.date = o.date AND p.conference = o.conference
                      AND p.points > o.points) < 3) AS cutoff_points
  FROM tstand_c s)
SELECT season, date, team, conference, gp, points, cutoff_points, points >= cutoff_points AS in_playoffs,
       CASE WHEN points >= cutoff_points THEN 0 ELSE cutoff_points - points END AS points_from_cutoff,
       82 - gp AS games_remaining, points + 2 * (82 - gp) AS max_points,
       """ + "(CASE WHEN gp = 0 THEN NULL ELSE CAST((CAST(points AS HUGEINT) * 82 * 20 + gp) // (2 * gp) AS DOUBLE) / 10 END)" + """ AS points_pace
FROM cut
"""))(cutoff_distance)


def latest_standings_table(spark: SparkSession, root: str, conference: str | None = None) -> DataFrame:
    """Rows of the latest standings date (max-date scalar, broadcast), inner
    join to the team dimension, optional conference filter, sorted."""
    st = team_standings_daily(Bed(spark, root))
    mx = st.agg(F.max("date").alias("__max"))
    cur = J.scalar_join(st, mx).filter(F.col("date") == F.col("__max")).drop("__max")
    if conference is not None:
        cur = cur.filter(F.col("conference") == F.lit(conference))
    return (cur.select("date", "team", "team_name", "conference", "gp", "wins", "points", "goal_diff")
               .orderBy(F.col("points").desc(), F.col("goal_diff").desc(), F.col("team")))


register("latest_standings_table", sql(_TEAM_STANDINGS_SQL + """
SELECT date, team, team_name, conference, gp, wins, points, goal_diff FROM tstand_c
WHERE date = (SELECT max(date) FROM tstand_c) ORDER BY points DESC, goal_diff DESC, team
"""))(latest_standings_table)


def date_range_slice(spark: SparkSession, root: str) -> DataFrame:
    """One slice per day between the first and last event day (inclusive end),
    each stamped with its date; empty days kept with zero counts."""
    p = Bed(spark, root).plays()
    lim = p.agg(F.min("play_date").alias("lo"), F.max("play_date").alias("hi"))
    slices = lim.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("slice_date"))
    per = p.groupBy(F.col("play_date").alias("slice_date")).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"))
    return (slices.join(per, "slice_date", "left")
                  .select("slice_date", F.coalesce("records", F.lit(0)).alias("records"),
                          F.coalesce("value", F.lit(0.0)).alias("value")))


register("date_range_slice", sql("""
, lim AS (SELECT min(play_date) AS lo, max(play_date) AS hi FROM plays)
, sl AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS slice_date FROM lim)
SELECT slice_date, (SELECT count(*) FROM plays p WHERE p.play_date = sl.slice_date) AS records,
       coalesce((SELECT CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) FROM plays p WHERE p.play_date = sl.slice_date), 0.0) AS value
FROM sl
"""))(date_range_slice)


def running_totals(spark: SparkSession, root: str) -> DataFrame:
    """Per player cumulative events and value by day."""
    p = Bed(spark, root).plays()
    day = p.groupBy("player", "play_date").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("value"))
    out = W.running_totals(day, ["player"], [F.col("play_date")],
                           {"cum_events": "events", "cum_value": "value"})
    return out.select("player", "play_date", "events", "cum_events",
                      F.col("value").cast("double").alias("value"),
                      F.col("cum_value").cast("double").alias("cum_value"))


register("running_totals", sql("""
, day AS (SELECT player, play_date, count(*) AS events, sum(CAST(value AS DECIMAL(18,2))) AS value
          FROM plays GROUP BY 1, 2)
SELECT player, play_date, events,
       CAST((SELECT sum(events) FROM day d2 WHERE d2.player = d.player AND d2.play_date <= d.play_date) AS BIGINT) AS cum_events,
       CAST(value AS DOUBLE) AS value,
       CAST((SELECT sum(value) FROM day d2 WHERE d2.player = d.player AND d2.play_date <= d.play_date) AS DOUBLE) AS cum_value
FROM day d
"""))(running_totals)
