"""Dashboard cards (C01–C14) as parametrised query functions over the marts.

A missing parameter means "no filter"; parameters enter plans as literals
(``F.lit``), never spliced into SQL text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonflow.functions import exprs as X
from seasonflow.operators import dedup as D
from seasonflow.operators import joins as J
from seasonflow.operators import ranking as R
from seasonflow.operators import windows as W


def _eq(df: DataFrame, col: str, value) -> DataFrame:
    return df if value is None else df.filter(F.col(col) == F.lit(value))


def detailed_team_table(standings: DataFrame, teams: DataFrame, conference: str | None = None) -> DataFrame:
    """Rows of the latest standings date (max-date scalar, cross joined),
    inner join to the team dimension, optional conference filter, sorted."""
    latest = D.latest_rows_per_group(standings, [], "date")
    t = latest.join(teams.select("team_abv", "team_name"), "team_abv", "inner")
    return _eq(t, "conferencename", conference).orderBy(F.col("points").desc(), F.col("team_abv"))


def leaders(skater_season: DataFrame, stat: str = "points", season: int | None = None, k: int = 5) -> DataFrame:
    """Top-k leaders (assists / points / goals) — order desc, limit, id tie-break."""
    return R.top_k(_eq(skater_season, "season", season), k, [F.col(stat).desc(), F.col("player_id")])


def scalar_stat(metrics: DataFrame, column: str, team=None) -> DataFrame:
    """One column for a (selected) team."""
    return _eq(metrics, "team", team).select("team", column)


def skater_detail(player_games: DataFrame, players: DataFrame, teams: DataFrame, season: int | None = None) -> DataFrame:
    """Two left joins, breakout of (season, team, player), 12 measures,
    average TOI in minutes, not-null filter on the player name."""
    j = (_eq(player_games, "season", season)
         .join(players.select("player_id", "full_name"), "player_id", "left")
         .join(teams.select("team_abv", "team_name"), "team_abv", "left")
         .filter(F.col("full_name").isNotNull()))
    return j.groupBy("season", "team_name", "full_name").agg(
        F.count(F.lit(1)).alias("gp"), *[F.sum(c).alias(c) for c in ("goals", "assists", "points", "shots", "hits",
                                                                     "pim", "game_winning_goals", "faceoffs_won")],
        F.count_if("is_hat_trick").alias("hat_tricks"), F.max("points").alias("best_game"),
        X.round_ratio(F.sum("toi_seconds"), F.count(F.lit(1)) * 60, 2).alias("avg_toi_minutes"))


def own_division(standings: DataFrame, team_abv: str, season: int | None = None) -> DataFrame:
    """``division = (select division of the selected team)`` via a one-row join,
    in one season (the latest unless given), at that season's last date."""
    standings_latest = (J.keep_max(standings, "season") if season is None
                        else standings.filter(F.col("season") == F.lit(season)))
    if "date" in standings.columns:
        standings_latest = J.keep_max(standings_latest, "date")
    sel = standings_latest.filter(F.col("team_abv") == F.lit(team_abv)).select(F.col("divisionname").alias("__d"))
    return J.scalar_join(standings_latest, sel).filter(F.col("divisionname") == F.col("__d")).drop("__d")


def standings_series(by_day: DataFrame, start: dt.date | None = None, end: dt.date | None = None,
                     season: int | None = None, team: str | None = None, conference: str | None = None,
                     cap: int | None = None) -> DataFrame:
    """Standings by day with optional filters, sorted by date.  All rows, or
    with ``cap`` the newest so many (the card's own limit, given by the caller)."""
    s = _eq(_eq(_eq(by_day, "season", season), "team_abv", team), "conferencename", conference)
    if start is not None:
        s = s.filter(F.col("date") >= F.lit(start))
    if end is not None:
        s = s.filter(F.col("date") <= F.lit(end))
    if cap is not None:
        s = s.orderBy(F.col("date").desc(), F.col("team_abv")).limit(cap)
    return s.orderBy("date", "team_abv")


def goalie_leaders(goalie_season: DataFrame, names: DataFrame, min_shots: int = 100,
                   excluded: Sequence[str] = (), k: int = 5) -> DataFrame:
    """Save-pct leaders with a minimum workload and a name exclusion list."""
    g = goalie_season.join(names, "player_id", "left").filter(F.col("shots_against") >= min_shots)
    if excluded:
        g = g.filter(~F.col("full_name").isin(*excluded))
    return R.top_k(g, k, [F.col("save_pct").desc(), F.col("player_id")])


def division_tables(by_day: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Each team's latest row inside a date range; division, then points desc."""
    s = by_day.filter(F.col("date").between(F.lit(start), F.lit(end)))
    top = D.dedup_latest(s, ["team_abv"], [F.col("date").desc()])
    return top.orderBy(F.col("divisionname"), F.col("points").desc(), F.col("team_abv"))


def efficiency(season_mart: DataFrame, min_toi_minutes: float = 30, min_gp: int = 2) -> DataFrame:
    """Computed-column filter (TOI minutes) and games-played filter."""
    t = season_mart.withColumn("toi_minutes", X.round_ratio("toi_seconds", F.lit(60), 1))
    return t.filter((F.col("toi_minutes") > min_toi_minutes) & (F.col("gp") > min_gp))


def goalie_detail(goalie_season: DataFrame, roster_goalies: DataFrame) -> DataFrame:
    """Season lines RIGHT JOIN the goalie roster (every goalie kept)."""
    return goalie_season.join(roster_goalies.select("player_id", "full_name", "team_abv")
                              .withColumnRenamed("team_abv", "roster_team"), "player_id", "right")


def team_future_games(upcoming: DataFrame, team: str, as_of: dt.date, offset_col: str | None = None) -> DataFrame:
    """C11: games on or after ``as_of`` where the team is on either side; an
    optional '+HH:MM' offset column shifts the start time."""
    u = upcoming.filter((F.col("game_date") >= F.lit(as_of)) &
                        ((F.col("home_team_abv") == F.lit(team)) | (F.col("away_team_abv") == F.lit(team))))
    if offset_col:
        u = u.withColumn("start_shifted", X.add_offset_hours(F.col("start_local"), F.col(offset_col)))
    return u


def player_compare(player_games: DataFrame, players: Sequence[int] | None = None, season: int | None = None) -> DataFrame:
    """``sum(toi) / count(distinct game) / 60`` and totals per selected player."""
    g = _eq(player_games, "season", season)
    if players:
        g = g.filter(F.col("player_id").isin(*players))
    return g.groupBy("player_id").agg(
        F.sum("points").alias("points"), F.count_distinct("game_id").alias("games"),
        X.round_ratio(F.sum("toi_seconds"), F.count_distinct("game_id") * 60, 2).alias("toi_min_per_game"))


def listing(dim: DataFrame) -> DataFrame:
    """Full dimension listing."""
    return dim


def running_stats(player_games: DataFrame, games: DataFrame, player_id: int | None = None) -> DataFrame:
    """C14: cumulative goals / assists / points by game date per player."""
    g = _eq(player_games, "player_id", player_id).join(games.select("game_id", "game_date"), "game_id", "inner")
    return W.running_totals(g, ["player_id"], [F.col("game_date"), F.col("game_id")],
                            {"cum_goals": "goals", "cum_assists": "assists", "cum_points": "points"})
