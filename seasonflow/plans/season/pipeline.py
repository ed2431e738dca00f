"""Dependency-ordered build of the season models from the raw tables.

``build(raw)`` takes a dict of raw DataFrames (names as in FIXTURES.md) and
returns a dict of every model as a lazy DataFrame.  ``write`` materialises the
models the reference materialises as tables (universe, box lines, standings by
day, plays fact, team lines) so the marts read them instead of re-deriving.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.operators.dedup import dedup_latest
from seasonflow.params import Params
from seasonflow.session import cut_lineage
from seasonflow.sources.bucketed import write_bucketed
from seasonflow.sources.loads import load_full_replace
from seasonflow.plans.season import dims, facts, marts, metrics, published
from seasonflow.plans.season import intermediate as I
from seasonflow.plans.season import staging as ST

MATERIALISED = ("league_games", "skater_game_lines", "goalie_game_lines", "standings_by_day", "fct_plays",
                "team_game_line", "fct_team_game")


def checkpointed(name: str, df: DataFrame) -> DataFrame:
    """Default materialisation: a reliable checkpoint into the shared folder named
    by ``spark.checkpoint.dir`` (cuts lineage; survives executor loss)."""
    return cut_lineage(df) if name in MATERIALISED else df


def build(spark: SparkSession, raw: dict[str, DataFrame], p: Params = Params(),
          calendar_start: dt.date = dt.date(2015, 10, 1), persist=None,
          seeds: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """``persist(name, df) -> df`` materialises the shared models (default: a
    reliable checkpoint; pass a table writer to publish them instead)."""
    keep = persist or checkpointed
    m: dict[str, DataFrame] = {}
    m["stg_games"] = ST.stg_games(raw["games"])
    m["stg_daily_standings"] = ST.stg_daily_standings(raw["daily_standings"])
    m["stg_plays"] = ST.stg_plays(raw["play_by_play"])
    m["stg_game_summaries"] = ST.stg_game_summaries(raw["game_summaries"])
    m["stg_three_stars"] = ST.stg_three_stars(raw["game_summaries"])
    m["stg_boxscore"] = ST.stg_boxscore(raw["game_boxscore"])
    m["stg_rosters"] = ST.stg_rosters(raw["team_rosters"])
    if "current_teams" in raw:
        m["stg_current_teams"] = ST.stg_current_teams(raw["current_teams"])
    if "season_schedules" in raw:
        m["stg_schedules"] = ST.stg_schedules(raw["season_schedules"])
    if "current_standings" in raw:
        m["stg_current_standings"] = ST.stg_current_standings(raw["current_standings"])
        m["current_standings"] = I.current_standings(m["stg_current_standings"])
    m["all_games"] = I.all_games(raw["game_summaries"], m["stg_games"])
    m["basic_games_info"] = I.basic_games_info(m["stg_games"])
    if "current_teams" in raw:
        m["teams_basic_info"] = I.teams_basic_info(
            dedup_latest(raw["current_teams"], ["ID"], [F.col("_loaded_at").desc()]))

    m["league_games"] = keep("league_games", I.league_games(m["stg_games"], m["stg_daily_standings"]))
    m["roster_players"] = I.roster_players(m["stg_rosters"])
    m["all_forwards"] = I.roster_players(m["stg_rosters"], ("forward",))
    m["all_defensemen"] = I.roster_players(m["stg_rosters"], ("defense",))
    m["all_goalies"] = I.roster_players(m["stg_rosters"], ("goalie",))
    m["all_skaters"] = I.all_skaters(m["stg_rosters"])
    m["game_faceoffs"] = I.game_faceoffs(m["stg_plays"], m["league_games"])
    m["game_penalties"] = I.game_penalties(m["stg_plays"], m["league_games"])
    m["skater_game_lines"] = keep("skater_game_lines", I.skater_game_lines(m["stg_boxscore"], m["league_games"]))
    m["goalie_game_lines"] = keep("goalie_game_lines", I.goalie_game_lines(m["stg_boxscore"], m["league_games"]))
    m["season_dates"] = I.season_dates(m["stg_daily_standings"])
    m["standings_by_day"] = keep("standings_by_day", I.standings_by_day(m["stg_daily_standings"], m["season_dates"]))
    m["team_game_line"] = keep("team_game_line", I.team_game_line(
        m["stg_game_summaries"], m["game_faceoffs"], m["game_penalties"], m["goalie_game_lines"],
        m["league_games"], m["skater_game_lines"]))
    m["skater_season"] = I.skater_season(m["skater_game_lines"], m["roster_players"])
    m["goalie_season"] = I.goalie_season(m["goalie_game_lines"])
    m["team_season_regular"] = I.team_season(m["team_game_line"], "regular")
    m["team_season_playoff"] = I.team_season(m["team_game_line"], "playoff")

    m["fct_plays"] = keep("fct_plays", facts.fct_plays(m["stg_plays"], m["league_games"], p))
    m["fct_games"] = facts.fct_games(m["team_game_line"], m["league_games"])
    m["fct_goalie_game"] = facts.fct_goalie_game(m["goalie_game_lines"], p, m["fct_plays"])
    m["fct_player_game"] = facts.fct_player_game(m["skater_game_lines"], m["fct_plays"], m["team_game_line"])
    m["fct_team_game"] = keep("fct_team_game", facts.fct_team_game(m["team_game_line"], m["fct_plays"]))
    m["fct_standings_daily"] = facts.fct_standings_daily(m["standings_by_day"], p)

    m["dim_dates"] = dims.dim_dates(spark, calendar_start, m["season_dates"], p)
    m["dim_seasons"] = dims.dim_seasons(m["league_games"], p, m["season_dates"])
    m["dim_players"] = dims.dim_players(m["roster_players"], m["skater_game_lines"], m["goalie_game_lines"], p)
    m["dim_player_team_bridge"] = dims.dim_player_team_bridge(m["skater_game_lines"], m["league_games"])
    if "stg_current_teams" in m:
        m["dim_teams"] = dims.dim_teams(m["stg_current_teams"], m["stg_daily_standings"], seeds,
                                        m["stg_games"], p)
        if "stg_schedules" in m:
            m["fct_upcoming_games"] = facts.fct_upcoming_games(m["stg_schedules"], m["dim_teams"], p)
            m["upcoming_games"] = marts.upcoming_games_mart(m["fct_upcoming_games"], m["dim_teams"])

    teams = m.get("dim_teams")
    listed = teams
    if listed is None:
        listed = m["team_game_line"].select("team_id", "team_abv", F.col("team_abv").alias("team_name")).distinct()
    m["team_power_rankings"] = metrics.team_power_rankings(
        m["team_game_line"], m["standings_by_day"], m["all_games"], listed.where(F.col("team_id").isNotNull()),
        m.get("current_standings"), p)
    m["team_season_metrics"] = metrics.team_season_metrics(m["fct_team_game"], teams)
    m["mart_team_power_rankings"] = metrics.mart_team_power_rankings(m["team_power_rankings"])

    m["all_players"] = marts.all_players(m["roster_players"])
    m["all_plays"] = marts.all_plays(m["stg_plays"])
    m["current_statwise_rankings"] = marts.statwise_rankings(m["team_season_regular"])
    m["goalies_season_stats_regular"] = marts.goalie_season_mart(m["fct_goalie_game"], "regular", p, m["dim_players"])
    m["goalies_season_stats_playoff"] = marts.goalie_season_mart(m["fct_goalie_game"], "playoff", p, m["dim_players"])
    m["mart_head_to_head"] = marts.head_to_head(m["fct_team_game"])
    m["mart_standings_weekly"] = marts.standings_weekly(m["standings_by_day"])
    m["mart_team_form"] = marts.team_form(m["standings_by_day"])
    m["mart_team_shot_metrics"] = marts.team_shot_metrics(m["fct_plays"], m["fct_team_game"])
    m["mart_three_stars"] = marts.three_stars_mart(m["stg_three_stars"], m["league_games"])
    m["players_history"] = marts.players_history(m["skater_game_lines"], m["goalie_game_lines"])
    m["skaters_season_stats_regular"] = marts.skater_season_mart(m["fct_player_game"], "regular", p, m["dim_players"])
    m["skaters_season_stats_playoff"] = marts.skater_season_mart(m["fct_player_game"], "playoff", p, m["dim_players"])
    m["standings_by_day_mart"] = marts.standings_by_day_mart(m["standings_by_day"])
    m["team_season_stats_regular"] = m["team_season_regular"]
    m["team_season_stats_playoff"] = m["team_season_playoff"]
    m["season_dates_mart"] = m["season_dates"]
    if teams is not None:
        m.update(published.tables(m, p))
    return m


def clustered(df: DataFrame) -> DataFrame:
    """Rows of a season together before a season-partitioned write, so a season gets
    a few files and not one per task; AQE splits a season that is too large."""
    return df.hint("rebalance", "season") if "season" in df.columns else df


def table_writer(base: str, spark: SparkSession):
    """A ``persist`` callback that publishes each shared model as a parquet table
    under ``base`` (partitioned by season when the model has one) and reads it
    back, instead of a checkpoint."""
    def keep(name: str, df: DataFrame) -> DataFrame:
        if name not in MATERIALISED:
            return df
        load_full_replace(clustered(df), f"{base.rstrip('/')}/{name}", ["season"] if "season" in df.columns else [])
        return spark.read.parquet(f"{base.rstrip('/')}/{name}")
    return keep


def bucketed_writer(base: str, buckets: int):
    """A ``persist`` callback that publishes the shared models of game grain bucketed by
    ``game_id``: the joins and aggregates by game of the facts and marts over them need no
    exchange.  Other shared models are checkpointed."""
    def keep(name: str, df: DataFrame) -> DataFrame:
        if name in MATERIALISED and "game_id" in df.columns:
            return write_bucketed(df, f"{base.rstrip('/')}/{name}", ["game_id"], buckets)
        return checkpointed(name, df)
    return keep


def publish(models: dict[str, DataFrame], base: str, names=None) -> list[str]:
    """Write the selected models (default: every mart and fact) as parquet
    tables under ``base``; returns the written names.  Season-partitioned where
    the model has a season column (dynamic partition overwrite)."""
    chosen = names or [n for n in models if n.startswith(("fct_", "dim_", "mart_")) or n in (
        "team_power_rankings", "team_season_metrics", "standings_by_day_mart", "skaters_season_stats_regular",
        "goalies_season_stats_regular", "current_statwise_rankings", "players_history", "upcoming_games")]
    for n in chosen:
        df = models[n]
        w = clustered(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        if "season" in df.columns:
            w = w.partitionBy("season")
        w.parquet(f"{base.rstrip('/')}/{n}")
    return chosen
