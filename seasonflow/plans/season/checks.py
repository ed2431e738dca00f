"""The reference's declarative schema tests re-expressed as distributed checks
over the built season models (Q01–Q08): grains, not-null keys, foreign keys,
accepted values, ranges, source freshness; one summary frame."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonflow.operators import quality as Q

GRAINS = {
    "league_games": ["game_id"],
    "stg_game_summaries": ["game_id", "team_abv"],
    "fct_plays": ["game_id", "event_id"],
    "fct_team_game": ["game_id", "team_id"],
    "fct_player_game": ["game_id", "player_id"],
    "fct_goalie_game": ["game_id", "player_id"],
    "standings_by_day": ["season", "date", "team_abv"],
    "dim_players": ["player_id"],
}


def run_checks(models: dict[str, DataFrame], raw: dict[str, DataFrame] | None = None,
               as_of: dt.datetime | None = None) -> DataFrame:
    checks, counted = [], []
    for name, keys in GRAINS.items():
        if name in models:
            checks.append(("unique" if len(keys) == 1 else "unique_combination", f"{name}({','.join(keys)})",
                           Q.ERROR, Q.unique(models[name], keys)))
    if "league_games" in models:
        counted.append(Q.row_checks(models["league_games"], [
            ("not_null", f"league_games.{c}", Q.ERROR, F.col(c).isNull()) for c in ("season", "game_id", "game_date")]))
    if "fct_team_game" in models and "league_games" in models:
        checks.append(("relationships", "fct_team_game.game_id", Q.ERROR,
                       Q.relationships(models["fct_team_game"], "game_id", models["league_games"], "game_id")))
        counted.append(Q.row_checks(models["fct_team_game"], [
            ("accepted_values", "fct_team_game.game_result", Q.ERROR, ~F.col("game_result").isin("W", "L", "OTL")),
            ("accepted_values", "fct_team_game.points", Q.ERROR, ~F.col("points").isin(0, 1, 2)),
            ("range", "fct_team_game.goals", Q.ERROR, F.col("goals") < 0)]))
    if "fct_standings_daily" in models:
        played = F.col("games_played") > 0
        counted.append(Q.row_checks(models["fct_standings_daily"], [
            ("range", "fct_standings_daily.points_pace", Q.WARN,
             played & ((F.col("points_pace") < 0) | (F.col("points_pace") > 200)))]))
    out = Q.summary(checks, counted)
    if raw is not None and as_of is not None:
        fresh = [Q.freshness(df, "_loaded_at", as_of, 24, 48, target=name).select("check", "target", "severity")
                 for name, df in raw.items() if "_loaded_at" in df.columns]
        for f in fresh:
            out = out.unionByName(f.select("check", "target", "severity", F.lit(None).cast("bigint").alias("violations"),
                                           F.col("severity").alias("status")))
    return out
