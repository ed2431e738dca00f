"""Metrics (M44, M45, M52) on the season layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonflow.params import Params
from seasonflow.plans import power_model as PM
from seasonflow.plans.season import power_rankings as PR

OPTIONAL = ("shots_against", "hits", "blocks", "giveaways", "takeaways", "faceoffs_won", "faceoffs_in_game")


def team_games(team_games_fact: DataFrame) -> DataFrame:
    return team_games_fact.select(
        "season", F.col("team_id").alias("team"), F.col("opponent_team_id").alias("opponent"), "game_id",
        "game_date", "game_type", F.col("goals").alias("goals_for"), "goals_against", "points", "shots", "pp_goals",
        "pp_attempts", "pk_attempts", "pk_goals_against",
        *[c for c in OPTIONAL if c in team_games_fact.columns])


def team_power_rankings(team_lines: DataFrame, by_day: DataFrame, all_games: DataFrame, teams: DataFrame,
                        current_standings: DataFrame | None = None, p: Params = Params()) -> DataFrame:
    """Published power score and rank per team for the latest season."""
    lines = team_lines.withColumn("season", F.col("season").cast("int"))
    games = all_games.select("season", F.col("HOMETEAM_ABBREV").alias("home_abv"), F.col("AWAYTEAM_ABBREV").alias("away_abv"))
    cur = None
    if current_standings is not None:
        cur = current_standings.select("team_abv", "points", F.col("gp").alias("games_played"), F.try_divide(
            F.col("points").cast("double"), F.col("gp").cast("double") * 2).alias("point_pct"))
    return PR.power_rankings(lines, by_day, games, lines.select("season"), teams, cur, p)


def team_season_metrics(team_games_fact: DataFrame, teams: DataFrame | None = None) -> DataFrame:
    """Latest-season totals, percentages, ranks, conference ranks, percentiles."""
    conf = None
    if teams is not None and "conference" in teams.columns:
        conf = teams.select(F.col("team_id").alias("team"), "conference").filter(F.col("team").isNotNull())
    return PM.season_metrics(team_games(team_games_fact), conf)


def mart_team_power_rankings(power: DataFrame) -> DataFrame:
    """The published rankings under a stable name."""
    return power
