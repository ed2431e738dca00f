"""Presentation marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonflow.functions import exprs as X
from seasonflow.operators import dedup as D
from seasonflow.operators import joins as J
from seasonflow.operators import ranking as R
from seasonflow.operators import windows as W
from seasonflow.params import Params

# The 11 stat-wise rankings (stat, lower-is-better).
STATWISE = {"goals_per_game": False, "shots_per_game": False, "goals_against_average": True,
            "pp_goals": False, "pp_pct": False, "pk_pct": False, "pim_per_game": True, "hits_per_game": False,
            "blocks_per_game": False, "takeaways_per_game": False, "giveaways_per_game": True}


def all_players(roster: DataFrame) -> DataFrame:
    """Pass-through under a stable name."""
    return roster.select("team_abv", "role", "player_id", "full_name", "position", "number", "birth_date")


def all_plays(plays: DataFrame) -> DataFrame:
    """Pass-through of the staged plays."""
    return plays.drop("_loaded_at")


def statwise_rankings(team_season: DataFrame) -> DataFrame:
    """Per-season row_number for each available stat (team breaks ties) + ordinal text."""
    stats = {k: v for k, v in STATWISE.items() if k in team_season.columns}
    r = R.ordinals(team_season, stats, ["season"], ["team_abv"], suffix="_rank")
    return r.select("*", *[X.ordinal_suffix(f"{s}_rank").alias(f"{s}_rank_ordinal") for s in stats])


def _with_headshot(s: DataFrame, players: DataFrame | None, p: Params) -> DataFrame:
    """The player dimension's headshot; where it has none, the feed's picture of
    that season and team under ``p.headshot_prefix`` (no prefix: NULL)."""
    known = F.lit(None).cast("string")
    if players is not None:
        s = s.join(players.select("player_id", F.col("headshot_url").alias("__shot")), "player_id", "left")
        known = F.col("__shot")
    made = F.lit(None).cast("string") if p.headshot_prefix is None else F.concat(
        F.lit(p.headshot_prefix), F.concat_ws("/", F.col("season").cast("string"), "team_abv",
                                              F.col("player_id").cast("string")), F.lit(".png"))
    return s.withColumn("headshot_url", F.coalesce(known, made)).drop("__shot")


def goalie_season_mart(goalie_games: DataFrame, game_type: str = "regular", p: Params = Params(),
                       players: DataFrame | None = None) -> DataFrame:
    """Rollup of the goalie game fact; GP counts games with ice time,
    games dressed counts all; GSAA = round(saves - shots * 0.910, 1); qualified >= 15 GP."""
    g = goalie_games.filter(F.col("game_type") == game_type)
    s = g.groupBy("season", "player_id", "team_abv").agg(
        F.count_if(F.col("toi_seconds") > 0).alias("gp"), F.count(F.lit(1)).alias("games_dressed"),
        F.count_if(F.col("starter")).alias("starts"), F.count_if(F.col("result") == "W").alias("wins"),
        F.count_if(F.col("result") == "L").alias("losses"), F.count_if(F.col("result") == "O").alias("ot_losses"),
        F.count_if(F.col("is_shutout")).alias("shutouts"), F.count_if(F.col("quality_start")).alias("quality_starts"),
        F.sum("goals_against").alias("goals_against"), F.sum("shots_saved").alias("saves"),
        F.sum("shots_against").alias("shots_against"), F.sum("toi_seconds").alias("toi_seconds"))
    avg = F.lit(p.avg_save_pct).cast("decimal(4,3)")
    return _with_headshot(s, players, p).select("*", X.round_ratio(F.col("goals_against") * 3600, "toi_seconds", 2).alias("gaa"),
                    X.round_ratio("saves", "shots_against", 3).alias("save_pct"),
                    F.round(F.col("saves") - F.col("shots_against") * avg, 1).cast("double").alias("gsaa"),
                    (F.col("gp") >= p.min_games_goalie).alias("is_qualified"))


def head_to_head(team_games: DataFrame) -> DataFrame:
    """Series record per (season, game type, team, opponent)."""
    return team_games.groupBy("season", "game_type", "team_abv", "opponent_team_id").agg(
        F.count(F.lit(1)).alias("games"), F.count_if(F.col("game_result") == "W").alias("wins"),
        F.count_if(F.col("game_result") == "L").alias("losses"), F.count_if(F.col("game_result") == "OTL").alias("ot_losses"),
        F.sum("goals").alias("goals_for"), F.sum("goals_against").alias("goals_against"),
        F.count_if(F.col("is_home")).alias("home_games"))


def standings_weekly(by_day: DataFrame) -> DataFrame:
    """Filled daily standings kept on Mondays or on the season's final date."""
    last = by_day.groupBy("season").agg(F.max("date").alias("__final"))
    s = by_day.join(F.broadcast(last), "season")    # one row per season
    return (s.filter(X.is_monday("date") | (F.col("date") == F.col("__final")))
             .withColumn("is_final_date", F.col("date") == F.col("__final")).drop("__final"))


def team_form(by_day: DataFrame) -> DataFrame:
    """Latest snapshot per (season, team) with record strings."""
    top = D.dedup_latest(by_day, ["season", "team_abv"], [F.col("date").desc()])
    return top.select("season", "team_abv", F.col("date").alias("as_of_date"), "points", "gamesplayed",
                      X.record_string("wins", "losses", "otlosses").alias("record"),
                      X.record_string("l10wins", "l10losses", "l10otlosses").alias("last_10"),
                      F.concat(F.col("streak_code"), F.col("streakcount").cast("string")).alias("streak"))


def team_shot_metrics(plays_fact: DataFrame, team_games: DataFrame) -> DataFrame:
    """Corsi / Fenwick / even-strength Corsi per (season, team) — blocked
    shots belong to the *other* side — plus PDO from the team lines.
    Shootout attempts are dropped; regular and playoff games are pooled.  The season is
    the team line's, so a side without an attempt counts its opponent's."""
    a = plays_fact.filter(F.col("event_type_name").isin("goal", "shot-on-goal", "missed-shot", "blocked-shot")
                          & (F.col("period_category") != "Shootout") & F.col("event_side").isNotNull())
    blocked = F.col("event_type_name") == "blocked-shot"
    shooter_side = F.when(blocked, F.when(F.col("event_side") == "home", "away").otherwise("home")) \
                    .otherwise(F.col("event_side"))
    a = a.select("game_id", shooter_side.alias("side"), (~blocked).alias("unblocked"),
                 (F.col("strength_state") == "Even").alias("even"))
    per = a.groupBy("game_id", "side").agg(
        F.count(F.lit(1)).alias("cf"), F.count_if("unblocked").alias("ff"), F.count_if("even").alias("cf_even"))
    tg = team_games.select("game_id", "season", "team_abv", F.when(F.col("is_home"), "home").otherwise("away").alias("side"),
                           "goals", "goals_against", "shots", "shots_against", "saves")
    j = J.within(tg, per, "game_id", ["side"])
    j = J.opponent_join(j, ["game_id"], "side", ["cf", "ff", "cf_even"])
    z = lambda n: F.coalesce(F.col(n), F.lit(0))
    s = j.groupBy("season", "team_abv").agg(
        F.sum(z("cf")).alias("cf"), F.sum(z("opp_cf")).alias("ca"), F.sum(z("ff")).alias("ff"),
        F.sum(z("opp_ff")).alias("fa"), F.sum(z("cf_even")).alias("cf_even"), F.sum(z("opp_cf_even")).alias("ca_even"),
        F.sum("goals").alias("gf"), F.sum("goals_against").alias("ga"), F.sum("shots").alias("sf"),
        F.sum("shots_against").alias("sa"), F.sum("saves").alias("saves"))
    share = lambda x, y: X.round_ratio(x, F.col(x) + F.col(y), 4)
    parts = F.coalesce(X.safe_divide("gf", "sf"), F.lit(0.0)) + F.coalesce(X.safe_divide("saves", "sa"), F.lit(0.0))
    return s.select("*", share("cf", "ca").alias("corsi_pct"), share("ff", "fa").alias("fenwick_pct"),
                    share("cf_even", "ca_even").alias("even_corsi_pct"),
                    X.round_ratio("gf", "sf", 4).alias("shooting_pct"), X.round_ratio("saves", "sa", 4).alias("save_pct"),
                    F.round(parts * 1000, 1).alias("pdo"))


def three_stars_mart(stars: DataFrame, league: DataFrame) -> DataFrame:
    """Universe-filtered stars with per-player selection counts per season."""
    s = J.semi(stars, league.select("game_id"), "game_id")
    return W.partition_counts(s, ["season", "player_id"],
                              {"times_selected": None, "first_star_count": F.col("star") == 1})


def players_history(skater_lines: DataFrame, goalie_lines: DataFrame) -> DataFrame:
    """Distinct (player, team) pairs."""
    return (skater_lines.select("player_id", "team_abv")
            .unionByName(goalie_lines.select("player_id", "team_abv")).distinct())


def skater_season_mart(player_games: DataFrame, game_type: str = "regular", p: Params = Params(),
                       players: DataFrame | None = None) -> DataFrame:
    """Rollup of the player game fact with per-60 rates and a
    qualification flag (>= 10 GP)."""
    g = player_games.filter(F.col("game_type") == game_type)
    s = g.groupBy("season", "player_id", "team_abv").agg(
        F.count(F.lit(1)).alias("gp"), *[F.sum(c).alias(c) for c in (
            "goals", "assists", "points", "primary_assists", "shots", "hits", "pim", "toi_seconds",
            "game_winning_goals", "shorthanded_goals", "faceoffs_won", "faceoffs_lost")],
        F.count_if("is_hat_trick").alias("hat_tricks"))
    return _with_headshot(s, players, p).select("*", X.round_ratio(F.col("points") * 3600, "toi_seconds", 2).alias("points_per_60"),
                    X.round_ratio(F.col("goals") * 3600, "toi_seconds", 2).alias("goals_per_60"),
                    X.round_ratio("toi_seconds", F.col("gp") * 60, 2).alias("toi_minutes_per_game"),
                    (F.col("gp") >= p.min_games_skater).alias("is_qualified"))


def standings_by_day_mart(by_day: DataFrame) -> DataFrame:
    """Filled standings plus the display season."""
    return by_day.select("*", X.season_display("season").alias("season_display"))


def upcoming_games_mart(upcoming: DataFrame, teams: DataFrame) -> DataFrame:
    """Future games (not yet final) with both logos (role-playing join)."""
    t = teams.select("team_abv", F.col("logo_url").alias("logo")) if "logo_url" in teams.columns else \
        teams.select("team_abv", F.lit(None).cast("string").alias("logo"))
    return J.role_playing(upcoming, t, "team_abv", {"home": "home_team_abv", "away": "away_team_abv"}, ["logo"])
