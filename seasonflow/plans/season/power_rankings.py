"""Team power rankings (M44) as published: standings snapshots give the points shares, the
last-ten form and the previous season's final order; game lines give goals, shots,
special teams, the last five games and the playoff results.

* a team's points share comes from the current standings (regular games only), its
  last-ten split from its latest daily snapshot, its schedule from the current shares of
  all opponents in the season's games of any type;
* the last five games count all game types, newest first;
* the previous season's score: final order in the standings, half of it the playoffs.

Game lines are read once for both seasons: one aggregate with conditional sums and one
top-five group limit.  Snapshots are looked up as of the end of each season with one
aggregate.  After that every frame has a row a team; ranks go through range
partitions and min-max scaling through a one-row aggregate, not a window over all rows.

Fixed values of the model (must equal the reference's): see ``power_model``; here a metric
whose range is zero has no scaled value, and the trend needs three of the last five games.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonflow.functions import exprs as X
from seasonflow.operators import ranking as R
from seasonflow.operators import windows as W
from seasonflow.operators.dedup import latest_as_of
from seasonflow.params import Params

SCALED = {"point_pct": False, "goal_differential_per_game": False, "goals_per_game": False, "goals_against_per_game": True,
          "shots_per_game": False, "pp_share": False, "pk_share": False, "opponent_avg_points_pct": False,
          "last_10_points_pct": False, "recent_goal_differential": False}
# Weights of points, goals, advanced, schedule, momentum below 5 and 10 games, and from there on
WEIGHTS = ((5, (0.35, 0.30, 0.15, 0.10, 0.10)), (10, (0.32, 0.28, 0.18, 0.12, 0.10)), (None, (0.30, 0.25, 0.20, 0.15, 0.10)))
NEUTRAL = 50.0


def _ratio(a, b) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.try_divide(a.cast("double"), b.cast("double"))


def two_seasons(seasons: DataFrame) -> DataFrame:
    """One row: the newest season and the one before it (NULL without one)."""
    top = seasons.select("season").distinct().orderBy(F.col("season").desc()).limit(2)
    return top.agg(F.max("season").alias("cur_"), F.when(F.count(F.lit(1)) == 2, F.min("season")).alias("prev_"))


def season_ends(by_day: DataFrame, scalars: DataFrame) -> DataFrame:
    """Each team's last snapshot of both seasons, with its points share."""
    rows = by_day.join(F.broadcast(scalars), F.col("season").isin(F.col("cur_"), F.col("prev_")))
    ends = latest_as_of(rows, ["season", "team_abv"], "date")
    return ends.select(
        "team_abv", (F.col("season") == F.col("cur_")).alias("current"), F.col("gamesplayed").alias("games_played"), "points",
        "wins", (F.col("goalfor") - F.col("goalagainst")).alias("goal_diff"),
        _ratio("points", F.col("gamesplayed") * 2).alias("point_pct"), F.col("l10points").alias("l10_points"),
        (F.col("l10wins") + F.col("l10losses") + F.col("l10otlosses")).alias("l10_games"))


def game_record(lines: DataFrame, scalars: DataFrame) -> DataFrame:
    """Per team: the current season's regular totals, its last five games of any type, and
    the previous season's playoff results."""
    rows = lines.join(F.broadcast(scalars), F.col("season").isin(F.col("cur_"), F.col("prev_")))
    cur, reg = F.col("season") == F.col("cur_"), F.col("game_type") == "regular"
    now, before = cur & reg, ~cur & (F.col("game_type") == "playoff")
    won, lost = F.col("goals") > F.col("goals_against"), F.col("goals") < F.col("goals_against")

    def total(cond: Column, c: str) -> Column:
        return F.sum(F.when(cond, F.col(c)))
    record = rows.groupBy("team_abv").agg(
        F.count_if(now).alias("lines"), *[total(now, c).alias(c) for c in (
            "goals", "goals_against", "shots", "pp_goals", "pp_attempts", "pk_attempts", "pk_goals_against")],
        F.count_if(before).alias("po_games"), F.count_if(before & won).alias("po_wins"), F.count_if(before & lost).alias("po_losses"),
        total(before, "goals").alias("po_goals"), total(before, "goals_against").alias("po_against"))
    five = W.last_n(rows.where(cur), ["team_abv"], [F.col("game_date").desc(), F.col("game_id").desc()], 5, rank_col="__rn")
    recent = five.groupBy("team_abv").agg(
        F.count_if(won).alias("recent_wins"), F.count_if(~won).alias("recent_losses"), F.count(F.lit(1)).alias("recent_games"),
        F.sum(F.col("goals") - F.col("goals_against")).alias("recent_goal_differential"))
    return record.join(recent, "team_abv", "left")


def schedule_strength(games: DataFrame, shares: DataFrame, scalars: DataFrame) -> DataFrame:
    """Mean current points share of a team's opponents over the season's games of all
    types; opponents without a standing are left out."""
    g = games.join(F.broadcast(scalars), F.col("season") == F.col("cur_"))
    pairs = g.select(F.inline(F.array(
        F.struct(F.col("home_abv").alias("team_abv"), F.col("away_abv").alias("opponent")),
        F.struct(F.col("away_abv").alias("team_abv"), F.col("home_abv").alias("opponent")))))
    # a pair of teams meets many times: counted before the join
    met = pairs.groupBy("team_abv", "opponent").agg(F.count(F.lit(1)).alias("met"))
    share = shares.where(F.col("point_pct").isNotNull()).select(F.col("team_abv").alias("opponent"), "point_pct")
    return met.join(share, "opponent").groupBy("team_abv").agg(
        (F.sum(F.col("point_pct") * F.col("met")) / F.sum("met")).alias("sos"))


def previous_scores(ends: DataFrame, record: DataFrame, p: Params) -> DataFrame:
    """The previous season's score of each team in its final standings."""
    final = R.multi_key_rank(ends.where("NOT current"), [F.col("point_pct").desc(), F.col("wins").desc(),
                                                         F.col("goal_diff").desc(), F.col("team_abv").asc()], name="final_rank")
    po = record.select("team_abv", "po_games", "po_wins", "po_losses", "po_goals", "po_against")
    t = final.select("team_abv", "final_rank").join(po, "team_abv", "left")
    n, wins = F.coalesce("po_games", F.lit(0)), F.coalesce("po_wins", F.lit(0))
    played = n > 0
    order = 100.0 * (p.team_count - F.col("final_rank")) / (p.team_count - 1.0)
    # goals per game for and against are rounded before they are subtracted
    diff = X.round_ratio("po_goals", "po_games", 2) - X.round_ratio("po_against", "po_games", 2)
    share = _ratio(wins, n)
    playoff = wins / 16.0 * 100.0 * 0.6 + share * 100.0 * 0.2 + (diff + 2.0) * 10.0 * 0.2
    reached = (F.when(wins >= 12, 4).when(wins >= 8, 3).when(wins >= 4, 2)
               .when((wins > 0) | (F.coalesce("po_losses", F.lit(0)) > 0), 1).otherwise(0))
    return t.select("team_abv", F.when(played, order * 0.5 + playoff * 0.5).otherwise(order * 0.8).alias("prev_score"),
                    reached.alias("playoff_round"), F.coalesce(share, F.lit(0.0)).alias("playoff_win_pct"),
                    wins.alias("playoff_wins"), n.alias("playoff_games"))


def team_metrics(lines: DataFrame, by_day: DataFrame, games: DataFrame, seasons: DataFrame, teams: DataFrame,
                 current: DataFrame | None = None, p: Params = Params()) -> DataFrame:
    """One row for each team with a current standing and games this season."""
    scalars = two_seasons(seasons)
    ends = season_ends(by_day, scalars)
    snapshot = ends.where("current")
    if current is None:
        current = snapshot.select("team_abv", "points", "games_played", "point_pct")
    record = game_record(lines, scalars)
    sos = schedule_strength(games, current, scalars)
    form = snapshot.select("team_abv", _ratio("l10_points", F.col("l10_games") * 2).alias("l10"))
    prev = previous_scores(ends, record, p)
    t = (teams.select("team_id", "team_abv", "team_name").join(current, "team_abv")
         .join(record.where(F.col("lines") > 0), "team_abv").join(form, "team_abv", "left").join(sos, "team_abv", "left")
         .join(prev, "team_abv", "left"))
    gp = F.col("games_played")

    def per_game(x: Column) -> Column:
        return F.when(gp > 0, _ratio(x, gp)).otherwise(0.0)
    return t.select(
        "team_id", "team_abv", "team_name", "games_played", "point_pct", per_game(F.col("goals")).alias("goals_per_game"),
        per_game(F.col("goals_against")).alias("goals_against_per_game"),
        per_game(F.col("goals") - F.col("goals_against")).alias("goal_differential_per_game"),
        per_game(F.col("shots")).alias("shots_per_game"), _ratio("pp_goals", "pp_attempts").alias("pp_share"),
        _ratio(F.col("pk_attempts") - F.col("pk_goals_against"), "pk_attempts").alias("pk_share"),
        F.coalesce("l10", "point_pct", F.lit(0.0)).alias("last_10_points_pct"), F.col("l10").isNotNull().alias("has_l10"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("recent_wins", "recent_losses", "recent_games", "recent_goal_differential")],
        F.coalesce("sos", F.lit(0.5)).alias("opponent_avg_points_pct"), F.coalesce("prev_score", F.lit(NEUTRAL)).alias("prev_score"),
        "playoff_round", "playoff_win_pct", "playoff_wins", "playoff_games")


def power_rankings(lines: DataFrame, by_day: DataFrame, games: DataFrame, seasons: DataFrame, teams: DataFrame,
                   current: DataFrame | None = None, p: Params = Params()) -> DataFrame:
    """The published table.  ``lines``: team game lines; ``by_day``: daily standings;
    ``games``: (season, home_abv, away_abv); ``seasons``: the seasons loaded; ``teams``:
    (team_id, team_abv, team_name); ``current``: (team_abv, points, games_played,
    point_pct), by default each team's latest snapshot of the newest season.
    Equal scores are ranked by team; a team without a score comes last."""
    t = R.minmax_normalize(team_metrics(lines, by_day, games, seasons, teams, current, p), SCALED, suffix="_s", neutral=None)
    c, gp = F.col, F.col("games_played")
    played = lambda name: F.when(gp > 0, c(f"{name}_s")).otherwise(0.0)
    sos = F.when(gp > 0, c("opponent_avg_points_pct_s")).otherwise(NEUTRAL)
    last10 = F.when(c("has_l10"), c("last_10_points_pct_s")).otherwise(0.0)
    recent = F.when(c("recent_games") > 0, c("recent_goal_differential_s")).otherwise(0.0)
    trend = F.when(c("recent_games") >= 3, _ratio(c("recent_wins") - c("recent_losses"), "recent_games") * 100).otherwise(0.0)
    t = t.withColumns({
        "points_component": played("point_pct"),
        "goal_component": (played("goal_differential_per_game") * 0.5 + played("goals_per_game") * 0.3
                           + played("goals_against_per_game") * 0.2),
        "advanced_stats_component": F.when(gp >= 5, played("shots_per_game") * 0.4 + played("pp_share") * 0.3
                                           + played("pk_share") * 0.3).otherwise(NEUTRAL),
        "schedule_component": F.when(gp >= 5, sos).otherwise(NEUTRAL),
        "momentum_component": F.when(gp >= 10, last10 * 0.6 + recent * 0.4).when(gp >= 5, trend * 0.5 + recent * 0.5)
        .otherwise(NEUTRAL),
        "cw": F.when(gp >= 20, 1.0).when(gp == 0, 0.0).otherwise(gp / 20.0)})
    t = t.withColumn("pw", F.lit(1.0) - c("cw"))
    parts = ("points_component", "goal_component", "advanced_stats_component", "schedule_component", "momentum_component")
    score = F.when(gp == 0, c("prev_score"))
    for below, weights in WEIGHTS:
        own = sum((c(n) * w for n, w in zip(parts[1:], weights[1:], strict=True)), c(parts[0]) * weights[0])
        mixed = c("prev_score") * c("pw") + own * c("cw")
        score = score.when(gp < below, mixed) if below else score.when(gp < 20, mixed).otherwise(own)
    t = R.multi_key_rank(t.withColumn("power_score", score), [F.col("power_score").desc_nulls_last(), F.col("team_abv").asc()],
                         name="power_rank")
    reached = c("playoff_round")
    return t.select(
        F.lit(p.as_of).alias("ranking_date"), "team_id", "team_abv", "team_name", "power_score", "power_rank", *parts,
        *[F.round(s, d).alias(n) for n, s, d in (
            ("point_pct", c("point_pct"), 3), ("goals_per_game", c("goals_per_game"), 2),
            ("goals_against_per_game", c("goals_against_per_game"), 2),
            ("goal_differential_per_game", c("goal_differential_per_game"), 2), ("shots_per_game", c("shots_per_game"), 1),
            ("pp_pct", c("pp_share") * 100, 1), ("pk_pct", c("pk_share") * 100, 1),
            ("last_10_points_pct", c("last_10_points_pct"), 3))],
        c("recent_wins").alias("last_5_wins"), c("recent_losses").alias("last_5_losses"),
        c("recent_goal_differential").alias("last_5_goal_diff"),
        F.round("opponent_avg_points_pct", 3).alias("strength_of_schedule"), "games_played",
        F.round(c("cw") * 100, 1).alias("current_season_weight_pct"), F.round(c("pw") * 100, 1).alias("previous_season_weight_pct"),
        reached.alias("prev_playoff_round"),
        F.when(reached == 4, "Cup Finals").when(reached == 3, "Conference Finals").when(reached == 2, "Second Round")
        .when(reached == 1, "First Round").when(reached.isNotNull(), "Missed Playoffs").alias("prev_playoff_result"),
        F.round(c("playoff_win_pct") * 100, 1).alias("prev_playoff_win_pct"), c("playoff_wins").alias("prev_playoff_wins"),
        c("playoff_games").alias("prev_playoff_games"))
