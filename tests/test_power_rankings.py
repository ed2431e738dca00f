"""Power rankings from standings snapshots: playoff games count in the last five only."""

import datetime as dt

import pytest

from seasonflow.operators.dedup import latest_as_of
from seasonflow.params import Params
from seasonflow.plans.season import power_rankings as PR

D = dt.date


def lines(spark, games):
    """games: (season, id, type, date, home, away, home goals, away goals, home shots, away shots)"""
    rows = []
    for s, i, t, d, h, a, hg, ag, hs, as_ in games:
        rows += [(s, i, t, d, h, hg, ag, hs, 1, 4, 2, 1), (s, i, t, d, a, ag, hg, as_, 0, 2, 4, 1)]
    return spark.createDataFrame(rows, "season int, game_id long, game_type string, game_date date, team_abv string, goals int, "
                                       "goals_against int, shots int, pp_goals int, pp_attempts int, pk_attempts int, "
                                       "pk_goals_against int")


def by_day(spark, rows):
    """rows: (season, date, team, gp, points, wins, gf, ga, l10 wins, losses, ot losses, points)"""
    return spark.createDataFrame(rows, "season int, date date, team_abv string, gamesplayed int, points int, wins int, "
                                       "goalfor int, goalagainst int, l10wins int, l10losses int, l10otlosses int, l10points int")


NOW, BEFORE = 20252026, 20242025
GAMES = [(BEFORE, 1, "regular", D(2025, 1, 1), "A", "B", 2, 1, 20, 20), (BEFORE, 2, "playoff", D(2025, 5, 1), "A", "B", 1, 4, 20, 30),
         (BEFORE, 3, "playoff", D(2025, 5, 3), "B", "A", 0, 3, 22, 25),
         (NOW, 4, "regular", D(2025, 10, 1), "A", "B", 3, 1, 30, 20), (NOW, 5, "playoff", D(2026, 5, 1), "A", "B", 0, 2, 25, 35)]
SNAPSHOTS = [(BEFORE, D(2025, 1, 1), "A", 1, 2, 1, 2, 1, 1, 0, 0, 2), (BEFORE, D(2025, 1, 1), "B", 1, 0, 0, 1, 2, 0, 1, 0, 0),
             (NOW, D(2025, 9, 30), "A", 0, 0, 0, 0, 0, 0, 0, 0, 0), (NOW, D(2025, 9, 30), "B", 0, 0, 0, 0, 0, 0, 0, 0, 0),
             (NOW, D(2025, 10, 2), "A", 1, 2, 1, 3, 1, 1, 0, 0, 2), (NOW, D(2025, 10, 2), "B", 1, 0, 0, 1, 3, 0, 1, 0, 0)]


@pytest.fixture(scope="module")
def ranked(spark):
    g = lines(spark, GAMES)
    games = spark.createDataFrame([(s, h, a) for s, _, _, _, h, a, *_ in GAMES], "season int, home_abv string, away_abv string")
    teams = spark.createDataFrame([(1, "A", "Ants"), (2, "B", "Bees"), (3, "C", "Cats")], "team_id long, team_abv string, team_name string")
    out = PR.power_rankings(g, by_day(spark, SNAPSHOTS), games, g.select("season"), teams, p=Params(as_of=D(2026, 6, 1)))
    return {r.team_abv: r for r in out.collect()}


def test_shares_come_from_standings(ranked):
    a, b = ranked["A"], ranked["B"]
    assert set(ranked) == {"A", "B"}                       # C has no standing
    assert (a.last_10_points_pct, b.last_10_points_pct) == (1.0, 0.0)
    # both games were against B, whose share is 0; a playoff win gives no standings points
    assert (a.strength_of_schedule, b.strength_of_schedule) == (0.0, 1.0)
    assert (a.point_pct, b.point_pct, a.games_played) == (1.0, 0.0, 1)
    # the last five count the playoff game
    assert (a.last_5_wins, a.last_5_losses, a.last_5_goal_diff) == (1, 1, 0)
    assert (a.goals_per_game, a.goals_against_per_game, a.shots_per_game, a.pp_pct, a.pk_pct) == (3.0, 1.0, 30.0, 25.0, 50.0)
    assert a.ranking_date == D(2026, 6, 1) and a.team_name == "Ants"


def test_previous_season_and_scores(ranked):
    a, b = ranked["A"], ranked["B"]
    assert (a.prev_playoff_round, a.prev_playoff_result, a.prev_playoff_win_pct, a.prev_playoff_wins, a.prev_playoff_games) == (
        1, "First Round", 50.0, 1, 2)
    # final ranks 1 and 2; goals per game 2.0 for and against
    prev_a = 100.0 * 0.5 + (1 / 16 * 60 + 0.5 * 20 + 2.0 * 2) * 0.5
    prev_b = 100.0 * 30 / 31 * 0.5 + (1 / 16 * 60 + 0.5 * 20 + 2.0 * 2) * 0.5
    assert (a.points_component, b.points_component, a.goal_component, b.goal_component) == (100.0, 0.0, 100.0, 0.0)
    assert a.advanced_stats_component == a.schedule_component == a.momentum_component == 50.0
    rest = 50 * (0.15 + 0.10 + 0.10)
    assert a.power_score == pytest.approx(prev_a * 0.95 + (100 * 0.65 + rest) * 0.05)
    assert b.power_score == pytest.approx(prev_b * 0.95 + rest * 0.05)
    assert (a.power_rank, b.power_rank, a.current_season_weight_pct, a.previous_season_weight_pct) == (1, 2, 5.0, 95.0)


def test_without_a_previous_season(spark):
    g = lines(spark, [x for x in GAMES if x[0] == NOW])
    games = spark.createDataFrame([(NOW, "A", "B")], "season int, home_abv string, away_abv string")
    teams = spark.createDataFrame([(1, "A", "Ants"), (2, "B", "Bees")], "team_id long, team_abv string, team_name string")
    snaps = by_day(spark, [x for x in SNAPSHOTS if x[0] == NOW])
    out = {r.team_abv: r for r in PR.power_rankings(g, snaps, games, g.select("season"), teams).collect()}
    assert out["A"].prev_playoff_round is None and out["A"].prev_playoff_result is None
    assert out["B"].power_score == pytest.approx(50 * 0.95 + 50 * 0.35 * 0.05)


def test_latest_as_of(spark):
    rows = [("a", D(2025, 1, 1), 1, 5), ("a", D(2025, 1, 3), 2, 6), ("a", D(2025, 1, 3), 3, 4), ("a", None, 9, 9), ("b", D(2025, 1, 2), 4, 4)]
    df = spark.createDataFrame(rows, "k string, d date, n int, t int").repartition(3)
    at = lambda day: sorted(tuple(r) for r in latest_as_of(df, ["k"], "d", day, ["n"]).collect())
    assert at(None) == at(D(2025, 2, 1)) == [("a", D(2025, 1, 3), 3, 4), ("b", D(2025, 1, 2), 4, 4)]
    assert at(D(2025, 1, 2)) == [("a", D(2025, 1, 1), 1, 5), ("b", D(2025, 1, 2), 4, 4)] and at(D(2024, 1, 1)) == []
    assert "Window" not in latest_as_of(df, ["k"], "d")._jdf.queryExecution().executedPlan().toString()
