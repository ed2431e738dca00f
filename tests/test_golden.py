"""The reference's three literal-row unit tests, ported."""

from pyspark.sql import functions as F

from seasonflow.plans.season import intermediate as I
from seasonflow.plans.season import staging as ST
from tests import fixtures as FX


def _league(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "game_id long")


def test_penalty_offsetting_cancels(spark):
    plays = ST.stg_plays(FX.plays(spark, [
        {"game": 1, "event": 10, "type": "penalty", "team": 100, "period": 1, "clock": "05:00", "duration": 2},
        {"game": 1, "event": 11, "type": "penalty", "team": 200, "period": 1, "clock": "05:00", "duration": 2},
        {"game": 1, "event": 20, "type": "penalty", "team": 100, "period": 2, "clock": "10:00", "duration": 2},
        {"game": 1, "event": 30, "type": "penalty", "team": 200, "period": 3, "clock": "01:00", "duration": 10},
    ]))
    out = {r.team_id: r for r in I.game_penalties(plays, _league(spark, [1])).collect()}
    assert (out[100].pim, out[100].penalties_taken, out[100].times_shorthanded) == (4, 2, 1)
    assert (out[200].pim, out[200].penalties_taken, out[200].times_shorthanded) == (12, 2, 0)


def test_faceoff_counts_by_team(spark):
    plays = ST.stg_plays(FX.plays(spark, [
        {"game": 5, "event": 1, "type": "faceoff", "team": 100},
        {"game": 5, "event": 2, "type": "faceoff", "team": 100},
        {"game": 5, "event": 3, "type": "faceoff", "team": 200},
        {"game": 5, "event": 4, "type": "goal", "team": 200},
    ]))
    out = {r.team_id: (r.faceoffs_won, r.faceoffs_in_game) for r in I.game_faceoffs(plays, _league(spark, [5])).collect()}
    assert out == {100: (2, 3), 200: (1, 3)}


def test_goalie_season_gaa_is_per_sixty(spark):
    rows = [(1, 20252026, "regular", "HOM", 9, "G. One", True, "W", 2, 30, 32, 3600),
            (2, 20252026, "regular", "HOM", 9, "G. One", False, "L", 2, 10, 12, 1800)]
    lines = spark.createDataFrame(rows, "game_id long, season int, game_type string, team_abv string, "
                                        "player_id long, name string, starter boolean, result string, "
                                        "goals_against int, shots_saved int, shots_against int, toi_seconds int")
    for c in ("even_shots_saved", "even_shots_against", "pp_shots_saved", "pp_shots_against", "sh_shots_saved",
              "sh_shots_against", "pim"):
        lines = lines.withColumn(c, F.lit(0))
    r = I.goalie_season(lines).collect()[0]
    assert (r.gp, r.gaa, r.saves, r.shots_faced) == (2, 2.67, 40, 44)
