"""What keeps the season models' time and bytes in proportion to their rows: shared steps
are derived once, by game, and written with the columns that are read."""

import re

import pytest

from pyspark.sql import functions as F

from seasonflow.operators import joins as J
from seasonflow.operators.netting import offset_netting
from seasonflow.plans import feed_models as FM
from seasonflow.plans.season import facts
from seasonflow.plans.testbed import Bed

SF = "/root/testdata/sf0.001"


@pytest.fixture
def merging(spark):
    """Joins as between tables too large for a broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def on_disk(spark, tmp_path, data, schema):
    path = str(tmp_path / "t")
    spark.createDataFrame(data, schema).write.parquet(path)
    return spark.read.parquet(path)


def test_opponent_join_derives_its_frame_once(merging, tmp_path):
    df = on_disk(merging, tmp_path, [(1, "a", 5), (1, "b", None), (2, "a", 7), (None, "a", 8), (None, "b", 9), (3, None, 1),
                                     (3, "c", 2), (4, "a", 1), (4, "a", 2), (4, "b", 3), (4, "c", 4)], "g int, s string, v int")
    out = J.opponent_join(df, ["g"], "s", ["v"])
    assert plan(out).count("FileScan") == 1 and plan(out).count("Exchange hashpartitioning") == 1
    a, b = df.alias("a"), df.alias("b")
    met = (F.col("a.g") == F.col("b.g")) & (F.col("a.s") != F.col("b.s"))
    for how in ("left", "inner"):
        plain = a.join(b, met, how).select("a.*", F.col("b.s").alias("opp_s"), F.col("b.v").alias("opp_v"))
        got = J.opponent_join(df, ["g"], "s", ["v"], how=how)
        assert got.columns == ["g", "s", "v", "opp_s", "opp_v"] and rows(got) == rows(plain)


def test_within_moves_no_row_that_lies_by_game(merging, tmp_path):
    df = on_disk(merging, tmp_path, [(1, "a", 5), (1, "b", 6), (1, "a", 7), (2, None, 8), (None, "a", 9)], "g int, s string, v int")
    left = df.repartition("g")
    right = df.repartition("g").groupBy("g", "s").agg(F.sum("v").alias("t"))
    for how in ("left", "inner"):
        out = J.within(left, right, "g", ["s"], how)
        assert plan(out).count("Exchange hashpartitioning") == 2
        assert rows(out) == rows(left.join(right, ["g", "s"], how).select("g", "s", "v", "t"))


def test_offset_netting_reads_the_events_once(merging, tmp_path):
    ev = [(1, "A", 1, 2), (1, "A", 1, 2), (1, "B", 1, 2), (1, None, 1, 2), (1, "A", None, 5), (1, "B", None, 5), (None, "A", 1, 2),
          (2, "A", 3, 10), (2, "A", 3, 4), (2, "B", 3, 4), (2, "C", 3, 4), (2, "C", 3, 4), (2, "C", 3, 4)]
    df = on_disk(merging, tmp_path, ev, "g int, side string, clock int, dur int")
    out = offset_netting(df, ["g"], "side", ["clock"], "dur", "dur", F.col("dur").isin(2, 4, 5))
    assert plan(out).count("FileScan") == 1
    # a NULL side or clock cancels nothing, a NULL game or side has no net events
    assert {tuple(r) for r in out.collect()} == {(1, "A", 9, 3, 2), (1, "B", 7, 2, 1), (1, None, 2, 1, 0), (None, "A", 2, 1, 0),
                                                 (2, "A", 14, 2, 0), (2, "B", 4, 1, 0), (2, "C", 12, 3, 1)}


def test_the_universe_is_written_from_one_derivation_of_the_games(spark):
    bed = Bed(spark, SF)
    games = bed.written("games")
    assert "lineitem.parquet" not in plan(bed.universe(games)) and plan(bed.universe()).count("lineitem.parquet") > 1
    assert rows(bed.written("universe")) == rows(bed.universe()) and bed._tables["games"] is games


def test_player_games_place_lines_once(merging):
    assert "hashpartitioning(l_orderkey" in plan(Bed(merging, SF).player_games())
    assert "hashpartitioning(game_id" not in plan(Bed(merging, SF).player_games())


def test_staged_plays_are_written_with_the_columns_read(spark):
    bed = Bed(spark, SF)
    staged = FM.staged_plays(bed, FM.TEAM_COLUMNS)
    full = FM.ST.stg_plays(FM.play_feed(bed))
    assert staged.dtypes == full.dtypes and rows(staged.select(*FM.TEAM_COLUMNS)) == rows(full.select(*FM.TEAM_COLUMNS))
    assert "ExistingRDD" not in plan(staged.select("game_id")) and "ReadSchema: struct<game_id:bigint>" in plan(staged.select("game_id"))
    with pytest.raises(Exception, match="was not written"):
        staged.select("x_pos").collect()


def test_only_actor_keys_of_a_play_meet_the_league(merging):
    bed = Bed(merging, SF)
    p = plan(facts.fct_plays(FM.ST.stg_plays(FM.play_feed(bed)), FM.league_feed(bed)).select("primary_player_key", "season"))
    join = p.splitlines().index(next(line for line in p.splitlines() if "SortMergeJoin [game_id" in line))
    assert "CASE WHEN" not in "\n".join(p.splitlines()[:join])


@pytest.mark.parametrize("key", ["shot_metrics_model", "team_game_model", "games_model", "player_game_model", "team_season_model"])
def test_models_of_game_lines_move_rows_by_game_only(merging, key):
    """No checkpoint of whole rows, and no key of a game and a team or player beside the game."""
    from __spark_entry__ import queries
    p = plan(queries()[key](merging, SF))
    assert "ExistingRDD" not in p and not re.search(r"hashpartitioning\(game_id, (?!\d+\))", p)
