"""Versioned tables: stopped writes, repeated batches, key index, slices."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from seasonflow.sources.tables import Conflict, Table, content_id


@pytest.fixture
def base():
    return tempfile.mkdtemp(prefix="sf-test-", dir="/tmp")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_stopped_write_leaves_the_old_table(spark, base):
    t = Table(spark, base)
    t.replace(spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string"))
    bad = spark.range(10).select(F.col("id").cast("int").alias("id"),
                                 F.when(F.col("id") < 9, "z").otherwise(F.raise_error(F.lit("stopped"))).alias("v"))
    for stopped in (t.replace, t.append):
        with pytest.raises(Exception):
            stopped(bad)
        assert rows(t.read()) == [(1, "x"), (2, "y")] and t.versions() == [0]
    # a load may read the table that it replaces, and readers of the old version go on
    before = t.read()
    t.replace(t.read().where("id = 1"))
    assert rows(t.read()) == [(1, "x")] and rows(before) == rows(t.read(0)) == [(1, "x"), (2, "y")]
    assert t.vacuum() > 0 and t.versions() == [1] and rows(t.read()) == [(1, "x")]
    assert t.vacuum() == 0


def test_a_batch_is_appended_once(spark, base):
    t = Table(spark, base)
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "id int, v string").repartition(3)
    assert t.append(df) and not t.append(df.repartition(1)) and t.read().count() == 3
    assert t.append(df, "run-2") and not t.append(df, "run-2") and t.read().count() == 6
    assert t.append(df.union(df.limit(1))) and t.read().count() == 10
    wider = spark.createDataFrame([(3, "c", 1.5)], "id int, v string, w double")
    assert t.append(wider) and rows(t.read().where("id = 3")) == [(3, "c", 1.5)]
    assert t.read().where("w IS NULL").count() == 10
    with pytest.raises(ValueError):
        t.append(spark.createDataFrame([("x",)], "id string"))
    assert content_id(df) != content_id(df.distinct()) != content_id(df.limit(0))


def test_two_writers_of_one_version(spark, base):
    a, b = Table(spark, base), Table(spark, base)
    df = spark.createDataFrame([(1,)], "id int")
    a.replace(df)
    m = b.manifest()
    a.append(df)
    with pytest.raises(Conflict):
        b._commit(m, files=[])
    assert a.read().count() == 2


def test_an_upsert_rewrites_only_files_that_hold_its_keys(spark, base):
    t = Table(spark, base, keys=["k"], rows_per_file=50)
    t.replace(spark.range(50_000).select(F.col("id").alias("k"), F.lit(1).alias("ts"), F.lit("old").alias("v")))
    rng = random.Random(4)
    picked = rng.sample(range(50_000), 290) + list(range(60_000, 60_010))
    new = spark.createDataFrame([(k, 2, "new") for k in picked], "k long, ts int, v string")
    done = t.upsert(new, [F.col("ts").desc()], "b1")
    # 300 random keys fall into about 1000 * (1 - exp(-0.3)) = 260 files of 1000; filters let few others through
    assert done["files"] == 1000 and done["rewritten"] <= 300
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 50_010 and {k for k, v in got.items() if v == "new"} == set(picked)
    assert t.read().count() == 50_010
    # the same batch again, and a late batch of an older state
    assert t.upsert(new, [F.col("ts").desc()], "b1")["rewritten"] == 0
    late = spark.createDataFrame([(picked[0], 1, "late"), (70_000, 1, "first")], "k long, ts int, v string")
    few = t.upsert(late, [F.col("ts").desc()], "b0")
    got = {r.k: r.v for r in t.read().collect()}
    assert got[picked[0]] == "new" and got[70_000] == "first" and len(got) == 50_011 and few["rewritten"] <= 3


def test_the_index_finds_every_file_that_holds_a_key(spark, base):
    t = Table(spark, base, keys=["a", "b"], rows_per_file=40)
    for n in range(4):
        t.append(spark.range(n * 300, n * 300 + 400).select(F.col("id").alias("a"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("b")))
    asked = spark.range(0, 1500, 50).select(F.col("id").alias("a"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("b"))
    held = t.read().select("a", "b", F.element_at(F.split("_metadata.file_path", "/data/"), -1).alias("f"))
    true = {f"data/{r.f}" for r in held.join(asked, held.a == asked.a).collect()}
    found = set(t.files_with(asked))
    assert true <= found < set(t.manifest()["files"])
    assert t.files_with(asked.limit(0)) == []


def test_missing_days_are_found_and_loaded_alone(spark, base):
    t, day = Table(spark, base), lambda n: dt.date(2025, 1, n)
    ev = spark.createDataFrame([(i, dt.datetime(2025, 1, 1 + i % 4, 5)) for i in range(20)] + [(99, None)], "id int, ts timestamp")
    assert t.load_slices(ev, "ts", day(1), day(3)) == [day(1), day(2), day(3)] and t.read().count() == 15
    assert t.load_slices(ev, "ts", day(1), day(3)) == [] and t.missing_slices(day(1), day(5)) == [day(4), day(5)]
    before = t.manifest()["files"]
    t.drop_slice(day(2))
    assert t.missing_slices(day(1), day(3)) == [day(2)] and t.read().where(F.col("slice_date") == day(2)).count() == 0
    # only the missing days are read from the source and written; a day without rows counts as loaded
    assert t.load_slices(ev, "ts", day(1), day(5)) == [day(2), day(4), day(5)]
    kept = [f for f in before if "by_slice_date=2025-01-02" not in f]
    assert set(kept) <= set(t.manifest()["files"])
    assert t.manifest()["slices"] == {"2025-01-01": 5, "2025-01-02": 5, "2025-01-03": 5, "2025-01-04": 5, "2025-01-05": 0}
    assert t.read().count() == 20 and t.load_slices(ev, "ts", day(1), day(1), again=True) == [day(1)] and t.read().count() == 20


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip() for line in plan.splitlines() if "Exchange hashpartitioning" in line or "BroadcastExchange" in line]


def test_joins_of_bucketed_tables_have_no_exchange(spark, base):
    from seasonflow.operators import joins as J
    from seasonflow.sources.bucketed import register_bucketed, write_bucketed
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sides = spark.range(4000).select((F.col("id") / 2).cast("long").alias("game_id"), (F.col("id") % 2 == 0).alias("is_home"),
                                         (F.col("id") * 7 % 11).alias("goals"))
        plays = spark.range(9000).select((F.col("id") % 2000).alias("game_id"), (F.col("id") % 5).alias("kind"))
        a = write_bucketed(sides, f"{base}/sides", ["game_id"], 4)
        b = write_bucketed(plays, f"{base}/plays", ["game_id"], 4)
        both = J.opponent_join(a, ["game_id"], "is_home", ["goals"])
        counted = a.join(b.groupBy("game_id").agg(F.count("*").alias("n")), "game_id")
        for df, plain in ((both, J.opponent_join(sides, ["game_id"], "is_home", ["goals"])),
                          (counted, sides.join(plays.groupBy("game_id").agg(F.count("*").alias("n")), "game_id"))):
            assert exchanges(df) == [] and exchanges(plain) != []
            assert rows(df.select(*sorted(df.columns))) == rows(plain.select(*sorted(plain.columns)))
        spark.sql(f"DROP TABLE {[t.name for t in spark.catalog.listTables() if t.name.endswith('_sides')][0]}")
        again = register_bucketed(spark, f"{base}/sides", ["game_id"], 4)
        assert exchanges(again.join(b, "game_id")) == [] and again.count() == 4000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_season_facts_over_bucketed_tables_join_without_exchange(spark, base):
    from seasonflow.params import Params
    from seasonflow.plans.season import pipeline
    from tests import fixtures as FX
    raw = {"games": FX.games(spark), "daily_standings": FX.daily_standings(spark), "game_summaries": FX.summaries(spark),
           "play_by_play": FX.plays(spark, [{"game": 1, "event": 2, "type": "goal", "team": 200, "clock": "05:00"}]),
           "game_boxscore": FX.boxscore(spark), "team_rosters": FX.rosters(spark), "current_teams": FX.current_teams(spark)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = pipeline.build(spark, raw, Params(as_of=dt.date(2025, 10, 12)), persist=pipeline.bucketed_writer(base, 2))
        plain = pipeline.build(spark, raw, Params(as_of=dt.date(2025, 10, 12)))
        for name in ("fct_player_game", "fct_team_game", "fct_games"):
            assert rows(m[name]) == rows(plain[name])
            shuffled = [e for e in exchanges(m[name]) if "hashpartitioning(game_id" in e]
            assert len(shuffled) < len([e for e in exchanges(plain[name]) if "hashpartitioning(game_id" in e]) or not shuffled, name
        largest = m["team_game_line"].join(m["fct_plays"], "game_id"), m["skater_game_lines"].join(m["fct_plays"], "game_id")
        assert all(exchanges(j) == [] for j in largest)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bitmap_counts_merge(spark):
    from seasonflow.operators import distinct as D
    ids = [None, 0, 1, -5, 32768, 32769, 40000, 5_000_000_000, 7]
    df = spark.createDataFrame([(g, ids[(i * (g + 3)) % len(ids)], i % 4) for g in range(3) for i in range(60)], "g int, x long, y int")
    maps = D.bitmaps(df.repartition(4), ["g"], {"x": "x", "y": "y"})
    want = {r.g: (r.x, r.y) for r in df.groupBy("g").agg(F.count_distinct("x").alias("x"), F.count_distinct("y").alias("y")).collect()}
    assert {r.g: (r.x, r.y) for r in D.counts(maps, ["g"], ["x", "y"]).collect()} == want
    total = D.counts(D.merge(maps), [], ["x", "y"]).first()
    assert (total.x, total.y) == (df.agg(F.count_distinct("x")).first()[0], 4)
    assert "Expand" not in D.counts(maps, ["g"], ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert D.counts(D.bitmaps(df.where("false"), ["g"], {"x": "x"}), ["g"], ["x"]).collect() == []
