import datetime as dt

from pyspark.sql import functions as F

from seasonflow.operators import dedup as D
from seasonflow.operators import gapfill as G
from seasonflow.operators import joins as J
from seasonflow.operators import quality as Q
from seasonflow.operators import ranking as R
from seasonflow.operators import reshape as U
from seasonflow.operators.netting import offset_netting


def test_dedup_latest_and_plan_limits_before_shuffle(spark):
    df = spark.createDataFrame([(1, 1, 10), (1, 2, 20), (1, 2, 5), (2, 1, 7)], "k int, ts int, v int")
    out = D.dedup_latest(df, ["k"], [F.col("ts").desc(), F.col("v").desc()])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2, 20), (2, 1, 7)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "Window" in plan


def test_latest_rows_keep_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 4)], "id int, d int")
    assert sorted(r.id for r in D.latest_rows_per_group(df, [], "d").collect()) == [1, 2]


def test_two_sided_unpivot(spark):
    g = spark.createDataFrame([(1, "A", "B", 3, 2)], "gid int, h string, a string, hs int, as_ int")
    out = U.two_sided_unpivot(g, ["gid"], {"team": "h", "score": "hs"}, {"team": "a", "score": "as_"}).collect()
    assert {(r.team, r.score, r.opp_score, r.is_home) for r in out} == {("A", 3, 2, True), ("B", 2, 3, False)}


def test_not_in_null_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert sorted(r.k for r in J.not_in(left, "k", spark.createDataFrame([(2,)], "k int"), "k").collect()) == [1]
    with_null = spark.createDataFrame([(2,), (None,)], "k int")
    assert J.not_in(left, "k", with_null, "k").count() == 0


def test_gap_fill_forward(spark):
    snaps = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1), 3), (1, "a", dt.date(2024, 1, 4), 5),
                                   (1, "b", dt.date(2024, 1, 2), 1)], "s int, e string, d date, v int")
    out = {(r.e, r.d.day): r.v for r in G.gap_fill(snaps, "s", "e", "d", {"v": 0}).collect()}
    assert out[("a", 2)] == 3 and out[("a", 4)] == 5 and out[("b", 1)] == 0 and out[("b", 4)] == 1
    assert len(out) == 8


def test_offset_netting_multi(spark):
    ev = spark.createDataFrame([(1, "A", 1, 2), (1, "A", 1, 2), (1, "B", 1, 2), (1, "B", 2, 5)],
                               "g int, side string, clock int, dur int")
    out = {r.side: (r.n_net, r.total_weight) for r in
           offset_netting(ev, ["g"], "side", ["clock"], "dur", "dur", F.col("dur").isin(2, 4, 5)).collect()}
    assert out == {"A": (1, 4), "B": (1, 7)}


def test_minmax_neutral_and_inverted(spark):
    df = spark.createDataFrame([(1, 10.0, 5.0), (2, 20.0, 5.0), (3, 15.0, 5.0)], "t int, x double, y double")
    out = {r.t: (r.x_scaled, r.y_scaled) for r in R.minmax_normalize(df, {"x": True, "y": False}).collect()}
    assert out[1] == (100.0, 50.0) and out[2] == (0.0, 50.0) and out[3] == (50.0, 50.0)


def test_rank_and_percentiles(spark):
    df = spark.createDataFrame([(1, 10), (2, 10), (3, 5)], "t int, p int")
    r = {x.t: x.p_rank for x in R.rank_metrics(df, {"p": False}).collect()}
    assert r == {1: 1, 2: 1, 3: 3}
    pc = {x.t: x.p_pctile for x in R.percentile_metrics(df, {"p": False}).collect()}
    assert pc[3] == 0.0 and pc[1] == 50.0


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, v string")
    assert Q.not_null(df, "k").collect()[0].violations == 1
    assert Q.unique(df, ["k"]).collect()[0].violations == 2
    assert Q.accepted_values(df, "v", ["x", "y"]).collect()[0].v == "z"
    s = {r.check: r.status for r in Q.summary([("not_null", "k", Q.WARN, Q.not_null(df, "k")),
                                               ("unique", "v", Q.ERROR, Q.unique(df, ["v"]))]).collect()}
    assert s == {"not_null": "warn", "unique": "pass"}


def test_row_checks_count_all_rules_in_one_pass(spark):
    from seasonflow.operators import quality as Q
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    out = Q.row_checks(df, [("not_null", "x", Q.ERROR, F.col("x").isNull()), ("accepted", "y", Q.WARN, ~F.col("y").isin("a")),
                            ("range", "x", Q.ERROR, F.col("x") > 9)])
    assert [(r.target, r.violations) for r in out.collect()] == [("x", 1), ("y", 1), ("x", 0)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    assert [r.status for r in Q.summary([], [out]).collect()] == ["fail", "warn", "pass"]


def test_scalar_join_needs_one_row(spark):
    from seasonflow.operators import joins as J
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert [r.v for r in J.scalar_join(df, spark.createDataFrame([(7,)], "v int")).collect()] == [7, 7]
    assert [r.v for r in J.scalar_join(df, spark.createDataFrame([], "v int")).collect()] == [None, None]
    import pytest
    with pytest.raises(Exception, match="more than one row"):
        J.scalar_join(df, spark.createDataFrame([(1,), (2,)], "v int")).collect()


def test_not_in_with_nulls_and_empty_subquery(spark):
    from seasonflow.operators import joins as J
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    sub = lambda rows: spark.createDataFrame(rows, "b int")
    assert sorted(r.a for r in J.not_in(df, "a", sub([(1,)]), "b").collect()) == [2]
    assert J.not_in(df, "a", sub([(1,), (None,)]), "b").count() == 0
    assert J.not_in(df, "a", sub([]), "b").count() == 3        # nothing is in an empty list, NULL included


def test_queries_see_replaced_inputs(spark, tmp_path):
    import shutil
    import __spark_entry__ as E
    src = "/root/testdata/{}/{}.parquet"
    tables = ("orders", "lineitem", "customer", "supplier", "nation", "region")
    for t in tables:
        shutil.copy(src.format("sf0.001", t), tmp_path / f"{t}.parquet")
    run = lambda d: sorted(map(tuple, E.queries()["head_to_head"](spark, str(d)).collect()))
    assert run(tmp_path) == run("/root/testdata/sf0.001")
    for t in tables:
        (tmp_path / f"{t}.parquet").chmod(0o644)
        shutil.copy(src.format("sf0.01", t), tmp_path / f"{t}.parquet")
    spark.catalog.clearCache()
    assert run(tmp_path) == run("/root/testdata/sf0.01")


def test_top_rows_limit_cuts_larger_data(spark):
    from seasonflow.operators import ranking as R
    df = spark.range(5000).withColumnRenamed("id", "d")
    rows = R.top_k(df, 2000, [F.col("d").desc()]).collect()
    assert len(rows) == 2000 and min(r.d for r in rows) == 3000


# -- ranks over a whole frame ------------------------------------------------------------------
def _windowed(df, specs):
    from pyspark.sql import Window
    fns = {"rank": F.rank, "dense_rank": F.dense_rank, "percent_rank": F.percent_rank}
    cols = []
    for s in specs:
        c = F.col(s.column)
        order = ((c.asc_nulls_last if s.nulls_last else c.asc_nulls_first) if s.ascending
                 else (c.desc_nulls_last if s.nulls_last else c.desc_nulls_first))()
        cols.append(fns[s.kind]().over(Window.partitionBy().orderBy(order)).alias(s.name))
    return df.select("*", *cols)


def test_global_ranks_equal_the_windows(spark):
    from seasonflow.operators.distributed import RankOf, global_ranks
    # ties, NULLs, NaN, a value that a third of the rows share, two column types, more values than partitions
    rows = [(i, None if i % 17 == 0 else 7 if i % 3 == 0 else i * 31 % 101, None if i % 13 == 0 else float("nan") if i % 29 == 0
             else i * 7 % 53 / 4) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, x long, y double").repartition(5)
    specs = [RankOf(f"{c}_{a}_{n}_{k}", c, a, n, k) for c in ("x", "y") for a in (True, False) for n in (True, False)
             for k in ("rank", "dense_rank", "percent_rank")]
    out = global_ranks(df, specs)
    want = {r.id: r for r in _windowed(df, specs).collect()}
    got = {r.id: r for r in out.collect()}
    assert len(got) == 900
    for i, r in got.items():
        assert [repr(r[s.name]) for s in specs] == [repr(want[i][s.name]) for s in specs]
    for n in (0, 1):
        few = global_ranks(df.where(F.col("id") < n + 1).where(F.col("id") >= 1 - n), specs).collect()
        assert len(few) <= 2
    assert global_ranks(df.where("false"), specs).collect() == []


def test_global_row_number_numbers_ranges_one_after_another(spark):
    from seasonflow.operators.distributed import global_row_number
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") * 37 % 211).alias("x")).repartition(6)
    order = [F.col("x").desc(), F.col("id").asc()]
    got = [(r.x, r.id) for r in sorted(global_row_number(df, order, "n").collect(), key=lambda r: r.n)]
    assert got == sorted(((r.x, r.id) for r in df.collect()), key=lambda r: (-r[0], r[1]))
    assert global_row_number(df.where("false"), order).collect() == []


def test_gap_fill_by_intervals_equals_the_filled_grid(spark):
    import random
    rng = random.Random(5)
    day = lambda n: dt.date(2025, 1, 1) + dt.timedelta(days=n)
    rows = [(s, e, day(d), rng.choice([None, rng.randint(1, 9)]), rng.choice([None, "x", "y"]))
            for s in (1, 2) for e in "abcd" for d in rng.sample(range(30), rng.randint(1, 9))]
    rows += [(1, "only_out", day(99), 5, "z"), (2, "undated", None, 6, "z"), (2, "undated", None, 7, "z"), (2, "late", day(29), 3, None),
             (3, "no_bounds", day(3), 1, "q"), (1, "mixed", None, 4, "n"), (1, "mixed", None, 4, "n"), (1, "mixed", day(12), 8, "m")]
    df = spark.createDataFrame(rows, "s int, e string, d date, v int, t string").repartition(3)
    bounds = spark.createDataFrame([(1, day(2), day(27)), (2, day(0), day(29))], "s int, start_date date, end_date date")
    fill = {"v": 0, "t": None}
    for b, given in ((bounds, True), (G.period_bounds(df, "s", "d"), False)):
        grid = G.scaffold(df, b, "s", "e", "d").join(df.select("s", "e", "d", "v", "t"), ["s", "e", "d"], "left")
        want = G.forward_fill(grid, ["s", "e"], "d", fill)
        out = G.gap_fill(df, "s", "e", "d", fill, b if given else None)
        assert out.columns == ["s", "e", "d", "v", "t"]
        key = lambda r: tuple(repr(x) for x in r)
        assert sorted(map(key, out.collect())) == sorted(map(key, want.select("s", "e", "d", "v", "t").collect()))
    # a day with two snapshots stays two rows, and the days after carry one of them
    two = spark.createDataFrame([(1, "a", day(0), 1), (1, "a", day(0), 1), (1, "a", day(2), 3)], "s int, e string, d date, v int")
    assert sorted((r.d.day, r.v) for r in G.gap_fill(two, "s", "e", "d", {"v": 0}).collect()) == [(1, 1), (1, 1), (2, 1), (3, 3)]


def test_gap_fill_shuffles_snapshots_once(spark):
    from pyspark.sql import functions as F
    df = spark.range(1000).select((F.col("id") % 3).alias("s"), (F.col("id") % 7).alias("e"),
                                  F.date_add(F.lit(dt.date(2025, 1, 1)), (F.col("id") % 50).cast("int")).alias("d"), F.col("id").alias("v"))
    plan = G.gap_fill(df, "s", "e", "d", {"v": 0})._jdf.queryExecution().executedPlan().toString()
    # the rows once, and the one-row-a-period bounds
    assert plan.count("Exchange hashpartitioning(s") == 2 and plan.count("Exchange hashpartitioning(") == 2


def test_global_running_totals(spark):
    from seasonflow.operators.distributed import global_running_totals
    df = spark.range(500).select("id", (F.col("id") * 13 % 29).alias("x"), (F.col("id") % 5).alias("n")).repartition(5)
    rows = sorted(global_running_totals(df, ["x", "id"], {"before": "n"}).collect(), key=lambda r: (r.x, r.id))
    total = 0
    for r in rows:
        assert r.before == total
        total += r.n
    assert len(rows) == 500 and global_running_totals(df.where("false"), ["id"], {"b": "n"}).collect() == []
