import datetime as dt
import json
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonflow.sources import loads as L
from seasonflow.sources import shaping as SH
from seasonflow.streaming.incremental import incremental_ingest, read_current


def _tmp():
    return tempfile.mkdtemp(prefix="sf-test-", dir="/tmp")


def test_flatten_and_nested_to_json(spark):
    schema = "id int, awayTeam struct<abbrev:string, name:struct<default:string>>, tags array<string>"
    df = spark.createDataFrame([(1, ("AWY", ("Away City",)), ["a"])], schema)
    flat = SH.flatten_structs(df, upper=True)
    assert flat.columns == ["ID", "AWAYTEAM_ABBREV", "AWAYTEAM_NAME_DEFAULT", "TAGS"]
    assert flat.collect()[0].TAGS == '["a"]'
    assert SH.nested_to_json(df).schema["awayTeam"].dataType == T.StringType()


def test_explode_events_and_extract_records(spark):
    el = T.StructType([T.StructField("eventId", T.IntegerType()),
                       T.StructField("details", T.StructType([T.StructField("xCoord", T.DoubleType())]))])
    df = spark.createDataFrame([(1, json.dumps([{"eventId": 1, "details": {"xCoord": 3.5}}, {"eventId": 2}])),
                                (2, "[]"), (3, None)], "game int, plays string")
    out = SH.explode_events(df, "plays", el, ["game"], upper=True)
    assert sorted((r.game, r.EVENTID, r.DETAILS_XCOORD) for r in out.collect()) == [(1, 1, 3.5), (1, 2, None)]
    payload = T.StructType([T.StructField("data", T.StructType([T.StructField("items", T.ArrayType(T.IntegerType()))]))])
    p = spark.createDataFrame([('{"data": {"items": [1, 2]}}',), ('{"other": 1}',)], "j string")
    assert sorted(r.record for r in SH.extract_records(p, "j", payload, ["data", "items"]).collect()) == [1, 2]
    assert SH.extract_records(p, "j", payload, []).count() == 2


def test_drop_fields_nested_and_parent_key(spark):
    df = spark.createDataFrame([(1, (2, 3), 4)], "id int, s struct<keep:int, secret_x:int>, secret_y int")
    out = SH.drop_fields(df, "**.secret_*")
    assert out.columns == ["id", "s"] and out.schema["s"].dataType.fieldNames() == ["keep"]
    parents = spark.createDataFrame([(1, [10, 11]), (None, [12])], "team int, kids array<int>")
    assert sorted(tuple(r) for r in SH.carry_parent_key(parents, "team", "kids").collect()) == [(1, 10), (1, 11)]


def test_load_modes_evolution_and_upsert(spark):
    base = _tmp()
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(2, "y", 5)], "id int, v string, extra int")
    L.load_append(L.stamp_load(a, dt.datetime(2024, 1, 1)), f"{base}/t")
    L.load_append(L.stamp_load(b, dt.datetime(2024, 1, 2)), f"{base}/t")
    t = L.read_evolving(spark, f"{base}/t")
    assert sorted(t.columns) == ["_loaded_at", "extra", "id", "v"] and t.count() == 2
    L.load_full_replace(a, f"{base}/t2")
    L.load_full_replace(a, f"{base}/t2")
    assert spark.read.parquet(f"{base}/t2").count() == 1
    assert L.evolve_schema(a, b).filter("id = 1").collect()[0].extra is None
    target = spark.createDataFrame([(1, "old", 1), (2, "keep", 1)], "id int, v string, ts int")
    delta = spark.createDataFrame([(1, "new", 2), (1, "newer", 3), (3, "ins", 1)], "id int, v string, ts int")
    m = {r.id: r.v for r in L.merge_upsert(target, delta, ["id"], [F.col("ts").desc()]).collect()}
    assert m == {1: "newer", 2: "keep", 3: "ins"}


def test_tolerant_json_and_date_slices(spark):
    base = _tmp()
    with open(f"{base}/in.json", "w") as fh:
        fh.write('{"id": 1}\n{"id": oops\n{"id": 3}\n')
    good, rejects = L.tolerant_json(spark, f"{base}/in.json", T.StructType([T.StructField("id", T.IntegerType())]))
    assert sorted(r.id for r in good.collect()) == [1, 3] and rejects.collect()[0].rejected_rows == 1
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5)), (2, dt.datetime(2024, 1, 2, 6)),
                                (3, dt.datetime(2024, 1, 9, 1))], "id int, ts timestamp")
    L.date_partitioned_load(ev, f"{base}/slices", "ts", dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    L.date_partitioned_load(ev, f"{base}/slices", "ts", dt.date(2024, 1, 2), dt.date(2024, 1, 2))  # re-run a day
    out = spark.read.parquet(f"{base}/slices")
    assert sorted(r.id for r in out.collect()) == [1, 2]


def test_incremental_ingest_latest_wins_across_batches(spark):
    base = _tmp()
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("ts", T.IntegerType()),
                           T.StructField("v", T.StringType())])
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], schema).coalesce(1).write.parquet(f"{base}/drop/f1")
    spark.createDataFrame([(1, 2, "a2"), (3, 1, "c")], schema).coalesce(1).write.parquet(f"{base}/drop/f2")
    last = incremental_ingest(spark, f"{base}/drop/*", schema, f"{base}/table", f"{base}/ckpt", ["k"],
                              [F.col("ts").desc()], max_files_per_trigger=1)
    out = {r.k: r.v for r in read_current(spark, f"{base}/table", schema, last).collect()}
    assert out == {1: "a2", 2: "b", 3: "c"} and last == 1
    # a new run with nothing new leaves the table as it is (checkpointed offsets)
    again = incremental_ingest(spark, f"{base}/drop/*", schema, f"{base}/table", f"{base}/ckpt", ["k"],
                               [F.col("ts").desc()])
    assert again is None
    # versioned layout gives the same table
    last_v = incremental_ingest(spark, f"{base}/drop/*", schema, f"{base}/vtable", f"{base}/vckpt", ["k"],
                                [F.col("ts").desc()], max_files_per_trigger=1, buckets=None)
    outv = {r.k: r.v for r in read_current(spark, f"{base}/vtable", schema, last_v, buckets=None).collect()}
    assert outv == out


@pytest.mark.parametrize("buckets", ["indexed", 512, 2, None])
def test_incremental_ingest_late_row_of_an_older_state(spark, buckets):
    base = _tmp()
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("ts", T.IntegerType()),
                           T.StructField("v", T.StringType())])
    spark.createDataFrame([(1, 10, "new"), (2, 1, "b")], schema).coalesce(1).write.parquet(f"{base}/drop/f1")
    spark.createDataFrame([(1, 5, "late"), (2, 2, "b2"), (3, 1, "c")], schema).coalesce(1).write.parquet(f"{base}/drop/f2")
    last = incremental_ingest(spark, f"{base}/drop/*", schema, f"{base}/table", f"{base}/ckpt", ["k"],
                              [F.col("ts").desc()], max_files_per_trigger=1, buckets=buckets)
    out = {r.k: (r.ts, r.v) for r in read_current(spark, f"{base}/table", schema, last, buckets=buckets).collect()}
    assert out == {1: (10, "new"), 2: (2, "b2"), 3: (1, "c")} and last == 1


def test_seeds_sorted_write_and_time_helpers(spark):
    from seasonflow.functions import exprs as X
    from seasonflow.plans.season.schemas import SEED_HISTORY
    from seasonflow.sources.readers import infer_schema, read_seed
    base = _tmp()
    with open(f"{base}/history.csv", "w") as fh:
        fh.write("team_abv,founded_year,previous_name,current_location_since,is_expansion_team,"
                 "is_original_or_relocated\nHOM,1998,,1998,true,false\nNEW,2024,Old Name,2024,false,true\n")
    seed = {r.team_abv: r for r in read_seed(spark, f"{base}/history.csv", SEED_HISTORY).collect()}
    assert seed["HOM"].previous_name is None and seed["NEW"].founded_year == 2024
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    L.write_sorted(df, f"{base}/sorted", ["k"], partitions=2)
    assert [r.k for r in spark.read.parquet(f"{base}/sorted").collect()] == [1, 2, 3]
    assert [f.name for f in infer_schema(spark, f"{base}/sorted").fields] == ["k"]
    t = spark.createDataFrame([("2025-10-09T00:00:00Z", "-04:00")], "s string, off string")
    r = t.select(X.parse_utc("s").alias("ts"), X.to_local(X.parse_utc("s"), "America/New_York").alias("loc"),
                 X.add_offset_hours(X.parse_utc("s"), F.col("off")).alias("shifted")).collect()[0]
    assert r.ts == dt.datetime(2025, 10, 9, 0, 0) and r.loc == dt.datetime(2025, 10, 8, 20, 0)
    assert r.shifted == dt.datetime(2025, 10, 8, 20, 0)


def test_append_is_done_once_a_batch(spark):
    base = _tmp()
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, p string")
    assert L.load_append(df, f"{base}/t") and not L.load_append(df.repartition(2), f"{base}/t")
    assert spark.read.parquet(f"{base}/t").count() == 3
    assert L.load_append(df, f"{base}/t", batch_id="two") and spark.read.parquet(f"{base}/t").count() == 6
    # an append that stopped after its files were moved, before the ledger had them, is done anew
    fs, at = __import__("seasonflow.session", fromlist=["x"]).file_system(spark, base)
    fs.delete(at(f"{base}/t/_batches/two"), False)
    assert L.load_append(df, f"{base}/t", batch_id="two") and spark.read.parquet(f"{base}/t").count() == 6
    assert L.load_append(df, f"{base}/by", ["p"]) and not L.load_append(df, f"{base}/by", ["p"])
    assert sorted((r.id, r.p) for r in spark.read.parquet(f"{base}/by").collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_a_stopped_replace_leaves_the_old_table(spark):
    base = _tmp()
    L.load_full_replace(spark.range(3), f"{base}/t")
    bad = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("stopped")).cast("long")).alias("id"))
    with pytest.raises(Exception):
        L.load_full_replace(bad, f"{base}/t")
    assert spark.read.parquet(f"{base}/t").count() == 3
    L.load_full_replace(spark.read.parquet(f"{base}/t").where("id > 0"), f"{base}/t")      # may read what it replaces
    assert spark.read.parquet(f"{base}/t").count() == 2
    import os
    os.rename(f"{base}/t", f"{base}/t.__old")                                                # stopped between the renames
    L.load_full_replace(spark.range(7), f"{base}/t")
    assert spark.read.parquet(f"{base}/t").count() == 7 and os.listdir(base) == ["t"]


def test_tolerant_json_leaves_the_schema_alone(spark):
    base = _tmp()
    with open(f"{base}/in.json", "w") as fh:
        fh.write('{"id": 1}\n{"id": oops\n{"id": -3}\n')
    schema = T.StructType([T.StructField("id", T.IntegerType())])
    for _ in range(2):
        good, rejects = L.tolerant_json(spark, f"{base}/in.json", schema)
        assert sorted(r.id for r in good.collect()) == [-3, 1] and rejects.first().rejected_rows == 1
    assert schema.names == ["id"]
    done = L.load_tolerant(spark, f"{base}/in.json", schema, f"{base}/out", [("positive", F.col("id") <= 0)])
    assert done.counts == {"rows": 3, "good": 1, "readable": 1, "positive": 1}
    assert [r.id for r in done.good.collect()] == [1]
    bad = {r.broken[0]: r for r in done.violations.collect()}
    assert bad["positive"].id == -3 and bad["readable"]._corrupt_record == '{"id": oops'


def test_split_scans_once_and_keeps_all_rows(spark, tmp_path):
    from seasonflow.operators import quality as Q
    src = str(tmp_path / "src")
    spark.range(100).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 3).alias("x")).write.parquet(src)
    df = spark.read.parquet(src)
    out = Q.split(df, [("not_null", F.col("x").isNull()), ("range", F.col("x") > 1), ("even", F.col("id") % 2 == 1)], str(tmp_path / "o"))
    rows = df.collect()
    broken = {r.id: [n for n, b in (("not_null", r.x is None), ("range", r.x is not None and r.x > 1), ("even", r.id % 2 == 1)) if b]
              for r in rows}
    assert {r.id: r.broken for r in out.violations.collect()} == {i: b for i, b in broken.items() if b}
    assert sorted(r.id for r in out.good.collect()) == sorted(i for i, b in broken.items() if not b)
    assert out.counts == {"rows": 100, "good": sum(not b for b in broken.values()),
                          **{n: sum(n in b for b in broken.values()) for n in ("not_null", "range", "even")}}


def test_drop_fields_at_any_depth(spark):
    schema = ("id int, logoA int, team struct<name:string, logo:string, home:struct<logoX:int, city:string>, only:struct<logo:int>>, "
              "plays array<struct<k:int, logoFr:string, sub:array<struct<logo:int, z:int>>>>, m map<string, struct<logo:int, v:int>>, "
              "gone array<struct<logo:int>>, deep array<array<struct<a:int, logo:int>>>")
    row = (1, 2, ("n", "l", (3, "c"), (4,)), [(5, "f", [(6, 7)]), (8, None, None), None], {"x": (9, 10)}, [(11,)], [[(12, 13)]])
    df = spark.createDataFrame([row, (2, None, None, None, None, None, None)], schema)
    out = SH.drop_fields(df, "**.logo*")
    assert out.dtypes == [("id", "int"), ("team", "struct<name:string,home:struct<city:string>>"),
                          ("plays", "array<struct<k:int,sub:array<struct<z:int>>>>"), ("m", "map<string,struct<v:int>>"),
                          ("deep", "array<array<struct<a:int>>>")]
    a, b = sorted(out.collect(), key=lambda r: r.id)
    assert a.team.home.city == "c" and a.plays[0].sub[0].z == 7 and a.plays[1].sub is None and a.plays[2] is None
    assert a.m["x"].v == 10 and a.deep[0][0].a == 12 and (b.team, b.plays, b.m) == (None, None, None)
    assert SH.drop_fields(df, "logo*").columns == ["id", "team", "plays", "m", "gone", "deep"]
