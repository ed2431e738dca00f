from pyspark.sql import functions as F

from seasonflow.functions import exprs as X


def one(spark, expr, schema="x string", value=None):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr.alias("r")).collect()[0].r


def test_clock_round_trip(spark):
    assert one(spark, X.clock_to_seconds("x"), value="12:34") == 754
    assert one(spark, X.clock_to_seconds("x"), value="bad") is None
    assert one(spark, X.seconds_to_clock(F.lit(754))) == "12:34"


def test_safe_divide_and_exact_rounding(spark):
    assert one(spark, X.safe_divide(F.lit(1), F.lit(0))) is None
    # 201 / 200 = 1.005 exactly -> HALF_UP 1.01 (a binary double would give 1.0)
    assert one(spark, X.round_ratio(F.lit(201), F.lit(200), 2)) == 1.01
    assert one(spark, X.round_ratio(F.lit(5), F.lit(0), 2)) is None
    # 0.12344999 must round to 0.1234 (rounding the quotient at 6 digits first would give 0.1235)
    assert one(spark, X.round_ratio(F.lit(12344999), F.lit(100000000), 4)) == 0.1234


def test_display_strings(spark):
    assert one(spark, X.season_display(F.lit(20252026))) == "2025-26"
    assert one(spark, X.record_string(F.lit(3), F.lit(2), F.lit(1))) == "3-2-1"
    assert one(spark, X.record_string(F.lit(3), F.lit(None).cast("int"), F.lit(1))) is None
    assert one(spark, X.signed_string(F.lit(4))) == "+4"
    assert one(spark, X.signed_string(F.lit(-4))) == "-4"
    assert [one(spark, X.ordinal_suffix(F.lit(n))) for n in (1, 2, 3, 4, 11, 12, 13, 21, 22, 23, 101, 111)] == \
        ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "22nd", "23rd", "101st", "111th"]


def test_fraction_and_keys(spark):
    assert one(spark, X.fraction_part("x", 1), value="30/32") == 30
    assert one(spark, X.fraction_part("x", 2), value="30/32") == 32
    k1 = one(spark, X.surrogate_key(F.lit(1), F.lit(None).cast("string")))
    k2 = one(spark, X.surrogate_key(F.lit(1), F.lit("_dbt_utils_surrogate_key_null_")))
    assert k1 == k2 and len(k1) == 32


def test_strength_decode(spark):
    df = spark.createDataFrame([("1551", 1), ("1451", 1), ("1451", 2), ("0651", 1), (None, 1), ("1551", None)],
                               "code string, team int")
    cols = X.strength_columns("code", "team", F.lit(1), F.lit(2))
    rows = df.select(*[v.alias(k) for k, v in cols.items()]).collect()
    assert [r.strength_state for r in rows] == ["Even", "PP", "SH", "SH", "Even", "Other"]
    assert rows[3].is_empty_net is True            # home event, away goalie pulled
    assert rows[4].is_powerplay is None            # NULL code: flags NULL


def test_geometry_and_severity(spark):
    assert round(one(spark, X.shot_distance(F.lit(80.0), F.lit(0.0))), 6) == 9.0
    assert round(one(spark, X.shot_angle(F.lit(79.0), F.lit(10.0))), 6) == 45.0
    assert one(spark, X.penalty_severity(F.lit("MAJ"), F.lit(5))) == "Major"
    assert one(spark, X.penalty_severity(F.lit("XYZ"), F.lit(4))) == "Double Minor"
    assert one(spark, X.elapsed_seconds(F.lit(2), F.lit(30))) == 1230
