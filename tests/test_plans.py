"""Plan properties the scale design relies on (checked on the physical plan)."""

import pytest

import __spark_entry__ as E
from seasonflow.plans import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(spark, key):
    return E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["dedup_latest", "dedup_latest_tiebreak", "dedup_preference", "last_n_form"])
def test_group_limit_runs_map_side(spark, key):
    plan = _plan(spark, key)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_partition_counts_use_partial_aggregate_not_window(spark):
    plan = _plan(spark, "partition_counts")
    assert "Window [" not in plan and "partial_count" in plan


def test_latest_season_prunes_partitions(spark, tmp_path):
    from pyspark.sql import functions as F
    from seasonflow.operators import joins as J
    from seasonflow.plans.testbed import Bed
    Bed(spark, SF).sides().write.partitionBy("season").parquet(str(tmp_path / "sides"))
    sides = spark.read.parquet(str(tmp_path / "sides"))
    plan = J.keep_max(sides.filter(F.col("game_type") == 2), "season")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "PushedFilters: [IsNotNull(game_type), EqualTo(game_type,2)]" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "semi_join")
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "lineitem" in line]
    assert scans and all("l_extendedprice" not in s for s in scans)


def test_no_cartesian_products_or_python_operators(spark):
    for key in sorted(QUERIES):
        if key == "incremental_ingest":
            continue
        plan = _plan(spark, key)
        assert "CartesianProduct" not in plan, key
        assert "EvalPython" not in plan and "InPandas" not in plan, key


@pytest.mark.parametrize("key", ["metric_ranks", "percentiles", "composite_score", "previous_period_final",
                                 "minmax_normalize", "season_points_otl"])
def test_global_ranks_have_no_window_in_one_task(spark, key):
    """Over a whole frame Spark would gather all rows in one partition for a window."""
    lines = _plan(spark, key).splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line or "WindowGroupLimit" in line:
            below = " ".join(lines[i + 1:i + 4])
            assert "SinglePartition" not in below, key
