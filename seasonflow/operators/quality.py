"""Distributed data-quality checks (Q01–Q08).

Each check returns a DataFrame of *violation groups* — never collected to the
driver — with the common columns ``check``, ``target``, ``severity`` and
``violations`` (bigint) plus the offending key values where meaningful.
``summary`` unions the per-check counts into one report.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN, ERROR = "warn", "error"


def _tag(df: DataFrame, check: str, target: str, severity: str) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.lit(target).alias("target"),
                     F.lit(severity).alias("severity"), "*")


def not_null(df: DataFrame, col: str, severity: str = ERROR) -> DataFrame:
    """Q01 — one row with the number of NULLs (0 rows when clean)."""
    v = df.agg(F.count_if(F.col(col).isNull()).alias("violations")).filter("violations > 0")
    return _tag(v, "not_null", col, severity)


def unique(df: DataFrame, cols: Sequence[str], severity: str = ERROR) -> DataFrame:
    """Q02 / Q03 — key values occurring more than once, with their count."""
    v = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("violations"))
           .filter(F.col("violations") > 1))
    name = "unique" if len(cols) == 1 else "unique_combination"
    return _tag(v, name, ",".join(cols), severity)


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                  severity: str = ERROR) -> DataFrame:
    """Q04 — non-NULL foreign keys without a parent row, counted per key."""
    keys = parent.select(F.col(pk).alias("__pk")).distinct()
    orphans = (child.filter(F.col(fk).isNotNull())
                    .join(keys, F.col(fk) == F.col("__pk"), "left_anti")
                    .groupBy(fk).agg(F.count(F.lit(1)).alias("violations")))
    return _tag(orphans, "relationships", fk, severity)


def accepted_values(df: DataFrame, col: str, values: Sequence, severity: str = ERROR) -> DataFrame:
    """Q05 — values outside the accepted list (NULLs are not violations)."""
    v = (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))
           .groupBy(col).agg(F.count(F.lit(1)).alias("violations")))
    return _tag(v, "accepted_values", col, severity)


def in_range(df: DataFrame, col: str, lo=None, hi=None, where: Column | None = None,
             severity: str = ERROR) -> DataFrame:
    """Q06 — values outside [lo, hi] among rows matching ``where``."""
    c = F.col(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < F.lit(lo))
    if hi is not None:
        bad = bad | (c > F.lit(hi))
    base = df if where is None else df.filter(where)
    v = base.agg(F.count_if(bad).alias("violations")).filter("violations > 0")
    return _tag(v, "range", col, severity)


def row_checks(df: DataFrame, rules: Sequence[tuple[str, str, str, Column]]) -> DataFrame:
    """Any number of row-level rules over one table in one pass: each rule is
    (check, target, severity, condition of a violating row).  One row per rule with
    its violation count, 0 when clean."""
    counts = df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(f"v{i}") for i, (*_, bad) in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(c).alias("check"), F.lit(t).alias("target"), F.lit(s).alias("severity"),
                              F.col(f"v{i}").alias("violations")) for i, (c, t, s, _) in enumerate(rules)])
    return counts.select(F.inline(rows))


class Split(NamedTuple):
    """Good rows, violating rows with the names of their broken rules, and the counts."""
    good: DataFrame
    violations: DataFrame
    counts: dict[str, int]


def split(df: DataFrame, rules: Sequence[tuple[str, Column]], path: str) -> Split:
    """Writes ``df`` once, good rows and violating ones into folders of their own, and
    counts in that pass (``DataFrame.observe``): one scan, and no row is lost.

    A rule is (name, condition of a violating row); a condition that is NULL holds for
    no row.  Violating rows keep all columns and have ``broken``, the rules' names.
    ``counts`` has ``rows``, ``good`` and a number for each rule."""
    names = [n for n, _ in rules]
    bad = [F.coalesce(c, F.lit(False)) for _, c in rules]
    broken = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in zip(names, bad, strict=True)]), lambda x: x.isNotNull())
    marked = df.withColumn("broken", broken if rules else F.array().cast("array<string>")).withColumn("ok", F.size("broken") == 0)
    seen = Observation()
    marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("ok").alias("good"),
                   *[F.count_if(F.array_contains("broken", n)).alias(f"rule_{i}") for i, n in enumerate(names)]
                   ).write.partitionBy("ok").parquet(path)
    got = seen.get
    counts = {"rows": got["rows"], "good": got["good"]} | {n: got[f"rule_{i}"] for i, n in enumerate(names)}
    back = df.sparkSession.read.schema(marked.schema).parquet(path)
    return Split(back.where("ok").drop("ok", "broken"), back.where("NOT ok").drop("ok"), counts)


def freshness(df: DataFrame, loaded_at: str, as_of, warn_after_hours: float,
              error_after_hours: float, target: str = "source") -> DataFrame:
    """Q07 — age of the newest load against ``as_of``: pass / warn / error.

    Ages are whole elapsed seconds computed on wall-clock (NTZ) timestamps, so
    the session time zone does not matter; hours use exact decimal rounding.
    """
    import datetime as _dt
    from seasonflow.functions.exprs import round_ratio
    if not isinstance(as_of, _dt.datetime):
        as_of = _dt.datetime(as_of.year, as_of.month, as_of.day)
    now = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    latest = df.agg(F.max(loaded_at).alias("latest_load"))
    age_s = F.timestamp_diff("SECOND", F.col("latest_load").cast("timestamp_ntz"), now)
    return latest.select(
        F.lit("freshness").alias("check"), F.lit(target).alias("target"),
        F.col("latest_load"), round_ratio(age_s, F.lit(3600), 2).alias("age_hours"),
        F.when(age_s > int(error_after_hours * 3600), ERROR)
         .when(age_s > int(warn_after_hours * 3600), WARN).otherwise("pass").alias("severity"))


def summary(checks, counted: Sequence[DataFrame] = ()) -> DataFrame:
    """Q08 — one row per check: violation total (0 when clean) and status.

    ``checks`` holds (check, target, severity, violations_df) tuples; each total
    is a one-row global aggregate, so a clean check still reports ``pass``.
    ``counted`` holds frames of ``row_checks``, whose rows are totals already.
    """
    parts = list(counted)
    for check, target, severity, df in checks:
        parts.append(df.agg(F.coalesce(F.sum("violations"), F.lit(0)).cast("bigint").alias("violations"))
                       .select(F.lit(check).alias("check"), F.lit(target).alias("target"),
                               F.lit(severity).alias("severity"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("violations") > 0,
                                           F.when(F.col("severity") == ERROR, "fail").otherwise("warn"))
                                     .otherwise("pass"))
