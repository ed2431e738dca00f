"""Sequence windows: n-th event, last-N form, running totals, partition counts,
previous value (W09, W12–W14, W16, W17).  Every window is partitioned by an
entity key and ordered by a total order (id tie-break)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nth_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                 name: str = "seq") -> DataFrame:
    """Sequence number of each row inside its group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def last_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
           rank_col: str | None = None) -> DataFrame:
    """The last ``n`` rows per group (``order`` newest first).

    ``row_number() <= n`` is planned as a WindowGroupLimit: each map task keeps
    at most ``n`` rows per group before the shuffle, so a group holding a third
    of all rows is never sorted whole.  ``rank_col`` keeps the position.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n)
    return out.withColumnRenamed("__rn", rank_col) if rank_col else out.drop("__rn")


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                   measures: Mapping[str, str]) -> DataFrame:
    """Cumulative sums (W17); ``measures`` maps output -> input column."""
    w = (Window.partitionBy(*group).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.select("*", *[F.sum(c).over(w).alias(o) for o, c in measures.items()])


def partition_counts(df: DataFrame, group: Sequence[str],
                     counts: Mapping[str, Column | None]) -> DataFrame:
    """``count(*) over (partition by g)`` and ``count_if(cond) over (...)``.

    Computed as a partial (map-side combined) aggregate joined back on the
    group keys (NULL-safe, like a window partition) instead of a window: a hot
    group holding a third of the rows is never sorted whole in one task, and
    AQE splits the skewed side of the join.
    """
    aggs = [(F.count(F.lit(1)) if cond is None else F.count_if(cond)).alias(name) for name, cond in counts.items()]
    stats = df.groupBy(*group).agg(*aggs)
    stats = stats.select(*[F.col(g).alias(f"__g_{g}") for g in group], *counts.keys())
    cond = None
    for g in group:
        e = F.col(g).eqNullSafe(F.col(f"__g_{g}"))
        cond = e if cond is None else cond & e
    return df.join(stats, cond, "left").drop(*[f"__g_{g}" for g in group])
