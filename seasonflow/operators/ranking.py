"""Ranks, percentiles, ordinals, min-max scaling and blends.

Ranks within a period or group are windows partitioned by it.  Ranks over a whole frame
go through ``distributed``: no window without a partition, whatever the frame's size.
Min-max scaling reads one aggregate (per partition, or one global row that is
broadcast).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonflow.operators.distributed import RankOf, global_ranks, global_row_number
from seasonflow.session import cut_lineage


def _sorted(col: str, ascending: bool) -> Column:
    return F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()


def rank_metrics(df: DataFrame, metrics: Mapping[str, bool], partition: Sequence[str] = (),
                 suffix: str = "_rank", fn=F.rank) -> DataFrame:
    """``rank()`` (or ``fn``, ``dense_rank``) per metric, NULLs last; ``metrics`` maps
    column -> ascending (lower is better)."""
    if not partition:
        return global_ranks(df, [RankOf(m + suffix, m, asc, kind=fn.__name__) for m, asc in metrics.items()])
    return df.select("*", *[fn().over(Window.partitionBy(*partition).orderBy(_sorted(m, asc))).alias(m + suffix)
                            for m, asc in metrics.items()])


def percentile_metrics(df: DataFrame, metrics: Mapping[str, bool], partition: Sequence[str] = (),
                       suffix: str = "_pctile", digits: int = 1) -> DataFrame:
    """``round(percent_rank() * 100, digits)``; higher is better unless asc=True."""
    if not partition:
        # percent_rank grows along the ordering: best value gets 100
        out = global_ranks(df, [RankOf(m + suffix, m, not lower_better, nulls_last=False, kind="percent_rank")
                                for m, lower_better in metrics.items()])
        return out.withColumns({m + suffix: F.round(F.col(m + suffix) * 100, digits) for m in metrics})
    cols = []
    for m, lower_better in metrics.items():
        order = F.col(m).desc_nulls_first() if lower_better else F.col(m).asc_nulls_first()
        w = Window.partitionBy(*partition).orderBy(order)
        cols.append(F.round(F.percent_rank().over(w) * 100, digits).alias(m + suffix))
    return df.select("*", *cols)


def ordinals(df: DataFrame, metrics: Mapping[str, bool], partition: Sequence[str],
             tie_break: Sequence[str], suffix: str = "_ordinal") -> DataFrame:
    """``row_number()`` per metric with a deterministic tie-break."""
    cols = []
    for m, asc in metrics.items():
        w = Window.partitionBy(*partition).orderBy(_sorted(m, asc), *[F.col(t) for t in tie_break])
        cols.append(F.row_number().over(w).alias(m + suffix))
    return df.select("*", *cols)


def multi_key_rank(df: DataFrame, order: Sequence[Column], partition: Sequence[str] = (),
                   name: str = "final_rank") -> DataFrame:
    """row_number over several keys (W18, W19); ``order`` must be total."""
    if not partition:
        return global_row_number(df, order, name)
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))


def minmax_normalize(df: DataFrame, cols: Mapping[str, bool], partition: Sequence[str] = (),
                     suffix: str = "_scaled", neutral: float | None = 50.0) -> DataFrame:
    """``(x - min) / (max - min) * 100`` (inverted when the flag is True).

    min/max come from one aggregate (per partition, or one global row that is
    broadcast); a zero range or a NULL value yields ``neutral`` (None: NULL).  The frame is
    checkpointed first, so it is evaluated once.
    """
    df = cut_lineage(df)
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"__min_{c}"), F.max(c).alias(f"__max_{c}")]
    if partition:
        stats = df.groupBy(*partition).agg(*aggs)
        joined = df.join(stats, list(partition), "left")
    else:
        joined = df.crossJoin(F.broadcast(df.agg(*aggs)))
    out = []
    for c, invert in cols.items():
        lo, hi = F.col(f"__min_{c}").cast("double"), F.col(f"__max_{c}").cast("double")
        x = F.col(c).cast("double")
        num = (hi - x) if invert else (x - lo)
        scaled = F.try_divide(num, hi - lo) * 100
        out.append((scaled if neutral is None else F.coalesce(scaled, F.lit(neutral))).alias(c + suffix))
    helper = [f"__min_{c}" for c in cols] + [f"__max_{c}" for c in cols]
    return joined.select("*", *out).drop(*helper)


def weighted_blend(parts: Mapping[str, float]) -> Column:
    """Linear combination sum(w * col); NULL parts count as 0."""
    expr = None
    for c, w in parts.items():
        e = F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(float(w))
        expr = e if expr is None else expr + e
    return expr


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """Global top-k: ``orderBy().limit()`` plans as TakeOrderedAndProject
    (each task keeps k rows; the driver merges k x partitions)."""
    return df.orderBy(*order).limit(k)
