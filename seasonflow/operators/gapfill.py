"""Calendar spine, gap-fill scaffold and forward fill.

``gap_fill`` turns snapshots into validity intervals: a snapshot holds from its date to
the day before the entity's next one (``lead``), values are carried over the snapshots
themselves, and each interval is expanded by ``sequence``.  So the only shuffle of the
rows is the one by (period, entity), over snapshots and not over days; there is no
grid, no join with it and no window over the filled rows.  ``scaffold`` builds the bare
grid with ``explode(sequence(start, end))`` instead of a band join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def date_spine(spark, start, end, col: str = "date") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive (literal bounds)."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(col))


def period_bounds(df: DataFrame, period: str, date: str) -> DataFrame:
    """First and last date seen per period."""
    return df.groupBy(period).agg(F.min(date).alias("start_date"), F.max(date).alias("end_date"))


def scaffold(entities: DataFrame, bounds: DataFrame, period: str, entity: str,
             date_col: str = "date", start: str = "start_date",
             end: str = "end_date") -> DataFrame:
    """(period, entity, date) for every day of the period's bounds (J09 + J10).

    ``entities`` holds (period, entity) pairs; ``bounds`` one row per period.
    The bounds side is one row per period (bounded by the number of seasons).
    """
    pairs = entities.select(period, entity).distinct()
    return (pairs.join(F.broadcast(bounds.select(period, start, end)), period, "inner")
                 .select(period, entity,
                         F.explode(F.sequence(F.col(start), F.col(end))).alias(date_col)))


def forward_fill(df: DataFrame, partition: Sequence[str], order: str,
                 cols: Mapping[str, object]) -> DataFrame:
    """Carry the last non-NULL value forward; ``cols`` maps column -> default.

    Three-step coalesce: own value, carried value, default (``None`` keeps NULL).
    """
    w = (Window.partitionBy(*partition).orderBy(order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = []
    for c in df.columns:
        if c in cols:
            carried = F.last(F.col(c), ignorenulls=True).over(w)
            default = cols[c]
            e = F.coalesce(F.col(c), carried) if default is None else \
                F.coalesce(F.col(c), carried, F.lit(default))
            out.append(e.alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def gap_fill(snapshots: DataFrame, period: str, entity: str, date: str,
             fill: Mapping[str, object], bounds: DataFrame | None = None) -> DataFrame:
    """Every (period, entity, day) within the period's bounds, ``fill`` columns (column ->
    default, ``None`` keeps NULL) carried forward from the last value that is not NULL.

    Entities enter on their period's first day, so days before an entity's first
    snapshot get the defaults.  Snapshots without a date or outside of the bounds only
    make their entity known; several snapshots of one day stay several rows.  ``bounds``
    has a row per period.
    """
    b = bounds if bounds is not None else period_bounds(snapshots, period, date)
    # one row per period: a fixed, small side
    s = snapshots.select(period, entity, date, *fill).join(
        F.broadcast(b.select(F.col(period).alias("__period"), F.col("start_date").alias("__start"), F.col("end_date").alias("__end"))),
        F.col(period) == F.col("__period"))
    inside = F.col(date).between(F.col("__start"), F.col("__end"))
    s = s.withColumn("__day", F.when(inside, F.col(date))).withColumns({c: F.when(inside, F.col(c)) for c in fill})
    by = Window.partitionBy(period, entity)
    w = by.orderBy(F.col("__day").asc_nulls_first())
    far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s.select(period, entity, "__day", "__start", "__end",
                 *[F.last(c, ignorenulls=True).over(far).alias(c) for c in fill],
                 F.lead("__day").over(w).alias("__next"), F.row_number().over(w).alias("__n"),
                 F.min("__day").over(by).alias("__first"))
    # the entity's first row also opens the days before its first snapshot
    none = F.struct(*[F.lit(None).cast(snapshots.schema[c].dataType).alias(c) for c in fill])
    ahead = F.struct(F.col("__start").alias("a"), F.coalesce(F.date_sub("__first", 1), F.col("__end")).alias("z"), none.alias("v"))
    own = F.struct(F.col("__day").alias("a"),
                   F.greatest(F.col("__day"), F.coalesce(F.date_sub("__next", 1), F.col("__end"))).alias("z"),
                   F.struct(*fill).alias("v"))
    spans = F.filter(F.array(F.when(F.col("__n") == 1, ahead), F.when(F.col("__day").isNotNull(), own)),
                     lambda x: x.isNotNull() & (x["a"] <= x["z"]))
    return (s.select(period, entity, F.explode(spans).alias("__s"))
            .select(period, entity, F.explode(F.sequence("__s.a", "__s.z")).alias(date), "__s.v.*")
            .select(period, entity, date, *[(F.col(c) if d is None else F.coalesce(F.col(c), F.lit(d))).alias(c)
                                            for c, d in fill.items()]))
