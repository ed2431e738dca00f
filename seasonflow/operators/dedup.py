"""Latest-wins deduplication and latest-snapshot selection.

Spark SQL has no QUALIFY; ``row_number() == 1`` over a window is planned by
Catalyst as a ``WindowGroupLimit`` that keeps only the top row per key on the
map side before the shuffle, so a hot key (a third of all rows) is reduced
per input partition instead of being sorted whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence) -> list[Column]:
    out = []
    for c in cols:
        out.append(F.col(c) if isinstance(c, str) else c)
    return out


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order_by``.

    ``order_by`` must be a total order inside a key (add tie-breakers), e.g.
    ``[F.col("_loaded_at").desc(), F.col("sort_order").desc()]``.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(order_by))
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def dedup_preference(df: DataFrame, keys: Sequence[str], prefer: Column,
                     then_by: Sequence) -> DataFrame:
    """Preference-ordered dedup: rows where ``prefer`` is true win, then ``then_by``."""
    return dedup_latest(df, keys, [F.coalesce(prefer.cast("int"), F.lit(0)).desc(), *_order(then_by)])


def latest_as_of(snapshots: DataFrame, keys: Sequence[str], date_col: str, as_of=None,
                 tie_break: Sequence[str] = ()) -> DataFrame:
    """The newest snapshot of each key at or before ``as_of`` (a date or column; None:
    the newest of all).  One aggregate with map-side combine and no window: a partition
    sends a row a key, however long a key's history is.  Rows without a date take no
    part; ``tie_break`` columns decide between rows of one date (greatest first)."""
    known = snapshots.where(F.col(date_col).isNotNull())
    if as_of is not None:
        known = known.where(F.col(date_col) <= (as_of if isinstance(as_of, Column) else F.lit(as_of)))
    rest = [c for c in snapshots.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(date_col, *tie_break))
    return known.groupBy(*keys).agg(newest.alias("__newest")).select(*keys, "__newest.*").select(*snapshots.columns)


def latest_rows_per_group(df: DataFrame, group: Sequence[str], by: str) -> DataFrame:
    """All rows whose ``by`` equals the group's maximum (ties kept, QUALIFY RANK()=1).

    Expressed as an aggregate + equi-join: the per-group maximum is a partial
    (map-side combined) aggregate; the join is co-partitioned on ``group``.
    """
    if not group:
        top = df.agg(F.max(by).alias("__max"))
        return df.join(F.broadcast(top), F.col(by) == F.col("__max"), "inner").drop("__max")
    top = df.groupBy(*group).agg(F.max(by).alias("__max"))
    return (df.join(top, list(group), "inner")
              .filter(F.col(by) == F.col("__max")).drop("__max"))
