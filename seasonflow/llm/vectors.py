"""Vector tables: which rows take part, bounded samples, rows as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid(df: DataFrame, id_col: str, vec_col: str, **extra: Column) -> DataFrame:
    """Rows ``(uid, id, <extra>, v array<double>)`` that have an id, a vector and no null
    or non-finite component.  ``uid`` tells rows with equal ids apart; write the
    table before using it, so that it stays as it is."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"),
                      *[c.alias(n) for n, c in extra.items()])
            .where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & fine)
            .withColumn("uid", F.monotonically_increasing_id()))


def common_size(rows: DataFrame) -> int:
    """The most frequent number of components (the larger of equals), 0 without rows."""
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return int(top.d) if top else 0


def sample(rows: DataFrame, most: int) -> np.ndarray:
    """At most ``most`` vectors, the first by a hash of the id, for fitting codebooks or
    pivots; the driver gets that many rows however large the table is."""
    table = rows.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(most).select("v").toArrow()
    return matrix(table.column("v").combine_chunks()) if table.num_rows else np.zeros((0, 0))


def matrix(v: pa.Array) -> np.ndarray:
    """Equally long lists as the rows of a matrix of doubles."""
    if isinstance(v, pa.ChunkedArray):
        v = v.combine_chunks()
    if not len(v):
        return np.zeros((0, 0))
    flat = v.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(v), -1).astype(np.float64, copy=False)


def first_of_groups(groups: list[np.ndarray], value: np.ndarray, ids: np.ndarray, k: int,
                    descending: bool) -> np.ndarray:
    """Indices of the first ``k`` entries of every group by value, ties by smaller id."""
    order = np.lexsort((ids, -value if descending else value, *reversed(groups)))
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
        for g in groups:
            new[1:] |= g[order][1:] != g[order][:-1]
    start = np.flatnonzero(new)
    place = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
    return order[place < k]
