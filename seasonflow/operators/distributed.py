"""Ranks over a whole frame without a window in one task.

``rank()``, ``dense_rank()`` and ``percent_rank()`` depend on the frame only through how
often each value occurs.  So the values are counted first (map-side combine: a value
that a third of the rows share is one line), range-partitioned, counted per partition,
and each partition's running count gets the total of the partitions before it.  Equal
values are one line, so no tie lies across a border.  ``row_number()`` over a total order
range-partitions the rows themselves and numbers each partition behind the others.

The range partitions are checkpointed with their number in the shared folder, since a
second evaluation would draw other borders.  On the driver there is one count for each
partition and ranked column; it goes back as a broadcast of that size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonflow.session import cut_lineage

_LESS, _SAME = "__less", "__same"


class RankOf(NamedTuple):
    """One rank column: of ``column``, ascending or not, NULLs at either end.
    ``kind`` is rank, dense_rank or percent_rank."""
    name: str
    column: str
    ascending: bool
    nulls_last: bool = True
    kind: str = "rank"


def _running_totals(counted: DataFrame, by: Sequence[str], order: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Adds, for ``counted`` range-partitioned by (by, order) with partition ``pid``, what
    all earlier lines of the same ``by`` sum to (``sums`` maps result -> summed column)."""
    spark = counted.sparkSession
    parts = counted.groupBy(*by, "pid").agg(*[F.sum(c).alias(n) for n, c in sums.items()]).collect()
    before, rows = {}, []
    for r in sorted(parts, key=lambda r: r.pid):
        key = tuple(r[c] for c in by)
        at = before.setdefault(key, [0] * len(sums))
        rows.append((*key, r.pid, *at))
        before[key] = [a + r[n] for a, n in zip(at, sums, strict=True)]
    schema = ", ".join([f"{c} int" for c in by] + ["pid int"] + [f"__b_{n} long" for n in sums])
    offsets = spark.createDataFrame(rows, schema)        # a line for each partition and column
    w = Window.partitionBy(*by, "pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (counted.join(F.broadcast(offsets), [*by, "pid"])
            .withColumns({n: F.col(f"__b_{n}") + F.coalesce(F.sum(c).over(w), F.lit(0)) for n, c in sums.items()})
            .drop(*[f"__b_{n}" for n in sums]))


def _positions(base: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(m, k, n, less, distinct_less) per column number and distinct value that is not
    NULL: how often it occurs and how many rows and distinct values are smaller."""
    long = base.select(F.inline(F.array(*[F.struct(F.lit(i).alias("m"), F.col(f"`{c}`").alias("k"))
                                          for i, c in enumerate(columns)])))
    counted = (long.where(F.col("k").isNotNull()).groupBy("m", "k").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("one", F.lit(1)))
    ranged = cut_lineage(counted.repartitionByRange("m", "k").withColumn("pid", F.spark_partition_id()))
    return _running_totals(ranged, ["m"], ["k"], {"less": "n", "distinct_less": "one"})


def global_ranks(df: DataFrame, specs: Sequence[RankOf]) -> DataFrame:
    """``df`` with a column for each spec, as ``kind() OVER (ORDER BY column ...)`` gives it.

    NULLs are ties of each other; an empty frame stays empty.  A column is joined back on
    its value, so a frequent value is one line of the joined side.
    """
    base = cut_lineage(df)
    columns = list(dict.fromkeys(s.column for s in specs))
    head = base.agg(F.count(F.lit(1)).alias("rows"), *[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(columns)]).first()
    types = {}
    for c in columns:
        types.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    out = base
    for same_type in types.values():
        at = _positions(base, same_type)
        for i, c in enumerate(same_type):
            mine = [s for s in specs if s.column == c]
            total, known = head["rows"], head[f"n{columns.index(c)}"]
            one = at.where(F.col("m") == i).select(F.col("k").alias("__k"), F.col("less").alias(_LESS), F.col("n").alias(_SAME),
                                                   F.col("distinct_less").alias("__dless"))
            kinds = {s.kind for s in mine}
            distinct = one.count() if "dense_rank" in kinds else 0
            out = out.join(one, F.col(f"`{c}`") == F.col("__k"), "left")
            for s in mine:
                out = out.withColumn(s.name, _rank(s, total, known, distinct))
            out = out.drop("__k", _LESS, _SAME, "__dless")
    return out


def _rank(s: RankOf, total: int, known: int, distinct: int) -> Column:
    nulls = total - known
    dense = s.kind == "dense_rank"
    before_known = (1 if dense else nulls) if nulls and not s.nulls_last else 0
    if dense:
        smaller = F.col("__dless") if s.ascending else F.lit(distinct - 1) - F.col("__dless")
        of_null = 1 if not s.nulls_last else distinct + 1
    else:
        smaller = F.col(_LESS) if s.ascending else F.lit(known) - F.col(_LESS) - F.col(_SAME)
        of_null = 1 if not s.nulls_last else known + 1
    rank = F.coalesce(smaller + before_known + 1, F.lit(of_null))
    if s.kind == "percent_rank":
        return (rank - 1).cast("double") / F.lit(float(total - 1)) if total > 1 else F.lit(0.0)
    return rank.cast("int")


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """``row_number() OVER (ORDER BY ...)``; ``order`` must be total (unique at its end),
    so that rows equal in its first columns can lie in several partitions."""
    ranged = cut_lineage(df.repartitionByRange(*order).withColumn("__pid", F.spark_partition_id()))
    before, rows = 0, []
    for r in sorted(ranged.groupBy("__pid").count().collect(), key=lambda r: r["__pid"]):
        rows.append((r["__pid"], before))
        before += r["count"]
    offsets = df.sparkSession.createDataFrame(rows, "__pid int, __before long")      # a line for each partition
    w = Window.partitionBy("__pid").orderBy(*order)
    return (ranged.join(F.broadcast(offsets), "__pid")
            .withColumn(name, (F.col("__before") + F.row_number().over(w)).cast("int")).drop("__pid", "__before"))


def global_running_totals(df: DataFrame, order: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Adds what all rows before a row, by ``order`` (total), sum to: ``sums`` maps result ->
    summed column.  Ranges are summed one after another, so sums of whole numbers are
    exact and those of doubles don't depend on the number of ranges alone."""
    ranged = cut_lineage(df.repartitionByRange(*order).withColumn("pid", F.spark_partition_id()))
    before, rows = [0] * len(sums), []
    parts = ranged.groupBy("pid").agg(*[F.sum(c).alias(n) for n, c in sums.items()]).collect()
    for r in sorted(parts, key=lambda r: r.pid):
        rows.append((r.pid, *[float(b) for b in before]))
        before = [b + r[n] for b, n in zip(before, sums, strict=True)]
    offsets = df.sparkSession.createDataFrame(rows, "pid int" + "".join(f", __b_{n} double" for n in sums))
    w = Window.partitionBy("pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.join(F.broadcast(offsets), "pid")
            .withColumns({n: F.col(f"__b_{n}") + F.coalesce(F.sum(c).over(w).cast("double"), F.lit(0.0)) for n, c in sums.items()})
            .drop("pid", *[f"__b_{n}" for n in sums]))
