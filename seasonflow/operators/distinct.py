"""Exact distinct counts from bitmaps that merge.

``count(DISTINCT ...)`` of several columns makes Spark copy every row once for each of them.
Here an id is a bit: ids are cut into buckets of 32,768, and one map-side combined
aggregate for each column sets the bits of (group, bucket).  The bitmaps of a closed
period can be kept in a table and merged with others later (``merge``), which plain counts
cannot: a player of two seasons is one bit.

A bucket costs 4 kB, so ids should be dense: the bitmaps of a column take at most an eighth
of a byte for each number between its smallest and largest id.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonflow.session import cut_lineage


def bitmaps(df: DataFrame, by: Sequence[str], ids: Mapping[str, str | Column], reread: bool = False) -> DataFrame:
    """(by, counted, bucket, bits): ``ids`` maps a name to an id column of whole numbers; NULL
    ids are not counted.  With several ids ``df`` is checkpointed, narrow, unless it
    may be read again (``reread``)."""
    cols = {n: F.col(c) if isinstance(c, str) else c for n, c in ids.items()}
    narrow = df.select(*by, *[c.cast("long").alias(f"__{n}") for n, c in cols.items()])
    if len(cols) > 1 and not reread:
        narrow = cut_lineage(narrow)
    parts = [narrow.where(F.col(f"__{n}").isNotNull())
             .groupBy(*by, F.lit(n).alias("counted"), F.bitmap_bucket_number(f"__{n}").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(f"__{n}")).alias("bits")) for n in cols]
    return reduce(DataFrame.unionByName, parts)


def merge(maps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The bitmaps of larger groups: ``by`` is a part of what they were made by."""
    return maps.groupBy(*by, "counted", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(maps: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """A column of distinct counts for each name, a row for each group."""
    n = F.bitmap_count("bits")
    return maps.groupBy(*by).agg(*[F.sum(F.when(F.col("counted") == c, n).otherwise(0)).alias(c) for c in names])
