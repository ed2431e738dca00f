"""Tables bucketed by a join key.

Tables written in the same number of buckets of one key, sorted by it, are joined and
grouped by that key without an exchange: the shuffle is paid once, by the writer.  The
number of buckets is the number of tasks of every such join, so it follows the largest
table (about a scan split for each bucket).  The files are plain Parquet; what makes them
bucketed is their entry in the session's catalog, which ``register_bucketed`` makes anew
in another session.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _name(path: str) -> str:
    return "bucketed_" + re.sub(r"\W+", "_", path).strip("_").lower()


def write_bucketed(df: DataFrame, path: str, key: Sequence[str], buckets: int) -> DataFrame:
    """Writes ``df`` under ``path`` in ``buckets`` buckets of ``key`` and returns the table.
    One task writes one bucket, so there is a file for each; the path must be new."""
    spark, name = df.sparkSession, _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (df.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key).option("path", path).mode("errorifexists")
     .saveAsTable(name))
    return spark.table(name)


def register_bucketed(spark: SparkSession, path: str, key: Sequence[str], buckets: int) -> DataFrame:
    """The table that ``write_bucketed`` left under ``path``, in a session that doesn't know it."""
    name, columns = _name(path), spark.read.parquet(path).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    by = ", ".join(f"`{k}`" for k in key)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    return spark.table(name)
