"""Scans and seeds.

Readers always select the needed columns up front so Catalyst prunes the
parquet scan (``ReadSchema`` in the plan) and pushes filters into it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_raw(spark: SparkSession, root: str, name: str, columns: Sequence[str] | None = None,
             schema: StructType | None = None) -> DataFrame:
    """Scan one raw table as it is now; an explicit schema skips footer inference."""
    r = spark.read if schema is None else spark.read.schema(schema)
    df = r.parquet(table_path(root, name))
    return df.select(*columns) if columns else df


def infer_schema(spark: SparkSession, path: str) -> StructType:
    """Names and types from parquet footers (S07); names resolve case-insensitively
    under the default ``spark.sql.caseSensitive=false``."""
    return spark.read.parquet(path).schema


def read_seed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Static CSV lookup with a header; empty fields become NULL."""
    return (spark.read.option("header", True).option("nullValue", "")
            .option("mode", "PERMISSIVE").schema(schema).csv(path))
