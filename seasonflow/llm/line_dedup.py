"""Line deduplication across documents.

Lines are exploded, normalised and hashed; distinct documents are counted per
hash; lines of a hash that reaches the threshold are dropped everywhere but in
the first document; documents are put together again by line position.

Shape at scale: the aggregate combines on the map side, so a line that every
document holds costs one row per task.  The join that brings the verdict back
moves (document, position, hash) only and is a plain equi-join, which AQE splits
on a hot hash.  Texts move once, with their own document's dropped positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, Scratch, ascii_lower, bind, own_columns


def line_key(line: Column) -> Column:
    """A line without white space at its ends and with A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _lines(docs: DataFrame, min_key_chars: int) -> DataFrame:
    line = F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")
    keys = (docs.select("id", "row1", "row2", line)
            .withColumn("key", line_key(F.col("line")))
            .where(F.length("key") >= min_key_chars))
    return keys.select("id", "row1", "row2", "pos", F.xxhash64("key").alias("k1"),
                       F.xxhash64(F.lit(7919), "key").alias("k2"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_key_chars: int = 10, min_docs: int = 2, scratch: Scratch | None = None) -> DataFrame:
    """Returns every row of ``docs`` with all its columns, ``text_col`` replaced
    by the lines that stay (joined by a newline), plus ``n_lines`` (before) and
    ``n_dropped``; existing columns of these two names are replaced.

    A line goes when its key has at least ``min_key_chars`` code points, at least
    ``min_docs`` documents hold it, and this is not the smallest id among them.
    Null or empty text is one empty line and becomes an empty text.  Rows that
    share an id are one document; rows without an id are one more document, which
    sorts last.  Keys are compared by a 128-bit hash.
    """
    own_columns(docs, id_col, text_col)
    scratch = scratch or Scratch(docs.sparkSession)
    rest = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    held = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)],
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    held = held.withColumn("id", F.col(f"c{rest.index(id_col)}"))
    # rows are told apart by id and text; equal rows share their positions
    held = held.withColumn("row1", F.xxhash64("text")).withColumn("row2", F.xxhash64(F.lit(7919), "text"))
    lines = _lines(held.select("id", "row1", "row2", "text"), min_key_chars)

    low, high, unnamed = F.min("id"), F.max("id"), F.max(F.col("id").isNull())
    if min_docs <= 2:
        held_by = lines.groupBy("k1", "k2").agg(low.alias("first"), high.alias("last"), unnamed.alias("unnamed"))
        common = held_by.where((F.col("first") < F.col("last")) | (F.col("unnamed") & F.col("first").isNotNull())
                               if min_docs == 2 else F.lit(True))
    else:
        held_by = (lines.select("k1", "k2", "id").distinct().groupBy("k1", "k2")
                   .agg(low.alias("first"), F.count(F.lit(1)).alias("n")))
        common = held_by.where(F.col("n") >= min_docs)
    # written, so that the join below is a stage of its own, whose hot hashes AQE can split
    common = scratch.save(common.select("k1", "k2", "first"), "common-lines")

    dropped = (lines.join(common, ["k1", "k2"])
               .where(~F.col("id").eqNullSafe(F.col("first")))
               .groupBy("id", "row1", "row2").agg(F.collect_set("pos").alias("gone"))
               .select(F.col("id").alias("id_"), F.col("row1").alias("r1"), F.col("row2").alias("r2"), "gone"))
    both = held.join(dropped, held.id.eqNullSafe(dropped.id_) & (held.row1 == dropped.r1) & (held.row2 == dropped.r2),
                     "left")
    kept = bind(F.split("text", "\n", -1), lambda ls: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("gone")), lambda i: F.get(ls, i)), "\n"))
    n_lines = F.size(F.split("text", "\n", -1)).cast("long")
    out = both.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)],
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias(text_col),
        n_lines.alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")],
                      "n_lines", "n_dropped")
