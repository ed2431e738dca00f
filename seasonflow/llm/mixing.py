"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same expected number of copies; the whole
part is certain and the fractional part is rounded by the pivotal method: two
fractional documents exchange mass at random, weighted by size so that the words
of the pair stay the same, until one of them is integral.  Groups of bounded size
do this at once; each passes on at most one fractional document to the next level
of a reduction tree, up to one per source.

Shape at scale: rows are narrow (id, source, size).  Leaves are dealt by a hash of
the id into as many groups as the source needs, so a source with a third of all
documents becomes many groups.  Each level has ``fanout`` times fewer rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonflow.operators.distributed import global_row_number, global_running_totals

from .common import WORD, Scratch, own_columns

WEIGHTS = (5, 2, 1)


def source_targets(sources: DataFrame, weights=WEIGHTS, max_repeat: int = 3, scratch: Scratch | None = None) -> DataFrame:
    """``sources``: (source, source_size), one row each.  Adds ``target``.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    all words; a target stops at ``max_repeat`` times its source, and the excess is
    shared by weight among the others until none is above.
    """
    # one row per source, and however many sources there are, ranges of them in tasks of their own
    ranked = global_row_number(sources.select("source", "source_size"), [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    cap = (F.col("source_size") * max_repeat).cast("double")
    ranked = ranked.withColumn("weight", weight).withColumn("cap", cap).withColumn("turn", cap / weight)
    ranked = (scratch or Scratch(sources.sparkSession)).save(ranked, "sources")
    # sources meet their caps in the order of cap / weight: were all before a source capped, the others would share
    # what is left at this level; the caps that hold are those before the first source whose level is in its reach
    step = global_running_totals(ranked, ["turn", "rank"], {"fixed": "cap", "used": "weight"})
    words, open_ = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    if not words:
        return ranked.withColumn("target", F.lit(0.0)).drop("rank", "cap", "turn")
    level = (F.lit(float(words)) - F.col("fixed")) / (F.lit(float(open_)) - F.col("used"))
    level = step.agg(F.max(F.when(level <= F.col("turn"), level))).first()[0]
    return ranked.withColumn("target", F.least("cap", F.lit(level) * F.col("weight"))).drop("rank", "cap", "turn")


def _pivot(size: np.ndarray, p: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """Rounds fractional ``p`` in order; returns them and the index of the one
    that is still fractional (or -1)."""
    p = p.copy()
    eps, cur = 1e-9, -1
    _settle_large(size, p, draw)
    for i in range(len(p)):
        if p[i] <= eps or p[i] >= 1 - eps:
            p[i] = 0.0 if p[i] <= eps else 1.0
            continue
        if cur < 0:
            cur = i
            continue
        a, b, r = p[cur], p[i], size[i] / size[cur]
        up, down = min(1 - a, b * r), min(a, (1 - b) * r)
        if draw[i] * (up + down) < down:
            a, b = a + up, b - up / r
        else:
            a, b = a - down, b + down / r
        p[cur], p[i] = a, b
        done_cur, done_i = not eps < a < 1 - eps, not eps < b < 1 - eps
        p[cur] = round(a) if done_cur else a
        p[i] = round(b) if done_i else b
        cur = -1 if done_cur and done_i else (i if done_cur else cur)
    return p, cur


def _settle_large(size: np.ndarray, p: np.ndarray, draw: np.ndarray, share: float = 0.02, huge: float = 0.2) -> None:
    """Rounds, in place, documents of more than ``share`` of the words that are
    still open, against all smaller ones together: their probabilities move by one
    common step.  One by one these could never outweigh it, and it would be left
    over.  Where the others can balance one direction only, the document waits for
    its turn, unless it has more than ``huge`` of all words: then that direction is
    taken, as the other would miss the target."""
    whole = size[(p > 1e-9) & (p < 1 - 1e-9)].sum()
    for i in range(len(p) - 1):
        rest = np.flatnonzero((p[i + 1:] > 1e-9) & (p[i + 1:] < 1 - 1e-9)) + i + 1
        total = size[rest].sum()
        if not total or size[i] <= share * total:
            return
        if not 1e-9 < p[i] < 1 - 1e-9:
            continue
        up, down = (1 - p[i]) * size[i] / total, p[i] * size[i] / total
        can_up, can_down = up <= p[rest].min(), down <= 1 - p[rest].max()
        if not (can_up and can_down) and not ((can_up or can_down) and size[i] > huge * whole):
            continue
        if can_up and (draw[i] < p[i] or not can_down):
            p[i], p[rest] = 1.0, p[rest] - up
        else:
            p[i], p[rest] = 0.0, p[rest] + down


ROUND_SCHEMA = "id long, row long, source string, size long, base long, p double, leaf long, last boolean, copies long"


def _round_group(seed: int, level: int):
    def run(key, table):
        # largest first, so that what is left over at the end is small
        table = table.take(pc.sort_indices(table, sort_keys=[
            ("size", "descending"), ("id", "ascending"), ("row", "ascending")]))
        leaf = key[1].as_py()
        rng = np.random.Generator(np.random.Philox(key=[seed, level * 1_000_003 + leaf]))
        size = table["size"].to_numpy().astype(float)
        p, rest = _pivot(size, table["p"].to_numpy(), rng.random(len(size)))
        last = np.zeros(len(p), bool)
        copies = table["base"].to_numpy() + np.round(p).astype(np.int64)
        if rest >= 0:
            last[rest] = True
        return pa.table({c: table[c] for c in ("id", "row", "source", "size", "base")} | {
            "p": pa.array(p), "leaf": table["leaf"], "last": pa.array(last), "copies": pa.array(copies)})
    return run


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights=WEIGHTS, max_repeat: int = 3, seed: int = 17, group_rows: int = 4096,
           scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``row`` (tells apart rows with equal ids),
    source, size in words, source_size, target and ``copies`` (0 to ``max_repeat``).

    Null text has size 0.  A document of size 0 gets the whole part of its
    expected copies, which changes no word count.  Rows that share an id are
    separate documents when their texts differ; equal rows get equal copies.
    Draws depend on ids, sizes and ``seed`` only, so reruns agree however the rows
    are partitioned.
    """
    own_columns(docs, id_col, text_col, source_col)
    scratch = scratch or Scratch(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    sized = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("row"),
                        F.col(f"`{source_col}`").alias("source"),
                        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
    sized = scratch.save(sized, "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    goal = source_targets(totals, weights, max_repeat, scratch)
    goal = goal.join(totals.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    goal = scratch.save(goal.select(F.col("source").alias("goal_source"), "source_size", "target", "n"), "targets")

    # equal rows are rounded together, as one document of their common size
    units = sized.groupBy("id", "row", "source", "size").agg(F.count(F.lit(1)).alias("k"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = units.join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).select(
        "id", "row", "source", (F.col("size") * F.col("k")).alias("size"), rate.alias("rate"), "n")
    leaf = F.pmod(F.xxhash64("id", "row", F.lit(seed)), F.greatest(F.lit(1), F.ceil(F.col("n") / group_rows))).cast("long")
    base = F.floor(F.col("rate") + 1e-9)
    p = F.when(F.col("size") > 0, F.greatest(F.lit(0.0), F.col("rate") - base)).otherwise(0.0)
    todo = units.select("id", "row", "source", "size", base.cast("long").alias("base"), p.alias("p"), leaf.alias("leaf"))
    done, level = [], 0
    while True:
        part = scratch.save(todo.groupBy("source", "leaf").applyInArrow(_round_group(seed, level), ROUND_SCHEMA),
                            f"round{level}")
        done.append(part.where(~F.col("last")))
        rest = part.where("last")
        wide = rest.groupBy("source").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0] or 0
        level += 1
        if wide <= 1:
            # at most one document a source: an unbiased draw settles it
            u = F.pmod(F.xxhash64("id", "row", F.lit(seed + level)), F.lit(1 << 30)) / F.lit(float(1 << 30))
            done.append(rest.withColumn("copies", F.col("base") + (u < F.col("p")).cast("long")))
            break
        todo = rest.select("id", "row", "source", "size", "base", "p",
                           F.floor(F.col("leaf") / group_rows).cast("long").alias("leaf"))
    settled = done[0]
    for d in done[1:]:
        settled = settled.unionByName(d)
    settled = settled.select(F.col("id").alias("i"), F.col("row").alias("r"), F.col("source").alias("so"), "copies")
    out = sized.join(settled, F.col("id").eqNullSafe(F.col("i")) & (F.col("row") == F.col("r"))
                     & F.col("source").eqNullSafe(F.col("so")))
    out = out.join(goal, F.col("source").eqNullSafe(F.col("goal_source")), "left")
    return out.select("id", "row", "source", "size", "source_size", "target", "copies")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: rows of ``docs``, all columns, each repeated as often as
    ``copies`` says (rows with no copies are left out)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    taken = (copies(docs, id_col, text_col, source_col, **how)
             .select(F.col("id").alias("__i"), F.col("row").alias("__r"), F.col("source").alias("__s"),
                     F.col("copies").alias("__n")).distinct())
    marked = docs.withColumn("__m", F.xxhash64(text))
    on = (F.col(f"`{id_col}`").eqNullSafe(F.col("__i")) & (F.col("__m") == F.col("__r"))
          & F.col(f"`{source_col}`").eqNullSafe(F.col("__s")))
    joined = marked.join(taken.where(F.col("__n") > 0), on)
    return (joined.withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__n"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
