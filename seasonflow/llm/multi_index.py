"""Hard negatives from an inverted multi-index.

Two codebooks, one for each half of the components, put every row into a cell: the
pair of its halves' nearest codewords.  A row's score for an anchor is the inner product,
so within a cell it is at most the sum of two half bounds: the anchor's half times the
codeword plus the half's length times the codeword's radius (the farthest of *all*
rows).  A heap walks the pairs of both sorted bound lists in descending order of
the sum (the multi-sequence algorithm), so the bound of the next cell holds for every
row not seen yet, and an anchor stops as soon as its window is certified:

1. positives: the last of the first ``n_pos`` rows of its label beats the next bound;
2. negatives: for every positive, the last of the first ``n_neg`` rows of other labels in
   the window beats the next bound, or the next bound lies under the window.

Both are exact, whatever the codebooks are; they only decide how many cells are read.

Shape at scale: rows are written once by cell and dealt to parts of bounded size (a
cell with more rows, say of a third of the table's copies, is split over several).  In
each round every open anchor goes to the parts that hold its next cells, in blocks; a
task scores one block against one part and gives back a few rows per anchor.  A round
may read sixteen times as many rows as the last one, so there are few.  On the driver
lie the codebooks and one line for each cell, at most ``CODEWORDS`` squared.
"""

from __future__ import annotations

import heapq
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, map_arrow, own_columns, per_cogroup
from .vectors import common_size, first_of_groups, matrix, sample, valid

SAMPLE_ROWS = 16_384     # rows that the codebooks are fitted on, at most
CODEWORDS = 256          # of a half, at most
CELL_ROWS = 64           # rows that a cell should hold, up to that many codewords
PART_ROWS = 16_384       # index rows a task scores at once
BLOCK_ANCHORS = 2_048    # anchors a task scores them for
FIRST_ROWS = 4_096       # rows an anchor may read in the first round; later ones GROW times as many
GROW = 16
_CHUNK, _LANES = 2_048, 256     # rows and anchors of one matrix product
_MOST = 1 << 50          # scores stay under it, so that doubles hold them exactly
_NONE = -(1 << 62)


# -- codebooks and cells -------------------------------------------------------------------
def _distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (words * words).sum(1) - 2 * x @ words.T, 0)


def codebook(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """``k`` codewords at most (as many as there are distinct rows) by Lloyd's rounds."""
    distinct = np.unique(x, axis=0)
    rng = np.random.default_rng(5)
    words = distinct[np.sort(rng.choice(len(distinct), min(k, len(distinct)), replace=False))].astype(np.float64)
    for _ in range(rounds):
        near = np.argmin(_distances(x, words), axis=1)
        size = np.bincount(near, minlength=len(words))
        total = np.zeros_like(words)
        np.add.at(total, near, x)
        words = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], words)
    return words


class Cells:
    """The codebooks, the radius of every codeword and where each cell's rows lie."""

    def __init__(self, words: list[np.ndarray], half: int):
        self.words, self.half = words, half
        self.second = len(words[1])

    def halves(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, :self.half], x[:, self.half:]]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Cell of every row, and the distances of its halves to their codewords."""
        codes, far = [], []
        for h, words in zip(self.halves(x), self.words, strict=True):
            codes.append(np.argmin(_distances(h, words), axis=1))
            far.append(np.sqrt(((h - words[codes[-1]]) ** 2).sum(1)))
        return codes[0] * self.second + codes[1], far

    def fill(self, stats: list) -> None:
        """Takes in ``(cell, rows, first half's largest distance, second's)``."""
        self.radius = [np.full(len(w), -1.0) for w in self.words]
        self.rows = {}
        self.parts: dict[int, tuple[int, int]] = {}
        filled, part = 0, 0
        for cell, n, far_a, far_b in sorted(stats):
            a, b = divmod(cell, self.second)
            self.radius[0][a] = max(self.radius[0][a], far_a)
            self.radius[1][b] = max(self.radius[1][b], far_b)
            self.rows[cell] = n
            if n > PART_ROWS:                   # a hot cell has parts of its own
                share = -(-n // PART_ROWS)
                part += filled > 0
                self.parts[cell] = (part, share)
                part, filled = part + share, 0
                continue
            if filled + n > PART_ROWS:
                part, filled = part + 1, 0
            self.parts[cell] = (part, 1)
            filled += n

    def bounds(self, v: np.ndarray) -> list[np.ndarray]:
        """Upper bounds of the half scores with any row of each codeword."""
        return [words @ h + np.sqrt(h @ h) * np.maximum(r, 0) for h, words, r in
                zip((v[:self.half], v[self.half:]), self.words, self.radius, strict=True)]

    def walk(self, v: np.ndarray):
        """``(bound, cell)`` of all cells with rows, in descending order of the bound:
        pairs of the two sorted lists of half bounds, taken from a heap.  A pair enters
        once the one before it in both directions is out."""
        half = self.bounds(v)
        lists_ = [[(float(b[i]), int(i)) for i in np.argsort(-b, kind="stable") if r[i] >= 0]
                  for b, r in zip(half, self.radius, strict=True)]
        one, two = lists_
        # a double's rounding must not take a row from a cell: scores are whole numbers
        slack = 1e-9 * (1 + sum(float(np.abs(b).max(initial=0)) for b in half))
        if not one or not two:
            return
        heap, out = [(-(one[0][0] + two[0][0]), 0, 0)], {}
        while heap:
            bound, i, j = heapq.heappop(heap)
            out[i] = j + 1                       # this row of pairs is taken up to j
            cell = one[i][1] * self.second + two[j][1]
            if cell in self.rows:
                yield float(np.floor(slack - bound)), cell
            if j + 1 < len(two) and (i == 0 or out.get(i - 1, 0) > j + 1):
                heapq.heappush(heap, (-(one[i][0] + two[j + 1][0]), i, j + 1))
            if i + 1 < len(one) and out.get(i + 1, 0) == j:
                heapq.heappush(heap, (-(one[i + 1][0] + two[j][0]), i + 1, j))


# -- one round ---------------------------------------------------------------------------------
_ANCHOR = "aid long, id long, label long, v array<long>, lows array<long>, highs array<long>"


def _visits(open_anchors: DataFrame, cells: Cells, limit: int) -> DataFrame:
    """For every open anchor its next cells, by part, and the bound of the one after them."""
    schema = _ANCHOR + ", seen long, bound double, visits array<struct<part: int, cells: binary>>"

    def run(batches):
        for b in batches:
            x = matrix(b.column("v"))
            seen, least = b.column("seen").to_pylist(), b.column("least").to_pylist()
            new_seen, bounds, visits = [], [], []
            for i in range(b.num_rows):
                by_part, rows, at, next_bound = {}, 0, 0, -np.inf
                for bound, cell in cells.walk(x[i]):
                    at += 1
                    if at <= seen[i]:
                        continue
                    if bound < least[i] or rows >= limit:
                        at, next_bound = at - 1, bound
                        break
                    first, share = cells.parts[cell]
                    for p in range(first, first + share):
                        by_part.setdefault(p, []).append(cell)
                    rows += cells.rows[cell]
                new_seen.append(at)
                bounds.append(next_bound)
                visits.append([{"part": p, "cells": np.array(c, "<i4").tobytes()} for p, c in by_part.items()])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in ("aid", "id", "label", "v", "lows", "highs")), pa.array(new_seen, pa.int64()),
                 pa.array(bounds, pa.float64()),
                 pa.array(visits, pa.list_(pa.struct([("part", pa.int32()), ("cells", pa.binary())])))],
                ["aid", "id", "label", "v", "lows", "highs", "seen", "bound", "visits"])
    return map_arrow(open_anchors, run, schema)


_FOUND = "aid long, kind int, score long, id long"


def _score(rows: pa.Table, anchors: pa.Table, keep: int) -> pa.Table:
    """The first ``keep`` rows per anchor: of its own label (kind 0) while it has no
    windows, else of other labels in each of its windows (kinds 1, 2, ...)."""
    none = pa.table({n: pa.array([], t) for n, t in
                     (("aid", pa.int64()), ("kind", pa.int32()), ("score", pa.int64()), ("id", pa.int64()))})
    if not rows.num_rows or not anchors.num_rows:
        return none
    ids, labels, cell = (rows.column(n).to_numpy() for n in ("id", "label", "cell"))
    order = np.argsort(ids, kind="stable")
    ids, labels, cell, x = ids[order], labels[order], cell[order], matrix(rows.column("v"))[order]
    known, cell = np.unique(cell, return_inverse=True)
    out = []
    for at in range(0, anchors.num_rows, _LANES):
        a = anchors.slice(at, _LANES)
        m, own, label = matrix(a.column("v")), a.column("id").to_numpy(), a.column("label").to_numpy()
        aid, lows, highs = a.column("aid").to_numpy(), a.column("lows").to_pylist(), a.column("highs").to_pylist()
        asked = np.zeros((len(m), len(known)), bool)
        for i, c in enumerate(a.column("cells").to_pylist()):
            want = np.frombuffer(c, "<i4")
            place = np.searchsorted(known, want)
            place[place == len(known)] = 0
            asked[i, place[known[place] == want]] = True
        windows = max((len(w) for w in lows), default=0)
        for s in range(0, len(ids), _CHUNK):
            part = slice(s, s + _CHUNK)
            use = np.flatnonzero(asked[:, cell[part]].any(axis=0)) + s
            if not len(use):
                continue
            seen = asked[:, cell[use]] & (ids[use] != own[:, None])
            score = (m @ x[use].T).astype(np.int64)
            same = labels[use] == label[:, None]
            # rows lie in order of id: among equal scores the earlier one is larger
            key = score * _CHUNK + (_CHUNK - 1 - np.arange(len(use)))
            for kind in range(windows + 1):
                if kind == 0:
                    good = seen & same & np.array([not w for w in lows])[:, None]
                else:
                    low = np.array([w[kind - 1] if len(w) >= kind else 1 for w in lows])
                    high = np.array([w[kind - 1] if len(w) >= kind else 0 for w in highs])
                    good = seen & ~same & (score >= low[:, None]) & (score <= high[:, None])
                if not good.any():
                    continue
                k = np.where(good, key, _NONE)
                top = np.argpartition(-k, min(keep, k.shape[1]) - 1, axis=1)[:, :keep]
                lane, col = np.nonzero(np.take_along_axis(k, top, 1) > _NONE)
                col = top[lane, col]
                out.append((aid[lane], np.full(len(lane), kind), score[lane, col], ids[use[col]]))
    if not out:
        return none
    a, kind, score, found = (np.concatenate(c) for c in zip(*out, strict=True))
    pick = first_of_groups([a, kind], score, found, keep, descending=True)
    return pa.table({"aid": pa.array(a[pick], pa.int64()), "kind": pa.array(kind[pick], pa.int32()),
                     "score": pa.array(score[pick], pa.int64()), "id": pa.array(found[pick], pa.int64())})


def _first(found: DataFrame, keep: int) -> DataFrame:
    w = Window.partitionBy("aid", "kind").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)


def _search(scratch: Scratch, index: DataFrame, anchors: DataFrame, cells: Cells, keep: int, blocks: int,
            positive: bool) -> DataFrame:
    """Rounds until every anchor's lists are certified: ``(aid, kind, score, id, rank)``.
    ``anchors`` has ``least``: no row with a smaller score is of use."""
    def step(_, rows: pa.Table, asking: pa.Table) -> pa.Table:
        return _score(rows, asking, keep)

    best, state, limit = None, anchors.withColumn("seen", F.lit(0).cast("long")), FIRST_ROWS
    while True:
        seen = scratch.save(_visits(state, cells, limit), "visits")
        asked = seen.select(*[n.split()[0] for n in _ANCHOR.split(", ")],
                            F.pmod(F.xxhash64("aid"), F.lit(blocks)).cast("int").alias("block"),
                            F.inline("visits"))
        needed = asked.groupBy(F.col("part").alias("p"), F.col("block").alias("b")).count()
        sent = index.join(needed, index["part"] == needed["p"]).select(
            F.col("p").alias("part"), F.col("b").alias("block"), "cell", "id", "label", "v")
        new = (sent.groupBy("part", "block")
               .cogroup(asked.groupBy("part", "block"))
               .applyInArrow(per_cogroup(step), _FOUND))
        both = new if best is None else best.select("aid", "kind", "score", "id").unionByName(new)
        before, best = best, scratch.save(_first(both, keep), "best")
        if before is not None:
            scratch.drop(before)
        # the worst score that a row not seen yet must reach to change the lists
        last = best.groupBy("aid", "kind").agg(F.count("*").alias("n"), F.min("score").alias("s"))
        if positive:
            need = last.select("aid", F.when(F.col("n") >= keep, F.col("s").cast("double")).alias("need"))
            open_ = (seen.join(need, "aid", "left")
                     .withColumn("least", F.coalesce("need", F.lit(float("-inf")))))
        else:
            low = seen.select("aid", F.posexplode("lows").alias("kind", "low")).withColumn("kind", F.col("kind") + 1)
            need = (low.join(last, ["aid", "kind"], "left")
                    .groupBy("aid").agg(F.min(F.when(F.col("n") >= keep, F.greatest("s", "low"))
                                              .otherwise(F.col("low"))).cast("double").alias("need")))
            open_ = seen.join(need, "aid").withColumn("least", F.col("need"))
        # a bound that equals the score may hide a tie with a smaller id
        open_ = (open_.where((F.col("bound") >= F.col("least")) & (F.col("bound") > float("-inf")))
                 .select(*[n.split()[0] for n in _ANCHOR.split(", ")], "least", "seen"))
        after = scratch.save(open_, "open")
        scratch.drop(seen, state)
        state = after
        if state.isEmpty():
            scratch.drop(state)
            return best
        limit *= GROW


OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(df: DataFrame, anchors: Column, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None,
         n_pos: int = 5, n_neg: int = 5, low_pct: int = 80, scale: int = 256) -> DataFrame:
    """The hard negatives of every anchor's positives.

    ``anchors`` (a condition on ``df``) selects the anchors, ``label`` is their class (an
    integer; default the column ``label``).  A component x counts as floor(scale * x); a
    score is the integer inner product, higher first, ties by smaller id.  Positives
    are an anchor's first ``n_pos`` other rows of its label, negatives of a positive with score
    p the first ``n_neg`` rows of other labels whose score lies from ``low_pct`` percent
    of p up to p.  A p below zero has an empty window; lists may be shorter, and an
    empty one has no rows.

    Rows without an id, label or vector, with a null, infinite or NaN component, with
    an empty vector or with another number of components than most rows take no part.
    Rows with equal ids are rows of their own, but never each other's positives or
    negatives.  Empty tables give no rows; other columns are not read.  Components so
    large that a score might not be exact are an error.
    """
    own_columns(df, id_col, vec_col)
    spark = df.sparkSession
    scratch = Scratch(spark)
    label = F.col("label") if label is None else label
    rows = valid(df, id_col, vec_col, label=label.cast("long"), anchor=F.coalesce(anchors, F.lit(False)))
    rows = rows.where("label IS NOT NULL")
    dim = common_size(rows)
    rows = scratch.save(rows.where(F.size("v") == dim)
                        .withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("long"))), "vectors")
    n, n_anchors, most = rows.agg(F.count("*"), F.count_if("anchor"),
                                  F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))))).first()
    if not n or not n_anchors:
        return spark.createDataFrame([], OUT)
    if dim * float(most) ** 2 >= _MOST:
        raise ValueError(f"components up to {most:.0f} are too large for exact scores")
    blocks = -(-n_anchors // BLOCK_ANCHORS)

    taken, half = sample(rows, SAMPLE_ROWS), (dim + 1) // 2
    k = max(1, min(CODEWORDS, isqrt(n // CELL_ROWS)))
    cells = Cells([codebook(taken[:, :half], k), codebook(taken[:, half:], k)], half)

    def place(batches):
        for b in batches:
            if not b.num_rows:
                continue
            cell, far = cells.assign(matrix(b.column("v")))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("uid", "id", "label", "anchor", "v")), pa.array(cell, pa.int32()),
                 *(pa.array(f, pa.float64()) for f in far)], ["uid", "id", "label", "anchor", "v", "cell", "far_a", "far_b"])
    placed = scratch.save(map_arrow(rows, place, "uid long, id long, label long, anchor boolean, v array<long>, "
                                                 "cell int, far_a double, far_b double"), "cells")
    scratch.drop(rows)
    cells.fill([tuple(r) for r in placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("far_a"), F.max("far_b")).collect()])
    where = spark.createDataFrame([(c, *p) for c, p in cells.parts.items()], "cell int, first int, share int")
    index = scratch.save(
        placed.join(where, "cell").withColumn("part", (F.col("first") + F.pmod(F.xxhash64("uid"), F.col("share"))).cast("int"))
        .select("part", "cell", "id", "label", "v"), "index")
    empty = F.array().cast("array<long>")
    chosen = placed.where("anchor").select(F.col("uid").alias("aid"), "id", "label", "v", empty.alias("lows"),
                                           empty.alias("highs"), F.lit(float("-inf")).alias("least"))
    positives = _search(scratch, index, chosen, cells, n_pos, blocks, positive=True)
    # ceil(low_pct * p / 100) for p >= 0
    low = F.expr(f"(score * {int(low_pct)} + 99) div 100")
    windows = (positives.where("score >= 0").groupBy("aid")
               .agg(F.sort_array(F.collect_list(F.struct("rank", low.alias("low"), F.col("score").alias("high")))).alias("w")))
    asked = (chosen.select("aid", "id", "label", "v").join(windows, "aid")
             .select("aid", "id", "label", "v", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"),
                     F.array_min("w.low").cast("double").alias("least")))
    negatives = _search(scratch, index, asked, cells, n_neg, blocks, positive=False)
    scratch.drop(index)
    ids = placed.where("anchor").select(F.col("uid").alias("aid"), F.col("id").alias("anchor_id"))
    return (negatives.select("aid", F.col("kind").alias("p"), F.col("rank").cast("int").alias("rank"),
                             F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(positives.select("aid", F.col("rank").alias("p"), F.col("id").alias("positive_id"),
                                   F.col("score").alias("positive_score")), ["aid", "p"])
            .join(ids, "aid")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
