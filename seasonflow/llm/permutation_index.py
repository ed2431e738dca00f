"""Approximate nearest neighbours from a permutation index.

Every vector is represented by its ``PREFIX`` nearest pivots in order.  The index posts it,
with the place the pivot has in that order, in the inverted file of each of them.  A
query reads the files of its own ``ASKED`` nearest pivots only and ranks the rows by the
footrule distance over these, a pivot that is not in a row's prefix standing just after
it.  The nearest share by footrule is ranked again by the true distance.

Shape at scale: rows are dealt by hash to parts of bounded size, each with its own
inverted files, so no pivot's file (a third of all rows may be copies of one vector, and
then share all their pivots) is ever whole in one task.  Queries go to every part in
blocks; a task ranks a block's queries in one part and gives back ``k`` rows each, which
one window merges.  The number of rows ranked again grows with the part, and ties at its
end all take part, so no row is cut off by a fixed cap.  On the driver lie the pivots.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, map_arrow, own_columns, per_cogroup
from .vectors import common_size, first_of_groups, matrix, sample, valid

SAMPLE_ROWS = 4_096      # rows that the pivots are chosen from, at most
PIVOTS = 256
PREFIX = 128             # pivots that represent a row
ASKED = 64               # nearest pivots of a query whose files are read
SHARE = 0.2              # of a part's rows, ranked again by distance; at least LEAST rows
LEAST = 256
PART_ROWS = 16_384       # rows of a part
BLOCK_QUERIES = 8_192    # queries that a task ranks a part for; a part is sent once per block of them


def choose_pivots(taken: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` distinct vectors of a sample that is in random order."""
    _, first = np.unique(taken, axis=0, return_index=True)
    return taken[np.sort(first)[:most]]


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``x`` to ``y``: squares are added from the first
    component to the last in double precision."""
    total = np.zeros(len(x))
    for i in range(x.shape[1]):
        total += (x[:, i] - y[i]) ** 2
    return np.sqrt(total)


def permutations(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of every row, nearest first (ties by number)."""
    with np.errstate(over="ignore", invalid="ignore"):
        d = np.nan_to_num((x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * x @ pivots.T, nan=np.inf)
    return np.argsort(d, axis=1, kind="stable")[:, :prefix].astype("<u2")


class InvertedFiles:
    """For every pivot the rows of a part that have it in their prefix, and its place there."""

    def __init__(self, perms: np.ndarray, pivots: int):
        self.rows, self.prefix = perms.shape
        flat = perms.ravel().astype(np.int64)
        order = np.argsort(flat, kind="stable")
        cuts = np.cumsum(np.bincount(flat, minlength=pivots))[:-1]
        self.posted = np.split(order // self.prefix, cuts)
        self.places = np.split((order % self.prefix).astype(np.int32), cuts)

    def footrule(self, perm: np.ndarray) -> np.ndarray:
        """Footrule distance of all rows over the pivots of ``perm``."""
        missing = np.maximum(self.prefix - np.arange(len(perm)), 0)
        out = np.full(self.rows, missing.sum(), np.int32)
        for place, pivot in enumerate(perm):
            out[self.posted[pivot]] += np.abs(self.places[pivot] - place) - missing[place]
        return out


_FOUND = "qid long, query_id long, id long, score double"


def _rank(rows: pa.Table, queries: pa.Table, k: int, share: float, pivots: int) -> pa.Table:
    none = pa.table({"qid": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()),
                     "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    if not rows.num_rows or not queries.num_rows:
        return none
    x, ids = matrix(rows.column("v")), rows.column("id").to_numpy()
    perms = lambda t: np.stack([np.frombuffer(p, "<u2") for p in t.column("perm").to_pylist()])
    files = InvertedFiles(perms(rows), pivots)
    depth = max(LEAST, k, int(np.ceil(share * len(ids))))
    out = []
    with np.errstate(over="ignore", invalid="ignore"):
        for qid, own, q, perm in zip(queries.column("uid").to_pylist(), queries.column("id").to_pylist(),
                                     matrix(queries.column("v")), perms(queries), strict=True):
            far = files.footrule(perm[:ASKED])
            others = np.flatnonzero(ids != own)
            if len(others) > depth:
                far = far[others]
                others = others[far <= np.partition(far, depth - 1)[depth - 1]]
            if not len(others):
                continue
            d = _distances(x[others], q)
            if len(others) > k:
                near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
                others, d = others[near], d[near]
            best = first_of_groups([], d, ids[others], k, descending=False) if len(d) > 1 else np.zeros(1, int)
            out.append((np.full(len(best), qid), np.full(len(best), own), ids[others[best]], d[best]))
    if not out:
        return none
    a, b, c, d = (np.concatenate(v) for v in zip(*out, strict=True))
    return pa.table({"qid": pa.array(a, pa.int64()), "query_id": pa.array(b, pa.int64()),
                     "id": pa.array(c, pa.int64()), "score": pa.array(d, pa.float64())})


def search(df: DataFrame, queries: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10,
           share: float = SHARE) -> DataFrame:
    """The ``k`` nearest rows found of every query: ``(query_id, rank, <id>, score)``.

    ``queries`` (a condition on ``df``) selects the query rows; all rows with another
    id are their candidates.  ``score`` is the Euclidean distance of the vectors as given,
    in double precision, smaller first, ties by smaller id; with fewer than ``k``
    candidates all are returned.  ``share`` of the rows, and ties with the last of them,
    are ranked by distance: more finds more (tests hold recall against brute force).

    Rows without an id, without a vector, with a null, infinite or NaN component, with an
    empty or all-zero vector or with another number of components than most rows take
    no part.  Rows with equal ids are rows of their own, but never each other's
    candidates.  Empty tables give no rows; other columns are not read.
    """
    own_columns(df, id_col, vec_col)
    spark = df.sparkSession
    scratch = Scratch(spark)
    rows = valid(df, id_col, vec_col, query=F.coalesce(queries, F.lit(False)))
    rows = rows.where(F.exists("v", lambda x: x != 0))
    dim = common_size(rows)
    rows = scratch.save(rows.where(F.size("v") == dim), "vectors")
    n, n_queries = rows.agg(F.count("*"), F.count_if("query")).first()
    if not n or not n_queries:
        return spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score double")
    pivots = choose_pivots(sample(rows, SAMPLE_ROWS), PIVOTS)
    prefix = min(PREFIX, len(pivots))

    def represent(batches):
        for b in batches:
            if not b.num_rows:
                continue
            perm = permutations(matrix(b.column("v")), pivots, prefix)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("uid", "id", "query", "v")), pa.array([p.tobytes() for p in perm], pa.binary())],
                ["uid", "id", "query", "v", "perm"])
    index = scratch.save(map_arrow(rows, represent, "uid long, id long, query boolean, v array<double>, perm binary"), "index")
    scratch.drop(rows)
    parts, blocks = -(-n // PART_ROWS), -(-n_queries // BLOCK_QUERIES)
    count = len(pivots)

    def step(_, part: pa.Table, asking: pa.Table) -> pa.Table:
        return _rank(part, asking, k, share, count)

    dealt = index.select(F.pmod(F.xxhash64("uid"), F.lit(parts)).cast("int").alias("part"),
                         F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "v", "perm")
    asking = (index.where("query")
              .select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
                      F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int").alias("block"), "uid", "id", "v", "perm"))
    found = (dealt.groupBy("part", "block").cogroup(asking.groupBy("part", "block"))
             .applyInArrow(per_cogroup(step), _FOUND))
    w = Window.partitionBy("qid").orderBy("score", "id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))
