"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is a multiset of paragraph digests (lines, cut further after words that a
hash selects, so that a one-line text has many and an edit changes few).  Each
digest is added to three cells of count, key sum and check sum.  The difference of
two sketches holds the differing digests only; peeling cells that hold one digest
recovers them all, or the sketch is built again, larger, from the digests.

Shape at scale: texts move once, to ranges of ids, and are compared with the next
text in the range; only each range's first text is sent to the range before it.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KERNEL_BYTES, flat_text, hash_words, map_arrow, mix64, own_columns, prepare

CELLS = 24                # of the published sketch
HASHES = 3
CUT = np.uint64(4)        # a paragraph is cut after one word in so many
GROW = 4                  # a sketch that fails to peel is built anew, so many times larger
_CELL = np.dtype([("count", "<i4"), ("check", "<u4"), ("key", "<u8")])


def paragraph_digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(text index, digest)``, sorted; a digest that repeats in a text is
    numbered, so that all digests of a text differ."""
    owners, digests, at = [], [], 0
    while at < len(texts):
        size, to = 0, at
        while to < len(texts) and (to == at or size + len(texts[to]) <= KERNEL_BYTES):
            size += len(texts[to])
            to += 1
        flat, offsets = flat_text(pa.array(texts[at:to], pa.large_string()))
        doc, start, h = hash_words(flat, offsets)
        if len(h):
            line = np.cumsum(flat == 10)[start]
            new = np.r_[True, (doc[1:] != doc[:-1]) | (line[1:] != line[:-1]) | (h[:-1] % CUT == 0)]
            first = np.flatnonzero(new)
            place = np.arange(len(h)) - np.repeat(first, np.diff(np.r_[first, len(h)]))
            d = np.add.reduceat(mix64(h + place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), first)
            o = doc[first] + at
            order = np.lexsort((d, o))
            o, d = o[order], d[order]
            run = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (o[1:] != o[:-1])])
            again = np.arange(len(d)) - np.repeat(run, np.diff(np.r_[run, len(d)]))
            owners.append(o)
            digests.append(mix64(d + again.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))
        at = to
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(digests)


def _places(keys: np.ndarray, cells: int, seed: int) -> list[np.ndarray]:
    """The cell of each key in each of the equal parts of a sketch."""
    part = cells // HASHES
    return [(mix64(keys ^ np.uint64((seed * HASHES + i + 1) * 0x9FB21C651E98DF25 % (1 << 64))) % np.uint64(part))
            .astype(np.int64) + i * part for i in range(HASHES)]


def _check(keys: np.ndarray) -> np.ndarray:
    return mix64(keys + np.uint64(0x589965CC75374CC3)) >> np.uint64(32)


class Sketches:
    """Sketches of many sets at once: one row of ``cells`` cells per set."""

    def __init__(self, sets: int, cells: int, seed: int = 0):
        self.cells, self.seed = cells, seed
        self.count = np.zeros(sets * cells, np.int64)
        self.key, self.check = np.zeros(sets * cells, np.uint64), np.zeros(sets * cells, np.uint64)

    def add(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray) -> None:
        """Adds (sign 1) or takes away (sign -1) keys."""
        s = sign.astype(np.uint64)
        for place in _places(keys, self.cells, self.seed):
            at = owner * self.cells + place
            np.add.at(self.count, at, sign)
            np.add.at(self.key, at, keys * s)
            np.add.at(self.check, at, _check(keys) * s)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Takes out, round by round, the keys of cells that hold just one.
        Returns owners, keys and signs, and for each set whether it came out empty."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        look = np.flatnonzero(np.abs(self.count) == 1)
        while len(look):
            sign = self.count[look]
            keys = self.key[look] * sign.astype(np.uint64)
            good = (np.abs(sign) == 1) & (_check(keys) == self.check[look] * sign.astype(np.uint64))
            owner, keys, sign = look[good] // self.cells, keys[good], sign[good]
            if not len(keys):
                break
            order = np.lexsort((keys, owner))
            owner, keys, sign = owner[order], keys[order], sign[order]
            one = np.r_[True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])]
            owner, keys, sign = owner[one], keys[one], sign[one]
            found.append((owner, keys, sign))
            self.add(owner, keys, -sign)
            look = np.unique(np.concatenate([owner * self.cells + p for p in _places(keys, self.cells, self.seed)]))
            look = look[np.abs(self.count[look]) == 1]
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        empty = ~left.reshape(-1, self.cells).any(axis=1)
        return *(np.concatenate(x) for x in zip(*found, strict=True)), empty


def publish(sets: int, owner: np.ndarray, keys: np.ndarray) -> list[str]:
    """The fingerprints: base64 of the number of digests and the cells."""
    s = Sketches(sets, CELLS)
    s.add(owner, keys, np.ones(len(keys), np.int64))
    cells = np.empty(len(s.count), _CELL)
    cells["count"], cells["check"], cells["key"] = s.count, s.check & np.uint64(0xFFFFFFFF), s.key
    sizes = np.bincount(owner, minlength=sets).astype("<u4")
    raw, width = cells.tobytes(), CELLS * _CELL.itemsize
    return [base64.b64encode(sizes[i].tobytes() + raw[i * width:(i + 1) * width]).decode() for i in range(sets)]


def differences(pairs: int, a_owner, a_keys, b_owner, b_keys) -> tuple[np.ndarray, np.ndarray]:
    """How many digests only the first and only the second of each pair has, by
    subtracting sketches and peeling; pairs that fail are tried ``GROW`` times
    larger until all are recovered.  The first try subtracts the published sketches.  Once
    a sketch has more cells than the largest pair has digests four times over, what
    still fails (two equal digests in one set) is compared digest by digest."""
    only_a, only_b = np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)
    todo, cells, seed = np.arange(pairs), CELLS, 0
    largest = int(np.max(np.bincount(a_owner, minlength=pairs) + np.bincount(b_owner, minlength=pairs), initial=0))
    while len(todo):
        if cells > GROW * max(largest, CELLS):
            for p in todo:
                a, b = a_keys[a_owner == p], b_keys[b_owner == p]
                (x, m), (y, n) = (np.unique(k, return_counts=True) for k in (a, b))
                both = np.minimum(m[np.isin(x, y)], n[np.isin(y, x)]).sum()
                only_a[p], only_b[p] = len(a) - both, len(b) - both
            break
        slot = np.full(pairs, -1, np.int64)
        slot[todo] = np.arange(len(todo))
        s = Sketches(len(todo), cells, seed)
        for owner, keys, sign in ((a_owner, a_keys, 1), (b_owner, b_keys, -1)):
            mine = slot[owner] >= 0
            s.add(slot[owner[mine]], keys[mine], np.full(int(mine.sum()), sign, np.int64))
        owner, _, sign, empty = s.peel()
        done = todo[empty]
        only_a[done] = np.bincount(owner[sign > 0], minlength=len(todo))[empty]
        only_b[done] = np.bincount(owner[sign < 0], minlength=len(todo))[empty]
        todo, cells, seed = todo[~empty], cells * GROW, seed + 1
    return only_a, only_b


def likeness(pairs: int, a_owner, a_keys, b_owner, b_keys) -> np.ndarray:
    """Common digests over all digests of each pair; 1 where neither has any."""
    only_a, only_b = differences(pairs, a_owner, a_keys, b_owner, b_keys)
    union = np.bincount(a_owner, minlength=pairs) + only_b
    return np.where(union > 0, (union - only_a - only_b) / np.maximum(union, 1), 1.0)


def edit(text: str, following: str) -> str:
    """``text`` with its last quarter (rounded down) replaced by as much of the
    front of ``following``, or all of it if it is shorter."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


SCHEMA = ("doc_id {0}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike the
    text's fingerprint is to the edited text's and to the next document's.

    Null text is empty.  Documents stand in order of id, then text; rows without
    an id come last; after the last comes the first.  Rows with equal ids are
    documents of their own.  A single document is followed by itself.
    """
    own_columns(docs, id_col, text_col)
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    ids = base.select("doc_id")
    n = ids.count()
    if not n:
        return base.selectExpr("doc_id", "0L n_chars", "'' edited_sha256", "'' fingerprint", "'' edited_fingerprint",
                               "0D near_edited", "0D near_next")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // 20_000))
    # ranges of ids: as many numbers on the driver as there are partitions
    cuts = np.unique(np.array(ids.where("doc_id IS NOT NULL").approxQuantile(
        "doc_id", [i / parts for i in range(1, parts)], 1 / (8 * parts)) if parts > 1 else [], np.float64))

    def range_of(v: pd.Series) -> np.ndarray:
        known = v.notna().to_numpy()
        out = np.full(len(v), len(cuts), np.int64)
        out[known] = np.searchsorted(cuts, v[known].to_numpy(np.float64), "right")
        return out

    part = F.pandas_udf(lambda v: pd.Series(range_of(v)), "long")
    heads = sorted((r.p, r.f) for r in ids.groupBy(part("doc_id").alias("p")).agg(F.min("doc_id").alias("f")).collect())
    # the first document of a range also goes to the end of the range before
    ahead = {f: heads[i - 1][0] for i, (_, f) in enumerate(heads)}

    @F.pandas_udf("array<struct<part: int, ahead: boolean>>")
    def places(v: pd.Series) -> pd.Series:
        return pd.Series([[{"part": p, "ahead": False}] + ([{"part": ahead[i], "ahead": True}] if i in ahead else [])
                          for p, i in zip(range_of(v), (None if pd.isna(x) else int(x) for x in v), strict=True)])

    dealt = base.select("doc_id", "text", F.explode(places("doc_id")).alias("w")).select("doc_id", "text", "w.*")
    ordered = (dealt.repartitionById(len(cuts) + 1, F.col("part"))
               .sortWithinPartitions("part", "ahead", F.col("doc_id").asc_nulls_last(), "text"))

    def work(rows: list[tuple]) -> pa.RecordBatch:
        """Rows are (id, text, next text)."""
        m = len(rows)
        texts, follow = [r[1] for r in rows], [r[2] for r in rows]
        edited = [edit(t, f) for t, f in zip(texts, follow, strict=True)]
        own, mine = paragraph_digests(texts)
        e_own, theirs = paragraph_digests(edited)
        # a next text is mostly the next row's own text
        same = np.array([i + 1 < m and follow[i] is texts[i + 1] for i in range(m)])
        lone = np.flatnonzero(~same)
        l_own, l_keys = paragraph_digests([follow[i] for i in lone])
        shifted = (own > 0) & same[own - 1]
        n_own = np.concatenate([own[shifted] - 1, lone[l_own]])
        n_keys = np.concatenate([mine[shifted], l_keys])
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
            pa.array(publish(m, own, mine)), pa.array(publish(m, e_own, theirs)),
            pa.array(likeness(m, own, mine, e_own, theirs)), pa.array(likeness(m, own, mine, n_own, n_keys)),
        ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches):
        held, ready, size = None, [], 0          # held: the row that waits for its next
        for b in batches:
            for i, text, at, is_ahead in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if held is not None and held[2] == at:
                    ready.append((held[0], held[1], text))
                    size += len(held[1])
                held = None if is_ahead else (i, text, at)
                if size > KERNEL_BYTES:
                    yield work(ready)
                    ready, size = [], 0
        if ready:
            yield work(ready)

    return map_arrow(ordered, run, SCHEMA.format("long"))
