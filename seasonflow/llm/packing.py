"""Packing documents into fixed windows by Karmarkar-Karp multiway differencing.

A document is its token ids and an end id.  Whole windows are cut from its front;
the remainder is an item, or a few if it is long, because windows of many small items
come out nearer to equal.  Items are dealt by hash into groups of bounded token and
piece counts; each group is split into k windows of nearly equal sums by repeatedly
merging the two partial partitions of the largest imbalance with opposing order.
k starts at what the tokens need at least and rises whenever a window would exceed
its capacity.

Shape at scale: groups hold about ``group_windows`` windows, or ``ITEMS`` pieces where
pieces are tiny, however large the input is, so tasks are of one size; their number is
the group count.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, binary, map_arrow, own_columns, per_group
from .tokens import encoder, public_path

TOKENIZER = "word_bpe_49k.json"
ITEMS = 8_192                      # pieces of a group, about, at most
_ID_BITS = 24                      # windows of one group; the group's number stands above


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """Window (0 to k - 1) of each item, by Karmarkar-Karp multiway differencing."""
    n = len(sizes)
    if k <= 1 or n <= 1:
        return np.zeros(n, np.int64)
    heap = []
    for i in range(n):
        sums, nodes = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[0], nodes[0] = sizes[i], i
        heap.append((-int(sizes[i]), i, sums, nodes))
    heapq.heapify(heap)
    merges, free = [], n
    while len(heap) > 1:
        _, at, s1, n1 = heapq.heappop(heap)
        _, _, s2, n2 = heapq.heappop(heap)
        sums, n2 = s1 + s2[::-1], n2[::-1]        # the fullest part meets the emptiest
        nodes = np.arange(free, free + k)
        merges.append((nodes, n1, n2))
        free += k
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        sums -= sums[-1]
        heapq.heappush(heap, (-int(sums[0]), at, sums, nodes[order]))
    label = np.zeros(free + 1, np.int64)          # the last entry takes what empty slots get
    label[heap[0][3]] = np.arange(k)
    for nodes, left, right in reversed(merges):
        label[left] = label[nodes]
        label[right] = label[nodes]
    return label[:n]


def pack_sizes(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows for items of at most ``capacity``: as few as hold them this way."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, k)
        if not len(sizes) or np.bincount(window, weights=sizes).max() <= capacity:
            return window
        k += 1


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
           capacity: int = 4096, end_id: int = 2, with_ids: bool = True, dtype: str = "<u4",
           piece: int | None = None) -> DataFrame:
    """Tokenises whole texts and cuts them into pieces of ``capacity`` ids and a
    remainder in pieces of at most ``piece`` (by default a quarter of it): ``doc_id, start, length, ids_crc32,
    doc_tokens, row`` and, with ``with_ids``, ``ids`` (binary, ``dtype``).

    Null text is empty, so that it is the end id alone.  Every row of ``docs`` is
    a document of its own, also where ids repeat or are null; ``row`` numbers rows
    (task, then place among the rows it read), tells such rows apart and spreads
    them over groups.
    """
    own_columns(docs, id_col, text_col)
    path = tokenizer or public_path(TOKENIZER)
    end = np.array([end_id], np.uint32).tobytes()

    size, small = np.dtype(dtype).itemsize, piece or max(1, capacity // 4)

    def cut(batches):
        enc, row = encoder(path), TaskContext.get().partitionId() << 33
        for b in batches:
            at, start, length, crc, total, rows, ids = [], [], [], [], [], [], []
            for i, text in enumerate(b.column(1)):
                t = text.as_py()
                raw = (enc.encode(t) if t else b"") + end
                n = len(raw) // 4
                own = raw
                if size < 4:
                    ids_ = np.frombuffer(raw, "<u4")
                    if ids_.max() > np.iinfo(dtype).max:
                        raise ValueError(f"id {ids_.max()} does not fit {dtype}")
                    own = ids_.astype(dtype).tobytes()
                whole = n // capacity * capacity
                for first in (*range(0, whole, capacity), *range(whole, n, small)):
                    last = min(n, first + (capacity if first < whole else small))
                    at.append(i)
                    start.append(first)
                    length.append(last - first)
                    crc.append(zlib.crc32(raw[4 * first:4 * last]))
                    total.append(n)
                    rows.append(row)
                    if with_ids:
                        ids.append(own[size * first:size * last])
                row += 1
            cols = [b.column(0).take(pa.array(at, pa.int64())),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc, total, rows))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row"]
            if with_ids:
                cols, names = [*cols, binary(ids)], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, row long"
              + ", ids binary" * with_ids)
    return map_arrow(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), cut, schema)


def pack(cut: DataFrame, capacity: int = 4096, group_windows: int = 256, scratch: Scratch | None = None) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (all their columns stay, ids
    included).  A sequence's pieces lie gapless from offset 0 and sum to at most
    ``capacity``.  Sequence ids are unique but not dense.  No rows for no pieces."""
    own_columns(cut, "doc_id", "start", "length", "row")
    scratch = scratch or Scratch(cut.sparkSession)
    cut = scratch.save(cut, "pieces")
    loose = F.when(F.col("length") < capacity, F.col("length"))
    tokens, items = cut.agg(F.sum(loose), F.count(loose)).first()
    groups = max(1, -(-(tokens or 0) // (group_windows * capacity)), -(-items // ITEMS))
    names = cut.columns

    def run(key, table):
        keys = ["doc_id", *(["ids_crc32"] if "ids_crc32" in names else []), "start", "row"]
        table = table.take(pc.sort_indices(table, [(k, "ascending") for k in keys]))       # nulls last
        length = table["length"].to_numpy()
        whole = length >= capacity
        window = np.empty(len(length), np.int64)
        if (~whole).any():
            window[~whole] = pack_sizes(length[~whole], capacity)
        used = int(window[~whole].max()) + 1 if (~whole).any() else 0
        window[whole] = used + np.arange(whole.sum())
        by = np.argsort(window, kind="stable")
        ends = np.cumsum(length[by])
        first = np.flatnonzero(np.r_[True, np.diff(window[by]) > 0])
        offset = np.empty(len(length), np.int64)
        offset[by] = ends - length[by] - np.repeat((ends - length[by])[first], np.diff(np.r_[first, len(by)]))
        return pa.table({c: table[c] for c in names} | {
            "sequence_id": pa.array((key[0].as_py() << _ID_BITS) + window), "offset": pa.array(offset)})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    dealt = cut.withColumn("__g", F.pmod(F.xxhash64("doc_id", "row", "start"), F.lit(groups)).cast("long"))
    return dealt.groupBy("__g").applyInArrow(per_group(run), schema)
