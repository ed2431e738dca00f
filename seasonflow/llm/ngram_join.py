"""N-gram Jaccard join by vertical partitioning, down to groups of linked documents.

The n-grams of all documents have one global order, rarest first.  It is cut into
fragments; overlaps are counted fragment by fragment and summed per pair.

1. Documents with equal n-gram sets are one class and are not compared.
2. The first vertical fragment (a fixed share of the n-grams, by hash) already
   rules out most classes: one with more n-grams that no other class has than a
   link allows cannot link.
3. The classes that are left send all their n-grams to be counted.  Two linked
   classes share one of their rarest n-grams (each has one more than the number
   a link allows it to miss).  The classes that hold such an n-gram meet at its
   hub, the smallest of them; classes with much in common share most hubs.
4. At a hub, overlaps are counted exactly: per fragment of the local order, summed
   per pair, tested, and only a spanning forest of the links is given out.  So a
   group of near copies costs rows in proportion to its members, not its pairs.
   A hub with many members is cut into blocks, and each pair of blocks is a task.
5. Groups are the connected components of these edges.

Shape at scale: n-grams travel as packed arrays to partitions of bounded size;
texts move once, to find the n-grams of the classes that are left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, hash_words, map_arrow, mix64, own_columns, per_group, text_slices, total_bytes
from .packed import grouped, rows_of, schema, share, unpack

GRAMS_A_PART = 1_000_000        # n-grams in a partition, on average
FLUSH = 400_000                 # n-grams a task packs at once
BLOCK_CLASSES = 500             # of a hub that one task compares with one other block
DIRECT = 3                      # blocks of a hub that are compared pair by pair at once: each is sent as often
REPRESENTATIVES = 32            # of a large hub, which all its members are compared with first
BLOCK_GRAMS = 1_000_000
CELLS = 4_000_000               # counts kept at once while a fragment is counted


def ngram_sets(flat: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """``(text index, n-gram hash)`` of the distinct n-grams of each text, sorted.
    A text with fewer words has its whole sequence as its one n-gram."""
    doc, _, h = hash_words(flat, offsets, lower=True)
    if not len(h):
        return doc, h
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    size = np.diff(np.r_[first, len(doc)])
    rest = np.repeat(first + size, size) - np.arange(len(doc))        # words from here to the end
    place = np.arange(len(doc)) - np.repeat(first, size)
    start = np.flatnonzero((rest >= words) | ((place == 0) & (rest < words)))
    left = np.minimum(rest[start], words)
    g = mix64(left.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
    for k in range(words):
        more = left > k
        g[more] = mix64(g[more] * np.uint64(0x9FB21C651E98DF25) + h[start[more] + k])
    owner = doc[start]
    order = np.lexsort((g, owner))
    owner, g = owner[order], g[order]
    one = np.r_[True, (g[1:] != g[:-1]) | (owner[1:] != owner[:-1])]
    return owner[one], g[one]


def allowed(size, min_pct: int):
    """How many of its n-grams a set of ``size`` may lack in a linked one."""
    return size * (100 - min_pct) // 100


def _signature(owner: np.ndarray, grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.bincount(owner, minlength=n)
    sums = np.zeros((2, n), np.uint64)
    for s, seed in zip(sums, (0xA0761D6478BD642F, 0x589965CC75374CC3), strict=True):
        np.add.at(s, owner, mix64(grams ^ np.uint64(seed)))
    return size, mix64(sums[0] + size.astype(np.uint64)).view(np.int64), mix64(sums[1] ^ np.uint64(7)).view(np.int64)


_GRAM = {"ids": "i8", "sizes": "u4", "at": "u4", "key": "u8"}
_COUNT = {"ids": "i8", "sizes": "u4", "at": "u4", "count": "u4"}
_SEEN = {"ids": "i8", "sizes": "u4", "at": "u4", "key": "u8", "held": "u4", "hub": "i8"}


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _send(held: list[dict], parts: int) -> pa.RecordBatch:
    """Packs n-grams by partition, in key order inside each."""
    x = {n: np.concatenate([h[n] for h in held]) for n in _GRAM}
    groups = grouped(_part_of(x["key"], parts))
    rows = [share(x, pick[np.argsort(x["key"][pick], kind="stable")], _GRAM) for _, pick in groups]
    return rows_of(_GRAM, {"part": [g for g, _ in groups]}, rows)


def _candidates(docs: DataFrame, classes: DataFrame, words: int, min_pct: int, size: int, scratch: Scratch) -> DataFrame:
    """Classes (s1) that the first vertical fragment rules out."""
    every = max(1, 40 // (100 - min_pct)) if min_pct < 100 else 40
    parts = max(1, size // (6 * every * GRAMS_A_PART))
    homes = max(1, size // (64 << 20))

    def cut(batches):
        held, n, texts = [], 0, 0
        for b in batches:
            for part, flat, offsets in text_slices([b], "text"):
                owner, grams = ngram_sets(flat, offsets, words)
                sizes, s1, _ = _signature(owner, grams, part.num_rows)
                # one of equal sets is enough: they are the same class
                _, once = np.unique(s1, return_index=True)
                pick = np.isin(owner, once) & (grams % np.uint64(every) == 0)
                if not pick.any():
                    continue
                held.append({"ids": s1, "sizes": sizes, "at": owner[pick] + texts, "key": grams[pick]})
                texts += part.num_rows
                n += int(pick.sum())
                if n >= FLUSH:
                    yield _send(held, parts)
                    held, n, texts = [], 0, 0
        if n:
            yield _send(held, parts)

    def lonely(key, table):
        """Counts, per class, n-grams that no other class has."""
        x = unpack(table, _GRAM)
        order = np.argsort(x["key"], kind="stable")
        k, who = x["key"][order], x["ids"][x["at"]][order]
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        alone = np.minimum.reduceat(who, first) == np.maximum.reduceat(who, first)
        mine = x["at"][order[first[alone]]]
        ids, at, count = np.unique(x["ids"][mine], return_index=True, return_counts=True)
        y = {"ids": ids, "sizes": x["sizes"][mine[at]], "at": np.arange(len(ids)), "count": count}
        groups = grouped(ids.astype(np.uint64) % np.uint64(homes))
        return pa.Table.from_batches([rows_of(_COUNT, {"home": [g for g, _ in groups]},
                                              [share(y, pick, _COUNT) for _, pick in groups])])

    def verdict(key, table):
        x = unpack(table, _COUNT)
        ids, at, back = np.unique(x["ids"], return_index=True, return_inverse=True)
        lone = np.bincount(back, weights=x["count"])
        return pa.table({"s1": pa.array(ids[lone > allowed(x["sizes"][at].astype(np.int64), min_pct)], pa.int64())})

    packed = map_arrow(docs.select("text"), cut, schema(_GRAM, "part int"))
    counted = packed.groupBy("part").applyInArrow(per_group(lonely), schema(_COUNT, "home int"))
    out = counted.groupBy("home").applyInArrow(per_group(verdict), "s1 long")
    return classes.join(out, "s1", "left_anti")


def _meetings(sets: DataFrame, min_pct: int, grams: int) -> DataFrame:
    """``(hub, cls, n)``: where each class meets those it may be linked with."""
    parts = homes = max(1, grams // GRAMS_A_PART)

    def cut(batches):
        held, n, texts = [], 0, 0
        for b in batches:
            for cls, size, keys in zip(*(b.column(i) for i in range(3)), strict=True):
                k = np.frombuffer(keys.as_buffer(), np.uint64)
                held.append({"ids": np.array([cls.as_py()]), "sizes": np.array([size.as_py()]),
                             "at": np.full(len(k), texts), "key": k})
                texts += 1
                n += len(k)
                if n >= FLUSH:
                    yield _send(held, parts)
                    held, n, texts = [], 0, 0
        if n:
            yield _send(held, parts)

    def count(key, table):
        """Tells each class which of its n-grams others hold, how many, and the hub."""
        x = unpack(table, _GRAM)
        order = np.argsort(x["key"], kind="stable")
        k = x["key"][order]
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        held = np.diff(np.r_[first, len(k)])
        hub = np.minimum.reduceat(x["ids"][x["at"]][order], first)
        run = np.repeat(np.arange(len(first)), held)
        keep = held[run] > 1
        order, run = order[keep], run[keep]
        y = {"ids": x["ids"], "sizes": x["sizes"], "at": x["at"][order], "key": x["key"][order],
             "held": held[run], "hub": hub[run]}
        groups = grouped(x["ids"][y["at"]] % homes)
        return pa.Table.from_batches([rows_of(_SEEN, {"home": [g for g, _ in groups]},
                                              [share(y, pick, _SEEN) for _, pick in groups])])

    def meet(key, table):
        x = unpack(table, _SEEN)
        who = x["ids"][x["at"]]
        order = np.lexsort((x["key"], x["held"], who))
        who = who[order]
        first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        shared = np.diff(np.r_[first, len(who)])
        size = x["sizes"][x["at"]][order][first].astype(np.int64)
        # of its rarest n-grams, those that it alone has come first and meet nobody
        front = allowed(size, min_pct) + 1 - (size - shared)
        place = np.arange(len(who)) - np.repeat(first, shared)
        near = place < np.repeat(front, shared)
        pairs = np.stack([x["hub"][order][near], who[near], np.repeat(size, shared)[near]], 1)
        pairs = np.unique(pairs, axis=0) if len(pairs) else pairs.reshape(0, 3)
        return pa.table({"hub": pairs[:, 0], "cls": pairs[:, 1], "n": pairs[:, 2]},
                        schema=pa.schema([(c, pa.int64()) for c in ("hub", "cls", "n")]))

    packed = map_arrow(sets.select("cls", "n", "grams"), cut, schema(_GRAM, "part int"))
    seen = packed.groupBy("part").applyInArrow(per_group(count), schema(_SEEN, "home int"))
    return seen.groupBy("home").applyInArrow(per_group(meet), "hub long, cls long, n long").distinct()


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set in ``a`` with every set in ``b``,
    counted per vertical fragment of their common order and summed.  Where both
    are the same list, a set's count with itself is left incomplete."""
    out = np.zeros((len(a), len(b)), np.float32)
    both = a if a is b else [*a, *b]
    key = np.concatenate(both)
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    order = np.argsort(key, kind="stable")
    key, owner = key[order], owner[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    held = np.diff(np.r_[first, len(key)])
    rank = np.lexsort((key[first], held))                      # rarest first
    rank = rank[held[rank] > 1]
    if not len(rank):
        return out
    # fragments hold as many n-grams as fit into a dense table of classes by n-grams
    width = max(1, CELLS // len(both))
    for f in range(0, len(rank), width):
        grams = rank[f:f + width]
        n = held[grams]
        rows = owner[np.repeat(first[grams] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        col = np.repeat(np.arange(len(grams)), n)
        if (n.astype(np.int64) ** 2).sum() * 60 < len(a) * len(b) * len(grams):
            _add_pairs(out, rows, n, len(a), a is b)           # few holders each: pair by pair
            continue
        table = np.zeros((len(both), len(grams)), np.float32)
        table[rows, col] = 1
        out += table[:len(a)] @ (table if a is b else table[len(a):]).T
    return out


def _add_pairs(out: np.ndarray, rows: np.ndarray, held: np.ndarray, split: int, same: bool) -> None:
    ends = np.cumsum(held)
    at, step = 0, 0
    while at < len(held):
        to = max(at + 1, int(np.searchsorted(np.cumsum(held[at:].astype(np.int64) ** 2), CELLS, "right")) + at)
        n = held[at:to]
        own = rows[step:ends[to - 1]]
        left = np.repeat(own, np.repeat(n, n))
        begin = np.repeat(np.repeat(np.cumsum(n) - n, n), np.repeat(n, n))
        square = np.repeat(n, n)
        inner = np.arange(len(left)) - np.repeat(np.cumsum(square) - square, square)
        right = own[begin + inner]
        if not same:
            pick = (left < split) & (right >= split)
            left, right = left[pick], right[pick] - split
        np.add.at(out, (left, right), 1)
        at, step = to, ends[to - 1]


def _forest(linked: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links connect, at most one per class."""
    left, right = np.nonzero(linked)
    if not len(left):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    u, v = a[left], b[right]
    ids, code = np.unique(np.r_[u, v], return_inverse=True)
    u, v = code[:len(u)], code[len(u):]
    label = np.arange(len(ids))
    while True:
        low = label.copy()
        np.minimum.at(low, u, label[v])
        np.minimum.at(low, v, label[u])
        low = low[low]
        if (low == label).all():
            break
        label = low
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return ids[label[moved]], ids[moved]


_EDGES = "a long, b long"


def _linked(a: list[np.ndarray], b: list[np.ndarray], min_pct: int) -> np.ndarray:
    n_a, n_b = (np.array([len(s) for s in x], np.int64) for x in (a, b))
    both = overlaps(a, b).astype(np.int64)
    union = n_a[:, None] + n_b[None, :] - both
    return (both > 0) & (100 * both >= min_pct * union)


def _compare(work: DataFrame, keys: list[str], min_pct: int) -> DataFrame:
    """``work``: ``keys``, side (0, 1), cls, grams.  A spanning forest of the links between
    the two sides of each group, or among side 0 where it stands alone."""
    def tile(key, table):
        cls, side = table.column("cls").to_numpy(), table.column("side").to_numpy()
        grams = [np.frombuffer(g.as_buffer(), np.uint64) for g in table.column("grams")]
        rows, cols = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        a = [grams[r] for r in rows]
        if not len(cols):
            linked, cols = _linked(a, a, min_pct), rows
            linked &= rows[:, None] < cols[None, :]
        elif len(rows):
            linked = _linked(a, [grams[c] for c in cols], min_pct)
            linked &= cls[rows][:, None] != cls[cols][None, :]
        else:
            linked = np.zeros((0, len(cols)), bool)
        u, v = _forest(linked, cls[rows], cls[cols])
        return pa.table({"a": pa.array(np.minimum(u, v), pa.int64()), "b": pa.array(np.maximum(u, v), pa.int64())})
    return work.groupBy(*keys).applyInArrow(per_group(tile), _EDGES)


def _blocks(k: str, g: str):
    """Blocks that hold ``k`` classes with ``g`` n-grams together."""
    return F.greatest(F.ceil(F.col(k) / BLOCK_CLASSES), F.ceil(F.col(g) / BLOCK_GRAMS))


def _links(sets: DataFrame, meetings: DataFrame, min_pct: int, scratch: Scratch) -> DataFrame:
    """``(a, b)``, a < b: edges that connect what the links at each hub connect.

    A hub of up to ``DIRECT`` blocks is compared block by block.  Of a larger one every
    member is first compared with a few representatives.  Members that are connected by then need no more
    comparison with each other; blocks are formed of connected members, and only blocks
    that hold different components, or members that are still few together, are
    compared pair by pair.  So a large group of near copies is sent about once, and
    no link between components is missed."""
    hubs = (meetings.groupBy("hub").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("g")).where("k > 1")
            .select(F.col("hub").alias("h"), _blocks("k", "g").alias("blocks")))
    placed = scratch.save(meetings.join(hubs, F.col("hub") == F.col("h")).select(
        "hub", F.col("cls").alias("c"), "n", "blocks", F.pmod(F.xxhash64("cls"), F.col("blocks")).alias("block")), "members")
    zero = F.lit(0).alias("side")
    cold = placed.where(F.col("blocks") <= DIRECT).select(
        "hub", "c", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cold = cold.join(sets, F.col("c") == F.col("cls")).select(
        "hub", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "cls", "grams")
    edges = _compare(cold, ["hub", "i", "j"], min_pct)
    hot = placed.where(F.col("blocks") > DIRECT)
    if hot.isEmpty():
        return edges

    first = F.row_number().over(Window.partitionBy("hub").orderBy(F.xxhash64("c", F.lit(3)), "c"))
    some = hot.withColumn("rn", first).where(F.col("rn") <= REPRESENTATIVES)
    some = some.select("hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "c", zero)
    met = hot.select("hub", "block", "c", F.lit(1).alias("side")).unionByName(some)
    met = met.join(sets, F.col("c") == F.col("cls")).select("hub", "block", "side", "cls", "grams")
    edges = scratch.save(edges.unionByName(_compare(met, ["hub", "block"], min_pct)), "links")

    roots = components(edges, scratch)
    mine = scratch.save(hot.join(roots, F.col("c") == F.col("node"), "left").select(
        "hub", "c", "n", F.coalesce("root", "c").alias("root")), "rooted")
    # a pool is a component with many members at the hub; all others lie in pool -1
    many = mine.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > BLOCK_CLASSES // 2)
    many = many.select(F.col("hub").alias("h"), F.col("root").alias("pool"))
    pooled = mine.join(many, (F.col("hub") == F.col("h")) & (F.col("root") == F.col("pool")), "left").select(
        "hub", "c", "n", F.coalesce("pool", F.lit(-1)).alias("pool"))
    sized = pooled.groupBy("hub", "pool").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("g")).select(
        "hub", "pool", _blocks("k", "g").alias("of"))
    block = F.struct("pool", F.pmod(F.xxhash64("c", F.lit(5)), F.col("of")).alias("no")).alias("block")
    dealt = scratch.save(pooled.join(sized, ["hub", "pool"]).select("hub", "c", block), "pools")
    known = sized.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("of") - 1)).alias("no"), "pool").select(
        "hub", F.struct("pool", "no").alias("block"))
    left, right = known.select(F.col("hub").alias("h"), F.col("block").alias("i")), known.select("hub", F.col("block").alias("j"))
    # block by block, a line each
    tiles = left.join(right, F.col("h") == F.col("hub")).where(
        (F.col("i") <= F.col("j")) & ((F.col("i.pool") != F.col("j.pool")) | (F.col("i.pool") == -1))).select("h", "i", "j")
    sides = tiles.select("h", "i", "j", F.inline(F.filter(F.array(
        F.struct(F.col("i").alias("own"), F.lit(0).alias("side")),
        F.when(F.col("i") != F.col("j"), F.struct(F.col("j").alias("own"), F.lit(1).alias("side")))), lambda x: x.isNotNull())))
    work = (sides.join(dealt, (F.col("h") == F.col("hub")) & (F.col("own") == F.col("block")))
            .join(sets, F.col("c") == F.col("cls")).select("h", "i", "j", "side", "cls", "grams"))
    return edges.unionByName(_compare(work, ["h", "i", "j"], min_pct))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (a, b): the root is the smallest
    node of its component.  Large-star and small-star rounds until nothing moves."""
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    now = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                       .distinct(), "edges")
    seen = mark(now)
    while True:
        # large star: larger neighbours go to the smallest neighbour
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).withColumnRenamed("a", "x")
        large = both.join(low, F.col("a") == F.col("x")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small star: smaller neighbours and the node itself go to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "x")
        small = large.join(low, F.col("a") == F.col("x"))
        small = (small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(small.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        new = scratch.save(small, "edges")
        scratch.drop(now)
        now, before, seen = new, seen, mark(new)
        if seen == before:
            break
    return (now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))


def link_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, min_pct: int = 80,
                scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, mark`` (hash of the text, tells apart
    rows that share an id), ``n_shingles``, ``component_id`` and ``component`` (a
    key of the group, also where ids are null).

    Two texts link when 100 * intersection >= ``min_pct`` * union of their sets of
    ``words``-word shingles (A-Z in lower case); ``component_id`` is the smallest id
    reachable by links.  Fewer words are one shingle; no words (or null text) link
    with nothing.  Rows that share an id are separate documents of that name; a
    null id is never the smallest unless its group has no other.  Sets are compared
    by 64-bit hashes of shingles.
    """
    own_columns(docs, id_col, text_col)
    scratch = scratch or Scratch(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text")).withColumn(
        "mark", F.xxhash64("text"))
    size = total_bytes(base, "text")

    def measure(batches):
        for b in batches:
            for part, flat, offsets in text_slices([b], "text"):
                n, s1, s2 = _signature(*ngram_sets(flat, offsets, words), part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n), pa.array(s1), pa.array(s2)],
                                                 ["id", "mark", "n", "s1", "s2"])

    measured = scratch.save(map_arrow(base.select("id", "mark", "text"), measure,
                                      "id long, mark long, n long, s1 long, s2 long"), "signatures")
    # one row stands for its class: the smallest id that is not null, then the smallest mark
    order = F.struct(F.col("id").isNull().alias("u"), F.col("id").alias("i"), F.col("mark").alias("m"))
    classes = (measured.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("id").alias("low"), F.min(order).alias("one"))
               .withColumn("cls", F.monotonically_increasing_id()))
    classes = scratch.save(classes, "classes")

    left = _candidates(base, classes, words, min_pct, size, scratch)
    # one text of each class that is left: copies are not read again, however many there are
    chosen = left.select("cls", F.col("one.i").alias("i"), F.col("one.m").alias("m"))
    some = base.join(chosen, F.col("id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m"))).select("cls", "text")

    def sets_of(batches):
        for b in batches:
            for part, flat, offsets in text_slices([b], "text"):
                owner, grams = ngram_sets(flat, offsets, words)
                n = np.bincount(owner, minlength=part.num_rows)
                at = np.r_[0, np.cumsum(n)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(
                    [grams[at[i]:at[i + 1]].tobytes() for i in range(part.num_rows)], pa.binary())], ["cls", "n", "grams"])

    # equal rows give equal sets: any one of them will do
    sets = map_arrow(some, sets_of, "cls long, n long, grams binary").dropDuplicates(["cls"])
    sets = scratch.save(sets, "sets")
    grams = int(sets.agg(F.sum("n")).first()[0] or 0)
    meetings = scratch.save(_meetings(sets, min_pct, grams), "meetings")
    roots = components(_links(sets, meetings, min_pct, scratch), scratch)
    scratch.drop(sets, meetings)
    named = classes.join(roots, F.col("cls") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cls"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id")).withColumnRenamed("root", "r")
    named = named.join(lowest, F.col("root") == F.col("r")).select(
        F.col("n").alias("n_"), F.col("s1").alias("s1_"), F.col("s2").alias("s2_"), "component_id", "root")
    out = measured.join(named, (F.col("n") == F.col("n_")) & (F.col("s1") == F.col("s1_")) & (F.col("s2") == F.col("s2_")),
                        "left")
    return out.select(F.col("id").alias("doc_id"), "mark", F.col("n").alias("n_shingles"),
                      F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.col("root").alias("component"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, all columns, without all but one of each linked group:
    the one with the smallest id (nulls last), then the smallest text hash.  Equal
    rows (same id and text) are one document and one of them stays."""
    groups = link_groups(docs, id_col, text_col, **how)
    order = F.struct(F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("i"), F.col("mark").alias("m"))
    best = groups.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("b"))
    stay = best.select(F.col("b.i").alias("__i"), F.col("b.m").alias("__m")).unionByName(
        groups.where("component IS NULL").select(F.col("doc_id").alias("__i"), F.col("mark").alias("__m")).distinct())
    text = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    marked = docs.withColumn("__t", text)
    kept = marked.join(stay, F.col(f"`{id_col}`").eqNullSafe(F.col("__i")) & (F.col("__t") == F.col("__m")), "left_semi")
    with_words = F.length(F.btrim(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))) > 0
    one = kept.where(with_words).dropDuplicates([id_col, "__t"])
    return one.unionByName(kept.where(~with_words)).select(*[F.col(f"`{c}`") for c in docs.columns])
