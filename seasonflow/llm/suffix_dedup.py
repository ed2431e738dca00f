"""Removal of long byte strings that an earlier document already holds.

Suffixes are range-partitioned by their leading bytes with sampled splitters,
sorted inside their partition by multikey sort, and equal neighbours compared.
Equal strings never lie in two partitions, so no match is cut at a boundary.

Sorting the suffix of every byte would move some fifty times the text.  Three
exact reductions come first:

1. Every window of ``length`` bytes takes the suffix that starts at its smallest
   k-gram (by hash, leftmost); equal windows take equal suffixes at equal places.
   Neighbouring windows mostly share one, so about one suffix in sixteen bytes is
   left.  A stretch is the bytes of all windows of one suffix.
2. Suffixes whose leading k-gram occurs in one document only cannot match.
3. Equal stretches need no look inside: all but the first document's go whole.
   Only where stretches differ after the same k-gram are their windows written
   out, sorted by their full bytes and compared.

Shape at scale: suffixes travel as packed arrays, about 20 bytes each, to
partitions of bounded size.  A k-gram that fills a range of its own is spread by its
stretches, and one whose windows to compare are many by these windows, each with the
hash of its bytes.  Of equal stretches or windows of such a k-gram a task sends only
those of its smallest id to be compared; the others are known to go.  So a passage in
a third of all documents fills no task.  Texts move by a hash of their id, whole
partitions of bounded size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (_BYTES, Scratch, flat_text, map_arrow, mix64, own_columns, per_cogroup, per_group, powers,
                     text_slices)
from .packed import grouped, rows_of, schema, share, spread, unpack

SUFFIXES_A_PART = 500_000       # of a range partition, on average
TEXT_A_PART = 8 << 20           # bytes of text in a partition by id
FLUSH = 300_000                 # suffixes a task packs at once
WINDOWS_A_KEY = 100_000         # to compare after one k-gram in one task


def anchored_suffixes(flat: np.ndarray, offsets: np.ndarray, length: int):
    """The suffixes of the windows of all texts in ``flat``: ``(text index, key,
    stretch hash, stretch start in its text, windows)``.  ``key`` orders by the
    two leading bytes and then by the hash of the leading k-gram."""
    k = max(2, 2 * length // 5)
    w, n = length - k + 1, len(flat)
    sizes = np.diff(offsets)
    none = np.zeros(0, np.int64)
    if n < length or not (sizes >= length).any():
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[flat] * up[:n], out=total[1:])
    gram = mix64((total[k:] - total[:-k]) * down[:n - k + 1])
    bits = np.uint64(n.bit_length())
    low = (gram >> bits << bits) | np.arange(n - k + 1, dtype=np.uint64)
    span = 1
    while 2 * span <= w:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < w:
        low = np.minimum(low[:len(low) - (w - span)], low[w - span:])
    inside = np.zeros(n + 1, np.int8)
    long = sizes >= length
    inside[offsets[:-1][long]] += 1
    np.add.at(inside, offsets[1:][long] - length + 1, -1)
    windows = np.flatnonzero(np.cumsum(inside)[:len(low)])
    anchor = (low[windows] & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    start, anchor = windows[first], anchor[first]
    count = np.diff(np.r_[first, len(windows)])
    stretch = mix64((total[start + count - 1 + length] - total[start]) * down[start]
                    + count.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    lead = (flat[anchor].astype(np.uint64) << np.uint64(8)) | flat[anchor + 1]
    key = (lead << np.uint64(48)) | (gram[anchor] >> np.uint64(16))
    doc = np.searchsorted(offsets, start, "right") - 1
    return doc, key, stretch, start - offsets[doc], count


def multikey_sort(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of equally long byte rows (n x m, uint8), and for each place in that
    order whether it differs from the one before.  Rows are ordered by eight bytes
    at a time; later bytes are looked at only among rows that are still equal."""
    n, m = rows.shape
    words = np.zeros((n, -(-m // 8) * 8), np.uint8)
    words[:, :m] = rows
    words = words.view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0], kind="stable")
    new = np.r_[True, words[order[1:], 0] != words[order[:-1], 0]] if n else np.zeros(0, bool)
    for j in range(1, words.shape[1]):
        group = np.cumsum(new)
        tied = np.flatnonzero(~new | np.r_[~new[1:], False])
        if not len(tied):
            break
        part, col = order[tied], words[order[tied], j]
        by = np.lexsort((col, group[tied]))
        order[tied] = part[by]
        new[tied] |= np.r_[True, col[by][1:] != col[by][:-1]]
    return order, new


def window_hashes(flat: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes at each place."""
    up, out = powers(length)[0], np.empty(len(begin), np.uint64)
    for a in range(0, len(begin), 20_000):
        rows = flat[begin[a:a + 20_000, None] + np.arange(length)]
        out[a:a + 20_000] = mix64((_BYTES[rows] * up).sum(axis=1))
    return out


def held_earlier(text: np.ndarray, begin: np.ndarray, key: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """The windows, by their places in ``text``, that a smaller id among them has too.
    Equal windows have equal keys."""
    hits = [np.zeros(0, np.int64)]
    # the index of a group is 400 bytes a window
    for _, pick in grouped(key % np.uint64(1 + len(begin) // 100_000)):
        order, new = multikey_sort(text[begin[pick][:, None] + np.arange(length)])
        d = doc[pick][order]
        first = np.minimum.reduceat(d, np.flatnonzero(new))[np.cumsum(new) - 1]
        hits.append(pick[order[d > first]])
    return np.concatenate(hits)


def not_first(key: np.ndarray, stretch: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a smaller id among them has the same key and stretch."""
    out = np.zeros(len(key), bool)
    if len(key):
        order = np.lexsort((doc, stretch, key))
        new = np.r_[True, (key[order][1:] != key[order][:-1]) | (stretch[order][1:] != stretch[order][:-1])]
        out[order] = doc[order] > doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    return out


# arrays of a row of packed suffixes, requests or ranges; ids and marks name texts, at points into them
_SUFFIX = {"ids": "i8", "marks": "i8", "homes": "i4", "at": "u4", "key": "u8", "stretch": "u8", "start": "u4",
           "count": "u2"}
_RANGE = {"ids": "i8", "marks": "i8", "at": "u4", "start": "u4", "count": "u2", "key": "u8"}
_STRING = {"ids": "i8", "marks": "i8", "homes": "i4", "at": "u4", "start": "u4", "count": "u2", "key": "u8",
           "text": "u1"}


def repeated_ranges(docs: DataFrame, length: int, parts: int, homes: int, scratch: Scratch) -> list[DataFrame]:
    """Packed byte ranges to remove, by the home of their text.  ``docs``: id (no
    nulls), mark, home, text."""
    texts = docs.select("id", "mark", "home", "text")

    def keys(batches):
        for b in batches:
            for _, flat, offsets in text_slices([b], "text"):
                key = anchored_suffixes(flat, offsets, length)[1]
                yield pa.RecordBatch.from_arrays([pa.array((key ^ np.uint64(1 << 63)).view(np.int64))], ["key"])

    if parts > 1:
        fraction = min(1.0, max(2000, 20 * parts) / max(1, docs.count()))
        sample = map_arrow(texts.sample(fraction, 7), keys, "key long")
        found = sample.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)], 100 * parts)).first()[0]
        splitters, times = np.unique(np.array(found or [], np.int64), return_counts=True)
        hot = splitters[times > 1].astype(float)       # a range or more for one key
        splitters = splitters.view(np.uint64) ^ np.uint64(1 << 63)
    else:
        splitters, hot = np.zeros(0, np.uint64), np.zeros(0)
    splitters = np.sort(splitters)
    ranges = np.uint64(len(splitters) + 1)

    def is_hot(key):
        # percentiles are given as the nearest doubles
        return np.isin((key ^ np.uint64(1 << 63)).view(np.int64).astype(float), hot)

    def cut(batches):
        held, size, n_texts = [], 0, 0

        def flush():
            x = {n: np.concatenate([h[n] for h in held]) for n in _SUFFIX}
            part, done = np.searchsorted(splitters, x["key"], "right"), np.zeros(len(x["key"]), bool)
            busy = np.flatnonzero(is_hot(x["key"]))
            if len(busy):
                done[busy] = not_first(x["key"][busy], x["stretch"][busy], x["ids"][x["at"][busy]])
                part[busy] = x["stretch"][busy] % ranges
                part[done] = x["homes"][x["at"][done]] % int(ranges)
            groups = grouped(2 * part + done)
            # in key order inside each group, so that the sort there merges runs
            rows = [share(x, pick[np.argsort(x["key"][pick], kind="stable")], _SUFFIX) for _, pick in groups]
            return rows_of(_SUFFIX, {"part": [g // 2 for g, _ in groups], "done": [g % 2 for g, _ in groups]}, rows)

        for b in batches:
            for part, flat, offsets in text_slices([b], "text"):
                doc, key, stretch, start, count = anchored_suffixes(flat, offsets, length)
                if not len(doc):
                    continue
                held.append({"ids": part.column(0).to_numpy(), "marks": part.column(1).to_numpy(),
                             "homes": part.column(2).to_numpy(), "at": doc + n_texts, "key": key, "stretch": stretch,
                             "start": start, "count": count})
                n_texts += part.num_rows
                size += len(doc)
                if size >= FLUSH:
                    yield flush()
                    held, size, n_texts = [], 0, 0
        if size:
            yield flush()

    def match(key, table):
        out = {"home": [], "kind": []}, []

        def add(kind, x, pick):
            for g, own in grouped(x["homes"][x["at"][pick]]):
                out[0]["home"].append(g)
                out[0]["kind"].append(kind)
                out[1].append(share(x, pick[own], _RANGE))

        x = unpack(table.filter(pc.equal(table["done"], 1)), _SUFFIX)
        add(0, x, np.arange(len(x["key"])))
        x = unpack(table.filter(pc.equal(table["done"], 0)), _SUFFIX)
        order = np.argsort(x["key"], kind="stable")
        k = x["key"][order]
        again = np.r_[False, k[1:] == k[:-1]]
        # k-grams that occur once are done, but hot ones have entries elsewhere
        order = order[again | np.r_[again[1:], False] | is_hot(k)] if len(k) else order
        doc = x["ids"][x["at"]]
        order = order[np.lexsort((doc[order], x["stretch"][order], x["key"][order]))]
        k, s, d = x["key"][order], x["stretch"][order], doc[order]
        new_key = np.r_[True, k[1:] != k[:-1]][:len(k)]
        new_stretch = new_key | np.r_[True, s[1:] != s[:-1]][:len(k)]
        if len(k):
            by_key, by_stretch = np.cumsum(new_key) - 1, np.cumsum(new_stretch) - 1
            first = d[np.flatnonzero(new_stretch)][by_stretch]     # the first document with the stretch
            at_key = np.flatnonzero(new_key)
            several = (np.add.reduceat(new_stretch.astype(np.int64), at_key) > 1)[by_key]
            lo, hi = np.minimum.reduceat(d, at_key)[by_key], np.maximum.reduceat(d, at_key)[by_key]
            spread_out = is_hot(k)
            gone = d > first
            ask = ~gone & (several & (lo != hi) | spread_out)
            windows = np.add.reduceat(x["count"][order].astype(np.int64) * ask, at_key)[by_key]
            many = spread_out | (windows > WINDOWS_A_KEY)
            for kind, chosen in ((0, gone), (1, ask & ~many), (2, ask & many)):
                add(kind, x, order[chosen])
        return pa.Table.from_batches([rows_of(_RANGE, *out)])

    packed = map_arrow(texts, cut, schema(_SUFFIX, "part int, done int"))
    kinds = schema(_RANGE, "home int, kind int")
    found = scratch.save(packed.groupBy("part").applyInArrow(per_group(match), kinds), "ranges")
    whole, asked = found.where("kind = 0").drop("kind"), found.where("kind > 0")

    def write_out(key, left, right):
        """The bytes of the stretches that are asked for; of a k-gram with many
        windows, those of each window that no smaller id here has."""
        out = {"part": [], "done": []}, []

        def add(part, done, x, pick, text):
            row = share(x, pick, [n for n in _STRING if n != "text"])
            out[0]["part"].append(part)
            out[0]["done"].append(done)
            out[1].append(row | {"text": text})

        if left.num_rows and right.num_rows:
            flat, offsets = flat_text(left.column("text").combine_chunks())
            for kind in (1, 2):
                x = unpack(right.filter(pc.equal(right["kind"], kind)), _RANGE)
                if not len(x["at"]):
                    continue
                which = _find_rows(left, x)[x["at"]]
                rows = np.flatnonzero(which >= 0)
                x["homes"] = np.full(len(x["ids"]), key[0].as_py())
                begin = offsets[which] + x["start"]
                if kind == 1:
                    size = x["count"].astype(np.int64) + (length - 1)
                    for g, pick in grouped(np.searchsorted(splitters, x["key"][rows], "right")):
                        pick = rows[pick]
                        add(g, 0, x, pick, flat[spread(begin[pick], size[pick])])
                    continue
                count = x["count"][rows].astype(np.int64)
                entry, shift = np.repeat(rows, count), spread(np.zeros(len(rows), np.int64), count)
                begin = begin[entry] + shift
                y = {n: x[n] for n in ("ids", "marks", "homes")} | {
                    "at": x["at"][entry], "start": x["start"][entry] + shift, "count": np.ones(len(entry), np.int64),
                    "key": window_hashes(flat, begin, length)}
                later = held_earlier(flat, begin, y["key"], y["ids"][y["at"]], length)
                if len(later):
                    add(key[0].as_py() % int(ranges), 1, y, later, np.zeros(0, np.uint8))
                stay = np.setdiff1d(np.arange(len(entry)), later)
                for g, pick in grouped((y["key"][stay] % ranges).astype(np.int64)):
                    pick = stay[pick]
                    add(g, 0, y, pick, flat[spread(begin[pick], np.full(len(pick), length))])
        return pa.Table.from_batches([rows_of(_STRING, *out)])

    strings = (texts.groupBy("home").cogroup(asked.groupBy("home"))
               .applyInArrow(per_cogroup(write_out), schema(_STRING, "part int, done int")))

    def compare(key, table):
        """Sorts the windows of stretches by all their bytes and keeps those that
        an earlier document has."""
        out = {"home": []}, []

        def add(x, pick):
            for g, own in grouped(x["homes"][x["at"][pick]]):
                out[0]["home"].append(g)
                out[1].append(share(x, pick[own], _RANGE))

        x = unpack(table.filter(pc.equal(table["done"], 1)), _STRING)
        add(x, np.arange(len(x["at"])))
        x = unpack(table.filter(pc.equal(table["done"], 0)), _STRING)
        size = x["count"].astype(np.int64) + (length - 1)
        base = np.cumsum(size) - size
        entry = np.repeat(np.arange(len(size)), x["count"])
        shift = spread(np.zeros(len(size), np.int64), x["count"].astype(np.int64))
        if len(entry):
            doc = x["ids"][x["at"]]
            hit = held_earlier(x["text"], base[entry] + shift, x["key"][entry], doc[entry], length)
            y = {n: x[n] for n in ("ids", "marks", "homes")} | {
                "at": x["at"][entry], "start": x["start"][entry] + shift, "count": np.ones(len(entry), np.int64),
                "key": np.zeros(len(entry), np.uint64)}
            add(y, hit)
        return pa.Table.from_batches([rows_of(_RANGE, *out)])

    inner = scratch.save(strings.groupBy("part").applyInArrow(per_group(compare), schema(_RANGE, "home int")), "inner")
    return [whole, inner]


def _find_rows(left, x) -> np.ndarray:
    """The row of ``left`` that has each text's id and mark, or -1."""
    rows = {(i, m): r for r, (i, m) in enumerate(zip(left.column("id").to_pylist(), left.column("mark").to_pylist(),
                                                     strict=True))}
    return np.array([rows.get((int(i), int(m)), -1) for i, m in zip(x["ids"], x["marks"], strict=True)], np.int64)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50,
                   with_text: bool = True, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256`` and, with ``with_text``, ``spans`` (removed byte ranges, ends
    exclusive) and ``kept`` (the remaining bytes).

    A byte goes when a string of ``length`` bytes over it also starts in a
    document with a smaller id.  Matches do not cross documents; all are judged on
    the input.  Null text is empty.  Rows that share an id do not remove from each
    other.  Rows without an id come after all others and share that place.
    """
    own_columns(docs, id_col, text_col)
    scratch = scratch or Scratch(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    size = base.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    homes = max(1, -(-size // TEXT_A_PART))
    parts = max(1, size // (16 * SUFFIXES_A_PART))
    base = base.withColumn("id", F.coalesce("doc_id", F.lit((1 << 63) - 1))).withColumn("mark", F.xxhash64("text"))
    base = base.withColumn("home", F.pmod(F.xxhash64("id", "mark"), F.lit(homes)).cast("int"))
    ranges = repeated_ranges(base, length, parts, homes, scratch)
    gone = ranges[0].unionByName(ranges[1])

    def finish(key, left, right):
        flat, offsets = flat_text(left.column("text").combine_chunks())
        change = np.zeros(len(flat) + 1, np.int32)
        same = {}
        for r, im in enumerate(zip(left.column("id").to_pylist(), left.column("mark").to_pylist(), strict=True)):
            same.setdefault(im, []).append(r)
        if right.num_rows:
            x = unpack(right, _RANGE)
            where = _find_rows(left, x)
            ok = where[x["at"]] >= 0
            begin = offsets[where[x["at"]][ok]] + x["start"][ok]
            np.add.at(change, begin, 1)
            np.add.at(change, begin + x["count"][ok].astype(np.int64) + (length - 1), -1)
        covered = np.cumsum(change[:-1]) > 0
        # an equal row of the same id has the same ranges
        for rows in same.values():
            for r in rows[:-1]:
                a, b = offsets[rows[-1]], offsets[rows[-1] + 1]
                covered[offsets[r]:offsets[r + 1]] = covered[a:b]
        sums = np.r_[0, np.cumsum(covered)]
        removed = sums[offsets[1:]] - sums[offsets[:-1]]
        out = {n: [] for n in ("n_spans", "kept_sha256", "spans", "kept")}
        for r in range(left.num_rows):
            a, b = offsets[r], offsets[r + 1]
            data, spans = flat[a:b], []
            if removed[r]:
                edge = np.flatnonzero(np.diff(np.r_[False, covered[a:b], False].astype(np.int8)))
                spans = edge.reshape(-1, 2)
                data = data[~covered[a:b]]
            out["n_spans"].append(len(spans))
            raw = data.tobytes()
            out["kept_sha256"].append(hashlib.sha256(raw).hexdigest())
            if with_text:
                out["spans"].append([{"start": int(s), "end": int(e)} for s, e in spans])
                out["kept"].append(raw)
        cols = {"doc_id": left.column("doc_id"), "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(removed),
                "n_spans": pa.array(out["n_spans"], pa.int64()), "kept_sha256": pa.array(out["kept_sha256"], pa.string())}
        if with_text:
            cols["spans"] = pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            cols["kept"] = pa.array(out["kept"], pa.binary())
        return pa.table(cols)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (
        ", spans array<struct<start: long, end: long>>, kept binary" if with_text else "")
    return (base.select("doc_id", "id", "mark", "home", "text").groupBy("home")
            .cogroup(gone.groupBy("home")).applyInArrow(per_cogroup(finish), schema))
