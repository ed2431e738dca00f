"""Alignment of two tokenizers' tokens over whole texts.

A is a byte-level BPE file (tokenizers), B a sentencepiece model.  Their spans, A's
character offsets and B's proto spans, are coarse cuts; where a character is shared by
several tokens (bytes of a multibyte character, byte-fallback pieces) the cuts come from
the decoded bytes.  Offsets where tokens of both end cut a text into groups, and every
pair of an A and a B token of a group is a link.

Neither vocabulary joins characters across certain borders: A's pre-tokens end before a
space that a word follows and between a letter and any other sign, and no B piece
holds a space after another character, or a sign after a letter (both are checked when the
model is loaded; without them texts stay whole).  So a text is cut there, and each
worker keeps a bounded table of the parts it has met, with their ids and groups.

Shape at scale: texts are read once, in blocks.  A block leaves one narrow row per
document (its links as packed arrays) and its own distinct id pairs with their number
of documents, so a pair that is in a third of all texts moves once a block, not once a
text.  The pair counts are summed by shuffle, joined back to the blocks that asked, and
meet the block's rows in one task of bounded size.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, map_arrow, own_columns, per_cogroup, release
from .packed import spread
from .tokens import _BYTE_CHARS, public_path

BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
BLOCK_CHARS = 8 << 20        # text of a block
TABLE_ENTRIES = 500_000      # parts that a worker's table holds (about 500 bytes each)
TABLE_CHARS = 64             # longer parts are worked out each time
STEP = 1 << 18               # characters worked on at once; longer texts are taken in slices

_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_WORDS = r"(?<=[^ ])(?= \S)"
_SIGNS = rf"{_WORDS}|(?<=[{_LETTER}])(?=[!-@\[-`{{-~])|(?<=\S\n)(?=[{_LETTER}])"


class Aligner:
    """Both tokenizers; ``align`` gives a part's groups of ids."""

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        shown = {chr(b): b for b in range(256) if b not in _BYTE_CHARS} | {chr(c): b for b, c in _BYTE_CHARS.items()}
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.a_bytes = [bytes(shown[c] for c in t) if t and all(c in shown for c in t) else (t or "").encode()
                        for t in map(self.a.id_to_token, range(size))]
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.fallback = {i for i in range(len(names)) if self.b.is_byte(i)}
        self.b_bytes = [bytes([int(p[3:5], 16)]) if i in self.fallback else p.replace("▁", " ").encode()
                        for i, p in enumerate(names)]
        plain = [p for i, p in enumerate(names)
                 if i not in self.fallback and not self.b.is_control(i) and not self.b.is_unknown(i)]
        letter = re.compile(f"[{_LETTER}]")
        spaces = all(re.fullmatch("\u2581*|\u2581?[^\u2581]+", p) for p in plain)
        signs = not any("\n" in p or (letter.match(x) and not letter.match(y) and y.isascii())
                        for p in plain for x, y in zip(p, p[1:], strict=False))
        self.cut = re.compile(_SIGNS if signs else _WORDS) if spaces else None
        self.lead = len(self.b.encode("\n", return_type="proto").pieces)
        self.a_len, self.b_len = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.is_byte = np.array([i in self.fallback for i in range(len(names))])
        self.wide = len(names)                   # a link's key is A's id times this plus B's id
        self.a_text, self.b_text = [[str(i) for i in range(n)] for n in (size, len(names))]
        self.table: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.table.clear()
        self.text: list[bytes | None] = []       # ids of a part's groups, None where bytes don't match
        self.sizes = array("q")                  # A tokens, B tokens, groups, links of each part
        self.keys, self.times = array("Q", [0]), array("I", [0])    # distinct links, and how often each occurs
        self.ends_at = array("q", [1])           # where a part's links end
        self.met = np.zeros(0, np.uint8)         # batches that a part was met in, since it came in

    def parts(self, text: str) -> list[str]:
        """``text``, which begins with a space, in parts that both tokenizers keep apart."""
        return self.cut.split(text) if self.cut else [text]

    def pieces(self, part: str) -> list[tuple[int, int, int]]:
        """B's ``(id, begin, end)`` of a part, the places as its proto gives them.  B puts a
        space before each text: the part's own, or else one that a line end keeps
        apart from it."""
        if part[0] == " ":
            return [(p.id, p.begin + 1 if p.begin or p.end else 0, p.end + 1)
                    for p in self.b.encode(part[1:], return_type="proto").pieces]
        return [(p.id, p.begin - 1, p.end - 1)
                for p in self.b.encode("\n" + part, return_type="proto").pieces[self.lead:]]

    def ends(self, part: str, a_ids: list[int], offsets: list, pieces: list) -> tuple[list[int], list[int]]:
        """Byte ends of A's and B's tokens of a part: spans, refined by decoded bytes where
        several tokens share a character."""
        if part.isascii():
            return [e for _, e in offsets], [e for _, _, e in pieces]
        at = [0, *accumulate(len(c.encode()) for c in part)]
        a_ends, end = [], 0
        for i, (start, stop) in enumerate(offsets):
            shared = (i + 1 < len(offsets) and offsets[i + 1][0] < stop) or (i and offsets[i - 1][1] > start)
            end = end + len(self.a_bytes[a_ids[i]]) if shared else at[stop]
            a_ends.append(end)
        in_bytes = pieces[-1][2] == at[-1]       # else the spans count characters
        b_ends, end = [], 0
        for i, start, stop in pieces:
            end = end + len(self.b_bytes[i]) if i in self.fallback or start == stop else stop if in_bytes else at[stop]
            b_ends.append(end)
        return a_ends, b_ends

    def add(self, parts: list[str]) -> None:
        """Works parts out and appends them to the lists, in order."""
        # parts that a line end before and after keeps as they are go through together, ASCII or not
        plain, mixed, alone = [], [], []
        for k, p in enumerate(parts):
            if len(p) > TABLE_CHARS or p[-1].isspace() or (p[0].isspace() and (p[0] != " " or p[1].isspace())):
                alone.append(k)
            else:
                (plain if p.isascii() else mixed).append(k)
        text, sizes, links = [None] * len(parts), np.zeros((len(parts), 4), np.int64), [(np.zeros(0, np.int64),) * 3]
        for which in (plain, mixed):
            if not which:
                continue
            done = self._together([parts[k] for k in which])
            if done is None:
                alone += which
                continue
            which = np.array(which)
            for k, t in zip(which.tolist(), done[0], strict=True):
                text[k] = t
            sizes[which] = done[1]
            links.append((which[done[2]], *done[3:]))
        for k in alone:
            text[k], sizes[k], found = self._alone(parts[k])
            links.append((np.full(len(found), k), np.fromiter(found, np.int64, len(found)),
                          np.fromiter(found.values(), np.int64, len(found))))
        part, key, n = (np.concatenate(x) for x in zip(*links, strict=True))
        order = np.argsort(part, kind="stable")
        base = len(self.keys)
        self.text += text
        self.sizes.frombytes(sizes.tobytes())
        self.keys.frombytes(key[order].astype(np.uint64).tobytes())
        self.times.frombytes(n[order].astype(np.uint32).tobytes())
        self.ends_at.frombytes((base + np.cumsum(np.bincount(part, minlength=len(parts)))).tobytes())

    def _together(self, parts: list[str]):
        """Group texts, sizes and links ``(part, key, times)`` of many parts, encoded as one
        text with a line end, a token of its own in both, before each; None if a tokenizer
        doesn't give it back."""
        joined = "\n" + "\n".join(parts)
        raw = joined.encode()
        a, pieces = self.a.encode(joined, add_special_tokens=False), self.b.encode(joined, return_type="proto").pieces
        a_ids, spans = np.array(a.ids), np.array(a.offsets)
        b = np.array([(p.id, p.begin, p.end) for p in pieces[self.lead - 1:]])
        b_ids, begin, stop = b[:, 0], b[:, 1], b[:, 2]
        if b"".join([self.a_bytes[i] for i in a.ids]) != raw or b"".join([self.b_bytes[i] for i in b_ids.tolist()]) != raw:
            return None
        if len(raw) == len(joined):
            a_ends, b_ends = spans[:, 1], stop
        else:
            # spans are coarse where tokens share a character: there ends come from decoded bytes
            at = np.r_[0, np.cumsum([len(c.encode()) for c in joined])]
            shared = np.r_[spans[1:, 0] < spans[:-1, 1], False] | np.r_[False, spans[:-1, 1] > spans[1:, 0]]
            a_ends = np.where(shared, np.cumsum(self.a_len[a_ids]), at[spans[:, 1]])
            b_ends = stop if stop[-1] == len(raw) else at[stop]
            b_ends = np.where(self.is_byte[b_ids] | (begin == stop), np.cumsum(self.b_len[b_ids]), b_ends)
        cuts = np.intersect1d(a_ends, b_ends)
        i, j = np.searchsorted(a_ends, cuts) + 1, np.searchsorted(b_ends, cuts) + 1
        i0, j0 = np.r_[0, i[:-1]], np.r_[0, j[:-1]]
        starts = 1 + np.cumsum([0, *(len(p.encode()) + 1 for p in parts[:-1])])
        own = np.searchsorted(starts, cuts, "left") - 1      # the part that a group ends in ...
        # ... unless it is a line end, which stops where the next part starts
        line = np.zeros(len(cuts), bool)
        line[np.searchsorted(cuts, starts)] = True
        group = np.flatnonzero(~line)
        own, i0, i, j0, j = own[group], i0[group], i[group], j0[group], j[group]
        n_a, n_b = i - i0, j - j0
        n = n_a * n_b
        at, width = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n), np.repeat(n_b, n)
        key = a_ids[np.repeat(i0, n) + at // width] * self.wide + b_ids[np.repeat(j0, n) + at % width]
        part, key, times = _sum(np.repeat(own, n), key, np.ones(len(key), np.int64))
        count = lambda w: np.bincount(own, weights=w, minlength=len(parts)).astype(np.int64)
        sizes = np.stack([count(n_a), count(n_b), np.bincount(own, minlength=len(parts)), count(n)], axis=1)
        x, y = [self.a_text[t] for t in a.ids], [self.b_text[t] for t in b_ids.tolist()]
        told = [f"{x[p]}|{y[r]}" if q - p == 1 == s - r else f"{','.join(x[p:q])}|{','.join(y[r:s])}"
                for p, q, r, s in zip(i0.tolist(), i.tolist(), j0.tolist(), j.tolist(), strict=True)]
        cut = np.searchsorted(own, np.arange(len(parts) + 1)).tolist()
        return [";".join(told[u:v]).encode() for u, v in zip(cut, cut[1:], strict=False)], sizes, part, key, times

    def _alone(self, part: str) -> tuple[bytes | None, tuple[int, int, int, int], dict[int, int]]:
        """Group text, sizes and links of one part."""
        wide, a_text, b_text = self.wide, self.a_text, self.b_text
        a, pieces = self.a.encode(part, add_special_tokens=False), self.pieces(part)
        a_ids, b_ids, raw = a.ids, [p[0] for p in pieces], part.encode()
        if b"".join([self.a_bytes[i] for i in a_ids]) != raw or b"".join([self.b_bytes[i] for i in b_ids]) != raw:
            return None, (0, 0, 0, 0), {}
        a_ends, b_ends = self.ends(part, a_ids, a.offsets, pieces)
        groups, links, n_links, i, j = [], {}, 0, 0, 0
        while i < len(a_ids):
            i0, j0 = i, j
            while a_ends[i] != b_ends[j]:
                if a_ends[i] < b_ends[j]:
                    i += 1
                else:
                    j += 1
            i, j = i + 1, j + 1
            xs, ys = a_ids[i0:i], b_ids[j0:j]
            n_links += len(xs) * len(ys)
            groups.append(f"{','.join([a_text[x] for x in xs])}|{','.join([b_text[y] for y in ys])}")
            for x, n in Counter(xs).items():         # a long group's distinct pairs once
                for y, m in Counter(ys).items():
                    links[x * wide + y] = links.get(x * wide + y, 0) + n * m
        return ";".join(groups).encode(), (len(a_ids), len(b_ids), len(groups), n_links), links

    def numbers(self, parts: list[str]) -> np.ndarray:
        """Places of the parts in the lists; new short ones go into the table."""
        table = self.table
        fresh = [p for p in dict.fromkeys(parts) if p not in table]
        base = len(self.text)
        if fresh:
            self.add(fresh)
            table.update(zip(fresh, range(base, base + len(fresh)), strict=True))
        out = np.fromiter(map(table.__getitem__, parts), np.int64, len(parts))
        for p in fresh:
            if len(p) > TABLE_CHARS:
                del table[p]
        return out

    def trim(self, numbers: np.ndarray) -> None:
        """Notes that the parts of these places were met; a full table keeps those that
        were met again after they came in, or starts anew if these are too many."""
        met = np.unique(numbers)
        if len(self.met) < len(self.text):
            self.met = np.r_[self.met, np.zeros(len(self.text) + TABLE_ENTRIES // 4 - len(self.met), np.uint8)]
        self.met[met] = np.minimum(self.met[met], 254) + 1
        if len(self.text) <= TABLE_ENTRIES and len(self.keys) <= 20 * TABLE_ENTRIES:
            return
        held = {p: n for p, n in self.table.items() if self.met[n] > 1}
        if 2 * len(held) > TABLE_ENTRIES:
            held = {p: n for p, n in held.items() if self.met[n] > 4}
        if 2 * len(held) > TABLE_ENTRIES:
            held = {}
        n = np.fromiter(held.values(), np.int64, len(held))
        ends = np.frombuffer(self.ends_at, np.int64)
        size = ends[n + 1] - ends[n]
        if size.sum() > 10 * TABLE_ENTRIES:
            n, size, held = n[:0], size[:0], {}
        at = spread(ends[n], size)
        text, sizes, ends = [self.text[i] for i in n.tolist()], np.frombuffer(self.sizes, np.int64).reshape(-1, 4)[n], None
        keys, times = np.frombuffer(self.keys, np.uint64)[at], np.frombuffer(self.times, np.uint32)[at]
        self.clear()
        self.table.update(zip(held, range(len(held)), strict=True))
        self.text = text
        self.sizes.frombytes(sizes.tobytes())
        self.keys.frombytes(keys.tobytes())
        self.times.frombytes(times.tobytes())
        self.ends_at.frombytes((1 + np.cumsum(size)).tobytes())
        self.met = np.ones(len(held), np.uint8)

    def slices(self, text: str):
        """The parts of ``text``, which begins with a space, in lists of bounded length."""
        if len(text) <= STEP:
            yield self.parts(text)
            return
        rest, at, step = "", 0, STEP
        while at < len(text):
            parts = self.parts(rest + text[at:at + step])
            at += step
            # the last part may go on; a stretch without a cut is taken in growing steps
            rest = parts.pop() if at < len(text) else ""
            step = STEP if parts else 2 * step
            if parts:
                yield parts

    def links(self, owner: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct ``(owner, link key)`` of parts and how often each occurs, in order."""
        both, n = np.unique((owner.astype(np.uint64) << np.uint64(32)) | number.astype(np.uint64), return_counts=True)
        owner, number = (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
        ends = np.frombuffer(self.ends_at, np.int64)
        size = ends[number + 1] - ends[number]
        at = spread(ends[number], size)
        return (np.repeat(owner, size), np.frombuffer(self.keys, np.uint64)[at],
                np.repeat(n, size) * np.frombuffer(self.times, np.uint32)[at])


def _sum(owner: np.ndarray, key: np.ndarray, n: np.ndarray):
    """Sums ``n`` over equal ``(owner, key)``, in order."""
    if not len(key):
        return owner, key, n
    if int(key.max()) >> 32 or int(owner.max()) >> 31:
        order = np.lexsort((key, owner))
    else:
        order = np.argsort((owner.astype(np.uint64) << np.uint64(32)) | key.astype(np.uint64))
    owner, key, n = owner[order], key[order], n[order]
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])])
    return owner[first], key[first], np.add.reduceat(n, first)


@lru_cache(maxsize=2)
def aligner(byte_level: str, pieces: str) -> Aligner:
    """One per pair of files and worker process."""
    return Aligner(byte_level, pieces)


def piece_count(pieces: str) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()


class Block:
    """What one block of documents gives: a row a document, and the block's own row."""

    def __init__(self, model: Aligner):
        self.model, self.chars = model, 0
        self.ids, self.sizes, self.sha, self.found = [], [], [], []

    def add(self, rows: list[tuple]) -> None:
        """Rows ``(id, text)``: texts of a step together, or one longer text alone."""
        if len(rows) == 1 and len(rows[0][1] or "") > STEP:
            return self._add_long(*rows[0])
        m, first = self.model, len(self.ids)
        parts = [m.parts(" " + t) if t else [] for _, t in rows]
        number = m.numbers([p for x in parts for p in x])
        owner = np.repeat(np.arange(len(rows)), [len(x) for x in parts])
        groups = [m.text[x] for x in number.tolist()]
        size = np.frombuffer(m.sizes, np.int64).reshape(-1, 4)[number]
        total = np.stack([np.bincount(owner, weights=size[:, k], minlength=len(rows)) for k in range(4)], 1).astype(np.int64)
        bad, at = np.zeros(len(rows), bool), 0
        for k, x in enumerate(parts):
            mine = groups[at:at + len(x)]
            at += len(x)
            bad[k] = None in mine
            self.sha.append(hashlib.sha256(b";".join(mine)).hexdigest() if x and not bad[k] else "")
        total[bad] = 0
        fine = ~bad[owner]
        self.found.append(_sum(*m.links(owner[fine] + first, number[fine])))
        self.ids += [i for i, _ in rows]
        self.sizes += list(total)
        self.chars += sum(len(t or "") for _, t in rows)
        m.trim(number)

    def _add_long(self, i, text: str) -> None:
        """A long text: its links are summed slice by slice."""
        m, digest, size, found = self.model, hashlib.sha256(), np.zeros(4, np.int64), []
        for k, parts in enumerate(m.slices(" " + text)):
            number = m.numbers(parts)
            groups = [m.text[x] for x in number.tolist()]
            if None in groups:
                size[:], found = 0, []
                break
            digest.update(b";" * bool(k) + b";".join(groups))
            size += np.frombuffer(m.sizes, np.int64).reshape(-1, 4)[number].sum(0)
            new = m.links(np.full(len(number), len(self.ids)), number)
            found = [_sum(*map(np.concatenate, zip(*found, new, strict=True)))]
            m.trim(number)
        self.ids.append(i)
        self.sizes.append(size)
        self.chars += len(text)
        self.sha.append(digest.hexdigest() if size[0] else "")
        self.found += found

    def batch(self, block: int) -> pa.RecordBatch:
        """A row a document, with its links as places in the block's list of pairs, and the
        row of the block itself: that list, and how many documents hold each."""
        owner, key, n = (np.concatenate(x) for x in zip(*self.found, strict=True)) if self.found else (
            np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        pairs, place, docs = np.unique(key, return_inverse=True, return_counts=True)
        cuts = np.searchsorted(owner, np.arange(len(self.ids) + 1))
        place, n = place.astype("<u4"), n.astype("<u8" if n.max(initial=0) >> 32 else "<u4")
        size = np.array(self.sizes, np.int64).reshape(-1, 4)
        rows = len(self.ids) + 1
        cols = {"block": pa.array([block] * rows, pa.int64()), "id": pa.array([*self.ids, None]),
                "own": pa.array([False] * (rows - 1) + [True])}
        for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links")):
            cols[name] = pa.array([*size[:, k].tolist(), None], pa.int64())
        cols["sha"] = pa.array([*self.sha, None], pa.string())
        cut = lambda x: [x[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
        cols["links"] = pa.array([*cut(place), pairs.astype("<u8").tobytes()], pa.binary())
        cols["times"] = pa.array([*cut(n), docs.astype("<u4").tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def _scored(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a block with their sums over links."""
    order = np.argsort(counts.column("place").to_numpy())
    total = counts.column("total").to_numpy()[order]
    best = counts.column("best").to_numpy()[order]
    n_best, count_sum = [], []
    for links, times, n in zip(docs.column("links").to_pylist(), docs.column("times").to_pylist(),
                               docs.column("n_links").to_pylist(), strict=True):
        at = np.frombuffer(links, "<u4")
        k = np.frombuffer(times, "<u4" if len(times) == len(links) else "<u8").astype(np.int64)
        assert int(k.sum()) == n
        n_best.append(int(k[best[at]].sum()))
        count_sum.append(int((k * total[at]).sum()))
    out = docs.select(["id", "n_a", "n_b", "n_groups", "n_links"])
    return (out.append_column("n_best", pa.array(n_best, pa.int64()))
            .append_column("count_sum", pa.array(count_sum, pa.int64()))
            .append_column("groups_sha256", docs.column("sha")))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_level: str | None = None,
          pieces: str | None = None) -> DataFrame:
    """One row per document: ``<id>, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``.

    A text is encoded after a space, without special tokens (their strings are plain
    text), by both tokenizers.  Groups lie between byte offsets where tokens of both end;
    links are the pairs of an A and a B token of a group.  ``n_best`` counts the links
    whose id pair is linked in as many documents as any pair of its A id, ``count_sum``
    sums these numbers of documents over the links.  ``groups_sha256`` is of all groups
    ``a1,a2|b1;...``.

    A text that is null, empty, or that a tokenizer doesn't give back byte for byte
    (one with U+2581) has no tokens: zeros and an empty ``groups_sha256``.  Rows with equal
    or null ids are documents of their own; ids keep their type.  An empty table
    gives no rows; other columns are not read.
    """
    own_columns(docs, id_col, text_col)
    scratch = Scratch(docs.sparkSession)
    files = byte_level or public_path(BYTE_LEVEL), pieces or public_path(PIECES)
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        model = aligner(*files)
        number = TaskContext.get().partitionId() << 32
        block, rows, size = Block(model), [], 0
        for b in batches:
            for row in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
                n = len(row[1] or "")
                if rows and size + n > STEP:
                    block.add(rows)
                    rows, size = [], 0
                rows.append(row)
                size += n
                if block.chars + size > BLOCK_CHARS:
                    block.add(rows)
                    yield block.batch(number)
                    number, block, rows, size = number + 1, Block(model), [], 0
                    release()
        if rows:
            block.add(rows)
        if block.ids:
            yield block.batch(number)

    blocks = scratch.save(map_arrow(
        base, run, f"block long, id {kind}, own boolean, n_a long, n_b long, n_groups long, n_links long, sha string, "
                   "links binary, times binary"), "alignment", compression="zstd")

    def unpack(batches):
        for b in batches:
            for no, links, times in zip(*(b.column(c).to_pylist() for c in ("block", "links", "times")), strict=True):
                pairs = np.frombuffer(links, "<u8").astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), no)), pa.array(np.arange(len(pairs), dtype=np.int32)), pa.array(pairs),
                     pa.array(np.frombuffer(times, "<u4").astype(np.int64))], ["block", "place", "pair", "docs"])
    asked = map_arrow(blocks.where("own").select("block", "links", "times"), unpack,
                      "block long, place int, pair long, docs long")
    wide = piece_count(files[1])
    # an A id has one row for each B id it is linked with, at most
    by_a = Window.partitionBy(F.expr(f"pair div {wide}L"))
    counts = (asked.groupBy("pair").agg(F.sum("docs").alias("total"))
              .select("pair", "total", (F.col("total") == F.max("total").over(by_a)).alias("best")))
    known = asked.join(counts, "pair").select("block", "place", "total", "best")

    def step(_, rows: pa.Table, found: pa.Table) -> pa.Table:
        return _scored(rows, found)

    out = (blocks.where("NOT own").select("block", "id", "n_a", "n_b", "n_groups", "n_links", "sha", "links", "times")
           .groupBy("block").cogroup(known.groupBy("block"))
           .applyInArrow(per_cogroup(step), f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                            "count_sum long, groups_sha256 string"))
    return out.withColumnRenamed("id", id_col)
