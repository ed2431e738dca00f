"""Token ids of whole texts with public vocabulary files.

In the word-BPE file white space always ends a token, so a text's ids are its
white-space chunks' ids in a row.  Each Python worker keeps a bounded table of
chunks it has met, which spares most of the BPE work.  Files of byte-level ranks
go to their own library, which is fast without one.
"""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache

import numpy as np

# Entries a worker's table may hold (about 200 bytes each); it starts anew when full.
TABLE_ENTRIES = 600_000
_SPACES = re.compile(r"[\x20\x09-\x0D]+")
# A word of Latin-1 letters and the marks after it (no apostrophe, which can begin a contraction): two pre-tokens
# at most, of which the normaliser changes the letters' case alone.
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-^`{-~]*)").fullmatch
# Byte-level vocabularies write a byte that is not printable as the next free character from 256 on.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_KINDS = "Word WORD, words... it's 3.14  two\nlines\tTab \u00c9cole \u00e9t\u00e9! (a_b) x\x1cy \u65e5\u672c\u8a9e \U0001F600 don't--stop 'tis U.S.A."
_ODD = re.compile("[\x1c-\x1f]")      # str.split cuts at these, the vocabulary does not


def _ids(tokenizer, text: str) -> bytes:
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()


class _Table(dict):
    """Chunks and their ids; a chunk is worked out when it is first asked for."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.bpe, self.marks = tokenizer, tokenizer.model.tokenize, {"": b""}

    def __missing__(self, chunk: str) -> bytes:
        plain = _PLAIN(chunk)
        if plain is None:
            ids = _ids(self.tokenizer, chunk)
        else:
            letters, run = plain.groups()
            low = letters.lower()
            ids = self.get(low)
            if ids is None:
                # one lower-case word is one pre-token: only the BPE itself is left to do
                word = low if low.isascii() else low.encode().decode("latin-1").translate(_BYTE_CHARS)
                ids = self[low] = array("I", [t.id for t in self.bpe(word)]).tobytes()
            if run:
                if run not in self.marks:
                    self.marks[run] = _ids(self.tokenizer, run)
                ids += self.marks[run]
        self[chunk] = ids
        return ids

    def trim(self) -> None:
        if len(self) > TABLE_ENTRIES or len(self.marks) > TABLE_ENTRIES:
            self.clear()
            self.marks = {"": b""}


class Encoder:
    """``encode(text)`` gives the ids as little-endian uint32 bytes; they equal
    those of the tokenizer file over the whole text without special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.table = _Table(self.tokenizer)
        # the chunks' way is right for files that lower-case and end tokens at white space; any other file is
        # found out on a text of all kinds and encodes whole texts
        self.by_chunks = True
        self.by_chunks = self.encode(_KINDS) == _ids(self.tokenizer, _KINDS)

    def encode(self, text: str) -> bytes:
        if not self.by_chunks:
            return _ids(self.tokenizer, text)
        if text.isascii():
            text = text.lower()
        chunks = [c for c in _SPACES.split(text) if c] if _ODD.search(text) else text.split()
        out = []
        # a very long text is taken in parts, so that the table's bound holds
        for i in range(0, len(chunks), 50_000):
            self.table.trim()
            out.append(b"".join(map(self.table.__getitem__, chunks[i:i + 50_000])))
        return b"".join(out)


class RankEncoder:
    """The same for a file of byte-level ranks."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ids = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                     special_tokens={}).encode_ordinary

    def encode(self, text: str) -> bytes:
        return array("I", self.ids(text)).tobytes()


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder | RankEncoder:
    """One encoder per file and worker process."""
    return RankEncoder(path) if path.endswith(".tiktoken") else Encoder(path)


def public_path(name: str) -> str:
    """Where a public tokenizer's file lies on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)
