"""Secret scans: fixed patterns, and character Markov models of random strings
and of ordinary identifiers compared by log-likelihood ratio.

The models are first-order Markov chains over one alphabet, trained from labelled
samples.  By default these are ``labelled_strings``, generated from a word list and fixed
forms (identifiers in all spellings, paths, versions; random strings over the usual
alphabets), and the corpus adds to both: each distinct secret that the patterns find is
random, and text outside of pattern spans and long unbroken strings is ordinary, a
model of its own.  A string must be likelier as random than under every ordinary
model.  So no string that is to be judged trains a model, and one secret counts once
however many documents share it.  All documents are counted.

Shape at scale: texts are read once.  That pass writes the pattern spans and the
few long unbroken strings (candidates) of each document, and sums ordinary pairs
per task; the sums are 68 x 68 numbers at most however large the input is.  Found
secrets are made distinct with map-side combine and summed the same way.  Scoring
reads the candidates only.
"""

from __future__ import annotations

import hashlib
import random
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_arrow, own_columns

# The patterns.  Letters of the first are matched in either case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("passw", "secret", "token", "api")       # one of them is in every match, in lower case
MIN_ASSIGN = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
MIN_ACCESS = 20
HEX = re.compile(r"[0-9a-f]+")
MIN_HEX = 24
KINDS = ("assign", "access", "hex", "random")            # in this order at equal starts

# Strings the models judge; every access or hex match of enough length lies in such a run.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET) + 1                               # state 0 is any other character
_STATE = np.zeros(256, np.int64)
for _i, _c in enumerate(ALPHABET):
    _STATE[ord(_c)] = _i + 1
CELLS = STATES * STATES


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, in order, in code points."""
    found, low = [], text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    for run in RUN.finditer(text):
        # leftmost matches from the run's front are those from the text's front,
        # because neither pattern can begin in one run and end in another
        for kind, pattern, least in ((1, ACCESS, MIN_ACCESS), (2, HEX, MIN_HEX)):
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text, run.start(), run.end())
                      if m.end() - m.start() >= least]
    return sorted(found)


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, str]]:
    """Long unbroken strings that no pattern span touches, with their starts."""
    return [(m.start(), m[0]) for m in RUN.finditer(text)
            if not any(a < m.end() and m.start() < b for a, _, b in spans)]


def pair_counts(text: bytes) -> np.ndarray:
    """Counts of neighbouring characters of the alphabet, as a flat table."""
    s = _STATE[np.frombuffer(text, np.uint8)]
    pairs = s[:-1] * STATES + s[1:]
    return np.bincount(pairs[(s[:-1] > 0) & (s[1:] > 0)], minlength=CELLS)


def ordinary_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text outside of pattern spans and long unbroken strings."""
    cuts = sorted([(a, e) for a, _, e in spans] + [m.span() for m in RUN.finditer(text)])
    at, plain = 0, []
    for a, e in cuts:
        plain.append(text[at:a])
        at = max(at, e)
    return "\n".join([*plain, text[at:]]) if cuts else text


# The words that sample identifiers are made of, and strings that are identifiers by their form.
WORDS = """abstract access account action active adapter address admin alert api app archive array asset async backup balance
bank base batch body buffer build button cache call channel check child class client code color command common config
connect connection content context control core count country create current customer data database date default
delete device document download driver email entry error event export factory field file final folder format frame
function group handler header height host image import index info input install instance interface job key label level
limit list loader local location logger login main manager map max member memory message method model module name
network node number object offset option order output owner package page parent path payment plan policy position
price process project provider proxy query queue record release remote request resource response result retry return
role root schema search security select server service session setting size source start state status storage store
stream string support switch system table target task team template test text thread time title token total track
transaction type update upload user utils value vector version view window worker writer""".split()
FORMS = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")      # UUID


def labelled_strings(n: int = 4000, seed: int = 7) -> tuple[list[str], list[str]]:
    """``n`` random and ``n`` ordinary sample strings, the same for the same seed."""
    rng = random.Random(seed)
    upper, lower, digits = string.ascii_uppercase, string.ascii_lowercase, string.digits
    alphabets = (upper + lower + digits + "+/", upper + lower + digits + "-_", upper + lower + digits, lower + digits,
                 upper + digits, upper + "234567")
    noise = ["".join(rng.choices(alphabets[i % len(alphabets)], k=rng.randint(20, 64))) for i in range(n)]

    def words() -> list[str]:
        return [w + str(rng.randint(1, 99)) if rng.random() < 0.08 else w for w in rng.choices(WORDS, k=rng.randint(3, 8))]
    spellings = (
        lambda w: w[0] + "".join(x.capitalize() for x in w[1:]), lambda w: "".join(x.capitalize() for x in w),
        "_".join, lambda w: "_".join(w).upper(), "-".join, "/".join, lambda w: "/" + "/".join(w),
        lambda w: "_".join(x.capitalize() for x in w), lambda w: "/".join(x.capitalize() for x in w),
        lambda w: "-".join(w) + f"-{rng.randint(1990, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}",
        "".join, lambda w: "".join(w).upper(), lambda w: "=".join(["_".join(w), w[-1]]))
    return noise, [spellings[i % len(spellings)](words()) for i in range(n)]


class Model:
    """Log-likelihood ratio of a string being random rather than ordinary, per
    character pair: the least over the ordinary models.  Counts are smoothed
    by one pair in every cell; ``spread`` of each chain's weight lies evenly on all, so
    that one pair no sample has does not decide."""

    def __init__(self, random_pairs: np.ndarray, *ordinary: np.ndarray, spread: float = 0.0):
        chains = [self._chain(c, spread) for c in (random_pairs, *ordinary)]
        self.ratio = [np.log(chains[0] / c).ravel() for c in chains[1:]]

    @staticmethod
    def _chain(counts: np.ndarray, spread: float) -> np.ndarray:
        t = counts.reshape(STATES, STATES)[1:, 1:] + 1.0
        return (1 - spread) * t / t.sum(axis=1, keepdims=True) + spread / (STATES - 1)

    def score(self, text: str) -> float:
        s = _STATE[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)] - 1
        s = s[s >= 0]
        if len(s) < 2:
            return 0.0
        return min(float(r[s[:-1] * (STATES - 1) + s[1:]].mean()) for r in self.ratio)

    def random(self, text: str, threshold: float = 0.0) -> bool:
        """Whether a string counts as a secret: it has letters and six different
        characters at least, is no UUID and no row of neighbours (``abcdefg``), and its
        ratio is above the threshold."""
        if not any(c.isalpha() for c in text) or len(set(text)) < 6 or FORMS.fullmatch(text):
            return False
        steps = sum(ord(b) - ord(a) == 1 for a, b in zip(text, text[1:], strict=False))
        return 2 * steps < len(text) and self.score(text) > threshold


def train(samples: DataFrame, text_col: str = "text", label_col: str = "random") -> Model:
    """A model from labelled strings: ``label_col`` is true for random ones.
    Null strings or labels are left out.  Every sample is counted."""
    own_columns(samples, text_col, label_col)

    def count(batches):
        sums = np.zeros((2, CELLS), np.int64)
        for b in batches:
            for t, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums[0 if label else 1] += pair_counts(t.encode())
        yield _sparse(sums)

    rows = samples.select(F.col(f"`{text_col}`").alias("t"), F.col(f"`{label_col}`").cast("boolean").alias("l")).dropna()
    return Model(*_gather(map_arrow(rows, count, "cell int, n long")))


def default_model(counts: DataFrame) -> Model:
    """The model of the generated samples and the corpus: its secrets' pairs are added to the
    random ones, its ordinary text is a second ordinary model, which leans on the
    identifiers' where it has few pairs."""
    own_random, own_text = _gather(counts)
    noise, names = (pair_counts("\n".join(x).encode()).astype(float) for x in labelled_strings())
    text = own_text + 2_000.0 * names / np.maximum(names.reshape(STATES, STATES).sum(axis=1), 1).repeat(STATES)
    return Model(noise + own_random, names, text, spread=0.2)


def _sparse(sums: np.ndarray) -> pa.RecordBatch:
    flat = sums.ravel()
    cell = np.flatnonzero(flat)
    return pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(flat[cell], pa.int64())], ["cell", "n"])


def _gather(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    # at most 2 * CELLS rows reach the driver
    sums = np.zeros(2 * CELLS)
    for r in counts.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        sums[r.cell] = r.n
    return sums[:CELLS], sums[CELLS:]


def _secrets(batches):
    """The secret inside each found span."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([ASSIGN.match(s)[2] if k == 0 else s for k, s in zip(
            b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)], pa.string())], ["secret"])


def _random_pairs(batches):
    sums = np.zeros((2, CELLS), np.int64)
    for b in batches:
        sums[0] += pair_counts("\n".join(b.column(0).to_pylist()).encode())
    yield _sparse(sums)


_FOUND = ("doc_id {0}, base array<struct<start: long, kind: int, end: long>>, starts array<long>, "
          "strings array<string>, counts array<struct<cell: int, n: long>>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: DataFrame | None = None,
         threshold: float = 0.0, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``spans``, an array of
    ``(start, end, kind, string)``; positions are code points, ends exclusive.

    Pattern spans are always there; a candidate is added as kind ``random`` when
    it is no trivial string (``Model.random``) and its ratio per character pair is above ``threshold``.
    ``samples``: see ``train``; default: ``default_model``.  Null text is empty; rows with equal ids are scanned one by one.
    """
    own_columns(docs, id_col, text_col)
    scratch = scratch or Scratch(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = _FOUND.format(kind)
    arrow = pa.schema([("base", pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()),
                                                    ("string", pa.string())]))),
                       ("starts", pa.list_(pa.int64())), ("strings", pa.list_(pa.string())),
                       ("counts", pa.list_(pa.struct([("cell", pa.int32()), ("n", pa.int64())])))])
    schema = schema.replace("end: long>>", "end: long, string: string>>", 1)

    def find(batches):
        sums, ids = np.zeros((2, CELLS), np.int64), None      # random pairs come from distinct secrets
        for b in batches:
            ids, rest, rows = b.column(0), [], []
            for t in b.column(1).to_pylist():
                spans = base_spans(t)
                runs = candidates(t, spans)
                rows.append({"base": [{"start": a, "kind": k, "end": e, "string": t[a:e]} for a, k, e in spans],
                             "starts": [a for a, _ in runs], "strings": [s for _, s in runs], "counts": None})
                rest.append(ordinary_text(t, spans))
            sums[1] += pair_counts("\n".join(rest).encode())
            cols = pa.RecordBatch.from_pylist(rows, schema=arrow)
            yield pa.RecordBatch.from_arrays([ids, *cols.columns], ["doc_id", *cols.schema.names])
        cells = np.flatnonzero(sums.ravel())
        if ids is not None and len(cells):
            # the task's sums, in a row that is no document
            cols = pa.RecordBatch.from_pylist([{"base": None, "starts": None, "strings": None, "counts": [
                {"cell": int(c), "n": int(sums.ravel()[c])} for c in cells]}], schema=arrow)
            yield pa.RecordBatch.from_arrays([pa.nulls(1, ids.type), *cols.columns], ["doc_id", *cols.schema.names])

    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    found = scratch.save(map_arrow(texts, find, schema), "spans")
    if samples is not None:
        model = train(samples)
    else:
        ordinary = found.where("counts IS NOT NULL").select(F.explode("counts").alias("c")).select("c.*")
        spans = found.where("counts IS NULL").select(F.explode("base").alias("s")).select("s.kind", "s.string").distinct()
        secrets = map_arrow(spans, _secrets, "secret string").distinct()
        model = default_model(ordinary.unionByName(map_arrow(secrets, _random_pairs, "cell int, n long")))

    def judge(batches):
        for b in batches:
            out = []
            for base, starts, strings in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                spans = [(s["start"], s["kind"], s["end"], s["string"]) for s in base]
                spans += [(a, 3, a + len(s), s) for a, s in zip(starts, strings, strict=True)
                          if model.random(s, threshold)]
                out.append([{"start": a, "end": e, "kind": KINDS[k], "string": s} for a, k, e, s in sorted(spans)])
            kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()),
                                        ("string", pa.string())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, kinds)], ["doc_id", "spans"])

    documents = found.where("counts IS NULL").select("doc_id", "base", "starts", "strings")
    return map_arrow(documents, judge,
                     f"doc_id {kind}, spans array<struct<start: long, end: long, kind: string, string: string>>")


def digest(spans: list[tuple[int, int, str]]) -> str:
    """Lowercase hex SHA-256 of ``kind:start:end`` joined by commas."""
    return hashlib.sha256(",".join(f"{k}:{a}:{e}" for a, e, k in spans).encode()).hexdigest()
