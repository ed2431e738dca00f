"""Quality rules with host-level verdicts, DataFrame expressions only.

Each document is measured and held against every rule by itself; failures of all rules
are summed per host (a narrow aggregate with map-side combine); host rates are shrunk
with a beta prior that is fitted to the hosts themselves; each host's posterior is held
against that prior, and the verdict is joined back and decides which rules its documents
must pass:

* ``clean``: clearly fewer failures than hosts have in general; the base rules alone;
* ``usual``: the rules on symbols and repeated lines as well;
* ``bad``: clearly more failures; these rules with half their limits.

Shape at scale: measures are written once as a narrow table, so texts are read
once and never shuffled.  The join back is a plain equi-join of narrow rows,
which AQE splits where one host holds a third of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, Scratch, bind, own_columns

SPACE_RUN = r"[\x20\x09-\x0D]+"


def _words(text: Column) -> Column:
    cut = F.split(F.regexp_replace(text, rf"^{SPACE_RUN}|{SPACE_RUN}$", ""), SPACE_RUN, -1)
    return F.when(F.regexp_like(text, F.lit(WORD)), cut).otherwise(F.array().cast("array<string>"))


def _covered(windows: Column, size: int) -> Column:
    """Words inside windows that occur twice or more.  ``windows`` has one hash
    per start; equal ones are neighbours once sorted by (hash, start)."""
    def run(s):
        starts = F.array_sort(F.transform(F.filter(s, lambda x, i:
                 (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])), lambda x: x["p"]))
        return bind(starts, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(size), F.coalesce(F.get(p, i + 1) - x, F.lit(size)))),
            F.lit(0).cast("long"), lambda a, x: a + x))
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return bind(pairs, run)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            host_col: str = "source", window: int = 5) -> DataFrame:
    """One row per row of ``docs``: id, host, and the counts ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``.
    Null text counts as no words."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{host_col}`").alias("host"), text.alias("text"))

    def of_words(w):
        n = F.size(w)
        windows = F.transform(F.sequence(F.lit(0), n - window),
                              lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))
        repeats = bind(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                       .otherwise(_covered(h, window)))
        return F.struct(n.cast("long").alias("n"),
                        F.when(n >= window, repeats).otherwise(F.lit(0).cast("long")).alias("r"))

    lines = F.filter(F.split("text", "\n", -1), lambda x: F.regexp_like(x, F.lit(WORD)))
    return base.select(
        "id", "host", bind(_words(F.col("text")), of_words).alias("w"),
        F.length(F.regexp_replace("text", SPACE_RUN, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        bind(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
    ).select("id", "host", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
             F.col("w.r").alias("n_repeat_words"))


def host_rates(measured: DataFrame, rules: dict[str, str], sure: float = 2.0, clean: float = 0.5,
               bad: float = 2.0) -> DataFrame:
    """One row per host: documents, failures of each rule (``rules`` maps a result to a
    boolean column) and of any, the posterior mean ``rate`` of any failure with its
    deviation ``sd``, and the ``verdict``.

    The beta prior's mean and strength are fitted to all hosts by the method of moments
    (weighted by documents).  Its strength is at least 1 and at most the mean number of
    documents of a host, so that hosts which differ no more than chance lets them are
    drawn to the mean, but a host's own documents still count.  A host is ``clean`` if
    its rate is below ``clean`` times the prior mean by ``sure`` deviations, ``bad`` if it
    is above ``bad`` times that mean by as many, else ``usual``.  A null host is a
    host of its own.  No rows for no documents."""
    any_failed = reduce(Column.__or__, [F.col(c) for c in rules.values()])
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(any_failed.cast("long")).alias("n_failed"),
        *[F.sum(F.col(c).cast("long")).alias(n) for n, c in rules.items()])
    prior = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"), F.count(F.lit(1)).alias("k"),
                      F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("ff")).first()
    mean = (prior.f / prior.n) if prior.n else 0.0
    # spread of host rates around the mean, less what sampling alone explains
    spread = (float(prior.ff) / prior.n - mean * mean) if prior.n else 0.0
    noise = mean * (1 - mean) * prior.k / prior.n if prior.n else 0.0
    most = max(1.0, prior.n / prior.k) if prior.n else 1.0
    strength = min(most, max(1.0, mean * (1 - mean) / (spread - noise) - 1)) if spread > noise else most
    rate = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    off = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n_docs") + F.lit(strength + 1)))
    verdict = (F.when(F.col("rate") + sure * F.col("sd") < F.lit(clean * mean), "clean")
               .when(F.col("rate") - sure * F.col("sd") > F.lit(bad * mean), "bad").otherwise("usual"))
    return hosts.withColumn("rate", rate).withColumn("sd", off).withColumn("verdict", verdict)


RULES = {"n_base": "base_failed", "n_symbol": "symbols_failed", "n_lines": "lines_failed"}


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          min_words: int = 10, max_repeat_pct: int = 20, max_symbol_pct: int = 10, max_dup_line_pct: int = 30,
          scratch: Scratch | None = None) -> DataFrame:
    """The measures, the three rules, the host's ``host_rate`` and ``host_verdict``, ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or repeated 5-word windows
    over more than ``max_repeat_pct`` percent of the words.  ``symbols_failed``: symbols
    over ``max_symbol_pct`` percent of the word characters.  ``lines_failed``: more than
    ``max_dup_line_pct`` repeated lines per hundred words.  A document stays if it passes
    the base rule and those that its host's verdict asks for (see above), so one that
    is far from every limit stays whatever its host.

    Null text has no words and fails; null host is one host; rows with equal ids
    are judged one by one; an empty table gives no rows.
    """
    own_columns(docs, id_col, text_col, host_col)
    scratch = scratch or Scratch(docs.sparkSession)

    def symbols(limit: Column) -> Column:
        return F.col("n_symbols") * 100 * limit > F.col("word_chars") * max_symbol_pct

    def lines(limit: Column) -> Column:
        return F.col("n_dup_lines") * 100 * limit > F.col("n_words") * max_dup_line_pct
    measured = measure(docs, id_col, text_col, host_col).withColumns({
        "base_failed": (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct),
        "symbols_failed": symbols(F.lit(1)), "lines_failed": lines(F.lit(1))})
    measured = scratch.save(measured, "measures")
    hosts = host_rates(measured, RULES).select(F.col("host").alias("host_"), "rate", "verdict")
    joined = measured.join(hosts, F.col("host").eqNullSafe(F.col("host_")), "left")
    twice = F.when(F.col("verdict") == "bad", 2).otherwise(1)
    passed = (F.col("verdict") == "clean") | ~(symbols(twice) | lines(twice))
    return joined.select(
        "id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "symbols_failed", "lines_failed", F.col("rate").alias("host_rate"), F.col("verdict").alias("host_verdict"),
        (~F.col("base_failed") & passed).alias("kept"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
              **rules) -> DataFrame:
    """The rows of ``docs``, all columns, whose verdict is kept.

    The verdict on a row follows from its own text and its host's rate, so the
    text is judged in place against the hosts' verdicts and never shuffled by id.
    Rejected documents are usually few; rows are matched by id, host and text hash
    so that rows which share an id keep their own verdicts.
    """
    own_columns(docs, id_col, text_col, host_col)
    marks = [F.xxhash64(F.col(f"`{text_col}`")), F.xxhash64(F.lit(7919), F.col(f"`{text_col}`"))]
    marked = docs.withColumn("__m1", marks[0]).withColumn("__m2", marks[1])
    slim = marked.select(F.struct(F.col(f"`{id_col}`").alias("i"), "__m1", "__m2").alias("rid"),
                         F.col(f"`{text_col}`").alias("text"), F.col(f"`{host_col}`").alias("host"))
    bad = (judge(slim, "rid", "text", "host", **rules).where(~F.col("kept"))
           .select(F.col("id.i").alias("__i"), F.col("id.__m1").alias("__n1"), F.col("id.__m2").alias("__n2"),
                   F.col("host").alias("__h")).distinct())
    on = (F.col(f"`{id_col}`").eqNullSafe(F.col("__i")) & F.col(f"`{host_col}`").eqNullSafe(F.col("__h"))
          & (F.col("__m1") == F.col("__n1")) & (F.col("__m2") == F.col("__n2")))
    return marked.join(bad, on, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
