"""Line dedup, quality rules, n-gram join, suffix dedup, source mixing against plain versions."""

import random

import numpy as np
import pytest

from seasonflow.llm import line_dedup, mixing, ngram_join, quality, suffix_dedup

from . import brute

TEXTS = lambda rows: [(i, t) for i, t, _ in rows]


def test_line_dedup_edges(edge, empty, edge_rows):
    out = line_dedup.dedup_lines(edge)
    assert out.columns == [*edge.columns, "n_lines", "n_dropped"]
    got = brute.bag((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect())
    assert got == brute.bag(brute.line_dedup(TEXTS(edge_rows)))
    assert out.where("id <> 'x' OR key <> 1 OR c0 <> 'c'").count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_threshold_of_three_documents(spark):
    docs = spark.createDataFrame([(i, "common line of text") for i in range(2)] + [
        (i, "frequent line of text") for i in range(5)], "doc_id long, text string")
    got = {(r.doc_id, r.text) for r in line_dedup.dedup_lines(docs, min_docs=3).collect()}
    assert (1, "common line of text") in got and (0, "frequent line of text") in got
    assert sum(t == "" for _, t in got) == 4


def test_quality_edges(edge, empty, edge_rows):
    out = quality.judge(edge)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = brute.bag((r.id, *(r[c] for c in names)) for r in out.collect())
    assert got == brute.bag((i, *brute.quality(t)) for i, t, _ in edge_rows)
    assert out.where("base_failed AND kept").count() == 0
    assert quality.judge(empty).count() == 0 and quality.keep_good(empty).count() == 0
    kept = quality.keep_good(edge)
    assert kept.columns == edge.columns
    judged = brute.judged(edge_rows)
    want = brute.bag((i, t) for (i, t, _), (_, k) in zip(edge_rows, judged) if k)
    assert brute.bag((r.doc_id, r.text) for r in kept.collect()) == want
    assert brute.bag((r.id, r.host_verdict, r.kept) for r in out.collect()) == brute.bag(
        (i, v, k) for (i, _, _), (v, k) in zip(edge_rows, judged))


def hosts():
    clean = " ".join(f"good{i}" for i in range(40))
    some = " ".join(f"w{i}abcde*" if i % 2 == 0 else f"w{i}abcdef" for i in range(40))        # 5 to 10 percent symbols
    shout = " ".join(f"#$w{i}*" for i in range(40))
    rows = [(1000 + i, "bad", "spam.example") for i in range(300)]
    rows += [(2000 + i, clean + str(i), "good.example") for i in range(500)]
    rows += [(3000 + i, clean + str(i) if i % 4 else "short", "usual.example") for i in range(500)]
    rows += [(k * 1000 + 900 + j, t, h) for k, h in ((1, "spam.example"), (2, "good.example"), (3, "usual.example"), (4, "new.example"))
             for j, t in enumerate((clean, some, shout))]
    return rows


def test_host_verdicts_decide_which_rules_hold(spark):
    rows = hosts()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = {r.id: r for r in quality.judge(docs).collect()}
    assert {r.host: r.host_verdict for r in got.values()} == {
        "spam.example": "bad", "good.example": "clean", "usual.example": "usual", "new.example": "usual"}
    kept = {h: [got[k * 1000 + 900 + j].kept for j in range(3)] for k, h in ((1, "bad"), (2, "clean"), (3, "usual"), (4, "new"))}
    # a clean document stays in every host; symbols are let pass in a clean one, half as many in a bad one
    assert kept == {"bad": [True, False, False], "clean": [True, True, True], "usual": [True, True, False], "new": [True, True, False]}
    assert [(got[i].host_verdict, got[i].kept) for i, _, _ in rows] == brute.judged(rows)
    rates = {r.host: r for r in quality.host_rates(quality.judge(docs), quality.RULES).collect()}
    spam = rates["spam.example"]
    assert (spam.n_docs, spam.n_base, spam.n_symbol, spam.n_failed) == (303, 300, 1, 301) and spam.rate < 301 / 303
    assert 0 < rates["good.example"].rate < 0.05


def test_host_verdicts_change_rows_of_the_given_documents_and_clean_ones_stay(spark):
    from seasonflow.llm.queries import QUERIES
    root = "/root/testdata/sf0.01"
    judged = QUERIES["op5_quality_rules"](spark, root)
    labels = spark.read.parquet(f"{root}/labels.parquet").where("quality = 1").select("doc_id")
    assert judged.where("NOT base_failed AND NOT kept").count() > 20
    assert judged.join(labels, "doc_id").where("NOT base_failed AND NOT kept").count() == 0


def hub_rows(seed=3):
    """Chains and clusters of near copies around one base, so that all meet at few hubs."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(60)]
    rows, chain = [], base[:]
    for i in range(40):                       # a chain: neighbours link, its ends don't
        if i % 2:
            chain[rng.randrange(60)] = f"c{i}"
        rows.append(" ".join(chain))
    for i in range(60):                       # many near copies of the base itself
        near = base[:]
        near[rng.randrange(60)] = f"n{i}"
        rows.append(" ".join(near))
    for i in range(30):                       # share half with it: meet, but link with nothing or each other
        rows.append(" ".join(base[:30] + [f"h{i // 3}x{k}" for k in range(30)]))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("blocks, representatives, direct", [(10, 2, 1), (4, 1, 3), (25, 8, 1), (25, 8, 3), (500, 32, 3)])
def test_large_hubs_lose_no_link(spark, monkeypatch, blocks, representatives, direct):
    for name, value in (("BLOCK_CLASSES", blocks), ("REPRESENTATIVES", representatives), ("DIRECT", direct)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = hub_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for words, pct in ((3, 90), (3, 80), (2, 95)):
        got = {r.doc_id: r.component_id for r in ngram_join.link_groups(docs, words=words, min_pct=pct).collect()}
        assert got == {i: c for i, _, c in brute.link_groups(rows, words, pct)}


def test_a_large_group_of_near_copies_is_sent_about_once(spark, monkeypatch):
    sent = []
    real = ngram_join._compare

    def counted(work, keys, min_pct):
        sent.append((keys, work.count()))
        return real(work, keys, min_pct)
    monkeypatch.setattr(ngram_join, "_compare", counted)
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 20)
    monkeypatch.setattr(ngram_join, "REPRESENTATIVES", 4)
    monkeypatch.setattr(ngram_join, "DIRECT", 1)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[:i] + [f"x{i}"] + words[i + 1:])) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.component_id for r in ngram_join.link_groups(docs, words=3, min_pct=90).collect()}
    assert got == {0}
    met = sum(n for keys, n in sent if keys == ["hub", "block"])
    tiles = sum(n for keys, n in sent if keys == ["h", "i", "j"])
    assert len(sent) == 3 and sent[0][1] < 200
    # ten blocks of twenty and four representatives at each hub; pairs of blocks would send each member ten times
    assert met and tiles == 0


def test_ngram_join_edges(edge, empty, edge_rows):
    for words, pct in ((3, 90), (5, 80)):
        got = brute.bag((r.doc_id, r.n_shingles, r.component_id)
                        for r in ngram_join.link_groups(edge, words=words, min_pct=pct).collect())
        assert got == brute.bag(brute.link_groups(TEXTS(edge_rows), words, pct))
    assert ngram_join.link_groups(empty).count() == 0 and ngram_join.keep_one(empty).count() == 0
    kept = ngram_join.keep_one(edge)
    assert kept.columns == edge.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert 0 in ids and not {1, 3, 11} & set(ids) and {4, 5, 6, 7} <= set(ids) and ids.count(14) == 1


def near_copies(seed, n, length=60):
    """Groups of copies with few or many edits, and texts of their own."""
    rng = random.Random(seed)
    rows, words = [], [f"w{k}" for k in range(400)]
    for _ in range(n // 6):
        base = [rng.choice(words) for _ in range(length)]
        for _ in range(6):
            t = list(base)
            for _ in range(rng.randrange(5)):
                t[rng.randrange(length)] = rng.choice(words)
            if rng.random() < 0.3:
                t = t[:rng.randrange(length - 8, length)]
            rows.append((len(rows), " ".join(t)))
    return rows


@pytest.mark.parametrize("words,pct", [(3, 90), (5, 80), (1, 100)])
def test_ngram_join_small_blocks(spark, monkeypatch, words, pct):
    # partitions and blocks so small that every way of splitting is taken
    for name, value in (("GRAMS_A_PART", 700), ("FLUSH", 900), ("BLOCK_CLASSES", 2), ("CELLS", 300), ("REPRESENTATIVES", 1), ("DIRECT", 1)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = near_copies(5, 90) + [(900 + i, "a b c d e f g h i j") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = brute.bag((r.doc_id, r.n_shingles, r.component_id)
                    for r in ngram_join.link_groups(docs, words=words, min_pct=pct).collect())
    assert got == brute.bag(brute.link_groups(rows, words, pct))


def test_overlap_counts_per_fragment(monkeypatch):
    rng = np.random.default_rng(1)
    a = [np.unique(rng.integers(0, 80, rng.integers(1, 60))).astype(np.uint64) for _ in range(17)]
    b = [np.unique(rng.integers(0, 80, rng.integers(1, 60))).astype(np.uint64) for _ in range(9)]
    for cells in (10, 200, 10 ** 6):
        monkeypatch.setattr(ngram_join, "CELLS", cells)
        assert (ngram_join.overlaps(a, b) == [[len(np.intersect1d(x, y)) for y in b] for x in a]).all()
        apart = ~np.eye(len(a), dtype=bool)       # a set's overlap with itself is not needed
        want = np.array([[len(np.intersect1d(x, y)) for y in a] for x in a])
        assert (ngram_join.overlaps(a, a) == want)[apart].all()


def test_suffix_dedup_edges(edge, empty, edge_rows):
    out = suffix_dedup.remove_repeats(edge, length=50)
    rows = out.collect()
    got = brute.bag((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)
    assert got == brute.bag(brute.remove_repeats(TEXTS(edge_rows), 50))
    for r in rows:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed and brute.sha(bytes(r.kept)) == r.kept_sha256
    assert suffix_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("length", [8, 50])
def test_suffix_dedup_small_partitions(spark, monkeypatch, length):
    for name, value in (("SUFFIXES_A_PART", 60), ("TEXT_A_PART", 2000), ("FLUSH", 50)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rng = random.Random(3)
    passages = ["".join(rng.choice("abc é") for _ in range(rng.randrange(40, 200))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(passages)[rng.randrange(30):] + rng.choice(["", "#", "\n"]) for _ in range(
        rng.randrange(5)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = brute.bag((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                    for r in suffix_dedup.remove_repeats(docs, length=length, with_text=False).collect())
    assert got == brute.bag(brute.remove_repeats(rows, length))


def test_suffix_dedup_spreads_a_passage_of_most_documents(spark, monkeypatch, tmp_path):
    for name, value in (("SUFFIXES_A_PART", 200), ("TEXT_A_PART", 4000), ("FLUSH", 2000), ("WINDOWS_A_KEY", 200)):
        monkeypatch.setattr(suffix_dedup, name, value, raising=False)
    per_group, folder = suffix_dedup.per_group, str(tmp_path)

    def counted(fn):
        """Leaves the number of windows of every group in a file."""
        fields = {"count": "u2", "at": "u4", "ids": "i8"}
        step = fn.__name__

        def run(key, table):
            n = int(suffix_dedup.unpack(table, fields)["count"].sum())
            with open(f"{folder}/{step}-{key[0].as_py()}", "w") as f:
                f.write(str(n))
            return fn(key, table)
        return per_group(run)

    monkeypatch.setattr(suffix_dedup, "per_group", counted)
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    passage = text(70)
    rows = [(rng.choice([None, i, i, i, i // 2]), text(rng.randrange(80)) + passage + rng.choice([" and ", "\n", ""]) + text(60))
            for i in range(400)] + [(1000 + i, text(200)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = brute.bag((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                    for r in suffix_dedup.remove_repeats(docs, length=50, with_text=False).collect())
    assert got == brute.bag(brute.remove_repeats(rows, 50))
    seen = {f.name: int(f.read_text()) for f in tmp_path.iterdir()}
    for step in ("match", "compare"):
        sizes = [n for name, n in seen.items() if name.startswith(step)]
        assert len(sizes) > 15 and max(sizes) < sum(sizes) / 8, (step, sorted(sizes))


def test_multikey_sort_orders_rows():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 2, (300, 21)).astype(np.uint8)
    rows[:, :14] = 7
    order, new = suffix_dedup.multikey_sort(rows)
    want = sorted(map(bytes, rows))
    assert [bytes(rows[i]) for i in order] == want
    assert new.tolist() == [k == 0 or want[k] != want[k - 1] for k in range(len(want))]


def test_mixing_edges(edge, empty, edge_rows):
    rows = mixing.copies(edge).collect()
    size = {}
    for _, t, s in edge_rows:
        size[s] = size.get(s, 0) + len(brute.WORD.findall(t or ""))
    want = brute.targets(size)
    assert len(rows) == len(edge_rows)
    for r in rows:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.copies <= 3
    again = mixing.copies(edge.repartition(7)).collect()
    assert brute.bag(rows) == brute.bag(again)
    mixed = mixing.mix(edge)
    assert mixed.columns == edge.columns and mixed.count() == sum(r.copies for r in rows)
    assert mixing.copies(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mixing_comes_near_its_targets_over_a_tree(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(0, 90), "big" if i % 3 else f"s{i % 7}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.copies(docs, group_rows=50).collect()
    size, taken, target = {}, {}, {}
    for r in out:
        size[r.source] = size.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        target[r.source] = r.target
    assert target == pytest.approx(brute.targets(size))
    for s in size:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 45


def test_pivotal_rounding_keeps_mass_and_expectation():
    rng = np.random.default_rng(6)
    size, p = np.sort(rng.integers(1, 100, 40))[::-1].astype(float), np.full(40, 0.3)
    hits = np.zeros(40)
    for _ in range(3000):
        q, rest = mixing._pivot(size, p, rng.random(40))
        assert (q * size).sum() == pytest.approx((p * size).sum())
        assert sum(1e-9 < x < 1 - 1e-9 for x in q) <= 1
        hits += q
    assert np.abs(hits / 3000 - 0.3).max() < 0.05
