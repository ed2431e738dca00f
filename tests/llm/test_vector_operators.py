"""Hard negatives, permutation search and token alignment against brute force."""

import hashlib
import math
import os
import random
from collections import Counter

import numpy as np
import pyarrow.dataset as ds
import pytest

from seasonflow.llm import alignment, multi_index, permutation_index
from seasonflow.llm.queries import ORACLE, QUERIES
from seasonflow.llm.tokens import public_path
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, uid long, cell int, v string, part int, id string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, 2, "v", 3, "i") for i, v, y in rows], SCHEMA).repartition(3)


def usable(rows):
    return [(i, v, y) for i, v, y in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]


# -- hard negatives --------------------------------------------------------------------------
def brute_mine(rows, anchor, n_pos=5, n_neg=5, low=80, scale=256):
    rows = [(i, [math.floor(scale * float(np.float32(x))) for x in v], y) for i, v, y in usable(rows) if y is not None]
    size = Counter(len(v) for _, v, _ in rows)
    best = max(size, key=lambda d: (size[d], d), default=0)
    rows = [r for r in rows if len(r[1]) == best]
    out = []
    for i, v, y in rows:
        if not anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in rows if j != i)
        for p, j, _ in [s for s in scored if s[2] == y][:n_pos]:
            negatives = [s for s in scored if s[2] != y and low * -p <= 100 * -s[0] <= 100 * -p][:n_neg]
            out += [(i, j, r + 1, n, -p, -s) for r, (s, n, _) in enumerate(negatives)]
    return sorted(out)


def mined(df, **kw):
    return sorted(tuple(r) for r in multi_index.mine(df, anchors=F.col("vec_id") % 10 == 0, **kw).collect())


def vectors(n, dim, seed, copies=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) + rng.normal(size=(6, dim))[rng.integers(0, 6, n)]
    x[:copies] = x[0]
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(int(i), [float(np.float32(c)) for c in v], int(rng.integers(0, 4))) for i, v in enumerate(x)]


EDGES = [(None, [0.1] * 6, 1), (400, None, 1), (410, [], 1), (420, [0.1, None, 0.2, 0.1, 0.1, 0.1], 1),
         (430, [float("nan")] + [0.1] * 5, 2), (440, [float("inf")] + [0.1] * 5, 2), (450, [0.1] * 5, 2),
         (460, [0.1] * 6, None), (470, [0.0] * 6, 1), (480, [-0.3] * 6, 1)]


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, small):
    if small:      # many cells, split hot cells, several rounds and anchor blocks
        for name, value in (("CELL_ROWS", 4), ("PART_ROWS", 40), ("BLOCK_ANCHORS", 7), ("FIRST_ROWS", 10), ("GROW", 3)):
            monkeypatch.setattr(multi_index, name, value)
    rows = vectors(300, 6, seed=1, copies=100) + EDGES
    assert mined(table(spark, rows)) == brute_mine(rows, lambda i: i % 10 == 0)


def test_hard_negatives_with_few_rows_and_ties(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (2, [1.0, 0.0], 2), (4, [0.85, 0.0], 3), (5, [0.7, 0.0], 3)]
    assert mined(table(spark, rows)) == brute_mine(rows, lambda i: i % 10 == 0) != []
    assert mined(table(spark, rows[:1])) == mined(table(spark, [])) == []
    lone = [(0, [0.5], 1), (1, [0.5], 1), (2, [0.5], 2)]
    assert mined(table(spark, lone)) == [(0, 1, 1, 2, 128 * 128, 128 * 128)]
    with pytest.raises(ValueError):
        mined(table(spark, [(0, [3e9, 1.0], 1), (1, [3e9, 1.0], 1)]))


def test_equal_ids_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.2], 1), (0, [1.0, 0.1], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.0], 2), (2, [0.9, 0.0], 2)]
    assert mined(table(spark, rows)) == brute_mine(rows, lambda i: i % 10 == 0)


def test_cells_are_walked_in_order_of_their_bounds():
    rng = np.random.default_rng(4)
    x = np.floor(256 * rng.normal(size=(500, 8)))
    cells = multi_index.Cells([multi_index.codebook(x[:, :4], 9), multi_index.codebook(x[:, 4:], 9)], 4)
    cell, far = cells.assign(x)
    cells.fill([(int(c), int((cell == c).sum()), far[0][cell == c].max(), far[1][cell == c].max()) for c in np.unique(cell)])
    for v in x[:20]:
        walk = list(cells.walk(v))
        bounds = [b for b, _ in walk]
        assert bounds == sorted(bounds, reverse=True) and sorted(c for _, c in walk) == sorted(set(cell.tolist()))
        score = x @ v
        assert all(score[cell == c].max() <= b for b, c in walk)


def test_anchors_stop_before_all_cells_where_clusters_are_apart(spark, monkeypatch):
    for name, value in (("CELL_ROWS", 20), ("FIRST_ROWS", 50)):
        monkeypatch.setattr(multi_index, name, value)
    read = []
    real = multi_index._visits

    def spy(state, cells, limit):
        out = real(state, cells, limit)
        read.append((out.agg(F.max("seen")).first()[0], len(cells.rows)))
        return out
    monkeypatch.setattr(multi_index, "_visits", spy)
    rng = np.random.default_rng(2)
    centres = np.eye(8) * 3
    rows = [(i, [float(np.float32(c)) for c in centres[i % 8] + rng.normal(size=8) * 0.02], i // 8 % 3) for i in range(2000)]
    assert mined(table(spark, rows)) == brute_mine(rows, lambda i: i % 10 == 0)
    assert max(s for s, _ in read) < read[0][1]


# -- permutation search --------------------------------------------------------------------------
def brute_search(rows, asked, k=10):
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in usable(rows) if any(v)]
    size = Counter(len(v) for _, v in rows)
    best = max(size, key=lambda d: (size[d], d), default=0)
    rows = [r for r in rows if len(r[1]) == best]
    out = []
    for i, v in rows:
        if asked(i):
            near = sorted((math.sqrt(sum((a - b) * (a - b) for a, b in zip(w, v))), j) for j, w in rows if j != i)[:k]
            out += [(i, r + 1, j, d) for r, (d, j) in enumerate(near)]
    return sorted(out)


def searched(df, **kw):
    return sorted(tuple(r) for r in permutation_index.search(df, queries=F.col("vec_id") % 10 == 0, **kw).collect())


def test_search_of_few_rows_is_exact(spark):
    rows = vectors(200, 6, seed=3, copies=60) + EDGES
    assert searched(table(spark, rows)) == brute_search(rows, lambda i: i % 10 == 0)
    assert searched(table(spark, [])) == searched(table(spark, rows[:1])) == []
    assert len(searched(table(spark, rows[98:104]))) == 5
    same = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1)]
    assert searched(table(spark, same)) == [(0, 1, 1, 0.0), (0, 1, 1, 0.0)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_of_the_registered_search(spark, sf):
    t = ds.dataset(f"/root/testdata/{sf}/embeddings.parquet").to_table(columns=["vec_id", "embedding"])
    ids, x = t.column("vec_id").to_numpy(), np.array(t.column("embedding").to_pylist(), float)
    found = {}
    for r in QUERIES["op12_permutation_search"](spark, f"/root/testdata/{sf}").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        got = sorted(found[ids[q]])
        assert [r for r, _, _ in got] == list(range(1, 11)) and [s for _, _, s in got] == sorted(s for _, _, s in got)
        place = {int(i): j for j, i in enumerate(ids)}
        assert all(abs(d[place[i]] - s) < 1e-12 for _, i, s in got)
        best = set(ids[np.argsort(d, kind="stable")[:10]].tolist())
        hits, total = hits + len(best & {i for _, i, _ in got}), total + 10
    assert hits / total >= 0.95


def test_parts_and_blocks_of_the_search(spark, monkeypatch):
    for name, value in (("PART_ROWS", 90), ("BLOCK_QUERIES", 7), ("LEAST", 25), ("PIVOTS", 40), ("PREFIX", 20), ("ASKED", 12)):
        monkeypatch.setattr(permutation_index, name, value)
    rows = vectors(600, 6, seed=5, copies=200)
    want, got = brute_search(rows, lambda i: i % 10 == 0), searched(table(spark, rows), share=0.3)
    assert [r[:2] for r in want] == [r[:2] for r in got]
    pairs = lambda x: {(q, i) for q, _, i, _ in x}
    assert len(pairs(want) & pairs(got)) >= 0.95 * len(want)


def test_footrule_from_inverted_files():
    rng = np.random.default_rng(6)
    perms = np.stack([rng.permutation(12)[:5] for _ in range(50)])
    files = permutation_index.InvertedFiles(perms, 12)
    for q in perms[:10]:
        want = [sum(abs((list(p).index(c) if c in p else 5) - k) for k, c in enumerate(q)) for p in perms]
        assert files.footrule(q).tolist() == want


# -- alignment -----------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def model():
    return alignment.Aligner(public_path(alignment.BYTE_LEVEL), public_path(alignment.PIECES))


def plain_groups(model, text):
    """Groups of whole texts from decoded bytes alone."""
    if not text:
        return None
    raw = (" " + text).encode()
    a, b = model.a.encode(" " + text, add_special_tokens=False).ids, model.b.encode(text)
    ends = []
    for ids, table_ in ((a, model.a_bytes), (b, model.b_bytes)):
        if b"".join(table_[i] for i in ids) != raw:
            return None
        ends.append(np.cumsum([len(table_[i]) for i in ids]).tolist())
    out, i, j = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        p, q = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
        out.append((a[i:p], b[j:q]))
        i, j = p, q
    return out


def brute_align(model, rows):
    groups = [plain_groups(model, t) for _, t in rows]
    links = [Counter((x, y) for xs, ys in g or () for x in xs for y in ys) for g in groups]
    count = Counter(p for k in links for p in k)
    top = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for (i, _), g, k in zip(rows, groups, links):
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in g or ())
        out.append((i, sum(len(xs) for xs, _ in g or ()), sum(len(ys) for _, ys in g or ()), len(g or ()), sum(k.values()),
                    sum(n for p, n in k.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in k.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=repr)


def aligned(df):
    return sorted((tuple(r) for r in alignment.align(df).collect()), key=repr)


ODD = ["Hello  wörld \U0001F600 x\n y", " lead  trail  ", "é", "<s> </s> <0x41> <|endoftext|> é", "a▁b", "ﬁ ½ Å x²2 ²",
       "a\x00b it's we'll 'x,y", "\n\nfoo\nbar\n baz \n  qux", "日本語 テキスト。 x 日", "x  y \u0085 z", "É! É?",
       "\r\n a\r\n\r\nb", " ", "\n", "a \U0001F9D1‍\U0001F680b", "=" * 70 + "a" * 70]


def test_parts_align_like_whole_texts(model):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("abzAZ09 .,'\n\t-éÉ́ßΣİ\x1c \U0001F600<|>▁日² _( )") for _ in range(rng.randint(1, 25)))
                   for _ in range(4000)]
    for t in texts:
        parts = model.parts(" " + t)
        assert "".join(parts) == " " + t
        groups = [model.text[n] for n in model.numbers(parts)]
        want = plain_groups(model, t)
        if want is None:
            assert None in groups
        else:
            assert b";".join(groups).decode() == ";".join(
                ",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want)


def test_alignment_edges(edge, empty, edge_rows, model):
    assert aligned(edge) == brute_align(model, [(i, t) for i, t, _ in edge_rows])
    assert aligned(empty) == []


def test_alignment_in_small_blocks_and_slices(spark, model, monkeypatch):
    # executors run in this process's workers: patched values reach them through the closure's module only when
    # it is called here, so the block is driven directly
    for name, value in (("STEP", 40), ("TABLE_ENTRIES", 30), ("TABLE_CHARS", 4)):
        monkeypatch.setattr(alignment, name, value)
    m = alignment.Aligner(public_path(alignment.BYTE_LEVEL), public_path(alignment.PIECES))
    texts = [t for t in ODD for _ in range(2)] + ["word " * 50 + "end.", "x" * 300, "a▁b " * 40, None, ""]
    block = alignment.Block(m)
    for i, t in enumerate(texts):
        block.add([(i, t)])
    batch = block.batch(7)
    own = batch.slice(batch.num_rows - 1)
    assert own.column("own").to_pylist() == [True]
    pairs = np.frombuffer(own.column("links")[0].as_py(), "<u8")
    docs = np.frombuffer(own.column("times")[0].as_py(), "<u4")
    seen = Counter()
    for i, t in enumerate(texts):
        g = plain_groups(model, t)
        want = Counter(x * m.wide + y for xs, ys in g or () for x in xs for y in ys)
        at = np.frombuffer(batch.column("links")[i].as_py(), "<u4")
        n = np.frombuffer(batch.column("times")[i].as_py(), "<u4")
        assert {int(pairs[a]): int(c) for a, c in zip(at, n)} == dict(want)
        assert batch.column("n_links")[i].as_py() == sum(want.values())
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g or ())
        assert batch.column("sha")[i].as_py() == (hashlib.sha256(text.encode()).hexdigest() if g else "")
        seen.update(want.keys())
    assert {int(p): int(d) for p, d in zip(pairs, docs)} == dict(seen)


def test_registered_alignment_on_whole_documents(spark, model):
    rows = ds.dataset(f"{SF}/documents.parquet").to_table(columns=["doc_id", "text"]).to_pylist()
    got = sorted((tuple(r) for r in QUERIES["op13_token_alignment"](spark, SF).collect()), key=repr)
    assert got == brute_align(model, [(r["doc_id"], r["text"]) for r in rows])


def test_hard_negatives_equal_their_sql(spark):
    import duckdb
    con = duckdb.connect()
    for sf in ("sf0.001", "sf0.1"):
        path = f"/root/testdata/{sf}/embeddings.parquet"
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM read_parquet('{path}')")
        want = sorted(con.execute(ORACLE["op11_hard_negatives"]).fetchall())
        got = sorted(tuple(r) for r in QUERIES["op11_hard_negatives"](spark, f"/root/testdata/{sf}").collect())
        assert got == want and got
