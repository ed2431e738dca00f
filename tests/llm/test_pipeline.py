"""The pipeline, stage by stage, against plain versions; and how the entry point finds it."""

import subprocess
import sys

import pytest

import __spark_entry__ as E
import corpus_pipeline
from seasonflow.llm.common import Scratch

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    scratch = Scratch(spark)
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(scratch.save(stage(spark, docs[-1], SF), "test"))
    return docs


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stage_columns(stages):
    for df in stages[:-1]:
        assert df.dtypes == stages[0].dtypes


def test_quality_stage_drops_what_the_rules_reject(stages):
    rows = [(r.doc_id, r.text, r.source) for r in stages[0].select("doc_id", "text", "source").collect()]
    want = [(i, t) for (i, t, _), (_, kept) in zip(rows, brute.judged(rows)) if kept]
    assert brute.bag(texts(stages[1])) == brute.bag(want) and len(want) < stages[0].count()


def test_line_stage(stages):
    want = [(i, kept) for i, _, _, kept in brute.line_dedup(texts(stages[1]))]
    assert brute.bag(texts(stages[2])) == brute.bag(want)
    assert stages[2].where("n_chars <> length(text)").count() == 0


def test_near_duplicate_stage_keeps_one_of_each_group(stages):
    rows = texts(stages[2])
    want = {i for i, _, c in brute.link_groups(rows, 5, 80) if i == c}
    assert sorted(i for i, _ in texts(stages[3])) == sorted(want)
    assert set(texts(stages[3])) <= set(rows)


def test_mixing_stage_repeats_whole_documents(stages):
    before = {(r.doc_id, r.text): (r.source, len(brute.WORD.findall(r.text))) for r in stages[3].collect()}
    size = {}
    for s, n in before.values():
        size[s] = size.get(s, 0) + n
    got = brute.bag(texts(stages[4]))
    assert set(got) <= set(before) and max(got.values()) <= 3
    for s, target in brute.targets(size).items():
        largest = max(n for k, (x, n) in before.items() if x == s)
        taken = sum(c * before[k][1] for k, c in got.items() if before[k][0] == s)
        assert abs(taken - target) <= largest


def test_packing_stage_holds_every_token_once(stages):
    docs = texts(stages[4])
    rows = stages[5].collect()
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in windows.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 4096
    assert sum(r.start == 0 for r in rows) == len(docs)
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    total = sum(r.length for r in rows)
    assert len(windows) <= -(-total // 4096) + 2 + len(windows) // 20


def test_empty_table_passes_all_stages(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_edge_rows_pass_all_stages(spark, edge):
    docs, scratch = edge, Scratch(spark)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = scratch.save(stage(spark, docs, SF), "edge")
        assert docs.count() > 0
        if i < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
    assert docs.where("length <= 0 OR offset < 0").count() == 0


def test_registered_names():
    names = list(E.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1


def test_entry_point_without_the_subpackage():
    code = ("import sys; sys.modules['seasonflow.llm'] = None; import __spark_entry__ as E; "
            "assert len(E.queries()) >= 100 and not [x for x in E.queries() if x == 'pipeline' or x[:2] == 'op' and x[2].isdigit()]")
    root = E.__file__.rsplit("/", 1)[0]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
