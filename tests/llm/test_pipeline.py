"""Each stage of the pipeline on its own input, against the plain version of its contract."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm.test_quality_rules_whole import judged_plainly
from tests.llm.test_operators import contaminated_plainly, groups_plainly, lines_plainly, prints_plainly


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        result = corpus_pipeline.written(stage(spark, docs, sf_dir))
        out.append((name, docs, result))
        docs = result
    return out


def test_stage_order_and_columns(stages):
    assert [n for n, _, _ in stages] == ["quality_rules", "line_dedup", "simhash_dedup", "decontaminate", "packing"]
    for _, before, after in stages[:-1]:
        assert after.schema.simpleString() == before.schema.simpleString()


def test_quality(stages):
    _, before, after = stages[0]
    rows = before.collect()
    kept = judged_plainly([(r.lang, r.text) for r in rows])[1]
    want = sorted(repr(r) for r, k in zip(rows, kept) if k)
    assert sorted(map(repr, after.collect())) == want and len(want) > 0.7 * len(rows)


def test_lines(stages):
    _, before, after = stages[1]
    want = {i: t for i, _, _, t in lines_plainly([(r.doc_id, r.text) for r in before.collect()])}
    got = after.collect()
    assert {r.doc_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_near_duplicates(stages):
    _, before, after = stages[2]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = set(groups_plainly(rows, [prints_plainly(t) for _, t in rows]))
    assert {r.doc_id for r in after.collect()} == want


def test_contamination(spark, sf_dir, stages):
    _, before, after = stages[3]
    bench = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {x[0] for x in contaminated_plainly([(r.doc_id, r.text) for r in before.collect()], bench) if not x[4]}
    assert {r.doc_id for r in after.collect()} == want


def test_run_equals_the_stages(spark, sf_dir, stages):
    got = sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()), key=repr)
    assert got == sorted(map(tuple, stages[-1][2].collect()), key=repr)
