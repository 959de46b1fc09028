"""The pipeline's stages against plain versions of their own input, and what is registered."""

from collections import Counter

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = ["op1_sharding", "op2_bpe", "op3_quality", "op4_fingerprints", "op5_personal_data", "op6_mixing", "op7_lines", "op8_rules", "op9_pages", "op10_jaccard_join"]


def test_registered():
    assert set(NAMES) | {"pipeline"} <= set(entry.queries())


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline
    from quillmill.session import materialize

    tables = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(materialize(stage(spark, tables[-1], SF), "stage"))
    return tables


def test_columns(stages):
    assert all(t.columns == stages[0].columns for t in stages[:-1])


def test_quality_stage(stages):
    from quillmill.llm.quality import judge

    assert {r.doc_id for r in stages[1].collect()} == {r.id for r in judge(stages[0]).collect() if r.kept}


def test_line_stage_only_takes_lines_away(stages):
    before = {r.doc_id: r.text for r in stages[1].collect()}
    for r in stages[2].collect():
        lines = iter(before[r.doc_id].split("\n"))
        assert not r.text or all(line in lines for line in r.text.split("\n"))
        assert r.n_chars == len(r.text)
    assert stages[1].count() == stages[2].count()


def test_one_of_each_group_stays(stages):
    from test_operators import plain_classes

    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    classes = plain_classes(rows, 5, 80, 100)
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted({c[2] for c in classes if c[1]} | {c[0] for c in classes if not c[1]})


def test_mixture_draws_from_its_input(stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    after = stages[4].collect()
    assert all(before[r.doc_id] == r for r in after)
    assert 0.6 * len(before) < len(after) < 1.6 * len(before)


def test_tokens_of_every_row(stages):
    pytest.importorskip("public_tokenizers")
    last = stages[5].collect()
    assert Counter(r.doc_id for r in last) == Counter(r.doc_id for r in stages[4].collect())
    assert all(r.exact and r.n_tokens == len(r.ids) for r in last)
