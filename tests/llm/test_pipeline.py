"""The whole pipeline, stage by stage, against plain versions of each stage's decision."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from martloom.llm import quality_rules
from martloom.llm.queries import END_ID, read
from martloom.llm.token_orc import default_tokenizer
from martloom.sources.scratch import stored
from tests.llm.test_decontamination import plain_leaks
from tests.llm.test_mixing import plain_targets
from tests.llm.test_quality_rules import words_of
from tests.llm.test_simhash import expected_ids

N_STAGES = 5


@pytest.fixture(scope="module")
def outputs(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], sf_dir)))
    return found


def test_columns(outputs):
    assert len(outputs) == N_STAGES + 1
    for frame in outputs[1:-1]:
        assert frame.columns == outputs[0].columns


def test_quality_keeps_what_the_operator_keeps(spark, outputs, sf_dir):
    judged = quality_rules.judge(outputs[0], read(spark, sf_dir, "labels"))
    assert {r.doc_id for r in outputs[1].collect()} == {r.doc_id for r in judged.where("kept").collect()}
    assert outputs[1].count() < outputs[0].count()


def test_one_document_of_each_group_stays(outputs):
    rows = [(r.doc_id, r.text) for r in outputs[1].collect()]
    expected = {i for i, _, component in expected_ids(rows) if i == component}
    assert sorted(r.doc_id for r in outputs[2].collect()) == sorted(expected)
    assert len(expected) < len(rows)


def test_leaked_documents_go(spark, outputs, sf_dir):
    rows = [(r.doc_id, r.text) for r in outputs[2].collect()]
    items = [(r.item_id, r.text) for r in read(spark, sf_dir, "benchmark").collect()]
    starts = {tuple(words_of(t.lower())[:3]) for _, t in items}
    near = [(i, t) for i, t in rows if any(" ".join(s) in " ".join(words_of(t.lower())) for s in starts)]
    bad = {i for i, _ in plain_leaks(near, items)}
    assert bad
    assert sorted(r.doc_id for r in outputs[3].collect()) == sorted(i for i, _ in rows if i not in bad)


def test_sources_meet_their_targets(outputs):
    sizes, taken = defaultdict(int), defaultdict(int)
    texts = {}
    for r in outputs[3].collect():
        sizes[r.source] += len(words_of(r.text))
        texts[r.doc_id] = r.text
    for r in outputs[4].collect():
        taken[r.source] += len(words_of(r.text))
        assert r.text in texts[r.doc_id]
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= 32 + 0.01 * target


def test_tokens_of_the_mix(outputs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    rows = outputs[5].collect()
    lengths = Counter(
        (r.doc_id, len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1)
        for r in outputs[4].collect()
    )
    assert END_ID == 2
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == lengths
    rows.sort(key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))


def test_run_and_odd_rows(spark, outputs, sf_dir, make_docs, odd_rows):
    run = Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))
    assert run == Counter(map(tuple, outputs[-1].collect()))
    for rows in ([], odd_rows):
        docs = make_docs(rows)
        for name, stage in corpus_pipeline.STAGES:
            after = stored(stage(spark, docs, sf_dir))
            assert name == "token_orc" or after.columns == docs.columns
            if name != "quality_rules" or not rows:  # which leaves only the long text
                docs = after
        assert (docs.count() > 0) == bool(rows)
