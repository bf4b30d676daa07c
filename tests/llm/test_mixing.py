import heapq
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import mixing
from martloom.llm.queries import QUERIES
from tests.llm.test_quality_rules import words_of


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Rounds of water filling over sizes by source, None last."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        shared = sum(weight[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else weight[s] * left / shared for s in names}
        over = {s for s in names if s not in capped and target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


def check(docs, mix=mixing.Mix()):
    rows = mixing.mixture(docs, mix).collect()
    texts = docs.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in texts)
    sizes = defaultdict(int)
    for r in texts:
        sizes[r.source] += len(words_of(r.text or ""))
    target = plain_targets(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for source, total in taken.items():
        # Rounding to blocks, and to whole blocks in about sqrt(documents) shards.
        assert abs(total - target[source]) <= 2 * mix.block_words + 0.01 * target[source], source
    return rows


def test_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = check(docs)
    again = QUERIES["op6_source_mixing"](spark, sf_dir).collect()
    assert Counter((r.doc_id, r.taken) for r in rows) == Counter((r.doc_id, r.taken) for r in again)


def text(n):
    return " ".join(f"w{i}" for i in range(n))


def test_odd_rows(make_docs, odd_rows):
    sources = ["b", "a", None, "", "é", "Z"]
    rows = [(i, t, "en", sources[k % 6]) for k, (i, t, *_) in enumerate(odd_rows)]
    rows += [(100 + i, text(20 + i), "en", sources[i % 6]) for i in range(300)]
    check(make_docs(rows))
    assert mixing.mixture(make_docs([])).isEmpty()
    assert mixing.mixed(make_docs([])).isEmpty()
    assert {r.taken for r in mixing.mixture(make_docs([(1, None), (2, "")])).collect()} == {0}


def test_mix_holds_the_words_taken(make_docs, odd_rows):
    rows = [(i, f" {text(30 + i)}\n", "en", "abc"[i % 3]) for i in range(200)]
    rows += [(7, "same words twice over", "en", "b")] * 2 + odd_rows
    docs = make_docs(rows)
    taken = defaultdict(int)
    for r in mixing.mixture(docs).collect():
        taken[r.doc_id] += r.taken
    originals = defaultdict(set)
    for i, t, *_ in rows:
        originals[i].add(t or "")
    found = defaultdict(int)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        found[r.doc_id] += len(words_of(r.text))
        assert any(r.text in t for t in originals[r.doc_id])
        assert r.n_chars == len(r.text)
        assert r.label == "l"
    assert {k: v for k, v in taken.items() if v} == dict(found)


def plain_quotas(shares, seats):
    """Seat by seat to the highest quotient, ties to the lesser party."""
    quota = [0] * len(shares)
    heap = [(-s / 1, i) for i, s in enumerate(shares) if s > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, i = heapq.heappop(heap)
        quota[i] += 1
        heapq.heappush(heap, (-shares[i] / (2 * quota[i] + 1), i))
    return quota


GROUP = st.tuples(
    st.lists(st.one_of(st.just(0), st.integers(1, 30), st.integers(1, 10**6)), min_size=1, max_size=25),
    st.integers(0, 400),
)


@given(st.lists(GROUP, min_size=30, max_size=30))
@settings(max_examples=3, deadline=None)
def test_quotas_are_the_highest_quotients(spark, groups):
    rows = [(g, i, float(s), seats) for g, (shares, seats) in enumerate(groups) for i, s in enumerate(shares)]
    parties = spark.createDataFrame(rows, "g int, party int, share double, seats long")
    found = defaultdict(dict)
    for r in mixing.apportion(parties, "g", "party", "share", "seats").collect():
        found[r.g][r.party] = r.quota
    for g, (shares, seats) in enumerate(groups):
        assert [found[g][i] for i in range(len(shares))] == plain_quotas(shares, seats), groups[g]
