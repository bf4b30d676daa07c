import random
import re

import pytest

from martloom.llm import license_scan as s
from martloom.llm.queries import QUERIES, read

LOWER = {i: i + 32 for i in range(65, 91)}
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def places(words, phrase):
    p = phrase.split()
    return [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]


def plain_base(text):
    words = words_of(text)
    found = [(i, label) for phrase, label in PHRASES.items() for i in places(words, phrase)]
    starts = [i for i, _ in found]
    labels = ",".join(sorted({label for _, label in found}))
    return len(words), len(found), min(starts, default=None), max(starts, default=None), labels


def base_of(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def phrase_labels(text):
    """Labels of all short templates, which are exact."""
    words = words_of(text)
    return {t.label for t in s.TEMPLATES if len(t.text.split()) < s.FUZZY_WORDS and places(words, t.text)}


def test_query_equals_plain_version(spark, sf_dir):
    texts = {r.doc_id: r.text for r in read(spark, sf_dir, "documents").collect()}
    rows = QUERIES["op2_license_scan"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    assert any(r.n_base for r in rows)
    for r in rows:
        assert base_of(r) == plain_base(texts[r.doc_id])
        assert set(filter(None, r.labels.split(","))) >= phrase_labels(texts[r.doc_id])
        assert r.score == (1.0 if r.labels else 0.0) or 0.8 <= r.score <= 1


def test_odd_rows(make_docs, odd_rows):
    rows = [r[:2] for r in odd_rows] + [
        (20, "MIT License. mit-license\nCC BY-NC 4.0, CC BY; GNU General Public License, version 3!"),
        (21, "Apache Licenses; apache\x00license éapache license apache licenseé"),
        (22, "mit license " * 400),
    ]
    found = s.scan(make_docs(rows)).collect()
    key = lambda t: tuple((x is not None, x or 0) for x in t)
    expected = sorted(((i, *plain_base(t)) for i, t in rows), key=key)
    assert sorted(((r.doc_id, *base_of(r)) for r in found), key=key) == expected
    labels = {r.doc_id: r.labels for r in found}
    assert labels[20] == "cc-by,cc-by-nc,gpl,gpl-3.0,mit"
    assert s.scan(make_docs([])).isEmpty()


LONG = [t for t in s.TEMPLATES if len(t.text.split()) >= s.FUZZY_WORDS]


@pytest.fixture(scope="module")
def passages():
    """(text, label expected or None): templates whole, with edits, and with too many of them."""
    rng = random.Random(11)
    filler = lambda n: [f"f{rng.randrange(10**6)}" for _ in range(n)]
    out = []
    for t in LONG:
        words = t.text.split()
        allowed = s.edits_allowed(len(words))
        for edits in (0, 1, allowed, allowed + 4):
            w = list(words)
            for at in sorted(rng.sample(range(1, len(w) - 1), min(edits, len(w) - 2)), reverse=True):
                kind = rng.randrange(3) if edits <= allowed else 0
                w[at : at + (kind != 1)] = [] if kind == 2 else filler(1)
            out.append((" ".join([*filler(rng.randrange(40)), *w, *filler(rng.randrange(40))]), t, edits <= allowed))
    return out


def test_passages_with_edits(make_docs, passages):
    found = {r.doc_id: r for r in s.scan(make_docs([(i, p[0]) for i, p in enumerate(passages)])).collect()}
    for i, (text, template, there) in enumerate(passages):
        labels = set(filter(None, found[i].labels.split(",")))
        if there:
            assert template.label in labels
        else:
            assert labels == phrase_labels(text)


def test_alignment_is_the_least_number_of_edits():
    rng = random.Random(2)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j - 1] + (x != y), last[j] + 1, row[-1] + 1))
        return row[-1]

    for _ in range(60):
        a = [rng.randrange(4) for _ in range(rng.randrange(1, 8))]
        b = [rng.randrange(4) for _ in range(rng.randrange(0, 12))]
        cost, first, end = s.align(a, b)
        assert cost == min(distance(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert distance(a, b[first:end]) == cost


def spans_of(docs):
    rows = s.license_spans(docs).collect()
    return sorted((r.doc_id, r.label, r.base, r.first_word, r.end_word, r.similarity) for r in rows)


def test_ranges_of_diagonals_give_the_same_spans(make_docs, monkeypatch):
    """Passages edited, cut short and run into each other, over many ranges or one."""
    rng = random.Random(5)
    texts = []
    for _ in range(8):
        words = []
        for _ in range(30):
            w = rng.choice(LONG).text.split()
            for at in sorted(rng.sample(range(len(w)), rng.randrange(4)), reverse=True):
                w[at : at + 1] = rng.choice([[], ["x"], [w[at], "y"]])
            words += w[rng.randrange(3) :] + ["z"] * rng.choice([0, 0, 1, 7])
        texts.append(" ".join(words))
    docs = make_docs(list(enumerate(texts)))
    monkeypatch.setattr(s, "RANGE", 1 << 30)
    whole = spans_of(docs)
    assert any(0.8 <= row[5] < 1 for row in whole)
    for size in (64, 7):
        monkeypatch.setattr(s, "RANGE", size)
        assert spans_of(docs) == whole


def test_a_document_of_one_passage_over_and_over(make_docs):
    passage, n = "redistribution and use in source and binary forms with or without modification are " \
        "permitted provided that the following conditions are met", 20_000
    found = spans_of(make_docs([(1, f"{passage} " * n)]))
    size = len(passage.split())
    assert found == [(1, "bsd", False, i * size, (i + 1) * size, 1.0) for i in range(n)]


def test_of_overlapping_places_the_best_stays():
    template = list(range(100, 120))
    words = template[:18] + template + [0, 0, 0] + template[3:]

    def vote(at):
        first = max(at - 4, 0)
        hits = [t for t in range(18) if 0 <= at + t <= len(words) - 3 and words[at + t : at + t + 3] == template[t : t + 3]]
        return {"diagonal": at, "hits": hits, "first": first, "window": words[first : at + 24]}

    votes = [v for v in map(vote, range(len(words))) if v["hits"]]
    assert [p[1:] for p in s.verified_places(votes, template)] == [(0, 18, 0.9), (18, 38, 1.0), (38, 58, 0.85)]
