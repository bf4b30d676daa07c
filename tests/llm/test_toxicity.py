import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from martloom.llm import toxicity
from martloom.llm.words import blocks
from tests.llm.conftest import LONG

INSULTS = {"gribble": 4.0, "snorfle": 2.0, "ünflat": 3.0}
LABELS = "doc_id long, toxic int"


def known(insults=INSULTS):
    words = list(insults)
    heads = np.array([int.from_bytes(w.encode()[:3].ljust(3, b"\0")) for w in words])
    return toxicity.lexicon(toxicity._hash_of(words), np.array(list(insults.values())), heads)


def figures(texts, lexicon=None):
    lexicon = lexicon or known()
    return np.concatenate([toxicity.evidence(b, lexicon) for b in blocks(pa.array(texts))])


def kinds(text):
    return figures([text])[0, : toxicity.N_KINDS].tolist()


@pytest.mark.parametrize(
    "text, expected",
    [
        ("what a gribble", [4, 0, 0, 0, 0]),
        ("What a GRIBBLE, what a gribble", [4, 0, 0, 0, 0]),
        ("you gribble and snorfle", [0, 6, 0, 0, 0]),
        ("you. a gribble", [4, 0, 0, 0, 0]),
        ("not a gribble", [0, 0, 4, 0, 0]),
        ("not in any way at all a gribble", [4, 0, 0, 0, 0]),
        ("not a gribble but a snorfle", [2, 0, 4, 0, 0]),
        ("he said gribble", [0, 0, 0, 4, 0]),
        ("he said so. gribble", [4, 0, 0, 0, 0]),
        ('the word "gribble" and you snorfle', [0, 2, 0, 4, 0]),
        ("das Wort „gribble“ und ünflat", [3, 0, 0, 4, 0]),
        ("le mot «gribble» et snorfle", [2, 0, 0, 4, 0]),
        ('an open " here\ngribble', [4, 0, 0, 0, 0]),
        ("I will kill you", [0, 0, 0, 0, 3]),
        ("you I will kill", [0, 0, 0, 0, 3]),
        ("kill the process", [0, 0, 0, 0, 0]),
        ("kill the process now and then you", [0, 0, 0, 0, 0]),
        ("never kill you", [0, 0, 0, 0, 0]),
        ("she said he would kill you", [0, 0, 0, 0, 0]),
        ("gribbles and ungribble", [0, 0, 0, 0, 0]),
        ("", [0, 0, 0, 0, 0]),
        (None, [0, 0, 0, 0, 0]),
    ],
)
def test_clauses(text, expected):
    assert kinds(text) == expected


MACHINES = [toxicity._reporting(), toxicity._negating(), toxicity._aiming(), toxicity._threatening()]


def plain(text):
    """Sums by kind, heaviest clause and matched clauses, machine after machine."""
    text = re.sub("[“”„«»]", '"', text or "").translate({i: i + 32 for i in range(65, 91)})
    sums, heaviest, matched, counted = [0.0] * 5, 0.0, 0, set()
    names = [
        ("insult", INSULTS),
        ("threat", toxicity.THREATS),
        ("target", toxicity.TARGETS),
        ("negation", toxicity.NEGATIONS),
        ("report", toxicity.REPORTS),
    ]
    for line in text.split("\n"):
        symbols, gap = [], 0
        for token in re.findall(r"[0-9a-z\x80-\U0010ffff]+|[\".!?;:]", line):
            if token == '"':
                symbols += ["words"] * (gap >= toxicity.NEGATED_WORDS) + [("quote", token)]
                gap = 0
                continue
            if token in ".!?;:":
                symbols.append("end")
                continue
            symbol = next((n for n, words in names if token in words), None)
            if symbol is None:
                gap += 1
                continue
            symbols += ["words"] * (gap >= toxicity.NEGATED_WORDS) + [(symbol, token)]
            gap = 0
        if not any(s[0] in ("insult", "threat") for s in symbols if isinstance(s, tuple)):
            continue
        states, clause = [m.start for m in MACHINES], 0.0
        for item in symbols + ["end"]:
            symbol, token = item if isinstance(item, tuple) else (item, None)
            ended = symbol == "end"
            for i, machine in enumerate(MACHINES):
                states[i], symbol = machine.step(states[i], symbol)
            if symbol in toxicity._OUTCOMES:
                kind = toxicity._OUTCOMES[symbol]
                own = INSULTS.get(token, toxicity.THREAT_WEIGHT)
                clause += own
                if (kind, token) not in counted:
                    counted.add((kind, token))
                    sums[kind] += own
            if ended and clause:
                heaviest, matched, clause = max(heaviest, clause), matched + 1, 0.0
    return [*sums, heaviest, matched]


def test_equals_plain_version():
    random.seed(3)
    words = [*INSULTS, "kill", "hurt", "you", "dich", "not", "said", "the", "of", "and", "ßß"]
    marks = [" ", " ", " ", " ", " ", ". ", "; ", "\n", ' "', '" ', " „", "“ "]
    texts = ["".join(random.choice(words) + random.choice(marks) for _ in range(n)) for n in range(300)]
    got = figures(texts)
    got[:, 6] = np.rint(np.expm1(got[:, 6]))
    assert np.array_equal(got[:, :7], np.array([plain(t) for t in texts]))


def test_texts_do_not_touch_each_other():
    texts = ["you", "gribble", "not", "gribble", "said", None, "gribble"]
    assert [row[0] for row in figures(texts).tolist()] == [0, 4, 0, 4, 0, 0, 4]


def made(n, seed):
    """Documents in two languages, every fourth toxic by words of two families of stems."""
    random.seed(seed)
    rows = []
    for i in range(n):
        words = ["".join(random.choices(["ka", "lo", "mi", "ren", "öt"], k=random.randrange(1, 4))) for _ in range(60)]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(3):
                words[random.randrange(60)] = random.choice(["zwack", "brötz"]) + random.choice(["", "ka", "lo", "mi"])
        rows.append((i, " ".join(words), toxic))
    return rows


def split(spark, make_docs, rows):
    docs = make_docs([r[:2] for r in rows])
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows], LABELS)


def test_held_out_accuracy(spark, make_docs):
    rows = made(600, 1)
    docs, labels = split(spark, make_docs, rows)
    scored = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert all(scored[r[0]]["held_out"] == (r in held) for r in rows)
    right = [scored[r[0]]["predicted"] == r[2] for r in held]
    assert len(right) > 80 and sum(right) / len(right) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored.values())


def test_held_out_labels_are_not_learned(spark, make_docs):
    rows = made(300, 2)
    docs, labels = split(spark, make_docs, rows)
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, _, t in rows]
    turned += [(None, 1), (5, None), (10**9, 1)]
    other = spark.createDataFrame(turned, LABELS)
    scores = [sorted((r["doc_id"], r["score"]) for r in toxicity.toxicity(docs, x).collect()) for x in (labels, other)]
    assert scores[0] == scores[1]


def test_odd_rows(spark, make_docs, odd_rows):
    rows = made(200, 4)
    _, labels = split(spark, make_docs, rows)
    docs = make_docs([r[:2] for r in rows] + [(i if i is None else i + 1_000, x) for i, x, *_ in odd_rows])
    found = [r for r in toxicity.toxicity(docs, labels).collect() if r["doc_id"] is None or r["doc_id"] >= 1_000]
    assert len(found) == len(odd_rows)
    assert {r["score"] for r in found if r["doc_id"] in (1_001, 1_002)} == {
        r["score"] for r in found if r["doc_id"] is None and r["clauses"] == 0
    }
    assert all(r["held_out"] for r in found if r["doc_id"] is None)
    assert toxicity.toxicity(make_docs([]), labels).isEmpty()


def test_without_labels_of_both_classes(spark, make_docs):
    docs = make_docs([(1, "a text"), (2, LONG), (3, None)])
    for rows in ([], [(1, 0), (2, 0)], [(None, 1)]):
        scored = toxicity.toxicity(docs, spark.createDataFrame(rows, LABELS)).collect()
        assert [r["score"] for r in scored] == [0.0] * 3 and not any(r["predicted"] for r in scored)


def test_copies_count_once(spark, make_docs):
    rows = [(i, "one text that many share", 1) for i in range(50)] + [(i, f"other {i}", 0) for i in range(50, 90)]
    docs, labels = split(spark, make_docs, rows)
    assert toxicity.sample(docs, labels).where("toxic").count() == 1
