import random
import re
from itertools import combinations

import pytest

from martloom.llm import decontamination as d
from martloom.llm.queries import QUERIES, read


def words_of(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()) if w]


def plain_leaks(docs, items, how=d.Overlap()):
    """Every item on every diagonal that shares a seed of a mask."""
    found = {}
    for item_id, text in items:
        item = words_of(text)
        width = min(len(item), how.window)
        for doc_id, body in docs:
            words = words_of(body)
            for diagonal in range(-len(item) + 1, len(words)):
                pairs = [(words[diagonal + i], w) for i, w in enumerate(item) if 0 <= diagonal + i < len(words)]
                equal = [a == b for a, b in pairs]
                if len(equal) < width:
                    continue
                hit = any(
                    all(equal[i + j] for j, bit in enumerate(m) if bit == "1")
                    for m in d.masks_of(len(item), how)
                    for i in range(len(equal) - len(m) + 1)
                )
                best = max(sum(equal[i : i + width]) for i in range(len(equal) - width + 1))
                if hit and best >= how.similarity * width:
                    found[doc_id, item_id] = max(found.get((doc_id, item_id), 0), sum(equal))
    return found


def rows_of(df):
    return {(r.doc_id, r.item_id): r.n_equal for r in df.collect()}


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([5, 6, 9, 15, 30, 57, 30])]
    items += [(None, items[4][1]), (8, None), (9, ""), (3, items[3][1])]
    docs = [(100 + i, " ".join(word() for _ in range(120))) for i in range(6)]
    for i, (item_id, text) in enumerate(items[:7]):
        own = text.upper().split()
        filler = [word() for _ in range(30)]
        docs.append((200 + i, ", ".join([*filler, *own, *filler])))
        docs.append((300 + i, " ".join(own)))
        changed = [w if j % 6 != 5 else word() for j, w in enumerate(own)]
        docs.append((400 + i, " ".join([*filler, *changed, *filler])))
        docs.append((500 + i, " ".join([*filler, *own[: len(own) // 2], *filler])))
        mangled = [w if j % 2 else word() for j, w in enumerate(own)]
        docs.append((600 + i, " ".join([*filler, *mangled])))
    return docs, items


def test_equals_all_diagonals(spark, make_docs, planted, odd_rows):
    docs, items = planted
    docs = [*docs, *odd_rows[:4], *odd_rows[6:8], (None, docs[7][1]), (300, docs[20][1])]
    docs = [r[:2] for r in docs]
    benchmark = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, words string")
    found = rows_of(d.leaks(make_docs(docs), benchmark))
    assert found == plain_leaks(docs, items)
    # Every item of six words and more is found whole, and with one word in six replaced.
    assert {(200 + i, i) for i in range(1, 7)} <= found.keys()
    assert {(400 + i, i) for i in range(3, 7)} <= found.keys()


def test_blocks_of_items_give_the_same(spark, make_docs, planted, monkeypatch):
    docs, items = planted
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = rows_of(d.leaks(make_docs(docs), benchmark))
    monkeypatch.setattr(d, "SEEDS_PER_PASS", 60)
    assert rows_of(d.leaks(make_docs(docs), benchmark)) == whole


def test_query_equals_plain_version(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").collect()]
    items = [(r.item_id, r.text) for r in read(spark, sf_dir, "benchmark").collect()]
    seeds = {tuple(w[i : i + 3]) for w in (words_of(t) for _, t in items) for i in range(len(w) - 2)}
    near = []
    for doc_id, text in docs:  # only what shares three words in a row can hold thirteen of sixteen
        w = words_of(text)
        if sum(tuple(w[i : i + 3]) in seeds for i in range(len(w) - 2)) >= 3:
            near.append((doc_id, text))
    found = rows_of(QUERIES["op1_decontamination"](spark, sf_dir))
    assert found
    assert found == plain_leaks(near, items)


def test_clean_documents_stay(spark, make_docs, planted, odd_rows):
    docs, items = planted
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = make_docs([*docs, *odd_rows])
    kept = d.decontaminated(frame, benchmark)
    assert kept.columns == frame.columns
    bad = {doc for doc, _ in plain_leaks(docs, items)}
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(i or 0 for i, *_ in [*docs, *odd_rows] if i not in bad)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert d.leaks(frame, empty).isEmpty()
    assert d.leaks(make_docs([]), benchmark).isEmpty()


def test_texts_that_share_an_id_are_told_apart(spark, make_docs):
    item = [f"w{i}" for i in range(20)]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    leak = " ".join(item)
    # The same diagonal, hit by a seed only: two words of three differ beyond the first six.
    chance = " ".join([*item[:6], *[w if i % 3 == 0 else f"x{i}" for i, w in enumerate(item[6:])]])
    clean = "nothing of any benchmark stands in this text at all"
    # Chance hits first and last in each id, over several partitions.
    rows = [(i, t) for i in (None, 7) for t in [*[f"{chance} {k}" for k in range(40)], leak, clean]]
    rows += [(None, f"{chance} z"), (7, f"{chance} z"), (None, None), (7, None)]
    frame = make_docs(rows)
    assert rows_of(d.leaks(frame, benchmark)) == {(None, 1): 20, (7, 1): 20}
    assert rows_of(d.leaks(frame.coalesce(1), benchmark)) == {(None, 1): 20, (7, 1): 20}
    kept = [(r.doc_id, r.text) for r in d.decontaminated(frame, benchmark).collect()]
    order = lambda r: (r[0] or 0, r[1] or "")
    assert sorted(kept, key=order) == sorted((r for r in rows if r[1] != leak), key=order)


def test_every_admitted_pattern_is_found(spark, make_docs):
    """Items of 1 to 14 words with every set of up to three words replaced, without seeds."""
    items = [(n, " ".join(f"i{n}w{j}" for j in range(n))) for n in range(1, 15)]
    docs, expected = [], set()
    for n, text in items:
        width = min(n, 13)
        for k in range(min(n, 3) + 1):
            for places in combinations(range(n), k):
                words = [f"x{j}" if j in places else w for j, w in enumerate(text.split())]
                equal = [j not in places for j in range(n)]
                best = max(sum(equal[i : i + width]) for i in range(n - width + 1))
                if best >= 0.8 * width:
                    expected.add((len(docs), n))
                docs.append((len(docs), " ".join(["before", "it", *words, "and", "after"])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = make_docs(docs)
    assert rows_of(d.leaks(frame, benchmark)).keys() == expected
    # Each kind of item also on its own, when documents get no seeds for the others.
    for low, high in ((1, 1), (4, 5), (6, 6), (7, 7), (8, 14)):
        some = benchmark.where(f"item_id BETWEEN {low} AND {high}")
        assert rows_of(d.leaks(frame, some)).keys() == {x for x in expected if low <= x[1] <= high}


@pytest.mark.parametrize(
    "how",
    [{"similarity": 0.7}, {"masks": d.MASKS_OF_LONG}, {"similarity": 0.0}, {"similarity": 0.75}],
)
def test_rules_that_masks_do_not_cover_are_refused(how):
    with pytest.raises(ValueError, match="no mask survives"):
        d.Overlap(**how)


def test_stricter_rules_are_covered():
    d.Overlap(similarity=0.9)
    d.Overlap(window=8, similarity=0.85)
    d.Overlap(similarity=1.0)
