import hashlib
import math
import re
import zlib
from collections import Counter

from martloom.llm import target_resampling as resampling
from tests.llm.conftest import LONG

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def plain(rows, target):
    """(doc_id, n_features, weight, score, rank), without segments; ties of ids left out."""
    s = Counter(bucket(f) for _, text, *_ in rows for f in features(text)[1])
    t = Counter(bucket(f) for text in target for f in features(text)[1])
    S, T = s.total(), t.total()
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000))))
        for b in range(10_000)
    ]
    out = []
    for doc_id, text, *_ in rows:
        words, own = features(text)
        weight = sum(gain[bucket(f)] for f in own) // len(own) if own else 0
        key = f"7:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(own), weight, score, None, len(words)])
    order = lambda r: (-r[3], -(2**63) if r[0] is None else r[0])
    eligible = sorted((r for r in out if r[5] >= 20), key=order)
    for rank, row in enumerate(eligible[: 25 * len(eligible) // 100], 1):
        row[4] = rank
    return Counter(tuple(r[:5]) for r in out)


def found(docs, target):
    rows = resampling.resample(docs, target)
    return Counter(map(tuple, rows.select("doc_id", "n_features", "weight", "score", "rank").collect()))


ROWS = [
    *[(i, "\n".join(f"line {j % 7} of document {i % 9} and more" for j in range(i % 5))) for i in range(100)],
    (200, "One, two\n\n \nthree\r\n--\nfour"),
    (201, "ÀÉ Éé İstanbul ß  no-break 42nd\n\U0001f600 x"),
    (202, "\n".join(["the same line in every place of the text"] * 500)),
]
TARGET = ["line 3 of document and more", None, "", "Istanbul four five\nsix"]


def benchmark(spark, texts):
    rows = [(i, x) for i, x in enumerate(texts)]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_equals_plain_version(spark, make_docs, odd_rows):
    rows = ROWS + odd_rows
    assert found(make_docs(rows), benchmark(spark, TARGET)) == plain(rows, TARGET)


def test_equals_plain_version_on_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = [tuple(r) for r in docs.collect()]
    assert found(docs, target) == plain(rows, [r["text"] for r in target.collect()])


def test_empty_tables(spark, make_docs):
    assert found(make_docs([]), benchmark(spark, TARGET)) == Counter()
    rows = [(i, f"some words of text number {i} " * 6) for i in range(8)]
    assert found(make_docs(rows), benchmark(spark, [])) == plain(rows, [])


def test_lines_are_counted_once(make_docs):
    docs = make_docs([(i, "A line, twice\na  LINE twice!\nend") for i in range(50)])
    counted = {tuple(r) for r in resampling.segment_counts(docs).collect()}
    assert counted == {
        ("a line twice", False, 100),
        ("end", False, 50),
        ("twice a", True, 50),
        ("twice end", True, 50),
    }


def test_repeated_rows_are_each_ranked(spark, make_docs):
    docs = make_docs([(5, LONG)] * 8 + [(None, LONG)] * 4)
    rows = resampling.resample(docs, benchmark(spark, TARGET)).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1, 2, 3]
