import random

import numpy as np
import pytest
import xxhash

from martloom.llm import components, groups, simhash
from martloom.llm.queries import QUERIES, read


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints, max_bits=4):
    """Index of each one's root: all pairs."""
    root = list(range(len(fingerprints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    values = np.array(fingerprints, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1 :]) <= max_bits):
            root[find(i)] = find(i + 1 + int(j))
    return [find(i) for i in range(len(values))]


def expected_ids(rows, max_bits=4):
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    roots = plain_components(fps, max_bits)
    least = {}
    for (doc_id, *_), r in zip(rows, roots):
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    return [(i, fp, least.get(r)) for (i, *_), fp, r in zip(rows, fps, roots)]


def key(row):
    return tuple((x is not None, x or 0) for x in row)


def test_query_equals_all_pairs(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").collect()]
    found = [
        (r.doc_id, int(r.fingerprint, 16), r.component_id)
        for r in QUERIES["op7_simhash"](spark, sf_dir).collect()
    ]
    assert all(len(r.fingerprint) == 16 for r in QUERIES["op7_simhash"](spark, sf_dir).take(5))
    assert sorted(found) == sorted(expected_ids(docs))


def test_odd_rows(make_docs, odd_rows):
    found = simhash.near_duplicates(make_docs(odd_rows)).collect()
    rows = [(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in found]
    assert sorted(rows, key=key) == sorted(expected_ids(odd_rows), key=key)
    assert simhash.near_duplicates(make_docs([])).isEmpty()


@pytest.fixture(scope="module")
def dense():
    """Chains and clusters of fingerprints, far from and near to each other, and random ones."""
    rng = random.Random(7)
    out = {0, 2**64 - 1}
    for centre in [rng.getrandbits(64) for _ in range(6)]:
        for _ in range(250):
            flips = rng.sample(range(64), rng.randrange(4))
            out.add(centre ^ sum(1 << b for b in flips))
        step = centre
        for _ in range(40):  # each link flips four bits
            for b in rng.sample(range(64), 4):
                step ^= 1 << b
            out.add(step)
    out |= {rng.getrandbits(64) for _ in range(500)}
    return sorted(out)


def same_parts(found, fps, max_bits):
    expected = plain_components(fps, max_bits)
    by_root = {}
    for fp, r in zip(fps, expected):
        by_root.setdefault(r, set()).add(fp)
    parts = {}
    for fp, r in found.items():
        parts.setdefault(r, set()).add(fp)
    assert sorted(map(sorted, parts.values())) == sorted(map(sorted, by_root.values()))


@pytest.mark.parametrize("max_bits", [0, 3, 4, 5])
def test_roots_of_dense_groups(spark, dense, max_bits):
    signed = [(x - 2**64 if x >> 63 else x,) for x in dense]
    found = simhash.fingerprint_roots(spark.createDataFrame(signed, "fp long"), max_bits).collect()
    same_parts({r.fp & (2**64 - 1): r.root for r in found}, dense, max_bits)


def test_cells_put_aside_lose_no_link(spark, dense, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_ROWS", 3)
    signed = [(x - 2**64 if x >> 63 else x,) for x in dense]
    found = simhash.fingerprint_roots(spark.createDataFrame(signed, "fp long")).collect()
    same_parts({r.fp & (2**64 - 1): r.root for r in found}, dense, 4)


def test_manhattan_distance_is_a_lower_bound():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**64, (2, 2000), dtype=np.uint64)
    distance = np.zeros(2000, int)
    for segment in range(32):
        x, y = ((simhash.embed(v) >> np.uint64(2 * segment)) & np.uint64(3) for v in (a, b))
        distance += np.abs(x.astype(int) - y.astype(int))
    assert (distance <= np.bitwise_count(a ^ b)).all()


def test_roots_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (600, 600)]
    found = {r.node: r.root for r in components.roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 201)}, 501: 500}


def test_scan_hands_over_whole_groups_only():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    rows = np.sort(rng.integers(0, 60, 500))
    sizes = np.bincount(rows)
    batches = [pa.RecordBatch.from_arrays([pa.array(rows[i : i + 37])], names=["g"]) for i in range(0, 500, 37)]
    whole, away = [], []
    out = groups.scan(
        iter(batches), 1, lambda c: iter([whole.append(c[0])]), lambda c: away.append(c[0]), limit=12
    )
    list(out)
    whole, away = np.concatenate(whole), np.concatenate(away)
    assert sorted([*whole, *away]) == rows.tolist()
    assert all((whole == g).sum() == sizes[g] for g in set(whole))
    assert rows[0] in away and rows[-1] in away


def test_one_of_each_keeps_the_least_id(make_docs, odd_rows):
    rows = odd_rows + [(30, "a b c d e f g h i j"), (31, "A b c d e f g h i j"), (29, "a b c d e f g h i j")]
    docs = make_docs(rows)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(29) == 1 and 30 not in ids and 31 not in ids
    assert ids.count(5) == 1
    # Texts without words have one fingerprint, whatever their id.
    assert [i for i in ids if i in (1, 2, 3)] == [1]
