import hashlib
from collections import Counter

import numpy as np
import pytest

from martloom.llm import groups, line_dedup

SPACES = "".join(map(chr, [0x20, *range(9, 14)]))
LOWER = {i: i + 32 for i in range(65, 91)}


def plain(rows, min_chars=20, min_docs=3):
    def key(line):
        return line.strip(SPACES).translate(LOWER)

    order = lambda i: -(2**63) if i is None else i
    holders = {}
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(order(doc_id))
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == order(doc_id)
        ]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc_id, len(lines), len(lines) - len(kept), digest))
    return Counter(out)


def found(docs):
    return Counter(map(tuple, line_dedup.digests(docs, line_dedup.keep_bitmaps(docs)).collect()))


COMMON = "This Line stands in many documents"
ROWS = [
    *[(i, f"own line of document number {i}\n\t{COMMON}  \nshort\n{COMMON.upper()}") for i in range(40)],
    *[(i, f"{COMMON}\r") for i in range(100, 140)],
    (200, "a line in two documents only, so kept"),
    (201, "a line in two documents only, so kept"),
    (202, "Zwanzig Zeichen äöü!"),
    (203, "zwanzig zeichen äöü!"),
    (204, "zwanzig zeichen äöü!\n\n"),
    (205, "zwanzig zeichen Äöü!"),
]


@pytest.mark.parametrize("limit", [groups.GROUP_ROWS, 2])
def test_equals_plain_version(make_docs, odd_rows, monkeypatch, limit):
    monkeypatch.setattr(groups.scan, "__defaults__", (limit,))
    rows = ROWS + odd_rows
    assert found(make_docs(rows)) == plain(rows)


def test_ids_with_several_texts_are_one_document(make_docs):
    rows = [(None, f"{COMMON}\nx"), (1, COMMON), (1, f"other\n{COMMON}"), (1, COMMON)]
    assert found(make_docs(rows)) == plain(rows)
    rows.append((2, COMMON))
    assert found(make_docs(rows)) == plain(rows)
    assert line_dedup.keep_bitmaps(make_docs([])).isEmpty()


def test_bitmap_reads_back():
    bitmap = line_dedup.keep_bitmap(np.array([5, 1, 5]))
    assert line_dedup.kept_lines(b"0\n1\n2\n3\n4\n5\n6\n7\n8\n9", bitmap) == (10, [b"0", b"2", b"3", b"4", b"6", b"7", b"8", b"9"])
    assert line_dedup.kept_lines(b"", None) == (1, [b""])
    assert len(line_dedup.keep_bitmap(np.array([100_000]))) < 100
