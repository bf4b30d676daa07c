import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from martloom.llm import warc_audit as w
from martloom.llm.queries import QUERIES, read
from martloom.sources.scratch import scratch_dir


def record(name, body):
    body = body.encode()
    head = f"WARC/1.1\r\nWARC-Record-ID: <{name}>\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


@pytest.fixture
def audit(spark, tmp_path):
    def run(first, second, **how):
        """Files by number, each a list of records (bytes)."""
        for side, files in (("a", first), ("b", second)):
            (tmp_path / side).mkdir()
            for number, records in files.items():
                data = b"".join(records)
                (tmp_path / side / f"part-{number:05}-{side}-c000.txt.gz").write_bytes(gzip.compress(data))
        sides = [w.record_hashes(spark, str(tmp_path / side)) for side in "ab"]
        rows = w.audit(*sides, **how).collect()
        return sorted((r.file, r.status, r.record_id or "", r.offset_a, r.offset_b) for r in rows)

    return run


FILES = {f: [record(f"f{f}r{i}", f"page {i} of {f}\r\n\r\n" * (i % 5)) for i in range(40)] for f in range(3)}
SMALL = {"range_bytes": 256, "fan_out": 3}


def test_equal_replicas(audit):
    assert audit(FILES, FILES, **SMALL) == []


def test_damage_is_located(audit):
    offset = lambda f, i: sum(map(len, FILES[f][:i]))
    second = {f: list(r) for f, r in FILES.items()}
    second[0][7] = second[0][7].replace(b"page", b"pagf")
    lost = second[1].pop(38)
    second[2].append(record("extra", "new"))
    expected = [
        ("00000-000", "changed", "f0r7", offset(0, 7), offset(0, 7)),
        ("00001-000", "missing", "f1r38", offset(1, 38), None),
        ("00001-000", "moved", "f1r39", offset(1, 39), offset(1, 39) - len(lost)),
        ("00002-000", "extra", "extra", None, offset(2, 40)),
    ]
    found = audit(FILES, second, **SMALL)
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_a_whole_file_and_a_cut_one(audit):
    second = {0: FILES[0], 1: [*FILES[1][:-1], FILES[1][-1][:-9]]}
    found = audit(FILES, second)
    assert [x[1:3] for x in found if x[0] == "00002-000"] == sorted(("missing", f"f2r{i}") for i in range(40))
    assert sorted(x[1:3] for x in found if x[0] == "00001-000") == [("extra", ""), ("missing", "f1r39")]


def test_records_of_damaged_bytes():
    data = record("a", "x") + b"junk" + record("b", "") + record("c", "yy")[:-5]
    assert [name for _, _, name in w.records_of(data)] in (["a", None, "b", None], ["a", None, None])
    assert sum(n for _, n, _ in w.records_of(data)) == len(data)
    assert list(w.records_of(b"")) == []
    packed = gzip.compress(record("a", "x" * 9000))
    assert w.unzipped(packed) == record("a", "x" * 9000)
    assert record("a", "x" * 9000).startswith(w.unzipped(packed[:-12]))
    assert w.unzipped(b"plain") == b"plain"


def test_written_files_hold_every_page(spark):
    rows = [(1, "http://a/", "<p>é</p>\r\n\r\nWARC/1.1"), (1, "http://a/", "<p>é</p>\r\n\r\nWARC/1.1"), (None, None, None), (2, "x\r\ny", ""), (3, "u", "long " * 200_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, record string")
    path = scratch_dir(spark, "warc")
    w.write_warc(pages.select(w.warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record")), path, 2)
    leaves = w.record_hashes(spark, path).collect()
    assert sorted(r.record_id for r in leaves) == ["urn:page:", "urn:page:1", "urn:page:1", "urn:page:2", "urn:page:3"]
    assert w.audit(w.record_hashes(spark, path), w.record_hashes(spark, path)).isEmpty()


def test_empty_replicas(spark):
    none = spark.createDataFrame([], "file string, offset long, length long, record_id string, sha256 binary")
    assert w.audit(none, none).isEmpty()
    one = spark.createDataFrame([("f", 0, 3, "x", bytearray(hashlib.sha256(b"x").digest()))], none.schema)
    assert [r.status for r in w.audit(one, none).collect()] == ["missing"]


def test_query_finds_all_damage(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    damage = lambda name, n: F.pmod(F.xxhash64(F.lit(name), "page_id"), F.lit(n)) == 0
    lost = {r.page_id for r in pages.where(damage("loss", 5000)).collect()}
    rotten = {r.page_id for r in pages.where(damage("rot", 50)).collect()} - lost
    rows = QUERIES["op9_warc_audit"](spark, sf_dir).collect()
    assert {r.page_id for r in rows if r.status == "missing"} - rotten == lost
    found = {r.page_id for r in rows if r.status in ("changed", "missing")}
    assert found == rotten | lost and found
