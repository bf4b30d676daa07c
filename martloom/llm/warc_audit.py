"""Fixity of WARC replicas by Merkle trees.

`write_warc` writes pages as WARC/1.1 response records, file by file. `record_hashes` reads the
files of a replica and hashes every record where it stands: (file, offset, length, record id,
sha256). These are the leaves. Above them, level by level, stand ordered *offset ranges* of each
file: a node of level l covers `fan_out` ranges of level l - 1, the lowest ranges being
`range_bytes` long, and its hash is that of its children's hashes with their places. One node per
file is left at the top; the replica's root is the hash over all files.

`audit` compares two replicas from the roots of the files down. On each level only the children of
ranges that differ are looked at, so what agrees is settled at the top, whatever its size. At the
bottom the records of the differing ranges are compared one by one, and reported as

  changed   same place, other content           missing   only in the first replica
  moved     same content at another place       extra     only in the second replica

Every level is one grouped aggregate and one join; nodes are spread by file and range.

Defined cases: null urls and payloads are empty; null page ids get the record id `urn:page:`;
repeated pages are records of their own; a record cut off by the end of a file, or bytes that are
no record, are hashed as one record without id; replicas without files have equal roots.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.sources.scratch import stored

RECORD_END = "\r\n\r\n"
# Bounds the size of a file, which a task reads as a whole.
RECORDS_PER_FILE = 1_000
RANGE_BYTES = 1 << 16
FAN_OUT = 16

_LEAF = "file string, offset long, length long, record_id string, sha256 binary"


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """One record without its closing line breaks, as text."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", " "),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
    )


def write_warc(records: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Column `record` as gzipped WARC files, in the order of the rows."""
    (
        records.select("record")
        .write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


_ID = re.compile(rb"^WARC-Record-ID:[ \t]*<?([^>\r\n]*)", re.I | re.M)
_LENGTH = re.compile(rb"^Content-Length:[ \t]*(\d+)", re.I | re.M)


def records_of(data: bytes) -> Iterator[tuple[int, int, str | None]]:
    """(offset, length, record id) of every record, closing line breaks included. What cannot be
    read as a record runs to the next one, or to the end, and has no id."""
    at = 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        length = _LENGTH.search(data, at, head) if head >= 0 and data.startswith(b"WARC/", at) else None
        end = head + 4 + int(length[1]) + 4 if length else -1
        if length is None or end > len(data) or data[end - 4 : end] != b"\r\n\r\n":
            following = data.find(b"\r\n\r\nWARC/", at)
            end = following + 4 if following >= 0 else len(data)
            yield at, end - at, None
        else:
            name = _ID.search(data, at, head)
            yield at, end - at, name[1].decode("utf-8", "replace") if name else None
        at = end


def unzipped(data: bytes) -> bytes:
    """What can be read of a file that may be gzipped, and may be damaged or cut."""
    if not data.startswith(b"\x1f\x8b"):
        return data
    try:
        return gzip.decompress(data)
    except (OSError, EOFError, zlib.error):
        pass
    out, rest = [], data
    while rest.startswith(b"\x1f\x8b"):
        member = zlib.decompressobj(31)
        try:
            for i in range(0, len(rest), 4096):
                out.append(member.decompress(rest[i : i + 4096]))
                if member.eof:
                    rest = member.unused_data + rest[i + 4096 :]
                    break
            else:
                break
        except zlib.error:
            break
    return b"".join(out)


def record_hashes(spark: SparkSession, path: str) -> DataFrame:
    """The leaves of a replica: one row per record of its files. A file goes by the part of its
    name that both replicas share (writer and number)."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select(
            F.concat_ws(
                "-",
                F.regexp_extract("path", r"part-(\d+)", 1),
                F.regexp_extract("path", r"-c(\d+)\.", 1),
            ).alias("file"),
            "content",
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                data = unzipped(content.as_py())
                found = list(records_of(data))
                view = memoryview(data)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file.as_py()] * len(found), pa.string()),
                        pa.array([a for a, _, _ in found], pa.int64()),
                        pa.array([n for _, n, _ in found], pa.int64()),
                        pa.array([i for _, _, i in found], pa.string()),
                        pa.array([hashlib.sha256(view[a : a + n]).digest() for a, n, _ in found], pa.binary()),
                    ],
                    names=["file", "offset", "length", "record_id", "sha256"],
                )

    # A batch holds a few files at most, each of which is read as a whole.
    return files.mapInArrow(run, _LEAF)


def _hash_of(children: Column) -> Column:
    """Hash over ordered (place, hash) pairs."""
    parts = F.transform(children, lambda c: F.concat(c["at"].cast("string"), F.lit(":"), F.hex(c["hash"])))
    return F.unhex(F.sha2(F.array_join(parts, "\n"), 256))


def _range_at(level: int, range_bytes: int, fan_out: int) -> Column:
    return F.floor(F.col("offset") / (range_bytes * fan_out**level)).cast("long")


def merkle_levels(leaves: DataFrame, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Tables (file, at, hash) of the offset ranges, from the lowest level to one node per file."""
    last = leaves.agg(F.max("offset")).first()[0] or 0
    nodes = (
        leaves.withColumn("at", _range_at(0, range_bytes, fan_out))
        .groupBy("file", "at")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("offset").alias("at"), F.col("sha256").alias("hash")))).alias("c"))
        .select("file", "at", _hash_of(F.col("c")).alias("hash"))
    )
    levels = [stored(nodes)]
    width = range_bytes
    while width <= last:
        nodes = (
            levels[-1]
            .withColumn("above", F.floor(F.col("at") / fan_out).cast("long"))
            .groupBy("file", "above")
            .agg(F.sort_array(F.collect_list(F.struct("at", "hash"))).alias("c"))
            .select("file", F.col("above").alias("at"), _hash_of(F.col("c")).alias("hash"))
        )
        levels.append(stored(nodes))
        width *= fan_out
    return levels


def root(levels: list[DataFrame]) -> str:
    """The hash over all files: what two replicas compare first. Files are summed up by ranges of
    their names, so that no task gathers all of them."""
    tops = levels[-1].withColumn("bucket", F.substring(F.sha2("file", 256), 1, 3))
    buckets = tops.groupBy("bucket").agg(
        F.sort_array(F.collect_list(F.struct(F.col("file").alias("at"), "hash"))).alias("c")
    )
    rows = buckets.select("bucket", F.hex(_hash_of(F.col("c"))).alias("hash")).orderBy("bucket").collect()
    return hashlib.sha256("\n".join(f"{r.bucket}:{r.hash}" for r in rows).encode()).hexdigest()


def _different(a: DataFrame, b: DataFrame) -> DataFrame:
    """(file, at) of nodes that one side lacks or that differ."""
    return (
        a.withColumnRenamed("hash", "hash_a")
        .join(b.withColumnRenamed("hash", "hash_b"), ["file", "at"], "full_outer")
        .where(~F.col("hash_a").eqNullSafe(F.col("hash_b")))
        .select("file", "at")
    )


def audit(
    first: DataFrame, second: DataFrame, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT
) -> DataFrame:
    """Records of two replicas (tables of leaves) that do not agree: file, status, record_id,
    offset and length in either replica (null where it lacks the record), and both hashes."""
    first, second = stored(first), stored(second)
    trees = [merkle_levels(x, range_bytes, fan_out) for x in (first, second)]
    height = max(map(len, trees))
    for leaves, tree in zip((first, second), trees):  # the lower tree grows to the other's height
        while len(tree) < height:
            tree.append(
                tree[-1]
                .withColumn("above", F.floor(F.col("at") / fan_out).cast("long"))
                .groupBy("file", "above")
                .agg(F.sort_array(F.collect_list(F.struct("at", "hash"))).alias("c"))
                .select("file", F.col("above").alias("at"), _hash_of(F.col("c")).alias("hash"))
            )
    if root(trees[0]) == root(trees[1]):
        open_ranges = trees[0][0].select("file", "at").limit(0)
    else:
        open_ranges = stored(_different(trees[0][-1], trees[1][-1]))
        for level in range(height - 2, -1, -1):
            above = open_ranges.select("file", F.col("at").alias("_above"))
            sides = [
                t[level].join(
                    above,
                    (t[level]["file"] == above["file"])
                    & (F.floor(t[level]["at"] / fan_out).cast("long") == above["_above"]),
                    "left_semi",
                )
                for t in trees
            ]
            open_ranges = stored(_different(*sides))

    def records(leaves: DataFrame, side: str) -> DataFrame:
        placed = leaves.withColumn("at", _range_at(0, range_bytes, fan_out)).join(
            open_ranges, ["file", "at"], "left_semi"
        )
        return placed.select(
            "file",
            "record_id",
            *[F.col(c).alias(f"{c}_{side}") for c in ("offset", "length", "sha256")],
        )

    a, b = records(first, "a"), records(second, "b")
    # Records at the same place first; what is left is matched by id and content.
    same_place = a.join(
        b.withColumnRenamed("record_id", "id_b"),
        (a["file"] == b["file"]) & (F.col("offset_a") == F.col("offset_b")),
        "full_outer",
    ).select(
        F.coalesce(a["file"], b["file"]).alias("file"),
        a["record_id"].alias("id_a"),
        "id_b",
        "offset_a", "length_a", "sha256_a", "offset_b", "length_b", "sha256_b",
    ).where(~F.col("sha256_a").eqNullSafe(F.col("sha256_b")))
    same_place = stored(same_place)
    changed = (F.col("id_a").eqNullSafe(F.col("id_b")) & F.col("offset_a").isNotNull() & F.col("offset_b").isNotNull()) | (
        (F.col("length_a") == F.col("length_b"))
    )
    in_place = same_place.where(F.coalesce(changed, F.lit(False))).select(
        "file", F.lit("changed").alias("status"), F.coalesce("id_a", "id_b").alias("record_id"),
        "offset_a", "length_a", "offset_b", "length_b", "sha256_a", "sha256_b",
    )
    rest = same_place.where(~F.coalesce(changed, F.lit(False)))
    # Equal records are numbered in their order, so that each has one partner.
    def numbered(side: str) -> DataFrame:
        columns = [F.col(f"{c}_{side}") for c in ("offset", "length", "sha256")]
        order = Window.partitionBy("file", "record_id", f"sha256_{side}").orderBy(f"offset_{side}")
        return (
            rest.where(F.col(f"offset_{side}").isNotNull())
            .select("file", F.col(f"id_{side}").alias("record_id"), *columns)
            .withColumn("k", F.row_number().over(order))
        )

    x, y = numbered("a"), numbered("b").withColumnRenamed("record_id", "id").withColumnRenamed("file", "file_b")
    moved = x.join(
        y,
        (x["file"] == y["file_b"])
        & (x["sha256_a"] == y["sha256_b"])
        & x["record_id"].eqNullSafe(y["id"])
        & (x["k"] == y["k"]),
        "full_outer",
    ).select(
        F.coalesce("file", "file_b").alias("file"),
        F.when(F.col("offset_b").isNull(), "missing").when(F.col("offset_a").isNull(), "extra").otherwise("moved").alias("status"),
        F.coalesce("record_id", "id").alias("record_id"),
        "offset_a", "length_a", "offset_b", "length_b", "sha256_a", "sha256_b",
    )
    found = in_place.unionByName(moved)
    return found.select(
        "file",
        "status",
        "record_id",
        "offset_a",
        "length_a",
        "offset_b",
        "length_b",
        F.lower(F.hex("sha256_a")).alias("sha256_a"),
        F.lower(F.hex("sha256_b")).alias("sha256_b"),
    )
