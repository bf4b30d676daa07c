"""Lines that stand in many documents are kept in one of them only.

Lines are keyed by a 128-bit hash of the line without white space at its ends, ASCII letters in
lower case. Keys are range-partitioned and sorted by hash, document (largest first) and position,
and streamed: the first document of a key is the one that keeps it, and once a third document
comes up, the lines of all others are dropped. A hot line is spread over tasks, as documents and
positions are part of the range; keys cut by the bounds of a partition are put aside and settled
by a grouped aggregate (see groups).

The result is no text but one compressed bitmap per document that loses lines: bit i tells whether
line i is kept, and lines beyond the bitmap are kept. `apply` reads it back against a text.

Defined cases: a null or empty text is one empty line; a null doc_id is the smallest document;
rows with the same doc_id are one document, and each row has a bitmap of its own text, so
repeated rows share one; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm import groups
from martloom.operators.sizing import fits_broadcast
from martloom.sources.scratch import stored

MIN_CHARS = 20
MIN_DOCS = 3

_NO_ID = -(2**63)
_CONTINUATION = bytes(range(0x80, 0xC0))


def document(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(_NO_ID))


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """What tells lines apart, or None for a line that is always kept."""
    key = line.strip().lower()  # of bytes: ASCII white space and letters
    if len(key) < min_chars or len(key.translate(None, _CONTINUATION)) < min_chars:
        return None
    return key


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, later, row_key, pos) of every line with a key; `later` orders documents from the
    largest on."""
    source = docs.select(document(F.col("doc_id")).alias("doc"), F.xxhash64("text").alias("row_key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, keys, texts = batch.columns
            digests, rows, positions = [], [], []
            for row, text in enumerate(texts.cast(pa.large_string()).cast(pa.large_binary())):
                raw = text.as_py()
                if raw is None:
                    continue
                for pos, line in enumerate(raw.split(b"\n")):
                    key = line_key(line, min_chars)
                    if key is not None:
                        digests.append(xxhash.xxh3_128_digest(key))
                        rows.append(row)
                        positions.append(pos)
            hashes = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[:, 0].copy()),
                    pa.array(hashes[:, 1].copy()),
                    pa.array(~np.asarray(docs)[rows] if rows else np.zeros(0, np.int64)),
                    keys.take(pa.array(rows, pa.int64())),
                    pa.array(positions, pa.int32()),
                ],
                names=["h1", "h2", "later", "row_key", "pos"],
            )

    return source.mapInArrow(run, "h1 long, h2 long, later long, row_key long, pos int")


_SCANNED = "h1 long, h2 long, later long, row_key long, pos int, settled boolean"


def _scan(min_docs: int):
    def out(columns: list[np.ndarray], settled: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c) for c in columns], pa.array(np.full(len(columns[0]), settled))],
            names=["h1", "h2", "later", "row_key", "pos", "settled"],
        )

    def whole(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        first = groups.starts(columns, 2)
        later = columns[2]
        size = np.diff(np.append(first, len(later)))
        opens = np.zeros(len(later), np.int64)  # rows that open a document of their group
        opens[groups.starts(columns, 3)] = 1
        many = np.add.reduceat(opens, first) >= min_docs
        dropped = np.repeat(many, size) & (later != np.repeat(later[first], size))
        if dropped.any():
            yield out([c[dropped] for c in columns], True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from groups.scan(batches, 2, whole, lambda columns: out(columns, False))

    return run


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(later, row_key, pos) of every line that goes."""
    order = ["h1", "h2", "later", "row_key", "pos"]
    lines = occurrences(docs, min_chars).repartitionByRange(*order).sortWithinPartitions(*order)
    scanned = stored(lines.mapInArrow(_scan(min_docs), _SCANNED))
    aside = scanned.where("NOT settled")
    common = stored(
        aside.groupBy("h1", "h2", "later")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("h1", "h2")
        .agg(F.min("later").alias("keeper"), F.count(F.lit(1)).alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "keeper")
    )
    if fits_broadcast(common):
        common = F.broadcast(common)
    late = aside.join(common, ["h1", "h2"]).where("later <> keeper")
    columns = ["later", "row_key", "pos"]
    return scanned.where("settled").select(*columns).unionByName(late.select(*columns))


def keep_bitmap(dropped: np.ndarray) -> bytes:
    """Compressed bits, 1 for a kept line, in whole bytes up to the last line that is dropped."""
    keep = np.ones((int(dropped.max()) // 8 + 1) * 8, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes())


def kept_lines(text: bytes, bitmap: bytes | None) -> tuple[int, list[bytes]]:
    """Number of lines, and those that stay."""
    lines = text.split(b"\n")
    if bitmap is None:
        return len(lines), lines
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")
    keep = keep.astype(bool).tolist()
    return len(lines), [x for i, x in enumerate(lines) if i >= len(keep) or keep[i]]


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, row_key, bitmap) of every text that loses lines; a text is found by document(doc_id)
    and xxhash64(text)."""
    lists = (
        dropped_lines(docs, min_chars, min_docs)
        .groupBy("later", "row_key")
        .agg(F.collect_set("pos").alias("dropped"))
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            positions, ends = np.asarray(lists.values), np.asarray(lists.offsets)
            bitmaps = [keep_bitmap(positions[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(~np.asarray(batch.column(0))), batch.column(1), pa.array(bitmaps, pa.binary())],
                names=["doc", "row_key", "bitmap"],
            )

    return lists.mapInArrow(pack, "doc long, row_key long, bitmap binary")


def digests(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row, from its text and bitmap."""
    texts = docs.select(
        "doc_id", document(F.col("doc_id")).alias("doc"), F.xxhash64("text").alias("row_key"), "text"
    )
    joined = texts.join(bitmaps, ["doc", "row_key"], "left").select("doc_id", "text", "bitmap")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, hashes = [], [], []
            texts = batch.column(1).cast(pa.large_string()).cast(pa.large_binary())
            for text, bitmap in zip(texts, batch.column(2)):
                total, kept = kept_lines(text.as_py() or b"", bitmap.as_py())
                n_lines.append(total)
                n_dropped.append(total - len(kept))
                hashes.append(hashlib.sha256(b"\n".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_lines, pa.int64()),
                    pa.array(n_dropped, pa.int64()),
                    pa.array(hashes, pa.string()),
                ],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    return joined.mapInArrow(run, f"doc_id {kind}, n_lines long, n_dropped long, kept_sha256 string")
