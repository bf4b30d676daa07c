"""SimHash near-duplicates by an embedding of fingerprints into per-segment bit counts.

A 64-bit fingerprint is cut into 32 segments of two bits, and mapped to the vector of their bit
counts. Flipping one bit moves one count by one, so the Manhattan distance of two vectors is a
lower bound of the number of differing bits. The range join works on halves of the vector: if two
vectors are at most 2r apart, one half is at most r apart. For r = 2 both points then lie within
one step of a common grid point of that half, so every fingerprint enters the grid cells within
one step of its two half vectors (about 50), and points that share a cell are compared exactly.
Limits up to 5 bits keep r at 2; that is what `max_bits` is checked against.

Groups: fingerprints that are equal become one point first, so copies cost nothing. A dense cell
must not make all pairs of its points:

1. Each point is compared with the least and the greatest point of its own two cells. Components
   over these links (`seeds`) hold nearly all of a dense group.
2. The full range join then compares points of *different* components only, and a block of cells
   returns each pair of components once. Cells are range-partitioned by cell and fingerprint, so
   that a hot cell is spread over tasks; cells cut by the bounds of a partition, or larger than
   `CELL_ROWS`, are put aside and joined by Spark, where again only points outside of a cell's
   main component meet the others.

No link between different components is lost, hence the components are exact.

Defined cases: a null or empty text has no words and the fingerprint zero, which links like any
other; null doc_ids take part and come last, so a component's id is null only if all its ids
are; repeated rows are returned as often as they come. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import groups
from martloom.llm.components import roots
from martloom.sources.scratch import stored

SHINGLE = 4
MAX_BITS = 4
SEED = 42

# Shingles whose bits are counted at a time.
_SLICE = 1 << 16
# A cell with more points than this is not compared within one task.
CELL_ROWS = 20_000

_ODD_BITS = 0x5555555555555555


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """Bit by bit, whether more than half of the shingles' hashes have it set."""
    words = b" ".join(text.lower().split())  # of bytes: ASCII letters and ASCII white space
    if not words:
        return 0
    data = np.frombuffer(words, np.uint8)
    gaps = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], gaps + 1])
    ends = np.append(gaps, len(data))
    n = max(len(starts) - k + 1, 1)
    first, last = starts[:n].tolist(), ends[min(k, len(ends)) - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _SLICE):
        hashes = np.array(
            [digest(words[s:e], SEED) for s, e in zip(first[at : at + _SLICE], last[at : at + _SLICE])],
            np.uint64,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, row_key, fp) of every row; fp is the fingerprint as a signed long and row_key
    a hash of the whole text."""
    source = docs.select("doc_id", F.xxhash64("text").alias("row_key"), "text")
    schema = source.drop("text").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.large_string()).cast(pa.large_binary()).fill_null(b"")
            fps = np.fromiter(
                (fingerprint(t.as_py(), k) for t in texts), np.uint64, count=len(texts)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                names=["doc_id", "row_key", "fp"],
            )

    return source.mapInArrow(run, schema)


def embed(fps: np.ndarray) -> np.ndarray:
    """The 32 two-bit counts of every fingerprint, two bits each."""
    return fps - ((fps >> np.uint64(1)) & np.uint64(_ODD_BITS))


def own_cells(vectors: np.ndarray) -> np.ndarray:
    """(points, 2): the grid point of each half vector, told apart by bit 32."""
    low = vectors & np.uint64(0xFFFFFFFF)
    high = (vectors >> np.uint64(32)) | np.uint64(1 << 32)
    return np.stack([low, high], axis=1).astype(np.int64)


def near_cells(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, cell) of all grid points within one step of the own ones, themselves included."""
    index, cells = [np.arange(len(own))], [own]
    for segment in range(16):
        count = (own >> (2 * segment)) & 3
        for step, fits in ((1, count < 2), (-1, count > 0)):
            at = np.flatnonzero(fits)
            index.append(at)
            cells.append(own[at] + step * (1 << (2 * segment)))
    return np.concatenate(index), np.concatenate(cells)


def _cells(points: DataFrame, near: bool) -> DataFrame:
    """(cell, fp, root) of every point and each of its cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                part = batch.slice(at, 20_000)
                fp = part.column(0).to_numpy()
                root = part.column(1).to_numpy()
                own = own_cells(embed(fp.view(np.uint64)))
                for half in (0, 1):
                    if near:
                        index, cells = near_cells(own[:, half])
                    else:
                        index, cells = np.arange(len(fp)), own[:, half]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cells), pa.array(fp[index]), pa.array(root[index])],
                        names=["cell", "fp", "root"],
                    )

    return points.select("fp", "root").mapInArrow(run, "cell long, fp long, root long")


def _differ(a: str, b: str, max_bits: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def _seed_links(points: DataFrame, max_bits: int) -> DataFrame:
    cells = stored(_cells(points.withColumn("root", F.col("fp")), near=False))
    ends = (
        cells.groupBy("cell")
        .agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
        .where("least < most")
    )
    star = cells.join(ends, "cell")
    pairs = [
        star.where((F.col("fp") != F.col(end)) & _differ("fp", end, max_bits)).select(
            F.col("fp").alias("a"), F.col(end).alias("b")
        )
        for end in ("least", "most")
    ]
    return pairs[0].unionByName(pairs[1])


def _compare_sorted(cell: np.ndarray, fp: np.ndarray, root: np.ndarray, max_bits: int) -> np.ndarray:
    """Pairs of roots with points that share a cell and differ in few bits; rows sorted by cell."""
    found = []
    bits = fp.view(np.uint64)
    index = np.arange(len(cell) - 1)
    step = 1
    while len(index):
        index = index[index + step < len(cell)]
        index = index[cell[index] == cell[index + step]]
        a, b = index, index + step
        close = (root[a] != root[b]) & (np.bitwise_count(bits[a] ^ bits[b]) <= max_bits)
        if close.any():
            found.append(np.stack([root[a][close], root[b][close]], axis=1))
        step += 1
    if not found:
        return np.zeros((0, 2), np.int64)
    return np.unique(np.sort(np.concatenate(found), axis=1), axis=0)


def _mixed_cells(cell: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Rows of cells that hold points of more than one component; rows sorted by cell."""
    first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    size = np.diff(np.append(first, len(cell)))
    mixed = np.minimum.reduceat(root, first) != np.maximum.reduceat(root, first)
    return np.repeat(mixed & (size > 1), size)


_OUT = "cell long, a long, b long"


def _scan_cells(max_bits: int):
    """Over sorted cells of one partition: (null, root, root) for links, and (cell, fp, root) for
    points of cells that are cut by the partition's bounds or too large."""

    def out(cell, a, b) -> pa.RecordBatch:
        cell = pa.nulls(len(a), pa.int64()) if cell is None else pa.array(cell)
        return pa.RecordBatch.from_arrays([cell, pa.array(a), pa.array(b)], names=["cell", "a", "b"])

    def whole(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keep = _mixed_cells(columns[0], columns[2])
        links = _compare_sorted(*[c[keep] for c in columns], max_bits)
        if len(links):
            yield out(None, links[:, 0].copy(), links[:, 1].copy())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from groups.scan(batches, 1, whole, lambda columns: out(*columns), CELL_ROWS)

    return run


def _aside_links(aside: DataFrame, max_bits: int) -> DataFrame:
    """Links in cells that were put aside. In each cell the points outside of its main component
    meet all points of other components; where there is one component, nothing meets."""
    parts = aside.groupBy("cell", "root").agg(F.count(F.lit(1)).alias("n"))
    main = (
        parts.groupBy("cell")
        .agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
        .where("roots > 1")
    )
    mixed = stored(aside.join(main.drop("roots"), "cell"))
    few = mixed.where("root <> main").select("cell", F.col("fp").alias("fp_few"), F.col("root").alias("root_few"))
    return (
        mixed.select("cell", "fp", "root")
        .join(few, "cell")
        .where((F.col("root") != F.col("root_few")) & _differ("fp", "fp_few", max_bits))
        .groupBy(F.least("root", "root_few").alias("a"), F.greatest("root", "root_few").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("a", "b")
    )


def _replace(points: DataFrame, found: DataFrame, node: str) -> DataFrame:
    """`points` with column `node` replaced by its root, where it has one."""
    renamed = found.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    joined = points.join(renamed, F.col(node) == F.col("_node"), "left")
    return joined.select(
        *[F.coalesce("_root", F.col(c)).alias(c) if c == node else F.col(c) for c in points.columns]
    )


def fingerprint_roots(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) of every distinct fingerprint; root is one fingerprint of the component."""
    if not 0 <= max_bits <= 5:
        raise ValueError("half vectors two steps apart cover at most 5 differing bits")
    points = stored(fps.select("fp").distinct())
    seeds = roots(_seed_links(points, max_bits))
    points = stored(_replace(points.withColumn("root", F.col("fp")), seeds, "root"))

    cells = _cells(points, near=True)
    sorted_cells = cells.repartitionByRange("cell", "fp").sortWithinPartitions("cell", "fp")
    scanned = stored(sorted_cells.mapInArrow(_scan_cells(max_bits), _OUT))
    aside = scanned.where("cell IS NOT NULL").select(
        "cell", F.col("a").alias("fp"), F.col("b").alias("root")
    )
    links = scanned.where("cell IS NULL").select("a", "b").unionByName(_aside_links(aside, max_bits))
    return _replace(points, roots(links), "root")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, row_key, fp, component_id) of every row: components of documents whose
    fingerprints link at `max_bits` or fewer differing bits, named by their least doc_id."""
    rows = stored(fingerprints(docs, k))
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = fingerprint_roots(rows, max_bits)
    named = stored(found.join(least, "fp"))
    # Written first, so that both sides of the join are plain shuffles and a root with very many
    # fingerprints is split.
    ids = stored(named.groupBy("root").agg(F.min("least").alias("component_id")))
    named = stored(named.select("fp", "root").join(ids, "root").select("fp", "component_id"))
    return rows.join(named, "fp").select("doc_id", "row_key", "fp", "component_id")


def one_of_each(docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of `docs` that stand for their component: the least doc_id's, and of rows that
    share it the one with the least hash. All columns stay. A component without any id is kept
    as a whole, as nothing tells its rows apart but their text: one row of each text."""
    rows = near_duplicates(docs, k, max_bits)
    chosen = (
        rows.where("doc_id = component_id")
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.min("row_key").alias("_key"))
    )
    nameless = rows.where("component_id IS NULL").select(
        F.col("doc_id").alias("_id"), F.col("row_key").alias("_key")
    )
    chosen = chosen.unionByName(nameless.distinct())
    # The row goes along as one value, so its columns cannot clash with those of the join.
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64("text").alias("key"),
    )
    kept = rows.join(
        chosen, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left_semi"
    )
    return kept.dropDuplicates(["id", "key"]).select("row.*")
