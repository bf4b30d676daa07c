"""Token ids of a corpus as ORC files in document order.

Rows are range-partitioned by document id and written in that order, so every file and every
stripe covers a narrow range of ids. ORC's run-length encoding packs the ids of a list to the bits
they need, row indexes hold the least and greatest doc_id of every `ROW_INDEX` rows, and a Bloom
filter on doc_id answers look-ups of single documents. Stripes are read in parallel, and filters
on doc_id skip stripes and row groups by their metadata.

Every row also holds its writer's number and the ids that writer wrote before it, so a reader
finds where a document starts from the sizes of the files before it alone, whatever way files
are split over tasks.

Text is encoded in pieces (see `pieces_of`), each distinct piece once per worker while it is
remembered. That gives what encoding the whole text gives if the tokenizer ignores case and never
joins characters across the cuts, which `check_pieces` tests on a probe before the job starts; if
it fails, whole texts are encoded.

Defined cases: a null or empty text has only the end id; null ids come first; rows with the same
id are ordered by a hash of their text, repeated rows all kept; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.operators.sizing import fits_broadcast

STRIPE_BYTES = 32 << 20
ROW_INDEX = 1_000
# Distinct pieces a worker remembers, in two generations.
REMEMBERED = 400_000
# Bytes of one text, and pieces of several, that are encoded at a time.
_GROUP = 1 << 20
_PIECES = 100_000
# Punctuation at which texts are cut, and which no special token holds.
_MARKS = [bytes([b]) for b in b".,;:!?#$%&*"]
_PUNCTUATION = re.compile(rb"([A-Za-z0-9])([.,;:!?#$%&*])")
_RUNS = re.compile(rb"[^A-Za-z0-9\x80-\xff \t\n\x0b\x0c\r][.,;:!?#$%&*]")
_ASCII = bytes(range(128))
# Lower-case letters of one or two bytes, and words of them in either case.
_LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_WORDS = ["the", "isnt", "dont", "über", "élève", "señor", "straße", "s", "ll", "re", "supercalifragilistic"]

_SCHEMA = "doc_id {kind}, n_tokens long, part int, before long, tokens array<int>"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces_of(raw: bytes) -> list[bytes]:
    """What a text may be cut into without changing its ids: at ASCII white space, and between a
    letter or digit and common punctuation. ASCII letters are put in lower case, unless something
    could turn on their case: a special token, or a combining mark that would become one
    character with the letter."""
    if b"<|" not in raw and b"\xcc" not in raw and b"\xcd" not in raw:
        raw = raw.lower()
    other = raw.translate(None, _ASCII)
    latin = 2 * other.count(b"\xc3") == len(other) and b"\x97" not in other and b"\xb7" not in other
    if latin and not _RUNS.search(raw):
        # Nothing but letters of two bytes beyond ASCII, and no runs of punctuation: every mark
        # of punctuation follows a letter, a digit or white space.
        for mark in _MARKS:
            raw = raw.replace(mark, b" " + mark)
    else:
        raw = _PUNCTUATION.sub(rb"\1 \2", raw)
    return raw.split()


class Pieces(dict):
    """Piece to its number, given out on first sight; `fresh` are those whose ids are to be
    added. Those of piece i are ids[starts[i]:starts[i] + counts[i]]."""

    def __init__(self):
        self.fresh: list[bytes] = []
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.starts = np.zeros(1 << 16, np.int64)
        self.counts = np.zeros(1 << 16, np.int64)

    def __missing__(self, piece: bytes) -> int:
        self[piece] = number = len(self)
        self.fresh.append(piece)
        return number

    def add(self, numbers: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Ids, end to end, of the pieces with these numbers."""
        if len(self) > len(self.starts):
            self.starts, self.counts = (np.resize(x, 2 * len(self)) for x in (self.starts, self.counts))
        if self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.used + len(ids)))
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[numbers] = self.used + np.cumsum(counts) - counts
        self.counts[numbers] = counts
        self.used += len(ids)

    def ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces end to end, and how many each has."""
        counts = self.counts[numbers]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.starts[numbers] - ends + counts, counts) + np.arange(total)], counts


class Encoder:
    """Whole texts to ids, remembering the ids of pieces in two generations: when the young one is
    full, the old one is dropped and takes its place, so what is in use stays known.

    A piece of nothing but letters of one or two bytes is a single word to the tokenizer, which a
    probe confirms (`direct`); its model then takes it as it is, in the model's own alphabet.
    """

    def __init__(self, path: str, by_piece: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_piece = by_piece
        self.young, self.old = Pieces(), Pieces()
        self.alphabet: dict[int, str] = {}
        self.direct = by_piece and self._check_direct()

    def _check_direct(self) -> bool:
        if self.tokenizer.pre_tokenizer is None:
            return False
        for letter in _LETTERS:
            found = self.tokenizer.pre_tokenizer.pre_tokenize_str(letter)
            if len(found) != 1:
                return False
            self.alphabet[ord(letter)] = found[0][0]
        words = [_LETTERS[i : i + n] for n in (1, 2, 5, 11) for i in range(len(_LETTERS))] + _WORDS
        whole = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return whole == [self._of_word(w) for w in words]

    def _of_word(self, word: str) -> list[int]:
        own = word if word.isascii() else word.translate(self.alphabet)
        return [token.id for token in self.tokenizer.model.tokenize(own)]

    def _encode(self, pieces: list[bytes]) -> list[list[int]]:
        if not self.direct:
            texts = [p.decode() for p in pieces]
            return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        out: list = []
        others, places = [], []
        for place, piece in enumerate(pieces):
            text = piece.decode()
            if piece.isalpha() or _WORD.fullmatch(text):
                out.append(self._of_word(text.lower()))
            else:
                out.append(None)
                others.append(text)
                places.append(place)
        encoded = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        for place, e in zip(places, encoded):
            out[place] = e.ids
        return out

    def _learn(self) -> None:
        """Ids of the young generation's fresh pieces: from the old one, or the tokenizer."""
        fresh, self.young.fresh = self.young.fresh, []
        first = len(self.young) - len(fresh)
        kept = np.array([self.old.get(p, -1) for p in fresh], np.int64)
        again = np.flatnonzero(kept >= 0)
        if len(again):
            self.young.add(first + again, *self.old.ids_of(kept[again]))
        new = np.flatnonzero(kept < 0)
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            encoded = self._encode([fresh[i] for i in part])
            counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
            ids = np.fromiter(chain.from_iterable(encoded), np.int32, int(counts.sum()))
            self.young.add(first + part, ids, counts)

    def _lookup(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end, and how many each has."""
        if len(self.young) > REMEMBERED // 2:
            self.young, self.old = Pieces(), self.young
        numbers = np.fromiter(map(self.young.__getitem__, pieces), np.int64, len(pieces))
        if self.young.fresh:
            self._learn()
        return self.young.ids_of(numbers)

    def encode_rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        counts = np.zeros(len(texts), np.int64)
        if not self.by_piece:
            lists = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
            counts[:] = [len(x) for x in lists]
            return np.array([i for x in lists for i in x], np.int32), counts
        out, pieces, owners = [np.zeros(0, np.int32)], [], []

        def settle() -> None:
            ids, sizes = self._lookup(pieces)
            out.append(ids)
            ends = np.append(0, np.cumsum(sizes))
            at = 0
            for row, n in owners:
                counts[row] += ends[at + n] - ends[at]
                at += n
            pieces.clear()
            owners.clear()

        for row, text in enumerate(texts):
            raw = text.encode()
            for at, end in _cuts(raw):
                own = pieces_of(raw[at:end])
                pieces.extend(own)
                owners.append((row, len(own)))
                if len(pieces) > _PIECES:
                    settle()
        settle()
        return np.concatenate(out), counts

    def encode(self, text: str) -> list[int]:
        return self.encode_rows([text])[0].tolist()


def encoder_of_worker(path: str, by_piece: bool) -> Encoder:
    """One encoder per Python worker, which serves many tasks: kept with the library itself, as
    this module travels to each task anew."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_martloom_encoders", {})
    if (path, by_piece) not in kept:
        kept[path, by_piece] = Encoder(path, by_piece)
    return kept[path, by_piece]


def _cuts(raw: bytes) -> Iterator[tuple[int, int]]:
    """Ranges of about _GROUP bytes that end at white space."""
    at = 0
    while at < len(raw):
        end = at + _GROUP
        while end < len(raw) and raw[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield at, min(end, len(raw))
        at = end


_PROBES = (
    "It's a  TEST, isn't it?\n\tÉté—naïve 42nd 3.14 <|endoftext|> ok no-break   é x́y "
    "don't 'll ' re 's\x0bq\x0cz\r\nline  İΣΣ end. <| start |> a<|startoftext|>b",
    "It's A  TEST, isn't IT? Yes!!! a.b,c;d:e!f?g#h$i%j&k*l 3.14,15 x.… … .x \tÉTÉ—Naïve 'S don'T",
)


def check_pieces(path: str) -> bool:
    """Whether encoding piece by piece gives what encoding the whole does, on a few probes."""
    whole, pieces = (Encoder(path, by_piece) for by_piece in (False, True))
    return all(whole.encode(x) == pieces.encode(x) for x in _PROBES)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    by_piece = check_pieces(tokenizer)
    ordered = (
        docs.select("doc_id", F.xxhash64("text").alias("_key"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), "_key")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_key")
        .select("doc_id", "text")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread
        encoder = encoder_of_worker(tokenizer, by_piece)
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                ids, counts = encoder.encode_rows(rows.column(1).to_pylist())
                ids = np.insert(ids, np.cumsum(counts), end_id)
                ends = np.append(0, np.cumsum(counts + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(counts + 1),
                        pa.array(np.full(len(counts), part, np.int32)),
                        pa.array(before + ends[:-1]),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                    ],
                    names=["doc_id", "n_tokens", "part", "before", "tokens"],
                )
                before += int(ends[-1])

    kind = docs.schema["doc_id"].dataType.simpleString()
    (
        ordered.mapInArrow(encode, _SCHEMA.format(kind=kind))
        .write.option("orc.compress", "ZSTD")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.row.index.stride", ROW_INDEX)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and tokens, from the files."""
    rows = spark.read.orc(path)
    # One row per writer.
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        F.col("part").alias("_part"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("_base")
    )
    if fits_broadcast(bases):
        bases = F.broadcast(bases)
    return rows.join(bases, F.col("part") == F.col("_part")).select(
        "doc_id", (F.col("_base") + F.col("before")).alias("start"), "n_tokens", "tokens"
    )


def with_crc32(rows: DataFrame) -> DataFrame:
    """`tokens` replaced by their number and the crc32 of their little-endian 32-bit forms."""
    schema = rows.drop("tokens", "n_tokens").schema.add("n_tokens", "long").add("ids_crc32", "long")
    keep = [c for c in rows.columns if c not in ("tokens", "n_tokens")]
    source = rows.select(*keep, "tokens")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(keep))
            ids = lists.values.to_numpy().astype("<u4")
            ends = np.asarray(lists.offsets)
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(np.diff(ends), pa.int64()), pa.array(crcs, pa.int64())],
                names=[*keep, "n_tokens", "ids_crc32"],
            )

    return source.mapInArrow(digest, schema)
