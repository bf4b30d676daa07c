"""Cheapest repair of conversation structure, over a grammar of role and fault sequences.

A conversation's rows, in order of turn, become a string of symbols: the role's initial, or another
letter, in one of two forms (sound, cut off), and one symbol for rows that must go (blank or
repeated). A repair keeps, reroles or deletes each row and may insert empty ones; the roles left
must follow `(s?(ua)+)?`, an automaton of four states.

Grammar. Distinct strings of all conversations are compressed by Re-Pair: the most frequent pairs of
neighbouring symbols become rules, round by round, counted over all strings by grouped aggregates.
The grammar is small (ROUNDS times RULES_A_ROUND rules); how well it fits changes the cost of
what follows, never its result.

Transfer matrices. For a symbol the matrix holds, for every pair of automaton states, the cheapest
edits that lead from one to the other across its rows: their cost and their letters. Costs add and
the lesser is taken (min-plus); equal costs are told apart by the letters, least in ASCII order. That
order survives concatenation: of two edit strings for the same rows with one cost none is the
beginning of the other, as any further letter would be an insertion and cost more. A rule's matrix is the
product of its two parts' matrices, made once, bottom-up, for all conversations. Letters are ropes:
trees whose leaves are shared by everything made from the same rule; they are compared by length
and hash from the top, so equal parts are not read, and spelt out for the answer only.

A long conversation is cut into chunks, one matrix each; chunk matrices are multiplied in order as a
balanced product. No rows of a conversation are gathered but its audit string, which the result
holds anyway. Its digest needs its texts in order in one stream: rows sorted by conversation pass by
an open digest, one at a time, whatever their number.

Defined cases: a null conv_id, role or text counts as one space, null turns come first, and gaps
ignore them; rows of one turn are ordered by a hash of role and text, repeated rows all count (the
later ones as duplicates); roles are known by their first character; a role that is neither system, user nor
assistant cannot be kept; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.sources.scratch import stored

KEEP, REROLE, DELETE, INSERT = "KRDI"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
CUT_OFF = 5  # for a row that ends nowhere and stays

SPACES = " \t\n\x0b\x0c\r"
CHUNK_ROWS = 1_000
ROUNDS, RULES_A_ROUND = 6, 32
# Pairs seen less often make no rule.
LEAST_USES = 8

# Symbols: rows that must go; rows by initial, sound or cut off.
GONE = "D"
SOUND = {"s": "s", "u": "u", "a": "a"}
CUT = {"s": "S", "u": "U", "a": "A"}
OTHER, CUT_OTHER = "x", "X"
FIRST_RULE = 0x100  # rules are the characters from here on

# The automaton: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
ACCEPTED = (START, ASSISTANT)


# --- ropes and matrices


_PRIME, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E687 % ((1 << 61) - 1)


class Rope:
    """A string as a tree of shared parts, with its length and hash."""

    __slots__ = ("text", "left", "right", "size", "digest", "power")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.size, self.digest, self.power = len(text), 0, 1
            for letter in text:
                self.digest = (self.digest * _BASE + ord(letter)) % _PRIME
                self.power = self.power * _BASE % _PRIME
        else:
            self.size = left.size + right.size
            self.digest = (left.digest * right.power + right.digest) % _PRIME
            self.power = left.power * right.power % _PRIME

    def __add__(self, other: Rope) -> Rope:
        if not other.size:
            return self
        return Rope(left=self, right=other) if self.size else other

    def __str__(self) -> str:
        leaves, rest = [], [self]
        while rest:
            node = rest.pop()
            if node.left is None:
                leaves.append(node.text)
            else:
                rest += (node.right, node.left)
        return "".join(leaves)

    def __lt__(self, other: Rope) -> bool:
        mine, yours = [self], [other]
        while mine and yours:
            x, y = mine.pop(), yours.pop()
            if x is y or (x.size == y.size and x.digest == y.digest):
                continue
            if x.left is None and y.left is None:
                n = min(x.size, y.size)
                if x.text[:n] != y.text[:n]:
                    return x.text[:n] < y.text[:n]
                if x.size > n:
                    mine.append(Rope(x.text[n:]))
                if y.size > n:
                    yours.append(Rope(y.text[n:]))
            elif y.left is None or (x.left is not None and x.size >= y.size):
                mine += (x.right, x.left)
                yours.append(y)
            else:
                mine.append(x)
                yours += (y.right, y.left)
        return not mine and bool(yours)


Cell = tuple[int, Rope]
Matrix = dict[tuple[int, int], Cell]


def _better(new: Cell, old: Cell | None) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and new[1] < old[1])


def times(first: Matrix, then: Matrix) -> Matrix:
    by_start: dict[int, list[tuple[int, Cell]]] = {}
    for (a, b), cell in then.items():
        by_start.setdefault(a, []).append((b, cell))
    cells: Matrix = {}
    for (a, b), (cost, rope) in first.items():
        for c, (more, rest) in by_start.get(b, ()):
            old = cells.get((a, c))
            if old is None or cost + more <= old[0]:
                new = (cost + more, rope + rest)
                if _better(new, old):
                    cells[a, c] = new
    return cells


def _insertions() -> Matrix:
    """No insertion, or the fewest that lead from state to state."""
    cells: Matrix = {(q, q): (0, Rope()) for q in range(4)}
    for start in (START, SYSTEM, USER, ASSISTANT):
        state, made = start, ""
        while True:
            following = STEP.get((state, "u")) or STEP.get((state, "a"))
            made += INSERT
            if (start, following) in cells:
                break
            cells[start, following] = (COSTS[INSERT] * len(made), Rope(made))
            state = following
    return cells


INSERTIONS = _insertions()


def terminal(symbol: str) -> Matrix:
    """Insertions before a row, and what may be done with the row."""
    row: Matrix = {(q, q): (COSTS[DELETE], Rope(DELETE)) for q in range(4)}
    if symbol != GONE:
        initial, extra = symbol.lower(), CUT_OFF if symbol.isupper() else 0
        for (a, letter), b in STEP.items():
            if letter == initial:
                row[a, b] = (COSTS[KEEP] + extra, Rope(KEEP))
            elif letter != "s":
                row[a, b] = (COSTS[REROLE] + extra, Rope(REROLE))
    return times(INSERTIONS, row)


IDENTITY: Matrix = {(q, q): (0, Rope()) for q in range(4)}


class Matrices:
    """Matrices of symbols and rules, and of strings met before."""

    REMEMBERED = 20_000

    def __init__(self, rules: list[str]):
        self.of = {s: terminal(s) for s in [GONE, OTHER, CUT_OTHER, *SOUND.values(), *CUT.values()]}
        self.rules = [(pair, chr(FIRST_RULE + i)) for i, pair in enumerate(rules)]
        for pair, symbol in self.rules:
            self.of[symbol] = times(self.of[pair[0]], self.of[pair[1]])
        self.strings: dict[str, Matrix] = {}

    def of_string(self, symbols: str) -> Matrix:
        found = self.strings.get(symbols)
        if found is None:
            parts: list[tuple[int, Matrix]] = []
            for symbol in compressed(symbols, self.rules):
                push(parts, self.of[symbol])
            found = product(parts)
            if len(self.strings) >= self.REMEMBERED:
                self.strings.clear()
            self.strings[symbols] = found
        return found


def push(parts: list[tuple[int, Matrix]], matrix: Matrix) -> None:
    """Add a factor to a product whose parts are of falling size, so that ropes stay shallow."""
    size = 1
    while parts and parts[-1][0] <= size:
        left, before = parts.pop()
        matrix, size = times(before, matrix), size + left
    parts.append((size, matrix))


def product(parts: list[tuple[int, Matrix]]) -> Matrix:
    whole = IDENTITY
    for _, matrix in reversed(parts):
        whole = times(matrix, whole)
    return whole


def repair(matrix: Matrix) -> tuple[int, str]:
    """Cost and letters of the cheapest repair of a conversation with this matrix."""
    ended = times(matrix, INSERTIONS)
    best: Cell | None = None
    for state in ACCEPTED:
        cell = ended.get((START, state))
        if cell is not None and _better(cell, best):
            best = cell
    return best[0], str(best[1])


# --- the grammar


def compressed(symbols: str, rules: list[tuple[str, str]]) -> str:
    for pair, symbol in rules:
        symbols = symbols.replace(pair, symbol)
    return symbols


def learn_rules(
    strings: DataFrame, rounds: int = ROUNDS, a_round: int = RULES_A_ROUND, least: int = LEAST_USES
) -> list[str]:
    """Pairs that become rules, in order, from (symbols, n). Rule i is the character FIRST_RULE + i."""
    rules: list[str] = []
    for _ in range(rounds):
        known = [(pair, chr(FIRST_RULE + i)) for i, pair in enumerate(rules)]

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pairs: Counter[str] = Counter()
            for batch in batches:
                for symbols, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    short = compressed(symbols, known)
                    last = -1
                    for i in range(len(short) - 1):
                        # Of three equal symbols in a row only two make a pair.
                        if short[i] == short[i + 1] and last == i - 1 and short[i - 1] == short[i]:
                            continue
                        last = i
                        pairs[short[i : i + 2]] += n
            yield pa.RecordBatch.from_pydict(
                {"pair": pa.array(pairs.keys(), pa.string()), "n": pa.array(pairs.values(), pa.int64())}
            )

        counts = strings.mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        top = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "pair").limit(a_round)
        found = [row["pair"] for row in top.collect()]
        rules += found
        if not found:
            break
    return rules


# --- rows, symbols, audits


def _spaced(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def source_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, `tie` (order of rows of one turn) and `copies`, all sound."""
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        _spaced(F.col("role")).alias("role"),
        _spaced(F.col("text")).alias("text"),
    )
    return rows.withColumns({"tie": F.xxhash64("role", "text"), "copies": F.lit(1)})


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of `source_rows` with one of five faults in a quarter of them, by a hash of their place."""
    key = F.concat(_spaced(F.col("conv_id")), F.lit(":"), _spaced(F.col("turn")))
    kind = F.pmod(F.crc32(key), F.lit(20))
    text, role, copies = F.col("text"), F.col("role"), F.col("copies")
    return rows.withColumns(
        {
            "text": F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text),
            "role": F.when(kind == 4, "user").otherwise(role),
            "copies": F.when(kind == 0, 0).when(kind == 3, 2 * copies).otherwise(copies),
        }
    )


def faults(rows: DataFrame) -> DataFrame:
    """`rows` without texts, with `blank`, `cut` and `seen` (role and text stand earlier in the
    conversation, other than in the row right before)."""
    initial = F.left("role", F.lit(1))
    ended = F.rtrim("text", F.lit(SPACES))
    marked = stored(
        rows.select(
            "conv_id",
            "turn",
            "tie",
            "copies",
            initial.alias("initial"),
            (ended == "").alias("blank"),
            (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("cut"),
            F.xxhash64("role", "text").alias("a"),
            F.xxhash64(F.lit(1), "text", "role").alias("b"),
        )
    )
    place = F.struct("turn", "tie")
    told = marked.where(~F.col("blank") & (F.col("copies") > 0))
    # One row per map task and group at most: a text repeated without end is no hot group.
    first = (
        told.groupBy("conv_id", "a", "b")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(F.col("first") != F.col("last"))
        .select(F.col("conv_id").alias("c"), F.col("a").alias("a1"), F.col("b").alias("b1"), "first")
    )
    first = stored(first)  # so that the join is of plain shuffles, which the engine may split
    same = marked["conv_id"].eqNullSafe(first["c"]) & (F.col("a") == F.col("a1")) & (F.col("b") == F.col("b1"))
    seen = F.coalesce(~F.col("blank") & (place > F.col("first")), F.lit(False))
    return marked.join(first, same, "left").select(
        "conv_id", "turn", "tie", "copies", "initial", "blank", "cut", seen.alias("seen")
    )


_LEGAL = {"su", "ua", "au"}
_CHUNK = [
    ("part", pa.int32()),
    ("no", pa.int64()),
    ("symbols", pa.string()),
    ("first_turn", pa.int64()),
    ("last_turn", pa.int64()),
    ("turns", pa.int64()),
    ("blank", pa.int64()),
    ("duplicate", pa.int64()),
    ("truncated", pa.int64()),
    ("illegal", pa.int64()),
    ("first", pa.string()),
    ("last", pa.string()),
]
_AUDIT = [
    ("gaps", pa.int64()),
    ("blank", pa.int64()),
    ("duplicate", pa.int64()),
    ("truncated", pa.int64()),
    ("illegal", pa.int64()),
    ("cost", pa.int64()),
    ("audit", pa.string()),
]


def _schema(rows: DataFrame, columns: list[tuple[str, pa.DataType]]) -> str:
    kinds = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string"}
    own = rows.schema["conv_id"].dataType.simpleString()
    return ", ".join([f"conv_id {own}", *(f"{name} {kinds[kind]}" for name, kind in columns)])


def _batches(
    found: Iterator[tuple], conv_type: list[pa.DataType], columns: list[tuple[str, pa.DataType]]
) -> Iterator[pa.RecordBatch]:
    """Tuples (conv_id and `columns`) as batches; `conv_type` is known once there is a tuple."""
    names = ["conv_id", *(name for name, _ in columns)]
    while rows := list(islice(found, 1_000)):
        types = [conv_type[0], *(kind for _, kind in columns)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _rows_of(batches: Iterator[pa.RecordBatch], conv_type: list[pa.DataType]) -> Iterator[tuple]:
    for batch in batches:
        conv_type[:] = [batch.schema.field(0).type]
        for at in range(0, batch.num_rows, 1_000):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 1_000).columns))


class _Chunk:
    """What is known of some rows of a conversation that stand one after the other."""

    def __init__(self):
        self.symbols: list[str] = []
        self.first_turn = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None

    def add(self, turn: int | None, initial: str, blank: bool, cut: bool, repeated: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        if self.last is None:
            self.first = initial
        elif self.last + initial not in _LEGAL:
            self.illegal += 1
        self.last = initial
        if blank or repeated:
            self.symbols.append(GONE)
            self.blank += blank
            self.duplicate += not blank
        else:
            self.truncated += cut
            self.symbols.append((CUT if cut else SOUND).get(initial, CUT_OTHER if cut else OTHER))

    def values(self) -> tuple:
        own = dict(vars(self), symbols="".join(self.symbols))
        return tuple(own[name] for name, _ in _CHUNK[2:])


def chunks(rows: DataFrame) -> DataFrame:
    """Rows of `faults` as chunks in order of (part, no); an empty chunk for rows all lost."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("tie").asc()]
    columns = ["conv_id", "turn", "tie", "copies", "initial", "blank", "cut", "seen"]
    ordered = rows.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv_type = TaskContext.get().partitionId(), []

        def found() -> Iterator[tuple]:
            no, chunk, own, before = 0, None, None, None
            for conv, turn, tie, copies, initial, blank, cut, seen in _rows_of(batches, conv_type):
                if chunk is None or conv != own:
                    if chunk is not None:
                        yield (own, part, no, *chunk.values())
                        no += 1
                    chunk, own = _Chunk(), conv
                for _ in range(copies):
                    if len(chunk.symbols) >= CHUNK_ROWS:
                        yield (own, part, no, *chunk.values())
                        no += 1
                        chunk = _Chunk()
                    # Rows alike in all stand side by side, in one partition.
                    chunk.add(turn, initial, blank, cut, seen or before == (conv, turn, tie))
                    before = (conv, turn, tie)
            if chunk is not None:
                yield (own, part, no, *chunk.values())

        yield from _batches(found(), conv_type, _CHUNK)

    return ordered.mapInArrow(cut_up, _schema(rows, _CHUNK))


class _Conversation:
    """Chunks of a conversation, in order, and the balanced product of their matrices."""

    def __init__(self):
        self.parts: list[tuple[int, Matrix]] = []
        self.first_turn = self.last_turn = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, matrices: Matrices, values: tuple) -> None:
        chunk = dict(zip((name for name, _ in _CHUNK[2:]), values))
        if not chunk["symbols"]:
            return
        push(self.parts, matrices.of_string(chunk["symbols"]))
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + chunk[name])
        if self.last is not None and self.last + chunk["first"] not in _LEGAL:
            self.illegal += 1
        self.last = chunk["last"]
        if chunk["turns"]:
            self.turns += chunk["turns"] - (chunk["first_turn"] == self.last_turn)
            self.last_turn = chunk["last_turn"]
            if self.first_turn is None:
                self.first_turn = chunk["first_turn"]

    def values(self) -> tuple:
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        cost, audit = repair(product(self.parts))
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit)


def audits(pieces: DataFrame, rules: list[str]) -> DataFrame:
    """Per conversation its faults, and cost and letters of its repair, from its chunks."""
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices, conv_type = Matrices(rules), []

        def found() -> Iterator[tuple]:
            conversation, own = None, None
            for conv, _part, _no, *values in _rows_of(batches, conv_type):
                if conversation is None or conv != own:
                    if conversation is not None:
                        yield (own, *conversation.values())
                    conversation, own = _Conversation(), conv
                conversation.add(matrices, values)
            if conversation is not None:
                yield (own, *conversation.values())

        yield from _batches(found(), conv_type, _AUDIT)

    return ordered.mapInArrow(run, _schema(pieces, _AUDIT))


# --- repaired texts


class Repairer:
    """Applies an audit to the rows of one conversation, as they come."""

    ROLES = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _say(self, role: str) -> str:
        self.state = STEP[self.state, role[0]]
        return role

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == INSERT:
            self.at += 1
            yield self._say(self.ROLES[self.state]), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """What stands in the row's place, and inserted before it."""
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == KEEP:
            yield self._say(role), text
        elif letter == REROLE:
            yield self._say(self.ROLES[self.state]), text


def digests(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """`audited` with the digest of each conversation's repaired rows, `role:text` by lines."""
    own = [name for name, _ in _AUDIT]
    out = [*_AUDIT, ("repaired_sha256", pa.string())]
    texts = rows.where("copies > 0").withColumn("_kind", F.lit(1))
    heads = audited.withColumn("_kind", F.lit(0))
    columns = ["conv_id", "_kind", "turn", "tie", "copies", "role", "text", *own]
    both = heads.unionByName(texts, allowMissingColumns=True).select(*columns)
    # An audit comes before the rows of its conversation, which pass by one at a time.
    ordered = both.repartition("conv_id").sortWithinPartitions(
        "conv_id", "_kind", F.col("turn").asc_nulls_first(), "tie"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type: list[pa.DataType] = []

        def found() -> Iterator[tuple]:
            head = repairer = digest = None

            def say(rows: Iterator[tuple[str, str]]) -> None:
                nonlocal said
                for role, text in rows:
                    digest.update((f"\n{role}:{text}" if said else f"{role}:{text}").encode())
                    said = True

            def ended() -> tuple:
                say(repairer.inserted())
                return (*head, digest.hexdigest())

            said = False
            for conv, kind, _turn, _tie, copies, role, text, *audit in _rows_of(batches, conv_type):
                if kind == 0:
                    if head is not None:
                        yield ended()
                    head, repairer, digest, said = (conv, *audit), Repairer(audit[-1]), hashlib.sha256(), False
                    continue
                for _ in range(copies):
                    say(repairer.row(role, text))
            if head is not None:
                yield ended()

        yield from _batches(found(), conv_type, out)

    return ordered.mapInArrow(run, _schema(rows, out))


def repaired(rows: DataFrame) -> DataFrame:
    """Per conversation of `source_rows`, damaged or not: faults, cost, audit and digest."""
    pieces = stored(chunks(faults(rows)))
    strings = pieces.where("symbols <> ''").groupBy("symbols").agg(F.count(F.lit(1)).alias("n"))
    rules = learn_rules(stored(strings))
    return digests(rows, audits(pieces, rules))
