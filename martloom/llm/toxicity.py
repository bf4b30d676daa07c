"""Toxicity by a weighted grammar of clauses, made of finite-state transducers.

Words are read by a weighted automaton of stems: a word's bytes lead from state to state, and the
heaviest state on the way gives the word its weight. Stems are learned: for every beginning of a word, and
the whole word, the labelled documents that hold it give a log ratio of the classes; those that tell the
classes apart beyond chance (twice the log likelihood ratio reaches LEAST_RATIO) become states, where they
say more than the shorter stem they extend. Function words of four languages, which are fixed, tell
threats, targets, negations and reported speech.

A clause ends at `.`, `!`, `?`, `;`, `:` or a line break. What its words are becomes a string of
symbols, read by four small transducers, each the input of the next, composed into one automaton:

* reported speech marks insults and threats after a verb of saying, or within quotation marks;
* negation marks those after a negating word, unless NEGATED_WORDS words or more lie between;
* target marks those that are aimed at somebody addressed before in the clause;
* threat holds a verb of harm back until somebody is addressed.

What counts is thus the clause: an insult that is plain, aimed, denied or reported, and a threat, have
figures of their own. The sums of weights by kind (a word that is repeated counts once), the heaviest
clause, the number of matched clauses and their share are a document's evidence, which a logistic regression,
pulled towards the grammar's own arc weights (PRIOR) where labels say little, turns into a score. It
is fitted on evidence from stems of the other half of the sample, as stems flatter the texts they come from.

Stems and regression come from a bounded sample of labelled rows, TRAIN_ROWS of them on average,
chosen by a hash of the id; texts that are copies of each other count once. The model is of bounded
size therefore and travels to the workers; all documents are scored in one pass over whole texts,
without a shuffle.

Defined cases: a null or empty text has no evidence, and the score of such a text; a null id counts as
held out, and is never learned from; repeated rows are each scored; labels that are null, or for ids
without a document, are ignored, and of contradicting ones the toxic one holds; without labels of
both classes every score is 0; empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.words import IS_ALNUM, LOWER, Block, blocks, span_hashes, spans
from martloom.sources.scratch import stored

FOLDS, HELD_OUT = 5, 0
# Labelled rows that are learned from, on average.
TRAIN_ROWS = 8_000
# Bytes of the shortest and longest stem.
SHORTEST, LONGEST = 3, 16
# Toxic documents that must hold a stem, and twice the log likelihood ratio it must reach.
LEAST_DOCS, LEAST_RATIO = 4, 24.0
# What a stem must add to the log ratio of the shorter one.
LEAST_GAIN = 0.25
NEGATED_WORDS = 3
# What a verb of harm weighs.
THREAT_WEIGHT = 3.0

# Function words of English, German, French and Spanish.
THREATS = """kill hurt destroy punch stab shoot burn beat crush töten schlagen verletzen zerstören
tuer frapper détruire brûler matar golpear destruir quemar""".split()
TARGETS = """you your yours yourself u du dich dir dein deine euch ihr tu toi te ton ta votre vous
tú ti tus usted ustedes vosotros""".split()
NEGATIONS = """not no never none nobody without nicht kein keine nie niemals ohne pas jamais aucun
sans ni nunca ningún sin""".split()
REPORTS = """said says say told tells reported reports wrote claimed called quoted sagte sagt
schrieb meinte dit disait écrit affirme dijo dice escribió afirma""".split()

# Kinds of evidence.
PLAIN, AIMED, DENIED, REPORTED, THREATENED = range(5)
N_KINDS = 5
# The grammar's own weights: sums by kind, the heaviest clause, log of matched clauses, sum of
# weights over the square root of the number of words.
PRIOR = np.array([1.0, 1.5, 0.3, 0.3, 1.5, 0.5, 0.5, 0.0])
RIDGE = 2.0

_IS_END = np.zeros(256, bool)
_IS_END[list(b".!?;:")] = True


# --- transducers


@dataclass(frozen=True)
class Transducer:
    """A deterministic machine from symbols to symbols. What has no arc of its own passes as it
    is, in the same state."""

    start: str
    # (state, symbol) to (state, symbol given out).
    arcs: dict[tuple[str, str], tuple[str, str]]

    def step(self, state: str, symbol: str) -> tuple[str, str]:
        return self.arcs.get((state, symbol), (state, symbol))


def _reporting() -> Transducer:
    arcs = {}
    for state in ("said", "quoted"):
        arcs[state, "insult"] = (state, "reported insult")
        arcs[state, "threat"] = (state, "reported threat")
    arcs["own", "report"] = ("said", "report")
    arcs["own", "quote"] = ("quoted", "quote")
    arcs["said", "quote"] = ("quoted", "quote")
    arcs["quoted", "quote"] = ("own", "quote")
    arcs["said", "end"] = ("own", "end")
    return Transducer("own", arcs)


def _negating() -> Transducer:
    """`words` stands for a gap of other words wide enough to end a negation's reach."""
    arcs = {("open", "negation"): ("denied", "negation")}
    for symbol in ("insult", "threat"):
        arcs["denied", symbol] = ("open", f"denied {symbol}")
    for symbol in ("words", "end"):
        arcs["denied", symbol] = ("open", symbol)
    return Transducer("open", arcs)


def _aiming() -> Transducer:
    arcs = {
        ("nobody", "target"): ("somebody", "target"),
        ("somebody", "insult"): ("somebody", "aimed insult"),
        ("somebody", "threat"): ("somebody", "aimed threat"),
        ("somebody", "end"): ("nobody", "end"),
    }
    return Transducer("nobody", arcs)


def _threatening() -> Transducer:
    """A verb of harm waits for somebody to be named, unless they were already."""
    arcs = {
        ("calm", "threat"): ("waiting", "nothing"),
        ("waiting", "threat"): ("waiting", "nothing"),
        ("waiting", "target"): ("calm", "aimed threat"),
        ("waiting", "words"): ("calm", "words"),
        ("waiting", "end"): ("calm", "end"),
    }
    return Transducer("calm", arcs)


_OUTCOMES = {
    "insult": PLAIN,
    "aimed insult": AIMED,
    "denied insult": DENIED,
    "reported insult": REPORTED,
    "aimed threat": THREATENED,
}


def composed(machines: list[Transducer], alphabet: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """One automaton that does what the machines do in a row: following state, and the kind of
    evidence given out or -1, by state and symbol. State 0 is the start."""
    states = {tuple(m.start for m in machines): 0}
    following, given = [], []
    todo = list(states)
    for state in todo:
        row, out = [], []
        for symbol in alphabet:
            after = []
            for machine, own in zip(machines, state):
                own, symbol = machine.step(own, symbol)
                after.append(own)
            after = tuple(after)
            if after not in states:
                states[after] = len(states)
                todo.append(after)
            row.append(states[after])
            out.append(_OUTCOMES.get(symbol, -1))
        following.append(row)
        given.append(out)
    return np.array(following), np.array(given)


ALPHABET = ["insult", "threat", "target", "negation", "report", "quote", "words", "end"]
INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, WORDS, END = range(len(ALPHABET))
FOLLOWING, GIVEN = composed([_reporting(), _negating(), _aiming(), _threatening()], ALPHABET)


# --- words, stems and clauses


def _plain(block: Block) -> np.ndarray:
    """Lower-case bytes, with quotation marks beyond ASCII as spaces and a plain one."""
    data = LOWER[block.data]
    for lead, second, third in ((0xE2, 0x80, (0x9C, 0x9D, 0x9E)), (0xC2, None, (0xAB, 0xBB))):
        at = np.flatnonzero(data == lead)
        size = 2 if second is None else 3
        at = at[at + size <= len(data)]
        if second is not None:
            at = at[data[at + 1] == second]
        at = at[np.isin(data[at + size - 1], third)]
        data[at] = ord('"')
        for i in range(1, size):
            data[at + i] = ord(" ")
    return data


def _heads(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first three bytes of words, zeros after shorter ones."""
    head = data[starts].astype(np.uint32) << 16
    for i, shift in ((1, 8), (2, 0)):
        long = ends - starts > i
        head[long] |= data[starts[long] + i].astype(np.uint32) << shift
    return head


def _whole_word(hashes: np.ndarray) -> np.ndarray:
    """The state at a word's end is another than that of a stem with the same bytes."""
    return hashes ^ np.uint64(0x5DEECE66D)


def _states(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of words and the hashes of their states, shortest first, word ends last."""
    for size in range(SHORTEST, LONGEST + 1):
        long = np.flatnonzero(ends - starts > size)
        cut = starts[long] + size
        between = (data[cut] & 0xC0) != 0x80  # code points stay whole
        long, cut = long[between], cut[between]
        yield long, span_hashes(data, starts[long], cut)
    yield np.arange(len(starts)), _whole_word(span_hashes(data, starts, ends))


def _hash_of(words: list[str]) -> np.ndarray:
    raw = "".join(words).encode()
    ends = np.cumsum([len(w.encode()) for w in words])
    starts = ends - [len(w.encode()) for w in words]
    return _whole_word(span_hashes(np.frombuffer(raw, np.uint8), starts, ends))


@dataclass
class Lexicon:
    """Hashes of stems and words, in order, with what they are and weigh."""

    hashes: np.ndarray
    symbols: np.ndarray
    weights: np.ndarray
    heads: np.ndarray  # first three bytes of the entries, as numbers

    @cached_property
    def begins(self) -> np.ndarray:
        """Whether some entry begins with three given bytes; made where it is used, as it is
        much larger than what it is made from."""
        table = np.zeros(1 << 24, bool)
        table[self.heads] = True
        return table


def lexicon(stems: np.ndarray, weights: np.ndarray, heads: np.ndarray) -> Lexicon:
    fixed = [(THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)]
    hashes, symbols, own = [stems], [np.full(len(stems), INSULT)], [weights]
    first = [heads.astype(np.int64)]
    for symbol, words in fixed:
        hashes.append(_hash_of(words))
        symbols.append(np.full(len(words), symbol))
        own.append(np.zeros(len(words)))
        first.append(np.array([int.from_bytes(w.encode()[:3].ljust(3, b"\0")) for w in words]))
    every = np.concatenate(hashes)
    order = np.argsort(every, kind="stable")
    return Lexicon(every[order], np.concatenate(symbols)[order], np.concatenate(own)[order], np.unique(np.concatenate(first)))


def evidence(block: Block, known: Lexicon) -> np.ndarray:
    """A row of figures for each text of the block; see PRIOR."""
    data = _plain(block)
    starts, ends = spans(block, IS_ALNUM[data])
    out = np.zeros((block.rows, len(PRIOR)))
    n_words = np.bincount(block.row_of(starts), minlength=block.rows)
    likely = np.flatnonzero(known.begins[_heads(data, starts, ends)])
    symbol, weight = np.full(len(likely), -1), np.zeros(len(likely))
    for words, name in _states(data, starts[likely], ends[likely]):
        at = np.minimum(np.searchsorted(known.hashes, name), len(known.hashes) - 1)
        met = known.hashes[at] == name
        words, at = words[met], at[met]
        better = (known.weights[at] > weight[words]) | (symbol[words] < 0)
        words, at = words[better], at[better]
        symbol[words], weight[words] = known.symbols[at], known.weights[at]
    told = symbol >= 0  # `name` holds the hashes of whole words now
    places, symbols, weights = starts[likely][told], symbol[told], weight[told]
    names, numbers = name[told], likely[told]
    weights[symbols == THREAT] = THREAT_WEIGHT

    # Lines that hold an insult or a verb of harm; the automaton starts anew in each.
    breaks = data == 10
    breaks[block.bounds[1:-1][block.bounds[1:-1] < len(data)]] = True
    line_at = np.cumsum(breaks) if len(data) else np.zeros(0, np.int64)
    harmful = line_at[places[(symbols == INSULT) | (symbols == THREAT)]]
    if not len(harmful):
        return out
    quotes = np.flatnonzero(data == ord('"'))
    quotes = quotes[np.isin(line_at[quotes], harmful)]
    near = np.isin(line_at[places], harmful)
    places = np.concatenate([places[near], quotes])
    order = np.argsort(places, kind="stable")
    places = places[order]
    symbols = np.append(symbols[near], np.full(len(quotes), QUOTE))[order].tolist()
    weights = np.append(weights[near], np.zeros(len(quotes)))[order].tolist()
    names = np.append(names[near], np.zeros(len(quotes), np.uint64))[order].tolist()
    # Words before the symbol, and up to its end.
    until = np.append(numbers[near], np.searchsorted(starts, quotes))[order].tolist()
    after = np.append(numbers[near] + 1, np.searchsorted(starts, quotes))[order].tolist()
    clauses = np.cumsum(_IS_END[data] | breaks)[places].tolist()
    lines, rows = line_at[places].tolist(), block.row_of(places).tolist()

    following, given = FOLLOWING.tolist(), GIVEN.tolist()
    line = clause = None
    state = 0
    heaviest: dict[tuple[int, int], float] = {}
    counted: set[tuple[int, int, int]] = set()
    for i, symbol_ in enumerate(symbols):
        if lines[i] != line:
            state = 0
        else:
            if clauses[i] != clause:
                state = following[state][END]
            if until[i] - after[i - 1] >= NEGATED_WORDS:
                state = following[state][WORDS]
        line, clause = lines[i], clauses[i]
        kind = given[state][symbol_]
        state = following[state][symbol_]
        if kind < 0:
            continue
        row, mine = rows[i], weights[i] or THREAT_WEIGHT
        heaviest[row, clause] = heaviest.get((row, clause), 0.0) + mine
        if (row, kind, names[i]) not in counted:
            counted.add((row, kind, names[i]))
            out[row, kind] += mine
    for (row, _), mine in heaviest.items():
        out[row, N_KINDS] = max(out[row, N_KINDS], mine)
        out[row, N_KINDS + 1] += 1
    out[:, N_KINDS + 1] = np.log1p(out[:, N_KINDS + 1])
    out[:, N_KINDS + 2] = out[:, :N_KINDS].sum(1) / np.sqrt(np.maximum(n_words, 1))
    return out


# --- learning


def held_out(doc_id: Column) -> Column:
    """A null id counts as the empty text, whose remainder is 0."""
    key = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.pmod(key, F.lit(FOLDS)) == HELD_OUT


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, half): about TRAIN_ROWS labelled texts outside the fold held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    n = known.count()
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    chosen = known.where(chance < min(1.0, TRAIN_ROWS / max(n, 1)))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by TRAIN_ROWS
    texts = texts.groupBy(F.coalesce("text", F.lit("")).alias("text")).agg(F.max("toxic").alias("toxic"))
    return stored(texts.withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int")))


def state_counts(texts: DataFrame) -> DataFrame:
    """(state, parent, head, and by class and half the number of texts that hold the state)."""
    schema = "state long, parent long, head int, c00 long, c01 long, c10 long, c11 long"
    names = [f.split()[0] for f in schema.split(", ")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            group = 2 * toxic + batch.column(2).to_numpy()
            for block in blocks(batch.column(0)):
                data = _plain(block)
                starts, ends = spans(block, IS_ALNUM[data])
                rows, heads = block.row_of(starts), _heads(data, starts, ends)
                last = np.zeros(len(starts), np.uint64)
                found = []
                for words, hashes in _states(data, starts, ends):
                    # A state of a word once for each text.
                    _, first = np.unique(hashes ^ (rows[words].astype(np.uint64) << np.uint64(40)), return_index=True)
                    kept = words[first]
                    own = group[block.first + rows[kept]]
                    found.append((hashes[first], last[kept], heads[kept], own))
                    last[words] = hashes
                states, parents, heads_, own = (np.concatenate(c) for c in zip(*found))
                distinct, first, index = np.unique(states, return_index=True, return_inverse=True)
                counts = np.bincount(index * 4 + own, minlength=4 * len(distinct)).reshape(-1, 4)
                columns = [
                    distinct.view(np.int64),
                    parents[first].view(np.int64),
                    heads_[first].astype(np.int32),
                    *counts.T.astype(np.int64),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    sums = [F.sum(c).alias(c) for c in names[3:]]
    parts = texts.select("text", "toxic", "half").mapInArrow(count, schema)
    return parts.groupBy("state").agg(F.min("parent").alias("parent"), F.min("head").alias("head"), *sums)


def _log_ratio(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    return np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))


def _likelihood_ratio(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    share = n_toxic / (n_toxic + n_clean)
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [
            np.where(n > 0, n * np.log(n / ((toxic + clean) * p)), 0.0)
            for n, p in ((toxic, share), (clean, 1 - share))
        ]
    return 2 * (parts[0] + parts[1])


def choose(
    states: np.ndarray, parents: np.ndarray, heads: np.ndarray, toxic: np.ndarray, clean: np.ndarray, sizes: tuple[int, int]
) -> Lexicon:
    ratio = _log_ratio(toxic, clean, *sizes)
    sure = (toxic >= LEAST_DOCS) & (ratio > 0) & (_likelihood_ratio(toxic, clean, *sizes) >= LEAST_RATIO)
    weight = dict(zip(states[sure].tolist(), ratio[sure].tolist()))
    shorter = [weight.get(p, 0.0) for p in parents[sure].tolist()]
    says_more = ratio[sure] >= np.array(shorter) + LEAST_GAIN if len(shorter) else np.zeros(0, bool)
    kept = np.flatnonzero(sure)[says_more]
    return lexicon(states[kept].view(np.uint64), ratio[kept], heads[kept])


def regression(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Offset and slopes, the slopes pulled towards PRIOR; by Newton's method."""
    offset, slopes = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))), PRIOR.copy()
    both = np.column_stack([np.ones(len(x)), x])
    pull = np.diag([1e-6] + [RIDGE] * len(PRIOR))
    theta, centre = np.append(offset, slopes), np.append(offset, PRIOR)

    def loss(t: np.ndarray) -> float:
        z = both @ t
        return float(np.sum(np.logaddexp(0, z) - y * z) + 0.5 * (t - centre) @ pull @ (t - centre))

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(both @ theta, -500, 500)))
        slope = both.T @ (p - y) + pull @ (theta - centre)
        curve = (both * (p * (1 - p))[:, None]).T @ both + pull
        step, rate = np.linalg.solve(curve, slope), 1.0
        while rate > 1e-6 and loss(theta - rate * step) > loss(theta):
            rate /= 2
        theta = theta - rate * step
        if np.abs(rate * step).max() < 1e-9:
            break
    return float(theta[0]), theta[1:]


@dataclass
class Model:
    known: Lexicon
    offset: float
    slopes: np.ndarray = field(default_factory=lambda: PRIOR)


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """None without labels of both classes."""
    texts = sample(docs, labels)
    sizes = np.zeros((2, 2), np.int64)
    for row in texts.groupBy("toxic", "half").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[int(row["toxic"]), row["half"]] = row["n"]
    if not sizes.sum(1).all():
        return None
    # Bounded, as the sample is: states that occur in several toxic texts of some thousand.
    counts = state_counts(texts).where(F.col("c10") + F.col("c11") >= LEAST_DOCS).toArrow()
    states, parents, heads, *n = (np.asarray(c) for c in counts.columns)
    heads = heads.astype(np.int64)
    clean, toxic = np.stack(n[:2]), np.stack(n[2:])

    def of(halves: list[int]) -> Lexicon:
        size = (int(sizes[1, halves].sum()), int(sizes[0, halves].sum()))
        return choose(states, parents, heads, toxic[halves].sum(0), clean[halves].sum(0), size)

    other = [of([1]), of([0])]
    width = len(PRIOR)

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = batch.column(2).to_numpy()
            x = np.zeros((batch.num_rows, width))
            for i in (0, 1):
                rows = np.flatnonzero(half == i)
                column = batch.column(0).take(pa.array(rows))
                x[rows] = np.concatenate([np.zeros((0, width)), *(evidence(b, other[i]) for b in blocks(column))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width).cast(pa.list_(pa.float64()))],
                names=["toxic", "x"],
            )

    rows = texts.select("text", "toxic", "half").mapInArrow(figures, "toxic boolean, x array<double>").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([float(r["toxic"]) for r in rows])
    return Model(of([0, 1]), *regression(x, y))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted and the number of `clauses` matched, of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            parts = [np.zeros((0, len(PRIOR)))]
            if own is not None:
                parts += [evidence(block, own.known) for block in blocks(batch.column(1))]
                x = np.concatenate(parts)
                z = np.clip(own.offset + x @ own.slopes, -500, 500)
                scores, clauses = 1 / (1 + np.exp(-z)), np.rint(np.expm1(x[:, N_KINDS + 1])).astype(np.int64)
            else:
                scores, clauses = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array(clauses)], names=["doc_id", "score", "clauses"]
            )

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, clauses long")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "clauses",
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, learn(docs, labels))
