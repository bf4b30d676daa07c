import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from martloom.llm import structure_repair as repair

SPACES = " \t\n\x0b\x0c\r"
LEGAL = re.compile(r"(s?(ua)+)?")


def damage(rows):
    """(conv_id, turn, role, text) in order of turn and, within one, of the operator's hash."""
    out = {}
    for conv, turn, role, text in rows:
        text, role = (" " if x is None else x for x in (text, role))
        kept = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def judged(rows):
    """Fault of each row: gone, cut off, or none."""
    found, seen = [], set()
    for _, role, text in rows:
        end = text.rstrip(SPACES)[-1:]
        found.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(initials, faults):
    """Least (cost, audit), trying row by row; the roles so far are kept as a plain string."""
    steps = {"": "su", "s": "u", "u": "a", "a": "u"}

    def with_insertions(states):
        todo = list(states.items())
        while todo:
            last, (cost, audit) = todo.pop()
            for role in steps[last].replace("s", ""):
                new = (cost + 5, audit + "I")
                if role not in states or new < states[role]:
                    states[role] = new
                    todo.append((role, new))
        return states

    states = {"": (0, "")}
    for initial, fault in zip(initials, faults):
        after = {}

        def offer(last, cost, audit):
            if last not in after or (cost, audit) < after[last]:
                after[last] = (cost, audit)

        for last, (cost, audit) in with_insertions(states).items():
            offer(last, cost + 2, audit + "D")
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 * (fault == "truncated")
            for role in steps[last]:
                if role == initial:
                    offer(role, cost + extra, audit + "K")
                elif role != "s":
                    offer(role, cost + 1 + extra, audit + "R")
        states = after
    states = with_insertions(states)
    return min(states[last] for last in ("", "a") if last in states)


def every_edit(initials, faults, most=2):
    """Least (cost, audit) among all edits with up to `most` insertions in a row."""
    best = None
    gaps = ["".join(g) for n in range(most + 1) for g in itertools.product("ua", repeat=n)]
    options = []
    for initial, fault in zip(initials, faults):
        extra = 5 * (fault == "truncated")
        own = [("D", "", 2)]
        if fault not in ("blank", "duplicate"):
            own += [("K", initial, extra), ("R", "u", 1 + extra), ("R", "a", 1 + extra)]
        options.append(own)
    for inserted in itertools.product(gaps, repeat=len(initials) + 1):
        for edits in itertools.product(*options):
            roles, audit, cost = inserted[0], "I" * len(inserted[0]), 5 * len(inserted[0])
            for (letter, role, price), gap in zip(edits, inserted[1:]):
                roles, audit, cost = roles + role + gap, audit + letter + "I" * len(gap), cost + price + 5 * len(gap)
            if LEGAL.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def repaired_rows(rows, audit):
    out, left = [], list(rows)
    for letter in audit:
        last = out[-1][0][0] if out else ""
        following = "assistant" if last == "u" else "user"
        if letter == "I":
            out.append((following, ""))
            continue
        _, role, text = left.pop(0)
        if letter != "D":
            out.append((role if letter == "K" else following, text))
    assert not left
    return out


def plain(rows, order):
    out = Counter()
    for conv, kept in damage(sorted(rows, key=order)).items():
        initials, faults = [role[:1] for _, role, _ in kept], judged(kept)
        turns = [t for t, _, _ in kept if t is not None]
        cost, audit = cheapest(initials, faults)
        fixed = repaired_rows(kept, audit)
        assert LEGAL.fullmatch("".join(role[0] for role, _ in fixed))
        out[
            conv,
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            faults.count("blank"),
            faults.count("duplicate"),
            faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest(),
        ] += 1
    return out


COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def found(conversations):
    rows = repair.repaired(repair.damaged(repair.source_rows(conversations)))
    return Counter(map(tuple, rows.select(*COLUMNS).collect()))


def by_turn(conversations):
    """Order of the rows, ties by the operator's hash."""
    keyed = repair.source_rows(conversations).select("role", "text", "tie").distinct()
    ties = {(r[0], r[1]): r[2] for r in keyed.collect()}
    spaced = lambda x: " " if x is None else x
    low = -(2**70)
    return lambda row: (
        low if row[0] is None else row[0],
        low if row[1] is None else row[1],
        ties[spaced(row[2]), spaced(row[3])],
    )


def check(conversations):
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    expected = plain(rows, by_turn(conversations))
    assert found(conversations) == expected
    return expected


def test_equals_plain_version_on_table(spark, sf_dir):
    result = check(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    audits = "".join(row[7] for row in result)
    assert set(audits) >= set("KRD")


SCHEMA = "conv_id long, turn long, role string, text string"


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK_ROWS", 3)
    roles = ["system", "user", "assistant", "tool", "", None, "User", "ünknown"]
    texts = ["A sentence.", "no end", None, "", " \t\n\x0b\x0c\r", "End?  \r\n", "x" * 70_000 + "!", "é…"]
    random.seed(5)
    rows = [
        (random.choice([None, 1, 2, 3, 40]), random.choice([None, *range(60)]), random.choice(roles), random.choice(texts))
        for _ in range(400)
    ]
    rows += [(7, None, "user", "All turns null."), (7, None, "assistant", "Yes.")] + [(8, 5, "user", "The same row.")] * 20
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    # Columns named like the operator's own.
    check(frame.selectExpr("*", "1 AS copies", "2 AS tie", "'k' AS audit", "3 AS _kind", "4 AS first", "5 AS part"))
    assert found(frame.limit(0)) == Counter()


def test_lost_conversations_are_returned(spark):
    lost = [i for i in range(500) if zlib.crc32(f"{i}:0".encode()) % 20 == 0]
    rows = check(spark.createDataFrame([(i, 0, "user", "Hello.") for i in lost], SCHEMA))
    empty = hashlib.sha256(b"").hexdigest()
    assert rows == Counter({(i, 0, 0, 0, 0, 0, 0, "", empty): 1 for i in lost})


def test_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK_ROWS", 50)
    random.seed(6)
    rows = [(1, i, random.choice(["user", "assistant"]), f"Turn {i % 700}{random.choice('. ')}") for i in range(3_000)]
    check(spark.createDataFrame(rows, SCHEMA).repartition(8))


def test_plain_version_tries_all_edits():
    kinds = [("s", ""), ("u", ""), ("a", ""), ("x", ""), ("u", "truncated"), ("a", "truncated"), ("s", "truncated"), ("u", "blank")]
    for n in range(3):
        for rows in itertools.product(kinds, repeat=n):
            initials, faults = [r[0] for r in rows], [r[1] for r in rows]
            assert cheapest(initials, faults) == every_edit(initials, faults)
    random.seed(7)
    for _ in range(40):
        rows = random.choices(kinds, k=3)
        initials, faults = [r[0] for r in rows], [r[1] for r in rows]
        assert cheapest(initials, faults) == every_edit(initials, faults)


@pytest.mark.parametrize("n_rules", [0, 5, 40])
def test_rules_do_not_change_repairs(n_rules):
    random.seed(n_rules)
    letters = "suaxSUAXD"
    rules, known = [], list(letters)
    for i in range(n_rules):
        rules.append(random.choice(known) + random.choice(known))
        known.append(chr(repair.FIRST_RULE + i))
    matrices = repair.Matrices(rules)
    for _ in range(300):
        symbols = "".join(random.choices(letters, k=random.randrange(60)))
        faults = ["blank" if s == "D" else "truncated" if s.isupper() else "" for s in symbols]
        assert repair.repair(matrices.of_string(symbols)) == cheapest(symbols.lower(), faults)


def test_rules_are_frequent_pairs(spark):
    strings = spark.createDataFrame([("uauaua", 10), ("aaaa", 3), ("x", 9)], "symbols string, n long")
    rules = repair.learn_rules(strings, rounds=3, a_round=1, least=5)
    assert rules == ["ua", chr(repair.FIRST_RULE) * 2, chr(repair.FIRST_RULE + 1) + chr(repair.FIRST_RULE)]
    assert repair.learn_rules(strings.limit(0)) == []


def test_ropes_compare_as_strings():
    random.seed(8)
    for _ in range(2_000):
        pair = []
        for _ in range(2):
            parts = random.choices(["A", "AB", "B", "", "ABA", "BA"], k=random.randrange(6))
            rope = repair.Rope()
            for part in parts:
                rope = rope + repair.Rope(part) if random.random() < 0.5 else repair.Rope(part) + rope
            pair.append(rope)
        x, y = pair
        assert (x < y) == (str(x) < str(y)) and x.size == len(str(x))
