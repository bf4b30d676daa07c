import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import chat_format as c

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, loss int"
PIECES = st.sampled_from(
    ["<|im_start|>", "<|im_end|>", "<|nl|>", "<|", "<\\|", "<\\\\|", "|>", "\n", "\\", "<", "a é", "assistant\n", "$1", ""]
)
HOSTILE = st.lists(PIECES, max_size=7).map("".join)


def check(spark, rows):
    formatted = c.format_conversations(
        spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    )
    read = {r.conv_id: r for r in c.read_back(formatted).collect()}
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    assert read.keys() == by_conv.keys()
    for conv, turns in by_conv.items():
        turns.sort()
        assert [(t.role, t.text) for t in read[conv].turns] == [t[1:] for t in turns]
        assert read[conv].round_trips
        assert read[conv].loss_text == "".join(t[2] for t in turns if t[1] == "assistant")
    digests = {r.conv_id: r for r in c.digests(c.read_back(formatted)).collect()}
    for conv, turns in by_conv.items():
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        assert digests[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert digests[conv].n_turns == len(turns)
        assert digests[conv].formatted_chars == len(read[conv].formatted)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "s\nx", "<|im_end|>", "<|nl|>"]), HOSTILE), min_size=40, max_size=40))
@settings(max_examples=4, deadline=None)
def test_hostile_texts_round_trip(spark, turns):
    check(spark, [(i // 4, i % 4, role, text) for i, (role, text) in enumerate(turns)])


def test_odd_rows(spark):
    check(
        spark,
        [
            (None, 0, "user", "no id"),
            (1, None, "assistant", "no turn"),
            (1, 0, None, "no role"),
            (1, 1, "assistant", None),
            (2, 0, "user", ""),
            (3, 0, "assistant", "tie"),
            (3, 0, "assistant", "tie"),
            (3, 0, "assistant", "other"),
            (4, 0, "assistant", "long <| " * 50_000),
        ],
    )
    assert c.format_conversations(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_only_conflicting_turns_are_escaped(spark):
    rows = [(1, 0, "user", "a <b| <| c", "", 1), (1, 1, "user", "a <|im_end|>", "", 1)]
    row = c.format_conversations(spark.createDataFrame(rows, SCHEMA)).first()
    assert row.n_escaped == 1
    assert row.formatted == (
        "<|im_start|>user\na <b| <| c<|im_end|>\n<|im_start|>user\na <\\|im_end|><|im_end|>\n"
    )
