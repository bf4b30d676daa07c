"""Chat rendering that is proven by reading it back.

Grammar of the rendered text, per turn:  <|im_start|> role \\n text <|im_end|> \\n

The parser is deterministic: it splits at the start marker, takes the role up to the first line
break and the text up to the first end marker, and in both it removes one backslash from every
`<` backslashes `|`. Rendering starts from the plain role and text. Where parsing that turn does
not give back its source, the content is escaped, one backslash into every `<` backslashes `|`
(and a line break in a role becomes a control string of its own), and parsed again; escaped
content holds no control string, so the second round always agrees. Most turns need no escape.

A conversation is one row, as it is one training example; turns are gathered by conversation.

Defined cases: a null text or role is empty; null turns come first, and rows with the same turn
are ordered by role and text, repeated rows all kept; a null conv_id is a conversation like any
other; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
NEWLINE = "<|nl|>"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(NEWLINE))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n")))


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END), F.lit("\n"))


def parse(rendered: Column) -> Column:
    """Array of (role, text, raw_text) of the rendered turns; raw_text is as it stands."""
    pieces = F.split(rendered, r"<\|im_start\|>", -1)
    pieces = F.slice(pieces, 2, F.size(pieces))

    def turn(piece: Column) -> Column:
        raw = F.substring_index(F.regexp_replace(piece, r"^[^\n]*\n", ""), END, 1)
        return F.struct(
            _unescape_role(F.substring_index(piece, "\n", 1)).alias("role"),
            unescape(raw).alias("text"),
            raw.alias("raw_text"),
        )

    return F.transform(pieces, turn)


def _reads_back(rendered: Column, role: Column, text: Column) -> Column:
    turns = parse(rendered)
    first = F.get(turns, F.lit(0))
    return F.coalesce(
        (F.size(turns) == 1) & (first["role"] == role) & (first["text"] == text), F.lit(False)
    )


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, n_escaped, and `loss`: the (start, length) in code points, from 0, of
    each trained turn's text inside `formatted`."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    plain = rows.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn(
        "plain", render_turn(F.col("role"), F.col("text"))
    )
    safe = plain.withColumn("clean", _reads_back(F.col("plain"), F.col("role"), F.col("text")))
    turns = safe.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.when(F.col("clean"), F.col("plain"))
        .otherwise(render_turn(_escape_role(F.col("role")), escape(F.col("text"))))
        .alias("rendered"),
        (~F.col("clean")).cast("int").alias("escaped"),
    )
    gathered = turns.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(F.struct("turn", "role", "text", "rendered", "escaped"))
        ).alias("turns")
    )
    formatted = F.array_join(F.transform("turns", lambda t: t["rendered"]), "")
    lengths = F.transform("turns", lambda t: F.length(t["rendered"]))
    tail = len(END) + 1

    def step(state: Column, turn: Column) -> Column:
        full = F.length(turn["rendered"])
        head = F.length(F.substring_index(turn["rendered"], "\n", 1)) + 1
        span = F.struct(
            (state["at"] + head).cast("long").alias("start"),
            (full - head - tail).cast("long").alias("length"),
        )
        return F.struct(
            (state["at"] + full).cast("long").alias("at"),
            F.when(turn["role"] == TRAINED_ROLE, F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    empty = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"),
    )
    return gathered.select(
        "conv_id",
        formatted.alias("formatted"),
        F.aggregate("turns", empty, step)["spans"].alias("loss"),
        F.aggregate("turns", F.lit(0), lambda n, t: n + t["escaped"]).alias("n_escaped"),
        F.size(lengths).alias("n_source_turns"),
        F.transform("turns", lambda t: F.struct(t["role"], t["text"])).alias("source"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns parsed from the whole rendered text, the text under the loss mask, and whether
    the turns are the source's."""
    parsed = formatted.withColumn("turns", parse(F.col("formatted")))
    masked = F.array_join(
        F.transform(
            "loss",
            lambda s: unescape(
                F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))
            ),
        ),
        "",
    )
    same = F.transform("turns", lambda t: F.struct(t["role"], t["text"]))
    return parsed.select(
        "conv_id",
        "formatted",
        "turns",
        masked.alias("loss_text"),
        "n_escaped",
        (F.to_json(same) == F.to_json("source")).alias("round_trips"),
    )


def digests(read: DataFrame) -> DataFrame:
    """Counts and hashes of what was read back."""
    whole = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("n_escaped").cast("long").alias("n_escaped"),
        "round_trips",
    )
