import hashlib
import re
from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.functions import (
    WHITESPACE_CLASS,
    business_key,
    hash_identifier,
    is_blank,
    last_characters,
    match_method,
    standardize_name,
    strip,
)
from martloom.operators.mapping import parse_value
from martloom.sources.contract import ContractColumn

SAMPLES = [
    None, "", " ", "\t", "\tA B\n", " A ", "　x ", "José", "o'Brien-smith 3rd", "straße",
    "\x1c\x1d", "a\x85", "12", "1234", "12345", " ", "  two  words ", "2026-03-31",
]


def evaluate(spark, values, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def expected(v):
    bare = v.strip() if v is not None else None
    return (
        bare,
        not bare,
        None if v is None else re.sub(r"[^A-Z\s]", "", v.upper()).strip(),
        hashlib.sha256(bare.encode()).hexdigest() if bare else None,
        "SSN" if bare else "NAME_DOB",
    )


def actual(spark, values):
    v = F.col("v")
    return evaluate(
        spark, values, strip(v), is_blank(v), standardize_name(v), hash_identifier(v), match_method(v)
    )


def test_text_functions_follow_python(spark):
    assert actual(spark, SAMPLES) == [expected(v) for v in SAMPLES]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.text(st.sampled_from("aZé3 .'-\t\n\x1f\x85    　ß"), max_size=12),
        min_size=20, max_size=60,
    )
)
def test_text_functions_follow_python_on_any_text(spark, values):
    assert actual(spark, values) == [expected(v) for v in values]


def test_spaces_only_blank(spark):
    assert evaluate(spark, [" ", "\t", None], is_blank(F.col("v"), " ")) == [(True,), (False,), (True,)]


def test_salt_changes_the_hash(spark):
    [(hashed,)] = evaluate(spark, [" 12 "], hash_identifier(F.col("v"), "pepper"))
    assert hashed == hashlib.sha256(b"pepper12").hexdigest()


def test_last_characters(spark):
    v = F.col("v")
    values = [None, "", "12", "1234", "12345678"]
    rows = evaluate(spark, values, last_characters(v), last_characters(v, 4, keep_short=False))
    assert rows == [(None, None), ("", None), ("12", None), ("1234", None), ("5678", "5678")]


def test_business_key(spark):
    df = spark.createDataFrame(
        [("h", "N", "d"), (None, "N", "d"), (None, None, "d")], "h string, n string, d string"
    )
    key = business_key(F.col("h"), [F.col("n")], F.lit("NAME_DOB"))
    longer = business_key(F.col("h"), [F.col("n"), F.col("d")], F.lit("NAME_DOB"))
    rows = [tuple(r) for r in df.select(key, longer).collect()]
    assert rows == [("h", "h"), ("N_NAME_DOB", "N_d_NAME_DOB"), (None, None)]


def test_white_space_and_names_need_no_regular_expression(spark):
    """Checked for every value of every landing row, where a class of ranges costs microseconds."""
    v = F.col("v")
    rows = spark.createDataFrame([("a",)], "v string").select(is_blank(v), is_blank(v, " "), standardize_name(v))
    plan = rows._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "rlike" not in plan and "regexp" not in plan


def test_names_and_blanks_as_by_regular_expression(spark):
    v = F.col("v")
    values = [*SAMPLES, "o\U0001f600'n\u00e9il \U0001d49c 1", "\U0001f600", "\x85\u2003", "!", "~", "\x7f", "\x00", "\u180e", "\ufeff a"]
    by_class = F.regexp_replace(F.upper(v), f"[^A-Z{WHITESPACE_CLASS}]+", "")
    blank = ~F.coalesce(v.rlike(f"[^{WHITESPACE_CLASS}]"), F.lit(False))
    pairs = evaluate(spark, values, standardize_name(v), strip(by_class), is_blank(v), blank)
    assert all(name == wanted and found == empty for name, wanted, found, empty in pairs)


def test_dates_as_by_their_pattern(spark):
    values = [
        None, "", " ", "2026-03-31", "2024-02-29", "2023-02-29", "0000-01-01", "0001-01-01", "9999-12-31",
        "+10000-01-01", "-0001-01-01", "-001-01-01", "2026-3-31", "2026-03-1", " 2026-03-31", "2026-03-31 ",
        "2026-03-1 ", "2026-03-1T", "2026-03-31T00:00:00", "2026-13-01", "2026-99-99", "soon", "31/12/1970",
        "\u0662\u0660\u0662\u0666-03-31", "2026-03-31\n", "1582-10-10", "20260331",
    ]
    read, wanted = parse_value(ContractColumn("v", "date")), F.try_to_date(F.col("v"), "yyyy-MM-dd")
    rows = evaluate(spark, values, read.cast("string"), wanted.cast("string"))
    assert [a for a, _ in rows] == [b for _, b in rows] and sum(a is not None for a, _ in rows) >= 5
    other = ContractColumn("v", "date", format="DD/MM/YYYY")
    assert str(evaluate(spark, ["31/12/1970", "1970-12-31"], parse_value(other))) == str(
        [(date(1970, 12, 31),), (None,)]
    )


def test_a_date_as_written_is_not_left_to_a_formatter(spark):
    rows = spark.createDataFrame([("2026-03-31",)], "v string").select(parse_value(ContractColumn("v", "date")))
    assert "octet_length" in rows._jdf.queryExecution().optimizedPlan().toString()
