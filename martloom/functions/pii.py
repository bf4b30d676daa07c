"""Masking of personal identifiers and the keys derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.text import WHITESPACE_CLASS, is_blank, strip

MATCHED_BY_ID = "SSN"
MATCHED_BY_NAME = "NAME_DOB"


def hash_identifier(c: Column, salt: str | None = None) -> Column:
    """SHA-256 hex of the stripped value, NULL when there is nothing to hash."""
    value = strip(c)
    salted = F.concat(F.lit(salt), value) if salt else value
    return F.when(~is_blank(c), F.sha2(salted, 256))


def match_method(c: Column, blank: str = WHITESPACE_CLASS) -> Column:
    """How the person will be identified: by the identifier, or by name."""
    return F.when(is_blank(c, blank), F.lit(MATCHED_BY_NAME)).otherwise(F.lit(MATCHED_BY_ID))


def last_characters(c: Column, n: int = 4, keep_short: bool = True) -> Column:
    """The last `n` characters. Shorter values come back whole unless `keep_short` is off."""
    tail = F.right(c, F.lit(n))
    return tail if keep_short else F.when(F.char_length(c) > n, tail)


def business_key(id_hash: Column, fallback: Sequence[Column], method: Column) -> Column:
    """The hashed identifier, or else the fallback values and the match method joined by `_`.

    A NULL in any fallback value gives a NULL key.
    """
    parts: list[Column] = []
    for value in (*fallback, method):
        parts += [F.lit("_"), value] if parts else [value]
    return F.coalesce(id_hash, F.concat(*parts))
