"""Column expressions used by the operators; native Spark only, no UDFs."""

from martloom.functions.pii import (
    business_key,
    hash_identifier,
    last_characters,
    match_method,
)
from martloom.functions.text import WHITESPACE, WHITESPACE_CLASS, is_blank, standardize_name, strip

__all__ = [
    "WHITESPACE",
    "WHITESPACE_CLASS",
    "business_key",
    "hash_identifier",
    "is_blank",
    "last_characters",
    "match_method",
    "standardize_name",
    "strip",
]
