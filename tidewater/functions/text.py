"""Tokens of text lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is the first run of these characters in a token.
WORD_CHARS = "a-z'"
# Tokens end at a space; lines end as the text reader ends them.
TOKEN_BREAKS = r" \r\n"


def words(text: Column) -> Column:
    """All words of a text as an array.

    A token is what lies between single spaces or line ends, in lower case; its
    word is its first run of letters and apostrophes. Tokens without one give
    nothing. One regex pass over the whole text replaces splitting it into
    tokens and running a regex on each: the match must start at a token's start
    and skip only characters that are neither word characters nor breaks.
    """
    first_run = f"(?:^|[{TOKEN_BREAKS}])[^{WORD_CHARS}{TOKEN_BREAKS}]*([{WORD_CHARS}]+)"
    return F.regexp_extract_all(F.lower(text), F.lit(first_run), F.lit(1))


def contains_ignore_case(text: Column, keyword: str) -> Column:
    return F.lower(text).contains(keyword.lower())
