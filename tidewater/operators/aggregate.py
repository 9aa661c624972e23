"""Grouped sums and counts; Spark combines before each shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import text


def grouped_total(
    df: DataFrame, keys: Sequence[str], amount: str, into: str
) -> DataFrame:
    """Sum of ``amount`` per group. NULL keys form a group, NULL amounts are skipped."""
    return df.groupBy(*keys).agg(F.sum(amount).alias(into))


def word_count(df: DataFrame, column: str = "value") -> DataFrame:
    """(word, count) over a text column, one line or a whole text per row."""
    return (
        df.select(F.explode(text.words(F.col(column))).alias("word"))
        .groupBy("word")
        .count()
    )


def top_words(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` commonest words; ties in alphabetical order."""
    return counts.orderBy(F.col("count").desc(), "word").limit(n)
