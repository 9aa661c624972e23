"""Nesting child rows under their parent, and flattening them again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.joins import balanced_join
from tidewater.operators.keys import ranks_within

PAGE_SIZE = 10_000


def nest(
    children: DataFrame,
    parent: str,
    child_key: str,
    fields: Sequence[str],
    into: str,
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """(parent, page, ``into``): child rows as sorted arrays of structs.

    Children are ordered by ``child_key``, then the fields, NULLs first. A parent's pages
    from 0 are runs of that order, each of ``page_size`` children but the last; one page
    after another they are the whole list, and most parents have one. No task or array
    holds more than a page, whether child keys repeat or are missing.
    """
    sizes = (
        children.groupBy(F.col(parent).alias("_parent"))
        .count()
        .where(F.col("count") > page_size)
        .select("_parent")
    )
    # At most rows / page_size parents are large. The hash makes both sides shuffle for
    # these joins, so that AQE can split a hot parent (see balanced_join); NULL is a
    # parent too.
    same = (F.xxhash64(parent) == F.xxhash64("_parent")) & F.col(parent).eqNullSafe(F.col("_parent"))
    ordered = list(dict.fromkeys([child_key, *fields]))
    rows = children.select(*dict.fromkeys([parent, *ordered]))
    nest = F.sort_array(F.collect_list(F.struct(*ordered))).alias(into)
    small = rows.join(sizes, same, "left_anti").groupBy(parent).agg(nest)
    large = ranks_within(rows.join(sizes, same, "left_semi"), parent, ordered, "_place")
    paged = large.groupBy(parent, F.floor(F.col("_place") / page_size).alias("page")).agg(nest)
    return small.select(parent, F.lit(0).cast("long").alias("page"), into).unionByName(paged)


def flatten(nested: DataFrame, column: str) -> DataFrame:
    """One row per array element, its fields as columns. Empty arrays give none."""
    others = [c for c in nested.columns if c not in (column, "page")]
    return nested.select(*others, F.explode(column).alias(column)).select(
        *others, f"{column}.*"
    )


def attach(
    parents: DataFrame, key: str, nested: DataFrame, nested_key: str, into: str
) -> DataFrame:
    """Parents with their nested children; one without children has an empty list.

    A parent repeats per page of a large list.
    """
    children = nested.withColumnRenamed(nested_key, "_child_parent")
    joined = balanced_join(parents, children, [(key, "_child_parent")], "left")
    empty = F.array().cast(nested.schema[into].dataType)
    return joined.select(
        *parents.columns,
        F.coalesce("page", F.lit(0)).alias("page"),
        F.coalesce(into, empty).alias(into),
    )
