"""Joins that stay balanced when keys are hot or missing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.hashes import row_hash

_SPREAD = "_spread"
_RIGHT_SPREAD = "_right_spread"
# Types whose equal values have equal hashes once ``_canonical``.
_HASHABLE = (
    T.StringType,
    T.NumericType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.BinaryType,
)


def _common_types(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]
) -> list[T.DataType] | None:
    """The types in which Spark compares the keys; None if it cannot hash one."""
    out = []
    for a, b in keys:
        pair = T.StructType(
            [T.StructField("a", left.schema[a].dataType), T.StructField("b", right.schema[b].dataType)]
        )
        kind = pair["a"].dataType
        if kind != pair["b"].dataType:
            if not all(isinstance(f.dataType, T.NumericType) for f in pair):
                return None
            # No rows: the analysis alone says what the two become.
            kind = left.sparkSession.createDataFrame([], pair).select(F.coalesce("a", "b")).schema[0].dataType
        if not isinstance(kind, _HASHABLE):
            return None
        out.append(kind)
    return out


def _canonical(column: str, kind: T.DataType) -> Column:
    """A key in the type of the comparison; zeros and NaNs, which are equal, alike."""
    value = F.col(column).cast(kind)
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        zero, nan = F.lit(0.0).cast(kind), F.lit(float("nan")).cast(kind)
        value = F.when(value == zero, zero).when(F.isnan(value), nan).otherwise(value)
    return value


def balanced_join(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], how: str
) -> DataFrame:
    """``left JOIN right`` on equal (left, right) key pairs, all columns kept.

    ``how`` is left, left_semi or left_anti, and the two frames share no column
    names. Spark broadcasts ``right`` when it is within its size limit. In the
    shuffled join that it plans otherwise:

    * left rows with a NULL key match nothing but would all meet in one partition.
      A hash of the whole row stands in for their key's hash in a further join
      column and spreads them.
    * keys of different types, fractions and decimals are hashed in the type in which
      Spark compares them, zeros and NaNs alike.
    * that column also makes both sides shuffle for this join alone, even after an
      aggregate on the same keys. Only such shuffles can be split by AQE, which
      cuts a hot key's left rows into many tasks.
    """
    condition = [F.col(a) == F.col(b) for a, b in keys]
    kinds = _common_types(left, right, keys)
    if kinds is None:
        return left.join(right, condition, how)
    left_keys = [_canonical(a, kind) for (a, _), kind in zip(keys, kinds)]
    right_keys = [_canonical(b, kind) for (_, b), kind in zip(keys, kinds)]
    unmatched = reduce(lambda x, y: x | y, [F.col(a).isNull() for a, _ in keys])
    spread = F.when(unmatched, row_hash(left)).otherwise(F.xxhash64(*left_keys))
    return (
        left.withColumn(_SPREAD, spread)
        .join(
            right.withColumn(_RIGHT_SPREAD, F.xxhash64(*right_keys)),
            [*condition, F.col(_SPREAD) == F.col(_RIGHT_SPREAD)],
            how,
        )
        .drop(_SPREAD, _RIGHT_SPREAD)
    )


def lookup_join(
    facts: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str
) -> DataFrame:
    """Facts with the columns of their lookup row, NULL where there is none."""
    return balanced_join(facts, lookup, [(fact_key, lookup_key)], "left")
