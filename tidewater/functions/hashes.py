"""Hashes of whole rows, for spreading rows and for a repeatable order of ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = (T.MapType, T.ArrayType, T.StructType, T.VariantType)


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns with plain values; maps cannot be hashed."""
    plain = [f.name for f in df.schema if not isinstance(f.dataType, _NESTED)]
    return F.xxhash64(*plain) if plain else F.lit(0).cast("long")
