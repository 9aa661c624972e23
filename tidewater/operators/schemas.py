"""One schema over loads whose schemas differ."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.transform import choice_fields

# Kinds of a choice, in the order of its fields; a record's own fields are one field.
KINDS = ("boolean", "long", "double", "date", "timestamp", "binary", "string", "record", "list")
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _kind(kind: T.DataType) -> str:
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, _INTEGERS):
        return "long"
    if isinstance(kind, T.NumericType):
        return "double"
    if isinstance(kind, T.DateType):
        return "date"
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return "timestamp"
    if isinstance(kind, T.BinaryType):
        return "binary"
    if isinstance(kind, T.ArrayType):
        return "list"
    return "record" if isinstance(kind, T.StructType | T.MapType) else "string"


def _is_choice(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and bool(kind.names) and set(kind.names) <= set(KINDS)


def _fields(kind: T.DataType) -> dict[str, T.DataType]:
    """A type as the fields of a choice."""
    return {f.name: f.dataType for f in kind} if _is_choice(kind) else {_kind(kind): kind}


def merged_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both.

    Integers widen to the longer one, and to double with other numbers; records merge
    field by field and lists by their elements. Types of different kinds become a choice:
    a struct with a field per kind, to which further kinds are added. Texts that meet
    numbers may hold integers and fractions, so that choice has fields for both.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType))
    if not _is_choice(a) and not _is_choice(b) and isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged_schema([a, b])
    both, other = _fields(a), _fields(b)
    texts = [isinstance(t, T.StringType) for t in (a, b)]
    if any(texts) and not all(texts) and not {"long", "double"}.isdisjoint([*both, *other]):
        # Numbers may be among the texts.
        both = {"long": T.LongType(), "double": T.DoubleType()} | both
    for name, kind in other.items():
        both[name] = merged_type(both[name], kind) if name in both else kind
    return T.StructType([T.StructField(name, both[name]) for name in KINDS if name in both])


def merged_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns of ``schemas`` in the order of their first appearance, nullable."""
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            have = kinds.get(field.name)
            kinds[field.name] = field.dataType if have is None else merged_type(have, field.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def converted(value: Column, have: T.DataType, wanted: T.DataType) -> Column:
    """``value`` of type ``have`` in a type that ``merged_type`` made of it.

    A text in a choice of numbers goes where ``resolve_choice`` would have put it.
    """
    if have == wanted:
        return value
    if isinstance(have, T.NullType):
        return F.lit(None).cast(wanted)
    if isinstance(have, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda x: converted(x, have.elementType, wanted.elementType))
    if _is_choice(wanted) and not _is_choice(have):
        kinds = wanted.names
        if isinstance(have, T.StringType):
            parsed = [k for k in kinds if k in ("long", "double", "string")]
            fits = dict(zip(parsed, choice_fields(value, parsed), strict=True))
        else:
            fits = {_kind(have): converted(value, have, wanted[_kind(have)].dataType)}
    elif isinstance(wanted, T.StructType):
        kinds = wanted.names
        fits = {f.name: converted(value[f.name], f.dataType, wanted[f.name].dataType) for f in have}
    else:
        return value.cast(wanted)
    empty = lambda name: F.lit(None).cast(wanted[name].dataType)
    return F.when(value.isNotNull(), F.struct(*[fits.get(k, empty(k)).alias(k) for k in kinds]))


def in_merged_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in a ``merged_schema`` of its own one and others; missing columns are NULL."""
    have = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            (converted(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def union_of(frames: Sequence[DataFrame]) -> DataFrame:
    """The rows of all ``frames`` in their merged schema."""
    schema = merged_schema([f.schema for f in frames])
    return reduce(DataFrame.unionByName, [in_merged_schema(f, schema) for f in frames])
