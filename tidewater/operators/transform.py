"""Row-wise operators and the two whose schema depends on the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.numbers import data_type, number_in, try_convert



def typed_mapping(
    df: DataFrame, mappings: Sequence[tuple[str, str, str, str]]
) -> DataFrame:
    """Keeps the listed columns only, renamed and cast.

    Each mapping is (source, source type, target, target type). A value that does
    not fit a type becomes NULL instead of failing the job.
    """

    def mapped(source: str, source_type: str, target: str, target_type: str) -> Column:
        value = F.col(source)
        have = df.schema[source].dataType
        for wanted in map(data_type, (source_type, target_type)):
            value, have = try_convert(value, have, wanted), wanted
        return value.alias(target)

    return df.select(*[mapped(*m) for m in mappings])


def dynamic_filter(df: DataFrame, filters: Sequence[Mapping[str, str]]) -> DataFrame:
    """Rows where every ``column_name`` equals its ``column_value``.

    Values are literals, never SQL text, so quotes in them are harmless; no
    filters keep all rows.
    """
    conditions = [F.col(f["column_name"]) == F.lit(f["column_value"]) for f in filters]
    return df.where(reduce(lambda a, b: a & b, conditions, F.lit(True)))


def choice_fields(value: Column, types: Sequence[str]) -> list[Column]:
    """One column per type; exactly the first type that fits a value holds it."""
    fields: list[Column] = []
    taken = value.isNull()
    for name in types:
        if name == "string":
            fit = value.cast("string")
        else:
            fit = number_in(value, data_type(name))
        fields.append(F.when(~taken, fit).alias(name))
        taken = taken | fit.isNotNull()
    return fields


def resolve_choice(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    types: Sequence[str] = ("long", "double", "string"),
) -> DataFrame:
    """Turns each column of mixed types into a struct with one field per type.

    A string column is mixed when its values are of more than one of ``types``;
    only the types seen become fields. Other columns stay as they are. The result
    schema depends on the data, so this runs one aggregate pass over the columns
    examined (``columns``, or every string column).
    """
    names = list(columns) if columns is not None else [
        f.name for f in df.schema if isinstance(f.dataType, T.StringType)
    ]
    if not names:
        return df
    checks = [
        F.bool_or(field.isNotNull()).alias(f"{i}_{kind}")
        for i, name in enumerate(names)
        for kind, field in zip(types, choice_fields(F.col(name), types))
    ]
    seen = df.agg(*checks).first().asDict()
    mixed = {}
    for i, name in enumerate(names):
        kinds = [k for k in types if seen[f"{i}_{k}"]]
        if len(kinds) > 1:
            mixed[name] = F.when(
                F.col(name).isNotNull(), F.struct(*choice_fields(F.col(name), kinds))
            ).alias(name)
    return df.select(*[mixed.get(c, F.col(c)) for c in df.columns])


def null_columns(df: DataFrame) -> list[str]:
    """Columns that are NULL in every row, by one pass over the nullable columns."""
    names = [f.name for f in df.schema if f.nullable]
    if not names:
        return []
    row = df.agg(*[F.bool_or(F.col(n).isNotNull()).alias(n) for n in names]).first()
    return [n for n in names if not row[n]]


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drops the columns that are NULL in every row."""
    return df.drop(*null_columns(df))
