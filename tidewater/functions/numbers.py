"""Numbers in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that is read as a number. The patterns come before the cast
# because a failed cast raises an exception inside the task, which costs some
# hundred times a match, and because Java alone would also take "12F".
INTEGER = r"^\s*[+-]?[0-9]+\s*$"
DECIMAL = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"
SPECIAL = r"(?i)^\s*(?:nan|[+-]?inf(?:inity)?)\s*$"


def number_in(text: Column, kind: T.DataType, special: bool = False) -> Column:
    """``text`` as a number of ``kind``, NULL where it is none or does not fit.

    ``special`` also reads NaN and infinities for floating kinds.
    """
    if isinstance(kind, T.IntegralType):
        readable = text.rlike(INTEGER)
    else:
        readable = text.rlike(DECIMAL)
        if special and isinstance(kind, T.FractionalType):
            readable = readable | text.rlike(SPECIAL)
    return F.when(readable, text.try_cast(kind))


def try_convert(value: Column, have: T.DataType, wanted: T.DataType) -> Column:
    """``value`` of type ``have`` as ``wanted``, NULL where it does not fit."""
    if have == wanted:
        return value
    if isinstance(have, T.StringType) and isinstance(wanted, T.NumericType):
        return number_in(value, wanted, special=True)
    return value.try_cast(wanted)


def data_type(name: str) -> T.DataType:
    return T.StructType.fromDDL(f"value {name}")["value"].dataType
