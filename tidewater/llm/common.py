"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyspark
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import work_dir

Made = TypeVar("Made")
# A table of no more bytes may be sent to every executor.
BROADCAST_BYTES = 32 << 20
# Text that a task takes apart at one time, one longer text aside.
TEXT_AT_ONCE = 2 << 20


def travels(module: str) -> None:
    """Functions of ``module`` go to workers with the job, not by import there."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


travels(__name__)


def kept(name: str, make: Callable[[], Made]) -> Made:
    """What ``make`` returns, made once for ``name`` in a worker process.

    Modules that travel with the job are made anew for each task; pyspark is not.
    """
    things = pyspark.__dict__.setdefault("_kept_by_tidewater", {})
    if name not in things:
        things[name] = make()
    return things[name]


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer file on this machine."""
    return public_tokenizers.path(name)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns_of(df: DataFrame, names: list[str] | None = None) -> list[Column]:
    """The columns of ``df``, or the named ones, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in (df.columns if names is None else names)]


def row_of(df: DataFrame, names: list[str] | None = None) -> Column:
    """The columns of ``df``, or the named ones, as one column ``row``, so that their
    names meet no other ones and may hold any character in a Python stage."""
    return F.struct(*columns_of(df, names)).alias("row")


def columns_of_row(names: list[str]) -> list[Column]:
    """The columns that ``row_of`` put into ``row``."""
    return [F.col("row").getField(c).alias(c) for c in names]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % n


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes; a null text is empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def slices(
    batches: Iterator[pa.RecordBatch], column: str, at_once: int = TEXT_AT_ONCE
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``at_once`` bytes of ``column``, or one row.

    Words of a text take many times its bytes as Python objects, so Arrow's batches are
    too large to be taken apart as a whole.
    """
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch[column]).fill_null(0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            most = at_once + (int(ends[start - 1]) if start else 0)
            stop = max(start + 1, int(np.searchsorted(ends, most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


class Remembered:
    """A map of bounded size: old entries go once ``most`` newer ones were used."""

    def __init__(self, most: int):
        self.most, self.new, self.old = most, {}, {}

    def get(self, key):
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        self.turn()[key] = value

    def turn(self) -> dict:
        """The newer entries, emptied if they are too many."""
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        return self.new
