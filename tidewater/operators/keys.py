"""Consecutive surrogate ids continuing from a stored high-water mark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.functions.hashes import row_hash
from tidewater.session import work_dir
from tidewater.sources.snapshots import SnapshotTable

_PART = "_part"
_ROW = "_row"
_ROW_BITS = 33  # monotonically_increasing_id: partition number << 33 | row number


def staged_in_order(df: DataFrame, order_by: Sequence[str], staged: str) -> DataFrame:
    """``df`` written in the order of ``order_by`` with its partition and row number there.

    No task sees more than its range of the order. The written table keeps all reads on
    the same ranges, whichever executors are lost. Rows equal in ``order_by`` are
    ordered by a hash of the whole row, which also splits a hot value into many ranges.
    """
    order = [*order_by, row_hash(df)]
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id())
        .withColumn(_PART, F.shiftright("_position", _ROW_BITS))
        .withColumn(_ROW, F.col("_position") - F.shiftleft(_PART, _ROW_BITS))
        .drop("_position")
        .write.parquet(staged)
    )
    return df.sparkSession.read.parquet(staged)


def _numbered(rows: DataFrame, columns: Sequence[str], last_id: int, into: str) -> DataFrame:
    """Staged rows with the ids after ``last_id`` in their order.

    Each partition's start is the count of the rows before it. Only the partition sizes,
    one row per written partition, are broadcast.
    """
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(_PART)
        .count()
        .select(_PART, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    return rows.join(F.broadcast(starts), _PART).select(
        *columns, (F.lit(last_id) + F.col("_start") + F.col(_ROW) + 1).alias(into)
    )


def assign_ids(
    df: DataFrame,
    order_by: Sequence[str],
    last_id: int = 0,
    into: str = "id",
    staging: str | None = None,
) -> DataFrame:
    """Adds ``last_id + 1, last_id + 2, ...`` in the order of ``order_by``.

    See ``staged_in_order``. The result reads the written table (``staging``, or a work
    folder), which can go once the result is stored.
    """
    staged = staging or work_dir(df.sparkSession, "ids")
    return _numbered(staged_in_order(df, order_by, staged), df.columns, last_id, into)


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    mark: HighWaterMark,
    into: str = "id",
    staging: str | None = None,
) -> DataFrame:
    """``assign_ids`` after the mark, whose ids are reserved before the first is given.

    A run that fails later, or whose result is not stored, leaves a gap of as many ids as
    it had rows; none is ever given twice. No rows reserve nothing.
    """
    staged = staging or work_dir(df.sparkSession, "ids")
    rows = staged_in_order(df, order_by, staged)
    return _numbered(rows, df.columns, mark.reserve(rows.count()), into)


def ranks_within(df: DataFrame, group: str, order_by: Sequence[str], into: str) -> DataFrame:
    """``df`` with each row's place, from 0, among the rows of its ``group`` in the order of
    ``order_by``; NULL is a group too.

    A large group lies in many ranges of the order, so no task holds it: a row's place is
    its place in its range and the rows that the group has in earlier ranges.
    """
    rows = staged_in_order(df, [group, *order_by], work_dir(df.sparkSession, "ranks"))
    pieces = rows.groupBy(F.col(group).alias("_group"), F.col(_PART).alias("_piece")).agg(
        F.min(_ROW).alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # As many rows a group as it has ranges.
    earlier = Window.partitionBy("_group").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    same = (F.col(_PART) == F.col("_piece")) & F.col(group).eqNullSafe(F.col("_group"))
    return rows.join(pieces, same).select(
        *df.columns, (F.col(_ROW) - F.col("_first") + F.col("_before")).alias(into)
    )


class HighWaterMark:
    """The last id handed out, kept as a one-row snapshot table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = SnapshotTable(spark, path)

    def read(self) -> int:
        """0 when nothing was stored yet."""
        if self.table.latest_version() is None:
            return 0
        return self.table.read().first()["last_id"]

    def store(self, last_id: int) -> None:
        self.table.write(self.spark.range(last_id, last_id + 1).toDF("last_id"))

    def reserve(self, count: int) -> int:
        """Moves the mark up by ``count`` and returns where it stood: the ids after that are
        the caller's alone. One job reserves at a time."""
        last_id = self.read()
        if count:
            self.store(last_id + count)
        return last_id
