"""Update, delete, upsert and time travel on a table of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.merge import delete_rows, merge_rows, update_rows
from tidewater.sources.snapshots import SnapshotTable

# The id that the update leaves alone, and what it adds.
KEPT_ID = 2
SHIFT = 100


def shift_even_ids(df: DataFrame, column: str = "id") -> DataFrame:
    """Even ids but one are moved up."""
    even = (F.col(column) % 2 == 0) & (F.col(column) != KEPT_ID)
    return update_rows(df, even, {column: F.col(column) + SHIFT})


def drop_odd_ids(df: DataFrame, column: str = "id") -> DataFrame:
    return delete_rows(df, F.col(column) % 2 != 0)


def walkthrough(table: SnapshotTable, ids: DataFrame, new_ids: DataFrame) -> None:
    """Writes four versions: the ids, updated, deleted from, and merged into."""
    table.write(ids)
    table.write(shift_even_ids(table.read()))
    table.write(drop_odd_ids(table.read()))
    table.write(merge_rows(table.read(), new_ids, ["id"]))
