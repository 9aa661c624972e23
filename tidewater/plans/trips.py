"""Taxi trips: raw table to typed silver files to fare totals."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewater.operators.aggregate import grouped_total
from tidewater.operators.transform import drop_null_columns, resolve_choice, typed_mapping
from tidewater.sinks.files import append_parquet, overwrite_parquet
from tidewater.streaming.incremental import load_new_files

# The trip columns and their types.
TRIP_TYPES = {
    "vendorid": "long",
    "lpep_pickup_datetime": "string",
    "lpep_dropoff_datetime": "string",
    "store_and_fwd_flag": "string",
    "ratecodeid": "long",
    "pulocationid": "long",
    "dolocationid": "long",
    "passenger_count": "long",
    "trip_distance": "double",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "ehail_fee": "string",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "payment_type": "long",
    "trip_type": "long",
}
FARE_KEYS = ("pulocationid", "trip_type", "payment_type")


def trip_mapping() -> list[tuple[str, str, str, str]]:
    return [(name, kind, name, kind) for name, kind in TRIP_TYPES.items()]


def silver_rows(raw: DataFrame, choices: Sequence[str] = ()) -> DataFrame:
    """Typed columns, mixed columns of ``choices`` as structs, no all-NULL column."""
    typed = typed_mapping(raw, trip_mapping())
    return drop_null_columns(resolve_choice(typed, choices))


def raw_to_silver(
    spark: SparkSession, table: str, path: str, choices: Sequence[str] = ()
) -> None:
    """Adds a registered raw table's rows to the silver files, in a folder ``load=...``."""
    append_parquet(silver_rows(spark.table(table), choices), f"{path}/load={uuid.uuid4().hex}")


def new_files_to_silver(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    path: str,
    bookmark: str,
    choices: Sequence[str] = (),
) -> None:
    """Adds the silver rows of raw files not seen before, each exactly once.

    The files may share ``path`` with those of ``raw_to_silver``.
    """
    load_new_files(
        spark,
        source,
        schema,
        path,
        bookmark,
        transform=lambda rows: silver_rows(rows, choices),
    )


def fare_totals(trips: DataFrame) -> DataFrame:
    return grouped_total(trips, FARE_KEYS, "fare_amount", "total_fare_amount")


def silver_to_gold(spark: SparkSession, silver: str, gold: str) -> None:
    """Replaces the fare totals.

    A column that some silver files lack, having had no values, reads as NULL.
    """
    columns = ", ".join(f"{c} {TRIP_TYPES[c]}" for c in (*FARE_KEYS, "fare_amount"))
    overwrite_parquet(fare_totals(spark.read.schema(columns).parquet(silver)), gold)
