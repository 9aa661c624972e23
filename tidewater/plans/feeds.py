"""The sample tables in the shape of the daily index and security files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import iso_day

# Below this value a user's last event leaves the security without a global id.
IDENTIFIED_FROM = 10.0


def _global_id(user_id: Column) -> Column:
    return F.concat(F.lit("BBG"), user_id.cast("string"))


def security_feed(events: DataFrame, date: Column) -> DataFrame:
    """One row per user and ``date`` from the user's last event of that date.

    Ids and values are fixed-width, so this is a hash aggregate that combines a
    hot user's events before the shuffle; text is built from its result.
    """
    last = events.groupBy("user_id", date.alias("business_date")).agg(
        F.max("event_id").alias("event_id"),
        F.max_by("value", "event_id").alias("value"),
    )
    return last.select(
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("security_id"),
        F.concat(F.lit("Holding "), F.col("event_id").cast("string")).alias("security_name"),
        F.when(F.col("value") >= IDENTIFIED_FROM, _global_id(F.col("user_id"))).alias(
            "id_bb_global"
        ),
        F.when(
            F.col("event_id") % 7 != 0, F.concat(F.lit("C"), F.col("event_id").cast("string"))
        ).alias("cusip"),
        F.col("business_date").cast("string").alias("business_date"),
    )


def index_feed(events: DataFrame, date: Column) -> DataFrame:
    """One constituent per event; sign-ups carry no security reference."""
    return events.select(
        F.col("event_type").alias("index_name"),
        F.col("event_id").cast("string").alias("constituent_id"),
        F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("ticker"),
        F.when(F.col("event_type") != "signup", _global_id(F.col("user_id"))).alias("figi"),
        F.col("value").cast("string").alias("index_weight"),
        F.get_json_object("props", "$.k").alias("market_cap"),
        date.cast("string").alias("business_date"),
    )


def day(ts: str) -> Column:
    return F.col(ts).cast("date")


def third_of_month(ts: str) -> Column:
    """The 1st, 11th or 21st: delivery dates of the index feed."""
    number = F.dayofmonth(day(ts))
    start = F.when(number <= 10, 0).when(number <= 20, 10).otherwise(20)
    return F.date_add(F.trunc(day(ts), "month"), start)


def first_or_last_third(ts: str) -> Column:
    """The 1st for days up to the 20th, else the 21st: the security feed, which
    brings no file on the 11th."""
    start = F.when(F.dayofmonth(day(ts)) <= 20, 0).otherwise(20)
    return F.date_add(F.trunc(day(ts), "month"), start)


def distinct_dates(date: Column, df: DataFrame) -> list[str]:
    """The dates in a table, as many as there are deliveries."""
    rows = df.select(date.cast("string").alias("d")).distinct().collect()
    return sorted(r["d"] for r in rows)


def landing_path(name: Column, ts: str) -> Column:
    """An address such as ``s3://lake/in/orders_v2_20240131.csv.gz``."""
    compact = F.replace(iso_day(F.col(ts)), F.lit("-"), F.lit(""))
    return F.concat(F.lit("s3://lake/in/"), name, F.lit("_"), compact, F.lit(".csv"))
