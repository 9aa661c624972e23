"""Daily index and security files through bronze, silver and gold.

Layout under a root folder:

    index/bronze             all rows, by their business_date
    index/silver             rows of the file's date, by effective_business_date
    security/bronze          all rows, by their business_date
    security/history_silver  type 2 history (see sources.history)
    index_security           gold, by effective_business_date

The type 1 latest table is the history's open rows. A type 1 merge of the same
files gives just these: where it updates a row the history opens one for the row it
closes, and both add the rows of unknown keys. So one merge a day serves both.

Each step commits on its own. With ``safe_rerun`` a date can be loaded again
after a failure: bronze folders are kept per file, so that a file replaces its own
rows only, silver and gold replace the date's partition, and the date's securities
are spliced into the history: corrected rows take the place of the old ones, late ones
come between newer ones, and rows that a corrected file no longer brings go. Without it
a second load of a date adds its rows again, and a security date then fails on its
duplicate keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import dates
from tidewater.operators import scd
from tidewater.operators.joins import lookup_join
from tidewater.session import path_exists
from tidewater.sinks import catalog
from tidewater.sinks.files import (
    append_partitioned,
    recover,
    recover_partitions,
    replace_partition,
)
from tidewater.sources.files import read_csv
from tidewater.sources.history import HistoryTable

# The columns of the daily files and of the layers.
INDEX_COLUMNS = (
    "index_name",
    "constituent_id",
    "ticker",
    "figi",
    "index_weight",
    "market_cap",
    "business_date",
)
SECURITY_COLUMNS = (
    "security_id",
    "security_name",
    "id_bb_global",
    "cusip",
    "business_date",
)
SECURITY_KEY = "security_id"
SECURITY_SCHEMA = T.StructType(
    [
        T.StructField("security_id", T.StringType()),
        T.StructField("security_name", T.StringType()),
        T.StructField("id_bb_global", T.StringType()),
        T.StructField("cusip", T.StringType()),
        T.StructField("effective_business_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
        T.StructField("latest", T.BooleanType()),
    ]
)
GOLD_SCHEMA = T.StructType(
    [
        T.StructField("index_name", T.StringType()),
        T.StructField("constituent_id", T.StringType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("figi", T.StringType()),
        T.StructField("index_weight", T.FloatType()),
        T.StructField("market_cap", T.FloatType()),
        T.StructField("effective_business_date", T.StringType()),
        T.StructField("security_id", T.StringType()),
        T.StructField("cusip", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Lake:
    """One root folder; ``database`` also registers the tables there."""

    spark: SparkSession
    root: str
    database: str | None = None
    safe_rerun: bool = False

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def history(self) -> HistoryTable:
        return HistoryTable(
            self.spark, self.path("security", "history_silver"), SECURITY_SCHEMA, SECURITY_KEY
        )

    @property
    def latest(self) -> DataFrame:
        """The newest row per security."""
        return self.history.open_rows()

    def register(
        self,
        name: str,
        location: str,
        schema: T.StructType,
        by: str,
        written: Sequence[Mapping[str, str]],
    ) -> None:
        """Makes the partitions just ``written`` of a table visible in the catalog."""
        if not self.database:
            return
        full_name = f"{self.database}.{name}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        catalog.create_table(self.spark, full_name, columns, location, by)
        for values in written:
            folder = "/".join([location, *[f"{c}={v}" for c, v in values.items()]])
            if path_exists(self.spark, folder):
                catalog.add_partition(self.spark, full_name, values, folder)


def index_silver_rows(bronze: DataFrame, business_date: str | Column) -> DataFrame:
    """Bronze rows of their file's date, or of the date that a column says of each row; a
    row dated otherwise than its file stays out."""
    return bronze.where(F.col("business_date") == business_date).select(
        *[c for c in INDEX_COLUMNS if c != "business_date"],
        F.col("business_date").alias(scd.EFFECTIVE),
    )


def security_versions(bronze: DataFrame, business_date: str) -> DataFrame:
    """Identified securities of one date as open versions."""
    rows = bronze.where(
        (F.col("business_date") == business_date) & F.col("id_bb_global").isNotNull()
    )
    return scd.new_versions(rows.select(*SECURITY_COLUMNS))


def gold_rows(index_silver: DataFrame, latest: DataFrame) -> DataFrame:
    """Constituents with their security, looked up by the global id."""
    lookup = latest.select("id_bb_global", SECURITY_KEY, "cusip")
    joined = lookup_join(index_silver, lookup, "figi", "id_bb_global")
    return catalog.in_schema(joined.select(*GOLD_SCHEMA.names), GOLD_SCHEMA)


def _strings(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


BRONZE_SCHEMAS = {
    "index": _strings(INDEX_COLUMNS),
    "security": _strings(SECURITY_COLUMNS),
}
INDEX_SILVER_SCHEMA = _strings([*INDEX_COLUMNS[:-1], scd.EFFECTIVE])


def land(lake: Lake, domain: str, rows: DataFrame, file_date: str | None = None) -> None:
    """Bronze: rows as they came, partitioned by their own date.

    With ``safe_rerun`` the rows of a file, known by its date, lie in a folder of
    their own. A NULL date has Spark's folder for it.
    """
    path = lake.path(domain, "bronze")
    schema, folders, own = BRONZE_SCHEMAS[domain], "business_date", {}
    if lake.safe_rerun and file_date is not None:
        replace_partition(rows, path, "file_date", file_date, "business_date")
        schema, folders = _strings([*schema.names, "file_date"]), "file_date, business_date"
        own = {"file_date": file_date}
    else:
        append_partitioned(rows, path, "business_date")
    written = []
    if lake.database:
        dates_in = rows.select("business_date").dropna().distinct().collect()
        written = [{**own, "business_date": r["business_date"]} for r in dates_in]
    lake.register(f"{domain}_bronze", path, schema, folders, written)


def _folder_rows(lake: Lake, path: str, schema: T.StructType, folder: str) -> DataFrame:
    """Rows of the folders that match ``folder`` only; no other is listed."""
    if not path_exists(lake.spark, f"{path}/{folder}"):
        return lake.spark.createDataFrame([], schema)
    reader = lake.spark.read.schema(schema).option("basePath", path)
    return reader.parquet(f"{path}/{folder}").select(*schema.names)


def _bronze(lake: Lake, domain: str, business_date: str) -> DataFrame:
    """Bronze rows of one date, whichever file brought them."""
    path, schema = lake.path(domain, "bronze"), BRONZE_SCHEMAS[domain]
    if lake.safe_rerun:
        recover_partitions(lake.spark, path)
    folder = f"business_date={business_date}"
    rows = _folder_rows(lake, path, schema, folder)
    if not path_exists(lake.spark, f"{path}/file_date=*/{folder}"):
        return rows
    stored = _strings([*schema.names, "file_date"])
    by_file = _folder_rows(lake, path, stored, f"file_date=*/{folder}")
    return rows.unionByName(by_file.select(*schema.names))


def _write_date(
    lake: Lake, name: str, path: str, rows: DataFrame, business_date: str, schema: T.StructType
) -> None:
    if lake.safe_rerun:
        replace_partition(rows, path, scd.EFFECTIVE, business_date)
    else:
        append_partitioned(rows, path, scd.EFFECTIVE)
    lake.register(name, path, schema, scd.EFFECTIVE, [{scd.EFFECTIVE: business_date}])


def index_silver(lake: Lake, business_date: str) -> None:
    rows = index_silver_rows(_bronze(lake, "index", business_date), business_date)
    path = lake.path("index", "silver")
    _write_date(lake, "index_silver", path, rows, business_date, INDEX_SILVER_SCHEMA)


def security_silver(lake: Lake, business_date: str) -> None:
    source = security_versions(_bronze(lake, "security", business_date), business_date)
    if lake.safe_rerun:
        lake.history.splice(source, [business_date])
    else:
        lake.history.merge(source, SECURITY_KEY)
    if lake.database:
        lake.history.register(lake.database, "security_history_silver", "security_latest_silver")


def gold(lake: Lake, business_date: str) -> None:
    """Adds a date to the gold table, with the securities as they are now."""
    silver_path, folder = lake.path("index", "silver"), f"{scd.EFFECTIVE}={business_date}"
    if lake.safe_rerun:
        recover(lake.spark, f"{silver_path}/{folder}")
    rows = gold_rows(_folder_rows(lake, silver_path, INDEX_SILVER_SCHEMA, folder), lake.latest)
    path = lake.path("index_security")
    _write_date(lake, "index_security", path, rows, business_date, GOLD_SCHEMA)


def read_gold(lake: Lake) -> DataFrame:
    if lake.safe_rerun:
        recover_partitions(lake.spark, lake.path("index_security"))
    return (
        lake.spark.read.schema(GOLD_SCHEMA)
        .parquet(lake.path("index_security"))
        .select(*GOLD_SCHEMA.names)
    )


def in_report_order(gold: DataFrame) -> DataFrame:
    """By date and constituent, NULLs first."""
    return gold.orderBy(scd.EFFECTIVE, "constituent_id")


def file_business_date(spark: SparkSession, uri: str) -> str:
    """The canonical date in a file's name."""
    return spark.range(1).select(dates.business_date(F.lit(uri)).alias("d")).first()["d"]


def ingest_index_file(lake: Lake, uri: str, business_date: str | None = None) -> str:
    """One daily index file into bronze and silver; returns its date."""
    date = business_date or file_business_date(lake.spark, uri)
    land(lake, "index", read_csv(lake.spark, uri, INDEX_COLUMNS), date)
    index_silver(lake, date)
    return date


def ingest_security_file(lake: Lake, uri: str, business_date: str | None = None) -> str:
    """One daily security file into bronze and history; returns its date."""
    date = business_date or file_business_date(lake.spark, uri)
    land(lake, "security", read_csv(lake.spark, uri, SECURITY_COLUMNS), date)
    security_silver(lake, date)
    return date


def replay(
    lake: Lake, index_dates: Sequence[str], security_dates: Sequence[str]
) -> DataFrame:
    """Silver and gold of landed rows, date by date; returns the gold table in order.

    A date may lack a security file: its gold uses the securities of the dates
    before. Every step reads only its date's partition and writes a table, so no
    plan grows with the number of dates.
    """
    for date in sorted({*index_dates, *security_dates}):
        if date in security_dates:
            security_silver(lake, date)
        if date in index_dates:
            index_silver(lake, date)
            gold(lake, date)
    return in_report_order(read_gold(lake))
