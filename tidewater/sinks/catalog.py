"""Databases and tables of the session catalog."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import path_exists, work_dir


def create_database(spark: SparkSession, name: str, recreate: bool = False) -> None:
    """``recreate`` drops the database first, which fails while it holds tables."""
    if recreate:
        spark.sql(f"DROP DATABASE IF EXISTS {name}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_table(
    spark: SparkSession,
    name: str,
    columns: str,
    location: str,
    partitioned_by: str | None = None,
) -> None:
    """An external parquet table with a fixed schema (``columns`` is DDL), and the
    partitions that its folder has when the table is made."""
    if spark.catalog.tableExists(name):
        return
    partitions = f"PARTITIONED BY ({partitioned_by})" if partitioned_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"{partitions} LOCATION '{_quoted(location)}'"
    )
    if path_exists(spark, location):
        refresh(spark, name, partitioned_by is not None)


def register_table(
    spark: SparkSession,
    name: str,
    location: str,
    schema: T.StructType | None = None,
    partitioned_by: str | None = None,
) -> None:
    """An external table over existing files.

    Columns and partitions come from the files, where folder names that look like
    dates become dates, or from ``schema``. To be called again after files were
    added, to make new partitions visible; ``add_partition`` does so for one.
    """
    if schema is not None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        known = spark.catalog.tableExists(name)
        create_table(spark, name, columns, location, partitioned_by)
        if known and path_exists(spark, location):
            refresh(spark, name, partitioned_by is not None)
        return
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{location}'")
    refresh(spark, name, _is_partitioned(spark, name))


def _is_partitioned(spark: SparkSession, name: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(name))


def refresh(spark: SparkSession, name: str, partitioned: bool) -> None:
    """Makes files and partitions visible that were added by path."""
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)


def discover(
    spark: SparkSession, location: str, name: str = "default.bronze", file_format: str = "parquet"
) -> DataFrame:
    """Registers whatever lies under ``location`` as a table and returns it.

    Replaces an earlier registration, so changed schemas are picked up; external
    files are not touched.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    options = "OPTIONS (header 'true', inferSchema 'true')" if file_format == "csv" else ""
    spark.sql(f"CREATE TABLE {name} USING {file_format} {options} LOCATION '{location}'")
    refresh(spark, name, _is_partitioned(spark, name))
    return spark.table(name)


def in_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``df``, by position, under the names and types of ``schema``.

    Casts that an insert used to do silently are done here; a value that does not
    fit fails the job.
    """
    if len(df.columns) != len(schema):
        raise ValueError(f"{len(df.columns)} columns for a schema of {len(schema)}")
    renamed = df.toDF(*schema.names)
    return renamed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def insert_into(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> None:
    """``INSERT INTO table SELECT``: appends by position, with the table's types.

    ``columns`` is the declared column order when it is not the catalog's, which
    moves partition columns to the end.
    """
    stored = df.sparkSession.table(table).schema
    declared = T.StructType([stored[c] for c in (columns or stored.names)])
    in_schema(df, declared).select(*stored.names).write.mode("append").insertInto(table)


def add_partition(
    spark: SparkSession, name: str, values: Mapping[str, str], location: str | None = None
) -> None:
    """Makes one partition of a table visible, without a look at the others."""
    spec = ", ".join(f"`{column}` = '{_quoted(value)}'" for column, value in values.items())
    place = f" LOCATION '{_quoted(location)}'" if location else ""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec}){place}")
    spark.catalog.refreshTable(name)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def table_location(spark: SparkSession, name: str) -> str:
    """The folder that a table of the catalog reads."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def replace_rows(df: DataFrame, table: str) -> None:
    """Makes ``df``, by column name, the whole content of an unpartitioned parquet table.

    The rows are written to a fresh folder beside the table's, to which the table is then
    switched: one change of the catalog, before which every reader gets the old rows and
    after which the new ones. ``df`` may read the table. The old folder is removed last;
    a query that still reads it then fails, as after any overwrite.
    """
    spark = df.sparkSession
    if _is_partitioned(spark, table):
        raise ValueError(f"{table} is partitioned; its partitions have places of their own")
    stored = spark.table(table).schema
    rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in stored])
    old = table_location(spark, table)
    base, _, last = old.rstrip("/").rpartition("/")
    new = f"{base}/{last.partition('.rows-')[0]}.rows-{uuid.uuid4().hex}"
    rows.write.parquet(new)
    _switch(spark, table, new)
    path = spark._jvm.org.apache.hadoop.fs.Path(old)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _switch(spark: SparkSession, table: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(location)}'")
    spark.catalog.refreshTable(table)


def load_table(df: DataFrame, table: str, truncate: bool = False) -> None:
    """Loads rows into a warehouse table of the catalog, by column name.

    With ``truncate`` the new rows replace the old ones, otherwise they are added. An
    unpartitioned table is replaced in one step (``replace_rows``). A partitioned one is
    overwritten once the new rows are computed and written aside, which is no single
    commit: its partitions are entries of their own in the catalog.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.saveAsTable(table)
        return
    if truncate and not _is_partitioned(spark, table):
        replace_rows(df, table)
        return
    rows = df.select(*spark.table(table).columns)
    if truncate:
        aside = work_dir(spark, "load")
        rows.write.parquet(aside)
        rows = spark.read.schema(rows.schema).parquet(aside)
    rows.write.mode("overwrite" if truncate else "append").insertInto(
        table, overwrite=truncate
    )


def load_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    truncate: bool = False,
    properties: dict[str, str] | None = None,
    connections: int = 16,
) -> None:
    """Loads rows into a warehouse over JDBC, keeping the table's definition.

    ``connections`` bounds the parallel writers; partitions are only merged, never
    funnelled through one.
    """
    writer = df.write.option("numPartitions", connections)
    if truncate:
        writer = writer.option("truncate", True)
    writer.jdbc(
        url, table, mode="overwrite" if truncate else "append", properties=properties or {}
    )
