"""File and catalog readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """A CSV with a header line; every column is a string, an empty field NULL.

    With ``columns`` the header is not read up front and a header that differs
    fails the read.
    """
    reader = spark.read.option("header", True)
    if columns:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line in ``value``; ``path`` may be a glob."""
    return spark.read.text(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def driver_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``{folder}/{name}.parquet``, a file or a folder of part files."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
