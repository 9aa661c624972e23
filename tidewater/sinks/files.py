"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def _aside(folder: str, kind: str) -> str:
    """A folder beside ``folder`` that no reader of a table sees."""
    parent, _, name = folder.rstrip("/").rpartition("/")
    return f"{parent}/.{kind}-{name}"


def recover(spark: SparkSession, folder: str) -> None:
    """Ends a replacement that broke off: the old rows come back if the new ones were not
    in their place yet, and go if they were."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    old = path(_aside(folder, "old"))
    if not files.exists(old):
        return
    if files.exists(path(folder)):
        files.delete(old, True)
    elif not files.rename(old, path(folder)):
        raise OSError(f"the rows of {folder} are still in {old}")


def recover_partitions(spark: SparkSession, table: str) -> None:
    """``recover`` for all partition folders of a table that a replacement left aside."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    pattern = path(f"{table.rstrip('/')}/.old-*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.globStatus(pattern) or []:
        name = status.getPath().getName().removeprefix(".old-")
        recover(spark, f"{table.rstrip('/')}/{name}")


def _replace(writer: DataFrameWriter, df: DataFrame, folder: str) -> None:
    """Writes beside ``folder``, moves the old rows aside, the new ones in, the old away.

    A failed job leaves the old rows as they were. After a failure between the two moves
    they are aside, where ``recover`` finds them; the next replacement calls it first.
    ``df`` may not read ``folder``.
    """
    spark = df.sparkSession
    recover(spark, folder)
    new, old = _aside(folder, "new"), _aside(folder, "old")
    writer.mode("overwrite").parquet(new)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path(folder)):
        _move(files, path(folder), path(old))
    try:
        _move(files, path(new), path(folder))
    except Exception:
        recover(spark, folder)
        raise
    files.delete(path(old), True)


def _move(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"{source} could not be moved to {target}")


def append_partitioned(df: DataFrame, path: str, column: str) -> None:
    """Appends parquet files in folders by ``column``."""
    df.write.mode("append").partitionBy(column).parquet(path)


def replace_partition(
    df: DataFrame, path: str, column: str, value: str, partition_by: str | None = None
) -> None:
    """Makes ``df`` the whole content of one partition, so that writing it again
    changes nothing. All other partitions stay."""
    writer = df.drop(column).write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    _replace(writer, df, f"{path.rstrip('/')}/{column}={value}")


def rebalanced(df: DataFrame, column: str) -> DataFrame:
    """Rows of one ``column`` value brought together into files of a good size.

    For loads of many dates: AQE merges small dates and splits a hot one. Without
    AQE nothing would split it, so the rows then stay where they are.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        return df
    return df.hint("rebalance", column)


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_parquet(df: DataFrame, path: str) -> None:
    """Replaces the whole table once the new rows are written."""
    _replace(df.write, df, path.rstrip("/"))


def append_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated text with a header line per file."""
    df.write.mode("append").option("sep", "\t").option("header", True).csv(path)
