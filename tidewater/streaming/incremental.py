"""Ingesting only the files that are new since the last run."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    bookmark: str,
    file_format: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: str | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Appends the rows of unseen files under ``source`` to ``target``.

    Progress is kept in the ``bookmark`` folder
    and committed with the output, so each file arrives exactly once although a
    run may fail at any point. The run ends when all files present at its start
    are read; ``maxFilesPerTrigger`` in ``options`` bounds one batch.
    """
    stream = (
        spark.readStream.format(file_format)
        .schema(schema)
        .options(**(options or {}))
        .load(source)
    )
    rows = transform(stream) if transform else stream
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", bookmark)
        .option("path", target)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.start().awaitTermination()


def load_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    bookmark: str,
    file_format: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """The same into folders ``load=...`` of ``target``, which batch loads may share.

    Each batch of files has a folder of its own that a rerun replaces, so a row arrives
    once although a run may fail at any point; ``transform`` sees a batch as a plain
    table.
    """
    name = hashlib.sha256(bookmark.encode()).hexdigest()[:16]

    def load(rows: DataFrame, number: int) -> None:
        rows = transform(rows) if transform else rows
        rows.write.mode("overwrite").parquet(f"{target}/load={name}-{number}")

    (
        spark.readStream.format(file_format)
        .schema(schema)
        .options(**(options or {}))
        .load(source)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", bookmark)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
