"""A type 2 history fed by the files that are new since the last run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewater.sources.history import HistoryTable


def merge_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    history: HistoryTable,
    bookmark: str,
    versions: Callable[[DataFrame], DataFrame],
    file_format: str = "parquet",
    options: dict[str, str] | None = None,
) -> None:
    """Splices the rows of unseen files under ``source`` into ``history``.

    ``versions`` makes open versions of raw rows (see ``scd.new_versions``). Files may
    come in any order and hold many dates; of a key and date the batch last merged
    counts. Every batch of files is one version of the history, which carries the
    batch's number and the bookmark's name: a batch that is run again, because the run
    failed after the merge and before the bookmark moved, changes nothing.
    """

    def merge(rows: DataFrame, number: int) -> None:
        history.splice(versions(rows), batch=f"{bookmark}#{number}")

    (
        spark.readStream.format(file_format)
        .schema(schema)
        .options(**(options or {}))
        .load(source)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", bookmark)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
