"""Tables kept as folders ``load=...``, each with a schema of its own."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession

from tidewater.operators.schemas import union_of


def load_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders of finished loads, in the order of their names."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/load=*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in files.globStatus(pattern) or [])


def read_loads(spark: SparkSession, path: str) -> DataFrame:
    """All loads' rows in one schema (see ``operators.schemas``).

    Loads of equal schemas are read together, so the plan grows with the number of
    different schemas, not of loads. One file a load is opened to learn its schema.
    """
    by_schema: dict[str, list[str]] = defaultdict(list)
    for folder in load_folders(spark, path):
        by_schema[spark.read.parquet(folder).schema.json()].append(folder)
    if not by_schema:
        raise ValueError(f"no loads under {path}")
    return union_of([spark.read.parquet(*folders) for folders in by_schema.values()])
