"""A table kept as whole snapshots under ``version=N`` folders."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "version"
COMMITS = "_commits"


def _digest(batch: str) -> str:
    return hashlib.sha256(batch.encode()).hexdigest()[:32]


class SnapshotTable:
    """Versions 0, 1, 2, ... of a table, each written once and never changed.

    A version counts once its empty file in ``_commits`` is there, which is made in one
    step after the rows are written. A failed or lost write leaves the previous version
    in place and is overwritten by the next attempt. The file's name also holds the
    write's ``batch``, so that a batch is known to be in the table exactly if its
    version is. One job writes a table at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def version_path(self, version: int) -> str:
        return f"{self.path}/{VERSION}={version}"

    def _commits(self) -> dict[int, str]:
        """Committed versions and their batches' digests."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{COMMITS}/*")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.globStatus(path) or []]
        return {int(n.partition("-")[0]): n.partition("-")[2] for n in names}

    def _commit(self, version: int, batch: str | None) -> None:
        name = str(version) if batch is None else f"{version}-{_digest(batch)}"
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{COMMITS}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True).close()

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return sorted(self._commits())

    def version_of(self, batch: str) -> int | None:
        """The version that ``batch`` made, if it is committed."""
        found = [v for v, digest in self._commits().items() if digest == _digest(batch)]
        return max(found, default=None)

    def latest_version(self) -> int | None:
        versions = self.versions()
        return versions[-1] if versions else None

    def write(self, df: DataFrame, partition_by: str | None = None, batch: str | None = None) -> int:
        """Writes ``df`` as the next version and returns its number.

        ``df`` may read any earlier version: no folder is ever overwritten while
        being read. A ``batch`` whose version is there already is not written again.
        """
        if batch is not None and (done := self.version_of(batch)) is not None:
            return done
        latest = self.latest_version()
        version = 0 if latest is None else latest + 1
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self.version_path(version))
        self._commit(version, batch)
        return version

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or the given one."""
        if version is None:
            version = self.latest_version()
        if version is None or version not in self.versions():
            raise ValueError(f"{self.path} has no committed version {version}")
        return self.spark.read.parquet(self.version_path(version))

    def read_all(self) -> DataFrame:
        """Every committed version, with its number in ``version``."""
        return (
            self.spark.read.option("basePath", self.path)
            .parquet(*[self.version_path(v) for v in self.versions()])
            .withColumn(VERSION, F.col(VERSION).cast("long"))
        )
