"""Storage of a type 2 history whose daily merge never rewrites closed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import scd
from tidewater.operators.joins import balanced_join
from tidewater.session import path_exists, work_dir
from tidewater.sinks import catalog
from tidewater.sources.snapshots import VERSION, SnapshotTable

# The folder of keys whose earlier closed rows no longer count.
VOID = "void"


class HistoryTable:
    """Each version holds all rows open after a merge and the rows it closed.

    The history at version N is N's open rows and the closed rows of versions up
    to N. A merge reads and writes open rows only: its cost follows the number of
    keys, not the length of the history. Version and openness are partition
    folders, so both choices prune files.

    A splice also changes closed rows. Its version holds all rows of the keys concerned
    anew and, in a folder ``latest=void``, these keys: their closed rows of earlier
    versions no longer count. No file is changed.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str | None = None
    ):
        self.spark = spark
        self.schema = schema
        self.key = key
        self.snapshots = SnapshotTable(spark, path)

    def _version(self, upto: int | None) -> int:
        """The newest version, or the newest one up to ``upto``."""
        versions = self.snapshots.versions()
        newest = max((v for v in versions if upto is None or v <= upto), default=None)
        if newest is None:
            raise ValueError(f"{self.snapshots.path} has no committed version")
        return newest

    def _scan(self, *versions: int) -> DataFrame:
        stored = T.StructType(
            [f for f in self.schema if f.name != scd.LATEST]
            + [T.StructField(VERSION, T.LongType()), T.StructField(scd.LATEST, T.StringType())]
        )
        return (
            self.spark.read.schema(stored)
            .option("basePath", self.snapshots.path)
            .parquet(*[self.snapshots.version_path(v) for v in versions])
        )

    def _typed(self, rows: DataFrame) -> DataFrame:
        return rows.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        )

    def _voids(self, versions: Sequence[int]) -> list[int]:
        """The versions that void closed rows."""
        return [
            v for v in versions
            if path_exists(self.spark, f"{self.snapshots.version_path(v)}/{scd.LATEST}={VOID}")
        ]

    def _closed(self, newest: int, key: str | None) -> DataFrame:
        """The closed rows at version ``newest``, as stored."""
        versions = [v for v in self.snapshots.versions() if v <= newest]
        closed = self._scan(*versions).where(F.col(scd.LATEST) == "false")
        voiding = self._voids(versions)
        if not voiding:
            return closed
        if key is None:
            raise ValueError("a spliced history is read by its key")
        voids = (
            self._scan(*voiding)
            .where(F.col(scd.LATEST) == VOID)
            .groupBy(F.col(key).alias("_key_0"))
            .agg(F.max(VERSION).alias("_void_from"))
        )
        marked = balanced_join(closed, voids, [(key, "_key_0")], "left")
        return marked.where(F.col("_void_from").isNull() | (F.col(VERSION) >= F.col("_void_from")))

    def read(self, version: int | None = None) -> DataFrame:
        """The whole history, at the newest or the given version."""
        newest = self._version(version)
        return self.open_rows(newest).unionByName(self._typed(self._closed(newest, self.key)))

    def open_rows(self, version: int | None = None) -> DataFrame:
        """The rows valid now, or at the given version."""
        rows = self._scan(self._version(version))
        return self._typed(rows.where(F.col(scd.LATEST) == "true"))

    def _stored(self, rows: DataFrame) -> DataFrame:
        """Rows as they are written: openness as text, as it is a folder's name."""
        kinds = {scd.LATEST: T.StringType()}
        return rows.select(
            *[F.col(f.name).cast(f.dataType).cast(kinds.get(f.name, f.dataType)).alias(f.name) for f in self.schema]
        )

    def append_version(
        self, rows: DataFrame, voids: DataFrame | None = None, batch: str | None = None
    ) -> int:
        """Writes open rows and newly closed rows as the next version.

        The closed rows of earlier versions of the keys in ``voids`` no longer count.
        """
        stored = self._stored(rows)
        if voids is not None:
            name = voids.columns[0]
            mark = {self.key: F.col(name), scd.LATEST: F.lit(VOID)}
            stored = stored.unionByName(
                voids.select(*[mark.get(f.name, F.lit(None)).cast(stored.schema[f.name].dataType).alias(f.name) for f in self.schema])
            )
        return self.snapshots.write(stored, partition_by=scd.LATEST, batch=batch)

    def register(self, database: str, history: str, latest: str) -> None:
        """Makes the newest version readable by name in every session of the catalog.

        The stored rows are a table with a partition for each version and kind; only the
        newest version's are added. ``history`` and ``latest`` are views of it that name
        the version: each follows in one change of the catalog, and keeps its rows while
        the next version is written.
        """
        newest = self._version(None)
        files = f"{database}.{history}_files"
        schema = T.StructType(
            [f for f in self.schema if f.name != scd.LATEST]
            + [T.StructField(VERSION, T.LongType()), T.StructField(scd.LATEST, T.StringType())]
        )
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        catalog.create_table(self.spark, files, columns, self.snapshots.path, f"{VERSION}, {scd.LATEST}")
        for kind in ("true", "false", VOID):
            folder = f"{self.snapshots.version_path(newest)}/{scd.LATEST}={kind}"
            if path_exists(self.spark, folder):
                catalog.add_partition(self.spark, files, {VERSION: str(newest), scd.LATEST: kind}, folder)
        rows = ", ".join(
            f"CAST(f.`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in self.schema
        )
        is_open = f"f.{VERSION} = {newest} AND f.{scd.LATEST} = 'true'"
        closed = f"f.{VERSION} <= {newest} AND f.{scd.LATEST} = 'false'"
        if self._voids([v for v in self.snapshots.versions() if v <= newest]):
            closed += (
                f" AND NOT EXISTS (SELECT 1 FROM {files} v WHERE v.{scd.LATEST} = '{VOID}' "
                f"AND v.{VERSION} <= {newest} AND v.`{self.key}` = f.`{self.key}` AND v.{VERSION} > f.{VERSION})"
            )
        chosen = f"SELECT {rows} FROM {files} f WHERE"
        self.spark.sql(f"CREATE OR REPLACE VIEW {database}.{latest} AS {chosen} {is_open}")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{history} AS "
            f"{chosen} {is_open} UNION ALL {chosen} {closed}"
        )

    def merge(
        self, source: DataFrame, key: str, on_duplicate: str = "error", guard_late: bool = False
    ) -> int:
        """Merges new versions of a day; see ``scd.scd2_merge``.

        Without a version yet all source rows are opened, of a key's several rows the
        newest if ``on_duplicate`` is "keep_last".
        """
        if self.snapshots.latest_version() is None:
            if on_duplicate == "keep_last":
                source = scd.newest_rows(source, key)
            return self.append_version(source)
        return self.append_version(
            scd.scd2_merge(self.open_rows(), source, key, on_duplicate, guard_late)
        )

    def splice(
        self, source: DataFrame, replaced_dates: Sequence[str] = (), batch: str | None = None
    ) -> int:
        """Merges new versions of any dates, late and corrected ones too.

        The history becomes what ``scd.scd2_splice`` says. Closed rows are read only as
        far as needed: of keys with a source row that is not newer than their open row,
        or with several source rows, and rows of ``replaced_dates``. Other keys are
        merged as in ``merge``. A ``batch`` that made a version before changes nothing.
        """
        if self.key is None:
            raise ValueError("a history without a key cannot be spliced")
        if batch is not None and (done := self.snapshots.version_of(batch)) is not None:
            return done
        key, columns = self.key, self.schema.names
        path = work_dir(self.spark, "splice")
        source.select(*columns).write.parquet(f"{path}/source")
        source = self.spark.read.schema(source.select(*columns).schema).parquet(f"{path}/source")
        newest = self.snapshots.latest_version()
        if newest is None:
            return self.append_version(scd.intervals(source, key), batch=batch)
        open_rows, closed = self.open_rows(newest), self._typed(self._closed(newest, key))
        replaced = None
        if replaced_dates:
            at_dates = F.col(scd.EFFECTIVE).isin(list(replaced_dates))
            replaced = open_rows.where(at_dates).unionByName(closed.where(at_dates)).select(key)
        late = scd.keys_to_splice(open_rows, source, key, replaced)
        late.write.parquet(f"{path}/keys")
        late = self.spark.read.schema(late.schema).parquet(f"{path}/keys")
        by_key = [(key, "_key_0")]
        of_late = lambda rows: balanced_join(rows, late, by_key, "left_semi")
        of_others = lambda rows: balanced_join(rows, late, by_key, "left_anti")
        other_open = of_others(open_rows)
        if replaced_dates:
            other_open = other_open.where(F.col(key).isNotNull() | ~at_dates)
        closed_late = of_late(closed)
        spliced = scd.splice_rows(
            of_late(open_rows).unionByName(closed_late), of_late(source), key, replaced_dates
        )
        merged = scd.scd2_merge(other_open, of_others(source), key)
        voids = closed_late.select(F.col(key).alias("_key_0")).distinct()
        return self.append_version(merged.unionByName(spliced), voids, batch)
