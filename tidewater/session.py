"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE coalesces small shuffle partitions, splits skewed join partitions and
# switches to a broadcast join when a side turns out small, so the number of
# shuffle partitions only has to be high enough for the largest shuffle.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Pages can be large, so the default of 10,000 rows is no bound on memory.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app_name: str = "tidewater",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings these jobs are written for.

    ``shuffle_partitions`` should be the largest shuffle's bytes / ~200 MB; AQE
    merges the surplus, so err on the high side.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's written tables.

    It lies under ``spark.checkpoint.dir``, or the checkpoint folder set on the
    context, which every executor can reach. A machine-local folder is used only by
    a local-mode session that sets neither.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir to a folder that all executors share"
            )
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidewater-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether any file or folder matches ``path``, which may hold wildcards."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(files.globStatus(hadoop_path))
