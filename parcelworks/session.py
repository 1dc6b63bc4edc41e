"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when a later stage must then shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A session runs many wide plans; keep their compiled code.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Wide projections become long methods, which the JVM otherwise never compiles.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.ui.enabled": "false",
}


def build_session(name: str = "parcelworks", **extra: str) -> SparkSession:
    """A session with the settings above; a cluster passes its own sizes in ``extra``."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate results.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="parcelworks-"))
    return spark.sparkContext.getCheckpointDir()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Within it, what a job has shuffled leaves the disk as the job ends.

    Otherwise it stays until the driver happens to collect its garbage.
    """
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


#: A task of ``in_few_tasks`` gets about so many rows; tables of at most so many are sent to every task.
TASK_ROWS = 4096
BROADCAST_ROWS = 200_000


def in_few_tasks(df: DataFrame, rows: int | None) -> DataFrame:
    """``df``, which has at most about ``rows`` rows, in no more tasks than these need.

    A task then reads several partitions of the last shuffle; large tables, and those of
    unknown size, stay as they are.
    """
    return df if rows is None else df.coalesce(max(1, math.ceil(rows / TASK_ROWS)))


def to_all(df: DataFrame, rows: int) -> DataFrame:
    """The smaller side of a join, of at most ``rows`` rows: a few are broadcast, more meet the others by a shuffle."""
    return F.broadcast(in_few_tasks(df, rows)) if rows <= BROADCAST_ROWS else df


def stage_table(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where a wide joined fact feeds several aggregations: the joins run once,
    later steps read only the columns they need, and a lost executor costs no
    recomputation of what came before. Between two shuffles of wide rows it keeps
    the first one's files from lying beside the second one's.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    with shuffles_end(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(*tables: DataFrame) -> None:
    """Take staged tables off the disk, once all that is made from them is written itself."""
    for table in tables:
        spark = table.sparkSession
        root = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            if path.getParent().toUri().getPath() != files.makeQualified(root).toUri().getPath():
                raise ValueError(f"{folder} is not a staged table")
            files.delete(path, True)


def stage_bucketed(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """As ``stage_table``, in buckets by ``key``: joins on it later leave this table where it is.

    For a wide table that several joins look up: it is shuffled once, as it is written.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    with shuffles_end(spark):
        writer.option("path", f"{shared_folder(spark)}/{name}").format("parquet").saveAsTable(name)
    return spark.table(name)
