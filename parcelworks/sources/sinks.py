"""Writers: snapshots, replaced tables, appended logs, published versions."""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parcelworks.functions.sentinels import render_sentinels

_LOG = "script string, updated_at string"
_METRICS = "script string, updated_at string, metric string, value bigint"
_VERSIONS = "version bigint, path string"
_TIME = "%Y-%m-%d %H:%M:%S"


def export_view(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """The table as it is exported: reasons in place of values, headers, blanks for null."""
    names = {name: header for header, name in headers.items()}
    shown = render_sentinels(df)
    return shown.select(
        *[
            F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(names.get(c, c))
            for c in shown.columns
        ]
    )


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows, to look at."""
    return df.limit(n)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("compression", compression).csv(path)


def replace_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a table, or with ``partition_by`` only the partitions that ``df`` holds.

    ``df`` must not read from ``path``; for that case use ``publish``.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Append: dead letters, sent messages, log rows."""
    df.write.mode("append").parquet(path)


def replace_partitions(df: DataFrame, path: str, by: list[str], touched: list[tuple]) -> None:
    """Replace the ``touched`` partitions and no other; one that ``df`` has no rows of becomes empty.

    ``touched`` holds one tuple of values of the ``by`` columns per partition, of which there
    are few; ``df`` must have rows of these alone, and must not read from ``path``.
    """
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)
    held = {tuple(r) for r in df.select(*by).distinct().collect()}
    nothing = df.drop(*by).limit(0)
    for values in sorted(set(touched) - held):
        leaf = "/".join(f"{name}={value}" for name, value in zip(by, values, strict=True))
        nothing.write.mode("overwrite").parquet(f"{path}/{leaf}")


def append_batch(df: DataFrame, path: str, batch: int, log: str = "batch") -> None:
    """Append rows as batch number ``batch``; the same batch again takes the place of its rows.

    So a job that is repeated after a failure appends once: dead letters, sent messages, log
    rows. A batch without rows leaves an empty partition, also where an earlier try had some.
    """
    if log in df.columns:
        raise ValueError(f"the rows have a column {log} already")
    replace_partitions(df.withColumn(log, F.lit(batch).cast("bigint")), path, [log], [(batch,)])


def read_batches(spark: SparkSession, path: str, log: str = "batch") -> DataFrame:
    """All appended rows, with the number of their batch as the last column."""
    rows = spark.read.parquet(path)
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != log], F.col(log).cast("bigint").alias(log))


def append_run_log(spark: SparkSession, path: str, script: str, at: dt.datetime) -> None:
    append_rows(spark.createDataFrame([(script, at.strftime(_TIME))], _LOG), path)


def append_run_logs(scripts: DataFrame, path: str, at: dt.datetime) -> None:
    """One log row per name in the one column of ``scripts``, in one append."""
    name = F.col(f"`{scripts.columns[0]}`").alias("script")
    append_rows(scripts.select(name, F.lit(at.strftime(_TIME)).alias("updated_at")), path)


def write_counted(df: DataFrame, write: Callable[[DataFrame], None], counts: dict[str, Column]) -> dict[str, int]:
    """Write ``df`` with ``write`` and count on the way: no second pass, nothing collected.

    ``counts`` maps a name to a condition; ``n_rows`` counts all rows. The counts are those of
    the rows as they were written.
    """
    seen = Observation()
    counted = {"n_rows": F.lit(True), **counts}
    write(df.observe(seen, *[F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, test in counted.items()]))
    return dict(seen.get)


def log_counts(spark: SparkSession, path: str, script: str, at: dt.datetime, counts: dict[str, int], batch: int) -> None:
    """The counts of one run as log rows, once per ``batch``."""
    rows = [(script, at.strftime(_TIME), name, value) for name, value in sorted(counts.items())]
    append_batch(spark.createDataFrame(rows, _METRICS), path, batch)


def _versions(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_VERSIONS).parquet(f"{root}/_published")
    except AnalysisException as problem:
        # Only a log that isn't there means that nothing was published.
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current_version(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """Number and folder of the last published version."""
    log = _versions(spark, root)
    row = None if log is None else log.orderBy(F.desc("version")).first()
    return None if row is None else (row["version"], row["path"])


def publish(df: DataFrame, root: str, version: int | None = None) -> int:
    """Write a new version next to the one being read, then make it the current one.

    Readers see either the old or the new version, never a half-written table. A
    version that is published already is left alone, so a repeated call is safe.
    """
    spark = df.sparkSession
    current = current_version(spark, root)
    last = 0 if current is None else current[0]
    version = last + 1 if version is None else version
    if version <= last:
        return last
    path = f"{root}/version={version}"
    df.write.mode("overwrite").parquet(path)
    append_rows(spark.createDataFrame([(version, path)], _VERSIONS), f"{root}/_published")
    return version


def read_published(spark: SparkSession, root: str) -> DataFrame:
    current = current_version(spark, root)
    if current is None:
        raise FileNotFoundError(f"nothing published under {root}")
    return spark.read.parquet(current[1])
