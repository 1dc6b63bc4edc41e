"""Scan histories as partial aggregates that are stored and merged with new scans.

What a shipment's scans come to is made of least, greatest and last values, so it can be
held as one row per shipment and merged with the row of any further scans, in any order
and also twice: old scans are never read again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelworks.operators.tracking import ARRIVED, PICKED_UP, RETURN_STARTED, ROLLED, closing_dates
from parcelworks.session import stage_table
from parcelworks.sources.sinks import append_rows, replace_partitions

BUCKET = "bucket"
_STATE = "buckets int, columns string"


def scan_state(scans: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One mergeable row per shipment of (key, status, time) scans.

    ``last`` holds the order columns of the last scan and then its status; of two scans
    that are equal in order, the greater status counts.
    """

    def times(status: str) -> Column:
        return F.when(F.col("status") == status, F.col("time"))

    return scans.groupBy(key).agg(
        F.min(times(PICKED_UP)).alias("pickup_date"),
        F.min(times(RETURN_STARTED)).alias("rto_initiated_date"),
        F.max(times(ARRIVED)).alias("arrived"),
        F.max(F.struct(*[F.col(c).alias(f"order_{i}") for i, c in enumerate(order)], "status")).alias("last"),
        F.max((F.col("status") == RETURN_STARTED).cast("int")).alias("returned"),
    )


def merge_states(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """One row per shipment of either side; shipments of one side alone stay as they are."""
    return (
        first.unionByName(second)
        .groupBy(key)
        .agg(
            F.min("pickup_date").alias("pickup_date"),
            F.min("rto_initiated_date").alias("rto_initiated_date"),
            F.max("arrived").alias("arrived"),
            F.max("last").alias("last"),
            F.max("returned").alias("returned"),
        )
    )


def rolled_up(state: DataFrame, key: str) -> DataFrame:
    """What ``rollup_scan_history`` gives for all scans that went into the state."""
    last = state.withColumn("last_status", F.col("last.status"))
    return closing_dates(last, F.col("returned") == 1).select(F.col(key).alias("awb_num"), *ROLLED)


def _kept(spark: SparkSession, root: str) -> tuple[int, T.StructType] | None:
    try:
        row = spark.read.schema(_STATE).parquet(f"{root}/_state").first()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if row is None else (row["buckets"], T.StructType.fromDDL(row["columns"]))


def _read(spark: SparkSession, root: str, columns: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*columns.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(f"{root}/shipments")


def fold_scans(scans: DataFrame, root: str, key: str, order: list[str], buckets: int = 64) -> None:
    """Merge new scans into the states stored under ``root``.

    Only the buckets (by hash of the key) that the scans touch are read and written again, and of
    the new scans one row per shipment is shuffled. Repeating a call, or a scan, changes
    nothing. ``buckets`` must be the same in every call.
    """
    spark = scans.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    fresh = stage_table(scan_state(scans, key, order).withColumn(BUCKET, bucket), "scans")
    kept = _kept(spark, root)
    columns = T.StructType([f for f in fresh.schema.fields if f.name != BUCKET])
    if kept is None:
        replace_partitions(fresh, f"{root}/shipments", [BUCKET], [])
        append_rows(spark.createDataFrame([(buckets, columns.toDDL())], _STATE), f"{root}/_state")
        return
    if kept[0] != buckets:
        raise ValueError(f"the states under {root} lie in {kept[0]} buckets, not {buckets}")
    touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]
    old = _read(spark, root, kept[1]).where(F.col(BUCKET).isin(touched))
    merged = merge_states(old.drop(BUCKET), fresh.drop(BUCKET), key).withColumn(BUCKET, bucket)
    replace_partitions(stage_table(merged, "scans"), f"{root}/shipments", [BUCKET], [(b,) for b in touched])


def read_states(spark: SparkSession, root: str) -> DataFrame:
    kept = _kept(spark, root)
    if kept is None:
        raise FileNotFoundError(f"no scan states under {root}")
    return _read(spark, root, kept[1]).drop(BUCKET)
