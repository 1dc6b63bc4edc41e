"""A shipment history that a refresh rewrites only where it touches it.

Rows lie in buckets by the hash of their key, open and finished shipments apart: ``open``
is partitioned by bucket, ``finished`` by bucket and by the batch that finished them. A
refresh reads the buckets of its own keys. Of these it replaces the open rows, and adds
finished rows as partitions of its own batch; the finished rows of earlier batches, which are most of
a history, are only asked about their keys, and rewritten only where a shipment with
finished rows was open again. Files of other buckets stay as they are. ``compact`` puts the
finished rows of many batches together in a folder of its own.

Partitions are replaced one after the other and the batch is logged last, so a refresh
that failed half-way is repeated: it looks at nothing that its own batch has written, and
ends with the same rows. A logged batch changes nothing any more. One refresh runs at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelworks.operators.carriers import COMPLETED
from parcelworks.operators.keyed import anti_join, scattered
from parcelworks.session import stage_table
from parcelworks.sources.sinks import append_rows, replace_partitions

BUCKET, BATCH = "bucket", "batch"
_LOG = "batch bigint, step int, buckets int, columns string, finished string"
_PARTS = T.StructType([T.StructField(BUCKET, T.IntegerType()), T.StructField(BATCH, T.LongType())])


@dataclass(frozen=True)
class _State:
    """The last logged state: batch, what was done since, buckets, columns, folder of finished rows."""

    batch: int
    step: int
    buckets: int
    columns: T.StructType
    finished: str


def _state(spark: SparkSession, root: str) -> _State | None:
    try:
        log = spark.read.schema(_LOG).parquet(f"{root}/_batches")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    row = log.orderBy(F.desc("batch"), F.desc("step")).first()
    return None if row is None else _State(*row[:3], T.StructType.fromDDL(row["columns"]), row["finished"])


def _log(spark: SparkSession, root: str, state: _State) -> None:
    row = (state.batch, state.step, state.buckets, state.columns.toDDL(), state.finished)
    append_rows(spark.createDataFrame([row], _LOG), f"{root}/_batches")


def _is_open():
    return F.coalesce(F.col("mapped_status") != COMPLETED, F.lit(True))


def _dealt(rows: DataFrame, key: str, buckets: int, batch: int) -> DataFrame:
    """Rows with their bucket; those without a key are dealt by their content."""
    place = F.pmod(F.xxhash64(F.coalesce(F.col(key), scattered(rows))), F.lit(buckets)).cast("int")
    return rows.withColumns({BUCKET: place, BATCH: F.lit(batch).cast("bigint")})


def _stored(spark: SparkSession, root: str, part: str, columns: T.StructType, batch: int) -> DataFrame:
    """Rows of one part as they were before ``batch``."""
    rows = spark.read.schema(T.StructType([*columns.fields, *_PARTS.fields])).parquet(f"{root}/{part}")
    return rows.where(F.col(BATCH) < batch)


def start_history(rows: DataFrame, root: str, key: str, buckets: int = 64) -> None:
    """A new history under ``root``, as batch 0; ``buckets`` stays the same for good.

    ``rows`` has ``key`` (text) and ``mapped_status``. A bucket should fit a few tasks.
    """
    spark = rows.sparkSession
    if _state(spark, root) is not None:
        raise FileExistsError(f"there is a history under {root}")
    if clash := {BUCKET, BATCH} & set(rows.columns):
        raise ValueError(f"a history has columns of its own named {sorted(clash)}")
    dealt = stage_table(_dealt(rows, key, buckets, 0), "history")
    replace_partitions(dealt.where(_is_open()), f"{root}/open", [BUCKET], [])
    replace_partitions(dealt.where(~_is_open()), f"{root}/finished", [BUCKET, BATCH], [])
    _log(spark, root, _State(0, 0, buckets, rows.schema, "finished"))


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the last batch that was logged."""
    state = _state(spark, root)
    if state is None:
        raise FileNotFoundError(f"no history under {root}")
    parts = [_stored(spark, root, part, state.columns, state.batch + 1) for part in ("open", state.finished)]
    return parts[0].unionByName(parts[1]).drop(BUCKET, BATCH)


def refresh(new: DataFrame, root: str, key: str, batch: int | None = None) -> int:
    """Upsert ``new`` and return the last batch: the rules of ``upsert_freeze_completed``.

    Keys with an open row are renewed, unknown keys added, finished ones kept; rows without a
    key are added. Without ``batch`` the next number is taken; a logged one is left alone.
    """
    spark = new.sparkSession
    state = _state(spark, root)
    if state is None:
        raise FileNotFoundError(f"no history under {root}")
    batch = state.batch + 1 if batch is None else batch
    if batch <= state.batch:
        return state.batch
    columns, done_at = state.columns, f"{root}/{state.finished}"
    fresh = stage_table(_dealt(new, key, state.buckets, batch), "refresh")
    touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
    here = F.col(BUCKET).isin(touched)
    opened = _stored(spark, root, "open", columns, batch).where(here)
    finished = _stored(spark, root, state.finished, columns, batch).where(here)

    asked = fresh.where(F.col(key).isNotNull()).select(key).distinct()
    renewed = stage_table(opened.select(key).join(asked, key, "left_semi").distinct(), "renewed")
    known = finished.select(key, BUCKET, BATCH).join(asked, key, "left_semi")
    frozen = anti_join(known.select(key).distinct(), renewed, key)
    # Few: partitions that hold finished rows of a shipment that was open again.
    reopened = [tuple(r) for r in known.join(renewed, key, "left_semi").select(BUCKET, BATCH).distinct().collect()]

    added = anti_join(fresh, frozen, key)
    rows = stage_table(anti_join(opened, renewed, key).unionByName(added, allowMissingColumns=True), "history")
    done = rows.where(~_is_open() & (F.col(BATCH) == batch))
    replace_partitions(done, done_at, [BUCKET, BATCH], [])
    if reopened:
        theirs = F.struct(BUCKET, BATCH).isin([F.struct(F.lit(b).cast("int"), F.lit(n).cast("bigint")) for b, n in reopened])
        kept = stage_table(anti_join(finished.where(theirs), renewed, key), "finished")
        replace_partitions(kept, done_at, [BUCKET, BATCH], reopened)
    replace_partitions(rows.where(_is_open()), f"{root}/open", [BUCKET], [(b,) for b in touched])
    held = T.StructType([f for f in rows.schema.fields if f.name not in (BUCKET, BATCH)])
    _log(spark, root, replace(state, batch=batch, step=0, columns=held))
    return batch


def compact(spark: SparkSession, root: str) -> str:
    """Put the finished rows of all batches together, one partition per bucket, and return their folder.

    They are written to a new folder, which is logged last: until then the old one counts. It
    stays for readers that began before; it is the job's to remove. No refresh may run meanwhile.
    """
    state = _state(spark, root)
    if state is None:
        raise FileNotFoundError(f"no history under {root}")
    folder = f"finished-{state.batch}-{state.step + 1}"
    rows = _stored(spark, root, state.finished, state.columns, state.batch + 1)
    one = rows.withColumn(BATCH, F.lit(state.batch).cast("bigint"))
    replace_partitions(one, f"{root}/{folder}", [BUCKET, BATCH], [])
    _log(spark, root, replace(state, step=state.step + 1, finished=folder))
    return folder
