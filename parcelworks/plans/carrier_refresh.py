"""Refresh of the five stored carrier tables from what the carriers delivered last."""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelworks.functions.text import blank_to_null, numeric_key
from parcelworks.operators import answers, carriers, tracking
from parcelworks.operators.keyed import key_presence
from parcelworks.operators.upsert import upsert_freeze_completed, upsert_replace
from parcelworks.session import stage_table
from parcelworks.sources import history
from parcelworks.sources.sinks import append_batch, write_counted

NO_ANSWER = "no_answer"
# Computed outside and not part of a refreshed row.
_OUTSIDE = ["total_charges"]


def _plain_key(df: DataFrame, key: str) -> DataFrame:
    """Whole-number keys in one spelling; other keys stay as they are."""
    text = blank_to_null(F.col(key).cast("string"))
    return df.withColumn(key, F.coalesce(numeric_key(text), text))


def refresh_carrier_a(stored: DataFrame, export: DataFrame, as_of: dt.date) -> DataFrame:
    fresh = carriers.clean_export_a(export, as_of)
    merged = upsert_freeze_completed(stored.select(*carriers.STORED_A), fresh, "awb_code")
    return merged.dropDuplicates()


def refresh_carrier_b(stored: DataFrame, export: DataFrame, as_of: dt.date) -> DataFrame:
    fresh = carriers.clean_export_b(carriers.drop_ignored_b(export), as_of)
    kept = carriers.drop_ignored_b(stored.select(*carriers.STORED_B))
    return upsert_freeze_completed(kept, fresh, "awb_no")


def refresh_carrier_c(stored: DataFrame, answers: DataFrame, as_of: dt.date) -> DataFrame:
    fresh = carriers.clean_tracking_c(tracking.flatten_shipment_lists(answers, as_of))
    return upsert_freeze_completed(
        _plain_key(stored.drop(*_OUTSIDE), "awb_number"),
        _plain_key(fresh, "awb_number"),
        "awb_number",
    )


def refresh_carrier_d(stored: DataFrame, answers: DataFrame, as_of: dt.date) -> DataFrame:
    fresh = carriers.clean_tracking_d(tracking.read_scan_documents(answers), as_of)
    return upsert_freeze_completed(
        _plain_key(stored.drop(*_OUTSIDE), "awb_num"), _plain_key(fresh, "awb_num"), "awb_num"
    )


def refresh_carrier_e(stored: DataFrame, answers: DataFrame, as_of: dt.date) -> DataFrame:
    """This carrier's answers always replace the stored rows, finished or not."""
    fresh = tracking.flatten_packages(answers, as_of)
    return upsert_replace(stored.drop(*_OUTSIDE), fresh, "awb_number")


def poll_round(
    recent: DataFrame,
    root: str,
    ask: Callable[[DataFrame], DataFrame],
    letters: str,
    as_of: dt.date,
    batch: int,
) -> dict[str, int]:
    """One round of asking carrier E: worklist, requests, answers, refreshed history, dead letters.

    ``root`` is the stored history (``sources.history``, key ``awb_number``). ``ask`` gets the requests
    (``mode``, ``chunk``, ``awbs``: up to 50 keys each) and gives back the answers (``awb``,
    ``body``). What can't be used, and keys without an answer (``no_answer``), go to the dead
    letters of this batch. Returns what was asked, refreshed and lost, counted on the way; a round
    that is repeated with its batch number changes nothing.
    """
    spark = recent.sparkSession
    stored = history.read_history(spark, root)
    keys = stage_table(tracking.tracking_worklist(recent, stored, "awb_number"), "worklist")
    docs = stage_table(ask(tracking.request_batches(keys)), "answers")
    rows = stage_table(answers.package_rows(docs, as_of).drop("package", "unreadable"), "packages")
    history.refresh(rows, root, "awb_number", batch)
    lost = unanswered_keys(keys, rows, "awb_number").select(
        F.col("awb_no").alias("awb"), F.lit(None).cast("int").alias("place"), F.lit(NO_ANSWER).alias("reason")
    )
    counts = write_counted(
        answers.dead_letters(docs).unionByName(lost),
        lambda df: append_batch(df, letters, batch),
        {"n_unanswered": F.col("reason") == NO_ANSWER},
    )
    return {"n_asked": keys.count(), "n_refreshed": rows.count(), "n_letters": counts["n_rows"], "n_unanswered": counts["n_unanswered"]}


def unanswered_keys(worklist: DataFrame, answered: DataFrame, key: str) -> DataFrame:
    """Keys that were asked for and did not come back."""
    return (
        key_presence({"asked": (worklist, "awb_no", {}), "answered": (answered, key, {})})
        .where("n_asked > 0 and n_answered = 0")
        .select(F.col("key").alias("awb_no"))
    )
