"""Upserts of a refreshed table into its history.

Only keys of the refresh decide which rows stay, so a small refresh is sent to the
history, as its measured size allows, and the history is not shuffled. Rows without a
key match nothing and always stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelworks.operators.carriers import COMPLETED
from parcelworks.operators.keyed import anti_join


def _keys(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).select(key).distinct()


def upsert_replace(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All new rows, and the old rows whose key is not among them."""
    return anti_join(old, _keys(new, key), key).unionByName(new, allowMissingColumns=True)


def upsert_freeze_completed(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Renew keys that still have an open old row, add unknown keys, keep finished ones.

    Renewing a key drops every old row of it, finished rows included.
    """
    is_open = F.coalesce(F.col("mapped_status") != COMPLETED, F.lit(True))
    asked = old.select(key, is_open.alias("__open")).join(_keys(new, key), key, "left_semi")
    known = asked.groupBy(key).agg(F.max("__open").alias("__open"))
    stays = anti_join(old, known.where("__open"), key)
    added = anti_join(new, known.where("not __open"), key)
    return stays.unionByName(added, allowMissingColumns=True)
