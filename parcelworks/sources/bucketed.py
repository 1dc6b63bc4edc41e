"""Tables stored by the hash of a key, so that joins on it need no exchange.

A bucketed table keeps, next to its columns, the key that it is joined on: the key itself, or
for rows without one a key of their own made from their content, so that these spread over
all buckets and match nothing. Two tables in equally many buckets are joined bucket by
bucket; a small refresh is sent to the buckets, and the history stays where it is.

Buckets are read by one task each, so a key must not hold more rows than a task can: a
tracking number has few lines.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelworks.operators.keyed import scattered
from parcelworks.session import shuffles_end

JOIN_KEY = "join_key"


def bucket_count(rows: int, each: int = 400_000, least: int = 8) -> int:
    """Buckets of about ``each`` rows, so that what a task reads doesn't grow with the table."""
    return max(least, math.ceil(rows / each))


def with_join_key(df: DataFrame, key: str, side: str) -> DataFrame:
    """Add the join key; ``side`` tells rows without a key of two tables apart."""
    if JOIN_KEY in df.columns:
        raise ValueError(f"the rows have a column {JOIN_KEY} already")
    return df.withColumn(JOIN_KEY, F.coalesce(F.col(key).cast("string"), F.concat(F.lit("\u0000" + side), scattered(df))))


def store_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as a table under ``path``, in buckets by ``key``, and read it from there.

    The session's catalog knows the buckets by the name ``table``; the files are those of ``path``.
    """
    keyed = with_join_key(df, key, table)
    # One task per bucket, so that each bucket is one file.
    keyed = keyed.repartition(buckets, JOIN_KEY)
    writer = keyed.write.mode("overwrite").bucketBy(buckets, JOIN_KEY).sortBy(JOIN_KEY)
    with shuffles_end(df.sparkSession):
        writer.option("path", path).option("compression", "zstd").format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def join_stored(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join two tables with join keys; the result has that of the left side."""
    theirs = right.withColumnRenamed(JOIN_KEY, "__theirs")
    return left.join(theirs, F.col(JOIN_KEY) == F.col("__theirs"), how).drop("__theirs")
