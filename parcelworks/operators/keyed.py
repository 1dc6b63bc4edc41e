"""Joins and per-key statistics that survive hot and missing keys.

Keys are text. Rows with a null key get a join key of their own, made from their
content, so they spread over all tasks and match nothing. Statistics of a key are
combined before the shuffle and joined back; adaptive execution splits a hot key of
such a join, so no group ever has to fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNMATCHED = "\u0000"


def scattered(df: DataFrame, spread: list[str] | None = None) -> Column:
    """A key that differs from row to row and equals no real key.

    Taken from the row's content (by default all of it), never from a random
    number, so that a task run again sends its rows to the same places.
    """
    names = spread or [f.name for f in df.schema.fields if f.dataType.typeName() != "map"]
    return F.concat(F.lit(_UNMATCHED), F.xxhash64(*[F.col(f"`{n}`") for n in names]).cast("string"))


def left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread: list[str] | None = None,
) -> DataFrame:
    """Left join on one text key; rows with a null key are spread, not gathered.

    Duplicates on the right fan out. Whether the right side is broadcast is left
    to its measured size. ``spread`` names columns that differ between rows.
    """
    keyed = left.withColumn("__jk", F.coalesce(F.col(left_key), scattered(left, spread)))
    return keyed.join(right, keyed["__jk"] == right[right_key], "left").drop("__jk")


def group_stats(
    df: DataFrame, key: str, aggs: dict[str, Column], spread: list[str] | None = None
) -> DataFrame:
    """Every row plus aggregates of its key; null keys get null aggregates.

    The meaning of ``agg over (partition by key)``. ``df`` is read twice, so stage it first
    if it is the result of joins.
    """
    names = list(aggs)
    stats = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("__gk"))
        .agg(*[expr.alias("__s_" + n) for n, expr in aggs.items()])
    )
    joined = left_join(df, stats, key, "__gk", spread)
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in names],
        *[F.col("__s_" + n).alias(n) for n in names],
    )


def lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    values: list[str],
    spread: list[str] | None = None,
) -> DataFrame:
    """Add ``values`` of the right side; a key it holds twice fans out, a missing one gives null."""
    wanted = right.select(
        F.col(right_key).alias("__rk"), *[F.col(v).alias("__s_" + v) for v in values]
    )
    joined = left_join(left, wanted, left_key, "__rk", spread)
    return joined.select(
        *[F.col(f"`{c}`") for c in left.columns if c not in values],
        *[F.col("__s_" + v).alias(v) for v in values],
    )


def anti_join(left: DataFrame, right: DataFrame, key: str, spread: list[str] | None = None) -> DataFrame:
    """Rows of ``left`` whose key ``right`` lacks; rows with a null key stay, and are spread."""
    keyed = left.withColumn("__jk", F.coalesce(F.col(key), scattered(left, spread)))
    gone = right.select(F.col(key).alias("__gk"))
    return keyed.join(gone, F.col("__jk") == F.col("__gk"), "left_anti").drop("__jk")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where("n_rows > 1")
    )


def last_by_key(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """One row per key with the value of its last row in ``order``."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max_by(value, F.struct(*order)).alias(value))
    )


def key_presence(parts: dict[str, tuple[DataFrame, str, dict[str, Column]]]) -> DataFrame:
    """One row per key found in any part, with sums per part; null keys are left out.

    ``parts`` maps a name to (rows, key column, {measure: 0/1 expression}). Every
    measure, and the row count under the part's name, becomes a column holding 0
    where the part lacks the key. Union, intersection and difference of key sets
    are then filters on one map-side combined aggregate instead of several joins.
    """
    measures = {name: ["n_" + name, *extra] for name, (_, _, extra) in parts.items()}
    every = [m for names in measures.values() for m in names]
    tagged = None
    for name, (rows, key, extra) in parts.items():
        own = {"n_" + name: F.lit(1), **extra}
        part = rows.where(F.col(key).isNotNull()).select(
            F.col(key).cast("string").alias("key"),
            *[own.get(m, F.lit(0)).cast("bigint").alias(m) for m in every],
        )
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy("key").agg(*[F.sum(m).alias(m) for m in every])


def small_map(df: DataFrame, column: str, values: dict[str, str], out: str) -> DataFrame:
    """Add ``out`` from a table written out in the program, whose size is thus fixed."""

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    rows = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in values.items())
    dim = df.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(__k, `{out}`)")
    return (
        df.drop(out).join(F.broadcast(dim), F.col(column) == F.col("__k"), "left").drop("__k")
    )
