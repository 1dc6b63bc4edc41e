"""A training mix of sources whose weights change over the training time.

Every source has a schedule: its weight at each point of the training time, from 0 to 1.
The schedule's integral is the source's share of all words to train on. Documents of a
source lie end to end in an order of their own (a hash of the id), copy after copy, until
the source's demand is met. A document's training position is the time at which the
source's cumulative demand reaches its first word: the inverse of the schedule's integral.
Sorting by position gives the training order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelworks.llm.names import unused

#: (time, weight) from time 0 to time 1; the weight is linear in between.
Schedule = Sequence[tuple[float, float]]
#: A source's documents are summed up in two steps: within, and over, so many ranges of hashes.
_RANGE_BITS = 12
_KEY_BITS = 60
_WHOLE = "decimal(38,0)"


def _integral(schedule: Schedule) -> Fraction:
    points = [(Fraction(t), Fraction(w)) for t, w in schedule]
    times = [t for t, _ in points]
    if times[0] != 0 or times[-1] != 1 or any(a >= b for a, b in zip(times[:-1], times[1:], strict=True)):
        raise ValueError(f"a schedule goes from time 0 to time 1: {schedule}")
    if min(w for _, w in points) < 0 or max(w for _, w in points) == 0:
        raise ValueError(f"weights are not negative and not all zero: {schedule}")
    return sum((b - a) * (v + w) / 2 for (a, v), (b, w) in zip(points[:-1], points[1:], strict=True))


def whole_weights(schedules: Sequence[Schedule]) -> list[int]:
    """The integrals of the schedules as whole numbers in the same proportions."""
    shares = [_integral(s) for s in schedules]
    common = math.lcm(*[s.denominator for s in shares])
    return [int(s * common) for s in shares]


def time_of(share: Column, schedule: Schedule) -> Column:
    """When a source has had this share (0 to 1) of its words: the inverse of the integral."""
    whole = float(_integral(schedule))
    out, before = None, 0.0
    for (a, v), (b, w) in zip(schedule[:-1], schedule[1:], strict=True):
        area = float((Fraction(b) - Fraction(a)) * (Fraction(v) + Fraction(w)) / 2)
        slope = (w - v) / (b - a)
        rest = F.greatest(share * F.lit(whole) - F.lit(before), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(float(v * v)) + F.lit(2.0 * slope) * rest, F.lit(0.0)))
        passed = F.lit(2.0) * rest / F.greatest(F.lit(float(v)) + root, F.lit(1e-300))
        here = F.lit(float(a)) + F.when(rest > 0, passed).otherwise(F.lit(0.0))
        out = here if out is None else F.when(share * F.lit(whole) >= F.lit(before), here).otherwise(out)
        before += area
    return F.least(out, F.lit(1.0))


def _of_kind(kind: Column, values: Sequence[Column]) -> Column:
    out = values[-1]
    for i in range(len(values) - 2, -1, -1):
        out = F.when(kind == i, values[i]).otherwise(out)
    return out


def source_targets(sizes: DataFrame, source: str, size: str, schedules: Sequence[Schedule], percent: int, most: int) -> DataFrame:
    """``target`` and ``kind`` (which schedule) of each source of a table with one row per source.

    Sources take the schedules in turn, by code point, null last. ``percent`` of all words
    are shared out by weight; none gets more than ``most`` times its size, and what is above
    goes to the others by weight, until none is above: with sources in the order of size by
    weight, those are a prefix, so running sums find them. One task sorts the sources, not
    their documents.
    """
    weights = whole_weights(schedules)
    number, weight, cap, tried, left, full = "number", "weight", "cap", "tried", "left", "full"
    table = sizes.select(F.col(f"`{source}`").alias("source"), F.col(f"`{size}`").cast(_WHOLE).alias("size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    table = table.withColumn(number, F.row_number().over(by_name) - 1).withColumn("kind", F.col(number) % len(schedules))
    table = table.withColumn(weight, _of_kind(F.col("kind"), [F.lit(w) for w in weights]).cast(_WHOLE))
    table = table.withColumn(cap, (F.col("size") * most).cast(_WHOLE)).withColumn("words", F.sum("size").over(every).cast(_WHOLE))
    by_need = Window.orderBy(F.col("size").cast("double") / F.col(weight).cast("double"), number)
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    behind = by_need.rowsBetween(0, Window.unboundedFollowing)
    # Hundredths of words that are left for this source and those behind it.
    table = table.withColumn(tried, (F.col("words") * percent - F.coalesce(F.sum(cap).over(before), F.lit(0)) * 100).cast(_WHOLE))
    table = table.withColumn(left, F.sum(weight).over(behind).cast(_WHOLE))
    table = table.withColumn(full, (F.col(tried) * F.col(weight)).cast(_WHOLE) > (F.col(cap) * 100 * F.col(left)).cast(_WHOLE))
    rest = F.col("words") * percent - F.coalesce(F.sum(F.when(F.col(full), F.col(cap))).over(every), F.lit(0)) * 100
    open_weight = F.sum(F.when(~F.col(full), F.col(weight))).over(every)
    share = (rest * F.col(weight)).cast(_WHOLE).cast("double") / (open_weight * 100).cast(_WHOLE).cast("double")
    return table.select("source", "kind", F.when(F.col(full), F.col(cap).cast("double")).otherwise(share).alias("target"))


def mix(
    docs: DataFrame,
    schedules: Sequence[Schedule],
    percent: int = 150,
    most: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Add what the mix takes of every document, and when.

    ``size`` is the number of words (runs of other than white space), ``source_size`` that of
    the whole source, ``target`` the words that the mix wants of the source (see
    ``source_targets``), ``taken`` the words it takes of the document, repeats counted, and
    ``copies`` an array of ``words`` and ``position`` (0 to 1) for each time it is read. A source gives
    exactly its target, rounded down to whole words: the last document is cut where the
    demand ends. No document gives more than ``most`` times its size.

    Null and empty texts have size 0 and are never taken; a null source is a source of its
    own; a null id sorts by the hash of the empty string. Rows equal in id, source and size
    may swap their parts; otherwise reruns agree. All input columns stay, but for those
    named like an added one; an empty table stays empty.
    """
    added = ["size", "source_size", "target", "taken", "copies"]
    own = [c for c in docs.columns if c not in added]
    key, span, of, missing, kind, at = unused([*docs.columns, *added], "key", "span", "of", "missing", "kind", "at")
    hashed = F.md5(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary"))
    sized = docs.select(
        *[F.col(f"`{c}`") for c in own],
        F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.conv(F.substring(hashed, 1, _KEY_BITS // 4), 16, 10).cast("long").alias(key),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias(of),
        F.col(f"`{source}`").isNull().alias(missing),
    ).withColumn(span, F.shiftright(F.col(key), _KEY_BITS - _RANGE_BITS))

    # Few rows from here: words per range of hashes, and what lies before each range.
    ranges = sized.groupBy(of, missing, span).agg(F.sum("size").alias("words"))
    over = Window.partitionBy(of, missing)
    ranges = ranges.withColumn(
        at, F.coalesce(F.sum("words").over(over.orderBy(span).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("source_size", F.sum("words").over(over))
    named = F.when(~F.col(missing), F.col(of)).alias("source")
    sizes = ranges.groupBy(of, missing).agg(F.max("source_size").alias("size")).select(named, "size")
    targets = source_targets(sizes, "source", "size", schedules, percent, most).select(
        F.coalesce("source", F.lit("")).alias(of), F.col("source").isNull().alias(missing), F.col("kind").alias(kind), "target"
    )
    ranges = ranges.join(targets, [of, missing]).drop("words")

    within = Window.partitionBy(of, missing, span).orderBy(key, F.col(f"`{doc_id}`"), "size")
    placed = sized.join(ranges, [of, missing, span]).withColumn(
        at, F.col(at) + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    )
    demand = F.floor("target").cast("long")

    def copy(turn: Column) -> Column:
        start = F.col(at) + turn * F.col("source_size")
        words = F.least(demand - start, F.col("size"))
        share = start.cast("double") / F.nullif(demand.cast("double"), F.lit(0.0))
        return F.struct(words.alias("words"), _of_kind(F.col(kind), [time_of(share, s) for s in schedules]).alias("position"))

    copies = F.filter(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), copy), lambda c: c["words"] > 0)
    return placed.withColumn("copies", copies).select(
        *[F.col(f"`{c}`") for c in own],
        "size",
        "source_size",
        "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["words"]).alias("taken"),
        "copies",
    )


def by_position(mixed: DataFrame) -> DataFrame:
    """Documents range-sorted by the position of their first copy; those not taken come last."""
    return mixed.orderBy(F.get("copies", F.lit(0))["position"].asc_nulls_last(), *[F.col(c) for c in ("size", "taken")])


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per copy, range-sorted by ``position``; ``words`` says how many of its words are read."""
    named = [c for c in mixed.columns if c not in ("copies", "words", "position")]
    rows = mixed.select(*[F.col(f"`{c}`") for c in named], F.inline("copies"))
    return rows.orderBy("position", "source_size", "size")
