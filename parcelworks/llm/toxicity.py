"""Linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelworks.llm import kernel
from parcelworks.session import stage_table

U = np.uint64
_FEATURE_BITS = 20
FEATURES = 1 << _FEATURE_BITS
_SLICES = 16
#: The labelled rows, of bounded number, are read by at most so many tasks.
_TASKS = 24
#: Sums over rows are of multiples of these, so exact: they do not depend on the rows' order.
_ERROR_UNIT, _LOSS_UNIT = 2.0**-32, 2.0**-26
_HISTORY = 10


@dataclass
class Model:
    """One weight per hashed n-gram (0: not looked at) and a bias; ``sizes`` are n-gram lengths."""

    sizes: tuple[int, ...]
    weights: np.ndarray
    bias: float


def _grams(data: np.ndarray, offs: np.ndarray, sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: the feature at every position, and whether it lies in one text."""
    sums = kernel.prefix(kernel.BYTE_CODES[kernel.LOWER[data]])
    borders = offs[1:-1]
    for n in sizes:
        feature = (kernel.window_hash(sums, n) >> U(64 - _FEATURE_BITS)).astype(np.int64)
        inside = np.ones(len(feature), dtype=bool)
        for back in range(1, n):
            at = borders - back
            inside[at[(at >= 0) & (at < len(inside))]] = False
        yield feature, inside


def present(column: pa.Array, sizes: tuple[int, ...], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs, row by row; only features flagged in ``wanted``."""
    data, offs = kernel.flat(column)
    kept = []
    for feature, inside in _grams(data, offs, sizes):
        at = np.flatnonzero(inside & wanted[feature])
        kept.append((feature[at], np.searchsorted(at, offs).tolist()))
    # Of equal features in a row the one that wrote its place last stays; nothing is sorted.
    place, last = np.arange(sum(len(f) for f, _ in kept), dtype=np.int32), np.zeros(FEATURES, dtype=np.int32)
    found, count = [np.zeros(0, dtype=np.int64)], []
    for r in range(len(column)):
        mine = np.concatenate([f[cuts[r] : cuts[r + 1]] for f, cuts in kept])
        last[mine] = place[: len(mine)]
        found.append(mine[last[mine] == place[: len(mine)]])
        count.append(len(found[-1]))
    return np.repeat(np.arange(len(column)), count), np.concatenate(found)


def held(column: pa.Array, sizes: tuple[int, ...]) -> Iterator[np.ndarray]:
    """For each row the distinct features it holds."""
    data, offs = kernel.flat(column)
    grams = [(feature.astype(np.int32), n) for (feature, _), n in zip(_grams(data, offs, sizes), sizes, strict=True)]
    seen = np.zeros(FEATURES, dtype=bool)
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        for feature, n in grams:
            seen[feature[a : max(a, b - n + 1)]] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        yield found


def _class_counts(rows: DataFrame, sizes: tuple[int, ...], batch_bytes: int) -> np.ndarray:
    """How many texts of each class hold each feature, [class, feature]."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, FEATURES), dtype=np.int32)
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            for a, b in kernel.slices(kernel.flat(batch.column("text"))[1], batch_bytes):
                for kind, found in zip(label[a:b].tolist(), held(batch.column("text").slice(a, b - a), sizes), strict=True):
                    sums[kind, found] += 1
        parts = sums.reshape(2, _SLICES, -1)
        raw = [parts[:, i].tobytes() for i in range(_SLICES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(_SLICES), pa.int32()), pa.array(raw, pa.binary())], names=["slice", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int32) for x in table["sums"].to_pylist())
        return pa.table({"slice": table["slice"][:1], "sums": pa.array([total.tobytes()], pa.binary())})

    kinds = "slice int, sums binary"
    got = rows.mapInArrow(count, kinds).groupBy("slice").applyInArrow(add, kinds).collect()
    out = np.zeros((2, _SLICES, FEATURES // _SLICES), dtype=np.int64)
    for r in got:
        out[:, r["slice"]] = np.frombuffer(r["sums"], np.int32).reshape(2, -1)
    return out.reshape(2, FEATURES)


def _sparse_rows(rows: DataFrame, sizes: tuple[int, ...], best: np.ndarray, batch_bytes: int) -> DataFrame:
    """The label of each text and the places in ``best`` of the features it holds."""
    sent = rows.sparkSession.sparkContext.broadcast(best)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.zeros(FEATURES, dtype=np.int32)
        place[sent.value] = np.arange(len(sent.value))
        mine = np.zeros(FEATURES, dtype=bool)
        mine[sent.value] = True
        for batch in batches:
            for a, b in kernel.slices(kernel.flat(batch.column("text"))[1], batch_bytes):
                part = batch.slice(a, b - a)
                row, feature = present(part.column("text"), sizes, mine)
                cuts = np.searchsorted(row, np.arange(b - a + 1))
                raw = [place[feature[x:y]].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(raw, pa.binary())], names=["label", "places"])

    return rows.mapInArrow(run, "label int, places binary")


def _loss(rows: DataFrame, value: np.ndarray, penalty: float, n: int) -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
    """The loss and its gradient at a point (a factor per feature, then the bias), summed by task."""
    context, width = rows.sparkSession.sparkContext, len(value)

    def at(point: np.ndarray) -> tuple[float, np.ndarray]:
        sent = context.broadcast(np.append(point[:-1] * value, point[-1]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weight, loss, sums = sent.value, 0.0, np.zeros(width + 1)
            for batch in batches:
                for label, raw in zip(batch.column("label").to_pylist(), batch.column("places"), strict=True):
                    held = np.frombuffer(raw.as_buffer(), np.int32)
                    total = weight[held].sum() + weight[-1]
                    loss += np.rint((np.logaddexp(0, total) - label * total) / _LOSS_UNIT) * _LOSS_UNIT
                    error = np.rint((0.5 + 0.5 * np.tanh(total / 2) - label) / _ERROR_UNIT) * _ERROR_UNIT
                    sums[held] += error
                    sums[-1] += error
            yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([sums.tobytes()], pa.binary())], names=["loss", "sums"])

        got = rows.mapInArrow(run, "loss double, sums binary").collect()
        sent.unpersist()
        slope = sum(np.frombuffer(r["sums"]) for r in got) / n
        slope[:-1] = slope[:-1] * value + penalty * point[:-1]
        return sum(r["loss"] for r in got) / n + penalty / 2 * float(point[:-1] @ point[:-1]), slope

    return at


def _least(at: Callable[[np.ndarray], tuple[float, np.ndarray]], point: np.ndarray, passes: int, flat: float) -> np.ndarray:
    """The point of least loss by limited-memory BFGS, in at most ``passes`` evaluations."""
    loss, slope = at(point)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    size, left = 1.0 / max(1.0, float(np.linalg.norm(slope))), passes - 1
    while left and np.abs(slope).max() > flat:
        way, factors = -slope, []
        for moved, turned in reversed(past):
            factors.append((moved @ way) / (moved @ turned))
            way = way - factors[-1] * turned
        if past:
            moved, turned = past[-1]
            way = way * ((moved @ turned) / (turned @ turned))
        for (moved, turned), factor in zip(past, reversed(factors), strict=True):
            way = way + (factor - (turned @ way) / (moved @ turned)) * moved
        fall, found = float(way @ slope), False
        while left and not found:
            new = point + size * way
            new_loss, new_slope = at(new)
            left -= 1
            found = new_loss <= loss + 1e-4 * size * fall
            size /= 2
        if not found:
            break
        moved, turned = new - point, new_slope - slope
        if moved @ turned > 0:
            past = [*past, (moved, turned)][-_HISTORY:]
        point, loss, slope, size = new, new_loss, new_slope, 1.0
    return point


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    sizes: tuple[int, ...] = (3, 4, 5, 6),
    most_rows: int = 20_000,
    surest: float = 2.0,
    penalty: float = 1e-4,
    passes: int = 80,
    flat: float = 1e-5,
    doc_id: str = "doc_id",
    text: str = "text",
    batch_bytes: int = 1 << 19,
) -> Model:
    """Fit on at most ``most_rows`` labelled documents, picked by a hash of the id.

    The ratio of a feature is the logarithm of how much more often texts of label 1 hold
    it. Every feature whose ratio is more than ``surest`` times its standard error, and that
    two texts hold, enters the regression, however many they are; ratios near that level
    count less. Spark sums the gradients over the rows, in at most ``passes`` passes. Labels other than 0 and 1 and null ids are left out; of
    several labels of an id the largest counts. Without rows of both classes the model
    gives every text the share of label 1.
    """
    given = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    given = given.groupBy("id").agg(F.max("label").alias("label")).where("id is not null")
    sample = given.orderBy(F.xxhash64("id"), "id").limit(most_rows)
    # At most ``most_rows`` narrow rows, so safe to send everywhere.
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")
    rows = stage_table(rows.select("text", "label"), "labelled").coalesce(_TASKS)
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 or not n1:
        return Model(sizes, np.zeros(FEATURES), float(np.log((n1 + 1) / (n0 + 1))))
    counts = _class_counts(rows, sizes, batch_bytes)
    ratio = np.log((counts[1] + 1) / (n1 + 2)) - np.log((counts[0] + 1) / (n0 + 2))
    sure = np.abs(ratio) / np.sqrt(1 / (counts[1] + 1) + 1 / (counts[0] + 1))
    best = np.flatnonzero((sure > surest) & (counts.sum(axis=0) >= 2))
    # Thousands of ratios pass the level by chance, just above it, and long texts hold many of them.
    value = ratio[best] * (1 - (surest / sure[best]) ** 2) ** 2
    held_rows = stage_table(_sparse_rows(rows, sizes, best, batch_bytes), "places").coalesce(_TASKS)
    start = np.append(np.zeros(len(best)), np.log((n1 + 1) / (n0 + 1)))
    point = _least(_loss(held_rows, value, penalty, n0 + n1), start, passes, flat)
    weights = np.zeros(FEATURES)
    weights[best] = point[:-1] * value
    return Model(sizes, weights, float(point[-1]))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score", batch_bytes: int = 1 << 19) -> DataFrame:
    """Add ``out``, 0 to 1, higher where label 1 is likelier; it looks at the whole text alone.

    Null and empty texts, and texts shorter than every n-gram, get the bias alone. An
    input column named ``out`` is replaced; equal texts get equal scores.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != out])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = sent.value
        wanted = mine.weights != 0
        for batch in batches:
            for a, b in kernel.slices(kernel.flat(batch.column(text))[1], batch_bytes):
                part = batch.slice(a, b - a)
                row, feature = present(part.column(text), mine.sizes, wanted)
                total = np.bincount(row, mine.weights[feature], b - a) + mine.bias
                value = pa.array(1 / (1 + np.exp(-np.clip(total, -700, 700))))
                yield pa.RecordBatch.from_arrays([*part.columns, value], names=[*batch.schema.names, out])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields)
    return docs.mapInArrow(run, kinds + f"`{out}` double")
