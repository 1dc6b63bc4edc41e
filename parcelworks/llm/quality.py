"""Regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelworks.llm import kernel
from parcelworks.llm.names import sets_aside
from parcelworks.session import stage_table

U = np.uint64
_UPPER = kernel.byte_set((0x41, 0x5A))
_DIGIT = kernel.byte_set((0x30, 0x39))
_ASCII_LETTER = kernel.byte_set((0x41, 0x5A), (0x61, 0x7A))
_HIGH = kernel.byte_set((0x80, 0xFF))
_STOP = kernel.byte_set((0x2E, 0x2E), (0x2C, 0x2C))
_SYMBOL = kernel.byte_set((0x21, 0x2B), (0x2D, 0x2D), (0x2F, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_LINE = kernel.byte_set((0x0A, 0x0A))

#: Names of the statistics, in the order of the feature array.
STATISTICS = (
    "bytes", "words", "word_length", "word_length_spread", "upper", "digits", "high_bytes", "stops", "symbols",
    "lines", "distinct_words", "distinct_pairs", "repeated_neighbours", "distinct_lines", "line_length_spread",
)


def _distinct(keys: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """How many distinct keys each row has."""
    order = np.lexsort((keys, row))
    k, r = keys[order], row[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
    return np.bincount(r[new], minlength=rows)


def _spread(values: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of the values of each row."""
    n = np.maximum(np.bincount(row, minlength=rows), 1)
    mean = np.bincount(row, values, rows) / n
    return mean, np.sqrt(np.maximum(np.bincount(row, values * values, rows) / n - mean * mean, 0))


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text: logarithms of sizes, of shares and of spreads."""
    data, offs = kernel.flat(column)
    rows = len(offs) - 1
    size = np.diff(offs).astype(float)
    start, end, row = kernel.words(data, offs, kernel.WHITE)
    hashes = kernel.word_hashes(data, start, end)
    words = np.bincount(row, minlength=rows).astype(float)
    mean, spread = _spread((end - start).astype(float), row, rows)
    pair = hashes[:-1] * U(3) + hashes[1:]
    same_row = row[1:] == row[:-1]
    pairs = np.maximum(np.bincount(row[1:][same_row], minlength=rows), 1)
    repeats = np.bincount(row[1:][same_row & (hashes[1:] == hashes[:-1])], minlength=rows)
    line_start, line_end, line_row = kernel.words(data, offs, _LINE)
    lines = np.maximum(np.bincount(line_row, minlength=rows), 1)
    _, line_spread = _spread(np.log1p((line_end - line_start).astype(float)), line_row, rows)

    def share(table: np.ndarray) -> np.ndarray:
        return np.log(kernel.per_row(table[data], offs) / np.maximum(size, 1) + 1e-3)

    some = np.maximum(words, 1)
    return np.column_stack(
        [
            np.log1p(size),
            np.log1p(words),
            np.log1p(mean),
            np.log1p(spread),
            share(_UPPER),
            share(_DIGIT),
            share(_HIGH),
            share(_STOP),
            share(_SYMBOL),
            np.log((lines - 1) / some + 1e-3),
            np.log(_distinct(hashes, row, rows) / some + 1e-3),
            np.log(_distinct(pair[same_row], row[1:][same_row], rows) / pairs + 1e-3),
            np.log(repeats / pairs + 1e-3),
            np.log(_distinct(kernel.word_hashes(data, line_start, line_end), line_row, rows) / lines + 1e-3),
            line_spread,
        ]
    )


@dataclass
class Model:
    """Means, inverse Cholesky factors and log weights of both classes (``None``: one class alone)."""

    means: np.ndarray | None
    factors: np.ndarray | None
    offsets: np.ndarray | None
    constant: float

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probability of label 1 by the difference of both log densities."""
        if self.means is None:
            return np.full(len(features), self.constant)
        logs = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets, strict=True):
            z = (features - mean) @ factor.T
            logs.append(offset - 0.5 * (z * z).sum(axis=1))
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -700, 700)))


def features(docs: DataFrame, text: str = "text", out: str = "features", batch_bytes: int = 2 << 20) -> DataFrame:
    """Replace ``text`` by the array ``out`` of its statistics; null counts as empty."""
    keep = [c for c in docs.columns if c not in (text, out)]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("__text")
            for a, b in kernel.slices(kernel.flat(column)[1], batch_bytes):
                values = statistics(column.slice(a, b - a))
                offs = pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32())
                part = batch.slice(a, b - a).select(keep)
                found = pa.ListArray.from_arrays(offs, pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*keep, out])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields if f.name != "__text")
    return docs.mapInArrow(run, kinds + f"`{out}` array<double>")


_STEPS = 1024


def _moments(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per class the sum of outer products of (1, features); summed by Spark.

    Features count in steps of 1/1024, so that all sums are whole numbers of steps, and the
    same whatever order rows come in.
    """
    width = len(STATISTICS) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, width, width))
        for batch in batches:
            flat = pc.list_flatten(batch.column("features")).to_numpy(zero_copy_only=False)
            x = np.column_stack([np.ones(batch.num_rows), flat.reshape(batch.num_rows, -1)])
            x = np.rint(x * _STEPS) / _STEPS
            label = batch.column("label").to_numpy(zero_copy_only=False)
            for kind in (0, 1):
                sums[kind] += x[label == kind].T @ x[label == kind]
        cell = np.arange(2 * width * width)
        steps = np.rint(sums.ravel() * _STEPS**2).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(steps)], names=["cell", "value"])

    got = rows.mapInArrow(run, "cell int, value bigint").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(2 * width * width)
    for r in got:
        out[r["cell"]] = r["value"] / _STEPS**2
    return dict(enumerate(out.reshape(2, width, width)))


def train(
    measured: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    shrink_pooled: float = 0.1,
    shrink_diagonal: float = 0.02,
    doc_id: str = "doc_id",
) -> Model:
    """Fit on every labelled row of ``measured`` (ids and ``features``).

    Each class covariance is drawn towards the pooled one, then towards its own diagonal;
    the Cholesky factor of each is inverted once and kept. Labels other than 0 and 1 and
    null ids are left out; of several labels of an id the largest counts. Without two rows
    of each class every text gets the share of label 1.
    """
    given = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    given = given.groupBy("id").agg(F.max("label").alias("label"))
    rows = measured.select(F.col(doc_id).alias("id"), "features").join(given, "id").select("features", "label")
    sums = _moments(rows)
    count = np.array([sums[0][0, 0], sums[1][0, 0]])
    if count.min() < 2:
        return Model(None, None, None, float((count[1] + 1) / (count.sum() + 2)))
    means = np.array([sums[k][0, 1:] / count[k] for k in (0, 1)])
    spreads = [sums[k][1:, 1:] / count[k] - np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = (count[0] * spreads[0] + count[1] * spreads[1]) / count.sum()
    floor = 1e-6 * np.diag(np.diag(pooled) + 1e-6)
    factors, offsets = [], []
    for k in (0, 1):
        cov = (1 - shrink_pooled) * spreads[k] + shrink_pooled * pooled
        cov = (1 - shrink_diagonal) * cov + shrink_diagonal * np.diag(np.diag(cov)) + floor
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        offsets.append(np.log(count[k] / count.sum()) - np.log(np.diag(lower)).sum())
    return Model(means, np.array(factors), np.array(offsets), 0.5)


def score(measured: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """Replace ``features`` by ``out``: 0 to 1, higher where label 1 is likelier.

    Empty and null texts have statistics like any other (no bytes, no words).
    """
    keep = [c for c in measured.columns if c not in ("features", out)]
    measured = measured.select(*[F.col(f"`{c}`") for c in keep], "features")
    sent = measured.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = pc.list_flatten(batch.column("features")).to_numpy(zero_copy_only=False)
                value = sent.value.score(flat.reshape(batch.num_rows, -1))
                part = batch.select(keep)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(value)], names=[*keep, out])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in measured.schema.fields if f.name != "features")
    return measured.mapInArrow(run, kinds + f"`{out}` double")


@sets_aside("__text", "features")
def fit_and_score(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``score`` for all documents by a model of the labelled ones; texts are read once.

    Columns of ``docs`` other than ``text`` stay, but for one named ``score``. Null and empty
    texts, and very long ones, are scored by their statistics like any other. A row whose id
    occurs twice trains once for each of its rows, and each is scored; rows without an id are
    scored only. Without documents the result is empty; without two labelled rows of each kind
    every text gets the share of label 1.
    """
    measured = stage_table(features(docs, text), "features")
    return score(measured, train(measured, labels, label, doc_id=doc_id))
