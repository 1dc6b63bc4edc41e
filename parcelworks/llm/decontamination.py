"""Benchmark passages in documents, found by multi-pattern search over words.

Every window of 13 words of a benchmark item is a pattern; an item of fewer words is
one pattern. Per pattern length a shift table, addressed by the hash of a block of two
words, says how far a scan may jump; where it may not, the block's bucket names the
patterns that end with it, and words are compared one by one. All texts of a batch are
scanned side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelworks.llm import blocks, kernel
from parcelworks.session import stage_table

U = np.uint64
_TABLE = 1 << 18
_SEGMENT = 256
_PAIRS = 1 << 20


def _word_codes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the 128-bit hash of each lower-cased word, and its row."""
    data = kernel.LOWER[data]
    start, end, row = kernel.words(data, offs, kernel.NOT_ALNUM)
    return kernel.word_hashes(data, start, end, bits=128), row


def _block(codes: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` (1 or 2) words that end at each position."""
    return codes[last] if size == 1 else kernel.mix(codes[last - 1] * U(3) + codes[last])


class Patterns:
    """Patterns of one length with their shift table and suffix buckets.

    ``windows`` and ``seconds`` hold the two halves of the words' hashes: the first is searched
    for, both are compared.
    """

    def __init__(self, windows: np.ndarray, seconds: np.ndarray, items: list[np.ndarray]) -> None:
        n, self.length = windows.shape
        self.size = min(2, self.length)
        flat = np.ascontiguousarray(windows).ravel()
        base = np.arange(n) * self.length
        self.shift = np.full(_TABLE, self.length - self.size + 1, dtype=np.uint8 if self.length < 256 else np.int64)
        for j in range(self.size - 1, self.length):
            at = (_block(flat, base + j, self.size) % U(_TABLE)).astype(np.int64)
            np.minimum.at(self.shift, at, self.length - 1 - j)
        suffix = _block(flat, base + self.length - 1, self.size)
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.windows, self.seconds = suffix[order], windows[order], seconds[order]
        self.prefix = _block(np.ascontiguousarray(self.windows).ravel(), base + self.size - 1, self.size)
        self.items = [items[i] for i in order.tolist()]
        self.item_count = np.array([len(i) for i in self.items], dtype=np.int64)
        self.item_start = np.concatenate([[0], np.cumsum(self.item_count)[:-1]])
        self.item_all = np.concatenate(self.items) if self.items else np.zeros(0, np.int64)

    def stops(self, codes: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Positions whose block may end a pattern; the others are jumped over."""
        first = self.length - 1
        if len(codes) <= first:
            return np.zeros(0, np.int64)
        at = np.arange(first, len(codes), _SEGMENT)
        limit = np.minimum(at + _SEGMENT, len(codes))
        found = []
        while len(at):
            step = self.shift[(_block(codes, at, self.size) % U(_TABLE)).astype(np.int64)].astype(np.int64)
            hit = step == 0
            found.append(at[hit])
            at = at + np.maximum(step, 1)
            go = at < limit
            at, limit = at[go], limit[go]
        at = np.concatenate(found)
        return at[row[at] == row[at - first]]

    def occurrences(self, both: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and pattern of every occurrence."""
        codes, seconds = both
        at = self.stops(codes, row)
        ends = _block(codes, at, self.size)
        lo, hi = np.searchsorted(self.suffix, ends, "left"), np.searchsorted(self.suffix, ends, "right")
        at, lo, count = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        starts, patterns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        sums = np.concatenate([[0], np.cumsum(count)])
        for a, b in kernel.slices(sums, _PAIRS):
            where = np.repeat(at[a:b], count[a:b]) - (self.length - 1)
            which = np.repeat(lo[a:b], count[a:b]) + np.arange(sums[b] - sums[a]) - np.repeat(sums[a:b] - sums[a], count[a:b])
            same = self.prefix[which] == _block(codes, where + self.size - 1, self.size)
            where, which = where[same], which[same]
            for j in range(self.length):
                same = (codes[where + j] == self.windows[which, j]) & (seconds[where + j] == self.seconds[which, j])
                where, which = where[same], which[same]
            starts.append(where)
            patterns.append(which)
        return np.concatenate(starts), np.concatenate(patterns)


def build_patterns(texts: list[str], width: int) -> list[Patterns]:
    """Patterns of all lengths; each names its items by their place in ``texts``."""
    data, offs = kernel.flat(pa.array(texts, pa.string()))
    codes, row = _word_codes(data, offs)
    bounds = np.searchsorted(row, np.arange(len(texts) + 1))
    found: dict[bytes, set[int]] = {}
    for item, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        size = min(width, b - a)
        for i in range(a, b - size + 1) if size else ():
            found.setdefault(codes[:, i : i + size].tobytes(), set()).add(item)
    by_length: dict[int, list[bytes]] = {}
    for key in found:
        by_length.setdefault(len(key) // 16, []).append(key)
    return [
        Patterns(
            *np.frombuffer(b"".join(keys), U).reshape(-1, 2, length).swapaxes(0, 1),
            [np.array(sorted(found[k]), dtype=np.int64) for k in keys],
        )
        for length, keys in sorted(by_length.items())
    ]


def search(column: pa.Array, patterns: list[Patterns]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word bounds per row, flags of hit words, and (row, item) pairs in order."""
    data, offs = kernel.flat(column)
    codes, row = _word_codes(data, offs)
    rows = len(offs) - 1
    hit = np.zeros(codes.shape[1], dtype=bool)
    pairs = [np.zeros((0, 2), np.int64)]
    for p in patterns:
        start, which = p.occurrences(codes, row)
        hit |= kernel.covered(np.unique(start), p.length, len(hit))
        count = p.item_count[which]
        sums = np.concatenate([[0], np.cumsum(count)])
        item = p.item_all[np.repeat(p.item_start[which], count) + np.arange(sums[-1]) - np.repeat(sums[:-1], count)]
        pairs.append(np.unique(np.stack([np.repeat(row[start], count), item], axis=1), axis=0))
    return np.searchsorted(row, np.arange(rows + 1)), hit, *np.unique(np.concatenate(pairs), axis=0).T


def _spans(hit: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of hit words per row, as [first word, word after the last]."""
    edge = np.zeros(len(hit) + 1, dtype=bool)
    edge[bounds] = True
    before = np.append(False, hit)[:-1]
    begin = np.flatnonzero(hit & (~before | edge[:-1]))
    after = np.append(hit, False)[1:]
    end = np.flatnonzero(hit & (~after | edge[1:])) + 1
    offs = np.searchsorted(begin, bounds)
    base = np.repeat(bounds[:-1], np.diff(offs))
    pair = pa.StructArray.from_arrays([pa.array(begin - base), pa.array(end - base)], ["first_word", "end_word"])
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pair)


def _flags(spans: pa.ListArray, bounds: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words lie in the spans that were found in earlier scans."""
    offs = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False))])
    flat = pc.list_flatten(spans)
    base = np.repeat(bounds[:-1], np.diff(offs))
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, base + flat.field("first_word").to_numpy(), 1)
    np.add.at(steps, base + flat.field("end_word").to_numpy(), -1)
    return np.cumsum(steps[:-1]) > 0


def _scan(docs: DataFrame, names: list[str], texts: list[str], width: int, text: str, batch_bytes: int) -> DataFrame:
    """``n_words``, ``hit_spans`` and ``items`` for one block of items, on top of those of the blocks before."""
    tables = docs.sparkSession.sparkContext.broadcast((np.array(names, dtype=object), build_patterns(texts, width)))
    own = [c for c in docs.columns if c not in _FOUND]
    before = own != docs.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, patterns = tables.value
        for batch in batches:
            column = batch.column(text)
            for a, b in kernel.slices(kernel.flat(column)[1], batch_bytes):
                part = batch.slice(a, b - a)
                bounds, hit, row, item = search(part.column(text), patterns)
                offs = np.searchsorted(row, np.arange(b - a + 1))
                found = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(ids[item], pa.string()))
                if before:
                    hit |= _flags(part.column("hit_spans"), bounds, len(hit))
                    both = zip(part.column("items").to_pylist(), found.to_pylist(), strict=True)
                    found = pa.array([x + y for x, y in both], pa.list_(pa.string()))
                extra = [pa.array(np.diff(bounds)), _spans(hit, bounds), found]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), *extra], names=[*own, *_FOUND])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in own)
    return docs.mapInArrow(
        scan, f"{kinds}, n_words long, hit_spans array<struct<first_word:long,end_word:long>>, items array<string>"
    )


_FOUND = ["n_words", "hit_spans", "items"]
_N_HIT = "aggregate(hit_spans, 0L, (n, s) -> n + s.end_word - s.first_word)"


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    width: int = 13,
    share: int = 20,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    batch_bytes: int = 8 << 20,
    item_block_bytes: int = 16 << 20,
) -> DataFrame:
    """Words of documents that lie in an occurrence of a benchmark window.

    Adds ``n_words``, ``hit_spans`` (runs of hit words), ``n_hit``, ``items`` (ids, as
    text, of items with an occurring window, sorted), ``n_items`` and ``contaminated``
    (some word is hit, and at least one in ``share`` words).

    Null and empty texts have no words; an item without words or with a null id has no
    window. Items that share an id count once; equal windows of several items count for
    each. Repeated documents are judged alike; rows keep all their columns but those named
    like an added one. An empty table on either side gives no hits.

    Tables for about ``item_block_bytes`` of item texts are made and broadcast at a time. More
    items are taken in blocks, one after the other: documents are scanned for each, and are
    written with what was found so far, so that every row keeps its own.
    """
    added = ["n_words", "hit_spans", "n_hit", "items", "n_items", "contaminated"]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    columns = docs.columns
    items = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("words")).where(
        "id is not null and words is not null"
    )
    parts = blocks.block_count(blocks.text_bytes(items, "words"), item_block_bytes)
    found = docs
    for k in range(parts):
        mine = items if parts == 1 else items.where(F.pmod(F.xxhash64("id", "words"), F.lit(parts)) == k)
        rows = mine.collect()
        found = _scan(found, [r["id"] for r in rows], [r["words"] for r in rows], width, text, batch_bytes)
        if k + 1 < parts:
            found = stage_table(found, "scanned")
    found = found.withColumn("items", F.array_sort(F.array_distinct("items"))).withColumn("n_hit", F.expr(_N_HIT))
    return found.select(
        *[F.col(f"`{c}`") for c in columns],
        "n_words",
        "hit_spans",
        "n_hit",
        "items",
        F.size("items").cast("long").alias("n_items"),
        F.expr(f"n_hit > 0 and {int(share)} * n_hit >= n_words").alias("contaminated"),
    )
