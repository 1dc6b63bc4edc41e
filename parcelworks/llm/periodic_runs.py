"""Stretches of words that repeat with a period, found by matching blocks inside a text.

Texts of a batch are suffix-sorted by doubling, so that every block of 1, 2, 4, 8 .. words
is an interval of the suffix array. A run of period q holds an aligned (dyadic) block whose
copy lies q words on. Where a block occurs in the windows of distances that its level
answers for is asked of a wavelet tree over the suffix array: range rank gives the number
of occurrences, range successor the first, second and last. In a window no longer than the
block they form an arithmetic progression; its terms are candidate periods, unless all lie
in one run of the progression's own step. Candidates are extended both ways as far as they
go, by comparing block names, so all results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelworks.llm import kernel

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Suffixes:
    """The suffix array of many short sequences, with block names of every dyadic length.

    ``names[k][i]`` is equal for two positions exactly if the same ``2**k`` values start
    there in the same row; it is the first place of their interval of the suffix array.
    """

    def __init__(self, values: np.ndarray, row: np.ndarray) -> None:
        self.n = n = len(values)
        key = row.astype(np.int64) * (int(values.max()) + 1 if n else 1) + values
        self.order = np.argsort(key, kind="stable")
        slots = np.arange(n)
        name = np.full(n + 1, -1, dtype=np.int64)
        self.names: list[np.ndarray] = []
        #: Per level the places of blocks that occur again, and the ends of their intervals.
        self.again: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        sort = key[self.order]
        size = 1
        while True:
            new = np.append(True, sort[1:] != sort[:-1])[: len(sort)]
            begin = np.flatnonzero(new)
            count = np.diff(np.append(begin, len(sort)))
            at = self.order[slots]
            name[at] = np.repeat(slots[begin], count)
            self.names.append(name.copy())
            several = np.repeat(count > 1, count)
            if not several.any():
                break
            low = np.repeat(slots[begin], count)[several]
            slots, at = slots[several], at[several]
            self.again.append((at, low, low + np.repeat(count, count)[several]))
            behind = name[np.minimum(at + size, n)]
            sort = low * (n + 2) + behind + 1
            turn = np.argsort(sort, kind="stable")
            sort = sort[turn]
            self.order[slots] = at[turn]
            size *= 2

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many values from ``i`` and from ``j`` (greater) on are the same."""
        i, j = i.copy(), j.copy()
        start = i.copy()
        for k in range(len(self.names) - 1, -1, -1):
            step = (self.names[k][i] == self.names[k][j]).astype(np.int64) << k
            i += step
            j += step
        return i - start

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many values before ``i`` and before ``j`` (greater) are the same."""
        i, j = i.copy(), j.copy()
        start = i.copy()
        for k in range(len(self.names) - 1, -1, -1):
            p = i - (1 << k)
            same = self.names[k][np.maximum(p, 0)] == self.names[k][np.maximum(j - (1 << k), 0)]
            step = (same & (p >= 0)).astype(np.int64) << k
            i -= step
            j -= step
        return start - i


class WaveletTree:
    """Rank and selection among the values of any range of a sequence, level by level of bits."""

    def __init__(self, values: np.ndarray, limit: int) -> None:
        self.bits = max(1, int(limit).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1 == 1
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]))
            values = np.concatenate([values[~one], values[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of each range are less than ``x``."""
        out = np.zeros(len(lo), dtype=np.int64)
        for bit, zeros in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            a, b = zeros[lo], zeros[hi]
            right = (x >> bit) & 1 == 1
            out += np.where(right, b - a, 0)
            lo = np.where(right, zeros[-1] + lo - a, a)
            hi = np.where(right, zeros[-1] + hi - b, b)
        return out

    def nth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value of each range that ``k`` others go before; with ``below`` the successor of any value."""
        out = np.zeros(len(lo), dtype=np.int64)
        for bit, zeros in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            a, b = zeros[lo], zeros[hi]
            right = k >= b - a
            out |= right.astype(np.int64) << bit
            k = np.where(right, k - (b - a), k)
            lo = np.where(right, zeros[-1] + lo - a, a)
            hi = np.where(right, zeros[-1] + hi - b, b)
        return out


def distances(least: int, longest: int) -> list[list[tuple[int, int]]]:
    """Per block level the windows (first, last distance) of the periods it answers for.

    A run of period q has at least ``max(least, 2q)`` words, so it holds an aligned block
    of ``2**k`` words together with its copy if ``2**(k+1) <= max(least, 2q) - q + 1``. Every
    period goes to the greatest such level; windows have at most ``2**k`` distances.
    """
    out: list[list[tuple[int, int]]] = []
    q = 1
    while 2 * q <= longest:
        room = max(least, 2 * q) - q + 1
        k = room.bit_length() - 2
        last = q
        while last - q + 1 < 1 << k and 2 * (last + 1) <= longest and (max(least, 2 * last + 2) - last).bit_length() - 2 == k:
            last += 1
        while len(out) <= k:
            out.append([])
        out[k].append((q, last))
        q = last + 1
    return out


def _progressions(found: Suffixes, least: int, longest: int) -> tuple[np.ndarray, ...]:
    """Block starts, and first place, step and number of the occurrences in a window behind."""
    windows = distances(least, longest)
    used = [k for k, w in enumerate(windows) if w and k < len(found.again)]
    none = np.zeros(0, np.int64)
    if not used:
        return none, none, none, none, none
    # Only suffixes that share a block of the lowest level asked about are in the tree.
    inside = np.zeros(found.n, dtype=bool)
    inside[found.names[-1][found.again[used[0]][0]]] = True
    places = np.flatnonzero(inside)
    compact = np.zeros(found.n, dtype=np.int64)
    compact[places] = np.arange(len(places))
    tree = WaveletTree(found.order[places], found.n)
    parts = []
    for k in used:
        at, low, high = found.again[k]
        mine = at & ((1 << k) - 1) == 0
        at, size = at[mine], (high - low)[mine]
        low = compact[low[mine]]
        high = low + size
        near = np.minimum(at + min(a for a, _ in windows[k]), found.n)
        far = np.minimum(at + max(b for _, b in windows[k]) + 1, found.n)
        any_there = tree.below(low, high, far) > tree.below(low, high, near)
        at, low, high = at[any_there], low[any_there], high[any_there]
        for a, b in windows[k]:
            before = tree.below(low, high, np.minimum(at + a, found.n))
            count = tree.below(low, high, np.minimum(at + b + 1, found.n)) - before
            some = count > 0
            i, lo, hi, before, count = (x[some] for x in (at, low, high, before, count))
            first = tree.nth(lo, hi, before)
            second = tree.nth(lo, hi, before + np.minimum(count - 1, 1))
            last = tree.nth(lo, hi, before + count - 1)
            assert ((last - first) == (second - first) * (count - 1)).all()
            parts.append((i, first, second - first, count, np.full(len(i), 1 << k)))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def find(values: np.ndarray, row: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of all runs of at least ``least`` values, by start and period."""
    none = np.zeros(0, np.int64)
    if not len(values):
        return none, none, none
    longest = int(np.bincount(row).max())
    if longest < max(least, 2):
        return none, none, none
    found = Suffixes(values, row)
    at, first, step, count, size = _progressions(found, least, longest)
    # Occurrences all in one run of their own step lie multiples of that step apart: it alone is a candidate.
    many = np.flatnonzero(count > 1)
    reach = at[many] + step[many] + found.ahead(at[many], at[many] + step[many])
    inside = np.zeros(len(at), dtype=bool)
    inside[many] = reach >= (first + step * (count - 1) + size)[many]
    first, count = np.where(inside, at + step, first), np.where(inside, 1, count)
    i = np.repeat(at, count)
    turn = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
    j = np.repeat(first, count) + turn * np.repeat(step, count)
    q = j - i
    begin = i - found.back(i, j)
    end = j + found.ahead(i, j)
    good = end - begin >= np.maximum(least, 2 * q)
    begin, end, q = begin[good], end[good], q[good]
    # A stretch found with several periods has the smallest of them.
    turn = np.lexsort((q, end, begin))
    begin, end, q = begin[turn], end[turn], q[turn]
    new = np.append(True, (begin[1:] != begin[:-1]) | (end[1:] != end[:-1]))[: len(begin)]
    begin, end, q = begin[new], end[new], q[new]
    turn = np.lexsort((q, begin))
    return begin[turn], end[turn], q[turn]


def _columns(column: pa.Array, least: int) -> list[pa.Array]:
    data, offs = kernel.flat(column)
    start, end, row = kernel.words(data, offs, kernel.WHITE)
    bounds = np.searchsorted(row, np.arange(len(offs)))
    begin, stop, period = find(kernel.word_numbers(data, start, end), row, least)
    steps = np.zeros(len(row) + 1, dtype=np.int64)
    np.add.at(steps, begin + period, 1)
    np.add.at(steps, stop, -1)
    stay = np.flatnonzero(np.cumsum(steps[:-1]) == 0)
    kept, kept_offs = kernel.joined_words(data, offs, start, end, row, stay)
    of = row[begin]
    runs = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(of, np.arange(len(offs))), pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(begin - bounds[of]), pa.array(stop - begin), pa.array(period)], ["start", "length", "period"]
        ),
    )
    return [pa.array(np.diff(bounds)), runs, kernel.text_rows(kept, kept_offs).cast(pa.string())]


def find_runs(docs: DataFrame, least: int = 12, text: str = "text", batch_bytes: int = 2 << 20) -> DataFrame:
    """Add ``n_words``, ``runs`` and ``collapsed_text`` to every document.

    Words are runs of other than white space, compared as they are. A run is a stretch of
    at least ``least`` words and two periods whose words a period apart are identical, which
    no neighbouring word extends; ``runs`` has start (word number), length and smallest
    period of each, by start and period. ``collapsed_text`` keeps, joined by one space, the words
    that no run contains behind its first period.

    Null and empty texts have no words, no runs and an empty collapsed text. Rows are
    independent of each other: repeated rows get equal results, ids may be null or absent,
    and an empty table stays empty. All input columns stay, but for those named like an
    added one. The longest text must fit a task.
    """
    if least < 2:
        raise ValueError(f"a run has two words at least, not {least}")
    added = ["n_words", "runs", "collapsed_text"]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in kernel.slices(kernel.flat(batch.column(text))[1], batch_bytes):
                part = batch.slice(a, b - a)
                columns = [*part.columns, *_columns(part.column(text), least)]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *added])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{kinds}, n_words bigint, runs {RUNS}, collapsed_text string")
