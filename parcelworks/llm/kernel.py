"""Numpy steps over the texts of one batch at once: words, hashes, sampled positions.

Texts lie end to end in one byte array; ``offs`` has the start of each text and the
end of the last one. Nothing here knows Spark.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOW = U((1 << 24) - 1)
#: Positions taken at a time, so that what is worked on stays in the processor's cache.
_STEP = 1 << 15


def _byte_codes() -> np.ndarray:
    codes = [int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "little") for b in range(256)]
    return np.array([c | 1 for c in codes], dtype=U)


BYTE_CODES = _byte_codes()
_powers = np.ones(1, dtype=U)
_inverses = np.ones(1, dtype=U)


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
            row = np.full(size, base, dtype=U)
            row[0] = 1
            globals()[name] = np.multiply.accumulate(row)
    return _powers, _inverses


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that is true for the bytes in the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: Bytes between words: white space only, or everything but digits, letters and bytes over 0x7F.
WHITE = byte_set((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks else pa.array([], pa.large_binary())
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays([c.cast(pa.large_binary()) for c in column.chunks])
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.binary()) if pa.types.is_string(column.type) else column
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offs = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.zeros(0, np.uint8) if body is None else np.frombuffer(body, dtype=np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each, never splitting a row."""
    cuts, n = [0], len(offs) - 1
    while cuts[-1] < n:
        at = int(np.searchsorted(offs, offs[cuts[-1]] + most, side="right")) - 1
        cuts.append(min(n, max(at, cuts[-1] + 1)))
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of the input over the output."""
    x = x ^ (x >> U(32))
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    x *= U(0xA0761D6478BD642F)
    x ^= x >> U(32)
    return x


def prefix(values: np.ndarray, codes: np.ndarray | None = None) -> np.ndarray:
    """Sums from which ``span_hash`` takes the hash of any span of ``values``.

    With ``codes`` the values are looked up there first.
    """
    n = len(values)
    powers = _powers_to(n + 1)[0]
    sums = np.zeros(n + 1, dtype=U)
    for lo in range(0, n, _STEP):
        hi = min(lo + _STEP, n)
        part = (values[lo:hi] if codes is None else codes[values[lo:hi]]) * powers[lo:hi]
        np.cumsum(part, out=sums[lo + 1 : hi + 1])
        sums[lo + 1 : hi + 1] += sums[lo]
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span that depends on its values alone, not on where it lies."""
    return mix((sums[end] - sums[start]) * _powers_to(len(sums))[1][start])


def window_hash(sums: np.ndarray, width: int) -> np.ndarray:
    """``span_hash`` of every window of one width."""
    n = max(0, len(sums) - width)
    inverses = _powers_to(len(sums))[1]
    out = np.empty(n, dtype=U)
    for lo in range(0, n, _STEP):
        hi = min(lo + _STEP, n)
        out[lo:hi] = mix((sums[width + lo : width + hi] - sums[lo:hi]) * inverses[lo:hi])
    return out


def words(data: np.ndarray, offs: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word: the longest runs of bytes outside ``between``."""
    inside = ~between[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = offs[1:] > offs[:-1]
        at = offs[:-1][full]
        first[at] = inside[at]
        at = offs[1:][full] - 1
        last[at] = inside[at]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offs, start, side="right") - 1


def distinct_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.DictionaryArray:
    """The words as a dictionary column: equal numbers for equal bytes, and for these alone."""
    steps = np.zeros(len(data) + 1, dtype=np.int8)
    steps[start] += 1
    steps[end] -= 1
    body = data[np.cumsum(steps[:-1], dtype=np.int8) > 0]
    offs = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    column = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offs), pa.py_buffer(body)])
    return column.dictionary_encode()


def word_numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number of each word, the same for the same bytes; numbers hold for this call only."""
    return distinct_words(data, start, end).indices.to_numpy(zero_copy_only=False).astype(np.int64)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, bits: int = 64) -> np.ndarray:
    """64 bits of a cryptographic hash of every word; with ``bits=128`` two such columns, one above the other.

    No words of any length are known to share them, which does not hold for sums of
    powers modulo 2**64 such as ``prefix`` makes: long words can cancel out there.
    """
    words = distinct_words(data, start, end)
    made = b"".join([hashlib.blake2b(w, digest_size=bits // 8).digest() for w in words.dictionary.to_pylist()])
    table = np.frombuffer(made, dtype=U).reshape(-1, bits // 64).T
    index = words.indices.to_numpy(zero_copy_only=False)
    out = np.ascontiguousarray(table)[:, index]
    return out[0] if bits == 64 else out


def joined_words(
    data: np.ndarray, offs: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, stay: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The words numbered in ``stay`` (ascending), joined by one space per row, and the rows' bounds."""
    steps = np.zeros(len(data) + 1, dtype=np.int32)
    steps[start[stay]] += 1
    steps[end[stay]] -= 1
    kept = np.cumsum(steps[:-1], dtype=np.int32) > 0
    # A kept word that is not its row's last keeps the byte behind it, as a space.
    behind = end[stay[np.flatnonzero(row[stay][1:] == row[stay][:-1])]]
    kept[behind] = True
    out = data.copy()
    out[behind] = 0x20
    return out[kept], np.concatenate([[0], np.cumsum(per_row(kept, offs))])


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return values if span == width else np.minimum(values[: len(values) - (width - span)], values[width - span :])


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each ``width`` neighbours the position of the least, the leftmost among equals.

    The choice depends on the neighbours alone, so equal stretches choose alike.
    """
    n = len(values) - width + 1
    out = np.empty(max(0, n), dtype=np.int32 if len(values) < 1 << 31 else np.int64)
    for lo in range(0, max(0, n), _STEP):
        hi = min(lo + _STEP, n)
        part = values[lo : hi + width - 1]
        least = _sliding_min((part & ~_LOW) | np.arange(len(part), dtype=U), width)
        out[lo:hi] = (least & _LOW).astype(out.dtype) + lo
    return out


def whole_windows(offs: np.ndarray, width: int) -> np.ndarray:
    """Which positions start a window that lies in one row."""
    out = np.ones(max(0, int(offs[-1]) - width + 1), dtype=bool)
    for border in offs[1:-1].tolist():
        out[max(0, border - width + 1) : border] = False
    return out


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a window that begins at one of the distinct ``starts``."""
    steps = np.zeros(n + 1, dtype=np.int32)
    steps[starts] += 1
    steps[starts + width] -= 1
    return np.cumsum(steps[:-1], dtype=np.int32) > 0


def per_row(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How many of the flags of each row are set."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offs[1:]] - sums[offs[:-1]]


def sha_hex(data: np.ndarray, offs: np.ndarray) -> list[str]:
    view = memoryview(np.ascontiguousarray(data))
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]


def text_rows(data: np.ndarray, offs: np.ndarray) -> pa.Array:
    """The rows as a text column."""
    body = pa.py_buffer(np.ascontiguousarray(data))
    return pa.Array.from_buffers(pa.large_string(), len(offs) - 1, [None, pa.py_buffer(offs.astype(np.int64)), body])
