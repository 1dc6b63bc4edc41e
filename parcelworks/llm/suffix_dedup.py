"""Repeated byte strings, found by a distributed merge sort of suffixes.

Only suffixes that can matter are sorted. In every window of ``width`` bytes one short
string is sampled by its content, so equal windows sample alike:

1. Samples that lie in one document only rule out all their windows.
2. Surroundings (all windows around one sample) that occur under a smaller id settle
   their windows, and so do samples that have the same surroundings wherever they occur.
3. Of the other windows those go on that more than one block holds, by a short hash.
4. Their suffixes are sorted in each block, one per distinct window, and sent front-coded:
   the length of the prefix shared with the one before, and the rest. Runs are merged by a
   loser tree that keeps shared prefix lengths, so no byte known to be equal is looked at
   again; equal neighbours of the merged order are the repeats.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelworks.llm import blocks, kernel
from parcelworks.llm.names import sets_aside

U = np.uint64
_SAMPLES, _KINDS, _AROUND, _FILTER, _RUNS = range(5)


class _Texts:
    def __init__(self, table: pa.Table, doc_id: str, text: str) -> None:
        self.part = table[blocks.PART][0].as_py()
        self.table, self.ids = blocks.ordered(table, doc_id, text)
        self.data, self.offs = kernel.flat(self.table[text])
        self.sums = kernel.prefix(self.data, kernel.BYTE_CODES)

    def row(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offs, at, side="right") - 1


def _sorted_suffixes(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Order of the windows at ``at`` by their bytes."""
    words = [
        data[at[:, None] + np.arange(i, min(i + 8, width))].astype(np.uint8) for i in range(0, width, 8)
    ]
    keys = []
    for w in words:
        wide = np.zeros((len(at), 8), dtype=np.uint8)
        wide[:, : w.shape[1]] = w
        keys.append(wide.view(">u8").ravel().astype(U))
    return np.lexsort(keys[::-1])


def _front_code(rows: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Shared prefix with the row before, and the remaining bytes of all rows."""
    width = rows.shape[1]
    same = np.zeros(len(rows), dtype=np.uint8)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        same[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    rest = rows[np.arange(width)[None, :] >= same[:, None]]
    return same, rest.tobytes()


class _Run:
    """A sorted run: front-coded on the way, whole strings once read."""

    __slots__ = ("at", "same", "texts")

    def __init__(self, same: bytes, rest: bytes, width: int) -> None:
        self.same = list(same)
        self.texts, self.at = [], 0
        text, pos = b"", 0
        for n in self.same:
            take = width - n
            text = text[:n] + rest[pos : pos + take]
            pos += take
            self.texts.append(text)


def _shared(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    x, y = a[known:], b[known:]
    if x == y:
        return len(a)
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return known + len(x) - (differ.bit_length() + 7) // 8


def merge_runs(runs: list[_Run], width: int):
    """(run, position in it, prefix shared with the one before) in sorted order.

    A loser tree: every inner node keeps the run that lost there and the prefix which its
    head shares with the winner. Both heads that meet share known prefixes with the last
    string that left the tree: the longer one is smaller, and only for equal lengths are
    bytes compared, from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    done = len(runs)
    losers = [done] * size
    prefix = [0] * (len(runs) + 1)
    heads: list[bytes | None] = [r.texts[0] if r.texts else None for r in runs] + [None]

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix becomes the one it shares with the winner."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if prefix[a] > prefix[b]:
            return a, b
        if prefix[a] < prefix[b]:
            return b, a
        n = _shared(x, y, prefix[a])
        if n == width:
            win, lose = (a, b) if a < b else (b, a)
        else:
            win, lose = (a, b) if x[n] < y[n] else (b, a)
        prefix[lose] = n
        return win, lose

    level = [i if i < len(runs) else done for i in range(size)]
    node = size
    while len(level) > 1:
        node //= 2
        up = []
        for i in range(0, len(level), 2):
            win, lose = play(level[i], level[i + 1])
            losers[node + i // 2] = lose
            up.append(win)
        level = up
    top = level[0]
    while heads[top] is not None:
        run = runs[top]
        yield top, run.at, prefix[top]
        run.at += 1
        if run.at < len(run.texts):
            heads[top] = run.texts[run.at]
            prefix[top] = run.same[run.at]
        else:
            heads[top] = None
        node = (top + size) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2


def _merge_bucket(requests: pa.Table, width: int) -> pa.Table:
    """Which suffixes of each run also start under a smaller id in another run."""
    if requests["tags"][0].as_py() is None or requests["level"][0].as_py() != _RUNS:
        raise ValueError("not suffix runs")
    sames, rests = requests["tags"].to_pylist(), requests["keys"].to_pylist()
    runs = [_Run(s, r, width) for s, r in zip(sames, rests, strict=True)]
    owners = [
        np.frombuffer(o, np.int64)[np.frombuffer(r, np.int32)].tolist()
        for o, r in zip(requests["owners"].to_pylist(), requests["runs"].to_pylist(), strict=True)
    ]
    sizes = [len(s) for s in sames]
    base = np.cumsum([0, *sizes]).tolist()
    smaller = np.zeros(base[-1], dtype=bool)
    group: list[tuple[int, int]] = []

    def close() -> None:
        if len(group) > 1:
            least = min(owner for _, owner in group)
            for i, owner in group:
                if owner > least:
                    smaller[i] = True
        group.clear()

    for run, at, same in merge_runs(runs, width):
        if same < width:
            close()
        group.append((base[run] + at, owners[run][at]))
    close()
    none = np.zeros(base[-1], dtype=bool)
    return blocks.reply_table(requests, sizes, none, smaller, none)


def _ask_suffixes(part: int, bucket: np.ndarray, rows: np.ndarray, owner: np.ndarray) -> pa.Table:
    """Request rows: one sorted, front-coded run for each bucket."""
    columns: dict[str, list] = {name: [] for name in blocks.REQUEST_SCHEMA.names}
    order = np.argsort(bucket, kind="stable")
    kinds, begin = np.unique(bucket[order], return_index=True)
    for kind, mine in zip(kinds.tolist(), np.split(order, begin)[1:], strict=True):
        same, rest = _front_code(rows[mine])
        ids, which = np.unique(owner[mine], return_inverse=True)
        for name, value in (
            ("level", _RUNS),
            ("bucket", kind),
            ("part", part),
            ("keys", rest),
            ("tags", same.tobytes()),
            ("owners", ids.tobytes()),
            ("runs", which.astype(np.int32).tobytes()),
        ):
            columns[name].append(value)
    return pa.table(columns, schema=blocks.REQUEST_SCHEMA)


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> U(32)) % U(buckets)).astype(np.int64)


def _positions(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the given stretches."""
    ends = np.cumsum(size)
    return np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def _walk(texts: _Texts, width: int, sample: int, buckets: int, filter_bytes: int, replies: pa.Table, ask_at: int | None):
    """Ask at one of the steps, or return the starts of all repeated windows."""
    whole = kernel.whole_windows(texts.offs, width)
    least = kernel.sliding_argmin(kernel.window_hash(texts.sums, sample), width - sample + 1)
    # Windows that sampled the same spot are neighbours: ``size`` of them from ``first`` on.
    first = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (whole[1:] != whole[:-1]))[: len(whole)])
    size = np.diff(np.append(first, len(whole)))
    first, size = first[whole[first]], size[whole[first]]
    spot = least[first].astype(np.int64)
    found = blocks.Keys(kernel.span_hash(texts.sums, spot, spot + sample), texts.row(spot), texts.ids)
    bucket = _bucket(found.key, buckets)
    if ask_at == _SAMPLES:
        return blocks.ask(_SAMPLES, texts.part, bucket, blocks.as_bytes((found.key, filter_bytes)))
    alive = (blocks.answers(_SAMPLES, bucket, replies, "shared") | found.several)[found.index]
    first, size, spot = first[alive], size[alive], spot[alive]
    last = first + size - 1
    row = texts.row(spot)
    kind = blocks.Keys(kernel.span_hash(texts.sums, spot, spot + sample), row, texts.ids)
    around = kernel.span_hash(texts.sums, first, last + width)
    around = kernel.mix(around + (spot - first).astype(U) * U(0x632BE59BD9B4E019) + size.astype(U))
    around[around == 0] = 1
    low = np.full(len(kind.key), np.iinfo(np.uint64).max, dtype=U)
    high = np.zeros(len(kind.key), dtype=U)
    np.minimum.at(low, kind.index, around)
    np.maximum.at(high, kind.index, around)
    tag = np.where(low == high, low, U(0))
    area = blocks.Keys(around ^ kind.key[kind.index], row, texts.ids)
    kind_bucket, area_bucket = _bucket(kind.key, buckets), _bucket(area.key, buckets)
    if ask_at == _KINDS:
        asked = blocks.ask(_KINDS, texts.part, kind_bucket, blocks.as_bytes((kind.key, 8)), None, tag)
        more = blocks.ask(_AROUND, texts.part, area_bucket, blocks.as_bytes((area.key, 8)), area.first)
        return pa.concat_tables([asked, more])
    mixed = (blocks.answers(_KINDS, kind_bucket, replies, "mixed") | (tag == 0))[kind.index]
    smaller = blocks.answers(_AROUND, area_bucket, replies, "smaller", area.first)[area.index]
    late = smaller | (texts.ids[row] > area.first[area.index])
    settled = _positions(first[late], size[late])
    go = mixed & ~late
    at = _positions(first[go], size[go])
    row = texts.row(at)
    found = blocks.Keys(kernel.span_hash(texts.sums, at, at + width), row, texts.ids)
    bucket = _bucket(found.key, buckets)
    if ask_at == _FILTER:
        return blocks.ask(_FILTER, texts.part, bucket, blocks.as_bytes((found.key, filter_bytes)))
    shared = np.flatnonzero(blocks.answers(_FILTER, bucket, replies, "shared"))
    start = at[found.at[shared]]
    order = _sorted_suffixes(texts.data, start, width)
    bucket = bucket[shared][order]
    if ask_at == _RUNS:
        rows = texts.data[start[order][:, None] + np.arange(width)]
        return _ask_suffixes(texts.part, bucket, rows, found.first[shared][order])
    smaller = np.zeros(len(found.key), dtype=bool)
    smaller[shared[order]] = blocks.answers(_RUNS, bucket, replies, "smaller")
    repeated = at[smaller[found.index] | (texts.ids[row] > found.first[found.index])]
    return np.concatenate([settled, repeated])


def _request(docs: pa.Table, replies: pa.Table, doc_id: str, text: str, ask_at: int, **options) -> pa.Table:
    return _walk(_Texts(docs, doc_id, text), replies=replies, ask_at=ask_at, **options)


def _result(docs: pa.Table, replies: pa.Table, doc_id: str, text: str, keep: list[str], **options) -> pa.Table:
    if not len(docs):
        return pa.table({})
    texts = _Texts(docs, doc_id, text)
    removed = _walk(texts, replies=replies, ask_at=None, **options)
    gone = kernel.covered(removed, options["width"], len(texts.data))
    turns = np.flatnonzero(gone[1:] != gone[:-1]) + 1
    turns = np.unique(np.concatenate([turns, texts.offs[texts.offs < len(gone)]]))
    ends = np.append(turns[1:], len(gone))[: len(turns)]
    begin, end = turns[gone[turns]], ends[gone[turns]]
    cuts = np.searchsorted(begin, texts.offs)
    base = np.repeat(texts.offs[:-1], np.diff(cuts))
    span = pa.StructArray.from_arrays([pa.array(begin - base), pa.array(end - base)], ["first_byte", "end_byte"])
    n_bytes, n_removed = np.diff(texts.offs), kernel.per_row(gone, texts.offs)
    offs = np.concatenate([[0], np.cumsum(n_bytes - n_removed)])
    kept = kernel.text_rows(texts.data[~gone], offs).view(pa.large_binary()).cast(pa.binary())
    columns = {name: texts.table[name] for name in keep}
    columns |= {
        "n_bytes": n_bytes,
        "n_removed": n_removed,
        "removed_spans": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), span),
        "kept_bytes": kept,
    }
    return pa.table(columns)


@sets_aside(blocks.PART)
def remove_repeated_bytes(
    docs: DataFrame,
    width: int = 50,
    sample: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = 3 << 20,
    bucket_bytes: int = 4 << 20,
) -> DataFrame:
    """Remove bytes covered by a ``width``-byte string that also starts under a smaller id.

    Adds ``n_bytes``, ``n_removed``, ``removed_spans`` (maximal runs, as offsets) and
    ``kept_bytes`` (binary: a cut may fall inside a character). Strings are judged on the
    input, matches never cross texts, overlaps count.

    Null and empty texts have no bytes; texts shorter than ``width`` lose nothing. Rows
    that share an id never remove each other's bytes; a null id counts as larger than all
    others. All input columns stay, but for those named like an added one; an empty table
    gives an empty table.

    Samples, and surroundings by which whole copies are settled without sorting, are told
    apart by hashes of 64 bits; suffixes that are sent are compared by their bytes, those of one block by
    64-bit hashes. The largest block must fit a task, so at least the longest
    text.
    """
    if not 0 < sample < width < 256:
        raise ValueError("sample must be shorter than width, and width under 256")
    added = ["n_bytes", "n_removed", "removed_spans", "kept_bytes"]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    total = blocks.text_bytes(docs, text)
    parts = blocks.in_blocks(docs, blocks.block_count(total, block_bytes), doc_id, text)
    options = {
        "doc_id": doc_id,
        "text": text,
        "width": width,
        "sample": sample,
        "buckets": blocks.block_count(total, bucket_bytes * 2),
        "filter_bytes": min(8, -(-(max(total, 2).bit_length() + 10) // 8)),
    }
    ask = lambda step: partial(_request, ask_at=step, **options)
    replies = blocks.exchange(parts, None, ask(_SAMPLES), key_bytes=options["filter_bytes"])
    replies = blocks.exchange(parts, replies, ask(_KINDS))
    replies = blocks.exchange(parts, replies, ask(_FILTER), key_bytes=options["filter_bytes"])
    replies = blocks.exchange(parts, replies, ask(_RUNS), partial(_merge_bucket, width=width))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    schema = ", ".join(
        [*kinds, "n_bytes long, n_removed long, removed_spans array<struct<first_byte:long,end_byte:long>>, kept_bytes binary"]
    )
    return blocks.each_block(parts, replies, partial(_result, keep=docs.columns, **options), schema)
