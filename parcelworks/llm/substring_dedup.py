"""Repeated passages of words, found by level-wise doubling.

The first level looks at passages of about half the wanted width, one sampled in each
window. Windows whose sampled passage is repeated are extended to the wanted width. Beyond it,
doubling goes on until no candidate survives or ``until`` is reached: a passage is extended to
twice its length where the one behind it is repeated too. These levels need no texts any more,
only the stretches of words that lie in repeated windows; they wait in buckets by block.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelworks.llm import blocks, kernel
from parcelworks.llm.names import sets_aside
from parcelworks.session import stage_bucketed, stage_table

U = np.uint64
#: What a block knows of its passages wider than the window: see ``_passages``.
_STRETCHES = f"{blocks.PART} int, removed binary, held binary, rows binary, sizes binary, ids binary, words binary, hashes binary, alive binary"
#: In place of a bucket: a block's row about itself.
_OWN = -1


class _Texts:
    """Words of one block and windows over them."""

    def __init__(self, table: pa.Table, doc_id: str, text: str, hashed: bool = True) -> None:
        self.part = table[blocks.PART][0].as_py()
        self.table, self.ids = blocks.ordered(table, doc_id, text)
        self.data, self.offs = kernel.flat(self.table[text])
        self.start, self.end, self.row = kernel.words(self.data, self.offs, kernel.WHITE)
        if hashed:
            self.hashes, second = kernel.word_hashes(self.data, self.start, self.end, bits=128)
            self.sums, self.more = kernel.prefix(self.hashes), kernel.prefix(second)

    def windows(self, width: int) -> np.ndarray:
        """Starts of windows that lie in one document."""
        n = max(0, len(self.row) - width + 1)
        return np.flatnonzero(self.row[:n] == self.row[width - 1 :][:n])


def _walk(texts: _Texts, width: int, buckets: int, filter_bytes: int, replies: pa.Table, ask_at: int | None):
    """Go through the two levels up to ``width``; ask at one of them, or return what all answers say.

    Returns the request table, or the starts of windows that occur under another id, and of
    those that occur under a smaller one.
    """
    half = -(-width // 2)
    least = kernel.sliding_argmin(kernel.window_hash(texts.sums, half), width - half + 1)
    at = texts.windows(width)
    anchor = least[at]
    chosen = np.zeros(len(texts.row) + 1, dtype=bool)
    chosen[anchor] = True
    spots = np.flatnonzero(chosen)
    found = blocks.Keys(kernel.span_hash(texts.sums, spots, spots + half), texts.row[spots], texts.ids)
    bucket = ((found.key >> U(32)) % U(buckets)).astype(np.int64)
    if ask_at == 0:
        return blocks.ask(0, texts.part, bucket, blocks.as_bytes((found.key, filter_bytes)))
    shared = blocks.answers(0, bucket, replies, "shared") | found.several
    alive = np.zeros(len(chosen), dtype=bool)
    alive[spots] = shared[found.index]
    at = at[alive[anchor]]
    found = blocks.Keys(kernel.span_hash(texts.sums, at, at + width), texts.row[at], texts.ids)
    bucket = ((found.key >> U(32)) % U(buckets)).astype(np.int64)
    second = kernel.span_hash(texts.more, at[found.at], at[found.at] + width)
    if ask_at == 1:
        return blocks.ask(1, texts.part, bucket, blocks.as_bytes((found.key, 8), (second, 4)), found.first)
    shared = (blocks.answers(1, bucket, replies, "shared", found.first) | found.several)[found.index]
    smaller = blocks.answers(1, bucket, replies, "smaller", found.first)
    removed = at[smaller[found.index] | (texts.ids[texts.row[at]] > found.first[found.index])]
    return at[shared], removed


def _request(docs: pa.Table, replies: pa.Table, doc_id: str, text: str, width: int, buckets: int, filter_bytes: int, ask_at: int) -> pa.Table:
    return _walk(_Texts(docs, doc_id, text), width, buckets, filter_bytes, replies, ask_at)


def _passages(docs: pa.Table, replies: pa.Table, doc_id: str, text: str, width: int, buckets: int, filter_bytes: int) -> pa.Table:
    """One row of a block with repeated windows; without them none.

    ``removed`` marks the starts of windows to remove among all words, ``held`` lists the rows
    with a repeated window. Of stretches of words that lie in such windows, if they have room for twice
    the width: their rows, sizes and ids, the words as numbers into ``hashes``, and ``alive``, which
    marks the starts of repeated windows among these words.
    """
    texts = _Texts(docs, doc_id, text)
    repeated, removed = _walk(texts, width, buckets, filter_bytes, replies, None)
    if not len(repeated):
        return pa.table({})
    n = len(texts.row)
    at = np.flatnonzero(kernel.covered(repeated, width, n))
    begin = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(texts.row[at]) != 0)))
    sizes = np.diff(np.append(begin, len(at)))
    wide = sizes >= 2 * width
    at, rows = at[np.repeat(wide, sizes)], texts.row[at[begin[wide]]]
    hashes, words = np.unique(texts.hashes[at], return_inverse=True)
    columns = {
        "removed": np.packbits(_marks(removed, n)),
        "held": np.unique(texts.row[repeated]).astype(np.int32),
        "rows": rows.astype(np.int32),
        "sizes": sizes[wide].astype(np.int32),
        "ids": texts.ids[rows],
        "words": words.astype(np.int32),
        "hashes": hashes,
        "alive": np.packbits(_marks(repeated, n)[at]),
    }
    return pa.table({blocks.PART: pa.array([texts.part], pa.int32())} | {k: pa.array([v.tobytes()], pa.binary()) for k, v in columns.items()})


def _marks(at: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, dtype=bool)
    out[at] = True
    return out


def _bits(body: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(body, np.uint8), count=n).astype(bool)


class _Longer:
    """Candidates of one block for the lengths after a level: all their parts of that level's length are repeated."""

    def __init__(self, stretches: pa.Table, known: pa.Table, width: int, length: int, lengths: list[int], buckets: int) -> None:
        row = stretches.to_pylist()[0]
        self.part, self.buckets = row[blocks.PART], buckets
        self.rows, sizes = (np.frombuffer(row[c], np.int32) for c in ("rows", "sizes"))
        self.ids, words = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["words"], np.int32)
        self.n, self.stretch = len(words), np.repeat(np.arange(len(sizes)), sizes)
        own = known.filter(pc.and_(pc.equal(known["bucket"], _OWN), pc.equal(known["level"], length)))["shared"].to_pylist()
        bits = row["alive"] if length == width else own[0] if own else None
        alive = np.zeros(self.n, dtype=bool) if bits is None else _bits(bits, self.n)
        self.sums = kernel.prefix(np.frombuffer(row["hashes"], U)[words])
        self.starts: dict[int, np.ndarray] = {}
        for twice in lengths:
            half, out = twice // 2, np.zeros(self.n, dtype=bool)
            at = np.flatnonzero(alive[: max(0, self.n - half)] & alive[half:])
            self.starts[twice] = at = at[self.stretch[at] == self.stretch[at + half]]
            out[at] = True
            alive = out

    def keys(self, length: int) -> tuple[blocks.Keys, np.ndarray]:
        at = self.starts[length]
        found = blocks.Keys(kernel.span_hash(self.sums, at, at + length), self.stretch[at], self.ids)
        return found, ((found.key >> U(32)) % U(self.buckets)).astype(np.int64)


def _ask_longer(stretches: pa.Table, known: pa.Table, lengths: list[int], **options: int) -> pa.Table:
    held = _Longer(stretches, known, lengths=lengths, **options)
    out = []
    for length in lengths:
        found, bucket = held.keys(length)
        out.append(blocks.ask(length, held.part, bucket, blocks.as_bytes((found.key, 8))))
    return pa.concat_tables(out)


def _survivors(stretches: pa.Table, replies: pa.Table, lengths: list[int], **options: int) -> pa.Table:
    """A block's rows, one per length, with the starts of repeated passages and the rows that hold one."""
    held, out = _Longer(stretches, replies, lengths=lengths, **options), []
    for length in lengths:
        found, bucket = held.keys(length)
        shared = (blocks.answers(length, bucket, replies, "shared") | found.several)[found.index]
        at = held.starts[length][shared]
        if len(at):
            alive = np.packbits(_marks(at, held.n)).tobytes() if length == lengths[-1] else None
            rows = np.unique(held.rows[held.stretch[at]]).tobytes()
            out.append({"level": length, "part": held.part, "bucket": _OWN, "shared": alive, "smaller": rows})
    return pa.Table.from_pylist(out, blocks.REPLY_SCHEMA)


def _cut(texts: _Texts, removed: np.ndarray, longest: np.ndarray, width: int, keep: list[str]) -> pa.Table:
    n, rows = len(texts.row), len(texts.ids)
    gone = kernel.covered(removed, width, n)
    bounds = np.searchsorted(texts.row, np.arange(rows + 1))
    # A kept word keeps its bytes and, unless it ends its text, the one behind it as a space.
    stay = np.flatnonzero(~gone)
    steps = np.zeros(len(texts.data) + 1, dtype=np.int32)
    steps[texts.start[stay]] += 1
    steps[texts.end[stay]] -= 1
    kept = np.cumsum(steps[:-1], dtype=np.int32) > 0
    last = np.append(texts.row[stay][1:] != texts.row[stay][:-1], True)[: len(stay)]
    behind = texts.end[stay[~last]]
    kept[behind] = True
    out = texts.data.copy()
    out[behind] = 0x20
    offs = np.concatenate([[0], np.cumsum(kernel.per_row(kept, texts.offs))])
    columns = {name: texts.table[name] for name in keep}
    columns |= {
        "n_words": np.diff(bounds),
        "n_removed": kernel.per_row(gone, bounds),
        "longest_repeat": longest,
        "kept_text": kernel.text_rows(out[kept], offs).cast(pa.string()),
    }
    return pa.table(columns)


def _result(docs: pa.Table, replies: pa.Table, doc_id: str, text: str, width: int, buckets: int, filter_bytes: int, keep: list[str]) -> pa.Table:
    """The cut documents of a block, out of the answers to both levels."""
    if not len(docs):
        return pa.table({})
    texts = _Texts(docs, doc_id, text)
    repeated, removed = _walk(texts, width, buckets, filter_bytes, replies, None)
    longest = np.zeros(len(texts.ids), dtype=np.int64)
    longest[texts.row[repeated]] = width
    return _cut(texts, removed, longest, width, keep)


def _marked(docs: pa.Table, marks: pa.Table, doc_id: str, text: str, width: int, keep: list[str]) -> pa.Table:
    """The cut documents of a block, out of its own rows: what is removed, and the rows that hold each length."""
    if not len(docs):
        return pa.table({})
    texts = _Texts(docs, doc_id, text, hashed=False)
    longest = np.zeros(len(texts.ids), dtype=np.int64)
    removed = np.zeros(0, dtype=np.int64)
    for mark in sorted(marks.select(["level", "shared", "smaller"]).to_pylist(), key=lambda m: m["level"]):
        longest[np.frombuffer(mark["smaller"], np.int32)] = mark["level"]
        if mark["level"] == width:
            removed = np.flatnonzero(_bits(mark["shared"], len(texts.row)))
    return _cut(texts, removed, longest, width, keep)


def _doubled(spark: SparkSession, stretches: DataFrame, width: int, until: int, buckets: int) -> DataFrame:
    """Rows about each block (as ``_marked`` reads them) for ``width``, twice, four times .., as long as a passage is repeated.

    A round asks about three lengths: what is repeated at the last one goes on.
    """
    nothing, place = F.lit(None).cast("binary"), F.lit(_OWN)
    marks = stretches.select(
        F.lit(width).alias("level"), F.col(blocks.PART).alias("part"), place.alias("bucket"),
        F.col("removed").alias("shared"), F.col("held").alias("smaller"), nothing.alias("mixed"),
    )
    known, length = None, width
    while lengths := [n for n in (2 * length, 4 * length, 8 * length) if not until or n <= until]:
        step = {"width": width, "length": length, "lengths": lengths, "buckets": buckets}
        replies = blocks.exchange(stretches, known, partial(_ask_longer, **step), key_bytes=8)
        found = blocks.each_block(stretches, replies, partial(_survivors, **step), blocks.REPLY)
        known, length = stage_table(found, "longer"), lengths[-1]
        del replies, found
        marks = marks.unionByName(known)
        if known.where(F.col("level") == length).isEmpty():
            break
    return marks


@sets_aside(blocks.PART)
def remove_repeats(
    docs: DataFrame,
    width: int = 13,
    until: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = 2 << 20,
    bucket_bytes: int = 4 << 20,
) -> DataFrame:
    """Remove words covered by ``width`` words that also start in a document of smaller id.

    Adds ``n_words``, ``n_removed``, ``kept_text`` (kept words joined by one space) and
    ``longest_repeat``: the greatest length looked at (``width``, twice, four times ..,
    at most ``until``; ``until=0`` doubles until no candidate survives) at which a window of
    the document also occurs under another id; 0 if none does. Windows are judged on the
    input. By default no length beyond ``width`` is looked at: a longer repeat removes
    nothing that its windows don't. Longer ones are found by jobs that run at once.

    Null and empty texts have no words. Rows that share an id never remove each other's
    words; a null id counts as larger than all others, and ``longest_repeat`` may count rows
    without an id as others of each other. All input columns stay, but for those
    named like an added one. An empty table gives an empty table.

    Keys are hashes: a sampled filter of few bits, which can only keep too much, then 96
    bits per window, made of two cryptographic hashes of each word that don't depend on each other;
    64 bits per longer passage, whose halves are both repeated. The largest block must fit a task, so at least the longest text.
    """
    added = ["n_words", "n_removed", "longest_repeat", "kept_text"]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    keep = docs.columns
    total = blocks.text_bytes(docs, text)
    buckets = blocks.block_count(total, bucket_bytes * 2)
    # Few false alarms however many passages there are: 10 bits more than they need.
    filter_bytes = min(8, -(-(max(total, 2).bit_length() + 10) // 8))
    parts = blocks.in_blocks(docs, blocks.block_count(total, block_bytes), doc_id, text)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    schema = ", ".join([*kinds, "n_words long", "n_removed long", "longest_repeat long", "kept_text string"])
    columns = {"doc_id": doc_id, "text": text, "width": width}
    options = {**columns, "buckets": buckets, "filter_bytes": filter_bytes}
    replies = None
    for level in range(2):
        step = partial(_request, ask_at=level, **options)
        replies = blocks.exchange(parts, replies, step, key_bytes=12 if level else filter_bytes)
    if until is None or 0 < until < 2 * width:
        return blocks.each_block(parts, replies, partial(_result, keep=keep, **options), schema)
    spark = docs.sparkSession
    # No fewer buckets than a shuffle has parts: else Spark would exchange this table for every level.
    places = max(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks.block_count(total, 16 * block_bytes))
    found = blocks.each_block(parts, replies, partial(_passages, **options), _STRETCHES)
    stretches = stage_bucketed(found, "stretches", blocks.PART, places)
    del replies, found
    marks = _doubled(spark, stretches, width, until, blocks.block_count(total, 8 * bucket_bytes))
    return blocks.each_block(parts, marks, partial(_marked, keep=keep, **columns), schema)
