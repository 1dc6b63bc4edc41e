"""Questions that blocks of documents ask each other, without gathering any key's rows.

A block is some megabytes of documents, picked by a hash of their id. Of every key
(the hash of a passage, say) a block sends one entry, however often it holds the key;
entries meet by hash bucket, and each sender gets back one bit per entry. So a passage
found in a third of all documents costs one entry per block, and no answer carries
texts. A block lists its keys anew for every step, in the same order, so answers need
no keys; the documents' exchange is written once and read by every step.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U = np.uint64
PART = "__part"

REQUEST = "level int, bucket int, part int, keys binary, tags binary, owners binary, runs binary"
REPLY = "level int, part int, bucket int, shared binary, smaller binary, mixed binary"
REQUEST_SCHEMA = pa.schema(
    [("level", pa.int32()), ("bucket", pa.int32()), ("part", pa.int32())]
    + [(name, pa.binary()) for name in ("keys", "tags", "owners", "runs")]
)
REPLY_SCHEMA = pa.schema(
    [("level", pa.int32()), ("part", pa.int32()), ("bucket", pa.int32())]
    + [(name, pa.binary()) for name in ("shared", "smaller", "mixed")]
)


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, most: int = 16 << 20) -> Iterator[None]:
    """Within it, jobs hand rows to Python in batches of at most so many bytes."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(most))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def give_back() -> None:
    """Return Arrow memory that is not used: a worker goes on to other blocks and steps, which should not add to it."""
    pa.default_memory_pool().release_unused()


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).cast("long")).first()[0]


def block_count(total: int, block_bytes: int) -> int:
    return max(1, math.ceil(total / block_bytes))


def in_blocks(docs: DataFrame, blocks: int, doc_id: str, text: str) -> DataFrame:
    """Documents with the number of their block; those without an id are dealt by their text."""
    dealt = F.coalesce(F.xxhash64(F.when(F.col(doc_id).isNull(), F.col(text))), F.lit(0))
    place = F.when(F.col(doc_id).isNull(), dealt).otherwise(F.xxhash64(doc_id))
    return docs.withColumn(PART, F.pmod(place, F.lit(blocks)).cast("int"))


def ordered(table: pa.Table, doc_id: str, text: str) -> tuple[pa.Table, np.ndarray]:
    """Rows by id (null last), then text, and their ids; a null id counts as the largest."""
    table = table.take(pc.sort_indices(table, sort_keys=[(doc_id, "ascending"), (text, "ascending")]))
    most = np.iinfo(np.int64).max
    return table, pc.fill_null(table[doc_id].cast(pa.int64()), most).to_numpy()


class Keys:
    """The distinct keys of a block, and which rows hold them.

    ``rows`` must not decrease, and rows are sorted by their id. ``first`` is the least
    id that holds a key, ``several`` tells whether another id of the block holds it too.
    """

    def __init__(self, key: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> None:
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        begin = np.flatnonzero(new)
        self.key = sorted_key[begin]
        self.at = order[begin]
        self.index = np.empty(len(key), dtype=np.int64)
        self.index[order] = np.cumsum(new) - 1
        end = np.append(begin[1:], len(key)) - 1
        self.first = ids[rows[order[begin]]] if len(begin) else np.zeros(0, np.int64)
        self.several = self.first != ids[rows[order[end]]] if len(begin) else np.zeros(0, bool)


def _layout(bucket: np.ndarray, owner: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(bucket, kind="stable") if owner is None else np.lexsort((owner, bucket))
    kinds, begin = np.unique(bucket[order], return_index=True)
    return order, kinds, np.append(begin, len(bucket))


def ask(
    level: int,
    part: int,
    bucket: np.ndarray,
    keys: np.ndarray,
    owner: np.ndarray | None = None,
    tags: np.ndarray | None = None,
) -> pa.Table:
    """Request rows for distinct keys, given as a matrix of bytes."""
    order, kinds, cuts = _layout(bucket, owner)
    rows: dict[str, list] = {name: [] for name in REQUEST_SCHEMA.names}
    for kind, a, b in zip(kinds.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        at = order[a:b]
        rows["level"].append(level)
        rows["bucket"].append(kind)
        rows["part"].append(part)
        rows["keys"].append(np.ascontiguousarray(keys[at]).tobytes())
        rows["tags"].append(None if tags is None else tags[at].tobytes())
        if owner is None:
            rows["owners"].append(None)
            rows["runs"].append(None)
        else:
            mine = owner[at]
            begin = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
            rows["owners"].append(mine[begin].tobytes())
            rows["runs"].append(np.diff(np.append(begin, len(mine))).astype(np.int32).tobytes())
    return pa.table(rows, schema=REQUEST_SCHEMA)


def answers(
    level: int, bucket: np.ndarray, replies: pa.Table, name: str, owner: np.ndarray | None = None
) -> np.ndarray:
    """The bits that came back for the keys of ``ask``, in the order of the keys."""
    order, kinds, cuts = _layout(bucket, owner)
    mine = replies.filter(pc.equal(replies["level"], level))
    bits = dict(zip(mine["bucket"].to_pylist(), mine[name].to_pylist(), strict=True))
    out = np.zeros(len(bucket), dtype=bool)
    for kind, a, b in zip(kinds.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if found := bits.get(kind):
            out[order[a:b]] = np.unpackbits(np.frombuffer(found, np.uint8), count=b - a).astype(bool)
    return out


def payload_table(requests: pa.Table, sizes: list[int], values: np.ndarray) -> pa.Table:
    """Reply rows that carry a row of bytes per key; rows of zeros alone are left out."""
    cuts = np.cumsum([0, *sizes]).tolist()
    rows: dict[str, list] = {name: [] for name in REPLY_SCHEMA.names}
    heads = zip(*(requests[c].to_pylist() for c in ("level", "part", "bucket")), strict=True)
    for head, a, b in zip(heads, cuts[:-1], cuts[1:], strict=True):
        if values[a:b].any():
            for name, value in zip(REPLY_SCHEMA.names, (*head, values[a:b].tobytes(), None, None), strict=True):
                rows[name].append(value)
    return pa.table(rows, schema=REPLY_SCHEMA)


def payload(level: int, bucket: np.ndarray, replies: pa.Table, width: int) -> np.ndarray:
    """What ``payload_table`` sent for the keys of ``ask``, in the order of the keys."""
    order, kinds, cuts = _layout(bucket, None)
    mine = replies.filter(pc.equal(replies["level"], level))
    got = dict(zip(mine["bucket"].to_pylist(), mine["shared"].to_pylist(), strict=True))
    out = np.zeros((len(bucket), width), dtype=np.uint8)
    for kind, a, b in zip(kinds.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if found := got.get(kind):
            out[order[a:b]] = np.frombuffer(found, np.uint8).reshape(-1, width)
    return out


def as_bytes(*columns: tuple[np.ndarray, int]) -> np.ndarray:
    """A matrix of the low bytes of each column."""
    return np.hstack([np.ascontiguousarray(c).view(np.uint8).reshape(-1, 8)[:, :size] for c, size in columns])


def _column(part: bytes, size: int) -> np.ndarray:
    wide = np.zeros((len(part) // size, 8), dtype=np.uint8)
    wide[:, :size] = np.frombuffer(part, np.uint8).reshape(-1, size)
    return wide.view(U).ravel()


def reply_table(requests: pa.Table, sizes: list[int], shared: np.ndarray, smaller: np.ndarray, mixed: np.ndarray) -> pa.Table:
    """Reply rows; a request whose bits are all unset gets none."""
    cuts = np.cumsum([0, *sizes]).tolist()
    rows: dict[str, list] = {name: [] for name in REPLY_SCHEMA.names}
    heads = zip(*(requests[c].to_pylist() for c in ("level", "part", "bucket")), strict=True)
    for (level, part, bucket), a, b in zip(heads, cuts[:-1], cuts[1:], strict=True):
        if shared[a:b].any() or smaller[a:b].any() or mixed[a:b].any():
            rows["level"].append(level)
            rows["part"].append(part)
            rows["bucket"].append(bucket)
            for name, bits in (("shared", shared), ("smaller", smaller), ("mixed", mixed)):
                rows[name].append(np.packbits(bits[a:b]).tobytes())
    return pa.table(rows, schema=REPLY_SCHEMA)


def settle(requests: pa.Table, key_bytes: int) -> pa.Table:
    """Answers to the requests of one bucket.

    ``shared``: another block holds the key. ``smaller``: another block holds it in a
    document with a smaller id. ``mixed``: its tags are not all the same known tag.
    """
    keys = requests["keys"].to_pylist()
    sizes = [len(k) // key_bytes for k in keys]
    matrix = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, key_bytes)
    low = _column(matrix[:, : min(8, key_bytes)].tobytes(), min(8, key_bytes))
    sort = [low]
    if key_bytes > 8:
        sort.append(_column(matrix[:, 8:].tobytes(), key_bytes - 8))
    order = np.lexsort(sort[::-1]) if len(sort) > 1 else np.argsort(low, kind="stable")
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for c in sort:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(order)))
    shared, smaller, mixed = (np.zeros(len(order), dtype=bool) for _ in range(3))
    shared[order] = np.repeat(count > 1, count)
    if requests["owners"][0].as_py() is not None:
        owner = np.concatenate(
            [
                np.repeat(np.frombuffer(o, np.int64), np.frombuffer(r, np.int32))
                for o, r in zip(requests["owners"].to_pylist(), requests["runs"].to_pylist(), strict=True)
            ]
        )
        least = np.minimum.reduceat(owner[order], begin)
        smaller[order] = np.repeat(least, count) < owner[order]
    if requests["tags"][0].as_py() is not None:
        tag = np.frombuffer(b"".join(requests["tags"].to_pylist()), U)[order]
        odd = np.minimum.reduceat(tag, begin) != np.maximum.reduceat(tag, begin)
        odd |= np.minimum.reduceat(tag, begin) == 0
        mixed[order] = np.repeat(odd, count)
    return reply_table(requests, sizes, shared, smaller, mixed)


def _asked(step: Callable[[pa.Table, pa.Table], pa.Table], docs: pa.Table, replies: pa.Table | None = None) -> pa.Table:
    give_back()
    return step(docs, REPLY_SCHEMA.empty_table() if replies is None else replies)


def each_block(docs: DataFrame, replies: DataFrame | None, step: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``step`` on the documents of each block and all answers that the block has got."""
    if replies is None:

        def alone(table: pa.Table) -> pa.Table:
            return _asked(step, table)

        return docs.groupBy(PART).applyInArrow(alone, schema)

    def both(table: pa.Table, got: pa.Table) -> pa.Table:
        return _asked(step, table, got)

    return docs.groupBy(PART).cogroup(replies.groupBy("part")).applyInArrow(both, schema)


def exchange(
    docs: DataFrame,
    replies: DataFrame | None,
    step: Callable[[pa.Table, pa.Table], pa.Table],
    answer: Callable[[pa.Table], pa.Table] | None = None,
    key_bytes: int = 8,
) -> DataFrame:
    """One round of questions; returns all answers so far."""

    def bucket_answers(requests: pa.Table) -> pa.Table:
        if answer:
            return answer(requests)
        kinds = pc.unique(requests["level"])
        return pa.concat_tables([settle(requests.filter(pc.equal(requests["level"], k)), key_bytes) for k in kinds])

    asked = each_block(docs, replies, step, REQUEST)
    # Dealt out here, so that later rounds read these answers again without making them anew.
    got = asked.groupBy("bucket").applyInArrow(bucket_answers, REPLY).repartition("part")
    return got if replies is None else replies.unionByName(got)
