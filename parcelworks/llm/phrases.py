"""Frequent phrases and how strongly their words belong together, from an FM-index per shard.

Documents become shards of some megabytes: sequences of word numbers with breaks between
pieces of text. Words too rare to stand in any phrase become breaks too. Per phrase length
a shard gets a bidirectional FM-index over its numbers (the Burrows-Wheeler transforms of the
sequence and of its reverse), and its phrases are enumerated by extending intervals by one
word, in turn to the left and to the right, while keeping the interval in the other index.
Counts are added up over all shards: a shard asks once for each distinct phrase it holds,
and gets back one bit that tells whether the phrase is frequent overall. Stretches of a
shard without two frequent phrases in a row hold no longer one and are dropped, so
sequences shrink from length to length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelworks.llm import blocks, kernel
from parcelworks.session import stage_table

U = np.uint64
#: Bytes that end a piece of text, and those between words of a piece.
_PIECE = kernel.byte_set(*((ord(c), ord(c)) for c in ".,;:!?"), (0x0A, 0x0D))
_BETWEEN = _PIECE | kernel.byte_set((0x20, 0x20), (0x09, 0x09))
_WORD = 4  # bytes of a word number

_SHARD = "shard bigint, words binary, bucket int, names array<string>, counts array<bigint>"
_NAMED = "shard bigint, bucket int, numbers binary, names array<string>, counts array<bigint>"
_SEQUENCE = "shard bigint, words binary, symbols binary"
_ASKED = "shard bigint, bucket int, keys binary, counts binary"
_COUNTED = "shard bigint, bucket int, bits binary, grams array<binary>, counts array<bigint>"
#: In place of a shard: rows about all shards.
_FREQUENT = -1


def _table(schema: str, rows: dict[str, list | pa.Array], **kinds: pa.DataType) -> pa.Table:
    names = [field.split(" ")[0] for field in schema.split(", ")]
    size = len(next(iter(rows.values())))
    columns = {n: rows.get(n, [None] * size) for n in names}
    return pa.table({n: c if isinstance(c, pa.Array) else pa.array(c, kinds[n]) for n, c in columns.items()})


def _lists(nulls: int, bounds: list[int], values: pa.Array) -> pa.Array:
    """A column of lists out of one array, without a Python object per value: first some nulls, then a list between any two bounds."""
    return pa.ListArray.from_arrays(pa.array([None] * nulls + bounds, pa.int32()), values)


_LONG, _INT, _BYTES = pa.int64(), pa.int32(), pa.binary()
_NAMES, _COUNTS = pa.list_(pa.string()), pa.list_(pa.int64())
_KINDS = {
    "shard": _LONG, "bucket": _INT, "words": _BYTES, "numbers": _BYTES, "symbols": _BYTES, "keys": _BYTES, "bits": _BYTES,
    "names": _NAMES, "grams": pa.list_(_BYTES),
}


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers as bytes, all lowest bytes first: the higher ones, mostly zero, then compress well."""
    return np.ascontiguousarray(values, dtype="<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(body: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    """Rows of numbers, column by column, as differences from the row before."""
    return _pack(np.diff(keys.astype(np.int32), axis=0, prepend=np.zeros((1, keys.shape[1]), np.int32)).T)


def _unpack_keys(body: bytes, width: int) -> np.ndarray:
    return np.cumsum(_unpack(body).reshape(width, -1), axis=1, dtype=np.int32).T


def _sequence(text: pa.Array, lang: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, dict[str, int]]:
    """Word numbers from 1, with 0 between pieces; the words with their language; their counts; words per language."""
    data, offs = kernel.flat(text)
    data = kernel.LOWER[data]
    start, end, row = kernel.words(data, offs, _BETWEEN)
    if not len(start):
        return np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, np.int64), {}
    words = kernel.distinct_words(data, start, end)
    langs = lang.dictionary_encode()
    pair = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row] * len(words.dictionary)
    kinds, number, count = np.unique(pair + words.indices.to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True)
    names = pc.binary_join_element_wise(
        langs.dictionary.take(pa.array(kinds // len(words.dictionary))),
        words.dictionary.cast(pa.string()).take(pa.array(kinds % len(words.dictionary))),
        "\n",
    )
    ends = np.concatenate([[0], np.cumsum(_PIECE[data])])
    cut = (row[1:] != row[:-1]) | (ends[start[1:]] > ends[end[:-1]])
    out = np.zeros(len(start) + int(cut.sum()) + 1, dtype=np.int64)
    out[np.arange(len(start)) + np.concatenate([[0], np.cumsum(cut)])] = number + 1
    totals = np.zeros(len(langs.dictionary), dtype=np.int64)
    np.add.at(totals, kinds // len(words.dictionary), count)
    return out, names, count, dict(zip(langs.dictionary.to_pylist(), totals.tolist(), strict=True))


def _name_buckets(names: pa.Array, buckets: int) -> np.ndarray:
    data, offs = kernel.flat(names)
    return (kernel.span_hash(kernel.prefix(data, kernel.BYTE_CODES), offs[:-1], offs[1:]) % U(buckets)).astype(np.int64)


def _shard(texts: list[pa.Array], langs: list[pa.Array], shard: int, buckets: int) -> pa.Table:
    """One row with the sequence of a shard and its words per language, and one row per bucket of its words.

    Word numbers follow the buckets, so answers in the order of buckets need no words.
    """
    words, names, counts, totals = _sequence(pa.concat_arrays(texts), pa.concat_arrays(langs))
    bucket = _name_buckets(names, buckets)
    order = np.argsort(bucket, kind="stable")
    number = np.zeros(len(order) + 1, dtype=np.int32)
    number[order + 1] = np.arange(1, len(order) + 1)
    kinds, begin = np.unique(bucket[order], return_index=True)
    cuts = np.append(begin, len(order)).tolist()
    rows: dict[str, list | pa.Array] = {"shard": [shard] * (len(kinds) + 1), "bucket": [None, *kinds.tolist()]}
    rows["words"] = [_pack(number[words])] + [None] * len(kinds)
    bounds = [0, *(len(totals) + cut for cut in cuts)]
    every = pa.concat_arrays([pa.array(list(totals), pa.string()), names.take(pa.array(order)).cast(pa.string())])
    rows["names"] = _lists(0, bounds, every)
    rows["counts"] = _lists(0, bounds, pa.array(np.concatenate([list(totals.values()), counts[order]]).astype(np.int64)))
    return _table(_SHARD, rows, **_KINDS, counts=_COUNTS)


def _shards(docs: DataFrame, shard_bytes: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size = TaskContext.get().partitionId() << 32, 0
        texts: list[pa.Array] = []
        langs: list[pa.Array] = []
        for batch in batches:
            offs = kernel.flat(batch.column("text"))[1]
            for a, b in kernel.slices(offs, shard_bytes):
                if size and size + int(offs[b] - offs[a]) > shard_bytes:
                    yield from _shard(texts, langs, shard, buckets).to_batches()
                    shard, size, texts, langs = shard + 1, 0, [], []
                texts.append(batch.column("text").slice(a, b - a))
                langs.append(batch.column("lang").slice(a, b - a))
                size += int(offs[b] - offs[a])
        if texts:
            yield from _shard(texts, langs, shard, buckets).to_batches()

    return docs.mapInArrow(run, _SHARD)


def _number(asked: pa.Table, least: int, buckets: int) -> pa.Table:
    """For one bucket of words: numbers of the frequent ones, and their counts."""
    bucket = asked["bucket"][0].as_py()
    names = pc.list_flatten(asked["names"]).combine_chunks().dictionary_encode()
    code = names.indices.to_numpy(zero_copy_only=False)
    total = np.zeros(len(names.dictionary), dtype=np.int64)
    np.add.at(total, code, pc.list_flatten(asked["counts"]).to_numpy())
    frequent = np.flatnonzero(total >= least)
    number = np.zeros(len(total), dtype=np.int64)
    number[frequent] = 1 + bucket + buckets * np.arange(len(frequent))
    if len(frequent) and number.max() >= 1 << 31:
        raise OverflowError("more words than 31 bits can number: use more buckets")
    sent = number[code]
    sizes = pc.list_value_length(asked["names"]).to_pylist()
    cuts = np.cumsum([0, *sizes]).tolist()
    rows: dict[str, list | pa.Array] = {"shard": [*asked["shard"].to_pylist(), _FREQUENT], "bucket": [bucket] * (len(sizes) + 1)}
    rows["numbers"] = [_pack(sent[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)] + [number[frequent].astype("<i4").tobytes()]
    rows["names"] = _lists(len(sizes), [0, len(frequent)], names.dictionary.take(pa.array(frequent)))
    rows["counts"] = _lists(len(sizes), [0, len(frequent)], pa.array(total[frequent]))
    return _table(_NAMED, rows, **_KINDS, counts=_COUNTS)


def _suffixes(values: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the ``depth`` or more values that start there.

    The last value, 0, stands nowhere inside a phrase, so that suffixes may go round it.
    """
    name, size = values.astype(np.int64), 1
    while size < depth:
        name = np.unique(name * (int(name.max()) + 1) + np.roll(name, -size), return_inverse=True)[1]
        size *= 2
    return np.argsort(name, kind="stable").astype(np.int32)


def _steps(transform: np.ndarray) -> np.ndarray:
    """From each row to the row of the suffix that begins one value earlier."""
    out = np.empty(len(transform), dtype=np.int32)
    out[np.argsort(transform, kind="stable")] = np.arange(len(transform), dtype=np.int32)
    return out


class Index:
    """A bidirectional FM-index of a sequence of symbols in which 0 is a break; it ends with one.

    Suffixes are sorted as far as phrases of ``depth`` symbols need it.
    """

    def __init__(self, values: np.ndarray, depth: int) -> None:
        self.n = len(values)
        self.order = _suffixes(values, depth)
        self.left = _steps(values[self.order - 1])
        turned = np.append(values[:-1][::-1], 0).astype(values.dtype)
        self.right = _steps(turned[_suffixes(turned, depth) - 1])
        self.count = np.bincount(values)
        self.begin = np.cumsum(self.count) - self.count
        self.first = np.repeat(np.arange(len(self.count), dtype=np.int32), self.count)

    def rows(self, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        return np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))

    def extend(self, steps: np.ndarray, low: np.ndarray, size: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, ...]:
        """All extensions of intervals by one symbol at the side of ``steps``.

        Returns the interval extended, the symbol, and the new interval: its start here, its
        size, and its start in the other index.
        """
        owner = np.full(self.n, -1, dtype=np.int32)
        owner[steps[self.rows(low, size)]] = np.repeat(np.arange(len(low), dtype=np.int32), size)
        at = np.flatnonzero(owner >= 0)
        own, symbol = owner[at], self.first[at]
        begin = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (symbol[1:] != symbol[:-1]))[: len(at)])
        count = np.diff(np.append(begin, len(at)))
        own, symbol, at = own[begin], symbol[begin], at[begin]
        # In the other index an extension lies inside its interval, behind those by smaller symbols.
        order = np.argsort(own, kind="stable")
        before = np.cumsum(count[order]) - count[order]
        new = np.append(True, own[order][1:] != own[order][:-1])[: len(order)]
        there = np.empty(len(own), dtype=np.int64)
        there[order] = other[own[order]] + before - np.maximum.accumulate(np.where(new, before, 0))
        real = symbol > 0
        return own[real], symbol[real], at[real], count[real], there[real]

    def phrases(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All phrases of one length: their symbols, and their intervals (start, size)."""
        low, size = self.begin[1:], self.count[1:]
        other = low
        words = np.arange(1, len(self.count), dtype=np.int32)[:, None]
        for n in range(2, length + 1):
            if n % 2 == 0:
                own, symbol, low, size, other = self.extend(self.left, low, size, other)
                words = np.hstack([symbol[:, None], words[own]])
            else:
                own, symbol, other, size, low = self.extend(self.right, other, size, low)
                words = np.hstack([words[own], symbol[:, None]])
        return words, low, size


def _key_buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    mixed = np.zeros(len(keys), dtype=U)
    for column in keys.T:
        mixed = kernel.mix(mixed * U(3) + column.astype(U))
    return (mixed % U(buckets)).astype(np.int64)


class _Sequence:
    """What is left of a shard, and its phrases of one length in the order of their buckets."""

    def __init__(self, row: dict, length: int, buckets: int) -> None:
        self.shard, self.symbols, self.values = row["shard"], _unpack(row["symbols"]), _unpack(row["words"])
        self.index = Index(self.values, length)
        words, self.low, self.size = self.index.phrases(length)
        keys = self.symbols[words]
        bucket = _key_buckets(keys, buckets)
        order = np.argsort(bucket, kind="stable")
        self.low, self.size, self.keys = self.low[order], self.size[order], keys[order]
        kinds, begin = np.unique(bucket[order], return_index=True)
        cuts = np.append(begin, len(order)).tolist()
        self.spans = list(zip(kinds.tolist(), cuts[:-1], cuts[1:], strict=True))


def _kept(shard: int, numbers: np.ndarray) -> dict:
    """A sequence in as small numbers as it needs, one break for many, one at its end."""
    numbers = np.append(numbers, 0)
    numbers = numbers[np.append(True, (numbers[1:] != 0) | (numbers[:-1] != 0))]
    symbols, words = np.unique(np.append(numbers, 0), return_inverse=True)
    return {"shard": [shard], "words": [_pack(words)], "symbols": [_pack(symbols)]}


def _numbered(shards: pa.Table, named: pa.Table) -> pa.Table:
    """The sequence of a shard in the numbers of all shards; rare words are breaks."""
    if not len(shards):
        return _table(_SEQUENCE, {"shard": []}, **_KINDS)
    named = named.take(pc.sort_indices(named, sort_keys=[("bucket", "ascending")]))
    numbers = np.concatenate([np.zeros(1, np.int32), *(_unpack(n) for n in named["numbers"].to_pylist())])
    return _table(_SEQUENCE, _kept(shards["shard"][0].as_py(), numbers[_unpack(shards["words"][0].as_py())]), **_KINDS)


def _ask(row: dict, length: int, buckets: int) -> pa.Table:
    """One row per bucket of phrases that a shard holds, with their counts in it."""
    held = _Sequence(row, length, buckets)
    rows: dict[str, list] = {"shard": [held.shard] * len(held.spans), "bucket": [kind for kind, _, _ in held.spans]}
    rows["keys"] = [_pack_keys(held.keys[a:b]) for _, a, b in held.spans]
    rows["counts"] = [_pack(held.size[a:b]) for _, a, b in held.spans]
    return _table(_ASKED, rows, **_KINDS, counts=_BYTES)


def _reduce(sequences: pa.Table, replies: pa.Table, length: int, buckets: int) -> pa.Table:
    """Keep of a shard the stretches in which one frequent phrase follows the other."""
    if not len(sequences):
        return _table(_SEQUENCE, {"shard": []}, **_KINDS)
    held = _Sequence(sequences.to_pylist()[0], length, buckets)
    bits = dict(zip(replies["bucket"].to_pylist(), replies["bits"].to_pylist(), strict=True))
    good = np.zeros(len(held.low), dtype=bool)
    for kind, a, b in held.spans:
        good[a:b] = np.unpackbits(np.frombuffer(bits[kind], np.uint8), count=b - a).astype(bool)
    start = np.zeros(held.index.n + 1, dtype=bool)
    start[held.index.order[held.index.rows(held.low[good], held.size[good])]] = True
    # Runs of two and more starts; each keeps its words up to the end of the last phrase.
    edge = np.diff(start.astype(np.int8), prepend=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begin, end = begin[end - begin > 1], end[end - begin > 1]
    size = end - begin + length  # the words, and a break
    at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    numbers = held.symbols[held.values[at]]
    numbers[np.cumsum(size) - 1] = 0
    return _table(_SEQUENCE, _kept(held.shard, numbers), **_KINDS)


def _add_up(asked: pa.Table, length: int, least: int) -> pa.Table:
    """For one bucket of phrases: a bit for every one asked about, and the frequent ones with their counts."""
    parts = [_unpack_keys(k, length) for k in asked["keys"].to_pylist()]
    matrix = np.concatenate(parts)
    counts = np.concatenate([_unpack(c) for c in asked["counts"].to_pylist()]).astype(np.int64)
    wide = [matrix[:, i].astype(np.int64) << 32 | (matrix[:, i + 1] if i + 1 < length else 0) for i in range(0, length, 2)]
    order = np.argsort(wide[0], kind="stable") if len(wide) == 1 else np.lexsort(wide[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for column in wide:
        column = column[order]
        new[1:] |= column[1:] != column[:-1]
    begin = np.flatnonzero(new)
    total = np.add.reduceat(counts[order], begin)
    frequent = np.empty(len(order), dtype=bool)
    frequent[order] = np.repeat(total >= least, np.diff(np.append(begin, len(order))))
    cuts = np.cumsum([0, *map(len, parts)]).tolist()
    rows: dict[str, list | pa.Array] = {"shard": [*asked["shard"].to_pylist(), _FREQUENT], "bucket": [*asked["bucket"].to_pylist(), None]}
    rows["bits"] = [*(np.packbits(frequent[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)), None]
    body = np.ascontiguousarray(matrix[order[begin[total >= least]]], dtype="<i4")
    ends = np.arange(len(body) + 1, dtype=np.int32) * (_WORD * length)
    grams = pa.Array.from_buffers(pa.binary(), len(body), [None, pa.py_buffer(ends), pa.py_buffer(body.tobytes())])
    rows["grams"] = _lists(len(parts), [0, len(body)], grams)
    rows["counts"] = _lists(len(parts), [0, len(body)], pa.array(total[total >= least]))
    return _table(_COUNTED, rows, **_KINDS, counts=_COUNTS)


def frequent_phrases(
    docs: DataFrame, least: int, longest: int, lang: str, text: str, shard_bytes: int, bucket_bytes: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (``gram``, ``lang``, ``word``, ``f``), phrases (``gram``, ``f``) and words per language (``lang``, ``n``).

    ``gram`` holds the numbers of the words, four bytes each; words and phrases have at least
    ``least`` occurrences in their language.
    """
    texts = docs.select(
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang")
    )
    buckets = blocks.block_count(blocks.text_bytes(texts, "text"), bucket_bytes)
    with blocks.small_batches(docs.sparkSession):
        shards = stage_table(_shards(texts, shard_bytes, buckets), "shards")

    def number(table: pa.Table) -> pa.Table:
        blocks.give_back()
        return _number(table, least, buckets)

    def numbered(table: pa.Table, numbers: pa.Table) -> pa.Table:
        blocks.give_back()
        return _numbered(table, numbers)

    def asking(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                blocks.give_back()
                for i in range(len(batch)):
                    yield from _ask(batch.slice(i, 1).to_pylist()[0], length, buckets).to_batches()

        return ask

    def adding(length: int) -> Callable[[pa.Table], pa.Table]:
        def add_up(table: pa.Table) -> pa.Table:
            blocks.give_back()
            return _add_up(table, length, least)

        return add_up

    def reducing(length: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        def reduce(table: pa.Table, replies: pa.Table) -> pa.Table:
            blocks.give_back()
            return _reduce(table, replies, length, buckets)

        return reduce

    named = stage_table(shards.where("bucket is not null").groupBy("bucket").applyInArrow(number, _NAMED), "named")
    rows = shards.where("bucket is null").select("shard", "words").groupBy("shard")
    rows = rows.cogroup(named.where(F.col("shard") != _FREQUENT).select("shard", "bucket", "numbers").groupBy("shard"))
    sequences = stage_table(rows.applyInArrow(numbered, _SEQUENCE), "sequences")
    grams = None
    for length in range(2, longest + 1):
        with blocks.small_batches(docs.sparkSession, 1 << 20):
            asked = sequences.mapInArrow(asking(length), _ASKED)
            counted = stage_table(asked.groupBy("bucket").applyInArrow(adding(length), _COUNTED), "phrases")
        found = counted.where(F.col("shard") == _FREQUENT).select("grams", "counts")
        grams = found if grams is None else grams.unionByName(found)
        if length < longest:
            replies = counted.where(F.col("shard") != _FREQUENT).select("shard", "bucket", "bits").groupBy("shard")
            sequences = stage_table(sequences.groupBy("shard").cogroup(replies).applyInArrow(reducing(length), _SEQUENCE), "sequences")
    words = named.where(F.col("shard") == _FREQUENT).select("numbers", F.posexplode(F.arrays_zip("names", "counts")))
    words = words.select(
        F.substring("numbers", F.col("pos") * _WORD + 1, F.lit(_WORD)).alias("gram"),
        F.regexp_extract("col.names", r"(?s)^(.*)\n[^\n]*$", 1).alias("lang"),
        F.regexp_extract("col.names", r"([^\n]*)$", 1).alias("word"),
        F.col("col.counts").alias("f"),
    )
    phrases = grams.select(F.inline(F.arrays_zip("grams", "counts"))).select(F.col("grams").alias("gram"), F.col("counts").alias("f"))
    totals = shards.where("bucket is null").select(F.inline(F.arrays_zip("names", "counts")))
    return words, phrases, totals.groupBy(F.col("names").alias("lang")).agg(F.sum("counts").alias("n"))


def _whole(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def collocations(
    docs: DataFrame,
    least: int = 30,
    longest: int = 4,
    top: int = 2000,
    within_percent: int = 80,
    lang: str = "lang",
    text: str = "text",
    shard_bytes: int = 3 << 20,
    bucket_bytes: int = 8 << 20,
) -> DataFrame:
    """The ``top`` phrases of every language by how strongly they hold together.

    A-Z is lower-cased; texts are split into pieces at ``.,;:!?`` and line ends, pieces into words at
    blanks and tabs. ``n`` counts all words of a language, ``a`` the occurrences of a phrase of 2 to
    ``longest`` words within pieces, overlaps included; phrases with ``a >= least`` are candidates. Cut
    in two, a candidate scores ``floor(2000000 * a / (l + r))`` with the counts ``l`` and ``r``
    of its parts; the cut of least score counts, the first of equal ones. Candidates
    inside a longer candidate that has at least ``within_percent`` of their count are left out (one
    that is longer by a single word suffices: it has at least the longer one's count). Rows
    are ranked by score and ``a``, both falling, then by phrase in UTF-8 byte order.

    Returns ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``. A null language
    counts as ``und``, a null text as empty; ids play no part, repeated rows count each time, and
    other columns are not looked at. Without candidates the result is empty.
    """
    words, phrases, totals = frequent_phrases(docs, least, longest, lang, text, shard_bytes, bucket_bytes)
    every = words.select("gram", "f", "lang").unionByName(phrases.select("gram", "f", F.lit(None).cast("string").alias("lang")))

    longer = phrases.withColumn("size", F.octet_length("gram")).where(F.col("size") > 2 * _WORD)
    ends = F.array(F.expr(f"substring(gram, 1, size - {_WORD})"), F.expr(f"substring(gram, {_WORD + 1}, size - {_WORD})"))
    around = longer.select(F.explode(ends).alias("gram"), "f").groupBy("gram").agg(F.max("f").alias("longer"))
    open_ = phrases.join(around, "gram", "left").where(
        F.coalesce(_whole(F.col("longer")) * 100 < _whole(F.col("f")) * within_percent, F.lit(True))
    )

    cuts = open_.select(
        "gram", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.expr(f"cast(octet_length(gram) div {_WORD} as int) - 1"))).alias("k")
    ).withColumns({"first": F.expr(f"substring(gram, 1, {_WORD} * k)"), "rest": F.expr(f"substring(gram, {_WORD} * k + 1, octet_length(gram))")})
    cuts = cuts.join(every.select(F.col("gram").alias("first"), F.col("f").alias("l"), "lang"), "first")
    cuts = cuts.join(every.select(F.col("gram").alias("rest"), F.col("f").alias("r")), "rest")
    score = F.expr("cast(2000000 as decimal(38,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + r)")
    # The cut behind the first word names the language: only single words have one.
    best = cuts.groupBy("gram", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"), F.max("lang").alias("lang"))
    best = best.select("gram", "lang", "a", "cut.*")
    ahead = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = best.withColumn("place", F.rank().over(ahead)).where(F.col("place") <= top)

    numbered = best.select("gram", F.posexplode(F.sequence(F.lit(1), F.expr(f"cast(octet_length(gram) div {_WORD} as int)"))).alias("pos", "i"))
    numbered = numbered.select(F.col("gram").alias("whole"), "pos", F.expr(f"substring(gram, {_WORD} * pos + 1, {_WORD})").alias("gram"))
    spelt = numbered.join(words.select("gram", "word"), "gram").groupBy("whole").agg(F.collect_list(F.struct("pos", "word")).alias("words"))
    phrase = F.array_join(F.transform(F.array_sort("words"), lambda w: w["word"]), " ")
    named = best.join(spelt.select(F.col("whole").alias("gram"), phrase.alias("phrase")), "gram").join(totals, "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        named.withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
