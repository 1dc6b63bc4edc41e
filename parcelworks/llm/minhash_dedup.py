"""Near duplicates by an inverted join on signature coordinates.

Every distinct shingle set has a signature of 64 minima. Sets are posted under each
(coordinate, value) that another set has too, rarest first. Two sets that agree in at
least ``matches`` coordinates must meet in one of the first ``shared - matches + 1``
postings of each, so the frequent rest is skipped. Links are confirmed on full sets.

A group of near copies is not compared pair by pair. In a few rounds every set is
confirmed against the one list leader that it meets most often; lists whose sets are all
in one group by then are done. Only pairs that still lie in different groups are compared
one by one, and bitmaps of both sets rule out most of them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelworks.llm import blocks, kernel
from parcelworks.llm.components import components
from parcelworks.llm.names import sets_aside
from parcelworks.session import in_few_tasks, stage_bucketed, stage_table, to_all

U = np.uint64
COORDINATES = 64
#: Four bits of each coordinate, as four numbers.
_SKETCH = ["sketch0", "sketch1", "sketch2", "sketch3"]
_SUMMARY = "doc bigint, mark bigint, n_shingles bigint, print binary, signature binary, " + ", ".join(
    f"{name} bigint" for name in _SKETCH
)
_SET_BYTES = 6
#: Names of at most so many texts (24 bytes each) are broadcast.
_BROADCAST_ROWS = 1_000_000
_STAR_ROUNDS = 3
#: Leaders are only tried where so many coordinates agree; the last step tries all that may be links.
_ALIKE = 42
#: The greatest chance to miss a pair at the threshold.
_MISS = 1e-6


def matches_for(percent: int) -> int:
    """The most coordinates that a pair at ``percent`` may be asked to agree in, missed with a chance under ``_MISS``."""
    if not 1 <= percent <= 100:
        raise ValueError(f"percent must be from 1 to 100, not {percent}")
    p, chance = percent / 100, 0.0
    for least in range(COORDINATES + 1):
        chance += math.comb(COORDINATES, least) * p**least * (1 - p) ** (COORDINATES - least)
        if chance > _MISS:
            break
    if not least:
        raise ValueError(f"{COORDINATES} coordinates are too few to find pairs at {percent} percent")
    return least


def _multipliers() -> np.ndarray:
    return kernel.mix(np.arange(1, COORDINATES + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted, end to end, and the bounds of the rows."""
    data, offs = kernel.flat(column)
    data = kernel.LOWER[data]
    start, end, row = kernel.words(data, offs, kernel.WHITE)
    sums = kernel.prefix(kernel.word_hashes(data, start, end))
    bounds = np.searchsorted(row, np.arange(len(offs)))
    hashes = kernel.window_hash(sums, size)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= size:
            sets.append(np.unique(hashes[a : b - size + 1]))
        else:
            sets.append(kernel.span_hash(sums, np.array([a]), np.array([b])) if b > a else hashes[:0])
    return np.concatenate([hashes[:0], *sets]), np.cumsum([0, *map(len, sets)])


def _signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Least value of every coordinate for each (not empty) row."""
    out = np.empty((len(bounds) - 1, COORDINATES), dtype=np.int32)
    for k, factor in enumerate(_multipliers()):
        least = np.minimum.reduceat((hashes * factor) >> U(32), bounds[:-1])
        out[:, k] = least.astype(np.uint32).view(np.int32)
    return out


def _sketches(signs: np.ndarray) -> np.ndarray:
    """Four bits of every coordinate; one number per sixteen coordinates, [number, row]."""
    four = kernel.mix(signs.view(np.uint32).astype(U)) & U(15)
    places = np.arange(16, dtype=U) * U(4)
    words = np.bitwise_or.reduce(four.reshape(len(signs), 4, 16) << places, axis=2)
    return np.ascontiguousarray(words.T).view(np.int64)


def _bitmaps(hashes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A bitmap of each set, of eight to sixteen bits per member (and 512 to 65536 in all).

    The size is a power of two, so that halves of a larger one laid over each other give the
    smaller one.
    """
    count = np.diff(bounds)
    bits = 2 ** np.clip(np.ceil(np.log2(np.maximum(count, 1) * 8.0)), 9, 16).astype(np.int64)
    offs = np.concatenate([[0], np.cumsum(bits)])
    flags = np.zeros(offs[-1], dtype=bool)
    place = (hashes >> U(20)).astype(np.int64) & np.repeat(bits - 1, count)
    flags[np.repeat(offs[:-1], count) + place] = True
    words = np.packbits(flags).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offs // 64, pa.int32()), pa.array(words))


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Id, a hash of the text (ids may repeat) and the text."""
    return docs.select(
        F.col(doc_id).cast("bigint").alias("doc"), F.xxhash64(text).alias("mark"), F.col(text).alias("text")
    ).where("doc is not null")


def summaries(docs: DataFrame, size: int, doc_id: str, text: str, batch_bytes: int) -> DataFrame:
    """Size, fingerprint and signature of the shingle set of every document with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, ids, marks = (batch.column(c) for c in ("text", "doc", "mark"))
            for a, b in kernel.slices(kernel.flat(column)[1], batch_bytes):
                hashes, bounds = shingle_sets(column.slice(a, b - a), size)
                full = np.flatnonzero(np.diff(bounds))
                if not len(full):
                    continue
                raw = memoryview(np.ascontiguousarray(hashes)).cast("B")
                cuts = (bounds * 8).tolist()
                prints = [hashlib.blake2b(raw[cuts[i] : cuts[i + 1]], digest_size=16).digest() for i in full.tolist()]
                signs = _signatures(hashes, np.append(bounds[full], bounds[-1]))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, b - a).take(pa.array(full)),
                        marks.slice(a, b - a).take(pa.array(full)),
                        pa.array(np.diff(bounds)[full]),
                        pa.array(prints, pa.binary()),
                        pa.array([x.tobytes() for x in signs], pa.binary()),
                        *[pa.array(c) for c in _sketches(signs)],
                    ],
                    names=["doc", "mark", "n_shingles", "print", "signature", *_SKETCH],
                )

    return _source(docs, doc_id, text).mapInArrow(run, _SUMMARY)


def _full_sets(docs: DataFrame, wanted: DataFrame, size: int, doc_id: str, text: str, batch_bytes: int) -> DataFrame:
    """``node``, its whole set and a bitmap of it, for the texts named in ``wanted``.

    Up to a fixed number of names (three numbers each) are sent to the texts; more are
    joined by a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, nodes = batch.column("text"), batch.column("node")
            for a, b in kernel.slices(kernel.flat(column)[1], batch_bytes):
                hashes, bounds = shingle_sets(column.slice(a, b - a), size)
                short = np.ascontiguousarray(hashes >> U(64 - 8 * _SET_BYTES))
                body = short.view(np.uint8).reshape(-1, 8)[:, :_SET_BYTES].tobytes()
                cuts = (bounds * _SET_BYTES).tolist()
                sets = [body[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [nodes.slice(a, b - a), pa.array(sets, pa.binary()), _bitmaps(hashes, bounds)],
                    names=["node", "members", "bits"],
                )

    if wanted.count() <= _BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = _source(docs, doc_id, text).join(wanted, ["doc", "mark"]).select("node", "text")
    return texts.mapInArrow(run, "node bigint, members binary, bits array<bigint>")


def _members(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // _SET_BYTES, 8), dtype=np.uint8)
    wide[:, :_SET_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, _SET_BYTES)
    return wide.view(U).ravel()


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int, rows: int | None = None) -> DataFrame:
    """Pairs (at most ``rows``, if given) whose full sets share at least ``percent`` of their union."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("set_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                p, q = _members(x.as_py()), _members(y.as_py())
                both = len(p) + len(q) - len(np.unique(np.concatenate([p, q])))
                good.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    # Written, so that their measured size decides how they get to the sets.
    pairs = stage_table(in_few_tasks(pairs.select("a", "b"), rows), "pairs")
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a bigint, b bigint")


def _agreement(a: str, b: str) -> str:
    """In how many coordinates two sketches agree: no less than the signatures do."""
    parts = []
    for name in _SKETCH:
        x = f"({a}.{name} ^ {b}.{name})"
        any_bit = f"({x} | shiftrightunsigned({x}, 1) | shiftrightunsigned({x}, 2) | shiftrightunsigned({x}, 3))"
        parts.append(f"bit_count({any_bit} & {0x1111111111111111}L)")
    return f"({COORDINATES} - {' - '.join(parts)})"


def _fits(percent: int) -> str:
    return f"100 * least(x.n_shingles, y.n_shingles) >= {percent} * greatest(x.n_shingles, y.n_shingles)"


def _laid_over(a: str, b: str) -> str:
    """Bitmap ``a``, its parts of the size of ``b`` laid over each other if ``b`` is smaller."""
    part = f"slice({a}, cast(k * size({b}) as int) + 1, size({b}))"
    parts = f"transform(sequence(1, cast(size({a}) / size({b}) as int) - 1), k -> {part})"
    folded = f"aggregate({parts}, slice({a}, 1, size({b})), (all, one) -> zip_with(all, one, (p, q) -> p | q))"
    return f"if(size({a}) > size({b}), {folded}, {a})"


def _unseen(a: str, b: str) -> str:
    """How many members of one set the bitmaps show to be missing in the other, at least."""
    pair = f"zip_with({_laid_over(a, b)}, {_laid_over(b, a)}, (x, y) -> bit_count(x & ~y))"
    return f"aggregate({pair}, 0, (n, x) -> n + x)"


def _possible(percent: int) -> str:
    """An upper bound of the overlap still reaches the threshold."""
    overlap = f"least(x.n_shingles - {_unseen('x.bits', 'y.bits')}, y.n_shingles - {_unseen('y.bits', 'x.bits')})"
    return f"(100 + {percent}) * {overlap} >= {percent} * (x.n_shingles + y.n_shingles)"


def _token_keys(signatures: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every (coordinate, value), [row, coordinate], and the values."""
    value = np.frombuffer(b"".join(signatures.to_pylist()), np.int32).reshape(-1, COORDINATES)
    where = np.arange(COORDINATES, dtype=U) << U(32)
    return kernel.mix((value.view(np.uint32).astype(U) | where) * U(0x9E3779B97F4A7C15) + U(1)), value


def _size_class(size: np.ndarray) -> np.ndarray:
    """Sizes in steps of six hundredths, so that a byte holds them."""
    return np.minimum(np.floor(np.log(size) / _CLASS), 255).astype(np.int64)


_CLASS = np.log(1.06)


class _Tokens:
    """Postings of one block of sets; one entry per (coordinate, value)."""

    def __init__(self, table: pa.Table, buckets: int) -> None:
        table = table.take(pc.sort_indices(table, sort_keys=[("node", "ascending")]))
        self.part, self.node = table[blocks.PART][0].as_py(), table["node"].to_numpy()
        self.size = table["n_shingles"].to_numpy()
        key, self.value = _token_keys(table["signature"])
        row = np.repeat(np.arange(len(table)), COORDINATES)
        self.keys = blocks.Keys(key.ravel(), row, self.node)
        self.bucket = ((self.keys.key >> U(32)) % U(buckets)).astype(np.int64)
        self.row, self.kind = row, _size_class(self.size)

    def ask(self, key_bytes: int) -> pa.Table:
        order = np.argsort(self.keys.index, kind="stable")
        begin = np.searchsorted(self.keys.index[order], np.arange(len(self.keys.key)))
        kind = self.kind[self.row[order]]
        count = np.minimum(np.diff(np.append(begin, len(order))), 255)
        more = np.minimum.reduceat(kind, begin) | np.maximum.reduceat(kind, begin) << 8 | count << 16
        return blocks.ask(0, self.part, self.bucket, blocks.as_bytes((self.keys.key, key_bytes), (more.astype(U), 3)))

    def choose(self, replies: pa.Table, percent: int, matches: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, coordinate) of the postings that can decide, the rarest of each set, and each row's reach.

        The reach says how widely the values of all coordinates are held: of the copies of a text, the
        text itself has the greatest.
        """
        held, low, high = blocks.payload(0, self.bucket, replies, 3)[self.keys.index].astype(np.int64).T
        kind = self.kind[self.row]
        # Of two holders the other one is known.
        pair = held == _weight(np.array([2]))[0]
        low, high = np.where(pair & (kind == low), high, low), np.where(pair & (kind == high), low, high)
        low, high = np.minimum(low, high), np.maximum(low, high)
        size = self.size[self.row]
        least, most = np.exp(low * _CLASS) * 0.999, np.where(high == 255, np.inf, np.exp((high + 1) * _CLASS) * 1.001)
        usable = np.flatnonzero((held > 0) & (100 * most >= percent * size) & (100 * size >= percent * least))
        order = usable[np.lexsort((self.keys.key[self.keys.index[usable]], held[usable], self.row[usable]))]
        row = self.row[order]
        bounds = np.searchsorted(row, np.arange(len(self.node) + 1))
        place = np.arange(len(order)) - bounds[row]
        order = order[place <= np.diff(bounds)[row] - matches]
        return self.row[order], order % COORDINATES, np.bincount(self.row, held, len(self.node)).astype(np.int64)


def _weight(held: np.ndarray) -> np.ndarray:
    """How often a posting is held, in a byte: 0 for one holder alone."""
    return np.where(held > 1, np.minimum(255, np.rint(8 * np.log2(held))), 0).astype(np.uint8)


def _settle_tokens(requests: pa.Table, key_bytes: int) -> pa.Table:
    """How often each posting is held over all blocks, and the range of its holders' sizes."""
    raw = requests["keys"].to_pylist()
    sizes = [len(k) // (key_bytes + 3) for k in raw]
    matrix = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, key_bytes + 3)
    wide = np.zeros((len(matrix), 8), dtype=np.uint8)
    wide[:, :key_bytes] = matrix[:, :key_bytes]
    key = wide.view(U).ravel()
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    low, high, count = matrix[order][:, key_bytes:].T.astype(np.int64)
    group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
    out = np.empty((len(order), 3), dtype=np.uint8)
    out[order, 0] = _weight(np.add.reduceat(count, begin))[group]
    out[order, 1] = np.minimum.reduceat(low, begin)[group]
    out[order, 2] = np.maximum.reduceat(high, begin)[group]
    return blocks.payload_table(requests, sizes, out)


def _postings(nodes: DataFrame, percent: int, matches: int, block_rows: int) -> DataFrame:
    """(node, token, reach) of the rarest shared postings that can decide, all of a node in ``tokens``.

    Blocks of sets ask how often each (coordinate, value) is held anywhere and how large
    its holders are; one that no set of fitting size shares is not posted.
    """
    count = nodes.count()
    parts = nodes.withColumn(blocks.PART, F.pmod("node", F.lit(blocks.block_count(count, block_rows))).cast("int"))
    key_bytes = min(8, -(-(max(count * COORDINATES, 2).bit_length() + 12) // 8))
    buckets = blocks.block_count(count, 4 * block_rows)

    def ask(table: pa.Table, replies: pa.Table) -> pa.Table:
        return _Tokens(table, buckets).ask(key_bytes)

    def choose(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table):
            return pa.table({})
        tokens = _Tokens(table, buckets)
        row, coordinate, reach = tokens.choose(replies, percent, matches)
        token = coordinate.astype(np.int64) << 32 | tokens.value[row, coordinate].view(np.uint32).astype(np.int64)
        return pa.table({"node": tokens.node[row], "token": token, "reach": reach[row]})

    replies = blocks.exchange(parts, None, ask, lambda requests: _settle_tokens(requests, key_bytes))
    return blocks.each_block(parts, replies, choose, "node bigint, token bigint, reach bigint")


def _grouped(postings: DataFrame, known: DataFrame | None, turn: int, count: int) -> DataFrame:
    """Postings of lists that hold several groups, with the leader of each list and its group, ``main``.

    That is the largest group and its member of the widest reach; in later turns any member
    of it and, in every other turn, of any group. ``count``: of all sets.
    """
    if known is None:
        named = postings.withColumn("component", F.col("node")).withColumn("size", F.lit(1).cast("bigint"))
    else:
        sizes = known.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
        named = postings.join(to_all(known.join(to_all(sizes, count), "component"), count), "node", "left")
        named = named.withColumns({"component": F.coalesce("component", "node"), "size": F.coalesce("size", F.lit(1))})
    any_one = F.xxhash64("node", F.lit(turn))
    if turn % 2:
        order = F.struct(F.xxhash64("component", F.lit(turn)), any_one)
    else:
        order = F.struct(-F.col("size"), F.lit(0) if turn else -F.col("reach"), "component" if turn else F.lit(0), any_one)
    lists = (
        named.groupBy("token")
        .agg(
            F.min_by(F.struct(F.col("node").alias("leader"), F.col("component").alias("main"), F.col("reach").alias("width")), order).alias("first"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        .where("low < high")
        .select("token", "first.*")
    )
    return named.drop("size").join(lists, "token")


def _nearest_leaders(grouped: DataFrame, nodes: DataFrame, matches: int, widest: bool, count: int) -> DataFrame:
    """Each set outside the largest group of a list with one leader, if they look alike.

    In the first turn that is the leader of the widest reach, then the one it meets most often.
    ``count``: of all sets.
    """
    met = grouped.where("component != main").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("n"), F.max("width").alias("width"))
    first = "width" if widest else "n"
    most = met.groupBy("node").agg(F.max_by("leader", F.struct(first, "n", "leader")).alias("leader"))
    left = nodes.select("node", *_SKETCH).join(to_all(most, count), "node").alias("x")
    right = to_all(nodes.select(F.col("node").alias("leader"), *_SKETCH), count).alias("y")
    alike = left.join(right, "leader").where(f"{_agreement('x', 'y')} >= {matches}")
    return alike.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def _open(grouped: DataFrame, nodes: DataFrame, percent: int, matches: int) -> DataFrame:
    """Postings with another group's set in the same list that may be near."""
    rows = grouped.select("token", "node", "component", "reach").join(nodes.select("node", "n_shingles", *_SKETCH), "node")
    test = (
        "x.token = y.token and x.component != y.component"
        f" and {_fits(percent)} and {_agreement('x', 'y')} >= {matches}"
    )
    return rows.alias("x").join(rows.alias("y"), F.expr(test), "left_semi").select("node", "token", "reach")


def _cross_pairs(rows: DataFrame, percent: int, matches: int) -> DataFrame:
    """Pairs of different groups that may be links, each from one list alone.

    In every list the members of its largest group are only compared with the others.
    """
    x, y = rows.where("component != main").alias("x"), rows.alias("y")
    test = (
        "x.token = y.token and x.component != y.component"
        " and (y.component = y.main or x.node < y.node)"
        f" and {_fits(percent)} and {_agreement('x', 'y')} >= {matches}"
        # Bitmaps come last: this leaves one of the lists in which a pair meets.
        f" and array_min(array_intersect(x.tokens, y.tokens)) = x.token and {_possible(percent)}"
    )
    return x.join(y, F.expr(test)).select(
        F.least("x.node", "y.node").alias("a"),
        F.greatest("x.node", "y.node").alias("b"),
        F.expr(_agreement("x", "y")).alias("agree"),
    )


def _apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs whose sets lie in different groups, with the groups."""
    side = lambda name: known.select(F.col("node").alias(name), F.col("component").alias(f"of_{name}"))
    named = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    named = named.withColumns({"of_a": F.coalesce("of_a", "a"), "of_b": F.coalesce("of_b", "b")})
    low, high = F.least("of_a", "of_b"), F.greatest("of_a", "of_b")
    return named.where("of_a != of_b").select("a", "b", "agree", low.alias("low"), high.alias("high"))


@sets_aside("__doc", "__mark", "__id", "__hash")
def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    matches: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    batch_bytes: int = 4 << 20,
    block_rows: int = 8192,
) -> DataFrame:
    """One row per document: ``n_shingles``, ``component_id``, ``kept``.

    Words are runs of other than white space, A-Z lower-cased; a document's set holds its
    distinct ``shingle``-word windows, or the whole word sequence if it is shorter. Two
    documents are linked if 100 * intersection >= ``percent`` * union; ``component_id`` is
    the least id reachable by links, ``kept`` marks that document. Documents without words
    (null, empty) link with nothing. Every link has both sets compared in full (48 bits a
    shingle). A pair at the threshold agrees in less than ``matches`` of 64 coordinates
    with a chance under 1e-6 (``matches_for``; about 3e-7 for 80 percent), and would be
    missed only then. A ``percent`` too low for 64 coordinates is an error.

    Rows with a null id are not compared: null ``n_shingles`` and ``component_id``, kept.
    Rows that share an id are judged text by text. Repeated texts form one set, posted
    once. All input columns stay, but for those named like an added one; an empty table
    gives an empty table.
    """
    matches = matches_for(percent) if matches is None else matches
    added = ["n_shingles", "component_id", "kept"]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    with blocks.small_batches(docs.sparkSession):
        every, nodes, known = _components(docs, shingle, percent, matches, doc_id, text, batch_bytes, block_rows)
    grouped = nodes.select("node", F.col("least.doc").alias("doc")).join(known, "node", "left")
    grouped = grouped.select("node", "doc", F.coalesce("component", "node").alias("component"))
    least = grouped.groupBy("component").agg(F.min("doc").alias("component_id"))
    by_node = grouped.join(least, "component").select("node", "component_id")
    result = (
        every.select("doc", "mark", "n_shingles", F.xxhash64("print").alias("node"))
        .distinct()
        .join(by_node, "node")
        .select(F.col("doc").alias("__doc"), F.col("mark").alias("__mark"), "n_shingles", "component_id")
    )
    own = F.col(f"`{doc_id}`").cast("bigint")
    # Hashed before the join, so that a text that nobody selects is not shuffled.
    marked = docs.withColumns({"__id": own, "__hash": F.xxhash64(text)})
    joined = marked.join(result, (F.col("__id") == F.col("__doc")) & (F.col("__hash") == F.col("__mark")), "left")
    component = F.coalesce("component_id", own)
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.when(own.isNotNull(), F.coalesce("n_shingles", F.lit(0).cast("bigint"))).alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == own, F.lit(True)).alias("kept"),
    )


def _components(
    docs: DataFrame, shingle: int, percent: int, matches: int, doc_id: str, text: str, batch_bytes: int, block_rows: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All texts, the distinct sets among them, and the group of each set that has links."""
    every = stage_table(summaries(docs, shingle, doc_id, text, batch_bytes), "summaries")
    nodes = every.groupBy(F.xxhash64("print").alias("node")).agg(
        F.min(F.struct("doc", "mark")).alias("least"),
        *[F.any_value(c).alias(c) for c in ("n_shingles", "signature", *_SKETCH)],
    )
    nodes = stage_table(in_few_tasks(nodes, every.count()), "nodes")
    postings = stage_table(_postings(nodes, percent, matches, block_rows), "postings")
    # Most sets that share postings are like none of those they share them with: they end here.
    alone = postings.withColumn("component", F.col("node"))
    postings = stage_table(_open(alone, nodes, percent, matches), "near")
    lists = postings.groupBy("node").agg(F.collect_list("token").alias("tokens"))
    posted = nodes.join(lists, "node").select("node", "least.*", "n_shingles", "tokens", *_SKETCH)
    posted = stage_table(in_few_tasks(posted, nodes.count()), "posted")
    count = posted.count()
    # Every round looks up sets, so they lie in buckets and only pairs travel.
    wanted = stage_table(posted.select("node", "doc", "mark"), "wanted")
    sets = _full_sets(docs, wanted, shingle, doc_id, text, batch_bytes)
    sets = stage_bucketed(sets, "sets", "node", blocks.block_count(count, block_rows))

    # One round over all lists; then only postings go on that another group may still reach.
    known = None
    for turn in range(_STAR_ROUNDS):
        pairs = _nearest_leaders(_grouped(postings, known, turn, count), posted, max(matches, _ALIKE), not turn, count)
        known = _joined(known, _confirm(pairs, sets, percent, count), count, count)
        if not turn:
            postings = stage_table(_open(_grouped(postings, known, 0, count), posted, percent, matches), "open")

    judged = posted.select("node", "n_shingles", "tokens", *_SKETCH).join(sets.select("node", "bits"), "node")
    rows = _grouped(postings, known, 0, count).drop("leader", "width", "reach").join(judged, "node")
    # The likeliest pair of any two groups first: where it is a link, the others need no look.
    pairs = stage_table(_cross_pairs(rows, percent, matches), "cross")
    order = F.struct("agree", "a", "b")
    best = _apart(pairs, known).groupBy("low", "high").agg(F.max_by(F.struct("a", "b"), order).alias("pair"))
    met = pairs.count()
    known = _joined(known, _confirm(best.select("pair.*"), sets, percent, met), met, count)
    rest = _apart(pairs, known).select("a", "b")
    return every, nodes, _joined(known, _confirm(rest, sets, percent), met, count)


def _joined(known: DataFrame | None, links: DataFrame, more: int, count: int) -> DataFrame:
    """The groups of ``known``, of ``count`` sets at most, after up to ``more`` further links.

    Each set's edge to the least of its group stands for the links before.
    """
    if known is not None:
        links = known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)
    return stage_table(in_few_tasks(components(links, rows=count + more), count), "known")
