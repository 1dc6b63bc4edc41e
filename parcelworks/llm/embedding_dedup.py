"""Near-equal vectors: spherical k-means cells, blocked cosine products inside cells."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelworks.llm.components import components
from parcelworks.llm.names import sets_aside
from parcelworks.session import stage_table

_FOUND = "vec bigint, links bigint, least bigint"


def _matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = pc.list_flatten(column)
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    return np.asarray(flat.to_numpy(zero_copy_only=False), dtype=np.float64).reshape(rows, -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_cells(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of at most ``cells`` cells by spherical k-means."""
    x = _unit(sample)
    centres = np.unique(x[:: max(1, len(x) // cells)][:cells], axis=0)
    for _ in range(rounds):
        nearest = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        size = np.sqrt((sums * sums).sum(axis=1))
        centres[size > 1e-9] = sums[size > 1e-9] / size[size > 1e-9, None]
    return np.unique(centres, axis=0)


def _place(x: np.ndarray, centres: np.ndarray, gaps: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each vector, and the other cells whose border is within ``reach``.

    Two unit vectors no further apart than 2 * ``reach`` lie in one cell, or one of them is
    within ``reach`` of the border between their cells.
    """
    near = x @ centres.T
    home = near.argmax(axis=1)
    close = near[np.arange(len(x)), home][:, None] - near <= reach * gaps[home]
    close[np.arange(len(x)), home] = False
    return home, close


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(table: pa.Table) -> pa.Table | None:
    parts = [pa.ipc.open_stream(x.as_buffer()).read_all() for x in table["data"]]
    return pa.concat_tables(parts) if parts else None


def _compare(table: pa.Table, threshold: float, step: int = 2048) -> pa.Table:
    """Links between the targets and the probes of one block of a cell."""
    targets, probes = (_unpacked(table.filter(pc.equal(table["target"], side))) for side in (True, False))
    if targets is None or probes is None:
        return pa.table({"vec": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "least": pa.array([], pa.int64())})
    targets = targets.combine_chunks()
    x, y = (_unit(_matrix(t["vector"], len(t))) for t in (targets, probes))
    ids, other = targets["vec"].to_numpy(), probes["vec"].to_numpy()
    copies, other_copies = targets["copies"].to_numpy(), probes["copies"].to_numpy()
    home = probes["own_cell"].to_numpy()
    guest = home != table["cell"][0].as_py()
    # A guest counts its links here unless the target visits the guest's cell too.
    reach = targets["reach"].chunk(0)
    row = np.repeat(np.arange(len(targets)), pc.list_value_length(reach).to_numpy(zero_copy_only=False))
    seen = np.sort(row.astype(np.int64) << 32 | pc.list_flatten(reach).to_numpy(zero_copy_only=False))
    links, guest_links = np.zeros(len(ids), np.int64), np.zeros(len(other), np.int64)
    edges = [np.zeros((2, 0), np.int64)]
    for lo in range(0, len(other), step):
        hi = min(lo + step, len(other))
        i, j = np.nonzero(x @ y[lo:hi].T >= threshold)
        j += lo
        real = ids[i] != other[j]
        i, j = i[real], j[real]
        links += np.bincount(i, other_copies[j], len(ids)).astype(np.int64)
        key = i.astype(np.int64) << 32 | home[j]
        at = np.minimum(np.searchsorted(seen, key), max(0, len(seen) - 1))
        visits = seen[at] == key if len(seen) else np.zeros(len(key), bool)
        alone = guest[j] & ~visits
        guest_links += np.bincount(j[alone], copies[i[alone]], len(other)).astype(np.int64)
        # Of the pairs of a step only the least vector that each one reaches by them is kept.
        least, other_least = ids.copy(), other.copy()
        while True:
            before = least.copy(), other_least.copy()
            np.minimum.at(least, i, other_least[j])
            np.minimum.at(other_least, j, least[i])
            if (before[0] == least).all() and (before[1] == other_least).all():
                break
        edges += [np.stack([a[a != b], b[a != b]]) for a, b in ((ids, least), (other, other_least))]
    vec, least = np.unique(np.concatenate(edges, axis=1), axis=1)
    counted = np.concatenate([ids, other]), np.concatenate([links, guest_links])
    some = counted[1] > 0
    return pa.table(
        {
            "vec": np.concatenate([counted[0][some], vec]),
            "links": np.concatenate([counted[1][some], np.zeros(len(vec), np.int64)]),
            "least": np.concatenate([counted[0][some], least]),
        }
    )


@sets_aside("__node")
def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.95,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    cell_rows: int = 2048,
    most_cells: int = 1024,
    sample_rows: int = 16_384,
    block_rows: int = 2048,
) -> DataFrame:
    """``n_links``, ``component_id`` and ``kept`` per vector, by cosine in double precision.

    Cells are fitted on at most ``sample_rows`` vectors, picked by a hash of the id; every
    vector is placed. A vector also visits each cell whose border is so near that a link
    may cross it, so no link is lost: cells only spare comparisons. Equal vectors are
    compared once. Cells are cut into blocks of about ``block_rows``; the products of two
    blocks are one unit of work, and only counts and group labels leave it. Up to
    ``cell_rows * most_cells`` vectors a cell holds about ``cell_rows``; beyond it cells
    grow, and with them the products per vector.

    ``n_links`` counts other rows linked directly, ``component_id`` is the least id
    reachable (itself included), ``kept`` marks that row. Null or empty vectors, vectors
    with null or non-finite parts and zero vectors link with nothing; vectors of different
    lengths neither. Rows that share an id and a vector count as rows of their own; a null
    id links with nothing and is kept. Other input columns stay, but for those named like
    an added one; an empty table gives an empty table.
    """
    spark = vectors.sparkSession
    added = ["n_links", "component_id", "kept"]
    vectors = vectors.select(*[F.col(f"`{c}`") for c in vectors.columns if c not in added])
    own, body = F.col(f"`{vec_id}`").cast("bigint"), F.col(f"`{vector}`")
    kind = vectors.schema[vector].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    usable = F.forall(body, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    usable = usable & F.exists(body, lambda v: v != 0) & own.isNotNull()
    # Adding zero makes -0 and 0 one.
    clean = F.transform(body, lambda v: v.cast(kind) + F.lit(0).cast(kind))
    rows = vectors.where(usable).select(own.alias("vec"), clean.alias("vector"))
    nodes = rows.groupBy("vector").agg(F.min("vec").alias("vec"), F.count(F.lit(1)).alias("copies"))
    # Equal ids with different vectors must not become one node.
    nodes = stage_table(nodes.withColumn("node", F.xxhash64("vector")), "vectors")
    result = None
    for size, count in [(r["size"], r["n"]) for r in nodes.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()]:
        mine = nodes.where(F.size("vector") == size)
        found = _links(mine, count, threshold, kind, cell_rows, most_cells, sample_rows, block_rows)
        result = found if result is None else result.unionByName(found)
    if result is None:
        result = spark.createDataFrame([], "node bigint, links bigint, component bigint")
    labelled = nodes.join(result, "node", "left").select(
        "node", "vec", "vector", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component")
    )
    least = labelled.groupBy("component").agg(F.min("vec").alias("component_id"))
    labelled = labelled.join(least, "component").select(
        F.col("node").alias("__node"), (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    joined = vectors.join(labelled, usable & (F.xxhash64(clean) == F.col("__node")), "left")
    component = F.coalesce("component_id", own)
    return joined.select(
        *[F.col(f"`{c}`") for c in vectors.columns],
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == own, F.lit(True)).alias("kept"),
    )


def _links(
    nodes: DataFrame,
    count: int,
    threshold: float,
    kind: str,
    cell_rows: int,
    most_cells: int,
    sample_rows: int,
    block_rows: int,
    place_rows: int = 2048,
) -> DataFrame:
    """``node``, ``links`` and ``component`` of the distinct vectors (of one length) with links."""
    sample = nodes.orderBy("node").limit(sample_rows).select("vector").collect()
    cells = max(1, min(most_cells, math.ceil(count / cell_rows)))
    centres = fit_cells(np.array([r["vector"] for r in sample], dtype=np.float64), cells)
    gaps = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
    reach = 0.5 * math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    sent = nodes.sparkSession.sparkContext.broadcast((centres, gaps))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, between = sent.value
        # A vector may visit many cells, so few are placed at a time.
        for batch in (b.slice(lo, place_rows) for b in batches for lo in range(0, b.num_rows, place_rows)):
            home, close = _place(_unit(_matrix(batch.column("vector"), batch.num_rows)), middle, between, reach)
            row, cell = np.nonzero(close)
            cuts = pa.array(np.searchsorted(row, np.arange(len(home) + 1)), pa.int32())
            rows = pa.table(
                {
                    "vec": batch.column("node"),
                    "own_cell": pa.array(home, pa.int32()),
                    "copies": batch.column("copies"),
                    "vector": batch.column("vector"),
                    "reach": pa.ListArray.from_arrays(cuts, pa.array(cell, pa.int32())),
                }
            )
            out: dict[str, list] = {"cell": [], "target": [], "n": [], "data": []}
            for target, where, who in (
                (True, home, np.arange(len(home))),
                (False, np.concatenate([home, cell]), np.concatenate([np.arange(len(home)), row])),
            ):
                order = np.argsort(where, kind="stable")
                kinds, begin = np.unique(where[order], return_index=True)
                for kind, at in zip(kinds.tolist(), np.split(who[order], begin[1:]), strict=True):
                    part = rows.take(pa.array(at))
                    out["cell"].append(kind)
                    out["target"].append(target)
                    out["n"].append(len(at))
                    out["data"].append(_packed(part if target else part.drop_columns(["reach"])))
            kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))

    # Vectors of one batch and cell travel as one row.
    schema = "cell int, target boolean, n bigint, data binary"
    placed = stage_table(nodes.select("node", "copies", "vector").mapInArrow(place, schema), "placed")
    # One row per cell, of which there are at most ``most_cells``.
    counts = placed.groupBy("cell").agg(
        F.ceil(F.sum(F.when(F.col("target"), F.col("n"))) / block_rows).cast("int").alias("rows_of"),
        F.ceil(F.sum(F.when(~F.col("target"), F.col("n"))) / (8 * block_rows)).cast("int").alias("columns_of"),
    )
    placed = placed.join(F.broadcast(counts.where("rows_of > 0")), "cell")
    spread = lambda blocks: F.expr(f"cast(pmod(xxhash64(data), {blocks}) as int)")
    each = lambda blocks: F.explode(F.expr(f"sequence(0, {blocks} - 1)"))
    columns = ["cell", "target", "data"]
    targets = placed.where("target").select(*columns, spread("rows_of").alias("i"), each("columns_of").alias("j"))
    probes = placed.where("not target").select(*columns, each("rows_of").alias("i"), spread("columns_of").alias("j"))

    def compare(table: pa.Table) -> pa.Table:
        return _compare(table, threshold)

    found = targets.unionByName(probes).groupBy("cell", "i", "j").applyInArrow(compare, _FOUND)
    found = stage_table(found, "links")
    groups = components(found.select(F.col("vec").alias("a"), F.col("least").alias("b")))
    return found.groupBy(F.col("vec").alias("node")).agg(F.sum("links").alias("links")).join(groups, "node")
