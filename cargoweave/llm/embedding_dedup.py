"""Near duplicates among vectors by collision-counting projections."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cargoweave.llm.common import staged
from cargoweave.llm.graph import components

COSINE = 0.98
#: Projections whose query-centred windows are counted.
COUNTED = 64
#: Half a window: the distance of two unit vectors at the threshold.
WINDOW = math.sqrt(2 - 2 * COSINE)
#: Share of linked pairs the count may miss.
MISSED = 1e-6
#: Pairs are only looked at within cells: TABLES times, GATES projections are cut into
#: stretches of CELL, with an offset by chance. A pair at the threshold shares a stretch
#: with probability 0.89, all ten with 0.32, and none of 32 tables with 4e-6.
TABLES, GATES, CELL = 32, 10, 1.5
#: Vectors of a cell that meet each other in one go.
BLOCK = 512
_SEED = 977


def least_collisions() -> int:
    """The largest count that pairs at the threshold reach with probability 1 - MISSED.

    The difference of two projections is normal, with the distance as its deviation, so a
    pair at the threshold collides in a window with probability erf(1 / sqrt 2).
    """
    p, below = math.erf(WINDOW / math.sqrt(2 - 2 * COSINE) / math.sqrt(2)), 0.0
    for k in range(COUNTED + 1):
        below += math.comb(COUNTED, k) * p**k * (1 - p) ** (COUNTED - k)
        if below > MISSED:
            return k
    return COUNTED


@cache
def _directions(size: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([_SEED, size])
    return random.standard_normal((size, COUNTED + TABLES * GATES)), random.uniform(0, CELL, TABLES * GATES)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def project(vectors: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors to (places on the counted projections, a cell for each table)."""
    directions, offsets = _directions(vectors.shape[1])
    places = vectors @ directions
    stretches = np.floor((places[:, COUNTED:] + offsets) / CELL).astype(np.int64).astype(np.uint64)
    cells = np.empty((len(vectors), TABLES), np.uint64)
    for t in range(TABLES):
        h = _mixed(label.astype(np.int64).astype(np.uint64) * np.uint64(TABLES) + np.uint64(t) + np.uint64(vectors.shape[1] << 40))
        for g in range(GATES):
            h = _mixed(h + stretches[:, t * GATES + g])
        cells[:, t] = h
    return places[:, :COUNTED].astype(np.float32), cells.view(np.int64)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel(), kind))


def _matrix(column: pa.Array, kind) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind, copy=False)


def _projected(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(3).value_lengths().to_numpy()
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                vectors = _matrix(part.column(3), np.float64)
                vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
                vectors /= np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
                places, cells = project(vectors, part.column(2).to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), _lists(vectors, pa.float64()), _lists(places, pa.float32()), _lists(cells, pa.int64())],
                    ["node", "copies", "unit", "places", "cells"],
                )

    return nodes.select("node", "copies", "label", F.col("embedding").cast("array<double>")).mapInArrow(
        run, "node long, copies long, unit array<double>, places array<float>, cells array<long>"
    )


def _links(nodes: np.ndarray, block: np.ndarray, cross: bool, table: int, copies, unit, places, cells):
    """(node, smallest node of its group, linked copies) of the links one cell owns.

    Pairs that collide in enough windows are verified by cosine. A pair that shares cells of
    several tables belongs to the first of them, so none counts twice.
    """
    n, least = len(nodes), least_collisions()
    left, right = [], []
    for k in range(0, n, 64):
        near = (np.abs(places[k : k + 64, None, :] - places[None, :, :]) <= WINDOW).sum(axis=2) >= least
        i, j = np.nonzero(near)
        i += k
        keep = (i < j) & (block[i] != block[j]) if cross else i < j
        left.append(i[keep])
        right.append(j[keep])
    i, j = np.concatenate(left), np.concatenate(right)
    good = np.empty(len(i), bool)
    for k in range(0, len(i), 65536):
        a, b = i[k : k + 65536], j[k : k + 65536]
        good[k : k + 65536] = (np.einsum("ij,ij->i", unit[a], unit[b]) >= COSINE) & ~(cells[a, :table] == cells[b, :table]).any(axis=1)
    i, j = i[good], j[good]
    if not len(i):
        return None
    links = np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)
    first = np.arange(n)
    while True:  # smallest place reachable within the cell
        before = first.copy()
        low = np.minimum(first[i], first[j])
        np.minimum.at(first, i, low)
        np.minimum.at(first, j, low)
        first = first[first]
        if (first == before).all():
            break
    has = np.flatnonzero(links > 0)
    return nodes[has], nodes[first[has]], links[has].astype(np.int64)


def _cell_links(members: DataFrame) -> DataFrame:
    names = ["cell", "one", "two", "table", "block", "node", "copies", "unit", "places", "cells"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held is not None else pa.Table.from_batches([batch])
            held, found = _complete(held, False)
            yield from found
        if held is not None:
            yield from _complete(held, True)[1]

    def _complete(rows: pa.Table, all_: bool):
        """Take the groups that are whole off a sorted table; the last may go on in the next batch."""
        batch = rows.combine_chunks().to_batches()
        if not batch:
            return rows, []
        batch = batch[0]
        keys = np.stack([batch.column(k).to_numpy() for k in range(3)])
        edges = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [batch.num_rows]])
        table, block, node, copies = (batch.column(k).to_numpy() for k in range(3, 7))
        out = []
        stop = len(edges) - 1 if all_ else len(edges) - 2
        for a, b in zip(edges[:stop], edges[1 : stop + 1]):
            if b - a > 1:
                part = batch.slice(a, b - a)
                found = _links(
                    node[a:b], block[a:b], keys[1, a] != keys[2, a], table[a], copies[a:b],
                    _matrix(part.column(7), np.float64), _matrix(part.column(8), np.float32), _matrix(part.column(9), np.int64),
                )
                if found:
                    out.append(pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["node", "other", "links"]))
        return rows.slice(int(edges[stop])), out

    return (
        members.select(*names).repartition("cell", "one", "two").sortWithinPartitions("cell", "one", "two")
        .mapInArrow(run, "node long, other long, links long")
    )


def near_vectors(vectors: DataFrame) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors of one label (not NULL) and one size are linked from COSINE on. Equal vectors are
    one node with a number of copies, so a group of them costs one vector; n_links counts
    every copy. Cells with many vectors are compared in blocks that are spread over tasks.
    Vectors that are NULL, empty, zero, or hold NULL, NaN or infinite components link with
    nothing. component_id is the smallest vec_id reachable; a NULL vec_id is smaller than
    none, has component_id only through others, and is not kept. Repeated rows count as copies.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    fit = F.coalesce(
        F.col("label").isNotNull()
        & F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
        & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    nodes = staged(
        rows.where(fit).groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    projected = staged(_projected(nodes), "projected")
    members = projected.select("node", F.posexplode("cells").alias("table", "cell"))
    sizes = members.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    pairs = (
        members.join(sizes, "cell").withColumn("parts", parts)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("with", other)
        .select("cell", "table", "node", "block", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("two"))
    )
    found = staged(_cell_links(pairs.join(projected, "node")), "links")
    groups = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = staged(
        nodes.join(groups, "node", "left").join(counts, "node", "left")
        .select("label", "embedding", "first", "copies", F.coalesce("component", "node").alias("group"), F.coalesce("links", F.lit(0)).alias("links")),
        "known",
    )
    smallest = known.groupBy("group").agg(F.min("first").alias("component_id"))
    known = known.join(smallest, "group").select(
        "label", "embedding", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links")
    )
    key = F.when(fit, F.col("embedding"))
    return (
        rows.withColumn("embedding", key).join(known, ["label", "embedding"], "left")
        .withColumn("component_id", F.coalesce("component_id", "vec_id"))
        .select(
            "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
            F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
        )
    )
