"""Near duplicates by MinHash bands, odd sketches and an exact check on full shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cargoweave.llm.common import semi, staged
from cargoweave.llm.near import linked_components

SHINGLE = 5
SAMPLES = 128
#: Rows of a band. 32 bands of 4 miss a pair of similarity 0.75 with probability 5e-6.
BAND = 4
SKETCH_BITS = 512
#: Pairs whose sketches differ in more bits are dropped. At similarity 0.75 about 57 bits
#: differ, with a deviation of 10; 110 is the mean at 0.46.
MOST_ODD_BITS = 110
#: Bits of the odd sketch of a whole set. No two sets differ in fewer shingles than these sketches do
#: in bits, which tells unlike ones apart for certain.
SET_BITS = 2048
#: A link: 100 * intersection >= 75 * union.
PERCENT = 75

_RANDOM = np.random.default_rng(20240501)
_A, _B = (_RANDOM.integers(0, 2**32, SAMPLES, dtype=np.uint32) | np.uint32(1) for _ in range(2))
_MIX = _RANDOM.integers(0, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of five words of the lower-cased text.

    With one to four words the whole sequence is the only shingle; without words none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    sums = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        sums += hashes[i : len(words) - width + 1 + i] * _MIX[i]
    return np.unique(_mixed(sums))


def _minima(hashes: np.ndarray) -> np.ndarray:
    low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 2**32 - 1, np.uint32)
    for i in range(0, len(hashes), 1024):
        np.minimum(least, (_A[:, None] * low[i : i + 1024] + _B[:, None] * high[i : i + 1024]).min(axis=1), out=least)
    return least


def _odd_sketches(minima: np.ndarray) -> np.ndarray:
    """Bit p of a sketch is the parity of the number of samples that fall on p."""
    bits = _mixed(minima.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32))) % np.uint64(SKETCH_BITS)
    flat = (np.arange(len(minima))[:, None] * SKETCH_BITS + bits.astype(np.int64)).ravel()
    odd = (np.bincount(flat, minlength=len(minima) * SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(len(minima), SKETCH_BITS // 64)


def _set_sketch(hashes: np.ndarray) -> np.ndarray:
    """Bit p is the parity of the number of shingles that fall on p."""
    odd = (np.bincount((hashes >> np.uint64(17)).astype(np.int64) % SET_BITS, minlength=SET_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))


def _digest(hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, sketch, set_sketch, bands); set_key is a digest of the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, minima = [], [], np.empty((batch.num_rows, SAMPLES), np.uint32)
            whole = np.empty((batch.num_rows, SET_BITS // 64), np.int64)
            for i, text in enumerate(batch.column(1)):
                hashes = shingle_set(text.as_py())
                sizes.append(len(hashes))
                keys.append(_digest(hashes))
                minima[i] = _minima(hashes)
                whole[i] = _set_sketch(hashes)
            grouped = np.zeros((batch.num_rows, SAMPLES // BAND), np.uint64)
            for j in range(BAND):
                grouped = _mixed(grouped + minima[:, j::BAND] + np.uint64(j + 1))
            grouped = _mixed(grouped + np.arange(SAMPLES // BAND, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 _lists(_odd_sketches(minima)), _lists(whole), _lists(grouped.view(np.int64))],
                ["doc_id", "n_shingles", "set_key", "sketch", "set_sketch", "bands"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, sketch array<long>, set_sketch array<long>, bands array<long>"
    )


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(id, set_key, shingles array<long>): the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(x.as_py()) for x in batch.column(1)]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = pa.array(np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(_digest, sets), pa.binary()), pa.ListArray.from_arrays(offsets, flat)],
                ["id", "set_key", "shingles"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "id long, set_key binary, shingles array<long>"
    )


def odd_bits(left: str, right: str, bits: int = SKETCH_BITS) -> Column:
    """How many bits of two sketches differ."""
    words = [F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(bits // 64)]
    return sum(words[1:], words[0])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Rows with equal sets are one node, named by their smallest doc_id. Nodes that agree in
    a band are candidates; odd sketches drop the unlike ones; full sets confirm the rest.
    NULL and empty texts have n_shingles 0 and link with nothing. Rows without a doc_id
    link nobody and have component_id NULL and kept false. Repeated rows keep their number;
    where one doc_id has several texts, the one with the smallest set_key stands for it.
    """
    rows = staged(signatures(docs), "signatures")
    sets = rows.where("n_shingles > 0 and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("id"))
    sets = staged(sets, "sets")
    named = sets.groupBy("id").agg(F.min("set_key").alias("set_key"))
    nodes = staged(
        rows.withColumnRenamed("doc_id", "id").join(named, ["id", "set_key"], "left_semi").dropDuplicates(["id"]), "nodes"
    )
    buckets = nodes.select("id", F.explode("bands").alias("bucket"))
    measures = nodes.select("id", F.col("n_shingles").alias("n"), "sketch", "set_sketch")

    def alike(left: str, right: str) -> Column:
        """Sizes and odd sketches of the samples, then the sets' own, which never misses: of sets that
        are linked (100 - PERCENT) in (100 + PERCENT) of their shingles differ at most."""
        n, m = F.col(f"{left}n"), F.col(f"{right}n")
        return (
            (F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT)
            & (odd_bits(f"{left}sketch", f"{right}sketch") <= MOST_ODD_BITS)
            & (odd_bits(f"{left}set_sketch", f"{right}set_sketch", SET_BITS) * (100 + PERCENT) <= (n + m) * (100 - PERCENT))
        )

    def side(name: str) -> DataFrame:
        return measures.toDF(name, f"{name}_n", f"{name}_sketch", f"{name}_set_sketch")

    def verify(pairs: DataFrame) -> DataFrame:
        close = staged(
            pairs.join(side("b"), "b").join(side("a"), "a").where(alike("a_", "b_")).select("a", "b"), "close"
        )
        wanted = staged(close.select(F.col("a").alias("doc_id")).union(close.select("b")).distinct(), "wanted")
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        owned = shingle_sets(semi(texts, wanted, "doc_id"))
        owned = staged(
            owned.join(named, ["id", "set_key"], "left_semi").drop("set_key").dropDuplicates(["id"]), "shingles"
        )
        both = close.join(owned.withColumnsRenamed({"id": "b", "shingles": "sb"}), "b").join(
            owned.withColumnsRenamed({"id": "a", "shingles": "sa"}), "a"
        )
        common = F.size(F.array_intersect("sa", "sb"))
        return both.withColumn("common", common).where(
            F.col("common") * 100 >= (F.size("sa") + F.size("sb") - F.col("common")) * PERCENT
        ).select("a", "b")

    found = linked_components(
        buckets, verify,
        lambda rest: rest.join(measures, "id"),
        lambda: alike("l_", "r_"),
    )
    groups = sets.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "set_key", F.coalesce("component", "id").alias("component_id")
    )
    return (
        rows.select("doc_id", "n_shingles", "set_key").join(groups, "set_key", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose near duplicate with the smallest doc_id stays.

    Rows without a doc_id stay: nothing tells that another one stands for them.
    """
    gone = near_duplicates(docs).where("not kept and doc_id is not null").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")
