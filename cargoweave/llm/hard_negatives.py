"""Hard negatives of anchors, streamed from pair scores that the shuffle has sorted."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Anchors scored in one pass over the rows.
BLOCK_ANCHORS = 4096
#: Positives of an anchor, and negatives of a positive.
POSITIVES, NEGATIVES = 5, 10
#: Components x count as floor(SCALE * x).
SCALE = 256
#: A negative's score lies within these hundredths of its positive's.
LOW, HIGH = 30, 90
#: Vectors scored together, so that a matrix of scores has a bounded size.
ROWS = 1024
_SIGN = np.uint64(1 << 63)
_LONG = np.iinfo(np.int64)


@dataclass
class Anchors:
    """Anchors of one vector length: numbers, labels, whole components, scores of positives."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    #: For each anchor and window the lowest and highest score of a negative; low > high is none.
    low: np.ndarray = field(default=None)
    high: np.ndarray = field(default=None)


def _whole(components: np.ndarray) -> np.ndarray:
    """Each component x as floor(SCALE * x), as double."""
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(components * SCALE))


def _scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products, anchors by rows, exact: in doubles where no sum can reach 2**53, else in
    whole numbers of any size. Those beyond 64 bits take the nearest long."""
    row_most, anchor_most = np.abs(rows).max(axis=1), np.abs(anchors).max(axis=1)
    with np.errstate(all="ignore"):
        score = (anchors @ rows.T).astype(np.int64)
        if row_most.max() * anchor_most.max() * rows.shape[1] < 2**53:
            return score
        large_rows = np.flatnonzero(row_most * anchor_most.min() * rows.shape[1] >= 2**53)
        large_anchors = np.flatnonzero(anchor_most * np.delete(row_most, large_rows).max(initial=0) * rows.shape[1] >= 2**53)

    def exact(a: np.ndarray, r: np.ndarray) -> np.ndarray:
        whole = np.vectorize(int, otypes=[object])
        return np.clip(whole(a) @ whole(r).T, _LONG.min, _LONG.max).astype(np.int64)

    if len(large_rows):
        score[:, large_rows] = exact(anchors, rows[large_rows])
    if len(large_anchors):
        score[large_anchors] = exact(anchors[large_anchors], rows)
    return score


def _first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Which entries are among the first ``most`` of their group: higher scores, then smaller
    ids come first; equal entries count once."""
    by = np.lexsort((ids, ~score, group))
    g, s, i = group[by], score[by], ids[by]
    new = np.ones(len(by), bool)
    new[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1]) | (i[1:] != i[:-1])
    by, g = by[new], g[new]
    begin = np.concatenate([[True], g[1:] != g[:-1]]) if len(g) else np.empty(0, bool)
    place = np.arange(len(g)) - np.maximum.accumulate(np.where(begin, np.arange(len(g)), 0)) if len(g) else g
    return by[place < most]


class _Best:
    """The first ``most`` (score, id) of each group so far; a part of an exact answer, since what
    is not among the first here is not among the first of all."""

    def __init__(self, groups: int, most: int) -> None:
        self.most = most
        self.least = np.full(groups, _LONG.min)
        self.group, self.score, self.ids = (np.empty(0, np.int64) for _ in range(3))

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.group, self.score, self.ids = (np.concatenate(p) for p in ((self.group, group), (self.score, score), (self.ids, ids)))
        stays = _first(self.group, self.score, self.ids, self.most)
        self.group, self.score, self.ids = self.group[stays], self.score[stays], self.ids[stays]
        full = np.flatnonzero(np.diff(self.group, append=-1) != 0)  # the last of each group
        held = np.diff(np.concatenate([[-1], full]))
        self.least[self.group[full[held >= self.most]]] = self.score[full[held >= self.most]]


def pack(anchor: np.ndarray, score: np.ndarray, negative: bool, ids: np.ndarray) -> pa.Array:
    """Keys of 25 bytes whose order is anchor, descending score, positives first, id."""
    out = np.zeros((len(ids), 25), np.uint8)
    for at, values in ((0, anchor), (8, ~score), (17, ids)):
        out[:, at : at + 8] = (values.astype(np.int64).view(np.uint64) ^ _SIGN).astype(">u8")[:, None].view(np.uint8)
    out[:, 16] = negative
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(25), len(ids), [None, pa.py_buffer(out.tobytes())]).cast(pa.binary())


def unpack(key: bytes) -> tuple[int, int, bool, int]:
    """Anchor, score, whether it is a negative, id."""
    def whole(at: int) -> int:
        return int.from_bytes(key[at : at + 8], "big") - (1 << 63)
    return whole(0), ~whole(8), key[16] == 1, whole(17)


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and vectors of a batch, at most ROWS of one length at a time."""
    lists = batch.column(2)
    sizes = lists.value_lengths().to_numpy()
    flat = _whole(lists.flatten().to_numpy())
    starts = np.cumsum(sizes) - sizes
    ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    for size in np.unique(sizes):
        chosen = np.flatnonzero(sizes == size)
        for part in (chosen[k : k + ROWS] for k in range(0, len(chosen), ROWS)):
            yield ids[part], labels[part], flat[starts[part][:, None] + np.arange(size)]


def _pairs(rows: DataFrame, block: dict[int, Anchors], negatives: bool) -> DataFrame:
    """(key binary): packed pairs of one pass, of each task only those that can still count."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {
            size: _Best(len(a.ids) * (POSITIVES if negatives else 1), NEGATIVES if negatives else POSITIVES)
            for size, a in shared.value.items()
        }
        for batch in batches:
            for ids, labels, vectors in _arrays(batch):
                anchors = shared.value.get(vectors.shape[1])
                if anchors is None:
                    continue
                score, found = _scores(vectors, anchors.vectors), best[vectors.shape[1]]
                same = anchors.labels[:, None] == labels
                if negatives:
                    parts = []
                    for w in range(POSITIVES):
                        group = np.arange(len(anchors.ids)) * POSITIVES + w
                        floor = np.maximum(anchors.low[:, w], found.least[group])
                        a, r = np.nonzero(~same & (score >= floor[:, None]) & (score <= anchors.high[:, w][:, None]))
                        parts.append((group[a], score[a, r], ids[r]))
                    found.add(*map(np.concatenate, zip(*parts)))
                else:
                    a, r = np.nonzero(same & (anchors.ids[:, None] != ids) & (score >= found.least[:, None]))
                    found.add(a, score[a, r], ids[r])
        for size, found in best.items():
            owner = shared.value[size].ids[found.group // (POSITIVES if negatives else 1)]
            yield pa.RecordBatch.from_arrays([pack(owner, found.score, negatives, found.ids)], ["key"])

    return rows.mapInArrow(run, "key binary")


def _sorted_keys(pairs: DataFrame):
    """An RDD of the packed keys, all of an anchor in one partition and in order."""
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.rdd.map(lambda r: (bytes(r[0]), None)).repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:8])).keys()


def stream(keys: Iterator[bytes]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(anchor, positive, rank, negative, positive score, negative score) from sorted keys.

    A positive opens a window, which hands out ranks until it has NEGATIVES or the scores have
    fallen below it. Held are the open windows of one anchor, POSITIVES at most. Equal keys count
    once. A positive below 0 has an empty window; one of 0 comes before the negatives of 0.
    """
    anchor, last, seen, windows = None, None, 0, []
    for key in keys:
        if key == last:
            continue
        last = key
        owner, score, negative, other = unpack(key)
        if owner != anchor:
            anchor, seen, windows = owner, 0, []
        if not negative:
            if seen < POSITIVES:
                seen += 1
                windows.append([other, score, 0])
            continue
        windows = [w for w in windows if w[2] < NEGATIVES and LOW * w[1] <= 100 * score]
        for window in windows:
            if 100 * score <= HIGH * window[1]:
                window[2] += 1
                yield owner, window[0], window[2], other, window[1], score


def first_positives(keys: Iterator[bytes]) -> Iterator[tuple[int, int, int]]:
    """(anchor, positive, score) of the first POSITIVES of each anchor, from sorted keys."""
    anchor, last, seen = None, None, 0
    for key in keys:
        if key == last:
            continue
        last = key
        owner, score, _, other = unpack(key)
        anchor, seen = owner, seen + 1 if owner == anchor else 1
        if seen <= POSITIVES:
            yield owner, other, score


def comparable(rows: DataFrame, vector: str = "embedding", label: Column | None = None) -> DataFrame:
    """(vec_id, label, vector array<double>) of the rows that take part: no NULL vec_id, label or
    vector, no empty vector, and only finite components."""
    wide = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return wide.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & finite).select(
        "vec_id", "label", F.col("v").alias("vector")
    )


def _blocks(anchors: DataFrame) -> Iterator[dict[int, Anchors]]:
    """The anchors in blocks of about BLOCK_ANCHORS, one at a time on the driver."""
    one = anchors.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    blocks = -(-one.count() // BLOCK_ANCHORS)
    for block in range(blocks):
        by_size: dict[int, list] = {}
        for r in (one.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block) if blocks > 1 else one).collect():
            by_size.setdefault(len(r["row"]["vector"]), []).append((r["vec_id"], r["row"]["label"], r["row"]["vector"]))
        yield {
            size: Anchors(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), _whole(np.array([r[2] for r in rows], float)))
            for size, rows in by_size.items()
        }


def _with_windows(block: dict[int, Anchors], positives: list[tuple[int, int, int]]) -> dict[int, Anchors]:
    """The block with the scores that negatives of each positive can have."""
    scores: dict[int, list[int]] = {}
    for anchor, _, score in positives:
        scores.setdefault(anchor, []).append(score)
    for anchors in block.values():
        anchors.low = np.full((len(anchors.ids), POSITIVES), _LONG.max)
        anchors.high = np.full((len(anchors.ids), POSITIVES), _LONG.min)
        for k, i in enumerate(anchors.ids.tolist()):
            for w, score in enumerate(scores.get(i, [])):
                anchors.low[k, w], anchors.high[k, w] = -(-LOW * score // 100), HIGH * score // 100
    return block


def hard_negatives(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``rows``
    (vec_id, label long, vector array<double>), as ``comparable`` makes them; a score is the inner
    product of two vectors whose components x are taken as floor(SCALE * x).

    Anchors are the rows for which ``is_anchor`` holds. Their positives are the first POSITIVES
    other rows of the same label by score, then vec_id; for each positive the first NEGATIVES rows
    of another label follow whose score is LOW to HIGH hundredths of its own.

    Anchors are taken in blocks and scored against all rows, in two passes: of the same label, and
    then of other labels within the windows of the positives. Tasks send on only pairs that can be
    among the first of all, as packed keys; a shuffle sorts them within partitions, and an iterator
    reads them off. Rows of equal vec_id, label and vector count once, others of equal vec_id each;
    an anchor of several rows is the one of the smallest label, then vector. Vectors of different
    lengths have no score. An empty table, or one without anchors, has no result.
    """
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    out = None
    for block in _blocks(rows.where(is_anchor)):
        same = _pairs(rows, block, negatives=False)
        positives = _sorted_keys(same).mapPartitions(first_positives).collect()  # POSITIVES for each anchor of the block
        other = _pairs(rows, _with_windows(block, positives), negatives=True)
        opened = _keys(spark, positives)
        found = spark.createDataFrame(_sorted_keys(opened.unionByName(other)).mapPartitions(stream), schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], schema)


def _keys(spark, positives: list[tuple[int, int, int]]) -> DataFrame:
    anchor, ids, score = (np.array([p[k] for p in positives], np.int64) for k in range(3))
    return spark.createDataFrame(pa.table({"key": pack(anchor, score, False, ids)}))


def mined(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of ``embeddings`` (vec_id, label, embedding): where vec_id is divisible by 7
    the label is the next of ten, and rows whose vec_id is divisible by 100 are the anchors."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(comparable(embeddings, label=moved), F.col("vec_id") % 100 == 0)
