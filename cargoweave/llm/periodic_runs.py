"""Stretches of text that repeat themselves, found tile by tile for each octave of periods."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cargoweave.llm.common import staged

#: A run has at least so many periods, and so many words.
LEAST_EXPONENT, LEAST_LENGTH = 4, 6
#: Words of documents that are looked through together.
BATCH_WORDS = 500_000
#: Boundaries of a tile.
TILE = 8
_RANDOM = np.random.default_rng(20240613)
_SEEDS = _RANDOM.integers(0, 2**63, 2, dtype=np.uint64) | np.uint64(1)


def words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of the text."""
    return (text or "").encode("utf-8", "replace").split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _inverse(odd: int) -> int:
    """The inverse of an odd number among those of 64 bits."""
    return pow(odd, -1, 2**64)


def seeds(documents: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """(document, octave, boundary) where 2 * 2**octave words from a boundary on equal those some
    period of the octave later, as far as a hash of them tells.

    Boundaries of the octave of P = 2**octave are the multiples of P, its periods P to 2P - 1. In
    a run of period q every word but the last q equals the one q later; these are 3q or more
    in a row, so that 2P of them begin at a boundary. No run is without a seed.
    """
    order = sorted(range(len(documents)), key=lambda k: -len(documents[k]))
    sizes = np.array([len(documents[k]) for k in order], np.int64)
    flat = np.concatenate([documents[k] for k in order]) if order else np.empty(0, np.int64)
    starts = np.cumsum(sizes) - sizes
    ratio = _SEEDS[0]
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(flat), ratio)]))
        back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(flat), np.uint64(_inverse(int(ratio))))]))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(flat.astype(np.uint64) + _SEEDS[1]) * powers[:-1])])
        octave = 0
        while True:
            p = 1 << octave
            counts = np.where(sizes >= LEAST_EXPONENT * p, sizes // p - 2, 0)  # 2P words, one period later
            counts = np.maximum(counts, 0)
            if not counts.any():
                return
            block = (sums[2 * p :] - sums[: -2 * p]) * back[: len(sums) - 2 * p]
            document = np.repeat(np.arange(len(sizes)), counts)
            nth = np.arange(len(document)) - np.repeat(np.cumsum(counts) - counts, counts)
            local = nth * p
            place = starts[document] + local
            rows = max(1, 2**18 // p)
            for k in range(0, len(place), rows):
                here = place[k : k + rows]
                later = np.minimum(here[:, None] + np.arange(p, 2 * p), len(block) - 1)
                b, d = np.nonzero(block[here][:, None] == block[later])
                b += k
                whole = local[b] + 2 * p + p + d <= sizes[document[b]]
                for row in np.unique(b[whole]).tolist():
                    yield order[document[row]], octave, int(local[row])
            octave += 1


def z_function(s: list[int]) -> list[int]:
    """How many symbols from each place on equal those at the beginning."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def solve(tile: list[int], octave: int, boundaries: list[int], tile_start: int = 0) -> Iterator[tuple[int, int, int]]:
    """(period, start, end) of the stretches around boundaries in which each word equals the one a
    period later, clipped to P words before a boundary and 3P behind.

    Two Z-functions of a boundary give the reach of all periods of the octave at once: one of the
    words behind it, one of the reversed words before. Where a smaller period does it, the stretch
    belongs to that one and is left out.
    """
    p = 1 << octave
    for boundary in boundaries:
        at = boundary - tile_start
        ahead = z_function(tile[at : at + 5 * p])
        before = tile[max(0, at - p) : at][::-1]
        behind = z_function([*before, -1, *tile[max(0, at - p) : at + 2 * p][::-1]])
        around = tile[max(0, at - p) : at + 2 * p]
        for period in range(p, min(2 * p, len(ahead))):
            reach = ahead[period]
            if reach < 2 * p or any(period % d == 0 and ahead[d] >= period - d for d in _divisors(period)):
                continue
            # reversed, the words that end a period behind the boundary start there
            shift = len(before) + 1 + len(around) - (at - max(0, at - p)) - period
            yield period, boundary - min(behind[shift], len(before)), boundary + min(reach, 3 * p)


def _divisors(n: int, known: dict[int, tuple[int, ...]] = {}) -> tuple[int, ...]:  # noqa: B006  # remembered, at most one entry a period
    """The proper divisors of a number."""
    if n not in known:
        if len(known) > 100_000:
            known.clear()
        small = [d for d in range(1, int(n**0.5) + 1) if n % d == 0]
        known[n] = tuple(sorted({d for x in small for d in (x, n // x)} - {n}))
    return known[n]


def repeat_end(numbers: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The contract's change: in one of ten documents the words from a place on become repeats."""
    n = len(numbers)
    if doc_id is None or not n:
        return numbers
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return numbers
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    out = numbers.copy()
    out[a:] = numbers[a + np.arange(n - a) % p]
    return out


_TILES = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("n_words", T.LongType()), T.StructField("octave", T.IntegerType()), T.StructField("tile_start", T.LongType()),
    T.StructField("boundaries", T.ArrayType(T.LongType())), T.StructField("tile", T.ArrayType(T.IntegerType())),
])


def tiles(docs: DataFrame, change=None, of_text=None) -> DataFrame:
    """Rows of two kinds, of ``docs`` (row, doc_id, text): one of each document, and one of each
    of its tiles that has a seed.

    A document's row has row, doc_id, text and n_words; octave is NULL if it has no tile, else -1.
    Its text is that of the words after ``change``, joined by one space; of a document without
    a tile it is what ``of_text`` makes of that. A tile's row has row,
    octave, tile_start (word number), the boundaries with a seed and the tile's words as
    numbers. A tile has TILE boundaries and reaches one P before the first and five behind the last,
    so tiles overlap by as much as a fragment can reach over.
    """

    def looked(ids: list, kept: list[list[bytes]], rows: list[int]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        numbers, changed = [], []
        for doc_id, own in zip(ids, kept):
            plain = np.array([number.setdefault(w, len(number)) for w in own], np.int64)
            numbers.append(plain if change is None else change(plain, doc_id))
            changed.append(numbers[-1] is not plain)
        out: list[tuple] = []
        grouped: dict[tuple[int, int, int], set[int]] = {}
        for k, octave, boundary in seeds(numbers):
            grouped.setdefault((k, octave, (boundary >> octave) // TILE), set()).add(boundary)
        seeded = {k for k, _, _ in grouped}
        names = list(number)
        for k, (row, doc_id, own) in enumerate(zip(rows, ids, kept)):
            spoken = [names[w] for w in numbers[k]] if changed[k] else own
            text = b" ".join(spoken).decode("utf-8", "replace")
            if of_text is not None and k not in seeded:
                text = of_text(text)
            out.append((row, doc_id, text, len(own), -1 if k in seeded else None, None, None, None))
        held = 0
        for (k, octave, nth), boundaries in grouped.items():
            p = 1 << octave
            start = max(0, nth * TILE * p - p)
            tile = numbers[k][start : (nth * TILE + TILE - 1 + 5) * p]
            out.append((rows[k], None, None, None, octave, start, sorted(boundaries), tile))
            held += len(tile)
            if held > BATCH_WORDS:
                yield batch_of(out)
                out, held = [], 0
        yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[]] * len(_TILES)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _TILES.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids, kept, held = [], [], [], 0
        for batch in batches:
            for row, doc_id, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                rows.append(row.as_py())
                ids.append(doc_id.as_py())
                kept.append(words(text.as_py()))
                held += len(kept[-1])
                if held >= BATCH_WORDS or len(rows) >= BATCH_WORDS // 10:
                    yield from looked(ids, kept, rows)
                    rows, ids, kept, held = [], [], [], 0
        if rows:
            yield from looked(ids, kept, rows)

    return docs.select("row", "doc_id", "text").mapInArrow(run, _TILES)


def fragments(tiled: DataFrame) -> DataFrame:
    """(row, period, start, end): what each tile (row, octave, tile_start, boundaries, tile) tells
    alone, of its own periods."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for row, octave, start, boundaries, tile in zip(*(c.to_pylist() for c in batch.columns)):
                ends: dict[int, tuple[int, int]] = {}
                for period, a, b in solve(tile, octave, boundaries, start):
                    if period in ends and a <= ends[period][1]:
                        ends[period] = ends[period][0], max(b, ends[period][1])
                        continue
                    if period in ends:
                        out.append((row, period, *ends[period]))
                    ends[period] = a, b
                out += [(row, period, a, b) for period, (a, b) in ends.items()]
            columns = [pa.array([x[k] for x in out], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "period", "start", "end"])

    return tiled.select("row", "octave", "tile_start", "boundaries", "tile").mapInArrow(run, "row long, period long, start long, end long")


def stitched(found: DataFrame) -> DataFrame:
    """(row, period, start, length) of the runs: fragments of a document and period that overlap
    or touch are one, and it counts if it is long enough."""
    own = Window.partitionBy("row", "period").orderBy("start", "end")
    reach = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    joined = (
        found.withColumn("new", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1)))
        .withColumn("nth", F.sum("new").over(own))
        .groupBy("row", "period", "nth").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    length = F.col("end") - F.col("start") + F.col("period")
    return joined.select("row", "period", "start", length.alias("length")).where(
        F.col("length") >= F.greatest(F.lit(LEAST_LENGTH).cast("long"), LEAST_EXPONENT * F.col("period"))
    )


def _numbered(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text), every row with a number of its own that a repeated task gives again,
    as the rows are written first."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.withColumn("row", F.monotonically_increasing_id())


def _runs_column() -> Column:
    """The runs of a row as a sorted array of (start, period, length)."""
    return F.array_sort(F.collect_list(F.struct("start", "period", "length")))


def periodic_runs(docs: DataFrame, change=None, of_text=None) -> DataFrame:
    """doc_id, n_words, runs and collapsed of ``docs`` (doc_id, text), row by row.

    A run is a stretch of words with smallest period q that is LEAST_EXPONENT * q words long or
    more, LEAST_LENGTH at least, and cannot be made longer; runs is an array of (start, period,
    length) in that order. ``collapsed`` is the words joined by one space, without those of each
    run behind its first period, or what ``of_text`` makes of that text (its hash, for example)
    where it is made, so that texts that are not wanted are not written. NULL and empty texts
    have no words and no runs; repeated rows each have theirs; NULL ids are ids like others;
    ``change`` (numbers of words, doc_id) may replace words by others of the text beforehand.
    Other columns are left out.

    Documents are looked through for seeds, and exploded into the tiles that have one; tiles are
    dealt out and solved alone; fragments are shuffled by document and period and stitched, and
    documents with runs meet them by their row.
    """
    found = staged(tiles(_numbered(docs), change, of_text), "tiles")
    spread = found.where("octave >= 0").repartition("row", "octave", "tile_start")
    runs = stitched(fragments(spread)).groupBy("row").agg(_runs_column().alias("runs"))
    none = F.array().cast("array<struct<start:bigint,period:bigint,length:bigint>>")
    plain = found.where("octave is null").select("doc_id", "n_words", none.alias("runs"), F.col("text").alias("collapsed"))
    seeded = found.where("octave = -1").select("row", "doc_id", "text", "n_words").join(runs, "row", "left")
    return plain.unionByName(_collapsed(seeded.select("doc_id", "n_words", F.coalesce("runs", none).alias("runs"), "text"), of_text))


def _collapsed(seeded: DataFrame, of_text) -> DataFrame:
    """The texts without what their runs drop, in place of the whole ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in zip(batch.column(3), batch.column(2).to_pylist()):
                spoken = text.as_py().encode().split()
                edges = np.zeros(len(spoken) + 1, np.int64)
                for r in runs:
                    edges[r["start"] + r["period"]] += 1
                    edges[r["start"] + r["length"]] -= 1
                keeps = np.cumsum(edges[:-1]) == 0
                left = b" ".join([w for w, k in zip(spoken, keeps.tolist()) if k]).decode()
                out.append(left if of_text is None else of_text(left))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.string())], [*batch.schema.names[:3], "collapsed"])

    schema = T.StructType([*seeded.schema.fields[:3], T.StructField("collapsed", T.StringType())])
    return seeded.mapInArrow(run, schema)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period) and hashes of all runs
    and of the collapsed text, after ``repeat_end``."""
    rows = periodic_runs(docs, repeat_end, _sha256)
    best = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.withColumn("best", F.get(best, F.lit(0))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"), (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"), F.floor(-F.col("best.l") * 1000 / F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(line, ""), "UTF-8"), 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )
