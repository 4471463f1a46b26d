"""Lines that repeat, exactly or within a few edits, by a segment-partition join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cargoweave.llm.common import semi, staged, text_batches
from cargoweave.llm.near import linked_components

#: Every line that is not empty is compared.
LEAST_CHARS = 1
#: Edits (insert, delete, replace a character) up to which two lines are the same.
EDITS = 2
#: The shorter line allows one edit for so many characters, at most EDITS: any two lines of
#: three characters with one in common are within 2 edits.
CHARS_PER_EDIT = 8
#: Lines from here on allow all EDITS.
LEAST_EDIT_CHARS = EDITS * CHARS_PER_EDIT
#: Bits of a line's sketch: the parity of how many pairs of neighbouring characters fall on each.
#: An edit changes two such pairs into two others at most, four bits.
SKETCH_BITS, BITS_OF_EDIT = 128, 4
#: Bits of the map of shared segments that all tasks get: 2 MB, whatever the input.
MAP_BITS = 24

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (_BASE, _INVERSE)
            )
        return self.up, self.down


_POWERS = _Powers()


def same(a: str, b: str) -> bool:
    """Whether two lines are within the edits that the shorter one allows."""
    return within(a, b, min(EDITS, min(len(a), len(b)) // CHARS_PER_EDIT))


def selections(edits: int) -> list[tuple[int, int, int]]:
    """(length difference, segment, shift): where a line has to look for the segments of a
    line that is shorter by the difference, so that no pair within ``edits`` is missed.

    Segment i (from 0) of the shorter line can have moved by at most i to either side when
    counted from the left, and by edits - i when counted from the right.
    """
    return [
        (d, i, s)
        for d in range(edits + 1) for i in range(edits + 1)
        for s in range(max(-i, d - (edits - i)), min(i, d + (edits - i)) + 1)
    ]


def segment_keys(lines: list[str], edits: int = EDITS) -> tuple[np.ndarray, np.ndarray]:
    """(place of the line, key) for every selection of every line that allows an edit.

    A line of n characters that allows k edits, at most ``edits``, is cut into k + 1 segments
    as even as can be, the longer ones last. A key is made of the length of the shorter line,
    which tells k, the segment's number and its characters, so two lines within k share one.
    """
    if not lines:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    begins = np.cumsum(lengths) - lengths
    up, down = _POWERS.upto(len(codes) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)])])
    at, keys = [], []
    for allowed, difference, segment, shift in [(k, *x) for k in range(1, edits + 1) for x in selections(k)]:
        count = allowed + 1
        shorter = lengths - difference
        small, longer = shorter // count, shorter % count
        size = small + (segment >= count - longer)
        place = segment * small + np.maximum(0, segment - (count - longer)) + shift
        fits = np.minimum(edits, shorter // CHARS_PER_EDIT) == allowed
        ok = np.flatnonzero(fits & (place >= 0) & (place + size <= lengths))
        start = begins[ok] + place[ok]
        inner = (sums[start + size[ok]] - sums[start]) * down[start]
        at.append(ok)
        keys.append(_mixed(inner + _mixed((shorter[ok] * count + segment).astype(np.uint64))).view(np.int64))
    return np.concatenate(at), np.concatenate(keys)


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``: bit-parallel over the diagonal band.

    Bits stand for the rows of the band, which moves down by one with each character of the
    longer text; vertical differences of +1 and -1 are kept as two bit sets.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > edits:
        return False
    same = 0
    for x, y in zip(a, b):
        if x != y:
            break
        same += 1
    a, b = a[same:], b[same:]
    same = 0
    for x, y in zip(reversed(a), reversed(b)):
        if x != y:
            break
        same += 1
    a, b = a[: len(a) - same], b[: len(b) - same]
    if not a:
        return len(b) <= edits
    if len(b) <= edits:
        return True
    # rows j-edits .. j+edits of column j; the bit of row r is r - j + edits
    width = 2 * edits + 1
    full = (1 << width) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << (i + edits)
    plus, minus = full ^ ((1 << edits) - 1), 0  # column 0: rows above 0 do not exist, those below grow by 1
    rows = len(a)
    bottom = min(edits, rows)  # distance at the band's lowest row, from the last row of the text on along it
    for j, c in enumerate(b):
        match = where.get(c, 0) >> j & full
        diagonal = (((match & plus) + plus) ^ plus | match | minus) & full
        right_plus = minus | full & ~(diagonal | plus)
        right_minus = diagonal & plus
        row = j + edits  # of the band's lowest bit, counted from 0
        if row < rows:
            bottom += not diagonal >> (width - 1) & 1
        else:
            bit = 1 << (width - 1 - (row - rows + 1))
            bottom += bool(right_plus & bit) - bool(right_minus & bit)
        down = diagonal >> 1
        plus = right_minus | full & ~(down | right_plus)
        minus = down & right_plus
        plus &= full
    return bottom <= edits


def sketches(lines: list[str]) -> np.ndarray:
    """For each line SKETCH_BITS bits as longs, ends of a line being characters too. Lines within k
    edits differ in BITS_OF_EDIT * k bits at most."""
    codes = np.frombuffer("".join(f"\n{x}\n" for x in lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines)) + 2
    of = np.repeat(np.arange(len(lines)), lengths - 1)
    first = np.delete(np.arange(len(codes)), np.cumsum(lengths) - 1)
    at = (_mixed((codes[first] << np.uint64(32)) + codes[first + 1] + np.uint64(1)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = np.zeros(len(lines) * SKETCH_BITS, np.uint8)
    np.bitwise_xor.at(odd, of * SKETCH_BITS + at, 1)
    return np.packbits(odd).view(np.int64).reshape(len(lines), SKETCH_BITS // 64)


def _ids(lines: list[str]) -> list[bytes]:
    return [xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in lines]


def _lines(docs: DataFrame, least: int, with_text: bool = False) -> DataFrame:
    """(digest, id, doc_id, line_no[, line]) of the lines of at least ``least`` characters.

    ``digest`` stands for the line; ``id``, its last half, names it where candidates are
    looked for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            for start, texts in text_batches(batch.column(1).to_pylist()):
                found = [(n, i, x) for n, t in zip(names[start:], texts) for i, x in enumerate(t.split("\n")) if len(x) >= least]
                if not found:
                    continue
                digests = _ids([x for _, _, x in found])
                columns = {
                    "digest": pa.array(digests, pa.binary()),
                    "id": pa.array(np.frombuffer(b"".join(digests), ">i8")[1::2].astype(np.int64)),
                    "doc_id": pa.array([n for n, _, _ in found], pa.int64()),
                    "line_no": pa.array([i for _, i, _ in found], pa.int32()),
                }
                if with_text:
                    columns["line"] = pa.array([x for _, _, x in found], pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    schema = "digest binary, id long, doc_id long, line_no int" + ", line string" * with_text
    return _plain(docs).mapInArrow(run, schema)


def _sketched(lines: DataFrame) -> DataFrame:
    """(id, chars, sketch) of lines (id, line)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            flat = sketches(texts).ravel()
            offsets = np.arange(len(texts) + 1, dtype=np.int32) * (SKETCH_BITS // 64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in texts], pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(flat))],
                ["id", "chars", "sketch"],
            )

    return lines.select("id", "line").mapInArrow(run, "id long, chars int, sketch array<long>")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _buckets(docs: DataFrame, only: np.ndarray | None = None) -> DataFrame:
    """(bucket, id) of all segment keys; with ``only``, of those whose bit is set there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_batches(batch.column(1).to_pylist()):
                lines = list({x for t in texts for x in t.split("\n") if len(x) >= CHARS_PER_EDIT})
                at, keys = segment_keys(lines)
                ids = np.frombuffer(b"".join(_ids(lines)), ">i8")[1::2].astype(np.int64)
                if only is not None:
                    bit = keys & (2**MAP_BITS - 1)
                    keep = only[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 > 0
                    at, keys = at[keep], keys[keep]
                if len(keys):
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array(keys), "id": pa.array(ids[at])})

    return _plain(docs).mapInArrow(run, "bucket long, id long")


def _shared_map(docs: DataFrame) -> np.ndarray:
    """A map of fixed size with the bits of all keys that two lines or more share.

    It only spares the second pass keys that nobody else has; with more keys than bits it
    spares fewer, and the result stays the same.
    """
    shared = _buckets(docs).groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    bit = F.col("bucket").bitwiseAND(F.lit(2**MAP_BITS - 1))
    rows = (
        shared.groupBy((F.floor(bit / 32768)).alias("page"))
        .agg(F.expr(f"bitmap_construct_agg(bucket & {2**15 - 1})").alias("bits"))
        .collect()
    )  # at most 512 rows of 4 KB
    out = np.zeros(2**MAP_BITS // 8, np.uint8)
    for row in rows:
        out[row["page"] * 4096 : (row["page"] + 1) * 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def line_classes(docs: DataFrame) -> DataFrame:
    """(node, component) of the line ids that are the same as another line but for edits."""
    buckets = staged(_buckets(docs, _shared_map(docs)).distinct(), "segments")

    wanted = staged(buckets.select("id").distinct(), "wanted")
    texts = semi(_lines(docs, CHARS_PER_EDIT, True), wanted, "id")
    texts = staged(texts.groupBy("id").agg(F.min("line").alias("line")), "texts")  # of the lines that share a segment

    def verify(pairs: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                yield batch.select(["a", "b"]).filter(pa.array([same(s, t) for s, t in zip(x, y)], pa.bool_()))

        return (
            pairs.join(texts.withColumnsRenamed({"id": "a", "line": "x"}), "a")
            .join(texts.withColumnsRenamed({"id": "b", "line": "y"}), "b")
            .select("a", "b", "x", "y").mapInArrow(run, "a long, b long")
        )

    def attach(rest: DataFrame) -> DataFrame:
        return rest.join(_sketched(texts.join(rest.select("id").distinct(), "id", "left_semi")), "id")

    def likely() -> Column:
        """Lengths and sketches of lines that can be within the edits; it misses none."""
        allowed = F.least(F.lit(EDITS), F.floor(F.least("l_chars", "r_chars") / CHARS_PER_EDIT))
        words = [F.bit_count(F.col("l_sketch")[i].bitwiseXOR(F.col("r_sketch")[i])) for i in range(SKETCH_BITS // 64)]
        return (F.abs(F.col("l_chars") - F.col("r_chars")) <= allowed) & (sum(words[1:], words[0]) <= BITS_OF_EDIT * allowed)

    return linked_components(buckets, verify, attach, likely)


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no) of all lines but the first of their class.

    A class holds equal lines and those reachable by steps of the edits that the shorter line
    allows, at most EDITS; its first line is the one of the smallest doc_id, then line number. Lines of documents
    without a doc_id are never removed and stand for no others.
    """
    own = docs.where(F.col("doc_id").isNotNull())
    place = F.struct("doc_id", "line_no")
    distinct = staged(
        _lines(own, LEAST_CHARS).groupBy("digest", "id").agg(F.min("doc_id").alias("d"), F.min(place).alias("first"), F.count("*").alias("n")),
        "distinct",
    )
    classes = line_classes(own).withColumnRenamed("node", "id")
    near = distinct.join(classes, "id").select("digest", "component", "first", "n")
    near = staged(near, "near")
    firsts = near.groupBy("component").agg(F.min("first").alias("first"))
    repeated = near.select("digest", "component").join(firsts, "component").select("digest", "first").unionByName(
        distinct.where("n > 1").select("digest", "first").join(near.select("digest"), "digest", "left_anti")
    )
    repeated = staged(repeated, "repeated")
    return (
        _lines(own, LEAST_CHARS).join(repeated, "digest")
        .where(place != F.col("first")).select("doc_id", "line_no")
    )


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, and two more columns, n_lines and
    n_removed.

    All else in a text stays as it is, line by line; NULL stays NULL. A text of which every
    line goes is left empty. Where rows share a doc_id and a line number, the class's first
    line stays in each of them. Columns named n_lines or n_removed are replaced; others may have
    any name.
    """
    own = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    plain = [f"c{k}" for k in range(len(own))]
    rows = docs.select(*(F.col("`" + c.replace("`", "``") + "`") for c in own)).toDF(*plain)
    key, text = (plain[[c.lower() for c in own].index(name)] for name in ("doc_id", "text"))
    gone = repeated_lines(rows.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))).groupBy("doc_id").agg(
        F.collect_set("line_no").alias("gone")
    )
    kept = F.filter(F.col("lines"), lambda line, i: ~F.array_contains("gone", i))
    return (
        rows.join(gone, rows[key].cast("long") == gone["doc_id"], "left")
        .withColumn("lines", F.split(text, "\n", -1))
        .withColumn("n_lines", F.coalesce(F.size("lines"), F.lit(0)).cast("long"))
        .withColumn(text, F.when(F.col("gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")))
        .withColumn("n_removed", F.coalesce(F.size("gone"), F.lit(0)).cast("long"))
        .select(*plain, "n_lines", "n_removed").toDF(*own, "n_lines", "n_removed")
    )
