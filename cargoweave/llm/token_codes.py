"""Token ids in directly addressable codes: written block by block, any token read alone.

An id is cut into chunks of eight bits. Level 0 holds the lowest chunk of every id; a
bitmap beside it says which ids go on in level 1, and so on. The ids that go on keep
their order, so the place of an id in the next level is the rank of its bit, found with a
directory of ranks before every 512 bits. A block is one binary value:

    magic, documents, ids, levels         4 little-endian 64-bit integers
    doc_ids, doc_known                    64-bit integers, bytes (0: the id is NULL)
    starts                                64-bit integers, one more than documents
    for each level: entries               a 64-bit integer
                    chunks                a byte for each entry
                    ranks                 a 32-bit integer for every 512 entries begun
                    bitmap                a bit for each entry, lowest first, whole 8 bytes
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cargoweave.llm.common import WHITE, Memo, text_batches

MAGIC = 0x31434144
#: Ids after which a block is closed; a block holds whole documents.
BLOCK_IDS = 1_000_000
#: Bits for each entry of a rank directory.
STRIDE = 512
REMEMBERED = 500_000
#: Characters of consecutive texts whose pieces are looked up together.
TOGETHER = 4_000_000
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint32)
#: Kinds of ASCII bytes; 0 for control characters and the bytes of all others.
_BLANK, _MARK, _WORD = 1, 2, 3
_KIND = np.array(
    [0 if i > 126 else _BLANK if chr(i) in "\t\n\x0b\x0c\r " else _WORD if chr(i).isalnum() else _MARK if i > 32 else 0 for i in range(256)], np.uint8
)
_WHITE_TWO, _WHITE_THREE = ([int.from_bytes(w.encode()) for w in WHITE if len(w.encode()) == n] for n in (2, 3))


def pack(doc_ids: list[int | None], documents: list[np.ndarray]) -> bytes:
    """One block of the documents' ids (unsigned 32-bit)."""
    starts = np.concatenate([[0], np.cumsum([len(d) for d in documents])]).astype("<i8")
    ids = np.concatenate([np.empty(0, np.uint32), *documents]).astype(np.uint32)
    levels, left = [], ids
    while True:
        more = left > 255
        words = -(-len(left) // 64)
        bitmap = np.packbits(more, bitorder="little").tobytes().ljust(8 * words, b"\0")
        ones = np.add.reduceat(more, np.arange(0, len(more), STRIDE)) if len(more) else np.empty(0, np.int64)
        ranks = np.concatenate([[0], np.cumsum(ones)])[: len(ones)].astype("<u4")
        levels += [len(left).to_bytes(8, "little"), (left & 255).astype(np.uint8).tobytes(), ranks.tobytes(), bitmap]
        left = left[more] >> 8
        if not len(left):
            break
    return b"".join([
        np.array([MAGIC, len(documents), len(ids), len(levels) // 4], "<i8").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        bytes(d is not None for d in doc_ids),
        starts.tobytes(),
        *levels,
    ])


@dataclass
class _Level:
    parts: np.ndarray
    ranks: np.ndarray
    bitmap: np.ndarray

    def goes_on(self, at: int) -> bool:
        return bool(self.bitmap[at >> 3] >> (at & 7) & 1)

    def rank(self, at: int) -> int:
        """Set bits before ``at``."""
        first = at // STRIDE * STRIDE >> 3
        whole = int(_ONES[self.bitmap[first : at >> 3]].sum())
        return int(self.ranks[at // STRIDE]) + whole + int(_ONES[self.bitmap[at >> 3] & ((1 << (at & 7)) - 1)])


class Block:
    """A block that was read: documents, slices and single tokens."""

    def __init__(self, raw: bytes) -> None:
        magic, n, self.n_ids, depth = np.frombuffer(raw, "<i8", 4).tolist()
        if magic != MAGIC:
            raise ValueError("no block of token ids")
        at = 32
        ids = np.frombuffer(raw, "<i8", n, at).tolist()
        known = raw[at + 8 * n : at + 9 * n]
        self.doc_ids = [i if k else None for i, k in zip(ids, known)]
        self.starts = np.frombuffer(raw, "<i8", n + 1, at := at + 9 * n)
        at += 8 * (n + 1)
        self.levels = []
        for _ in range(depth):
            size = int.from_bytes(raw[at : at + 8], "little")
            parts = np.frombuffer(raw, np.uint8, size, at := at + 8)
            ranks = np.frombuffer(raw, "<u4", -(-size // STRIDE), at := at + size)
            bitmap = np.frombuffer(raw, np.uint8, 8 * -(-size // 64), at := at + 4 * len(ranks))
            at += len(bitmap)
            self.levels.append(_Level(parts, ranks, bitmap))

    def token(self, at: int) -> int:
        """One id, without decoding any other."""
        value = shift = 0
        for level in self.levels:
            value |= int(level.parts[at]) << shift
            if not level.goes_on(at):
                break
            at, shift = level.rank(at), shift + 8
        return value

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids from start to stop, as unsigned 32-bit integers."""
        stop = self.n_ids if stop is None else stop
        out = np.zeros(stop - start, np.uint32)
        where, shift = np.arange(stop - start), 0
        for level in self.levels:
            out[where] |= level.parts[start:stop].astype(np.uint32) << np.uint32(shift)
            more = np.unpackbits(level.bitmap[start >> 3 : -(-stop // 8)], bitorder="little")[start & 7 :][: stop - start] > 0
            where, shift = where[more], shift + 8
            if not len(where):
                break
            start = level.rank(start)
            stop = start + len(where)
        return out


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _token_bytes(path: str) -> np.ndarray:
    """How many bytes each id stands for; in a byte-level vocabulary every character is a byte."""
    vocabulary = _tokenizer(path).get_vocab()
    out = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, i in vocabulary.items():
        out[i] = len(token)
    return out


@cache
def _memory(path: str) -> Memo:
    return Memo(REMEMBERED)


def _library_ids(path: str, texts: list[str]) -> list[np.ndarray]:
    found = _tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)
    return [np.array(f.ids, np.uint32) for f in found]


@cache
def _special(path: str) -> list[str]:
    return [t.content for t in _tokenizer(path).get_added_tokens_decoder().values()]


def _encode_pieces(path: str, texts: list[str]) -> list[bytes]:
    """The ids of each piece. Pieces are handed to the library many at a time, joined where
    no match reaches over the seam, and cut again by the bytes their ids stand for."""
    seam = [t[0] in WHITE and t[-1] not in WHITE for t in texts]
    joined = [t for t, s in zip(texts, seam) if s]
    runs = ["".join(joined[k : k + 200]) for k in range(0, len(joined), 200)]
    ids = np.concatenate([np.empty(0, np.uint32), *_library_ids(path, runs)])
    id_ends = np.cumsum(_token_bytes(path)[ids])
    text_ends = np.cumsum(np.fromiter((len(t.encode()) for t in joined), np.int64, len(joined)))
    ends = (4 * np.searchsorted(id_ends, text_ends, "right")).tolist()
    raw = ids.tobytes()
    cut = iter([raw[a:b] for a, b in zip([0, *ends], ends)])
    alone = iter(_library_ids(path, [t for t, s in zip(texts, seam) if not s]))
    return [next(cut) if s else next(alone).tobytes() for s in seam]


def _edges(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces of the texts that start at ``starts`` in ``raw`` (UTF-8) begin, and the end.

    They begin where ASCII white space follows what is none, and where ASCII punctuation follows
    an ASCII letter or digit. No match of a byte-level BPE pattern reaches over such a place.
    """
    before, here = raw[:-1], raw[1:]
    kind, after = _KIND[before], _KIND[here]
    cut = np.zeros(len(raw) + 1, bool)
    cut[1:-1] = ((after == _BLANK) & (kind >= _MARK)) | ((after == _MARK) & (kind == _WORD))
    at = np.flatnonzero((after == _BLANK) & (before >= 128)) + 1  # the last byte of a character of several
    last = raw[at - 2].astype(np.int32) << 8 | raw[at - 1]
    white = np.isin(last, _WHITE_TWO) | np.isin(raw[np.maximum(at - 3, 0)].astype(np.int32) << 16 | last, _WHITE_THREE)
    cut[at[~white]] = True
    cut[starts] = cut[-1] = True
    return np.flatnonzero(cut)


def _encoded(path: str, texts: list[str]) -> Iterator[np.ndarray]:
    """The ids of each text. The library encodes each piece once and it is remembered; texts
    with special tokens, which a piece could cut through, are encoded whole."""
    whole = {i: t for i, t in enumerate(texts) if any(s in t for s in _special(path))}
    special = dict(zip(whole, _library_ids(path, list(whole.values()))))
    coded = [b"" if i in whole else t.encode() for i, t in enumerate(texts)]
    raw = b"".join(coded)
    bounds = np.cumsum([0, *map(len, coded)])
    if not raw:
        yield from (special.get(i, np.empty(0, np.uint32)) for i in range(len(texts)))
        return
    edges = _edges(np.frombuffer(raw, np.uint8), bounds)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(raw)]).dictionary_encode()
    distinct = pieces.dictionary.cast(pa.large_string()).to_numpy(zero_copy_only=False).tolist()
    known = _memory(path).known(distinct, lambda missing: _encode_pieces(path, missing))
    found = [known[p] for p in distinct]
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    which = pieces.indices.to_numpy()
    n = sizes[which]
    ends = np.cumsum(n)
    ids = np.frombuffer(b"".join(found), np.uint32)[np.repeat((np.cumsum(sizes) - sizes)[which] - ends + n, n) + np.arange(ends[-1])]
    cuts = np.concatenate([[0], ends])[np.searchsorted(edges, bounds)].tolist()
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        yield special[i] if i in whole else ids[a:b]


def write_codes(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Write the tokens of ``docs`` (doc_id, text) in ascending doc_id order.

    Each row of the Parquet files is a block: part (range of ids), block (place in the part),
    first (ids of the part before it), n_ids, codes. Parts are sorted ranges; Spark's commit
    makes a repeated task harmless. NULL texts count as empty, and every text gets the end id.
    Rows without a doc_id come first; repeated rows are all written, ordered by text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, documents, held = [], [], 0
        end = np.array([end_id], np.uint32)

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int64()), "first": pa.array([first], pa.int64()),
                 "n_ids": pa.array([held], pa.int64()), "codes": pa.array([pack(doc_ids, documents)], pa.binary())}
            )

        for batch in batches:
            names = batch.column(0).to_pylist()
            for start, texts in text_batches(batch.column(1).to_pylist(), TOGETHER):
                for name, ids in zip(names[start:], _encoded(tokenizer, texts)):
                    doc_ids.append(name)
                    documents.append(np.concatenate([ids, end]))
                    held += len(ids) + 1
                    if held >= BLOCK_IDS:
                        yield closed()
                        block, first = block + 1, first + held
                        doc_ids, documents, held = [], [], 0
        if documents:
            yield closed()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(
        run, "part int, block long, first long, n_ids long, codes binary"
    )
    blocks.write.parquet(path)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the written blocks.

    The starts of parts are a running sum over one row for each part; there are as many
    parts as tasks wrote, which bounds the broadcast.
    """
    blocks = spark.read.schema("part int, block long, first long, n_ids long, codes binary").parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = Block(raw.as_py())
                ids = block.ids().astype("<u4")
                edges = block.starts
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(block.doc_ids, pa.int64()),
                    "start": pa.array(edges[:-1] + base),
                    "n_tokens": pa.array(np.diff(edges)),
                    "ids_crc32": pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(edges.tolist(), edges[1:].tolist())], pa.int64()),
                })

    return (
        blocks.join(F.broadcast(parts), "part")
        .select((F.col("base") + F.col("first")).alias("base"), "codes")
        .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )
