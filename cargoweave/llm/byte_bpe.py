"""Byte-level BPE by segment trees over byte positions, many pieces at a time."""

from __future__ import annotations

import base64
import hashlib
import sys
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from cargoweave.llm.common import WHITE, Memo, chunks, text_batches

#: Chunks of text each of two generations of a Python worker's memory holds.
REMEMBERED = 150_000
#: Tree cells that are merged together at a time.
CELLS = 1_000_000
#: Pieces of more bytes are merged one by one.
LONG = 1024
_NONE = np.int64(2**62)


def _slices(raw: bytes, counts: np.ndarray) -> list[bytes]:
    ends = (4 * np.cumsum(counts)).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


class BytePairs:
    """The merges of a rank file. A pair merges at the rank of the bytes it makes; of equal
    ranks the leftmost goes first."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {
            (self.ranks[t[:i]] << 32) + self.ranks[t[i:]]: rank
            for t, rank in self.ranks.items() for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        }
        self._pairs = pairs
        bits = max(4, (4 * len(pairs)).bit_length())
        self._shift = np.uint64(64 - bits)
        self._keys, self._merged = np.full(2**bits, -1, np.int64), np.full(2**bits, _NONE)
        self._probes = 1
        keys, merged = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64)
        slot = self._slot(keys)
        while len(keys):  # open addressing: all pairs still without a place try the next one
            free = self._keys[slot] < 0
            first = np.zeros(len(keys), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            placed = free & first
            self._keys[slot[placed]], self._merged[slot[placed]] = keys[placed], merged[placed]
            keys, merged, slot = keys[~placed], merged[~placed], (slot[~placed] + 1) % len(self._keys)
            self._probes += len(keys) > 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) + right
        slot = self._slot(keys)
        out = np.where(self._keys[slot] == keys, self._merged[slot], _NONE)
        open_ = np.flatnonzero((self._keys[slot] != keys) & (self._keys[slot] >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) % len(self._keys)
            there = self._keys[slot[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self._merged[slot[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out

    def _merge(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Pieces of at most ``width`` bytes, a power of two; a row of a matrix for each.

        ``tree[:, width + i]`` holds rank and place of the pair that starts at byte i; every
        inner cell holds the smaller of its two, so the root is the leftmost minimum. A merge
        changes three leaves: the pair that went, the merged one's, and the one before it.
        """
        n = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        flat = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in pieces), np.uint8).reshape(n, width)
        place = np.arange(width, dtype=np.int64)
        ids = self.single[flat]
        after, before = np.tile(place + 1, (n, 1)), np.tile(place - 1, (n, 1))
        tree = np.full((n, 2 * width), _NONE)
        pair = self._rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        pair = np.where(place[1:] < lengths[:, None], pair, _NONE)
        tree[:, width:-1] = np.where(pair < _NONE, pair * width + place[:-1], _NONE)
        for level in (2**k for k in range(width.bit_length() - 2, -1, -1)):
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        live = np.ones((n, width), bool)
        rows = np.flatnonzero(tree[:, 1] < _NONE)
        while len(rows):
            at = tree[rows, 1] % width
            ids[rows, at] = tree[rows, 1] // width
            gone = after[rows, at]
            live[rows, gone] = False
            follows = after[rows, gone]
            after[rows, at] = follows
            inside = follows < width
            before[rows[inside], follows[inside]] = at[inside]
            tree[rows, width + gone] = _NONE
            self._pair(tree, ids, rows, at, follows, lengths, width)
            led = before[rows, at]
            has = led >= 0
            self._pair(tree, ids, rows[has], led[has], at[has], lengths, width)
            cells = [width + gone, width + at, np.where(has, width + led, width + at)]
            while cells[0][0] > 1:
                cells = [c >> 1 for c in cells]
                for c in cells:
                    tree[rows, c] = np.minimum(tree[rows, 2 * c], tree[rows, 2 * c + 1])
            rows = rows[tree[rows, 1] < _NONE]
        live &= place < lengths[:, None]
        return _slices(ids[live].astype(np.int32).tobytes(), live.sum(axis=1))

    def _merge_long(self, piece: bytes) -> bytes:
        """The same tree for a single long piece, in plain integers."""
        width = 1 << (len(piece) - 1).bit_length()
        ids = self.single[np.frombuffer(piece, np.uint8)]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        none = int(_NONE)
        tree = [none] * (2 * width)
        first = self._rank(ids[:-1], ids[1:])
        tree[width : width + len(first)] = np.where(first < _NONE, first * width + np.arange(len(first)), _NONE).tolist()
        for cell in range(width - 1, 0, -1):
            tree[cell] = min(tree[2 * cell], tree[2 * cell + 1])
        ids = ids.tolist()

        def put(place: int, value: int) -> None:
            cell = width + place
            tree[cell] = value
            while cell > 1:
                cell >>= 1
                least = min(tree[2 * cell], tree[2 * cell + 1])
                if tree[cell] == least:
                    break
                tree[cell] = least

        def pair(place: int) -> int:
            if after[place] >= len(ids):
                return none
            rank = self._pairs.get((ids[place] << 32) + ids[after[place]], none)
            return rank * width + place if rank < none else none

        while tree[1] < none:
            rank, at = divmod(tree[1], width)
            gone = after[at]
            ids[at], ids[gone] = rank, -1
            after[at] = after[gone]
            if after[at] < len(ids):
                before[after[at]] = at
            put(gone, none)
            put(at, pair(at))
            if before[at] >= 0:
                put(before[at], pair(before[at]))
        return np.array([i for i in ids if i >= 0], np.int32).tobytes()

    def _pair(self, tree, ids, rows, at, follows, lengths, width) -> None:
        ok = follows < lengths[rows]
        rank = self._rank(ids[rows, at], ids[rows, np.where(ok, follows, at)])
        tree[rows, width + at] = np.where(ok & (rank < _NONE), rank * width + at, _NONE)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, merged by itself, as 32-bit integers."""
        out = [b""] * len(pieces)
        by_width = defaultdict(list)
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, sys.byteorder)
            elif len(piece) > LONG:
                out[i] = self._merge_long(piece)
            elif piece:
                by_width[1 << (len(piece) - 1).bit_length()].append(i)
        for width, places in by_width.items():
            step = max(1, CELLS // (2 * width))
            for k in range(0, len(places), step):
                part = places[k : k + step]
                for i, ids in zip(part, self._merge([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def encode_chunks(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, every match of the pattern apart, as 32-bit integers.

        Texts are matched in one go where their seams are places no match reaches over.
        """
        seam = [bool(t) and t[0] in WHITE and t[-1] not in WHITE for t in texts]
        joined = [t for t, s in zip(texts, seam) if s]
        found = self.pattern.findall("".join(joined))
        alone = [[] if s else self.pattern.findall(t) for t, s in zip(texts, seam)]
        pieces = list({*found, *chain.from_iterable(alone)})
        ids = dict(zip(pieces, self.encode_pieces([p.encode() for p in pieces]), strict=True))
        coded = [ids[p] for p in found]
        piece_ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        id_ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)))])
        text_ends = np.cumsum(np.fromiter(map(len, joined), np.int64, len(joined)))
        ends = id_ends[np.searchsorted(piece_ends, text_ends, "right")].tolist()
        raw = b"".join(coded)
        cut = iter([raw[a:b] for a, b in zip([0, *ends], ends)])
        return [next(cut) if s else b"".join([ids[p] for p in f]) for s, f in zip(seam, alone)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@cache
def byte_pairs(path: str, pattern: str) -> BytePairs:
    """One for each Python worker and file."""
    return BytePairs(path, pattern)


@cache
def _memory(path: str, pattern: str) -> Memo:
    return Memo(REMEMBERED)


def _encoded(path: str, pattern: str, texts: list[str]) -> Iterator[bytes]:
    """For each text its ids as 32-bit integers."""
    memory = _memory(path, pattern)
    parts = [chunks(text) for text in texts]
    known = memory.known(set(chain.from_iterable(parts)), byte_pairs(path, pattern).encode_chunks)
    for p in parts:
        yield b"".join([known[c] for c in p])


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids`` array<int> in place of ``text``: the tokens of every whole text.

    NULL texts count as empty and have no ids. Rows are independent of each other; other
    columns stay as they are (a column named ids is replaced).
    """
    kept = [k for k, c in enumerate(docs.columns) if c.lower() not in ("text", "ids")]
    schema = T.StructType([*(docs.schema[k] for k in kept), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept)).to_pylist()
            for start, part in text_batches(texts):
                raw = list(_encoded(path, pattern, part))
                offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(raw), np.int32)))
                columns = [c.slice(start, len(part)) for c in batch.columns[: len(kept)]]
                yield pa.RecordBatch.from_arrays([*columns, ids], schema.names)
        _memory(path, pattern).clear()

    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # own columns may have any name
    text = [c.lower() for c in docs.columns].index("text")
    return plain.select(*[f"c{k}" for k in kept], F.col(f"c{text}").cast("string").alias("text")).mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, encoded and decoded.

    ids_sha256 is of the decimal ids joined by one space. NULL texts count as empty;
    repeated rows and rows without a doc_id each have their row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(path, pattern)
        decimals = {i: str(i) for i in pairs.tokens}
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for _, part in text_batches(batch.column(1).to_pylist()):
                for raw in _encoded(path, pattern, part):
                    ids = np.frombuffer(raw, np.int32).tolist()
                    counts.append(len(ids))
                    ids_sha.append(hashlib.sha256(" ".join([decimals[i] for i in ids]).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(pairs.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        _memory(path, pattern).clear()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
