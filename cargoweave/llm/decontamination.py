"""Benchmark passages in documents, found in a full-text index of each training shard."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cargoweave.llm.common import ASCII_LOWER

#: Words of a window; an item of fewer words is one window.
WINDOW = 10
#: Words of benchmark items that are searched for in one pass over the documents.
BLOCK_WORDS = 200_000
#: Bytes of text that are indexed together; a longer text is a shard of its own.
SHARD_BYTES = 8_000_000
#: Every such suffix position is kept, and those of first words behind a break.
SAMPLED = 16
#: Lower case for A-Z, and a space for every ASCII character that is neither letter nor digit.
_WORDS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in ASCII_LOWER)


def words(text: str | None) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case."""
    return (text or "").encode("utf-8", "replace").translate(_WORDS).split()


class _Bits:
    """Bits, with a directory of how many are set before each group of 64."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.groups = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.groups), dtype=np.int64)[:-1]])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` bits are set."""
        inside = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.groups[at >> 6] & inside)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return (self.groups[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletMatrix:
    """A sequence of numbers below ``2 ** depth`` with rank and access in ``depth`` steps."""

    def __init__(self, values: np.ndarray, depth: int) -> None:
        self.levels: list[tuple[int, _Bits, int]] = []
        for shift in range(depth - 1, -1, -1):
            bits = (values >> shift) & 1 != 0
            values = np.concatenate([values[~bits], values[bits]])
            self.levels.append((shift, _Bits(bits), len(bits) - int(bits.sum())))
        every = np.arange(2**depth)
        self._starts = self._follow(every, np.zeros(len(every), np.int64))

    def _follow(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((value >> shift) & 1, zeros + ones, at - ones)
        return at

    def rank(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``value`` stands among the first ``at``."""
        return self._follow(value, at) - self._starts[value]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value at ``at``, and how often it stands before."""
        value = np.zeros(len(at), np.int64)
        for shift, bits, zeros in self.levels:
            ones, one = bits.rank(at), bits[at]
            value |= one.astype(np.int64) << shift
            at = np.where(one, zeros + ones, at - ones)
        return value, at - self._starts[value]


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Where the suffixes of ``symbols`` start, in order.

    Symbol 0 is a break: it comes before all others, breaks come in the order of their places,
    and the last symbol must be one. The first sort takes as many symbols as a number holds;
    after that suffixes that are still equal are told apart by those twice as far behind.
    """
    n = len(symbols)
    ahead = max(1, 62 // depth)
    key, broken = np.zeros(n, np.int64), np.zeros(n, bool)
    for k in range(ahead):
        there = np.concatenate([symbols[k:], np.zeros(min(k, n), np.int64)])[:n]
        broken |= there == 0
        key = (key << depth) | np.where(broken, 0, there)
    order = np.argsort(key)
    slots, sorted_ = np.arange(n), key[order]
    rank = np.empty(n, np.int64)
    while True:
        new = np.concatenate([[True], sorted_[1:] != sorted_[:-1]])
        rank[order[slots]] = slots[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        tied = ~(new & np.concatenate([new[1:], [True]]))
        slots = slots[tied]
        if not len(slots):
            return order
        here = order[slots]
        behind = np.where(broken[here], here, rank[np.minimum(here + ahead, n - 1)])
        key = rank[here] * n + behind
        by = np.argsort(key)
        order[slots], sorted_ = here[by], key[by]
        broken |= np.concatenate([broken[ahead:], np.ones(min(ahead, n), bool)])[:n]
        ahead *= 2


class FmIndex:
    """Counts and finds phrases of symbols from 1 up; 0 is a break that no phrase crosses."""

    def __init__(self, symbols: np.ndarray, largest: int) -> None:
        depth = max(1, int(largest).bit_length())
        order = suffix_order(symbols, depth)
        before = symbols[order - 1]
        self.size = len(symbols)
        self.text = WaveletMatrix(before, depth)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=2**depth))[:-1]])
        kept = (order % SAMPLED == 0) | (before == 0)
        self.kept, self.places = _Bits(kept), order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that start with each phrase; phrases stand at the right end of
        their rows. All are searched at once, from the last symbol to the first."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size)
        for step in range(1, phrases.shape[1] + 1):
            on = np.flatnonzero((lengths >= step) & (low < high))
            symbol = phrases[on, -step]
            low[on] = self.smaller[symbol] + self.text.rank(symbol, low[on])
            high[on] = self.smaller[symbol] + self.text.rank(symbol, high[on])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes at ``rows`` of the order start: back to the next kept place."""
        out, left, at, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), rows, 0
        while len(left):
            kept = self.kept[at]
            out[left[kept]] = self.places[self.kept.rank(at[kept])] + steps
            left, at, steps = left[~kept], at[~kept], steps + 1
            symbol, nth = self.text.access(at)
            at = self.smaller[symbol] + nth
        return out


@dataclass
class Phrases:
    """The windows of a block of items: numbers of words, and the items that have each window."""

    vocabulary: dict[bytes, int]
    windows: np.ndarray
    lengths: np.ndarray
    owners: np.ndarray
    owner_starts: np.ndarray
    items: list[str | None]

    @classmethod
    def of(cls, items: list[tuple[str | None, str | None]]) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        names = sorted({i for i, _ in items if i is not None})
        number = {i: k for k, i in enumerate(names)}
        for item, text in items:
            numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)]
            for start in range(max(1, len(numbers) - WINDOW + 1) if numbers else 0):
                holders = owners.setdefault(tuple(numbers[start : start + WINDOW]), set())
                if item is not None:
                    holders.add(number[item])
        windows = np.zeros((len(owners), WINDOW), np.int64)
        for k, window in enumerate(owners):
            windows[k, WINDOW - len(window) :] = window
        starts = np.cumsum([0, *map(len, owners.values())])
        flat = [i for holders in owners.values() for i in sorted(holders)]
        return cls(vocabulary, windows, np.array([*map(len, owners)], np.int64), np.array(flat, np.int64), starts, names)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each range its number, and the numbers in it."""
    of = np.repeat(np.arange(len(starts)), sizes)
    return of, np.arange(len(of)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _shard_hits(texts: list[list[bytes]], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merged spans of words (text, start, end), and the pairs (text, item), both in order."""
    get = phrases.vocabulary.get
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(sizes)
    all_ = np.zeros(int(ends[-1]), np.int64)
    for text, end, size in zip(texts, ends.tolist(), sizes.tolist()):
        all_[end - size : end - 1] = [get(w, 0) for w in text]
    # words that no item has only part the others: one break stands for any number of them
    stays = (all_ != 0) | np.concatenate([[False], all_[:-1] != 0])
    where = np.flatnonzero(stays)
    none = np.empty(0, np.int64)
    if not len(where) or not len(phrases.windows):
        return none, none, none, none, none
    index = FmIndex(all_[where], len(phrases.vocabulary))
    low, high = index.search(phrases.windows, phrases.lengths)
    window, rows = _ranges(low, high - low)
    start = where[index.locate(rows)]
    by = np.argsort(start)
    window, start = window[by], start[by]
    text = np.searchsorted(ends, start, "right")

    reach = np.maximum.accumulate(start + phrases.lengths[window]) if len(start) else none
    first = np.concatenate([[True], start[1:] > reach[:-1]]) if len(start) else none.astype(bool)
    last = np.concatenate([first[1:], [True]]) if len(start) else first
    base = (ends - sizes)[text[first]]

    counts = np.diff(phrases.owner_starts)[window]
    of, at = _ranges(phrases.owner_starts[window], counts)
    pairs = np.unique(text[of] * (len(phrases.items) + 1) + phrases.owners[at])
    return text[first], start[first] - base, reach[last] - base, *np.divmod(pairs, len(phrases.items) + 1)


def _cuts(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The places, in code points, from the first to the last word of each span of words."""
    raw = text.encode("utf-8", "replace")
    letters = np.frombuffer(raw.translate(_WORDS), np.uint8) != 0x20
    edge = np.diff(np.concatenate([[0], letters.view(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [(int(points[begin[a]]), int(points[end[b - 1]])) for a, b in spans]


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ADDED = [T.StructField("n_words", T.LongType()), T.StructField("hits", _SPANS), T.StructField("cuts", _SPANS),
          T.StructField("items", T.ArrayType(T.StringType()))]
_ARROW = {"hits": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), "items": pa.list_(pa.string())}


def _searched(docs: DataFrame, phrases: Phrases, text_column: str) -> DataFrame:
    """One pass: what the columns hits and items of an earlier one hold is kept."""
    shared = docs.sparkSession.sparkContext.broadcast(phrases)
    names = [f.name for f in _ADDED]
    own = [c for c in docs.columns if c not in names]
    again = set(names) <= set(docs.columns)
    schema = T.StructType([*[docs.schema[c] for c in own], *_ADDED])

    def shard(batches: list[pa.RecordBatch], split: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        of, starts, ends, holders, held = _shard_hits(split, block)
        spans: dict[int, list[tuple[int, int]]] = {}
        for t, a, b in zip(of.tolist(), starts.tolist(), ends.tolist()):
            spans.setdefault(t, []).append((a, b))
        items: dict[int, list[str]] = {}
        for t, i in zip(holders.tolist(), held.tolist()):
            items.setdefault(t, []).append(block.items[i])
        base = 0
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("_text"))
            hits = [spans.get(base + k, []) for k in range(batch.num_rows)]
            found = [items.get(base + k, []) for k in range(batch.num_rows)]
            if again:
                before = [[(s["start"], s["end"]) for s in x] for x in batch.column(batch.schema.get_field_index("_hits")).to_pylist()]
                hits = [_joined(x + y) for x, y in zip(before, hits)]
                found = [sorted({*x, *y}) for x, y in zip(batch.column(batch.schema.get_field_index("_items")).to_pylist(), found)]
            cuts = [_cuts(texts[k].as_py(), h) if h else [] for k, h in enumerate(hits)]
            made = [[{"start": a, "end": b} for a, b in h] for h in hits], [[{"start": a, "end": b} for a, b in c] for c in cuts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(own)],
                 pa.array([len(split[base + k]) for k in range(batch.num_rows)], pa.int64()),
                 pa.array(made[0], _ARROW["hits"]), pa.array(made[1], _ARROW["hits"]), pa.array(found, _ARROW["items"])],
                [*own, *names],
            )
            base += batch.num_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        split: list[list[bytes]] = []
        held = 0
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("_text"))
            first = 0
            for k, text in enumerate(texts):
                split.append(words(text.as_py()))
                held += len(text.as_buffer()) if text.is_valid else 0
                if held >= SHARD_BYTES:
                    yield from shard([*kept, batch.slice(first, k + 1 - first)], split)
                    kept, split, held, first = [], [], 0, k + 1
            if first < batch.num_rows:
                kept.append(batch.slice(first))
        if split:
            yield from shard(kept, split)

    carried = [F.col(f"`{c.replace('`', '``')}`") for c in own]
    passed = [F.col("hits").alias("_hits"), F.col("items").alias("_items")] if again else []
    text = F.col(f"`{text_column.replace('`', '``')}`").cast("string").alias("_text")
    # positions, not names, tell columns apart, so that own columns may have any name
    numbered = docs.select(*carried, text, *passed).toDF(*[f"c{k}" for k in range(len(own))], "_text", *(["_hits", "_items"] if again else []))
    found = numbered.mapInArrow(run, schema)
    return found


def _blocks(benchmark: DataFrame) -> Iterator[Phrases]:
    """The items in blocks of about BLOCK_WORDS words, one at a time on the driver. An item is
    never parted, so a block holds an item of more words alone at least."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    count = F.sum(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")))
    blocks = -(-(items.agg(count).first()[0] or 0) // BLOCK_WORDS)
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        yield Phrases.of([tuple(r) for r in part.collect()])


def find_passages(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the columns n_words, hits, cuts and items.

    A window is WINDOW consecutive words of an item of ``benchmark`` (item_id, text); an item of
    fewer words, but not none, is one window. hits are the merged spans of word numbers (from 0,
    end exclusive) that windows cover, cuts the same places in code points, from the first
    character of the first word to the last of the last one. items are the item_ids, as text and
    in order, that have a window here; items without an id mark words but are not among them.

    Every shard of documents (SHARD_BYTES of text, in the order they are read) is indexed: the
    words that some item has, with breaks for all others, as a Burrows-Wheeler text in a wavelet
    matrix. Windows are searched backward, all at once, and located by the sampled suffix
    positions. A benchmark of more than BLOCK_WORDS words is searched for block by block, one
    pass over the documents for each. NULL and empty texts have no words; an empty benchmark, or
    one without words, hits nothing; repeated rows are searched each. Columns of ``docs`` that
    have the names of the added ones are replaced.
    """
    names = [f.name for f in _ADDED]
    plain = docs.select(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns if c not in names])
    found = None
    for phrases in _blocks(benchmark):
        found = _searched(plain if found is None else found, phrases, text_column)
    return found if found is not None else _searched(plain, Phrases.of([]), text_column)


def _left(text: Column, cuts: Column) -> Column:
    """The text without the cut places."""
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda c: c["end"]))
    starts = F.concat(F.transform(cuts, lambda c: c["start"]), F.array(F.char_length(text).cast("long")))
    pieces = F.zip_with(ends, starts, lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int")))
    return F.array_join(pieces, "")


def without_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (text) with what ``find_passages`` cuts taken out of the text; what stands
    between words on either side stays. Columns stay as they were; NULL stays NULL."""
    place = [c.lower() for c in docs.columns].index("text")
    plain = [f"c{k}" for k in range(len(docs.columns))]  # own columns may have any name
    found = find_passages(docs.toDF(*plain), benchmark, plain[place])
    text = F.col(plain[place])
    left = F.when(F.size("cuts") > 0, _left(text.cast("string"), F.col("cuts"))).otherwise(text)
    return found.withColumn(plain[place], left).select(plain).toDF(*docs.columns)


def digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated, from ``find_passages``."""
    found = find_passages(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
