"""Quality by weak labels: expectation-maximisation over heuristics, then a hashed linear scorer."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain, islice
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cargoweave.llm.common import Memo

#: Frequent function words of English, Spanish, French and German. Fixed values.
FUNCTION_WORDS = frozenset(
    "the of and to a in is that it for was on with as be are by this at from "
    "de la que el en y los se del un las por con no una para su al es lo "
    "le et les des du une est pour dans pas au qui par sur avec "
    "der die und den zu von das sich mit auf für ein im dem nicht ist eine als".split()
)
#: The heuristics; each says 1 (good), -1 (bad) or 0 (no opinion) of a text.
LABELLERS = ("repetition", "capitals", "symbols", "function_words", "word_length", "lines", "runs", "length")
#: Documents that the linear scorer is fitted on at most, drawn by a hash of doc_id.
SAMPLE = 4000
BUCKETS = 2**16
#: Documents that the prior on the label model counts as, whatever the input, and the chance of
#: a bad vote by class that it holds. It tells which class is which; accuracies come from votes.
PRIOR, BAD_ON_BAD, BAD_ON_GOOD = 20.0, 0.3, 0.001
EM_ROUNDS, ROUNDS, RATE, PENALTY = 100, 300, 0.3, 1e-4
#: Words of which a task remembers what they are; only saves time.
REMEMBERED = 200_000
#: Documents are kept from this score on.
KEEP = 0.5


def _vote(value: float, bad_below: float | None = None, bad_above: float | None = None, good: tuple[float, float] | None = None) -> int:
    if (bad_below is not None and value < bad_below) or (bad_above is not None and value > bad_above):
        return -1
    return int(good is not None and good[0] <= value <= good[1])


@cache
def _kinds() -> np.ndarray:
    """For every code point 1 if it is a letter, and 2 more if it is upper case."""
    points = map(chr, range(sys.maxunicode + 1))
    return np.fromiter((c.isalpha() + 2 * c.isupper() for c in points), np.uint8, sys.maxunicode + 1)


def _hashed(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass")) % BUCKETS


def _word(w: str) -> int:
    """1 if a word is a symbol, and 2 more if it is a function word."""
    symbol = not w.isalnum() and (
        not any(map(str.isalnum, w)) or not w[-2:].isalnum() and not w[-2:-1].isalnum() and len(w) > 1
    )
    return symbol + 2 * (w.lower().strip(".,;:!?%") in FUNCTION_WORDS)


def _buckets(w: str) -> tuple[int, int]:
    """Where a word and its shape are counted."""
    core = w.strip(".,;:!?%")
    shape = ("U" if core.isupper() and len(core) > 1 else "a" if core.isalnum() else "x") + w[len(core):][:3]
    return _hashed("w:" + w.lower()), _hashed("s:" + shape)


#: What is known of words that occurred lately.
_WORDS, _BUCKETS = Memo(REMEMBERED), Memo(REMEMBERED)


class _Measured(NamedTuple):
    """A whole text, measured once for its votes and its features."""

    text: str
    words: Counter[str]
    measures: dict[str, float]


def _measured(text: str) -> _Measured:
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    known = _WORDS.known(counts, lambda new: map(_word, new))
    of = [(known[w], c) for w, c in counts.items() if known[w]]
    kinds = np.bincount(_kinds()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)], minlength=4)
    letters = int(kinds[1] + kinds[3]) or 1
    lines = [x for x in text.split("\n") if x.strip()]
    return _Measured(text, counts, {
        "n": len(words),
        "distinct": len(counts) / n,
        "top": max(counts.values(), default=0) / n,
        "capitals": int(kinds[2] + kinds[3]) / letters,
        "symbols": sum(c for kind, c in of if kind & 1) / n,
        "function": sum(c for kind, c in of if kind & 2) / n,
        "length": sum(map(len, words)) / n,
        "lines": len(set(lines)) / max(1, len(lines)),
        "runs": sum(map(eq, words, islice(words, 1, None))) / n,
    })


def votes(text: str | None) -> list[int]:
    """What each of LABELLERS says of a whole text; nothing but ``length`` on texts without words."""
    return _votes(_measured(text or ""))


def _votes(of: _Measured) -> list[int]:
    m = of.measures
    if not of.words:
        return [0] * (len(LABELLERS) - 1) + [-1]
    long_ = m["n"] >= 20
    return [
        _vote(m["distinct"], bad_below=0.15, good=(0.2, 1)) if 50 <= m["n"] <= 2000 else 0,
        _vote(m["capitals"], bad_above=0.5, good=(0.0, 0.2)),
        _vote(m["symbols"], bad_above=0.25, good=(0, 0.05)),
        _vote(m["function"], bad_below=0.02, good=(0.08, 0.7)) if long_ else 0,
        _vote(m["length"], bad_below=2, bad_above=14),
        _vote(m["lines"], bad_below=0.5) if "\n" in of.text else 0,
        _vote(m["runs"], bad_above=0.2, good=(0, 0.1)) if long_ else 0,
        _vote(m["n"], bad_below=3),
    ]


@dataclass
class LabelModel:
    """Class share, and for each labeller the chances of bad and good given a bad and a good text.

    No opinion is missing data: that a heuristic does not apply says nothing of the class.
    """

    good: float
    chances: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(good) for rows of votes."""
        logs = np.zeros((len(patterns), 2))
        for k, (bad, good) in enumerate(np.log(self.chances).transpose(0, 2, 1)):
            logs += np.where(patterns[:, k : k + 1] < 0, bad, 0) + np.where(patterns[:, k : k + 1] > 0, good, 0)
        logs += np.log([1 - self.good, self.good])
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -40, 40)))


def label_model(patterns: np.ndarray, counts: np.ndarray) -> LabelModel:
    """Accuracies of labellers that are independent given the class, from how often each pattern
    of votes occurs, by expectation-maximisation.

    It starts from texts with any bad vote being bad. PRIOR, in texts of each class, says what
    the labellers are made for: a bad vote is rare on a good text.
    """
    posterior = np.where((patterns < 0).any(axis=1), 0.1, np.where((patterns > 0).any(axis=1), 0.95, 0.5))
    total = max(1.0, float(counts.sum()))
    prior = PRIOR * np.array([[BAD_ON_BAD, 1 - BAD_ON_BAD], [BAD_ON_GOOD, 1 - BAD_ON_GOOD]])
    for _ in range(EM_ROUNDS):
        by_class = np.stack([counts * (1 - posterior), counts * posterior])
        chances = np.stack([(by_class @ (patterns == v)).T for v in (-1, 1)], axis=2) + prior
        chances /= chances.sum(axis=2, keepdims=True)
        model = LabelModel(float(np.clip(by_class[1].sum() / total, 0.01, 0.99)), chances)
        after = model.posterior(patterns)
        if np.abs(after - posterior).max() < 1e-9:
            break
        posterior = after
    return model


@cache
def _steps(name: str, step: int) -> tuple[int, ...]:
    """The buckets of a measure up to a step, of which it has a few dozen at most."""
    return tuple(_hashed(f"m:{name}:{i}") for i in range(step + 1))


def features(text: str | None) -> np.ndarray:
    """Hashed words, their shapes, and the measures of the whole text in steps."""
    return _features(_measured(text or ""))


def _features(of: _Measured) -> np.ndarray:
    known = _BUCKETS.known(of.words, lambda new: map(_buckets, new))
    found = set(chain.from_iterable([known[w] for w in of.words]))
    for name, value in of.measures.items():
        found.update(_steps(name, int(np.log2(value + 1)) if name in ("n", "length") else int(value * 20)))
    return np.unique(np.fromiter(found, np.int32, len(found)))


@dataclass
class Scorer:
    labels: LabelModel
    weights: np.ndarray
    bias: float


def _logistic(rows: list[np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, float]:
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    flat = np.concatenate([np.empty(0, np.int64), *rows]).astype(np.int64)
    scale = 1 / np.sqrt(np.maximum(1, [len(r) for r in rows]))
    share = np.clip(wanted.mean() if len(wanted) else 0.5, 0.01, 0.99)
    cost = (wanted * 0.5 / share + (1 - wanted) * 0.5 / (1 - share)) / max(1, len(rows))
    weights, bias, square, square_b = np.zeros(BUCKETS), 0.0, np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(ROUNDS):
        chance = 1 / (1 + np.exp(-np.clip(np.bincount(owner, weights[flat], len(rows)) * scale + bias, -40, 40)))
        push = cost * (wanted - chance)
        gradient = np.bincount(flat, (push * scale)[owner], BUCKETS) - PENALTY * weights / max(1, len(rows))
        square += gradient**2
        square_b += push.sum() ** 2
        weights += RATE * gradient / np.sqrt(square)
        bias += RATE * push.sum() / np.sqrt(square_b)
    return weights, float(bias)


def train(docs: DataFrame) -> Scorer | None:
    """Fit the label model on the votes over all documents, and the scorer on a bounded sample.

    Votes are counted by pattern, of which there are at most 3**8, whatever the input; only
    the counts reach the driver. The scorer learns the posteriors of SAMPLE documents with the
    smallest hashes of doc_id. No given label is used. None for an empty table.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter(tuple(votes(t.as_py())) for t in batch.column(0))
            yield pa.RecordBatch.from_pydict({"votes": pa.array([list(k) for k in found], pa.list_(pa.int32())), "n": pa.array(found.values(), pa.int64())})

    counted = rows.select("text").mapInArrow(vote, "votes array<int>, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    if not counted:
        return None
    counted = sorted((tuple(r["votes"]), r["n"]) for r in counted)
    model = label_model(np.array([c[0] for c in counted], np.int64), np.array([c[1] for c in counted], np.float64))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_measured(t or "") for t in batch.column(1).to_pylist()]
            good = model.posterior(np.array([_votes(t) for t in texts], np.int64).reshape(len(texts), len(LABELLERS)))
            sets = [_features(t) for t in texts]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "good": pa.array(good), "features": pa.array(sets, pa.list_(pa.int32()))})

    sample = rows.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    found = rows.join(F.broadcast(sample), "doc_id", "left_semi").mapInArrow(featured, "doc_id long, good double, features array<int>").toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("good", "ascending")])
    column = found.column("features").combine_chunks()
    sets = np.split(column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())[:-1]) if found.num_rows else []
    weights, bias = _logistic(sets, found.column("good").to_numpy())
    return Scorer(model, weights, bias)


def score(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id, weak_label, quality, kept.

    ``weak_label`` is the posterior of the votes alone, ``quality`` the scorer's probability
    that the text is good; ``kept`` is quality >= KEEP. NULL and empty texts have no words and
    quality 0. Repeated rows and rows without a doc_id each have their row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weak, quality = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            if scorer is not None and batch.num_rows:
                said = []
                for i, text in enumerate(batch.column(1)):
                    of = _measured(text.as_py() or "")
                    said.append(_votes(of))
                    if of.words:
                        f = _features(of)
                        z = scorer.weights[f].sum() / np.sqrt(len(f)) + scorer.bias
                        quality[i] = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                weak = scorer.labels.posterior(np.array(said, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(weak), pa.array(quality), pa.array(quality >= KEEP)], ["doc_id", "weak_label", "quality", "kept"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, weak_label double, quality double, kept boolean"
    )
