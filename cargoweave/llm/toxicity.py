"""Severity of toxic language by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cargoweave.llm.common import staged

#: Labelled documents of each kind that the model is fitted on at most, drawn by a hash.
SAMPLE = 2000
#: Features are those in at least so many documents of the sample, whose shares of toxic and
#: of other documents differ by at least so many deviations.
SUPPORT, DEVIATIONS = 5, 6.0
#: Severity grades of toxic documents; grade 0 is not toxic.
GRADES = 3
ROUNDS, RATE, PENALTY = 400, 0.5, 1e-3
#: Letters of a word's beginning that are features beside the word.
STEMS = (4, 5)
_EDGES = ".,;:!?\"'()[]{}<>|*%-_"


def word_features(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct lower-cased words of the whole text, bare of punctuation,
    and of the first letters of longer words, which inflected forms of a word share."""
    words = {w.strip(_EDGES) for w in set((text or "").lower().split())}
    words.discard("")
    names = {*words, *(w[:n] + "~" for n in STEMS for w in words if len(w) > n)}
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) >> 1 for w in names), np.int64, len(names)))


@dataclass
class Ordinal:
    """P(grade > k) = sigmoid(sum of the weights of a text's features - threshold k).

    Documents are rejected from ``reject`` on, a probability of any toxicity.
    """

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    reject: float

    def above(self, text: str | None) -> np.ndarray:
        """P(grade > k) for k from 0; zeros for a text without features."""
        found = word_features(text)
        if not len(found):
            return np.zeros(GRADES)
        place = np.minimum(np.searchsorted(self.features, found), len(self.features) - 1)
        return _sigmoid(self.weights[place[self.features[place] == found]].sum() - self.thresholds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _fit(rows: list[np.ndarray], places: int, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights shared by all thresholds, by gradient descent on the log-likelihood.

    Thresholds stay in order since they are a first one and the logarithms of the steps.
    """
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    flat = np.concatenate([np.empty(0, np.int64), *rows]).astype(np.int64)
    weights, first, steps = np.zeros(places), 0.0, np.zeros(GRADES - 1)
    square_w, square_t = np.full(places, 1e-8), np.full(GRADES, 1e-8)
    share = np.bincount(grades, minlength=GRADES + 1) / max(1, len(grades))
    cost = np.where(grades > 0, 0.5 / max(share[1:].sum(), 1e-9), 0.5 / max(share[0], 1e-9)) / max(1, len(grades))
    for _ in range(ROUNDS):
        thresholds = first + np.concatenate([[0], np.cumsum(np.exp(steps))])
        score = np.bincount(owner, weights[flat], len(rows))
        above = _sigmoid(score[:, None] - thresholds)  # P(grade > k)
        edges = np.concatenate([np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))], axis=1)
        slope = edges * (1 - edges)
        here = np.arange(len(rows))
        low, high = edges[here, grades], edges[here, grades + 1]
        chance = np.maximum(low - high, 1e-9)
        push = cost * (slope[here, grades] - slope[here, grades + 1]) / chance
        down = np.zeros((len(rows), GRADES + 2))
        down[here, grades] -= cost * slope[here, grades] / chance
        down[here, grades + 1] += cost * slope[here, grades + 1] / chance
        of_threshold = down[:, 1:-1].sum(axis=0)
        gradient = np.bincount(flat, push[owner], places) - PENALTY * weights
        tail = np.cumsum(of_threshold[::-1])[::-1]
        of_steps = np.concatenate([[tail[0]], tail[1:] * np.exp(steps)])
        square_w += gradient**2
        square_t += of_steps**2
        weights += RATE * gradient / np.sqrt(square_w)
        first += RATE * of_steps[0] / np.sqrt(square_t[0])
        steps += RATE * of_steps[1:] / np.sqrt(square_t[1:])
    return weights, first + np.concatenate([[0], np.cumsum(np.exp(steps))])


def choose(names: np.ndarray, of_toxic: np.ndarray, of_all: np.ndarray, n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The features of a model, sorted, and by how much their share of the ``n`` toxic rows exceeds that
    of the ``m`` others; from how many toxic and how many of all rows hold each feature."""
    of_rest = of_all - of_toxic
    share = (of_toxic + of_rest) / (n + m)
    error = np.sqrt(share * (1 - share) * (1 / n + 1 / m)) + 1e-12
    excess = of_toxic / n - of_rest / m
    chosen = np.flatnonzero((of_all >= SUPPORT) & (np.abs(excess / error) >= DEVIATIONS))
    chosen = chosen[np.argsort(names[chosen])]
    return names[chosen], excess[chosen]


def fit(features: np.ndarray, excess: np.ndarray, rows: list[np.ndarray], toxic: np.ndarray) -> Ordinal:
    """A model of chosen features from the places in them that each row holds, and 0/1 labels.

    The labels name two grades. Severities of toxic rows come from how many features that
    mark toxicity they hold: the rows are cut at equal shares of that count.
    """
    marks = np.array([(excess[r] > 0).sum() for r in rows])
    cuts = np.quantile(marks[toxic > 0], np.arange(1, GRADES) / GRADES)
    grades = np.where(toxic > 0, 1 + np.searchsorted(cuts, marks, "left"), 0).astype(np.int64)
    weights, thresholds = _fit(rows, len(features), grades)
    chance = _sigmoid(np.array([weights[r].sum() for r in rows]) - thresholds[0])
    return Ordinal(features, weights, thresholds, _cut(chance, toxic))


def _cut(chance: np.ndarray, toxic: np.ndarray) -> float:
    """Where the shares of toxic and of other rows at or above differ most; halfway to the next lower chance."""
    steps, place = np.unique(chance, return_inverse=True)
    hit = np.cumsum(np.bincount(place, toxic)[::-1])[::-1] / toxic.sum()
    false = np.cumsum(np.bincount(place, 1 - toxic)[::-1])[::-1] / (1 - toxic).sum()
    best = int((hit - false).argmax())
    return float((steps[best] + steps[max(0, best - 1)]) / 2)


def train(docs: DataFrame, labels: DataFrame) -> Ordinal | None:
    """A model of at most SAMPLE toxic and SAMPLE other labelled documents.

    The sample is those with the smallest hashes of doc_id, so it does not depend on the
    order of rows; it bounds what is sent to the tasks. Features are counted by Spark, and the driver
    gets counts of those with SUPPORT and, for each document of the sample, the chosen ones it holds.
    Labels that are NULL, or of no document, do not count. None, with a warning, if the labelled
    documents do not make a model.
    """
    wanted = [
        labels.where((F.col("toxic") == kind) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(F.min("toxic").cast("int").alias("_toxic"))
        .orderBy(F.xxhash64("_doc"), "_doc").limit(SAMPLE)
        for kind in (0, 1)
    ]
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [word_features(t.as_py()) for t in batch.column(2)]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = pa.array(np.concatenate([np.empty(0, np.int64), *sets]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, flat)], ["doc", "toxic", "features"])

    sample = texts.join(F.broadcast(wanted[0].union(wanted[1])), "_doc").select("_doc", "_toxic", "_text")
    sample = staged(sample.mapInArrow(run, "doc long, toxic int, features array<long>"), "sample")
    rows = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    model = _trained(sample, rows[1], rows[0]) if len(rows) == 2 else None
    if model is None:
        warnings.warn(f"no model of toxicity from {sum(rows.values())} labelled documents: nothing will be rejected", stacklevel=2)
    return model


def _trained(sample: DataFrame, n: int, m: int) -> Ordinal | None:
    """A model of ``sample`` (doc, toxic, features sorted) of ``n`` toxic and ``m`` other rows; None
    if no feature tells them apart."""
    counts = (
        sample.select("toxic", F.explode("features").alias("feature"))
        .groupBy("feature").agg(F.sum("toxic").alias("of_toxic"), F.count("*").alias("of_all"))
        .where(F.col("of_all") >= SUPPORT).toArrow()
    )
    features, excess = choose(*(counts.column(c).to_numpy() for c in ("feature", "of_toxic", "of_all")), n, m)
    if not len(features):
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = []
            for held in batch.column(2):
                held = held.values.to_numpy()
                place = np.minimum(np.searchsorted(features, held), len(features) - 1)
                places.append(place[features[place] == held])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places, pa.list_(pa.int64()))], ["doc", "toxic", "places"])

    found = sample.mapInArrow(run, "doc long, toxic int, places array<long>").toArrow().sort_by([("doc", "ascending"), ("toxic", "ascending")])
    column = found.column("places").combine_chunks()
    rows = np.split(column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())[:-1])
    return fit(features, excess, rows, found.column("toxic").to_numpy())


def score(docs: DataFrame, model: Ordinal | None) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id, p_toxic, severity, grade, rejected.

    ``severity`` is the expected grade, ``grade`` the likeliest. NULL and empty texts have no
    features; what a text without features gets is 0 and not rejected. Without a model all
    rows get that. Repeated rows and rows without a doc_id each have their row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            above = np.zeros((n, GRADES))
            if model:
                for i, text in enumerate(batch.column(1)):
                    above[i] = model.above(text.as_py())
            chances = np.concatenate([np.ones((n, 1)), above], axis=1) - np.concatenate([above, np.zeros((n, 1))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(above[:, 0]), pa.array(above.sum(axis=1)),
                 pa.array(chances.argmax(axis=1).astype(np.int32)), pa.array(above[:, 0] >= (model.reject if model else 2.0))],
                ["doc_id", "p_toxic", "severity", "grade", "rejected"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, p_toxic double, severity double, grade int, rejected boolean"
    )


def without_toxic(docs: DataFrame, model: Ordinal | None) -> DataFrame:
    """The rows of ``docs`` whose own text is not rejected, in one pass and with all columns."""
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [model.above(text.as_py())[0] < model.reject for text in batch.column("text")]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
