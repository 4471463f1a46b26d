"""Classifiers: held-out accuracy on the given labels, and rows out of the ordinary."""

import random
import tracemalloc

import numpy as np
import pytest

from cargoweave.llm import quality, toxicity
from tests.llm.conftest import SCHEMA, prose

TABLES = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    return docs, spark.read.parquet(f"{TABLES}/labels.parquet")


def test_toxicity_on_labels_held_out(given):
    docs, labels = given
    model = toxicity.train(docs, labels.where("doc_id % 2 = 0"))
    scored = toxicity.score(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    hit = [r["rejected"] for r in scored if r["toxic"]]
    false = [r["rejected"] for r in scored if not r["toxic"]]
    assert np.mean(hit) > 0.6 and np.mean(false) < 0.02


def test_severity_grows_with_marks(spark):
    r = random.Random(1)
    marks = [f"bad{i}word" for i in range(8)]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        extra = " ".join(r.sample(marks, r.randint(1, 8))) if toxic else ""
        rows.append((i, f"{prose(r, 30)} {extra}", "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    rows += [(None, "no id", None, None, None), (1000, None, None, None, None), (1001, "", None, None, None), rows[0], (1002, "x " * 50_000, None, None, None)]
    labels += [(None, 1, 1), (5000, 1, None), (6000, 0, 1)]
    docs, given = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, given)
    assert (np.diff(model.thresholds) > 0).all()
    few, many = (model.above(f"some text {' '.join(marks[:n])}").sum() for n in (1, 8))
    assert few < many and model.above("some text")[0] < model.reject <= model.above(marks[0])[0]
    scored = toxicity.score(docs, model).collect()
    assert len(scored) == len(rows)
    assert all(not s["rejected"] and s["severity"] == 0 for s in scored if s["doc_id"] in (1000, 1001))
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert sorted(map(repr, kept.select("doc_id").collect())) == sorted(repr(s) for s in toxicity.score(docs, model).where("not rejected").select("doc_id").collect())


def test_training_takes_few_features_to_the_driver(spark):
    words = "transform(sequence(0, 2999), k -> concat('w', md5(concat(id, ':', k))))"
    docs = spark.range(200).selectExpr("id AS doc_id", f"concat_ws(' ', {words}, IF(id % 4 = 0, 'nasty vile', 'kind')) AS text").repartition(8)
    labels = spark.range(200).selectExpr("id AS doc_id", "CAST(id % 4 = 0 AS int) AS toxic")
    tracemalloc.start()
    try:
        model = toxicity.train(docs, labels)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert set(model.features) == set(toxicity.word_features("nasty vile kind"))
    assert model.above("nasty vile")[0] >= model.reject > model.above("kind")[0]
    assert most < 8_000_000, "features that no model takes came to the driver"


def test_toxicity_without_a_model(spark, docs, empty, rows_in):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    with pytest.warns(UserWarning, match="nothing will be rejected"):
        assert toxicity.train(docs, none) is None and toxicity.train(empty, none) is None
    scored = toxicity.score(docs, None).collect()
    assert len(scored) == len(rows_in) and not any(r["rejected"] for r in scored)
    assert toxicity.without_toxic(docs, None).count() == len(rows_in)
    assert toxicity.score(empty, None).count() == 0


def test_quality_on_labels(given):
    docs, labels = given
    scored = quality.score(docs, quality.train(docs)).join(labels, "doc_id").collect()
    kept = [r["kept"] for r in scored if r["quality"] is not None and r[-2] == 1]
    bad = [r["kept"] for r in scored if r[-2] == 0]
    assert np.mean(kept) > 0.97 and np.mean(bad) < 0.3


def test_label_model_finds_accuracies():
    r = np.random.default_rng(2)
    good = r.random(20_000) < 0.8
    votes = np.zeros((len(good), 8), np.int64)
    for k in range(8):
        says_bad = np.where(good, r.random(len(good)) < 0.01, r.random(len(good)) < 0.3 + 0.05 * k)
        votes[:, k] = np.where(r.random(len(good)) < 0.2, 0, np.where(says_bad, -1, 1))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.label_model(patterns, counts.astype(float))
    assert abs(model.good - 0.8) < 0.1
    assert (model.chances[:, 0, 0] > model.chances[:, 1, 0] * 5).all()
    assert ((model.posterior(votes) > 0.5) == good).mean() > 0.94


@pytest.mark.parametrize("texts", [20_000, 80_000])
def test_label_model_tells_good_labellers_from_poor_on_a_rare_class(texts):
    r = np.random.default_rng(3)
    bad = r.random(texts) < 0.05
    on_bad = np.array([0.9, 0.01, 0.6, 0.3, 0.1, 0.5, 0.7, 0.2])
    on_good = np.array([0.01, 0.001, 0.02, 0.01, 0.001, 0.005, 0.01, 0.01])
    says_bad = r.random((texts, 8)) < np.where(bad[:, None], on_bad, on_good)
    votes = np.where(r.random((texts, 8)) < 0.2, 0, np.where(says_bad, -1, 1))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.label_model(patterns, counts.astype(float))
    assert np.abs(model.chances[:, 0, 0] - on_bad).max() < 0.07 and np.abs(model.chances[:, 1, 0] - on_good).max() < 0.01
    assert abs(model.good - 0.95) < 0.01


def test_quality_of_odd_rows(docs, empty, rows_in):
    scored = quality.score(docs, quality.train(docs)).collect()
    assert len(scored) == len(rows_in)
    assert quality.train(empty) is None and quality.score(empty, None).count() == 0
    assert all(0 <= r[2] <= 1 for r in scored)
