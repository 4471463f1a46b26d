"""The pipeline against a brute-force version of its stages, and the registered queries."""

import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cargoweave.llm import mixing, toxicity
from cargoweave.llm.queries import ORACLE_SQL, PATTERN, QUERIES, RANKS
from tests.llm.conftest import SCHEMA, corpus
from tests.llm.test_exact import as_tiktoken, brute_lines, classes, shingles


@pytest.fixture(scope="module")
def folder(spark):
    path = tempfile.mkdtemp()
    rows = [r for r in corpus(5) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    rows += [(9000 + i, f"{rows[i][1]} nasty vile words number {i}", "en", "src2", 9) for i in range(30)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], 1, int(r[0] >= 9000)) for r in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, labels


def test_pipeline_is_brute_force(spark, folder):
    path, rows, labels = folder
    toxic = dict((i, t) for i, _, t in labels)
    sample = sorted(rows)
    model = toxicity.train(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    stay = [r for r in sample if model.above(r[1])[0] < model.reject]
    assert {r[0] for r in sample} - {r[0] for r in stay} <= {i for i, t in toxic.items() if t}
    lines = dict(brute_lines([r[:2] for r in stay]))
    stay = [(i, lines[i], lang, s, n) for i, t, lang, s, n in stay if lines[i] == t or (lines[i] or "").strip(" ")]
    ids = [r[0] for r in stay]
    sets = {r[0]: shingles(r[1]) for r in stay}
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    of = classes(ids, links)
    stay = [r for r in stay if of[r[0]] == r[0]]
    sized = mixing.sizes(spark.createDataFrame(stay, SCHEMA))
    copies = {r["doc_id"]: r["copies"] for r in mixing.with_copies(sized, mixing.plan(sized), F.col("size")).collect()}
    library = as_tiktoken()
    want = Counter()
    for i, text, _, source, _ in stay:
        ids = tuple(library.encode_ordinary(text or ""))
        want[i, source, len(ids), ids] += copies[i]
    got = Counter((r["doc_id"], r["source"], r["n_tokens"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, path).collect())
    assert got == +want


def test_stages_keep_the_columns(spark, folder):
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns
        assert stage(spark, docs.limit(0), path).count() == 0


def test_registered_names():
    assert [n.split("_")[0] for n in QUERIES] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
    assert set(ORACLE_SQL) < set(QUERIES) and RANKS and PATTERN
