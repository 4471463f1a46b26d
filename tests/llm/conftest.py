import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Names that operators use inside.
CLASHING = ("id", "bucket", "copies", "target", "ids", "n_lines", "_lines", "_copy", "stretch", "key", "spans", "size", "component_id",
            "_gone", "_doc", "_source", "_whole", "gone", "lines", "copy", "c0", "c1", "a`b", "a.b")


def prose(random_, words):
    return " ".join("".join(random_.choice("abcdefgh") for _ in range(random_.randint(2, 7))) for _ in range(words))


def corpus(seed=3):
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared lines, odd rows."""
    r = random.Random(seed)
    texts = [prose(r, r.randint(1, 120)) for _ in range(40)]
    for base in texts[:8]:
        words = base.split()
        for _ in range(3):
            near = list(words)
            near[r.randrange(len(near))] = "changed"
            texts.append(" ".join(near))
    texts += [texts[0]] * 5 + [texts[20].upper()]
    shared = prose(r, 60)
    texts += [f"{prose(r, 30)}\n{shared}\n{prose(r, 12)}" for _ in range(6)]
    texts += [f"{prose(r, 20)}\n{shared[:40]}X{shared[41:]}", "", "   ", None, "one two", "x", "\n\n", "é　中 𝒳" * 3, "word " * 5000]
    rows = [(i * 3, t, "en", f"src{i % 4}" if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "no id here at all", "en", "src1", 5), (None, None, None, None, None), (7_000, texts[1], None, "src1", None)]
    return rows


@pytest.fixture(scope="module")
def rows_in():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows_in):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows_in, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHING}).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
