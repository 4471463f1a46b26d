"""Benchmark passages, hard negatives and periodic runs against brute force, and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from cargoweave.llm import decontamination, hard_negatives, periodic_runs

NAMES = ("hits", "cuts", "items", "n_words", "_text", "_hits", "_items", "c0", "c1", "row", "runs", "key", "octave", "a`b", "a.b")


def clashing(df):
    return df.withColumns({n: F.lit("clash") for n in NAMES})


# --- benchmark passages


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [(m[0], m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)]


def brute_passages(text, items):
    """(n_words, hit word numbers, item ids) of one text."""
    spoken = [w for w, *_ in plain_words(text)]
    hit, found = set(), set()
    for item, item_text in items:
        own = [w for w, *_ in plain_words(item_text)]
        for k in range(max(1, len(own) - 9) if own else 0):
            window = own[k : k + 10]
            for at in range(len(spoken) - len(window) + 1):
                if spoken[at : at + len(window)] == window:
                    hit |= set(range(at, at + len(window)))
                    found |= {str(item)} if item is not None else set()
    return len(spoken), hit, sorted(found)


def passages():
    r = random.Random(11)
    vocabulary = ["a", "b", "c", "word", "Größe", "中文", "x9", "naïve"]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, say(r.randrange(11, 40))) for i in range(12)]
    items += [(20, "a word of few"), (21, "rare"), (22, ""), (23, None), (None, "nameless item of five words"), (24, "..."), (1, items[1][1]), (3, "another text of a known id")]
    texts = [say(r.randrange(0, 60)) for _ in range(25)]
    for _, text in items[:12]:
        own = text.split()
        texts += [f"{say(9)} {text.upper()}, {say(5)}", f"{say(3)}\n{'; '.join(own[3:14])}! rare"]
    texts += ["", None, "  ", "rare", "RARE rare\x00rare", "nameless item of five words", "a word, of few", items[0][1] * 300, "b " * 30_000, "é" * 200]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[30], rows[30], (None, texts[30]), (7, "a second text rare")], items


ITEMS = "item_id long, text string"


def test_passages_are_brute_force(spark):
    rows, items = passages()
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(items, ITEMS)
    got = Counter(tuple(r) for r in decontamination.digests(clashing(docs), clashing(benchmark)).collect())
    want = Counter()
    for i, text in rows:
        n, hit, found = brute_passages(text, items)
        want[i, n, len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)] += 1
    assert got == want
    assert 15 < sum(k[-1] for k in got) < len(rows) - 10


def test_passages_in_blocks_and_small_shards(spark, monkeypatch):
    rows, items = passages()
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    whole = sorted(map(tuple, decontamination.digests(docs, benchmark).collect()), key=repr)
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 60)
    monkeypatch.setattr(decontamination, "SHARD_BYTES", 300)
    assert len(list(decontamination._blocks(benchmark))) > 3
    assert sorted(map(tuple, decontamination.digests(docs, benchmark).collect()), key=repr) == whole


def test_passages_are_cut(spark):
    rows, items = passages()
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    left = decontamination.without_passages(docs, spark.createDataFrame(items, ITEMS))
    assert left.columns == docs.columns
    want = Counter()
    for i, text in rows:
        if text is not None:
            places = plain_words(text)
            _, hit, _ = brute_passages(text, items)
            keep, last = "", 0
            for k in sorted(hit):
                if k - 1 not in hit:
                    keep += text[last : places[k][1]]
                last = places[k][2]
            text = keep + text[last:]
        want[i, text] += 1
    assert Counter(tuple(r) for r in left.select("doc_id", "text").collect()) == want


def test_no_benchmark_and_no_documents(spark):
    rows, items = passages()
    docs, none = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([], ITEMS)
    got = decontamination.digests(docs, none).collect()
    assert len(got) == len(rows) and not any(r["contaminated"] for r in got)
    assert {(r["doc_id"], r["n_words"]) for r in got} == {(i, len(plain_words(t))) for i, t in rows}
    assert decontamination.digests(docs.limit(0), spark.createDataFrame(items, ITEMS)).count() == 0
    assert decontamination.without_passages(docs, none).count() == len(rows)


def test_the_index_counts_and_finds():
    r = random.Random(1)
    for _ in range(200):
        n = r.randrange(1, 80)
        symbols = np.array([r.choice([0, 1, 1, 2, 3]) for _ in range(n)] + [0])
        index = decontamination.FmIndex(symbols, 3)
        lengths = np.array([r.randrange(1, 5) for _ in range(6)])
        phrases = np.zeros((6, 4), np.int64)
        for k, size in enumerate(lengths):
            phrases[k, 4 - size :] = [r.randrange(1, 4) for _ in range(size)]
        low, high = index.search(phrases, lengths)
        for k, size in enumerate(lengths):
            phrase = phrases[k, 4 - size :].tolist()
            want = [i for i in range(n + 1) if symbols[i : i + size].tolist() == phrase]
            assert sorted(index.locate(np.arange(low[k], high[k])).tolist()) == want


def test_suffixes_are_in_order():
    r = random.Random(2)
    for depth in (2, 20):
        for _ in range(100):
            symbols = np.array([r.choice([0, 1, 1, 1, 2, 3]) for _ in range(r.randrange(1, 200))] + [0])
            breaks = {int(i): k for k, i in enumerate(np.flatnonzero(symbols == 0))}
            keys = [[breaks[j] - 1000 if symbols[j] == 0 else int(symbols[j]) for j in range(i, len(symbols))] for i in range(len(symbols))]
            assert decontamination.suffix_order(symbols, depth).tolist() == sorted(range(len(symbols)), key=keys.__getitem__)


# --- hard negatives

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
])


def brute_negatives(rows):
    use = []
    for i, label, v in set((i, n, tuple(v) if v is not None else None) for i, n, v in rows):
        if None not in (i, label, v) and v and all(x is not None and math.isfinite(x) for x in v):
            use.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v]))
    anchors = {}
    for i, label, v in use:
        if i % 100 == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    out = []
    for i, (label, v) in anchors.items():
        scored = [(-sum(a * b for a, b in zip(v, w)), j, n == label) for j, n, w in use if j != i and len(w) == len(v)]
        scored = sorted({(max(-(2**63) + 1, min(2**63 - 1, s)), j, same) for s, j, same in scored})
        for s, j, same in [x for x in scored if x[2]][:5]:
            inside = [x for x in scored if not x[2] and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(i, j, k, x[1], -s, -x[0]) for k, x in enumerate(inside, 1)]
    return sorted(out)


def vectors():
    r = random.Random(12)
    rows = []
    for i in range(700):
        base = [r.choice([-1.0, 0.5, 0.25, 1.0]) for _ in range(6)]
        rows.append((i, r.randrange(3), [x + r.choice([0, 0, 0.01]) for x in base]))
    odd = [(1000, None, [1.0] * 6), (1001, 1, None), (1002, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1003, 1, [float("nan")] * 6),
           (1004, 1, [float("inf")] * 6), (1005, 1, []), (None, 1, [1.0] * 6), (1100, 1, [0.0] * 6), (1200, 2, [1.0, 2.0]), (1201, 2, [2.0, 2.0]),
           (1202, 1, [1.0, 1.5]), (2000, 0, [3e37] * 6), (2001, 0, [2e12] * 6), (2002, 1, [1e12] * 6), (-100, 1, [1.0] * 6)]
    return rows + odd + [rows[0], rows[0], rows[101], rows[200], (300, 1, [9.0] * 6), (5, 2, [1.0] * 6)]


def test_negatives_are_brute_force(spark):
    rows = vectors()
    df = clashing(spark.createDataFrame(rows, VECTORS).repartition(5))
    got = hard_negatives.mined(df)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows)
    assert got.count() > 100


def test_negatives_of_many_blocks(spark, monkeypatch):
    rows = vectors()
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 3)
    monkeypatch.setattr(hard_negatives, "ROWS", 7)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    assert sorted(map(tuple, hard_negatives.mined(df).collect())) == brute_negatives(rows)


def test_no_vectors_and_no_anchors(spark):
    df = spark.createDataFrame(vectors(), VECTORS)
    assert hard_negatives.mined(df.limit(0)).collect() == []
    assert hard_negatives.mined(df.where("vec_id % 100 <> 0")).collect() == []
    assert hard_negatives.mined(df.where("vec_id = 100")).collect() == []


def test_keys_are_in_order():
    r = random.Random(3)
    most = 2**63 - 1
    draw = lambda: r.choice([0, 1, -1, most, -most, r.randrange(-most, most)])
    entries = [(draw(), draw(), r.random() < 0.5, draw()) for _ in range(400)]
    packed = [hard_negatives.pack(np.array([a]), np.array([s]), n, np.array([i]))[0].as_py() for a, s, n, i in entries]
    assert [hard_negatives.unpack(k) for k in sorted(packed)] == sorted(entries, key=lambda e: (e[0], -e[1], e[2], e[3]))


# --- periodic runs


def brute_runs(w):
    """(start, period, length) of the runs of a list."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, q, length) for (s, length), q in out.items())


def changed(i, spoken):
    n = len(spoken)
    if i is None or not n or zlib.crc32(str(i).encode()) % 10:
        return spoken
    g = zlib.crc32(str(i).encode()) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [spoken[k] if k < a else spoken[a + (k - a) % p] for k in range(n)]


def repeating():
    r = random.Random(13)
    texts = []
    for _ in range(150):
        w = []
        for _ in range(r.randrange(1, 7)):
            block = [r.choice("abcd") for _ in range(r.randrange(1, 14))]
            w += (block * r.randrange(2, 9))[: r.randrange(1, 60)] if r.random() < 0.6 else [str(r.randrange(r.choice([2, 3, 50]))) for _ in range(r.randrange(25))]
        texts.append(r.choice([" ", "\n", "  \t"]).join(w))
    long_ = [r.choice("abcdefgh") for _ in range(700)]
    texts += ["", None, "  \n", "one", "x " * 5, "x " * 6, "x " * 4000, "a b " * 900, " ".join(long_ * 4), " ".join(long_ * 4 + ["z"] + long_ * 5), "é ß " * 40]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, "a b c " * 30), (-5, "q " * 50), (9, None)]


def test_runs_are_brute_force(spark):
    rows = repeating()
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    got = Counter(tuple(r) for r in periodic_runs.digests(docs).collect())
    want, total = Counter(), 0
    for i, text in rows:
        spoken = changed(i, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        runs = brute_runs(spoken)
        total += len(runs)
        best = min(runs, key=lambda x: (-x[2], x[0], x[1])) if runs else None
        gone = {k for s, q, n in runs for k in range(s + q, s + n)}
        kept = " ".join(w for k, w in enumerate(spoken) if k not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        figures = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
        want[i, len(runs), *figures, sha(lines), sha(kept)] += 1
    assert got == want and total > 100


def test_runs_of_small_batches(spark, monkeypatch):
    rows = repeating()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, periodic_runs.digests(docs).collect()), key=repr)
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", 200)
    assert sorted(map(tuple, periodic_runs.digests(docs).collect()), key=repr) == whole


def test_runs_keep_the_text(spark):
    df = spark.createDataFrame([(1, "say it say it say it say it say it now"), (2, "plain text"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["collapsed"], r["n_words"]) for r in periodic_runs.periodic_runs(df).collect()}
    assert got == {1: ("say it now", 11), 2: ("plain text", 2), 3: ("", 0)}


def test_no_documents_no_runs(spark, empty):
    assert periodic_runs.digests(empty).collect() == []


@pytest.mark.parametrize("symbols", ["", "a", "aaaa", "abcabcab", "abacabadabacaba"])
def test_z_function(symbols):
    want = [next((k for k in range(len(symbols) - i) if symbols[k] != symbols[i + k]), len(symbols) - i) for i in range(len(symbols))]
    assert periodic_runs.z_function(list(symbols)) == want
