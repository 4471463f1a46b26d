"""The quality and toxicity operators once more in plain loops, compared on whole results."""

import math
import random
from collections import Counter, defaultdict

import pytest
import xxhash

from cargoweave.llm import quality, toxicity
from tests.llm.conftest import SCHEMA, prose


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


# --- quality


def measures(text):
    words, n = text.split(), max(1, len(text.split()))
    letters = sum(c.isalpha() for c in text) or 1
    lines = [x for x in text.split("\n") if x.strip()]
    ends = lambda w: not w[-2:].isalnum() and not w[-2:-1].isalnum() and len(w) > 1
    return words, {
        "n": len(words), "distinct": len(set(words)) / n, "top": max(Counter(words).values(), default=0) / n,
        "capitals": sum(c.isupper() for c in text) / letters,
        "symbols": sum(not any(c.isalnum() for c in w) or ends(w) for w in words) / n,
        "function": sum(w.lower().strip(".,;:!?%") in quality.FUNCTION_WORDS for w in words) / n,
        "length": sum(map(len, words)) / n, "lines": len(set(lines)) / max(1, len(lines)),
        "runs": sum(a == b for a, b in zip(words, words[1:])) / n,
    }


def plain_votes(text):
    words, m = measures(text)
    if not words:
        return (0, 0, 0, 0, 0, 0, 0, -1)
    say = lambda bad, good=False: -1 if bad else int(good)
    return (
        say(m["distinct"] < 0.15, 0.2 <= m["distinct"] <= 1) if 50 <= m["n"] <= 2000 else 0,
        say(m["capitals"] > 0.5, m["capitals"] <= 0.2),
        say(m["symbols"] > 0.25, m["symbols"] <= 0.05),
        say(m["function"] < 0.02, 0.08 <= m["function"] <= 0.7) if m["n"] >= 20 else 0,
        say(m["length"] < 2 or m["length"] > 14),
        say(m["lines"] < 0.5) if "\n" in text else 0,
        say(m["runs"] > 0.2, m["runs"] <= 0.1) if m["n"] >= 20 else 0,
        say(m["n"] < 3),
    )


def plain_features(text):
    words, m = measures(text)
    names = set()
    for w in words:
        core = w.strip(".,;:!?%")
        kind = "U" if core.isupper() and len(core) > 1 else "a" if core.isalnum() else "x"
        names |= {"w:" + w.lower(), "s:" + kind + w[len(core) :][:3]}
    for name, value in m.items():
        top = int(math.log2(value + 1)) if name in ("n", "length") else int(value * 20)
        names |= {f"m:{name}:{i}" for i in range(top + 1)}
    return {xxhash.xxh3_64_intdigest(x.encode()) % quality.BUCKETS for x in names}


def plain_quality(texts):
    """For each text the posterior of its votes and the scorer's probability."""
    votes = [plain_votes(t) for t in texts]
    counts = sorted(Counter(votes).items())
    posterior = {v: 0.1 if -1 in v else 0.95 if 1 in v else 0.5 for v, _ in counts}
    prior = {0: (quality.PRIOR * quality.BAD_ON_BAD, quality.PRIOR * (1 - quality.BAD_ON_BAD)),
             1: (quality.PRIOR * quality.BAD_ON_GOOD, quality.PRIOR * (1 - quality.BAD_ON_GOOD))}
    for _ in range(quality.EM_ROUNDS):
        chances = []
        for k in range(8):
            of = {}
            for c in (0, 1):
                share = lambda v: posterior[v] if c else 1 - posterior[v]  # noqa: B023, E731
                bad = sum(n * share(v) for v, n in counts if v[k] < 0) + prior[c][0]
                good = sum(n * share(v) for v, n in counts if v[k] > 0) + prior[c][1]
                of[c] = (bad / (bad + good), good / (bad + good))
            chances.append(of)
        total = sum(n for _, n in counts)
        right = min(0.99, max(0.01, sum(n * posterior[v] for v, n in counts) / total))
        after = {}
        for v, _ in counts:
            logs = [math.log(1 - right), math.log(right)]
            for k, x in enumerate(v):
                for c in (0, 1):
                    logs[c] += math.log(chances[k][c][0]) if x < 0 else math.log(chances[k][c][1]) if x > 0 else 0
            after[v] = sigmoid(logs[1] - logs[0])
        done = max(abs(after[v] - posterior[v]) for v, _ in counts) < 1e-9
        if done:
            break
        posterior = after
    wanted, rows = [after[v] for v in votes], [plain_features(t) for t in texts]
    share = min(0.99, max(0.01, sum(wanted) / len(rows)))
    cost = [(w * 0.5 / share + (1 - w) * 0.5 / (1 - share)) / len(rows) for w in wanted]
    weights, bias, square, square_b = defaultdict(float), 0.0, defaultdict(lambda: 1e-8), 1e-8
    for _ in range(quality.ROUNDS):
        push = [c * (w - sigmoid(sum(weights[f] for f in r) / math.sqrt(len(r)) + bias)) for c, w, r in zip(cost, wanted, rows)]
        gradient = defaultdict(float)
        for p, r in zip(push, rows):
            for f in r:
                gradient[f] += p / math.sqrt(len(r))
        for f, g in gradient.items():
            g -= quality.PENALTY * weights[f] / len(rows)
            square[f] += g * g
            weights[f] += quality.RATE * g / math.sqrt(square[f])
        square_b += sum(push) ** 2
        bias += quality.RATE * sum(push) / math.sqrt(square_b)
    scores = [sigmoid(sum(weights[f] for f in r) / math.sqrt(len(r)) + bias) if t.split() else 0.0 for t, r in zip(texts, rows)]
    return wanted, scores


def test_quality_is_the_plain_one(spark):
    r = random.Random(21)
    good = [" ".join(r.choice(["the", "of", "a", *prose(r, 8).split()]) for _ in range(r.randrange(3, 80))) + "." for _ in range(30)]
    bad = ["BUY NOW " * r.randrange(3, 30) for _ in range(6)] + ["$$ !! ## " * 9, "word " * 60, "x\nx\nx\ny", "hi", "", "   ", "É ß ǅ 中文 " * 8]
    texts = good + bad
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    weak, scores = plain_quality(texts)
    got = {x["doc_id"]: x for x in quality.score(docs, quality.train(docs)).collect()}
    for i in range(len(texts)):
        assert got[i]["weak_label"] == pytest.approx(weak[i], abs=1e-6), texts[i]
        assert got[i]["quality"] == pytest.approx(scores[i], abs=1e-6), texts[i]
        assert got[i]["kept"] == (got[i]["quality"] >= quality.KEEP)
    assert {got[i]["kept"] for i in range(len(texts))} == {True, False}


# --- toxicity


def marks(text):
    words = {w.strip(toxicity._EDGES) for w in text.lower().split()} - {""}
    return words | {w[:n] + "~" for n in toxicity.STEMS for w in words if len(w) > n}


def plain_toxicity(texts, toxic, others):
    """For each of ``others`` P(grade > k) and whether it is rejected, of a model of the labelled texts."""
    sets = [marks(t) for t in texts]
    n, m = sum(toxic), len(toxic) - sum(toxic)
    of_toxic, of_rest = Counter(), Counter()
    for s, t in zip(sets, toxic):
        (of_toxic if t else of_rest).update(s)
    excess = {}
    for w in {*of_toxic, *of_rest}:
        share = (of_toxic[w] + of_rest[w]) / (n + m)
        error = math.sqrt(share * (1 - share) * (1 / n + 1 / m)) + 1e-12
        x = of_toxic[w] / n - of_rest[w] / m
        if of_toxic[w] + of_rest[w] >= toxicity.SUPPORT and abs(x / error) >= toxicity.DEVIATIONS:
            excess[w] = x
    rows = [s & set(excess) for s in sets]
    held = [sum(excess[w] > 0 for w in s) for s in rows]
    of = sorted(h for h, t in zip(held, toxic) if t)

    def quantile(q):
        at = q * (len(of) - 1)
        low = int(at)
        return of[low] + (at - low) * (of[min(low + 1, len(of) - 1)] - of[low])

    cuts = [quantile(k / toxicity.GRADES) for k in range(1, toxicity.GRADES)]
    grades = [1 + sum(c < h for c in cuts) if t else 0 for h, t in zip(held, toxic)]
    k_all, weights, first, steps = toxicity.GRADES, defaultdict(float), 0.0, [0.0] * (toxicity.GRADES - 1)
    square, square_t = defaultdict(lambda: 1e-8), [1e-8] * k_all
    bad = max(sum(g > 0 for g in grades) / len(grades), 1e-9)
    cost = [(0.5 / bad if g else 0.5 / max(1 - bad, 1e-9)) / len(grades) for g in grades]

    def thresholds():
        return [first, *(first + sum(math.exp(s) for s in steps[: k + 1]) for k in range(len(steps)))]

    for _ in range(toxicity.ROUNDS):
        cut, gradient, of_cut = thresholds(), defaultdict(float), [0.0] * k_all
        for row, g, c in zip(rows, grades, cost):
            score = sum(weights[w] for w in row)
            edges = [1.0, *(sigmoid(score - t) for t in cut), 0.0]
            slope = [e * (1 - e) for e in edges]
            chance = max(edges[g] - edges[g + 1], 1e-9)
            for w in row:
                gradient[w] += c * (slope[g] - slope[g + 1]) / chance
            if g > 0:
                of_cut[g - 1] -= c * slope[g] / chance
            if g < k_all:
                of_cut[g] += c * slope[g + 1] / chance
        for w in excess:
            x = gradient[w] - toxicity.PENALTY * weights[w]
            square[w] += x * x
            weights[w] += toxicity.RATE * x / math.sqrt(square[w])
        tail = [sum(of_cut[k:]) for k in range(k_all)]
        of_steps = [tail[0], *(tail[k + 1] * math.exp(steps[k]) for k in range(k_all - 1))]
        for k, x in enumerate(of_steps):
            square_t[k] += x * x
        first += toxicity.RATE * of_steps[0] / math.sqrt(square_t[0])
        steps = [s + toxicity.RATE * x / math.sqrt(q) for s, x, q in zip(steps, of_steps[1:], square_t[1:])]
    cut = thresholds()
    above = lambda s: [sigmoid(sum(weights[w] for w in s if w in excess) - t) for t in cut] if s else [0.0] * k_all
    chance = [sigmoid(sum(weights[w] for w in s) - cut[0]) for s in rows]
    best, reject = -9.0, None
    ordered = sorted(set(chance))
    for k, x in enumerate(ordered):
        gain = sum(c >= x and t for c, t in zip(chance, toxic)) / n - sum(c >= x and not t for c, t in zip(chance, toxic)) / m
        if gain > best + 1e-12:
            best, reject = gain, (x + ordered[max(0, k - 1)]) / 2
    return [(above(marks(t)), above(marks(t))[0] >= reject) for t in others]


def test_toxicity_is_the_plain_one(spark):
    r = random.Random(22)
    bad = [f"nasty{c}word" for c in "abcdefgh"]
    texts, toxic = [], []
    for i in range(160):
        toxic.append(int(i % 3 == 0))
        texts.append(f"{prose(r, r.randrange(2, 12))} {' '.join(r.sample(bad, r.randrange(1, 7))) if toxic[-1] else ''}")
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)] + [(900, "", None, None, None), (901, " ".join(bad), None, None, None)], SCHEMA)
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    others = [*texts, "", " ".join(bad)]
    want = plain_toxicity(texts, toxic, others)
    got = {x["doc_id"]: x for x in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    for i, (above, rejected) in zip([*range(160), 900, 901], want):
        assert got[i]["p_toxic"] == pytest.approx(above[0], abs=1e-6) and got[i]["severity"] == pytest.approx(sum(above), abs=1e-6)
        chances = [a - b for a, b in zip([1.0, *above], [*above, 0.0])]
        assert chances[got[i]["grade"]] == pytest.approx(max(chances), abs=1e-6)
        assert got[i]["rejected"] == rejected, others[i if i < 900 else i - 740]
    assert {x["rejected"] for x in got.values()} == {True, False}
