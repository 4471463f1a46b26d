"""Operators whose whole result is known: against brute force or the libraries themselves."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F, types as T
from tokenizers import Tokenizer

from cargoweave.llm import byte_bpe, embedding_dedup, fingerprints, graph, line_dedup, minhash_dedup, mixing, pii, token_codes
from cargoweave.llm.common import chunks
from cargoweave.llm.queries import END_ID, PATTERN, RANKS, TOKENIZER, op2_document_fingerprints


def classes(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def test_components_of_chains_stars_and_loops(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, x) for x in range(501, 530)] + [(9, 9)]
    edges += [(r.randrange(1000, 1100), r.randrange(1000, 1100)) for _ in range(60)]
    r.shuffle(edges)
    got = {x["node"]: x["component"] for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == classes(linked, [e for e in edges if e[0] != e[1]])


def test_minhash_is_brute_force(docs, rows_in):
    sets = defaultdict(set)
    for i, text, *_ in rows_in:
        sets[i].add(shingles(text))
    known = {i: next(iter(s)) for i, s in sets.items() if i is not None}
    ids = sorted(known)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if known[a] and known[b] and 100 * len(known[a] & known[b]) >= 75 * len(known[a] | known[b])
    ]
    want = classes(ids, links)
    got = minhash_dedup.near_duplicates(docs).collect()
    assert len(got) == len(rows_in)
    for row in got:
        if row["doc_id"] is None:
            assert row["component_id"] is None and row["kept"] is False
        else:
            assert (row["n_shingles"], row["component_id"]) == (len(known[row["doc_id"]]), want[row["doc_id"]])
            assert row["kept"] == (row["doc_id"] == row["component_id"])
    assert len(set(want.values())) < len(ids)


def test_residual_links_that_stars_do_not_see(spark):
    """A chain in which neighbours are near and the ends are not."""
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[k * 3 : k * 3 + 34]) for k in range(8)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a in range(8) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert got == classes(range(8), links) and links


def test_odd_sketches_keep_similar_pairs():
    r = np.random.default_rng(3)
    for _ in range(60):
        common = r.integers(0, 2**63, 600, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, r.integers(0, 2**63, 100, dtype=np.uint64)])) for _ in range(2))
        sketches = minhash_dedup._odd_sketches(np.stack([minhash_dedup._minima(a), minhash_dedup._minima(b)]))
        assert sum(bin(int(x) & (2**64 - 1)).count("1") for x in sketches[0] ^ sketches[1]) <= minhash_dedup.MOST_ODD_BITS


def as_tiktoken():
    ranks = byte_bpe.byte_pairs(RANKS, PATTERN).ranks
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_is_tiktoken(docs, rows_in):
    library = as_tiktoken()
    want = Counter()
    for i, text, *_ in rows_in:
        ids = library.encode_ordinary(text or "")
        joined = " ".join(map(str, ids))
        want[i, len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in byte_bpe.digests(docs, RANKS, PATTERN).collect()) == want
    ids = {r["doc_id"]: r["ids"] for r in byte_bpe.encode(docs, RANKS, PATTERN).collect()}
    assert ids[0] == library.encode_ordinary(rows_in[0][1])


def test_bpe_of_odd_strings():
    pairs, library, r = byte_bpe.byte_pairs(RANKS, PATTERN), as_tiktoken(), random.Random(2)
    texts = ["".join(r.choice("aab  \n\t\x1c\x85 　éß'sthe12中 .,!𝒳") for _ in range(r.randrange(70))) for _ in range(1500)]
    for text in [*texts, "x" * 3000, "ab" * 900, "<|endoftext|>"]:
        assert "".join(chunks(text)) == text
        ids = np.frombuffer(b"".join(pairs.encode_chunks(chunks(text))), np.int32).tolist()
        assert ids == library.encode_ordinary(text) and pairs.decode(ids) == text.encode()


#: Texts that hold the tokenizer's own special token, which the plain library call takes as that token.
SPECIAL = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|>b  <|endoftext|>\n\n<|endoftext|> x", "<|endoftext|", "say " * 300 + "<|endoftext|> " * 5]


def test_codes_are_the_library(spark, docs, rows_in, tmp_path):
    library = Tokenizer.from_file(TOKENIZER)
    path = str(tmp_path / "codes")
    rows_in = rows_in + [(90_000 + i, t, "en", "special", len(t)) for i, t in enumerate(SPECIAL)]
    extra = spark.createDataFrame(rows_in[-len(SPECIAL) :], "doc_id long, text string, lang string, source string, n_chars long")
    token_codes.write_codes(docs.unionByName(extra, allowMissingColumns=True), path, TOKENIZER, END_ID)
    got = sorted(map(tuple, token_codes.read_codes(spark, path).collect()), key=lambda r: r[1])
    start = 0
    for (i, text, *_), row in zip(sorted(rows_in, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")), got, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids + [END_ID]
        assert row == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_codes_give_any_token():
    r = random.Random(4)
    documents = [np.array([r.randrange(2 ** r.randrange(1, 32)) for _ in range(r.randrange(1500))], np.uint32) for _ in range(9)]
    block = token_codes.Block(token_codes.pack([None, *range(8)], documents))
    flat = np.concatenate(documents)
    assert (block.ids() == flat).all() and block.doc_ids == [None, *range(8)]
    for _ in range(500):
        i = r.randrange(len(flat))
        j = r.randrange(i, len(flat) + 1)
        assert block.token(i) == flat[i] and (block.ids(i, j) == flat[i:j]).all()
    assert len(token_codes.Block(token_codes.pack([], [])).ids()) == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def mutated(r, text, edits):
    text = list(text)
    for _ in range(edits):
        at, kind = r.randrange(len(text) + 1), r.random()
        if kind < 0.34:
            text.insert(at, r.choice("abc"))
        elif text and kind < 0.67:
            text.pop(at % len(text))
        elif text:
            text[at % len(text)] = r.choice("abz")
    return "".join(text)


def test_banded_distance_is_the_table():
    r = random.Random(5)
    for k in range(6000):
        a = "".join(r.choice("ab" if k % 2 else "abcdefgh") for _ in range(r.randrange(24)))
        b = mutated(r, a, r.randrange(5))
        for edits in (1, 2, 3):
            assert line_dedup.within(a, b, edits) == (edit_distance(a, b) <= edits)


def test_near_lines_share_a_segment():
    r = random.Random(6)
    for _ in range(1500):
        a = "".join(r.choice("abcdefgh éß") for _ in range(r.randrange(24, 60)))
        b = mutated(r, a, r.randrange(line_dedup.EDITS + 1))
        if len(b) >= line_dedup.LEAST_EDIT_CHARS:
            at, keys = line_dedup.segment_keys([a, b])
            assert set(keys[at == 0]) & set(keys[at == 1])


def brute_lines(rows):
    """The lines that stay, of (doc_id, text)."""
    places = defaultdict(list)
    for i, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            if i is not None and len(line) >= line_dedup.LEAST_CHARS:
                places[line].append((i, n))
    lines = sorted(places)
    long_ = [x for x in lines if len(x) >= line_dedup.LEAST_EDIT_CHARS]
    links = [
        (a, b) for k, a in enumerate(long_) for b in long_[k + 1 :]
        if abs(len(a) - len(b)) <= line_dedup.EDITS and line_dedup.within(a, b, line_dedup.EDITS)
    ]
    of = classes(lines, links)
    first = {}
    for line in lines:
        first[of[line]] = min([first.get(of[line], (10**9, 0)), *places[line]])
    gone = {p for line in lines for p in places[line] if p != first[of[line]]}
    return [
        (i, None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if (i, n) not in gone)) for i, text in rows
    ]


def test_line_dedup_is_brute_force(docs, rows_in):
    want = Counter(brute_lines([r[:2] for r in rows_in]))
    out = line_dedup.without_repeated_lines(docs)
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == want
    assert want != Counter(r[:2] for r in rows_in)
    assert out.columns[: len(docs.columns) - 1] == [c for c in docs.columns if c != "n_lines"]


def test_short_lines_are_brute_force(spark):
    r = random.Random(12)
    lines = ["Home", "Read more", "Sign in", "All rights reserved", "x", "ab", "cat", "cut"]
    lines += ["".join(r.choice("abcdefgh ") for _ in range(n)) for n in range(1, 40) for _ in range(3)]
    lines += [mutated(r, x, r.randrange(4)) for x in lines for _ in range(3)]
    lines = [x for x in lines if x] + ["All rights reserved.", "Read more.", "k" * 23, "k" * 24, "m" * 15, "m" * 16, "n" * 14, "n" * 16]
    r.shuffle(lines)
    rows = [(i, "\n".join(["", *lines[i::60], "", r.choice(lines)])) for i in range(60)]
    places = defaultdict(list)
    for i, text in rows:
        for n, line in enumerate(text.split("\n")):
            if line:
                places[line].append((i, n))
    allowed = lambda a, b: min(2, min(len(a), len(b)) // 8)
    known = sorted(places)
    links = [(a, b) for k, a in enumerate(known) for b in known[k + 1 :] if abs(len(a) - len(b)) < 3 and edit_distance(a, b) <= allowed(a, b)]
    of = classes(known, links)
    first = {}
    for line in known:
        first[of[line]] = min([first.get(of[line], (10**9, 0)), *places[line]])
    gone = {p for line in known for p in places[line] if p != first[of[line]]}
    want = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in rows}
    got = {x["doc_id"]: x["text"] for x in line_dedup.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want
    assert of["All rights reserved"] == of["All rights reserved."] and of["k" * 23] == of["k" * 24] and of["cat"] != of["cut"]


def test_vectors_are_brute_force(spark):
    r = np.random.default_rng(7)
    rows = []
    for label in (1, 2):
        centres = r.normal(size=(12, 16))
        for c in centres:
            rows += [(len(rows) + k, (c + r.normal(size=16) * s).tolist(), label) for k, s in enumerate((0, 0.05, 0.1, 0.2, 0.3))]
    rows = [(i, v, label) for i, (_, v, label) in enumerate(rows)]
    copy = rows[0][1]
    rows += [(200 + i, copy, 1) for i in range(700)] + [(1000 + i, (np.array(copy) + r.normal(size=16) * 1e-3).tolist(), 1) for i in range(600)]
    rows += [(2000, [0.0] * 16, 1), (2001, None, 1), (2002, copy, None), (2003, [float("nan")] * 16, 1), (2004, [None] + copy[1:], 1), (2005, copy[:8], 1), (2006, (np.array(copy) * 3).tolist(), 1), (2007, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    plain = [
        (i, np.array(v, np.float32).astype(np.float64), label) for i, v, label in rows
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = []
    for size in (8, 16):
        for label in (1, 2):
            part = [(i, v) for i, v, x in plain if x == label and len(v) == size]
            if part:
                m = np.stack([v / np.linalg.norm(v) for _, v in part])
                a, b = np.nonzero(np.triu(m @ m.T >= 0.98, 1))
                links += [(part[x][0], part[y][0]) for x, y in zip(a, b)]
    n = Counter(x for link in links for x in link)
    want = classes([r[0] for r in rows], links)
    got = embedding_dedup.near_vectors(df).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == {i: (n[i], want[i], want[i] == i) for i, *_ in rows}
    assert len(got) == len(rows) and embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_mix_reaches_its_targets(docs, rows_in):
    sized = mixing.sizes(docs)
    made = mixing.plan(sized)
    got = mixing.with_copies(sized, made, F.col("size")).collect()
    assert len(got) == len(rows_in)
    taken, size, target, largest = Counter(), Counter(), {}, Counter()
    for r in got:
        taken[r["source"]] += r["size"] * r["copies"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert r["copies"] <= mixing.EPOCHS
    total = sum(size.values())
    assert sum(target.values()) == pytest.approx(min(1.5 * total, sum(2 * s for s in size.values())))
    weights = dict(zip(sorted(size, key=lambda s: (s is None, s or "")), [5, 2, 1, 5, 2]))
    level = max(target[s] / weights[s] for s in size)
    for s in size:
        assert target[s] == pytest.approx(min(2 * size[s], level * weights[s]))
        assert abs(taken[s] - target[s]) <= max(3, 0.05 * target[s], largest[s] / 2)
    assert sorted(map(repr, mixing.taken(docs).collect())) == sorted(map(repr, mixing.taken(docs).collect()))
    copies = Counter(r["doc_id"] for r in mixing.mix(docs).collect())
    want = Counter()
    for r in got:
        want[r["doc_id"]] += r["copies"]
    assert copies == +want


def test_mix_fills_up_behind_long_documents(spark):
    r = random.Random(11)
    rows = [(i, "w " * 100, "a") for i in range(1000)] + [(5000, "w " * 90_000, "a")]
    rows += [(10_000 + i, "w " * r.choice([1, 2, 3, 5, 8, 40, 41, 300, 300, 7000, r.randrange(9000)]), r.choice("bcdef")) for i in range(600)]
    rows += [(20_000 + i, "w " * (50_000 if i % 40 == 0 else 7), None) for i in range(200)] + [(20_001, "w w w", None)]
    sized = mixing.sizes(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got, by_source = mixing.with_copies(sized, mixing.plan(sized), F.col("size")).collect(), defaultdict(list)
    assert len(got) == len(rows)
    for row in got:
        by_source[row["source"]].append(row)
    filled = 0
    for own in by_source.values():
        units, copies = Counter(), {}
        for row in own:
            place = hashlib.md5(f"mix:{row['doc_id']}".encode()).hexdigest()
            units[place] += row["size"]
            assert copies.setdefault(place, row["copies"]) == row["copies"]
        total = sum(units.values())
        whole = int(own[0]["target"] // total)
        left = rest = own[0]["target"] - whole * total
        want = set()
        for place in sorted(p for p in units if units[p] <= left):
            if units[place] > rest:
                break
            want.add(place)
            rest -= units[place]
        before = len(want)
        last = max(want, default="")
        for n, place in sorted(((n, p) for p, n in units.items() if p > last), reverse=True):
            if 0 < n <= rest:
                want.add(place)
                rest -= n
        filled = max(filled, len(want) - before)
        if whole < mixing.EPOCHS:
            assert {p for p in copies if copies[p] > whole and units[p]} == {p for p in want if units[p]}
            assert all(units[p] > rest for p in units if p > last and copies[p] == whole and units[p])
    assert filled > 3


def spans_of(text):
    found = []
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", luhn),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(re.sub("[^0-9]", "", v)) <= 15),
    }
    for rank, (kind, (pattern, ok)) in enumerate(rules.items()):
        found += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if ok(m[0])]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def luhn(value):
    digits = [int(c) for c in value if c.isdigit()][::-1]
    return 12 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def personal():
    r = random.Random(8)
    parts = ["a.b@c.d.ef", "x@y", "@", "a@b.c_d@e.f", "1.2.3.4", "256.1.1.1", "0255.1.2.03", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "4111111111111111", "+1 (555) 123-4567", "+12", "+49 30 1234567890123456", "é𝒳中", "12", "-", ".", " ", "\n", "+", "word"]
    texts = ["".join(r.choice(parts) + r.choice(["", " "]) for _ in range(r.randrange(14))) for _ in range(300)]
    return [(i, t) for i, t in enumerate([*texts, None, "", "9" * 30_000, "a" * 30_000, "a.b@" + "c." * 9000 + "d", "+" + "1 " * 9000])]


def test_personal_data_is_brute_force(spark):
    rows = personal()
    got = {r["doc_id"]: r for r in pii.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        want = spans_of(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (text or "")[:200]
        for kind in pii.KINDS:
            assert got[i][f"n_{kind}"] == sum(k == kind for k, _, _ in want)
        assert set(joined.split(",")) <= set(got[i]["spans"].split(","))


def test_addresses_with_zero_parts(spark):
    parts = ["0", "00", "000", "01", "001", "10", "100", "255", "0255", "256", "0256", "00000", "1000", "99"]
    texts = [f"at {a}.{b}.0.{c} and" for a in parts for b in parts for c in parts]
    texts += ["10.0.0.1", "127.0.0.1", "192.168.0.5", "0.0.0.0", "00.0.0.0", "10.0.0.0.1", "10.0.0", "0" * 3000 + ".0.0.1"]
    got = {r["doc_id"]: r for r in pii.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        want = spans_of(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert got[i]["n_ip"] == sum(k == "ip" for k, _, _ in want), text[:200]
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), text[:200]
        assert set(joined.split(",")) <= set(got[i]["spans"].split(","))
    assert all(r["n_ip"] == 1 for i, r in got.items() if texts[i] in ("10.0.0.1", "127.0.0.1", "192.168.0.5", "0.0.0.0", "00.0.0.0"))


def test_terms_that_reveal_an_entity(spark):
    r = random.Random(9)
    other = lambda: " ".join(r.choice("the of and to alpha beta gamma delta".split()) for _ in range(12))
    rows = [(i, f"{other()}\nAsk Wolfram at w.adler@mail.org the {other()}") for i in range(6)]
    rows += [(100 + i, other() + "\nask at " + other()) for i in range(200)] + [(900, "Wolfram is not in this document with an address")]
    rows += [(None, "Wolfram w.adler@mail.org"), (901, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.spans(df)
    got = {x["doc_id"]: x for x in found.withColumn("s", pii.joined("spans")).collect()}
    text = rows[0][1]
    at, mail = text.index("Wolfram"), text.index("w.adler")
    assert got[0]["s"] == f"term:{at}:{at + 7},email:{mail}:{mail + 16}"
    assert got[900]["s"] == "" and got[100]["s"] == "" and got[901]["s"] == ""
    clean = {x["doc_id"]: x["text"] for x in pii.sanitised(found).collect()}
    assert clean[0] == text.replace("Wolfram", "").replace("w.adler@mail.org", "<email>")
    assert clean[100] == rows[6][1] and clean[901] is None


def py_signatures(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    runs = []
    for w in words:
        if w in fingerprints.ANCHORS:
            runs.append([])
        elif runs:
            runs[-1].append(w)
    runs = [r for r in runs if r]
    spots = {" ".join(sum(runs[i : i + 3], [])[:3]) for i in range(len(runs))}
    if len(runs) < fingerprints.FEW:
        content = [w for w in words if w not in fingerprints.ANCHORS]
        return spots | {("word", w) for w in content or words}
    return spots


def test_fingerprints(spark, docs, rows_in):
    r = random.Random(10)
    stop = "the of and to in".split()
    rows = [(i * 2, " ".join(r.choice(stop) if r.random() < 0.4 else r.choice("abcdefghijkl") + str(r.randrange(40)) for _ in range(r.randrange(0, 150)))) for i in range(60)]
    rows += [(500, None), (501, ""), (502, rows[3][1]), (503, "𝒳é中 the 中中 of x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {x["doc_id"]: x for x in fingerprints.edited_fingerprints(df).collect()}
    texts = [(i, t or "") for i, t in sorted(rows)]
    for k, (i, t) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        row = got[i]
        assert (row["n_chars"], row["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        for name, other in (("near_edited", edited), ("near_next", after)):
            a, b = py_signatures(t), py_signatures(other)
            assert row[name] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0), (name, t)
    assert got[502]["fingerprint"] == got[rows[3][0]]["fingerprint"]
    out = fingerprints.edited_fingerprints(docs).collect()
    assert len(out) == len(rows_in)


def test_anchors_in_a_row_and_words_like_marks(spark):
    rows = [(1, "the " * 100_000), (2, "the " * 50_000 + "river bank house " + "of " * 50_000), (3, "\x01 the \x01 river"), (4, "the river")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["signatures"] for r in fingerprints.signed(df).collect()}
    assert len(got[1]) == 1 and len(got[2]) == 4 and got[3] != got[4]


def test_ids_of_any_width(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "STRETCH_ROWS", 10)
    r = random.Random(8)
    ids = sorted({r.randrange(-(2**63), 2**63) for _ in range(300)} | {-(2**63), 2**63 - 1} | set(range(200)) | {10**15})
    rows = [(i, f"text {k} of the corpus of words") for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {x["doc_id"]: x["edited_sha256"] for x in fingerprints.edited_fingerprints(df).collect()}
    for k, (i, text) in enumerate(rows):
        half = len(text) // 2
        edited = text[: len(text) - half] + rows[(k + 1) % len(rows)][1][:half]
        assert got[i] == hashlib.sha256(edited.encode()).hexdigest()


def test_an_outlying_id_crowds_no_stretch(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "STRETCH_ROWS", 100)
    ids = spark.range(5000).select(F.col("id").alias("doc_id")).union(spark.createDataFrame([(10**15,)], "doc_id long"))
    borders = fingerprints._borders(ids)
    sizes = [x["count"] for x in ids.groupBy(fingerprints._stretch(borders).alias("s")).count().collect()]
    assert len(sizes) == len(borders) + 1 > 20 and max(sizes) <= 2 * 5001 / len(sizes)
    plain = sorted(x["doc_id"] for x in ids.collect())
    for x in ids.select("doc_id", fingerprints._stretch(borders).alias("s")).sample(0.1, 3).collect():
        assert x["s"] == sum(b <= x["doc_id"] for b in borders), plain[:3]


def test_sketches_differ_in_no_more_bits_than_sets_in_signatures(spark):
    r = random.Random(9)
    sets = [sorted({r.randrange(-(2**31), 2**31) for _ in range(r.randrange(1, 300))}) for _ in range(20)]
    sets += [sorted({*s[: -len(s) // 5], r.randrange(2**31)}) for s in sets]
    df = spark.createDataFrame([(s,) for s in sets], "s array<int>")
    sketches = [x[0] for x in df.select(fingerprints._sketch("s")).collect()]
    for a in range(len(sets)):
        for b in range(a):
            bits = sum(bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(sketches[a], sketches[b]))
            assert bits <= len(set(sets[a]) ^ set(sets[b])) and (bits > 0) == (sets[a] != sets[b])


def test_near_documents_are_brute_force(docs, rows_in):
    known = {i: py_signatures(t) for i, t, *_ in rows_in if i is not None}
    ids = sorted(known)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if known[a] and known[b] and len(known[a] & known[b]) >= 0.75 * len(known[a] | known[b])]
    want = classes(ids, links)
    got = {r["doc_id"]: r["component_id"] for r in fingerprints.near_documents(docs).collect()}
    assert got.pop(None) is None and got == want and links


def test_registered_fingerprints_have_near_documents(spark, docs, rows_in, empty, plan, tmp_path):
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    out = op2_document_fingerprints(spark, str(tmp_path))
    got = out.collect()
    known = {i: py_signatures(t) for i, t, *_ in rows_in if i is not None}
    ids = sorted(known)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if known[a] and known[b] and len(known[a] & known[b]) >= 0.75 * len(known[a] | known[b])]
    want = classes(ids, links)
    assert len(got) == len(rows_in) and {x["doc_id"]: x["component_id"] for x in got} == {None: None, **want}
    assert all(x["kept"] == (x["doc_id"] is not None and x["doc_id"] == x["component_id"]) for x in got)
    first = fingerprints.edited_fingerprints(docs)
    assert out.columns == [*first.columns, "component_id", "kept"]
    assert Counter(map(tuple, out.select(*first.columns).collect())) == Counter(map(tuple, first.collect()))
    assert fingerprints.document_fingerprints(empty).count() == 0 and not re.search("Python|Pandas|Arrow", plan(out))


def test_empty_tables(spark, empty, tmp_path):
    assert minhash_dedup.near_duplicates(empty).count() == 0
    assert fingerprints.edited_fingerprints(empty).count() == 0
    assert fingerprints.near_documents(empty).count() == 0
    assert byte_bpe.digests(empty, RANKS, PATTERN).count() == 0
    assert line_dedup.without_repeated_lines(empty).count() == 0
    assert mixing.taken(empty).count() == 0 and mixing.mix(empty).count() == 0
    assert pii.digests(empty).count() == 0
    token_codes.write_codes(empty, str(tmp_path / "none"), TOKENIZER, END_ID)
    assert token_codes.read_codes(spark, str(tmp_path / "none")).count() == 0


def test_native_operators_run_no_python(spark, plan):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (fingerprints.edited_fingerprints(docs), pii.digests(docs)):
        assert not re.search("Python|Pandas|Arrow", plan(df))
    assert isinstance(docs.schema, T.StructType) and public_tokenizers.PATTERN == PATTERN
