import random

from cargoweave.llm import fingerprints


def test_whole_sets_travel_only_for_pairs_that_may_be_links(spark, monkeypatch):
    """Documents that share one signature and are unlike else: they meet in a bucket, and their
    sketches show that they are no links."""
    written, plain = {}, fingerprints.staged

    def staged(df, name):
        out = plain(df, name)
        written.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(fingerprints, "staged", staged)
    r = random.Random(7)
    spot = lambda: "the " + " ".join("".join(r.choice("abcdefgh") for _ in range(8)) for _ in range(3))
    shared = spot()
    texts = [" ".join([shared, *[spot() for _ in range(12)]]) for _ in range(60)]
    texts += [f"{texts[k]} {spot()}" for k in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in fingerprints.near_documents(docs).collect()}
    assert got == {i: i - 60 if i >= 60 else i for i in range(65)}
    assert max(written["ids"]) <= 14


def test_groups_are_found_by_digests(spark, plan):
    """The last join moves digests, not sets."""
    docs = spark.createDataFrame([(1, "the one two three of four five six"), (2, "the one two three of four five six"), (3, None)], "doc_id long, text string")
    near = fingerprints._grouped(docs)
    assert [tuple(x) for x in near.select("doc_id", "component_id").orderBy("doc_id").collect()] == [(1, 1), (2, 1), (3, 3)]
    assert "signatures" not in plan(near.select("doc_id", "digest", "component_id"))
