"""Document fingerprints from spot signatures, with DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from cargoweave.llm.common import SMALL_SET, WORD_GAP, semi, staged
from cargoweave.llm.near import linked_components

#: Anchors: frequent function words of English, Spanish, French and German. Fixed values.
ANCHORS = tuple(dict.fromkeys(
    "the of and to a in is that it for was on with as be are by this at from "
    "de la que el en y los se del un las por con no una para su al es lo "
    "le et les des du une est pour dans pas au qui par sur avec "
    "der die und den zu von das sich mit auf für ein im dem nicht ist eine als".split()
))
#: Content words of a signature.
CHAIN = 3
#: Texts with fewer signatures are described by their content words as well.
FEW = 4
#: Rows of a stretch of doc_ids that are ordered together, and stretches at most.
STRETCH_ROWS, STRETCHES = 1000, 20_000
#: Likeness from which two documents are near duplicates.
SIMILAR = 0.75
#: Cells by which signatures are counted to order them by rarity.
CELLS = 65_536
#: Longs of a sketch of a set: the parity of how many signatures fall on each of their bits.
SKETCH_LONGS = 16


def signed(df: DataFrame, text: str = "text", out: str = "signatures") -> DataFrame:
    """``df`` with the sorted distinct 32-bit hashes of the spot signatures of a whole text.

    A spot is a run of anchors; its signature is the CHAIN content words that follow, over
    later anchors. A text with few spots also has a signature for each content word (for
    each word if all are anchors). NULL and empty texts, and white space, have none.
    """
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), WORD_GAP, -1), lambda w: w != "")
    behind = lambda i: F.coalesce(F.get(F.col("_words"), i - 1).isin(*ANCHORS), F.lit(False))
    content = F.filter(
        F.transform("_words", lambda w, i: F.struct(w.alias("word"), behind(i).alias("spot"))), lambda c: ~c["word"].isin(*ANCHORS)
    )

    def chain(c: Column, i: Column) -> Column:
        following = [F.get(F.col("_content"), i + k)["word"] for k in range(1, CHAIN)]
        return F.when(c["spot"], F.hash(F.concat_ws(" ", c["word"], *following)))

    spoken = F.when(F.size("_content") > 0, F.transform("_content", lambda c: c["word"])).otherwise(F.col("_words"))
    every = F.transform(spoken, lambda w: F.hash(F.lit("word"), w))
    all_ = F.when(F.size("_chains") < FEW, F.concat("_chains", every)).otherwise(F.col("_chains"))
    return (
        df.withColumn("_words", words).withColumn("_content", content).withColumn("_chains", F.array_compact(F.transform("_content", chain)))
        .withColumn(out, F.array_sort(F.array_distinct(all_))).drop("_words", "_content", "_chains")
    )


def fingerprint(signatures: str) -> Column:
    """Signatures as text, eight hexadecimal digits each: equal sets, equal text."""
    digits = lambda s: F.lower(F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    return F.array_join(F.transform(signatures, digits), "")


def likeness(a: str, b: str, least: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 1 for two empty ones.

    Sets whose sizes alone keep them below ``least`` are not compared and get 0.
    """
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return (
        F.when(large == 0, F.lit(1.0))
        .when((small == 0) | (small < large * F.lit(least)), F.lit(0.0))
        .otherwise(common / (small + large - common))
    )


def _rarity(sets: DataFrame) -> Column:
    """For use on a signature: a letter that comes the later in the alphabet the more sets have
    signatures of its cell, by powers of two. Any order serves the prefixes; this one keeps what
    many share out of them. CELLS numbers at most come to the driver."""
    cell = lambda s: F.pmod(s, F.lit(CELLS))
    counted = sets.select(F.explode("signatures").alias("s")).groupBy(cell(F.col("s")).alias("cell")).agg(F.count("*").alias("n"))
    letters = ["a"] * CELLS
    for r in counted.collect():
        letters[r["cell"]] = chr(ord("a") + min(25, r["n"].bit_length() // 2))
    known = F.split(F.lit(",".join(letters)), ",")
    return lambda s: F.element_at(known, cell(s) + 1)


def _sketch(s: str) -> Column:
    """Bits of a set. Sets never differ in fewer signatures than their sketches do in bits."""
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(x, SKETCH_LONGS.bit_length() - 1).bitwiseAND(F.lit(63)))

    def word(w: int) -> Column:  # a lambda with another parameter would get the place in the array
        mine = F.filter(s, lambda x: x.bitwiseAND(F.lit(SKETCH_LONGS - 1)) == w)
        return F.aggregate(mine, F.lit(0).cast("long"), lambda all_, x: all_.bitwiseXOR(bit(x)))

    return F.array(*map(word, range(SKETCH_LONGS)))


def near_documents(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """(doc_id, fingerprint, component_id, kept): the ``_grouped`` rows of ``docs``."""
    return _grouped(docs, least).select(
        "doc_id", fingerprint("signatures").alias("fingerprint"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def _digest(fingerprint_: Column) -> Column:
    """32 bytes that stand for a fingerprint where rows travel."""
    return F.unhex(F.sha2(fingerprint_, 256))


def _grouped(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """(doc_id, signatures, digest, component_id) of ``docs`` (doc_id, text) whose signature
    sets have a likeness of ``least`` or more, over any number of steps.

    Documents are partitioned by the length of their sets, each partition reaching as far as
    a set can differ in length; a pair is met in its own or the next partition, through a
    signature among the rarest ones of both (of n, all but those that must be shared, and one). Equal
    sets are one node. Where many meet, places of the signature and sketches of the sets show which can
    be alike at all, and whole sets travel only for pairs that may be. Texts without signatures, NULL
    ids and empty tables link with nothing.
    """
    rows = staged(
        signed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select(
            "doc_id", "signatures", _digest(fingerprint("signatures")).alias("digest")
        ),
        "signed",
    )
    sets = staged(
        rows.where((F.size("signatures") > 0) & F.col("doc_id").isNotNull()).groupBy("digest", "signatures").agg(F.min("doc_id").alias("id")),
        "sets",
    )
    rarity = _rarity(sets)
    ordered = F.transform(F.array_sort(F.transform("s", lambda x: F.struct(rarity(x).alias("r"), x.alias("x")))), lambda y: y["x"])
    n = F.size("s")
    nodes = staged(
        sets.groupBy("id").agg(F.min("signatures").alias("s")).select(
            "id", "s", n.alias("n"), F.floor(F.log(n) / F.lit(-math.log(least))).cast("int").alias("length"),
            F.slice(ordered, 1, n - F.ceil(n * F.lit(least)).cast("int") + 1).alias("first"), _sketch("s").alias("sketch"),
        ),
        "nodes",
    )
    buckets = (
        nodes.select("id", "length", F.explode("first").alias("signature"))
        .select("id", "signature", F.explode(F.array("length", F.col("length") + 1)).alias("length"))
        .select(F.xxhash64("length", "signature").alias("bucket"), "id")
    )

    def alike(x: str, y: str) -> Column:
        """Two tests that no likely pair fails: sizes, and how many signatures the sketches show to differ."""
        small, large, both = F.least(f"{x}_n", f"{y}_n"), F.greatest(f"{x}_n", f"{y}_n"), F.col(f"{x}_n") + F.col(f"{y}_n")
        words = [F.bit_count(F.col(f"{x}_sketch")[i].bitwiseXOR(F.col(f"{y}_sketch")[i])) for i in range(SKETCH_LONGS)]
        return (small >= large * F.lit(least)) & (sum(words[1:], words[0]) * F.lit(1 + least) <= both * F.lit(1 - least) + 1e-6)

    def verify(pairs: DataFrame) -> DataFrame:
        a, b = (nodes.select(F.col("id").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("n", "sketch")]) for x in "ab")
        left = staged(pairs.join(a, "a").join(b, "b").where(alike("a", "b")).select("a", "b"), "alike")
        whole = semi(nodes.select("id", "s"), staged(left.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids"), "id")
        both = left.join(whole.toDF("a", "sa"), "a").join(whole.toDF("b", "sb"), "b")
        return both.where(likeness("sa", "sb", least) >= least).select("a", "b")

    def attach(rest: DataFrame) -> DataFrame:
        """The sizes and sketches of sets, and how many signatures come before the bucket's."""
        place = lambda length: F.array_position(F.transform("first", lambda x: F.xxhash64(length, x)), F.col("bucket"))
        at = F.greatest(place(F.col("length")), place(F.col("length") + 1)) - 1
        return rest.join(nodes.select("id", "n", "sketch", "first", "length"), "id").select(
            *rest.columns, "n", "sketch", at.alias("at")
        )

    def likely() -> Column:
        """``alike``, and what can be shared from the place of the bucket's signature on, if it is the first one shared."""
        both = F.col("l_n") + F.col("r_n")
        rest = F.least(F.col("l_n") - F.col("l_at"), F.col("r_n") - F.col("r_at"))
        return (rest * F.lit(1 + least) >= both * F.lit(least) - 1e-6) & alike("l", "r")

    found = linked_components(buckets.distinct(), verify, attach, likely).withColumnRenamed("node", "id")
    groups = sets.select("digest", "id").join(found, "id", "left").select("digest", F.coalesce("component", "id").alias("component_id"))
    return rows.join(groups, "digest", "left").select(
        "doc_id", "signatures", "digest", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    )


def _borders(ids: DataFrame) -> list[int]:
    """Smallest ids of up to STRETCHES stretches of about as many rows, without the first: Spark's
    own range partitioning of the ids alone."""
    rows = ids.where(F.col("doc_id").isNotNull())
    stretches = max(1, min(STRETCHES, rows.count() // STRETCH_ROWS))
    if stretches == 1:
        return []
    dealt = rows.repartitionByRange(stretches, "doc_id").select("doc_id", F.spark_partition_id().alias("part"))
    return sorted(r["first"] for r in dealt.groupBy("part").agg(F.min("doc_id").alias("first")).collect())[1:]


def _stretch(borders: list[int]) -> Column:
    """How many borders are not above doc_id, -1 for NULL: first among every so many of them,
    then among those between."""
    if not borders:
        return F.when(F.col("doc_id").isNull(), -1).otherwise(0).cast("long")
    width = math.isqrt(len(borders) - 1) + 1
    all_, some = (F.split(F.lit(",".join(map(str, b))), ",").cast("array<bigint>") for b in (borders, borders[width - 1 :: width]))
    whole = F.size(F.filter(some, lambda b: b <= F.col("doc_id"))) * width
    rest = F.size(F.filter(F.slice(all_, whole + 1, F.lit(width - 1)), lambda b: b <= F.col("doc_id"))) if width > 1 else F.lit(0)
    return F.when(F.col("doc_id").isNull(), -1).otherwise(whole + rest).cast("long")


def _with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with signatures, and next_text and next_signatures of the row that follows.

    Rows are ordered by doc_id (NULL first), then text, within stretches of doc_ids that hold about
    as many rows each, however the ids lie; the first row of a stretch is also a guest at the end of
    the stretch before. The window over all stretches has one row for each, STRETCHES at most.
    """
    ids = docs.select("doc_id")
    stretch = _stretch(_borders(ids))
    order = Window.orderBy("stretch")
    firsts = (
        ids.groupBy(stretch.alias("stretch")).agg(F.min("doc_id").alias("first"))
        .withColumn("guest_of", F.coalesce(F.lag("stretch").over(order), F.max("stretch").over(Window.partitionBy())))
        .select("first", "guest_of", F.lit(True).alias("is_first"))
    )
    seats = F.when(
        F.col("is_first"), F.array(F.struct(stretch.alias("s"), F.lit(0).alias("g")), F.struct(F.col("guest_of").alias("s"), F.lit(1).alias("g")))
    ).otherwise(F.array(F.struct(stretch.alias("s"), F.lit(0).alias("g"))))
    seated = (
        docs.join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("first")), "left")
        .withColumn("seat", F.explode(seats))
        .select("doc_id", "text", F.col("seat.s").alias("stretch"), F.col("seat.g").alias("guest"))
    )
    seated = signed(seated.repartition("stretch"))  # where the texts have come together, so that signatures do not travel
    following = Window.partitionBy("stretch").orderBy("guest", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return (
        seated.withColumn("next_text", F.lead("text").over(following))
        .withColumn("next_signatures", F.lead("signatures").over(following))
        .where("guest = 0").drop("stretch", "guest")
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of whole texts, of their edited texts, and how alike they are.

    The edited text has its last floor(n_chars / 2) characters replaced by as many (or all)
    of the next document's first ones; after the last comes the first. NULL texts count as
    empty. Of rows that share a doc_id the one with the smaller text comes first; rows without
    a doc_id come before all others.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = _with_next(plain)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long")).withColumn(
        "edited",
        F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(F.col("next_text"), F.lit(1), half)),
    )
    rows = signed(rows, "edited", "edited_signatures")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        fingerprint("signatures").alias("fingerprint"), fingerprint("edited_signatures").alias("edited_fingerprint"),
        likeness("signatures", "edited_signatures").alias("near_edited"),
        likeness("signatures", "next_signatures").alias("near_next"),
    )


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """The columns of ``edited_fingerprints``, and component_id and kept of ``near_documents``.

    Rows that share a doc_id find theirs by their fingerprint.
    """
    near = _grouped(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("_doc"), F.col("digest").alias("_key"), "component_id").distinct()
    near = staged(near, "near")
    if near.limit(SMALL_SET + 1).count() <= SMALL_SET:
        near = F.broadcast(near)
    rows = edited_fingerprints(docs)
    joined = rows.select("*", _digest(F.col("fingerprint")).alias("_own")).join(near, (F.col("doc_id") == F.col("_doc")) & (F.col("_own") == F.col("_key")), "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select(
        *rows.columns, component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )
