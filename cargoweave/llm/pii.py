"""Personal data: patterns, and terms that reveal the entities found; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from cargoweave.llm.common import staged

#: Kinds of entities in the order in which spans of one start are listed, and their patterns.
#: They find what the plain forms beside them find; possessive repeats and the looks behind
#: only keep long runs of letters and digits from being tried again and again.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried at all.
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_BYTE = r"(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)|0++)"
#: A term is one of a line in which the entity stands. It discloses the entity when it is on
#: so many different lines with it, and this share of the information of the entity (its
#: pointwise mutual information over the entity's own) is known from the term.
LEAST_LINES, DISCLOSED = 3, 0.9
TERM = "term"
#: A term in a text; what stands before and after it is no letter, digit or part of an address.
_INSIDE = r"[\p{L}\p{N}._%+@-]"
_SPAN = "struct<kind:string,start:int,end:int,value:string>"


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _test(kind: str) -> Callable[[Column], Column]:
    return lambda span: _valid(kind, span["value"])


def _placed(kind: str, text: str, pattern: Column) -> Column:
    """All matches of a pattern with their places: those of the gaps and matches before them."""
    found = F.regexp_extract_all(F.col(text), pattern, F.lit(0))
    lengths = F.arrays_zip(
        F.transform(F.split(F.col(text), pattern, -1), lambda g: F.char_length(g)).alias("gap"), found.alias("value")
    )

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.char_length(x["value"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))
    with_value = F.filter(lengths, lambda x: x["value"].isNotNull())
    return F.aggregate(with_value, start, step, lambda s: s["spans"])


def _ordered(spans: Column) -> Column:
    rank = lambda s: F.array_position(F.array(*map(F.lit, [*KINDS, TERM])), s["kind"]).cast("int")
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))


def joined(spans: str, kinds: tuple[str, ...] = (*KINDS, TERM)) -> Column:
    """kind:start:end of the spans, comma-joined."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base``: the entities of the whole text by start, then kind.

    Matches are leftmost and do not overlap within a kind; those that fail a kind's test are
    dropped and not tried again. Places count characters; ends are exclusive. NULL is empty.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.withColumn("_text", text)
    none = F.array().cast(f"array<{_SPAN}>")
    for kind in KINDS:
        all_ = _placed(kind, "_text", F.lit(PATTERNS[kind]))
        need = _NEEDS[kind]
        worth = F.contains("_text", F.lit(need)) if need else F.col("_text").rlike("[0-9]")
        df = df.withColumn(f"_{kind}", F.when(worth, F.filter(all_, _test(kind))).otherwise(none))
    base = F.concat(*[F.col(f"_{k}") for k in KINDS])
    return df.withColumn("base", _ordered(base)).drop("_text", *[f"_{k}" for k in KINDS])


def _terms(line: Column) -> Column:
    """The distinct lower-cased words of a line, at least two characters, that are no addresses or numbers."""
    words = F.split(F.lower(line), r"[^\p{L}\p{N}._%+@-]+", -1)
    trimmed = F.transform(words, lambda w: F.regexp_replace(w, r"^[._%+@-]+|[._%+@-]+$", ""))
    return F.array_distinct(F.filter(trimmed, lambda w: (F.char_length(w) > 1) & w.rlike(r"^\p{L}+$")))


def disclosing_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(entity, term): the terms that reveal an entity, by co-occurrence over the corpus.

    ``found`` is ``docs`` with base spans. Lines are the places of co-occurrence, and every
    different line counts once, however many copies it has. With p over all different
    lines, pmi = log(p(e, t) / p(e) p(t)), and log 1 / p(e) is all there is to know of the
    entity; their quotient is the share that the term discloses. Lines of terms are counted
    over the whole corpus, for those terms only that meet an entity often enough.
    """
    holding = found.where(F.size("base") > 0).select(
        F.explode(F.split(F.col("text"), "\n", -1)).alias("line"), "base"
    )
    values = F.array_distinct(F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["value"].alias("value"))))
    there = F.filter(values, lambda v: F.contains(F.col("line"), v["value"]))
    lines = holding.select("line", F.explode(there).alias("e")).select("line", F.concat_ws(":", "e.kind", F.lower("e.value")).alias("entity"))
    lines = staged(lines.distinct(), "entity_lines")
    entities = lines.groupBy("entity").agg(F.countDistinct("line").alias("n_e")).where(F.col("n_e") >= LEAST_LINES)
    pairs = (
        lines.join(entities, "entity").select("entity", "n_e", "line", F.explode(_terms(F.col("line"))).alias("term"))
        .groupBy("entity", "n_e", "term").agg(F.count("*").alias("n_et")).where(F.col("n_et") >= LEAST_LINES)
    )
    pairs = staged(pairs, "pairs")
    if pairs.isEmpty():  # nobody is met often enough, so no term's lines need counting
        return pairs.select("entity", "term")
    wanted = pairs.select("term").distinct()
    all_lines = staged(docs.select(F.explode(F.split(F.col("text").cast("string"), "\n", -1)).alias("line")).where("line <> ''").distinct(), "lines")
    counts = all_lines.select(F.explode(_terms(F.col("line"))).alias("term")).join(wanted, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_t"))
    total = all_lines.count()
    pmi = F.log(F.col("n_et") * F.lit(float(total)) / (F.col("n_e") * F.col("n_t")))
    information = F.log(F.lit(float(total)) / F.col("n_e"))
    return staged(
        pairs.join(counts, "term").where((information > 0) & (pmi >= information * DISCLOSED)).select("entity", "term"), "disclosing"
    )


def spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: the entities, and with them the disclosing terms.

    A term becomes a span wherever it stands alone in a document that holds the entity it
    reveals; other documents are left as they are. NULL texts have no spans. Repeated rows
    get equal spans; a row without a doc_id gets its base spans and no terms.
    """
    found = base_spans(docs)
    revealed = disclosing_terms(docs, found)
    own = found.where(F.size("base") > 0).select(F.col("doc_id").alias("_doc"), F.explode("base").alias("s"))
    of_doc = (
        own.select("_doc", F.concat_ws(":", "s.kind", F.lower("s.value")).alias("entity")).where("_doc is not null").distinct()
        .join(revealed, "entity").groupBy("_doc").agg(F.array_sort(F.collect_set("term")).alias("_terms"))
    )
    of_doc = staged(of_doc, "terms")
    if of_doc.isEmpty():
        return found.withColumn("spans", F.col("base"))
    one_of = F.concat(F.lit(rf"(?iu)(?<!{_INSIDE})(?:"), F.array_join("_terms", "|"), F.lit(rf")(?!{_INSIDE})"))
    terms = F.when(F.col("_terms").isNotNull() & F.col("text").isNotNull(), _placed(TERM, "text", one_of)).otherwise(F.array().cast(f"array<{_SPAN}>"))
    return (
        found.join(of_doc, F.col("doc_id") == F.col("_doc"), "left").withColumn("spans", _ordered(F.concat("base", terms))).drop("_doc", "_terms")
    )


def sanitised(found: DataFrame) -> DataFrame:
    """``found`` with its text sanitised: entities become their kind in brackets, terms go.

    Of overlapping spans the one that starts first is replaced, and the part of a later one
    that sticks out is removed with it.
    """

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        label = F.when((s["kind"] == TERM) | (s["start"] < state["at"]), F.lit("")).otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">")))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], gap, label).alias("out"))

    end = lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.char_length("text")))
    text = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, end)
    return found.withColumn("text", F.when(F.col("text").isNotNull(), text))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row of ``docs``."""
    found = spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(F.encode(joined("base"), "UTF-8"), 256).alias("base_sha256"), joined("spans").alias("spans")
    )
