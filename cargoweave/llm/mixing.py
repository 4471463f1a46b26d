"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cargoweave.llm.common import staged, word_count

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: What the mix holds, as a share of all sizes.
BUDGET = 1.5
#: Repetitions of a source at most.
EPOCHS = 2
SEED = "mix"
#: Sources up to which their plan, and fills up to which they, are sent to all tasks (some 20 MB).
SMALL_PLAN = 100_000


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """The place of a document in its source's random order; depends on nothing but its id."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of the whole text, 0 for NULL."""
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """``totals`` (source, source_size: one row for each source) with ``target``.

    Sources weigh ``weights`` in code point order, NULL last. The level of the water is where
    the sources that are full, ordered by the level at which each becomes so, leave just as
    much for the others; that is what clamping and sharing anew comes to. The windows run
    over one row for each source.
    """
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    by_level = Window.orderBy("full_at", "place")
    ranked = (
        totals.withColumn("place", rank)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * epochs)
        .withColumn("full_at", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(budget)))
    )
    levels = (
        ranked.withColumn("below", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("shares", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("below")) / F.col("shares"))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "place", "level"))).over(everything)["level"])
    )
    full = F.col("level").isNull() | (F.col("full_at") <= F.col("level"))
    return levels.select(
        "source", "source_size",
        F.when(full, F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight")).alias("target"),
    )


def plan(sized: DataFrame) -> DataFrame:
    """One row for each source: source, source_size, target, whole, left, last, fills.

    Every document is taken ``whole`` times. ``left`` is what whole repetitions leave of the
    target; documents of at most this size are taken once more if their draw is not after
    ``last``, or is among ``fills``. ``last`` is where sizes, summed in the order of the draws,
    still fit; fills are, one after the other until none fits the rest, the largest documents
    that do. Their sizes, all but a few of them whole, follow from how many documents behind
    ``last`` have each size. The rest is less than one document, so fills have no more words
    than that. The running sum is made of 4,096 stretches of draws by source, so that a source
    with a third of all rows is not summed in one task.
    """
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("key")
    units = staged(
        sized.groupBy("source", draw(F.col("doc_id")).alias("draw")).agg(F.sum("size").alias("size")).withColumn("key", key), "units"
    )
    totals = units.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = staged(
        targets(totals).withColumn("key", key)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
        .withColumn("left", F.col("target") - F.col("whole") * F.col("source_size")),
        "aims",
    )
    stretch = F.substring("draw", 1, 3).alias("stretch")
    fitting = staged(units.join(aims.select("key", "left"), "key").where("size <= left").select("key", "draw", "size", "left", stretch), "fitting")
    sums = fitting.groupBy("key", "stretch").agg(F.sum("size").alias("size"))
    so_far = Window.partitionBy("key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("key", "stretch", F.coalesce(F.sum("size").over(so_far), F.lit(0)).alias("before"))
    within = Window.partitionBy("key", "stretch").orderBy("draw").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = (
        fitting.withColumn("inner", F.sum("size").over(within))
        .join(sums, ["key", "stretch"]).select("key", "draw", "left", (F.col("before") + F.col("inner")).alias("upto"))
    )
    fits = staged(
        summed.where("upto <= left").groupBy("key").agg(F.max("draw").alias("last"), F.max("upto").alias("used")),
        "fits",
    )
    state = staged(
        aims.join(fits, "key", "left").select(
            *aims.columns, F.coalesce("last", F.lit("")).alias("last"),
            F.floor(F.col("left") - F.coalesce("used", F.lit(0))).cast("long").alias("rest"),
        ),
        "state",
    )
    chosen = _fills(units, state).groupBy("key").agg(F.collect_list("draw").alias("fills"))
    return staged(
        state.join(chosen, "key", "left").select(
            "source", "source_size", "target", "whole", "left", "last",
            F.coalesce("fills", F.array().cast("array<string>")).alias("fills"),
        ),
        "plan",
    )


def _fills(units: DataFrame, state: DataFrame) -> DataFrame:
    """(key, draw) of the units (key, draw, size) behind ``last`` that fill up the ``rest``, by
    ``state`` (key, last, rest).

    Going down the sizes, each is taken as often as it fits; of equal sizes the latest draws.
    That is what taking the largest that fits, again and again, comes to. ``runs`` are the
    sizes taken whole, from top down to above ``size``, and ``n`` of that size itself. After
    a run less than half of the rest is left, so there are few.
    """
    behind = (
        units.select("key", "draw", "size").join(state.select("key", "last", "rest"), "key")
        .where((F.col("size") > 0) & (F.col("size") <= F.col("rest")) & (F.col("draw") > F.col("last")))
    )
    run = "struct<top:bigint,size:bigint,n:bigint>"

    def step(s: Column, x: Column) -> Column:
        n = F.least(x["n"], F.floor(s["rest"] / x["size"]))
        top = F.when(s["top"] > 0, s["top"]).otherwise(x["size"])
        ends = (n < x["n"]) & ((s["top"] > 0) | (n > 0))
        ended = F.struct(top.alias("top"), x["size"].alias("size"), n.alias("n"))
        return F.struct(
            (s["rest"] - n * x["size"]).alias("rest"), F.when(n < x["n"], F.lit(0).cast("long")).otherwise(top).alias("top"),
            F.when(ends, F.concat(s["runs"], F.array(ended))).otherwise(s["runs"]).alias("runs"),
        )

    def finish(s: Column) -> Column:
        none = F.lit(0).cast("long")
        ended = F.struct(s["top"].alias("top"), none.alias("size"), none.alias("n"))
        return F.when(s["top"] > 0, F.concat(s["runs"], F.array(ended))).otherwise(s["runs"])

    start = F.struct(F.col("rest"), F.lit(0).cast("long").alias("top"), F.array().cast(f"array<{run}>").alias("runs"))
    runs = (
        behind.groupBy("key", "size", "rest").agg(F.count("*").alias("n"))
        .groupBy("key", "rest").agg(F.sort_array(F.collect_list(F.struct("size", "n")), False).alias("sizes"))
        .select("key", F.explode(F.aggregate("sizes", start, step, finish)).alias("run")).select("key", "run.*")
    )
    runs = staged(runs, "runs")
    # of a size that is not taken whole, the draw of the n-th from behind
    parted = behind.join(runs.where("n > 0").select("key", "size", "n"), ["key", "size"]).withColumn("stretch", F.substring("draw", 1, 3))
    counts = parted.groupBy("key", "size", "stretch").agg(F.count("*").alias("here"))
    later = Window.partitionBy("key", "size").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("key", "size", "stretch", "here", F.coalesce(F.sum("here").over(later), F.lit(0)).alias("later"))
    place = F.row_number().over(Window.partitionBy("key", "size", "stretch").orderBy(F.desc("draw")))
    since = (
        parted.join(counts, ["key", "size", "stretch"]).where("later < n and n <= later + here")
        .withColumn("place", place).where("later + place = n").select("key", "size", F.col("draw").alias("since"))
    )
    runs = staged(
        runs.join(since, ["key", "size"], "left").groupBy("key").agg(F.collect_list(F.struct("top", "size", "since")).alias("runs")), "runs"
    )
    size, drawn = F.col("size"), F.col("draw")
    taken_in = lambda r: (size <= r["top"]) & ((size > r["size"]) | ((size == r["size"]) & F.coalesce(drawn >= r["since"], F.lit(False))))
    return behind.join(runs, "key").where(F.exists("runs", taken_in)).select("key", "draw")


def with_copies(rows: DataFrame, made: DataFrame, size: Column) -> DataFrame:
    """``rows`` (doc_id, source, ...) of this ``size`` with source_size, target and copies by a plan."""
    n = made.agg(F.count("*").alias("sources"), F.coalesce(F.sum(F.size("fills")), F.lit(0)).alias("fills")).first()
    made = made.withColumnsRenamed({c: f"_{c}" for c in made.columns})  # rows have names of this module or c1, c2 ...
    fills = made.select(F.col("_source").alias("_of"), F.explode("_fills").alias("_fill"))
    made = made.drop("_fills")
    place, source = draw(F.col("doc_id")), F.col("source").cast("string")
    again = ((place <= F.col("_last")) & (size <= F.col("_left"))) | F.col("_fill").isNotNull()
    return (
        rows.join(F.broadcast(made) if n["sources"] <= SMALL_PLAN else made, source.eqNullSafe(F.col("_source")), "left")
        .join(F.broadcast(fills) if n["fills"] <= SMALL_PLAN else fills, source.eqNullSafe(F.col("_of")) & (place == F.col("_fill")), "left")
        .select(
            *[c for c in rows.columns if c not in ("source_size", "target", "copies")],
            F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
            (F.col("_whole") + (again & (F.col("_whole") < EPOCHS)).cast("int")).alias("copies"),
        )
    )


def taken(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``.

    ``taken`` is the words the mix takes of the row, repeats counted; never more than EPOCHS
    times its size. NULL texts have size 0; NULL is a source of its own; rows that share a
    doc_id within a source are drawn together.
    """
    sized = staged(sizes(docs), "sizes")
    return with_copies(sized, plan(sized), F.col("size")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )


def mix(docs: DataFrame) -> DataFrame:
    """``docs`` with every row as often as the mix takes it. Other columns may have any name."""
    names = [c.lower() for c in docs.columns]
    own = {"doc_id": "doc_id", "source": "source", "text": "text"}
    plain = [own.get(c, f"c{k}") for k, c in enumerate(names)]
    rows = docs.toDF(*plain)
    repeated = with_copies(rows, plan(sizes(rows)), word_count(F.col("text"))).where("copies > 0")
    return repeated.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*plain).toDF(*docs.columns)
