"""Left joins on lookup tables that keep every fact row exactly once.

Plans are chosen by the measured size of the lookup:

* A lookup proven to be small is broadcast; the fact is not shuffled.
* For all other lookups of a fact its keys are counted, in one pass. Each lookup is
  reduced to the keys that the fact holds, and measured again; then it may be small.
  What is still large is joined by a shuffle. Keys that
  hold a large share of a task's rows are looked up in a broadcast of just those keys
  (at most ``HOT_KEYS`` of them), and rows that are hot or have no key at all are spread
  evenly instead of meeting in one task; where the fact holds no other keys, nothing is
  shuffled. The lookup's part in each task is known
  to be small, one row per key, so it is hashed and the wide fact is not sorted.
* A fact in parts (``in_parts``) is never shuffled: each part's distinct key hashes go to the
  lookup, and the rows found there go to the part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from cargoweave.functions.expressions import column
from cargoweave.sources.tables import PART, stage

BROADCAST_BYTES = 64 * 1024 * 1024
HASH_BYTES = 128 * 1024 * 1024
HOT_KEYS = 8192
TRACKED_KEYS = 100_000
SKETCH_GROUPS = 64
#: Values of the second join column, by which rows without a key are spread.
CODES = 65_536
#: Key hashes that are sent to all tasks (some 64 MB in their memory); more are shuffled.
HELD_KEYS = 2_000_000
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@dataclass(frozen=True)
class Lookup:
    """A lookup table: its rows as they came, its keys, and how to join it.

    ``on_duplicate`` says what a repeated key does: ``min`` keeps the smallest
    row of values, ``error`` fails the job, ``expand`` keeps all and so
    multiplies the matching fact rows. ``size`` is None until measured. ``hot`` are the hashes
    of a fact's frequent keys once :func:`prepared` has counted them; ``all_hot`` says that the
    fact holds no others. ``count`` is the number of rows, ``searches`` that of the fact's rows with a key.
    """

    rows: DataFrame
    keys: tuple[str, ...]
    values: tuple[str, ...]
    on_duplicate: str = "min"
    broadcast_bytes: int = BROADCAST_BYTES
    size: int | None = None
    hot: tuple[int, ...] | None = None
    all_hot: bool = False
    count: int | None = None
    searches: int | None = None

    @property
    def small(self) -> bool:
        """Proven to fit a broadcast."""
        return self.size is not None and self.size <= self.broadcast_bytes

    @property
    def unique(self) -> bool:
        return self.on_duplicate != "expand"

    @cached_property
    def table(self) -> DataFrame:
        """The rows to join: one per key, unless repeated keys are to expand."""
        if not self.unique:
            return self.rows
        winner = F.min(F.struct(*map(column, self.values)))
        if self.on_duplicate == "error":
            winner = F.when(F.count(F.lit(1)) == 1, winner).otherwise(
                F.raise_error(F.lit(f"lookup has repeated keys in {', '.join(self.keys)}"))
            )
        best = self.rows.groupBy(*map(column, self.keys)).agg(winner.alias("_winner"))
        return best.select(*map(column, self.keys), "_winner.*")

    def typed(self, match: Mapping[str, Column]) -> dict[str, Column]:
        """The fact's expression for each key, in the key's own type."""
        types = self.rows.schema
        return {k: match[k].try_cast(types[k].dataType) for k in self.keys}

    def key_code(self, match: Mapping[str, Column]) -> Column:
        """One hash for all key columns; NULL when a key is missing."""
        return _key_code(list(self.typed(match).values()))

    def row_code(self) -> Column:
        """The same hash, of the lookup's own rows."""
        return F.xxhash64(*map(column, self.keys))

    def key_table(self) -> DataFrame:
        """The distinct keys, hinted for broadcast when the lookup is small."""
        (known,) = measured(self)
        keys = known.rows.select(*map(column, self.keys)).distinct()
        return F.broadcast(keys) if known.small else keys


def lookup_table(
    table: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    on_duplicate: str = "min",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> Lookup:
    """A lookup over a table's key and value columns; rows with a NULL key are left out."""
    if on_duplicate not in ("min", "error", "expand"):
        raise ValueError(f"on_duplicate must be min, error or expand, not {on_duplicate!r}")
    rows = table.select(*map(column, [*keys, *values])).dropna(subset=list(keys))
    return Lookup(rows, tuple(keys), tuple(values), on_duplicate, broadcast_bytes)


def measured(*lookups: Lookup) -> tuple[Lookup, ...]:
    """Count the bytes of each lookup, all its rows, in one job for those not measured yet."""

    def size(position: int, table: DataFrame) -> DataFrame:
        widths = (F.coalesce(F.octet_length(column(c).cast("string")), F.lit(0)) for c in table.columns)
        row = sum(widths, F.lit(16 * len(table.columns)).cast("bigint"))
        return table.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).withColumn(
            "position", F.lit(position)
        )

    unmeasured = [size(i, one.rows) for i, one in enumerate(lookups) if one.size is None]
    if not unmeasured:
        return lookups
    sizes = {r["position"]: r for r in reduce(DataFrame.union, unmeasured).collect()}
    return tuple(
        replace(one, size=sizes[i]["bytes"], count=sizes[i]["rows"]) if i in sizes else one
        for i, one in enumerate(lookups)
    )


def held_keys(fact: DataFrame, codes: Sequence[Column]) -> DataFrame:
    """(held_code): the distinct key hashes that a fact holds, staged.

    One narrow aggregate over the key columns, combined before its shuffle, so that a frequent
    key is one row of each task. All ``codes`` count, those of both parties for example.
    """
    each = fact.select(F.explode(F.array(*codes)).alias("held_code")) if len(codes) > 1 else fact.select(codes[0].alias("held_code"))
    return stage(each.where(F.col("held_code").isNotNull()).distinct(), "held-keys")


def reduced(lookup: Lookup, held: DataFrame) -> Lookup:
    """The lookup with only the rows of held keys, staged and measured again.

    Up to HELD_KEYS hashes are sent to the tasks that read the lookup, which then shuffles
    nothing; beyond that hashes and lookup rows meet by a shuffle, never the fact. Hashes that
    happen to be equal keep a row more and change no result.
    """
    (known,) = measured(_held_rows(lookup, held, held.limit(HELD_KEYS + 1).count()))
    return known


def _most_hot(partitions: int) -> int:
    """As many keys as can each hold a quarter of an average task."""
    return min(HOT_KEYS, 4 * partitions)


def key_counts(fact: DataFrame, codes: Mapping[int, Column]) -> DataFrame:
    """(use, held_code, n): the rows of each key hash that a fact holds, for all uses in one pass, staged.

    Rows without a key count under NULL. Counts are combined before their shuffle.
    """
    each = F.array(*(F.struct(F.lit(i).alias("use"), code.alias("held_code")) for i, code in codes.items()))
    counts = fact.select(F.explode(each).alias("c")).groupBy("c.use", "c.held_code").agg(F.count(F.lit(1)).alias("n"))
    return stage(counts, "held-keys")


def frequent(counts: DataFrame, rows: int, keys: int) -> tuple[tuple[int, ...], bool]:
    """Of (held_code, n) the hashes that hold more than a quarter of an average task, or all if they
    are few, and whether it is all."""
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = _most_hot(partitions)
    hot = counts.where(F.col("held_code").isNotNull())
    if keys > most:
        hot = hot.where(F.col("n") >= rows / (4 * partitions))
    found = hot.orderBy(F.desc("n"), "held_code").limit(most).collect()
    return tuple(r["held_code"] for r in found), keys <= most


def prepared(fact: DataFrame, uses: Sequence[tuple[Lookup, Mapping[str, Column]]]) -> list[Lookup]:
    """Each lookup, measured, ready to be joined to ``fact``: small, or else reduced to the keys that
    the fact holds, with its hot keys if it is still large.

    ``uses`` has the lookups with how the fact's rows match them. However many there are, the
    fact is read once, and only for its keys. One that is used more than once is reduced to the
    keys of each use on its own: the exporters can be few where the importers are many.
    """
    given = list({id(k): k for k, _ in uses}.values())
    known = dict(zip(map(id, given), measured(*given)))
    unknown = [i for i, (k, _) in enumerate(uses) if not known[id(k)].small and k.hot is None]
    if fact.isStreaming or not unknown:
        return [known[id(k)] for k, _ in uses]
    counts = key_counts(fact, {i: uses[i][0].key_code(uses[i][1]) for i in unknown})
    sums = F.sum("n").alias("rows"), F.count("held_code").alias("keys"), F.coalesce(F.sum(F.when(F.col("held_code").isNotNull(), F.col("n"))), F.lit(0)).alias("searches")
    figures = {r["use"]: r for r in counts.groupBy("use").agg(*sums).collect()}
    rows_of, keys_of, searches = ({i: figures[i][name] if i in figures else 0 for i in unknown} for name in ("rows", "keys", "searches"))
    smaller = dict(zip(unknown, measured(*(
        _held_rows(known[id(uses[i][0])], counts.where((F.col("use") == i) & F.col("held_code").isNotNull()).select("held_code"), keys_of[i])
        for i in unknown
    ))))

    def ready(i: int) -> Lookup:
        lookup = smaller.get(i, known[id(uses[i][0])])
        if i not in unknown or lookup.small or not lookup.unique:
            return lookup
        lookup = replace(lookup, hot=(), searches=searches[i])
        if PART in fact.columns and keys_of[i] > _most_hot(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))):
            return lookup  # rows that stay where they are need no hot keys
        hot, whole = frequent(counts.where(F.col("use") == i), rows_of[i], keys_of[i])
        return replace(lookup, hot=hot, all_hot=whole and (lookup.size or 0) <= BROADCAST_BYTES)

    return [ready(i) for i in range(len(uses))]


def _held_rows(lookup: Lookup, held: DataFrame, keys: int) -> Lookup:
    """The lookup with only the rows of held keys, staged, to be measured. ``keys`` are as many as there can be."""
    held = F.broadcast(held) if keys <= HELD_KEYS else held
    rows = lookup.rows.join(held, lookup.row_code() == F.col("held_code"), "left_semi")
    return replace(lookup, rows=stage(rows, "reduced-lookup"), size=None)


def found(name: str) -> Column:
    """The lookup's value column, for use in the updates of :func:`left_lookup`."""
    return column(f"_found_{name}")


def _key_code(keys: Sequence[Column]) -> Column:
    return F.when(reduce(and_, (k.isNotNull() for k in keys)), F.xxhash64(*keys))


def left_lookup(
    fact: DataFrame,
    lookup: Lookup,
    match: Mapping[str, Column],
    updates: Mapping[str, Column],
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Left join and replace columns in place; columns and their order stay as they are.

    ``match`` gives the fact expression for each lookup key. A NULL key matches
    nothing. ``updates`` gives the new expression of each replaced column and may
    use :func:`found`. ``hot`` are the hashes of frequent keys, where the caller has
    reduced the lookup and knows them from a cheaper table than ``fact``; any list gives
    the same rows. A lookup that was :func:`prepared` for these rows has its own.
    """
    if hot is None:
        (lookup,) = prepared(fact, [(lookup, match)])
    else:
        (lookup,) = measured(replace(lookup, hot=tuple(hot), all_hot=False))
    keyed = fact.withColumns({f"_key_{k}": e for k, e in lookup.typed(match).items()})
    table = lookup.table.withColumnsRenamed(
        {k: f"_at_{k}" for k in lookup.keys} | {v: f"_found_{v}" for v in lookup.values}
    )
    on = reduce(and_, (column(f"_key_{k}") == column(f"_at_{k}") for k in lookup.keys))
    if lookup.small:
        joined = keyed.join(F.broadcast(table), on, "left")
    elif fact.isStreaming or not lookup.unique:
        joined = keyed.join(table, on, "left")
    elif lookup.all_hot:
        joined = keyed.join(F.broadcast(table.filter(_at_code(lookup).isin(list(lookup.hot or ())))), on, "left")
    elif PART in fact.columns:
        joined = _join_in_place(keyed, table, lookup, on)
    else:
        joined = _skew_safe_join(keyed, table, lookup, on, list(lookup.hot or ()))
    own = set(fact.columns)
    return joined.withColumns(dict(updates)).drop(*(c for c in joined.columns if c not in own))


def _at_code(lookup: Lookup) -> Column:
    return F.xxhash64(*(column(f"_at_{k}") for k in lookup.keys))


def _join_in_place(keyed: DataFrame, table: DataFrame, lookup: Lookup, on: Column) -> DataFrame:
    """Join without moving ``keyed``, which is in parts: a key is asked for once by each part that holds
    it, so that a frequent one costs no task more than there are parts, and rows without a key cost nothing."""
    code = _key_code([column(f"_key_{k}") for k in lookup.keys]).alias("_asked_code")
    asked = keyed.select(column(PART), code).where("_asked_code is not null").distinct()
    asked = asked.withColumnRenamed(PART, "_asked_part")
    table.sparkSession.conf.set(_ALL_KEYS, "false")  # rows that lie by part are together for part and key
    limit = HASH_BYTES * int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    coded = table.withColumn("_at_code", _at_code(lookup))
    if (lookup.size or 0) <= limit:
        coded = coded.hint("shuffle_hash")
    # equal hashes of different keys bring a row more, which the keys' own comparison leaves out
    answers = asked.join(coded, F.col("_asked_code") == F.col("_at_code")).drop("_asked_code", "_at_code")
    if lookup.searches is not None and lookup.count and lookup.searches * (lookup.size or 0) <= limit * lookup.count:
        answers = answers.hint("shuffle_hash")
    return keyed.join(answers, (column(PART) == F.col("_asked_part")) & on, "left")


def _skew_safe_join(
    keyed: DataFrame, table: DataFrame, lookup: Lookup, on: Column, hot: list[int]
) -> DataFrame:
    code = _key_code([column(f"_key_{k}") for k in lookup.keys])
    at_code = _at_code(lookup)

    # The key's hash is a second join column. Rows that need no shuffle join, hot or
    # without a key, carry a hash of the whole row and its partition there instead: that
    # spreads different rows however few parts they come in, and exact copies by the parts
    # they are in, and is the same when a task is run again. Maps have no hash.
    searches = code.isNotNull() & ~code.isin(hot) if hot else code.isNotNull()
    whole = [column(f.name) for f in keyed.schema if "map<" not in f.dataType.simpleString()]
    spread = F.xxhash64(F.spark_partition_id(), *whole)
    # A few bits of it do: whole hashes cannot be compressed, and the keys are compared anyway.
    rows = keyed.withColumn("_code", F.pmod(F.when(searches, code).otherwise(spread), F.lit(CODES)).cast("int"))
    # else rows that happen to lie by their key alone would stay so, however skewed
    table.sparkSession.conf.set(_ALL_KEYS, "true")
    coded = table.withColumn("_at_code", F.pmod(at_code, F.lit(CODES)).cast("int"))
    partitions = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if (lookup.size or 0) <= HASH_BYTES * partitions:
        coded = coded.hint("shuffle_hash")
    joined = rows.join(coded, (F.col("_code") == F.col("_at_code")) & on, "left")
    if not hot:
        return joined

    # One row per key and at most HOT_KEYS hashes: a bounded broadcast.
    values = [f"_found_{v}" for v in lookup.values]
    hot_rows = table.filter(at_code.isin(hot)).withColumnsRenamed(
        {c: f"_hot{c}" for c in table.columns}
    )
    hot_on = reduce(and_, (column(f"_key_{k}") == column(f"_hot_at_{k}") for k in lookup.keys))
    return joined.join(F.broadcast(hot_rows), hot_on, "left").withColumns(
        {v: F.coalesce(column(f"_hot{v}"), column(v)) for v in values}
    )


def hot_key_codes(fact: DataFrame, *codes: Column) -> list[list[int]]:
    """For each column of key hashes, those that hold more than a quarter of an average task.

    Frequent-items sketches in one pass over the keys, merged in two steps: first those of
    the tasks of a group, in as many tasks as there are groups, then SKETCH_GROUPS of them.
    The share follows the number of shuffle partitions; at most HOT_KEYS numbers per column
    return. What a sketch misses is only less well balanced, never wrong.
    """
    partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = 1 / (4 * partitions)
    tracked = min(TRACKED_KEYS, max(1000, 16 * partitions))
    most = min(HOT_KEYS, 4 * partitions, tracked)
    names = [f"code{i}" for i in range(len(codes))]
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("sketch_group")
    sketches = fact.select(group, *(c.alias(n) for c, n in zip(codes, names))).groupBy("sketch_group").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.expr(f"approx_top_k_accumulate({n}, {tracked})").alias(n) for n in names),
    )
    # a constant key: without one, tasks that get no group fail on their empty sketch
    row = sketches.groupBy(F.lit("all").alias("all")).agg(
        F.sum("n").alias("n"),
        *(F.expr(f"approx_top_k_estimate(approx_top_k_combine({n}, {tracked}), {most})").alias(n) for n in names),
    ).first()
    return [
        [
            t["item"] for t in (row[n] if row else None) or []
            if t["item"] is not None and t["count"] >= row["n"] * share
        ]
        for n in names
    ]
