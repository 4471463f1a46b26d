from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cargoweave.operators.lookup import (
    HOT_KEYS,
    found,
    hot_key_codes,
    left_lookup,
    lookup_table,
    measured,
)


@pytest.fixture
def no_broadcast(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(
        [(1, "a", "x"), (2, "b", None), (3, None, "y"), (4, "c", "z")],
        "id int, `key.1` string, value string",
    )


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [("a", "A1", 2), ("a", "A2", 1), ("b", None, 7), (None, "N", 9)],
        "k string, v string, w int",
    )


def update(fact, lookup, **options):
    return left_lookup(
        fact, lookup, {"k": F.col("`key.1`")}, {"value": F.coalesce(found("v"), F.col("value"))},
        **options,
    )


@pytest.mark.parametrize("broadcast_bytes", [10**6, 0])
def test_keeps_rows_columns_and_order(fact, dim, rows, no_broadcast, broadcast_bytes):
    lookup = lookup_table(dim, ["k"], ["v", "w"], broadcast_bytes=broadcast_bytes)
    result = update(fact, lookup)
    assert result.columns == fact.columns
    # "a" is there twice: its smallest row of values wins; NULL matches nothing.
    assert rows(result) == [(1, "a", "A1"), (2, "b", None), (3, None, "y"), (4, "c", "z")]


def test_repeated_key_can_expand_or_fail(fact, dim, rows):
    expanded = update(fact, lookup_table(dim, ["k"], ["v", "w"], on_duplicate="expand"))
    assert [r for r in rows(expanded) if r[0] == 1] == [(1, "a", "A1"), (1, "a", "A2")]
    with pytest.raises(Exception, match="repeated keys in k"):
        update(fact, lookup_table(dim, ["k"], ["v", "w"], on_duplicate="error")).collect()
    unique = dim.filter("k = 'b'")
    assert update(fact, lookup_table(unique, ["k"], ["v", "w"], on_duplicate="error")).count() == 4
    with pytest.raises(ValueError, match="on_duplicate"):
        lookup_table(dim, ["k"], ["v"], on_duplicate="max")


def test_winner_is_one_whole_row(spark, rows):
    dim = spark.createDataFrame([("a", "x", "2"), ("a", "y", "1")], "k string, p string, q string")
    assert rows(lookup_table(dim, ["k"], ["p", "q"]).table) == [("a", "x", "2")]


def test_keys_of_other_types_match_by_value(spark, rows):
    fact = spark.createDataFrame([("7", None), ("x", None)], "`key.1` string, value string")
    dim = spark.createDataFrame([(7, "seven")], "k bigint, v string")
    for size in (10**6, 0):
        result = update(fact, lookup_table(dim, ["k"], ["v"], broadcast_bytes=size))
        assert rows(result) == [("7", "seven"), ("x", None)]


def test_size_decides_the_plan(spark, fact, dim, plan, no_broadcast):
    small, large = measured(
        lookup_table(dim, ["k"], ["v"]), lookup_table(dim, ["k"], ["v"], broadcast_bytes=50)
    )
    assert small.small and not large.small
    assert "BroadcastHashJoin LeftOuter" in plan(update(fact, small))
    shuffled = plan(update(fact, large, hot=[]))
    assert "ShuffledHashJoin LeftOuter BuildRight" in shuffled
    assert "BroadcastHashJoin" not in shuffled and "SortMergeJoin" not in shuffled
    huge = replace(large, size=10**15)  # more than tasks could hash
    assert "SortMergeJoin LeftOuter" in plan(update(fact, huge, hot=[]))


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key, a third have none, and both are exact copies."""
    return spark.range(30_000).select(
        F.expr("case when id % 3 = 0 then 'hot' when id % 3 = 1 then null"
               " else concat('k', id % 5000) end").alias("key.1"),
        F.lit(None).cast("string").alias("value"),
    )


def big_dim(spark):
    return spark.range(4000).select(
        F.concat(F.lit("k"), "id").alias("k"), F.concat(F.lit("v"), "id").alias("v")
    ).union(spark.createDataFrame([("hot", "HOT")], "k string, v string"))


def test_skew_safe_join_equals_broadcast_join(spark, skewed, no_broadcast):
    dim = big_dim(spark)
    broadcast = update(skewed, lookup_table(dim, ["k"], ["v"]))
    shuffled = update(skewed, lookup_table(dim, ["k"], ["v"], broadcast_bytes=0))
    assert shuffled.count() == 30_000
    assert broadcast.exceptAll(shuffled).isEmpty() and shuffled.exceptAll(broadcast).isEmpty()
    # The list of hot keys changes the plan, never the rows.
    for hot in ([], [1, 2, 3]):
        other = update(skewed, lookup_table(dim, ["k"], ["v"], broadcast_bytes=0), hot=hot)
        assert broadcast.exceptAll(other).isEmpty() and other.count() == 30_000


def test_hot_and_missing_keys_are_spread(spark, skewed, conf, plan, no_broadcast):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "32")
    lookup = lookup_table(big_dim(spark), ["k"], ["v"], broadcast_bytes=0)
    fact = skewed.repartition(16)
    assert "hashpartitioning(_code#" in plan(update(fact, lookup))

    def largest_task(df, value):
        sizes = df.withColumn("p", F.spark_partition_id()).groupBy("p").agg(
            F.count(F.lit(1)).alias("n"), F.max(value).alias("v")
        )
        # The value is asked for, or Spark would leave the join out.
        return sizes.agg(F.max("n"), F.max("v")).first()[0]

    # Evenly dealt out that is about 940; left alone, a key's 10,000 meet in one task.
    assert largest_task(update(fact, lookup), "value") < 5_000
    table = lookup.table.withColumnRenamed("k", "k2")
    assert largest_task(fact.join(table, F.expr("`key.1` = k2"), "left"), "v") >= 10_000


def test_hot_keys_are_few_and_frequent(spark):
    codes = spark.range(100_000).select(
        F.expr("case when id % 4 = 0 then 7L when id % 4 = 1 then null else id end").alias("c")
    )
    (hot,) = hot_key_codes(codes, F.col("c"))
    assert hot == [7]
    many = spark.range(10_000).select((F.col("id") % 1000).alias("c"))
    assert len(hot_key_codes(many, F.col("c"))[0]) <= HOT_KEYS


def test_unknown_lookup_value_of_hot_key_leaves_the_row(spark, skewed, no_broadcast):
    dim = big_dim(spark).filter("k <> 'hot'")
    result = update(skewed, lookup_table(dim, ["k"], ["v"], broadcast_bytes=0))
    hot = result.filter("`key.1` = 'hot'")
    assert hot.count() == 10_000 and hot.filter("value is not null").isEmpty()


def test_rows_are_spread_from_few_input_parts(spark, conf, no_broadcast):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "32")
    lookup = lookup_table(big_dim(spark), ["k"], ["v"], broadcast_bytes=0)
    fact = spark.range(30_000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else concat('k', id % 5000) end as `key.1`",
        "cast(null as string) as value",
    ).coalesce(2)
    sizes = update(fact, lookup).withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count("*").alias("n"), F.max("value").alias("v"))
    assert sizes.agg(F.max("n"), F.max("v")).first()[0] < 2 * 30_000 / 32
