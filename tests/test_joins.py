import pytest
from pyspark.sql import functions as F

from obligo.operators import joins
from obligo.operators.joins import Sized, heavy_keys, join_dimension, measure

from conftest import plan, rows


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows share one key, some keys are missing, some are unknown."""
    key = (
        F.when(F.col("id") % 3 == 0, 1)
        .when(F.col("id") % 7 == 0, None)
        .otherwise(F.col("id") % 50)
    )
    return spark.range(3000).select(key.cast("long").alias("k"), F.col("id").alias("v"))


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.range(30).select(
        F.col("id").alias("k"), F.concat(F.lit("name "), "id").alias("name")
    )


def test_measure_counts_texts_and_rows(spark):
    small = spark.createDataFrame([("ab", 1), (None, 2)], "s string, i int")
    nested = spark.createDataFrame([([1, 2],)], "a array<int>")
    sizes = measure({"small": small, "empty": small.limit(0), "nested": nested})
    assert sizes["small"].n_bytes == 2 * (16 + 8 * 2) + 2
    assert sizes["empty"].n_bytes == 0
    assert sizes["nested"].n_bytes > 24
    assert measure({}) == {}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_broadcast_join(facts, dimension, how):
    expected = rows(facts.join(dimension, "k", how))
    small = join_dimension(facts, Sized(dimension, 100), ["k"], how)
    large = join_dimension(facts, Sized(dimension, 10**12), ["k"], how)
    assert "BroadcastHashJoin" in plan(small)
    assert "_salt" in plan(large)
    assert rows(small) == expected
    assert rows(large) == expected


def test_salted_join_of_facts_with_only_the_key(facts, dimension):
    keys = facts.select("k")
    large = join_dimension(keys, Sized(dimension, 10**12), ["k"], "left")
    assert rows(large) == rows(keys.join(dimension, "k", "left"))


def test_hot_and_missing_keys_are_spread(facts, dimension):
    salted = join_dimension(facts, Sized(dimension, 10**12), ["k"], "left", salts=16)
    assert salted.columns == ["k", "v", "name"]
    salt = F.pmod(F.xxhash64("v"), F.lit(16))
    hot = facts.filter("k = 1 or k is null").groupBy("k", salt).count()
    assert hot.groupBy("k").count().agg(F.min("count")).first()[0] == 16


def test_repeated_dimension_rows_fan_out(spark, facts, dimension):
    twice = dimension.union(dimension)
    for size in (1, 10**12):
        got = join_dimension(facts, Sized(twice, size), ["k"], "inner").count()
        assert got == 2 * facts.join(dimension, "k").count()


def test_facts_must_be_kept(facts, dimension):
    with pytest.raises(ValueError):
        join_dimension(facts, Sized(dimension, 1), ["k"], "right")


def test_heavy_keys_are_found_and_others_are_not(spark):
    half = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 9 == 0, None)
        .otherwise(F.col("id") + 100).cast("long").alias("k"))
    hot = heavy_keys(half, ["k"])
    named = half.select("k").distinct().withColumn("h", F.xxhash64(F.col("k").cast("string")))
    assert {r.k for r in named.collect() if r.h in hot} == {7, None} and len(hot) == 2
    assert heavy_keys(half.limit(0), ["k"]) == []
    as_int = half.select(F.col("k").cast("int"))
    assert sorted(heavy_keys(as_int, ["k"])) == sorted(hot)


def test_only_hot_keys_are_repeated_and_tasks_are_even(spark):
    """Half of the rows have one key."""
    facts = spark.range(64_000).select(
        F.when(F.col("id") % 2 == 0, 3).otherwise(F.col("id") % 2000).alias("k"),
        F.col("id").alias("v")).cache()
    dimension = spark.range(2000).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    joined = join_dimension(facts, Sized(dimension, 10**12), ["k"], "inner", salts=64,
                            hot=heavy_keys(facts, ["k"], 0.1))
    generated = [line for line in plan(joined).splitlines() if "Generate explode" in line]
    assert len(generated) == 1
    per_task = joined.groupBy(F.spark_partition_id().alias("p")).count()
    counts = sorted(r["count"] for r in per_task.collect())
    assert sum(counts) == 64_000 and max(counts) < 0.4 * 64_000
    right = spark.range(2000).select(F.col("id").alias("k"))
    salted = join_dimension(facts, Sized(right.withColumn("one", F.lit(1)), 10**12), ["k"],
                            "inner", hot=heavy_keys(facts, ["k"], 0.1))
    assert salted.count() == 64_000
    facts.unpersist()


def test_no_salt_where_no_key_is_hot(spark):
    facts = spark.range(50_000).withColumnRenamed("id", "k")
    dimension = Sized(spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("one")),
                      10**12)
    assert "_salt" not in plan(join_dimension(facts, dimension, ["k"]))
    assert "_salt" not in plan(join_dimension(facts, dimension, ["k"], salts=1))


@pytest.mark.parametrize("slots", [1 << 28, 64])
def test_bitmaps_keep_every_listed_key_and_drop_most_others(spark, monkeypatch, slots):
    monkeypatch.setattr(joins, "SLOTS", slots)
    df = spark.range(5000).select(F.when(F.col("id") > 0, F.concat(F.lit("t"), "id")).alias("k"))
    listed = df.filter("k IS NULL OR k LIKE '%77'").distinct()
    kept = joins.maybe_listed(df, listed, ["k"])
    assert rows(kept.join(listed, df.k.eqNullSafe(listed.k), "left_semi")) == rows(listed)
    assert kept.columns == ["k"] and (kept.count() == listed.count() or slots == 64)
    assert joins.maybe_listed(df, listed.limit(0), ["k"]).isEmpty()
    assert "Broadcast" in plan(kept) and "Python" not in plan(kept)
