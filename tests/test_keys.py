import hashlib

import pytest
from pyspark.sql import functions as F

from obligo.functions import keys


def test_md5_number_is_the_first_sixty_bits(spark):
    df = spark.createDataFrame([("abc",), ("",)], "s string")
    got = [r[0] for r in df.select(keys.hash_number(F.col("s"), "md5")).collect()]
    assert got == [int(hashlib.md5(t.encode()).hexdigest()[:15], 16) for t in ("abc", "")]


@pytest.mark.parametrize("algo", keys.HASHES)
def test_buckets_are_stable_and_in_range(spark, algo):
    df = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("k"))
    b = keys.bucket(F.col("k"), 7, algo).alias("b")
    first = {r.k: r.b for r in df.select("k", b).collect()}
    again = {r.k: r.b for r in df.orderBy(F.desc("k")).repartition(5).select("k", b).collect()}
    assert first == again
    assert set(first.values()) == set(range(7))


def test_unknown_hash(spark):
    with pytest.raises(ValueError):
        keys.hash_number(F.col("k"), "crc")


def test_natural_key_keeps_missing_parts_apart(spark):
    parts = ["a", "b", "a-b", "-", "", "null", "\\N", "\\", "a\\", None]
    df = spark.createDataFrame([(x, y) for x in parts for y in parts], "x string, y string")
    got = [r[0] for r in df.select(keys.natural_key("x", "y")).collect()]
    assert len(set(got)) == len(parts) ** 2
    assert got[1] == "a-b"


@pytest.mark.parametrize("algo", keys.HASHES)
def test_fingerprint_ignores_order_but_not_content(spark, algo):
    df = spark.range(500).select(
        F.col("id").cast("string").alias("k"), F.col("id").cast("decimal(18,2)").alias("a")
    )

    def fingerprint(rows):
        return rows.agg(*keys.fingerprint(F.col("k"), F.col("a"), algo)).first()

    base = fingerprint(df)
    assert fingerprint(df.orderBy(F.desc("k")).repartition(3)) == base
    swapped = df.withColumn(
        "a", F.when(F.col("k") == "1", 2).when(F.col("k") == "2", 1).otherwise(F.col("a"))
        .cast("decimal(18,2)")
    )
    assert fingerprint(swapped).hash_sum != base.hash_sum
    nulled = df.withColumn("a", F.when(F.col("k") != "1", F.col("a")))
    assert fingerprint(nulled).hash_sum != base.hash_sum
    assert fingerprint(df.limit(0)).asDict() == {"n_rows": 0, "hash_sum": 0, "hash_xor": 0}
