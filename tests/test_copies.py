"""Copies compared with their source."""

import pytest
from pyspark.sql import functions as F

from obligo.verification.registry import compared_copy

from conftest import plan


def table(spark):
    return spark.range(500).select(
        (F.col("id") % 100).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 100).alias("b"),
        F.lit(None).cast("long").alias("c"))


@pytest.mark.parametrize("change, differing", [
    (lambda df: df, 0),
    (lambda df: df.unionByName(df.limit(3)), 3),
    (lambda df: df.filter("a <> 7"), 5),
    (lambda df: df.withColumn("c", F.col("b")).withColumn("b", F.lit(None).cast("long")), 666),
    (lambda df: df.limit(0), 500),
])
def test_every_row_that_differs_is_counted(spark, change, differing):
    source = table(spark)
    copied = change(source)
    assert tuple(compared_copy(source, copied).first()) == (copied.count(), differing)


def test_nothing_is_counted_in_empty_tables(spark):
    empty = table(spark).limit(0)
    assert tuple(compared_copy(empty, empty).first()) == (None, None)


def test_an_equal_copy_moves_no_rows(spark):
    df = table(spark)
    assert "keys=[a" not in plan(compared_copy(df, df))
    assert "keys=[a" in plan(compared_copy(df, df.limit(9)))
