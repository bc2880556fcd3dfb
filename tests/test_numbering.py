import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from obligo.operators import numbering
from obligo.operators.numbering import dense_numbers

from conftest import plan, rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(5000).select(
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("g"), F.col("id") % 3)).alias("group"),
        F.when(F.col("id") % 11 != 0, F.xxhash64("id") % 1000).alias("value"), "id",
    ).repartition(9, "id").cache()


def test_numbers_are_those_of_a_window(table):
    order = Window.partitionBy("group").orderBy(F.col("value").asc_nulls_first(), "id")
    want = table.withColumn("number", (F.row_number().over(order) - 1).cast("long")).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy("group")))
    assert rows(dense_numbers(table, ["value", "id"], ["group"], total="n")) == rows(want)


def test_numbers_without_groups(table):
    found = dense_numbers(table.select("id"), ["id"], number="at").collect()
    assert sorted(map(tuple, found)) == [(i, i) for i in range(5000)]


def test_equal_rows_are_numbered_without_gap_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(numbering, "SHUFFLE_TASK_BYTES", 4000)
    same = spark.range(3000).select(F.lit("x").alias("k"))
    found = dense_numbers(same, ["k"])
    assert sorted(r.number for r in found.collect()) == list(range(3000))
    assert found.rdd.getNumPartitions() > 1
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 3000


def test_no_window_over_the_rows(spark, table):
    assert "Window" not in plan(dense_numbers(table, ["id"]))


def test_empty_table(spark):
    assert dense_numbers(spark.range(0), ["id"], total="n").collect() == []
