import pytest
from pyspark.sql import functions as F

from obligo.operators.intervals import interval_join

from conftest import plan, rows


@pytest.fixture(scope="module")
def points(spark):
    return spark.range(400).select(
        F.concat(F.lit("k"), F.col("id") % 3).alias("k"), F.col("id").alias("n"),
        F.when(F.col("id") % 17 != 0, F.xxhash64("id") % 60).alias("day"))


@pytest.fixture(scope="module")
def intervals(spark):
    made = [("k0", -10, 5, "a"), ("k0", 5, 5, "b"), ("k0", 4, 58, "c"), ("k1", 30, 20, "never"),
            ("k1", -59, 59, "all"), ("k1", -59, 59, "all"), ("k2", None, 9, "open"),
            (None, 0, 9, "nobody")]
    return spark.createDataFrame(made, "k string, first long, last long, name string")


@pytest.mark.parametrize("width", [1, 4, 1000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_rows_are_those_of_the_plain_condition(points, intervals, width, how):
    found = interval_join(points, intervals, ["k"], "day", "first", "last", width, how)
    i = intervals.withColumnRenamed("k", "j")
    want = points.join(i, (F.col("k") == F.col("j")) & F.col("day").between(
        F.col("first"), F.col("last")), how).drop("j")
    assert rows(found.select(want.columns)) == rows(want)
    assert "NestedLoop" not in plan(found) and "CartesianProduct" not in plan(found)


def test_arguments(points, intervals):
    for options in ({"how": "right", "width": 1}, {"width": 0}):
        with pytest.raises(ValueError):
            interval_join(points, intervals, ["k"], "day", "first", "last", **options)
