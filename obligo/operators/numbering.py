"""Dense row numbers without a window over all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obligo.operators.joins import measured_bytes
from obligo.session import SHUFFLE_TASK_BYTES
from obligo.sinks.tables import stored

PARTITION_SHIFT = 33  # monotonically_increasing_id: the partition, then 33 bits of row numbers


def dense_numbers(df: DataFrame, order: list[str], within: list[str] | None = None,
                  number: str = "number", total: str | None = None) -> DataFrame:
    """Numbers the rows 0, 1, 2, ... by ``order``, of each group ``within`` where one is given.

    Rows are dealt to ranges of (within, order) and sorted there. Each range counts its rows per
    group, the counts of the ranges before are added up, and a row's number is that sum and its
    place in its range. What is added up is one row per range and group, never one per row, so a
    group of any size is numbered by as many tasks as it has ranges. Rows that are equal in the
    order are told apart by where they stand in the stored input, so that they can be split too;
    which of them comes first is not defined. Nulls come first.

    ``total`` names a column for the number of rows of the group.
    """
    spark, by = df.sparkSession, [*(within or []), *order]
    fixed = stored(spark, df.withColumn("_tie", F.monotonically_increasing_id()), "unnumbered")
    ranges = -(-measured_bytes(fixed) // SHUFFLE_TASK_BYTES)
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in [*by, "_tie"]]
    dealt = (fixed.repartitionByRange(ranges, *keys) if ranges > default
             else fixed.repartitionByRange(*keys))
    placed = stored(
        spark,
        dealt.sortWithinPartitions(*keys).drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_at", PARTITION_SHIFT)),
        "placed",
    )
    groups = within or []
    counts = placed.groupBy(*groups, "_range").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    group = Window.partitionBy(*groups)
    before = F.sum("_rows").over(
        group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = stored(spark, counts.select(
        *[F.col(c).alias(f"_of_{c}") for c in groups], F.col("_range").alias("_of_range"),
        (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(group).alias("_total")), "starts")
    matches = reduce(
        lambda a, b: a & b,
        [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in groups],
        F.col("_range") == F.col("_of_range"))
    # Spark broadcasts the stored starts or shuffles both sides, by the size of the files.
    return placed.join(starts, matches).select(
        *df.columns, (F.col("_at") + F.col("_shift")).alias(number),
        *([F.col("_total").alias(total)] if total else []))
