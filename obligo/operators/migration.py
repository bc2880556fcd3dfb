"""Which tables to copy, by which key, and in how many chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the published chunk rule.
PADDING = 1.10
ROWS_PER_CHUNK = 1_000_000
SPLIT_ABOVE_CHUNKS = 1.5


def padded_rows(estimate: Column) -> Column:
    """The estimate plus ten per cent, as a whole number."""
    return F.floor(estimate.cast("double") * F.lit(PADDING)).cast("bigint")


def chunk_plan(estimates: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Chunks and save mode per table: large tables are appended in chunks, others written once.

    The number of chunks is rounded half to even.
    """
    upper = padded_rows(F.col("approx_cnt"))
    split = upper > F.lit(SPLIT_ABOVE_CHUNKS * rows_per_chunk)
    return estimates.select(
        "*",
        upper.alias("upper_bound"),
        F.when(split, F.bround(upper.cast("double") / F.lit(float(rows_per_chunk))))
        .otherwise(F.lit(1))
        .cast("int")
        .alias("n_chunks"),
        F.when(split, F.lit("append")).otherwise(F.lit("error")).alias("save_mode"),
    )


def migration_plan(tables: DataFrame, keys: DataFrame, constraints: DataFrame,
                   estimates: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """One row per stored table with a primary key: its key columns, size and chunks.

    The columns of a composite key are one array, so such a table is listed once. A database
    bounds the columns of a key, so the array is short.
    """
    primary = constraints.filter(F.col("constraint_type") == "PRIMARY KEY").select(
        "constraint_name"
    )
    listed = (
        keys.join(primary, "constraint_name")
        .join(tables.select("table_name"), "table_name")
        .join(estimates.select("table_name", "approx_cnt"), "table_name")
        .groupBy("table_name")
        .agg(F.sort_array(F.collect_set("column_name")).alias("pkey"),
             F.max("approx_cnt").alias("approx_cnt"))
    )
    return chunk_plan(listed, rows_per_chunk)
