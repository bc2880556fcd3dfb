"""Catalogue metadata of a remote database, as DataFrames.

Each function takes ``read``, which turns a relation name or ``(SELECT ...) alias`` into a
DataFrame: ``functools.partial(read_relation, spark, connection)`` for a live database.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Read = Callable[[str], DataFrame]

# Where the source database keeps its row estimates (fixed value).
ROW_ESTIMATES = "(SELECT reltuples AS approx_cnt, relname AS table_name FROM pg_class) estimates"


def base_tables(read: Read, schema: str = "public") -> DataFrame:
    """Names of the stored tables of a schema; views are left out. The filter is pushed down."""
    return (
        read("information_schema.tables")
        .filter((F.col("table_schema") == schema) & (F.col("table_type") == "BASE TABLE"))
        .select("table_name")
    )


def key_columns(read: Read) -> DataFrame:
    """One row per column of a key constraint."""
    return read("information_schema.key_column_usage").select(
        "table_name", "column_name", "constraint_name"
    )


def constraints(read: Read) -> DataFrame:
    return read("information_schema.table_constraints").select(
        "constraint_name", "constraint_type"
    )


def row_estimates(read: Read, relation: str = ROW_ESTIMATES) -> DataFrame:
    return read(relation).select("table_name", "approx_cnt")


def footer_estimates(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows, files and bytes of Parquet tables, from the footers of their files alone.

    No column is asked for, so tasks read the footers of their files and no page of data; the
    lists of files are taken in by Spark and never held on the driver by this function.
    """
    union = None
    for name, path in paths.items():
        of_file = spark.read.parquet(path).groupBy(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
        ).agg(F.count(F.lit(1)).alias("n"))
        part = of_file.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("approx_cnt"),
            F.count(F.lit(1)).alias("n_files"),
            F.coalesce(F.sum("size"), F.lit(0)).alias("n_bytes"),
        ).select(F.lit(name).alias("table_name"), "approx_cnt", "n_files", "n_bytes")
        union = part if union is None else union.unionByName(part)
    return union


def counted_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of tables that have no catalogue; parquet answers from its footers."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("approx_cnt")).withColumn("table_name", F.lit(name))
        for name, frame in tables.items()
    ]
    union = counts[0]
    for part in counts[1:]:
        union = union.unionByName(part)
    return union.select("table_name", "approx_cnt")
