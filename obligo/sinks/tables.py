"""Writing tables: files, remote relations, chunks and dated snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obligo.functions.keys import bucket
from obligo.session import scratch_folder
from obligo.sources.relational import Connection

# Rows the published target takes per insert (fixed value).
ROWS_PER_INSERT = 1000
# Chunk counts of the published writers (fixed values).
MART_CHUNKS = 10
DETAIL_CHUNKS = 100
# A file is uneven with more than so many times the rows of a mean one.
EVEN = 3


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Writes an intermediate table to the scratch folder and reads it back.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    path = f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_evenly(df: DataFrame, path: str) -> bool:
    """Writes large rows as they come, without an exchange, and says whether the files are even.

    A join may leave all rows of a hot key, or all copies of a row, in one file. Copies take next
    to no bytes, so no reader would split that file again. The rows of every file are counted from
    what was written; the caller deals them anew where one has far more than its share, or where
    there are fewer files than cores.
    """
    spark = df.sparkSession
    df.write.option("compression", "zstd").parquet(path)
    files = spark.read.schema(df.schema).parquet(path).groupBy(
        F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    found = files.agg(F.max("n").alias("most"), F.sum("n").alias("rows"),
                      F.count(F.lit(1)).alias("files")).first()
    return not found["files"] or (
        found["files"] >= min(spark.sparkContext.defaultParallelism, found["rows"])
        and found["most"] * found["files"] <= EVEN * found["rows"])


def write_files(df: DataFrame, path: str, mode: str = "error", files: int | None = None) -> None:
    """Writes a table as it is; ``files`` rebalances it into about so many even files."""
    if files is not None:
        df = df.repartition(files)
    df.write.mode(mode).parquet(path)


def write_relation(df: DataFrame, target: Connection, table: str, mode: str = "error",
                   connections: int | None = None, key: str | None = None) -> None:
    """Writes to a remote table: fails if it exists, or appends.

    ``connections`` bounds how many tasks insert at the same time. Rows are spread by ``key``
    where one is given, so that a repeated task inserts the rows it inserted before. A task that
    failed after some of its inserts were committed inserts them again: give the target a key
    constraint that refuses them, or write to a staging table and swap it in when all is there.
    """
    if mode not in ("error", "append"):
        raise ValueError("mode must be 'error' or 'append'")
    if connections is not None:
        df = df.repartition(connections, F.xxhash64(key)) if key else df.repartition(connections)
    df.write.option("batchsize", ROWS_PER_INSERT).jdbc(
        target.url, table, mode=mode, properties=target.options
    )


def chunk_of(key: str, chunks: int, algo: str = "xxhash64") -> Column:
    """Chunk 1..chunks of a row. The same row is always in the same chunk."""
    return (bucket(F.col(key), chunks, algo) + 1).alias("chunk")


def assign_chunks(df: DataFrame, key: str, chunks: int, algo: str = "xxhash64") -> DataFrame:
    """Splits a table into disjoint chunks that together hold every row, in one pass."""
    return df.withColumn("chunk", chunk_of(key, chunks, algo))


def chunk_row_counts(df: DataFrame, key: str, chunks: int, algo: str = "xxhash64") -> DataFrame:
    """Rows per chunk, all chunks in one pass."""
    return df.groupBy(chunk_of(key, chunks, algo)).agg(F.count(F.lit(1)).alias("n_rows"))


def partition_row_counts(df: DataFrame) -> DataFrame:
    """Rows per partition of a plan."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def write_chunks(df: DataFrame, path: str, key: str, chunks: int = MART_CHUNKS,
                 mode: str = "append") -> None:
    """Writes a table in chunks, one folder per chunk, without reading it once per chunk.

    A chunk is a hash range of the key, so chunks are even. Rows are rebalanced by chunk before
    they are written: a small chunk is one file, a large or skewed one several, and there is no
    file per chunk and task.
    """
    (
        assign_chunks(df, key, chunks)
        .hint("rebalance", "chunk")
        .write.mode(mode)
        .partitionBy("chunk")
        .parquet(path)
    )


def with_snapshot(df: DataFrame, snapshot_date: str) -> DataFrame:
    return df.withColumn("snapshot_date", F.lit(snapshot_date))


def write_snapshot(df: DataFrame, root: str, snapshot_date: str) -> None:
    """Appends one dated snapshot to a table; writing the same date again replaces it.

    The partition folder is the unit of replacement, so a repeated run that has fewer rows, or
    none, leaves nothing of the earlier run behind. Rows are rebalanced into files of even size:
    the join or aggregation before may have left a hot key in one partition and little in others.
    """
    df.hint("rebalance").write.mode("overwrite").parquet(f"{root}/snapshot_date={snapshot_date}")


def read_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """All snapshots of a table; a filter on ``snapshot_date`` prunes folders."""
    return (
        spark.read.option("basePath", root)
        .option("mergeSchema", "false")
        .parquet(root)
        .withColumn("snapshot_date", F.col("snapshot_date").cast("string"))
    )


def snapshot_dates(spark: SparkSession, root: str) -> list[str]:
    """Dates of the stored snapshots in order, from the names of the folders; no file is opened."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    prefix = "snapshot_date="
    names = [f.getPath().getName() for f in files.listStatus(path)]
    return sorted(n[len(prefix):] for n in names if n.startswith(prefix))


def latest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the most recent snapshot; the scan is pruned to its folder."""
    snapshots, dates = read_snapshots(spark, root), snapshot_dates(spark, root)
    return snapshots.filter(F.col("snapshot_date") == (dates[-1] if dates else ""))


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """Stores a snapshot bucketed by its key, so that snapshots compare without a shuffle."""
    df.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(
        table
    )
