"""Appending a batch in chunks so that every row arrives once, whatever fails and is repeated.

A batch is first stored in chunks, by a hash of the key, in one job. Chunks are then delivered one
after the other to a staging place of their own, each replacing what an earlier try left there,
and a ledger notes what was delivered. At the end one swap makes all of them visible. A run that
stops is run again with the same batch: chunks in the ledger are left alone, the others delivered,
and a batch that was swapped in is not touched. The rows come from what was stored first, so all
tries deliver the same.

The ledger is a folder of files, each made by a rename that never replaces. Deliveries and the swap
are functions, so targets may be files, as here, or tables with staging tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from obligo.sinks.tables import MART_CHUNKS, assign_chunks

# Rows of a chunk and its number to its staging place; then all staging places to the target.
Deliver = Callable[[DataFrame, int], None]
Swap = Callable[[], None]


@dataclass(frozen=True)
class Folders:
    """File operations below one folder."""

    spark: SparkSession
    root: str

    def path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def files(self, name: str = ""):
        return self.path(name).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        return self.files(name).exists(self.path(name))

    def remove(self, name: str) -> None:
        self.files(name).delete(self.path(name), True)

    def rename(self, name: str, to: str) -> None:
        """Moves a file or folder; an error where the target is there or nothing was moved."""
        if self.exists(to) or not self.files(name).rename(self.path(name), self.path(to)):
            raise FileExistsError(f"{self.root}/{to}")

    def mark(self, name: str) -> None:
        """Makes an empty file, seen whole or not at all."""
        staged = f"{name}.{uuid4().hex}"
        self.files(name).create(self.path(staged)).close()
        self.rename(staged, name)


def append_chunks(df: DataFrame, ledger: str, batch: str, key: str, deliver: Deliver, swap: Swap,
                  chunks: int = MART_CHUNKS) -> list[int]:
    """Appends a batch, or goes on with one that stopped; the chunks that this run delivered.

    ``ledger`` is a folder that is kept. ``deliver`` must replace what it delivered for the same
    chunk before, ``swap`` must do nothing where it was done before: a run may stop after either
    and before it was noted.
    """
    spark = df.sparkSession
    notes = Folders(spark, f"{ledger}/{batch}")
    if notes.exists("swapped"):
        return []
    rows = f"{notes.root}/rows"
    if not notes.exists("stored"):
        assign_chunks(df, key, chunks).hint("rebalance", "chunk").write.mode(
            "overwrite").partitionBy("chunk").parquet(rows)
        notes.mark("stored")
    delivered = []
    for i in range(1, chunks + 1):
        if not notes.exists(f"chunk-{i}"):
            if notes.exists(f"rows/chunk={i}"):
                deliver(spark.read.schema(df.schema).parquet(f"{rows}/chunk={i}"), i)
            notes.mark(f"chunk-{i}")
            delivered.append(i)
    swap()
    notes.mark("swapped")
    notes.remove("rows")
    return delivered


def file_target(spark: SparkSession, path: str, batch: str) -> tuple[Deliver, Swap]:
    """Delivers to folders beside the table, and swaps them in as the folder of the batch."""
    table = Folders(spark, path)
    staged, final = f"_staged-{batch}", f"batch={batch}"

    def deliver(rows: DataFrame, chunk: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/{staged}/part-{chunk}")

    def swap() -> None:
        if table.exists(staged):  # not yet, or a batch without rows
            table.rename(staged, final)

    return deliver, swap


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches that were swapped in, with the batch."""
    return spark.read.option("recursiveFileLookup", "false").option("basePath", path).parquet(
        f"{path}/batch=*/*")
