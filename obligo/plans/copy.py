"""Copying the tables of a database, one after the other, each in parallel."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Partitions of a table read at most (fixed value).
READ_PARTITIONS = 200

# Table, key columns, pieces to read it in; frame, table, chunks, key columns.
ReadTable = Callable[[str, list[str], int], DataFrame]
WriteTable = Callable[[DataFrame, str, int, list[str]], None]


def copy_tables(plan: DataFrame, read: ReadTable, write: WriteTable,
                only: Iterable[str] | None = None,
                partitions: int = READ_PARTITIONS) -> list[str]:
    """Copies every table of a migration plan and returns the names in the order copied.

    The plan has one row per table, so listing it on the driver is safe. Each table is one read
    in as many pieces as the plan has chunks for it, ``partitions`` at most, and one write. Rows
    and columns reach the writer as they are in the source, whatever the size; the number of
    chunks and the key only tell it how to spread them. The writer replaces its target, or fails
    where there is one, so a repeated copy never adds the rows again.
    """
    if only is not None:
        plan = plan.filter(F.col("table_name").isin(list(only)))
    copied = []
    for row in plan.orderBy("table_name").toLocalIterator():
        name, key, chunks = row["table_name"], row["pkey"], row["n_chunks"]
        write(read(name, key, min(chunks, partitions)), name, chunks, key)
        copied.append(name)
    return copied
