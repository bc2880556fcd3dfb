"""Legislator documents: one JSON object per person with an array of terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obligo.schemas import LEGISLATOR
from obligo.sources.json_arrays import read_json_arrays


def read_legislators(spark: SparkSession, paths: str | list[str],
                     multiline: bool = True, split_arrays: bool = False) -> DataFrame:
    """Reads the documents with their declared schema, so no inference pass over the files.

    ``multiline=True`` is for files that hold one JSON array; such a file is one task.
    ``split_arrays=True`` finds the borders of its documents first, so a large file is many tasks.
    ``multiline=False`` is for one document per line, which Spark can split.
    """
    if split_arrays:
        return read_json_arrays(spark, paths, LEGISLATOR)
    return spark.read.schema(LEGISLATOR).option("multiLine", multiline).json(paths)
