"""What several of the text operators share: texts, rows, Arrow batches, matrix sums."""

from __future__ import annotations

import ctypes
import gc
import io
import string
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import obligo
from obligo.session import scratch_folder

# ASCII letters in either case, for texts and for the bytes of texts.
LOWER_BYTES = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
ROW = "document_row"
STRETCH_BYTES = 1_000_000
BATCH_LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1_000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 4_000_000,
}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text(name: str = "text") -> Column:
    """The text; a null text counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """Lower-cases A to Z and nothing else."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """What operators with Python code in tasks need of a session.

    Arrow batches are bounded: their defaults are meant for short rows, and a batch is in memory
    several times over, in the JVM and in Python, for every running task. The package is sent to
    the executors once, by way of the shared folder, so they need not have it on their path.
    """
    for key, most in BATCH_LIMITS.items():
        spark.conf.set(key, str(most))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(obligo.__file__).parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    jvm = context._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{scratch_folder(spark)}/obligo-{uuid4().hex}.zip")
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    out = files.create(path)
    out.write(bytearray(data.getvalue()))
    out.close()
    context.addPyFile(files.makeQualified(path).toString())
    _shipped.add(context.applicationId)


def id_or_zero(docs: DataFrame, column: str = "doc_id") -> Column:
    """The id, a missing one as zero of the id's type, so that it can be joined on."""
    kind = docs.select(column).schema[0].dataType
    return F.coalesce(F.col(column), F.lit(0).cast(kind))


def given_back(over: Callable) -> Callable:
    """The same function over Arrow batches; free memory is given back when its task ends.

    Workers outlive their tasks, and what numpy and Arrow have freed would stay theirs.
    """
    def inner(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from over(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
        if trim:
            trim(0)

    return inner


def whole_rows(docs: DataFrame) -> DataFrame:
    """Every column packed into one, so that added columns cannot clash with the table's own."""
    return docs.select(F.struct("*").alias(ROW))


def checksum_mod(divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; a null id counts as the text 'null'."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) % divisor


def stretches(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Runs of texts of about ``size`` bytes, so that what is made of them stays small."""
    whole = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy()) // size
    starts = np.flatnonzero(np.r_[True, whole[1:] != whole[:-1]]) if len(whole) else []
    for s, e in zip(starts, [*starts[1:], len(whole)]):
        yield texts.slice(s, e - s)


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of the texts of an Arrow column, null as empty, a few at a time in memory."""
    for part in stretches(column, STRETCH_BYTES):
        yield from (x or b"" for x in part.cast(pa.binary()).to_pylist())


def array_blocks(values: np.ndarray, rows_per_block: int) -> pd.DataFrame:
    """A float matrix cut into blocks of rows, each as bytes."""
    return pd.DataFrame([
        {"block": i, "value": values[s:s + rows_per_block].astype(np.float32).tobytes()}
        for i, s in enumerate(range(0, len(values), rows_per_block))
    ])


def summed_blocks(blocks: DataFrame) -> DataFrame:
    """Sums the float blocks that tasks emitted under one number; one row per block."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(group["value"].iloc[0]) // 4, np.float64)
        for value in group["value"]:
            total += np.frombuffer(value, np.float32)
        return pd.DataFrame(
            {"block": group["block"].iloc[:1], "value": [total.astype(np.float32).tobytes()]}
        )

    return blocks.groupBy("block").applyInPandas(add, "block int, value binary")


def joined_blocks(rows: Iterable, size: int) -> np.ndarray:
    """The collected blocks as one flat array; blocks that nobody emitted are zero."""
    found = {r["block"]: np.frombuffer(r["value"], np.float32) for r in rows}
    if not found:
        return np.zeros(size, np.float32)
    width = max(len(v) for v in found.values())
    out = np.zeros(size, np.float32)
    for block, value in found.items():
        out[block * width:block * width + len(value)] = value
    return out
