"""Exact deduplication with a two-pass Bloom filter.

The first pass sets the bits of every text's digest in a filter of two layers: bits set once and
bits set again. Layers of different tasks merge as seen = a or b, again = a' or b' or (a and b).
The second pass tests each digest against the second layer. A digest that occurs twice has all of
its bits there, so nothing is missed; only rows that test positive are shuffled and compared by
their whole digest, all others pass straight through.

The filter has BITS_PER_ROW bits a row. Where that exceeds ``filter_bytes``, the digests are cut
into slices that are stored in folders of their own, and each slice has a filter of its own. A
slice is read twice, to fill its filter and to be tested; its filter is broadcast for the test and
released after it, its bits are kept in the shared folder. So the work is in proportion to the
rows whatever the number of slices, and the bound of what is broadcast never depends on the number
of rows, nor does the rate of false positives. Documents to be filtered are cut in the same way.

Defined cases: a null text is empty; texts are equal when they are identical after lower-casing
A to Z; of rows with equal text the largest doc_id stays, null ids counting as smallest; of
repeated rows (same id, same text) exactly one stays; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obligo.llm.common import ROW, documents, given_back, lower_ascii, prepare, text, whole_rows
from obligo.session import remove_folder, scratch_folder
from obligo.sinks.tables import stored

BITS_PER_ROW = 16
HASHES = 2
BLOCK_SLOTS = 1 << 16
# Most bytes one broadcast filter takes.
FILTER_BYTES = 64 * 1024**2
# Up to so many slices tasks write a file for each; beyond that the rows are shuffled by slice.
SLICES_IN_PLACE = 16
# Slots a task gathers before it hands them on.
CHUNK_SLOTS = 1 << 21


def digest(name: str = "text") -> Column:
    return F.unhex(F.sha2(lower_ascii(text(name)), 256))


def slots_of(digests: list[bytes], slots: int) -> np.ndarray:
    """HASHES slot numbers per digest, by double hashing of its first 16 bytes."""
    words = np.frombuffer(b"".join(d[:16] for d in digests), np.uint64).reshape(-1, 2)
    steps = np.arange(HASHES, dtype=np.uint64)
    return (words[:, :1] + steps * (words[:, 1:] | np.uint64(1))) % np.uint64(slots)


def layers(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots met once and slots met more than once. A row counts once for a slot."""
    slots = np.sort(slots, axis=1)
    slots[:, 1:][slots[:, 1:] == slots[:, :-1]] = -1
    numbers, counts = np.unique(slots[slots >= 0], return_counts=True)
    return numbers[counts == 1], numbers[counts > 1]


def filter_of(narrow: DataFrame, slots: int) -> np.ndarray:
    """The second layer over all rows, one bit a slot, packed. Its size is bounded by ``slots``."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(parts: list[np.ndarray]) -> pa.RecordBatch:
            once, again = layers(np.concatenate(parts).astype(np.int64))
            numbers = np.concatenate([once, again])
            repeated = np.repeat([False, True], [len(once), len(again)])
            order = np.argsort(numbers // BLOCK_SLOTS, kind="stable")
            numbers, repeated = numbers[order], repeated[order]
            blocks, starts = np.unique(numbers // BLOCK_SLOTS, return_index=True)
            offsets = (numbers % BLOCK_SLOTS).astype(np.uint16)
            return pa.RecordBatch.from_pydict({
                "block": pa.array(blocks, pa.int64()),
                "once": [p[~r].tobytes() for p, r in zip(
                    np.split(offsets, starts[1:]), np.split(repeated, starts[1:]))],
                "again": [p[r].tobytes() for p, r in zip(
                    np.split(offsets, starts[1:]), np.split(repeated, starts[1:]))],
            })

        parts, held = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append(slots_of(batch.column(0).to_pylist(), slots))
                held += parts[-1].size
            if held >= CHUNK_SLOTS:
                yield emit(parts)
                parts, held = [], 0
        if parts:
            yield emit(parts)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(BLOCK_SLOTS, np.uint8)
        for once, again in zip(group["once"], group["again"]):
            met = np.frombuffer(once, np.uint16)
            counts[met] = np.minimum(counts[met] + 1, 2)
            counts[np.frombuffer(again, np.uint16)] = 2
        return pd.DataFrame({"block": group["block"].iloc[:1],
                             "bits": [np.packbits(counts > 1).tobytes()]})

    blocks = (
        narrow.select("digest")
        .mapInArrow(given_back(partial), "block long, once binary, again binary")
        .groupBy("block")
        .applyInPandas(merge, "block long, bits binary")
        .filter(F.col("bits") != F.lit(bytes(BLOCK_SLOTS // 8)))
    )
    packed = np.zeros(slots // 8, np.uint8)
    for r in blocks.toLocalIterator():
        start = r["block"] * (BLOCK_SLOTS // 8)
        packed[start:start + BLOCK_SLOTS // 8] = np.frombuffer(r["bits"], np.uint8)
    return packed


class Filters:
    """The filters of all slices of the digests, and the rows tested by them."""

    def __init__(self, spark: SparkSession, rows: int, filter_bytes: int):
        self.spark = spark
        bits = max(rows * BITS_PER_ROW, BLOCK_SLOTS)
        self.slices = -(-bits // (filter_bytes * 8))
        self.slots = -(-bits // (self.slices * BLOCK_SLOTS)) * BLOCK_SLOTS
        self.whole: Broadcast | None = None  # the filter where there is one slice
        self.kept = ""

    def sliced(self, df: DataFrame, name: str) -> str:
        """Stores rows with a digest, one folder per slice, and returns where."""
        path = f"{scratch_folder(self.spark)}/{name}-{uuid4().hex}"
        cut = df.withColumn("slice", F.pmod(F.xxhash64("digest"), F.lit(self.slices)).cast("int"))
        if self.slices > SLICES_IN_PLACE:
            cut = cut.hint("rebalance", "slice")  # or every task would write a file per slice
        cut.write.partitionBy("slice").parquet(path)
        return path

    def part(self, path: str, i: int, columns: list[str]) -> DataFrame | None:
        """The rows of a slice, from its own folder."""
        folder = f"{path}/slice={i}"
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return self.spark.read.parquet(folder).select(columns) if files.exists(where) else None

    def fill(self, narrow: DataFrame) -> DataFrame:
        """Fills the filters from rows with a digest; the same rows with ``maybe``."""
        if self.slices == 1:
            table = stored(self.spark, narrow, "digests")
            self.whole = self.spark.sparkContext.broadcast(filter_of(table, self.slots))
            return self._tested(table, self.whole)
        path = self.sliced(narrow, "digests")
        self.kept = f"{scratch_folder(self.spark)}/filters-{uuid4().hex}"

        def fill(part: DataFrame, i: int) -> np.ndarray:
            packed = filter_of(part, self.slots)
            self.spark.createDataFrame([(packed.tobytes(),)], "bits binary").coalesce(1).write \
                .parquet(f"{self.kept}/slice={i}")
            return packed

        return self._each(path, narrow, fill)

    def flagged(self, df: DataFrame) -> DataFrame:
        """Other rows with a digest and a column ``maybe``: whether it may occur more than once."""
        if self.slices == 1:
            return self._tested(df, self.whole)

        def read(part: DataFrame, i: int) -> np.ndarray:
            kept = self.spark.read.parquet(f"{self.kept}/slice={i}").first()
            return np.frombuffer(kept["bits"], np.uint8)

        return self._each(self.sliced(df, "sliced"), df, read)

    def _each(self, path: str, df: DataFrame, filter_for: Callable) -> DataFrame:
        """Tests slice after slice, with one filter broadcast at a time."""
        out = f"{path}-flagged"
        for i in range(self.slices):
            part = self.part(path, i, df.columns)
            if part is not None:
                packed = self.spark.sparkContext.broadcast(filter_for(part, i))
                self._tested(part, packed).write.mode("append").parquet(out)
                packed.destroy()
        remove_folder(self.spark, path)
        schema = df.withColumn("maybe", F.lit(True)).schema
        return self.spark.read.schema(schema).parquet(out)

    def _tested(self, df: DataFrame, packed: Broadcast) -> DataFrame:
        slots = self.slots

        @F.pandas_udf("boolean")
        def maybe(digests: pd.Series) -> pd.Series:
            numbers = slots_of(list(digests), slots).astype(np.int64)
            return pd.Series(((packed.value[numbers >> 3] >> (7 - (numbers & 7))) & 1).all(axis=1))

        return df.withColumn("maybe", maybe("digest"))


class ExactDedup:
    """The decisions for one table: ``singles`` (not repeated) and ``repeats`` with their group."""

    def __init__(self, spark: SparkSession, docs: DataFrame, filter_bytes: int = FILTER_BYTES):
        prepare(spark)
        self.filters = Filters(spark, docs.count(), filter_bytes)
        flagged = self.filters.fill(docs.select("doc_id", digest().alias("digest")))
        self.singles = flagged.filter(~F.col("maybe")).select("doc_id", "digest")
        pairs = stored(
            spark,
            flagged.filter("maybe").groupBy("digest", "doc_id")
            .agg(F.count(F.lit(1)).alias("copies")),
            "repeats",
        )
        # Stored, so that the join below reads plain exchanges, which Spark can split by size:
        # a group may hold a third of all rows.
        self.groups = stored(
            spark,
            pairs.groupBy("digest").agg(
                F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")),
            "groups",
        )
        self.repeats = pairs.join(self.groups, "digest")

    def decisions(self) -> DataFrame:
        """One row per document, dropped ones too."""
        singles = self.singles.withColumns({
            "keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True),
        })
        repeats = self.repeats.withColumn(
            "copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))
        ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1))
        columns = ["doc_id", "keep_id", "group_size", "kept",
                   F.lower(F.hex("digest")).alias("text_sha256")]
        return singles.select(*columns).unionByName(repeats.select(*columns))

    def kept_rows(self, docs: DataFrame) -> DataFrame:
        """The rows of the table that stay, with all their columns."""
        rows = self.filters.flagged(
            whole_rows(docs).withColumn("digest", digest(f"{ROW}.text"))
        )
        singles = rows.filter(~F.col("maybe")).select(f"{ROW}.*")
        keepers = self.groups.select(F.col("digest").alias("keep_digest"), "keep_id")
        repeats = (
            rows.filter("maybe")
            .withColumn("doc_key", F.col(f"{ROW}.doc_id"))
            .join(keepers, (F.col("digest") == F.col("keep_digest"))
                  & F.col("doc_key").eqNullSafe(F.col("keep_id")))
            .dropDuplicates(["digest", "doc_key"])
            .select(f"{ROW}.*")
        )
        return singles.unionByName(repeats)


def exact_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return ExactDedup(spark, docs).decisions()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, documents(spark, sf_dir))


SQL = """
WITH texts AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM texts
WINDOW same AS (PARTITION BY text_sha256)
"""
