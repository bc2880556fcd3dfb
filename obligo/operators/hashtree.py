"""Hash trees of snapshots: find what changed without reading what did not.

A snapshot is stored in buckets of its key's hash, one folder per bucket. Beside it lies a tree of
digests: a leaf is the fingerprint of its bucket's rows, a node above the digest of its
``FAN_OUT`` children in order, up to one root. Two trees of the same shape are compared from the
root down; below a node that is the same on both sides nothing is read. The buckets whose leaves
differ are cut into cells by the same hash, and the cells compared by fingerprint where they lie;
the rows of cells that differ are then compared as ``snapshot_diff`` does. All rows of a key lie in
one bucket and cell, so the result is that of the whole snapshots. What is read grows with the buckets that
hold changes, not with the snapshots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obligo.functions.keys import bucket, fingerprint
from obligo.operators.joins import bitmaps, in_bitmaps
from obligo.operators.snapshots import (
    AMOUNT,
    KEY,
    compare_fingerprints,
    snapshot_diff,
    snapshot_fingerprint,
)

BUCKETS, FAN_OUT = 4096, 16
BUCKET = "key_bucket"
# Rows of a cell and, over all buckets, cells at most.
CELL_ROWS, MOST_CELLS = 64, 1 << 20
CELL = "key_cell"


def write_tree(df: DataFrame, path: str, key: str = KEY, amount: str = AMOUNT,
               buckets: int = BUCKETS) -> None:
    """Stores a snapshot in buckets under ``path``, and the tree of their digests.

    Rows are rebalanced by bucket, so a small one is one file and a hot one several.
    """
    spark, rows, nodes = df.sparkSession, f"{path}/rows", f"{path}/tree"
    placed = df.withColumn(BUCKET, bucket(F.col(key), buckets))
    placed.hint("rebalance", BUCKET).write.option("compression", "zstd").partitionBy(
        BUCKET).parquet(rows)
    # Taken of what was written, so that the tree is that of the rows whatever is computed again.
    kept = spark.read.schema(placed.schema).parquet(rows)
    level = kept.groupBy(F.col(BUCKET).alias("node")).agg(
        *fingerprint(F.col(key), F.col(amount))).select(
        "node", F.md5(F.concat_ws("|", "n_rows", "hash_sum", "hash_xor")).alias("digest"))
    depth, width = 0, buckets
    while True:
        level.repartitionByRange("node").sortWithinPartitions("node").write.parquet(
            f"{nodes}/depth={depth}")
        if width <= 1:
            break
        level = spark.read.parquet(f"{nodes}/depth={depth}").groupBy(
            F.floor(F.col("node") / FAN_OUT).cast("int").alias("node")).agg(
            F.array_sort(F.collect_list(F.struct("node", "digest"))).alias("children")).select(
            "node", F.md5(F.array_join(F.transform("children", lambda c: F.concat_ws(
                ":", c["node"].cast("string"), c["digest"])), "|")).alias("digest"))
        depth, width = depth + 1, -(-width // FAN_OUT)


def _depths(buckets: int) -> int:
    depth = 0
    while buckets > 1:
        depth, buckets = depth + 1, -(-buckets // FAN_OUT)
    return depth


def differing_buckets(spark: SparkSession, old: str, new: str,
                      buckets: int = BUCKETS) -> list[int]:
    """Buckets whose digests differ, found from the root down.

    Of each level only the children of differing nodes are looked at; a level's nodes are sorted,
    so files and row groups without them are skipped. The list is bounded by the buckets.
    """
    suspects: list[int] | None = None
    for depth in range(_depths(buckets), -1, -1):
        sides = []
        for side, path in (("old", old), ("new", new)):
            nodes = spark.read.schema("node int, digest string").parquet(
                f"{path}/tree/depth={depth}")
            if suspects is not None:
                nodes = nodes.filter(F.col("node").isin(suspects))
            sides.append(nodes.select("node", F.col("digest").alias(side)))
        found = sides[0].join(sides[1], "node", "full").filter(
            ~F.col("old").eqNullSafe(F.col("new")))
        differing = sorted(r["node"] for r in found.select("node").collect())
        if not differing or depth == 0:
            return differing
        suspects = [n * FAN_OUT + i for n in differing for i in range(FAN_OUT)]
    return []


def _rows_of(spark: SparkSession, path: str, buckets: list[int], key: str,
             amount: str) -> DataFrame:
    """Rows of some buckets; no other folder is listed or opened."""
    rows = f"{path}/rows"
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(rows)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held = [f"{rows}/{BUCKET}={b}" for b in buckets
            if files.exists(jvm.org.apache.hadoop.fs.Path(f"{rows}/{BUCKET}={b}"))]
    if not held:
        return spark.read.parquet(rows).limit(0).select(key, amount)
    return spark.read.option("basePath", rows).parquet(*held).select(key, amount)


def tree_diff(spark: SparkSession, old: str, new: str, key: str = KEY, amount: str = AMOUNT,
              buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``snapshot_diff`` of two stored snapshots."""
    differing = differing_buckets(spark, old, new, buckets)
    sides = [_rows_of(spark, path, differing, key, amount) for path in (old, new)]
    # The cells of a bucket divide it, so a task has those of the few buckets it reads.
    per_bucket = max(side.count() for side in sides) // (
        CELL_ROWS * max(len(differing), 1))
    cells = buckets * min(max(per_bucket, 1), max(MOST_CELLS // buckets, 1))
    cell = bucket(F.col(key), cells)
    prints = [snapshot_fingerprint(side.withColumn(CELL, cell), [CELL], key=key, amount=amount)
              for side in sides]
    changed = compare_fingerprints(*prints, [CELL]).filter(F.col("status") == "changed")
    # Of bounded size: a bit per cell.
    found = bitmaps(changed.select(F.col(CELL).cast("long").alias("slot")))
    maps = spark.createDataFrame(found.collect(), found.schema)
    return snapshot_diff(
        *[in_bitmaps(side, cell.cast("long"), maps) for side in sides], key, amount)
