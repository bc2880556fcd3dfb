import pytest
from pyspark.sql import functions as F

from obligo.operators import hashtree
from obligo.operators.hashtree import BUCKET, differing_buckets, tree_diff, write_tree
from obligo.operators.snapshots import snapshot_diff

from conftest import rows

BUCKETS = 64


def snapshot(spark, n=2000):
    return spark.range(n).select(
        F.when(F.col("id") % 5 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), "id"))
        .alias("txn_id"), (F.col("id") % 100).cast("decimal(18,2)").alias("amount"),
        F.lit("AA").alias("state"))


def changed(df):
    """One key gone, one new, one with another amount."""
    edited = df.filter("txn_id != 't3'").withColumn(
        "amount", F.when(F.col("txn_id") == "t7", F.col("amount") + 1).otherwise(F.col("amount"))
        .cast("decimal(18,2)"))
    return edited.union(df.sparkSession.createDataFrame(
        [("new", 1, "AA")], "txn_id string, amount int, state string").withColumn(
        "amount", F.col("amount").cast("decimal(18,2)")))


@pytest.fixture(scope="module")
def trees(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("trees"))
    old = snapshot(spark)
    for name, df in (("old", old), ("new", changed(old)), ("same", old.repartition(3))):
        write_tree(df, f"{root}/{name}", buckets=BUCKETS)
    return root


def test_result_is_that_of_the_whole_snapshots(spark, trees):
    old = snapshot(spark)
    found = tree_diff(spark, f"{trees}/old", f"{trees}/new", buckets=BUCKETS)
    assert rows(found) == rows(snapshot_diff(old, changed(old)))
    assert {r.status for r in found.collect()} == {"new", "missing", "changed"}


def test_only_differing_buckets_are_read(spark, trees):
    differing = differing_buckets(spark, f"{trees}/old", f"{trees}/new", BUCKETS)
    assert 1 <= len(differing) <= 3
    files = tree_diff(spark, f"{trees}/old", f"{trees}/new", buckets=BUCKETS).inputFiles()
    assert {f.split(f"{BUCKET}=")[1].split("/")[0] for f in files} == {str(b) for b in differing}


def test_equal_snapshots_stop_at_the_root(spark, trees, monkeypatch):
    read = []
    real = hashtree.F.col
    assert differing_buckets(spark, f"{trees}/old", f"{trees}/same", BUCKETS) == []
    monkeypatch.setattr(hashtree.F, "col", lambda name: read.append(name) or real(name))
    differing_buckets(spark, f"{trees}/old", f"{trees}/same", BUCKETS)
    assert read.count("node") == 0  # no level below the root is asked for its nodes
    assert tree_diff(spark, f"{trees}/old", f"{trees}/same", buckets=BUCKETS).count() == 0


def test_a_hot_key_and_rows_that_change_places_within_it(spark, tmp_path):
    old = snapshot(spark, 400)
    swapped = old.withColumn("amount", F.when(
        F.col("txn_id") == "hot", F.col("amount") + F.when(F.col("amount") == 0, 5).when(
            F.col("amount") == 5, -5).otherwise(0)).otherwise(F.col("amount"))
        .cast("decimal(18,2)"))
    write_tree(old, f"{tmp_path}/old", buckets=BUCKETS)
    write_tree(swapped, f"{tmp_path}/new", buckets=BUCKETS)
    found = tree_diff(spark, f"{tmp_path}/old", f"{tmp_path}/new", buckets=BUCKETS)
    assert rows(found) == rows(snapshot_diff(old, swapped))


def test_one_bucket_and_an_empty_side(spark, tmp_path):
    old = snapshot(spark, 20)
    write_tree(old, f"{tmp_path}/old", buckets=1)
    write_tree(old.filter("txn_id = 't1'"), f"{tmp_path}/new", buckets=1)
    found = tree_diff(spark, f"{tmp_path}/old", f"{tmp_path}/new", buckets=1)
    assert rows(found) == rows(snapshot_diff(old, old.filter("txn_id = 't1'")))


@pytest.mark.parametrize("rows_of_cell, most", [(1, 1 << 20), (1, 128), (64, 1 << 20)])
def test_only_cells_that_differ_are_compared_row_by_row(spark, trees, monkeypatch, rows_of_cell, most):
    monkeypatch.setattr(hashtree, "CELL_ROWS", rows_of_cell)
    monkeypatch.setattr(hashtree, "MOST_CELLS", most)
    compared = []
    real = hashtree.snapshot_diff
    monkeypatch.setattr(hashtree, "snapshot_diff",
                        lambda old, new, *names: compared.append(old.count()) or real(old, new, *names))
    old = snapshot(spark)
    found = tree_diff(spark, f"{trees}/old", f"{trees}/new", buckets=BUCKETS)
    assert rows(found) == rows(snapshot_diff(old, changed(old)))
    in_buckets = hashtree._rows_of(
        spark, f"{trees}/old",
        differing_buckets(spark, f"{trees}/old", f"{trees}/new", BUCKETS), "txn_id", "amount")
    assert len(compared) == 1 and compared[0] < in_buckets.count() or rows_of_cell == 64
