from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from obligo.operators import snapshots as S

from conftest import plan, rows

SCHEMA = "txn_id string, amount decimal(18,2), state string"


def frame(spark, *made):
    return spark.createDataFrame(
        [(k, None if a is None else Decimal(a), s) for k, a, s in made], SCHEMA)


@pytest.fixture(scope="module")
def old(spark):
    return frame(spark, *[(f"t{i}", f"{i}.50", f"S{i % 5}") for i in range(300)],
                 ("null", None, "S0"), ("nogroup", "1.00", None))


@pytest.fixture(scope="module")
def new(spark):
    kept = [(f"t{i}", f"{i}.50" if i % 50 else f"{i}.75", f"S{i % 5}")
            for i in range(300) if i % 60 != 7]
    return frame(spark, *kept, ("null", "0.00", "S0"), ("nogroup", "2.00", None),
                 ("added", "9.00", "S9"), ("added null", None, None))


def brute_force(old, new):
    """Bags of amounts per key, compared in plain Python."""
    bags = [defaultdict(list), defaultdict(list)]
    for bag, df in zip(bags, (old, new)):
        for r in df.collect():
            bag[r.txn_id].append(r.amount)

    def total(values):
        known = [v for v in values if v is not None]
        return sum(known) if known else None

    out = []
    for key in set(bags[0]) | set(bags[1]):
        before, after = bags[0].get(key), bags[1].get(key)
        if before is None or after is None:
            status = "new" if before is None else "missing"
        elif sorted(map(str, before)) != sorted(map(str, after)):
            status = "changed"
        else:
            continue
        out.append((key, total(before or []), total(after or []), status))
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


def test_diff(old, new):
    got = rows(S.snapshot_diff(old, new))
    assert got == brute_force(old, new)
    assert {r[3] for r in got} == {"new", "missing", "changed"}


def test_equal_snapshots_do_not_differ(old):
    assert S.snapshot_diff(old, old.repartition(3)).isEmpty()
    assert S.localized_diff(old, old.repartition(3), ["state"]).isEmpty()


def test_diff_of_repeated_keys_compares_bags(spark):
    old = frame(spark, *[("hot", "2.00", "S")] * 500, ("a", "1.00", "S"), ("a", "4.00", "S"),
                ("b", "1.00", "S"), ("b", "1.00", "S"), ("c", "2.00", "S"), ("c", "2.00", "S"))
    new = frame(spark, *[("hot", "2.00", "S")] * 500, ("a", "2.00", "S"), ("a", "3.00", "S"),
                ("b", "1.00", "S"), ("c", "2.00", "S"), ("c", "2.00", "S"))
    got = S.snapshot_diff(old, new)
    assert rows(got) == brute_force(old, new)
    assert [r[0] for r in rows(got)] == ["a", "b"]
    assert "Join" not in plan(got)


def test_new_and_carried_over_rows_split_the_new_snapshot(old, new):
    known = {r.txn_id for r in old.collect()}
    added, kept = S.new_rows(old, new), S.carry_over(old, new)
    assert {r.txn_id for r in added.collect()} == {"added", "added null"}
    assert all(r.txn_id in known for r in kept.collect())
    assert added.count() + kept.count() == new.count()
    assert rows(added.union(kept)) == rows(new)


@pytest.mark.parametrize("find,count", [(S.new_rows, 4000), (S.carry_over, 8000)])
def test_key_hot_on_both_sides_is_split(spark, find, count):
    """Half of all rows share one key. No task may take them all, in either direction."""
    shape = ("CASE WHEN id % 2 = 0 THEN 'hot' ELSE 't' || id END AS txn_id", "id AS amount",
             "uuid() AS filler")
    new = spark.range(0, 12000, 1, 8).selectExpr(*shape)
    old = spark.range(0, 4000, 1, 8).selectExpr(*shape)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = find(old, new)
        sizes = [r[1] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        per_task = found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        assert found.count() == sum(per_task) == count and sizes
        assert max(per_task) < 3000
        assert "skew=true" in plan(found)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rows_without_a_key_are_never_known(old, new):
    nameless = new.withColumn("txn_id", F.lit(None).cast("string")).limit(3)
    assert S.new_rows(old.unionByName(nameless), nameless).count() == 3


def test_append_keeps_old_rows_as_they_were(old, new):
    both = S.append_new(old, new)
    assert both.count() == old.count() + 2
    assert both.filter("txn_id = 'nogroup'").first().amount == Decimal("1.00")
    assert rows(S.append_new(both, new)) == rows(both)


@pytest.mark.parametrize("algo", ["xxhash64", "murmur3", "md5"])
def test_compare(old, new, algo):
    assert S.compare_snapshots(old, new, algo=algo).first().status == "changed"
    grown = old.unionByName(new.filter("txn_id like 'added%'"))
    same = S.compare_snapshots(old, grown, algo=algo).first()
    assert same.status == "same" and same.old_n_rows == old.count()


def test_compare_by_group_finds_where(old, new):
    by = {r.state: r.status for r in S.compare_snapshots(old, new, ["state"]).collect()}
    changed = {r.state for r in old.join(S.snapshot_diff(old, new).filter("status <> 'new'"),
                                         "txn_id", "left_semi").collect()}
    assert {k for k, v in by.items() if v == "changed"} == changed
    assert set(by.values()) == {"same", "changed"}


@pytest.mark.parametrize("limit", [50_000_000, -1])
def test_localized_diff_equals_the_full_diff(old, new, limit):
    assert rows(S.localized_diff(old, new, ["state"], limit=limit)) == rows(
        S.snapshot_diff(old, new))


@pytest.mark.parametrize("limit", [50_000_000, -1])
def test_localized_diff_compares_an_id_in_several_groups_as_a_whole(spark, limit):
    old = frame(spark, ("k", "5.00", "A"), ("k", "3.00", "B"), ("m", "5.00", "A"),
                ("m", "3.00", "B"), ("same", "1.00", "A"), ("same", "1.00", "B"))
    new = frame(spark, ("k", "5.00", "A"), ("k", "4.00", "B"), ("m", "5.00", "A"),
                ("same", "1.00", "A"), ("same", "1.00", "B"))
    got = S.localized_diff(old, new, ["state"], limit=limit)
    assert rows(got) == rows(S.snapshot_diff(old, new))
    assert [(r[0], r[3]) for r in rows(got)] == [("k", "changed"), ("m", "changed")]


def test_localized_diff_takes_kept_fingerprints(spark, old):
    changed = old.withColumn("amount", F.when(F.col("state") == "S1", F.col("amount") + 1)
                             .otherwise(F.col("amount")).cast("decimal(18,2)"))
    kept = S.snapshot_fingerprint(old, ["state"])
    got = S.localized_diff(old, changed, ["state"], old_prints=kept)
    assert rows(got) == rows(S.snapshot_diff(old, changed)) != []
    assert "BroadcastHashJoin" in plan(got)
    by_join = S.localized_diff(old, changed, ["state"], old_prints=kept, limit=-1)
    assert rows(by_join) == rows(got)


def test_row_that_moves_to_another_group_is_not_a_change(spark):
    old = frame(spark, ("a", "1.00", "S1"), ("b", "1.00", "S2"))
    new = frame(spark, ("a", "1.00", None), ("b", "1.00", "S2"))
    assert S.localized_diff(old, new, ["state"]).isEmpty()


@pytest.mark.parametrize("by", [None, ["state"]])
def test_fingerprint_of_what_was_carried_over_needs_no_join(old, new, by):
    added = S.new_rows(old, new)
    got = S.fingerprint_without(
        S.snapshot_fingerprint(new, by), S.snapshot_fingerprint(added, by), by)
    assert rows(got) == rows(S.snapshot_fingerprint(S.carry_over(old, new), by))
    assert "Join" not in plan(S.snapshot_fingerprint(new, by))


def test_semi_and_anti_joins_shuffle_each_side_once(old, new):
    text = plan(S.new_rows(old.repartition(2), new.repartition(2)).select("txn_id"))
    assert "Cartesian" not in text and "BroadcastNestedLoop" not in text


def test_beyond_the_broadcast_only_rows_that_may_be_listed_are_shuffled(old, new):
    keys = S.distinct_keys(new.filter("txn_id LIKE 't1%'"))
    found = S.rows_of_keys(old, keys, limit=-1)
    assert rows(found) == rows(old.join(keys, "txn_id", "left_semi")) != []
    for df in (found, S.localized_diff(old, new, ["state"], limit=-1)):
        assert "bitmap" in plan(df).lower()
    joins = [line.lower() for line in plan(found).splitlines() if "LeftSemi" in line]
    assert ["bitmap" in line for line in joins][:2] == [False, True]  # the upper join comes first
