import pytest

from obligo.sinks import store as stores
from obligo.sinks.store import ConcurrentChange, Store
from obligo.sinks.tables import write_snapshot

from conftest import plan, rows


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def held(store, table="a"):
    found = store.rows(table)
    return [] if found is None else [(r.snapshot_date, r.n) for r in found.orderBy("snapshot_date", "n").collect()]


def test_a_change_is_published_as_a_whole(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.rows("a") is None and store.state().version == 0
    with store.change("2020-01") as change:
        change.write("a", numbers(spark, 1, 2))
        change.write("b", numbers(spark, 3))
        assert held(store) == []  # nobody sees it yet
        assert change.rows("a").count() == 2
    assert held(store) == [("2020-01", 1), ("2020-01", 2)] and held(store, "b") == [("2020-01", 3)]
    assert store.damaged() == []


def test_a_stopped_change_leaves_the_state_before_it(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    with store.change("2020-01") as change:
        change.write("a", numbers(spark, 1))
    with pytest.raises(KeyError), store.change("2020-01") as change:
        change.write("a", numbers(spark, 9))
        raise KeyError
    assert held(store) == [("2020-01", 1)]
    with store.change("2020-02") as change:
        change.write("a", numbers(spark, 2))
    folders = {p.parent.name for p in tmp_path.glob("a/*/*/*.parquet")}
    assert len(folders) == 2  # what the stopped change wrote is gone


def test_replacing_a_date_replaces_all_its_tables_and_keeps_one_version(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for value in (1, 2, 3):
        with store.change("2020-01") as change:
            change.write("a", numbers(spark, value))
            if value == 1:
                change.write("b", numbers(spark, value))
    assert held(store) == [("2020-01", 3)] and held(store, "b") == []
    assert store.versions() == [2, 3]
    assert [r.n for r in store.rows("a", state=store.state(2)).collect()] == [2]
    assert not list(tmp_path.glob("b/*/*"))


def test_the_second_of_two_changes_fails(spark, tmp_path):
    one, other = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    with pytest.raises(ConcurrentChange), one.change("2020-01") as change:
        change.write("a", numbers(spark, 1))
        with other.change("2020-02") as faster:
            faster.write("a", numbers(spark, 2))
    assert held(one) == [("2020-02", 2)]


def test_dated_folders_without_commits_are_taken_over(spark, tmp_path):
    write_snapshot(numbers(spark, 1), f"{tmp_path}/a", "2020-01")
    store = Store(spark, str(tmp_path))
    assert held(store) == [("2020-01", 1)]
    with store.change("2020-02") as change:
        change.write("a", numbers(spark, 2))
    assert held(store) == [("2020-01", 1), ("2020-02", 2)]
    for _ in range(2):
        with store.change("2020-01") as change:
            change.write("a", numbers(spark, 5))
    assert held(store) == [("2020-01", 5), ("2020-02", 2)]
    write_snapshot(numbers(spark, 7), f"{tmp_path}/other", "2020-01")
    store.clean()
    assert (tmp_path / "other" / "snapshot_date=2020-01").exists()


def test_a_lost_file_is_found(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    with store.change("2020-01") as change:
        part = change.write("a", numbers(spark, *range(100)))
    next(tmp_path.glob("a/*/*/*.parquet")).unlink()
    assert store.damaged() == [part.folder]


def test_buckets_are_read_without_an_exchange(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    with store.change("2020-01") as change:
        part = change.write("a", numbers(spark, *range(100)), key="n", buckets=8)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("obligo_")]
    found = store.bucketed(part, "n int", "n").groupBy("n").count()
    assert "Exchange" not in plan(found) and found.count() == 100


def test_latest_opens_one_date(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for date, value in (("2020-01", 1), ("2020-02", 2)):
        with store.change(date) as change:
            change.write("a", numbers(spark, value))
    newest = store.latest("a")
    assert rows(newest) == [(2, "2020-02")]
    assert all("2020-02" in f for f in newest.inputFiles())
    assert stores.COMMITS in {p.name for p in tmp_path.iterdir()}


def test_large_rows_are_written_without_another_exchange(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    dealt = []
    real = stores.DataFrame.repartition
    monkeypatch.setattr(stores.DataFrame, "repartition",
                        lambda self, *a: dealt.append(a) or real(self, *a))
    ids = spark.range(4000).selectExpr("'t' || id % 1000 AS n").distinct()
    with store.change("2020-01") as change:
        part = change.write("ids", ids, key="n", buckets=16, as_dealt=True)
        even = change.write("even", spark.range(0, 1000, 1, 8), as_dealt=True)
        uneven = change.write("uneven", spark.range(0, 1000, 1, 8).filter("id < 9 OR id > 600"),
                              as_dealt=True)
        assert change.rows("ids").count() == 1000 and part.buckets == 16
        assert len(list((tmp_path / part.folder).glob("*.parquet"))) <= 16
        assert len(list((tmp_path / even.folder).glob("*.parquet"))) == 8
        assert change.rows("uneven").count() == 408
    assert not dealt and store.damaged() == []
    assert len(list((tmp_path / uneven.folder).parent.iterdir())) == 1
