import pytest
from pyspark.sql import functions as F

import world
from obligo.operators import snapshots as S
from obligo.plans import marts
from obligo.operators.enrich import Dimensions
from obligo.operators.totals import seat_totals
from obligo.plans.refresh import current_totals, known_ids, refresh
from obligo.sinks.store import Change, Store
from obligo.sinks.tables import write_snapshot
from obligo.sources.transactions import clean_contracts

from conftest import plan, rows


def projected(spark, facts):
    """Cleaned rows as they would be delivered: years and districts as text."""
    return facts.selectExpr(
        "txn_id", "CAST(year AS STRING) || '-01-02' AS year", "amount", "state",
        "lpad(CAST(district AS STRING), 2, '0') AS district", "code || '30' AS code",
        "'USA' AS country_code")


@pytest.fixture(scope="module")
def dumps(spark):
    january = projected(spark, world.contracts(spark, 300)).cache()
    more = projected(spark, world.contracts(spark, 330, seed=2)).filter(
        "CAST(substr(txn_id, 2) AS INT) >= 300")
    return january, january.unionByName(more).cache()


def test_refresh_end_to_end_and_again(spark, dumps, tmp_path):
    january, february = dumps
    root, dims = str(tmp_path), world.dims(spark)
    first = refresh(spark, root, january, "2020-01-05", dims)
    assert [r.status for r in first.collect()] == ["same"]
    second = refresh(spark, root, february, "2020-02-05", dims)
    assert [(r.status, r.old_n_rows, r.new_n_rows) for r in second.collect()] == [
        ("same", 300, 300)]

    def state():
        return {name: rows(Store(spark, root).rows(name))
                for name in ["transactions", *marts.MARTS]}

    before = state()
    assert len(before["transactions"]) == 330
    for name in marts.MARTS:
        newest = Store(spark, root).latest(name)
        assert {r.snapshot_date for r in newest.collect()} <= {"2020-02-05"}
        expected = marts.mart(name, clean_contracts(february), dims)
        assert rows(newest.drop("snapshot_date")) == rows(expected), name

    refresh(spark, root, february, "2020-02-05", dims)
    assert state() == before


def test_refresh_reports_a_changed_amount_and_keeps_the_old_one(spark, dumps, tmp_path):
    january, february = dumps
    root, dims = str(tmp_path), world.dims(spark)
    refresh(spark, root, january, "2020-01-05", dims)
    target = january.filter("amount is not null and state = 'AA'").first().txn_id
    edited = february.withColumn(
        "amount",
        F.when(F.col("txn_id") == target, F.col("amount") + 1)
        .otherwise(F.col("amount"))
        .cast("decimal(18,2)"),
    )
    report = refresh(spark, root, edited, "2020-02-05", dims, ["state"])
    assert {r.state for r in report.collect() if r.status == "changed"} == {"AA"}
    kept = Store(spark, root).rows("transactions").filter(
        "snapshot_date = '2020-01-05'").drop("snapshot_date")
    assert S.snapshot_diff(january, kept).isEmpty()


def test_kept_fingerprints_are_those_of_the_store(spark, dumps, tmp_path):
    january, february = dumps
    root, dims = str(tmp_path), world.dims(spark)
    for by in (None, ["state"]):
        for date, dump in (("2020-01-05", january), ("2020-02-05", february)):
            refresh(spark, f"{root}/{len(by or [])}", dump, date, dims, by)
        name = "-".join(by or ["all"])
        folder = f"{root}/{len(by or [])}"
        kept = Store(spark, folder).rows(f"fingerprints-{name}").drop("snapshot_date")
        store = Store(spark, folder).rows("transactions")
        assert rows(S.fingerprint_together(kept, by)) == rows(S.snapshot_fingerprint(store, by))
    # Another grain than before: fingerprints are taken of the rows.
    report = refresh(spark, f"{root}/0", february, "2020-02-05", dims, ["state"])
    assert {r.status for r in report.collect()} == {"same"}


def test_an_earlier_date_is_refused(spark, dumps, tmp_path):
    january, february = dumps
    root, dims = str(tmp_path), world.dims(spark)
    refresh(spark, root, january, "2020-01-05", dims)
    refresh(spark, root, february, "2020-02-05", dims)
    before = rows(Store(spark, root).rows("transactions"))
    with pytest.raises(ValueError, match="2020-02-05"):
        refresh(spark, root, january, "2020-01-05", dims)
    assert rows(Store(spark, root).rows("transactions")) == before


def test_a_row_without_an_id_is_refused(spark, dumps, tmp_path):
    january, _ = dumps
    nameless = january.withColumn("txn_id", F.when(F.col("txn_id") != "t7", F.col("txn_id")))
    with pytest.raises(Exception, match="a transaction without an id"):
        refresh(spark, str(tmp_path), nameless, "2020-01-05", world.dims(spark))


def test_later_run_with_fewer_rows_replaces_the_snapshot(spark, dumps, tmp_path):
    january, february = dumps
    root, dims = str(tmp_path), world.dims(spark)
    refresh(spark, root, january, "2020-01-05", dims)
    refresh(spark, root, february, "2020-02-05", dims)
    refresh(spark, root, january, "2020-02-05", dims)
    assert Store(spark, root).rows("transactions").count() == 300


class Stopped(Exception):
    pass


def test_a_refresh_that_stops_anywhere_can_be_run_again(spark, dumps, tmp_path, monkeypatch):
    january, february = dumps
    dims, by = world.dims(spark), ["state"]
    # February comes a second time with rows gone and others new, so all that it keeps differs.
    again = february.filter("txn_id NOT IN ('t1', 't310')")

    def run(root, stop_at=None):
        """The refresh, stopped before its write number ``stop_at`` or, at -1, its commit."""
        with monkeypatch.context() as patch:
            written, real = [], Change.write

            def write(self, *args, **options):
                if len(written) == stop_at:
                    raise Stopped
                written.append(args[0])
                return real(self, *args, **options)

            def publish(self, change):
                raise Stopped

            patch.setattr(Change, "write", write)
            if stop_at == -1:
                patch.setattr(Store, "_publish", publish)
            return rows(refresh(spark, root, again, "2020-02-05", dims, by)), len(written)

    def state(root):
        store = Store(spark, root)
        return {t: rows(store.rows(t)) for t in store.state().tables}

    def begun(root):
        refresh(spark, root, january, "2020-01-05", dims, by)
        refresh(spark, root, february, "2020-02-05", dims, by)
        return root

    whole = begun(str(tmp_path / "whole"))
    before = state(whole)
    report, n_writes = run(whole)
    after = state(whole)
    assert after != before and n_writes == 10
    root = begun(str(tmp_path / "stopped"))
    for step in (0, 1, 2, 3, 4, n_writes - 1, -1):
        with pytest.raises(Stopped):
            run(root, step)
        assert state(root) == before, step
    assert run(root)[0] == report and state(root) == after
    third = [rows(refresh(spark, r, february, "2020-03-05", dims, by)) for r in (root, whole)]
    assert third[0] == third[1]


def test_marts_and_ids_need_no_earlier_transactions(spark, dumps, tmp_path):
    january, february = dumps
    root, dims = str(tmp_path), world.dims(spark)
    refresh(spark, root, january, "2020-01-05", dims)
    store = Store(spark, root)
    with store.change("2020-02-05") as change:
        change.write("transactions", february.filter("CAST(substr(txn_id, 2) AS INT) >= 300"))
        totals = current_totals(change, dims, ["2020-01-05", "2020-02-05"])
        assert not [f for f in totals.inputFiles() if "/transactions/" in f]
        want = seat_totals(clean_contracts(february), ratios_from=dims.states)
        assert rows(totals.select(want.columns)) == rows(want)
        found = plan(S.unknown_keys(february, known_ids(change, ["2020-01-05"])))
        assert found.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in found


def test_totals_are_taken_again_where_the_states_are_others(spark, dumps, tmp_path):
    january, february = dumps
    root, dims = str(tmp_path), world.dims(spark)
    refresh(spark, root, january, "2020-01-05", dims)
    grown = world.states(spark).withColumn("population", F.col("population") + 5)
    other = Dimensions.measured(world.labels(spark), grown, world.legislators(spark))
    refresh(spark, root, february, "2020-02-05", other)
    for name in marts.MARTS:
        expected = marts.mart(name, clean_contracts(february), other)
        assert rows(Store(spark, root).latest(name).drop("snapshot_date")) == rows(expected), name


def test_ids_are_taken_from_the_rows_where_a_date_has_none(spark, dumps, tmp_path):
    january, february = dumps
    root, dims = str(tmp_path), world.dims(spark)
    write_snapshot(january, f"{root}/transactions", "2020-01-05")
    report = refresh(spark, root, february, "2020-02-05", dims).collect()
    assert [(r.status, r.old_n_rows, r.new_n_rows) for r in report] == [("same", 300, 300)]
    assert Store(spark, root).rows("transactions").count() == 330
    assert Store(spark, root).state().dates("ids") == ["2020-01-05", "2020-02-05"]
