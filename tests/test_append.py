import pytest
from pyspark.sql import functions as F

from obligo.sinks import append
from obligo.sinks.append import append_chunks, file_target, read_batches

from conftest import rows


class Stopped(Exception):
    pass


@pytest.fixture
def table(spark):
    return spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"))


def test_a_chunk_that_fails_twice_leaves_each_row_once(spark, table, tmp_path):
    path, tries = str(tmp_path / "table"), []
    deliver, swap = file_target(spark, path, "may")

    def failing(chunk_rows, chunk):
        tries.append(chunk)
        if chunk == 4 and tries.count(4) < 3:
            deliver(chunk_rows.limit(5), chunk)  # some rows arrive before it fails
            raise Stopped
        deliver(chunk_rows, chunk)

    for _ in range(2):
        with pytest.raises(Stopped):
            append_chunks(table, str(tmp_path / "ledger"), "may", "k", failing, swap, 8)
        assert not list((tmp_path / "table").glob("batch=*"))
    done = append_chunks(table, str(tmp_path / "ledger"), "may", "k", failing, swap, 8)
    assert done == [4, 5, 6, 7, 8] and tries == [1, 2, 3, 4, 4, 4, 5, 6, 7, 8]
    assert rows(read_batches(spark, path).drop("batch")) == rows(table)


@pytest.mark.parametrize("stop_before", ["stored", "chunk-3", "swapped"])
def test_a_run_that_stops_before_a_note_is_taken_up(spark, table, tmp_path, monkeypatch,
                                                   stop_before):
    path = str(tmp_path / "table")
    real = append.Folders.mark
    target = file_target(spark, path, "may")

    def mark(self, name):
        if name == stop_before:
            raise Stopped
        real(self, name)

    with monkeypatch.context() as patch:
        patch.setattr(append.Folders, "mark", mark)
        with pytest.raises(Stopped):
            append_chunks(table, str(tmp_path / "ledger"), "may", "k", *target, 5)
    append_chunks(table, str(tmp_path / "ledger"), "may", "k", *target, 5)
    assert rows(read_batches(spark, path).drop("batch")) == rows(table)
    assert not (tmp_path / "ledger" / "may" / "rows").exists()


def test_a_batch_is_appended_once_and_others_beside_it(spark, table, tmp_path):
    path, ledger = str(tmp_path / "table"), str(tmp_path / "ledger")
    for batch in ("may", "may", "june"):
        append_chunks(table, ledger, batch, "k", *file_target(spark, path, batch), 3)
    counts = {r.batch: r["count"] for r in read_batches(spark, path).groupBy("batch").count()
              .collect()}
    assert counts == {"may": 500, "june": 500}


def test_later_tries_deliver_what_was_stored_first(spark, table, tmp_path):
    path, ledger = str(tmp_path / "table"), str(tmp_path / "ledger")
    deliver, swap = file_target(spark, path, "may")

    def stop(rows, chunk):
        raise Stopped

    with pytest.raises(Stopped):
        append_chunks(table, ledger, "may", "k", stop, swap, 3)
    append_chunks(table.filter("v < 5"), ledger, "may", "k", deliver, swap, 3)
    assert read_batches(spark, path).count() == 500


def test_an_empty_batch(spark, table, tmp_path):
    target = file_target(spark, str(tmp_path / "table"), "may")
    assert append_chunks(table.limit(0), str(tmp_path / "l"), "may", "k", *target, 2) == [1, 2]
    assert append_chunks(table.limit(0), str(tmp_path / "l"), "may", "k", *target, 2) == []
