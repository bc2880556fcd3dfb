"""The monthly refresh: check what was carried over, append what is new, renew the marts.

A refresh is one change of a ``Store``: rows, ids, fingerprints and totals of the date and the
marts are published together. What a date added is kept as sums, so a refresh reads of the store
only its ids, where they lie, and these sums.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obligo.operators.enrich import Dimensions
from obligo.operators.joins import measured_bytes
from obligo.operators.snapshots import (
    KEY,
    compare_fingerprints,
    fingerprint_together,
    fingerprint_without,
    rows_of_keys,
    snapshot_fingerprint,
    unknown_keys,
)
from obligo.operators.totals import added_totals, seat_totals
from obligo.plans.marts import MARTS, marts_of
from obligo.session import SHUFFLE_TASK_BYTES
from obligo.sinks.store import DATE, Change, Part, Store
from obligo.sinks.tables import stored, write_snapshot
from obligo.sources.transactions import clean_contracts

TRANSACTIONS, IDS, TOTALS = "transactions", "ids", "seat_totals"


def refresh(spark: SparkSession, root: str, dump: DataFrame, snapshot_date: str,
            dims: Dimensions, by: list[str] | None = None) -> DataFrame:
    """Takes a new dump of projected contracts into the store under ``root``.

    Returns the comparison of the carried-over rows with what the store held. The ids of the dump
    meet those of the store, which are kept in buckets and not moved; the rows of the new ids are
    what is added. What was carried over is known from the fingerprints of the dump and of the new
    rows, what the store held from those kept with each date. The marts are made of the seat
    totals kept with each date and those of the new rows, so earlier transactions are not read.

    All is published at once, or nothing: a run that stops leaves the store as it was. Running the
    newest date again replaces what that run published, so the outcome is the same. A date before
    the newest is refused: what later dumps added and reported rests on what was there before
    them. So is a row without an id, which could not be told from one that is there already.
    """
    store = Store(spark, root)
    dates = store.state().dates(TRANSACTIONS)
    if dates and snapshot_date < dates[-1]:
        raise ValueError(f"the store already holds {dates[-1]}, later than {snapshot_date}")
    earlier = [d for d in dates if d < snapshot_date]
    missing = F.raise_error(F.lit("a transaction without an id"))
    dump = dump.withColumn(KEY, F.coalesce(F.col(KEY), missing.cast("string")))
    prints = f"fingerprints-{'-'.join(by or ['all'])}"
    with store.change(snapshot_date) as change:
        known = known_ids(change, earlier)
        ids = unknown_keys(dump, known)
        if earlier:
            ids = stored(spark, ids, "new-ids")
            change.write(TRANSACTIONS, rows_of_keys(dump, ids))
            change.write(IDS, ids, key=KEY, buckets=_buckets(change, earlier, ids))
        else:
            change.write(TRANSACTIONS, dump, as_dealt=True)
            _write_first_ids(change, ids, change.rows(TRANSACTIONS, [snapshot_date]), snapshot_date)
        added = change.rows(TRANSACTIONS, [snapshot_date]).drop(DATE)
        change.write(prints, snapshot_fingerprint(added, by))
        own = change.rows(prints, [snapshot_date]).drop(DATE)
        held = _held(change, prints, earlier, by, dump)
        carried = fingerprint_without(snapshot_fingerprint(dump, by), own, by)
        report = stored(spark, compare_fingerprints(held, carried, by), "comparison")
        totals = stored(spark, current_totals(change, dims, [*earlier, snapshot_date]), TOTALS)
        _side_by_side(lambda name, df: change.write(name, df), marts_of(totals, dims))
    return report


def _ids_of(change: Change, date: str) -> tuple[Part, str]:
    """The bucketed ids of a date; taken from its rows where they were not kept."""
    part = change.state().tables.get(IDS, {}).get(date)
    rows = change.rows(TRANSACTIONS, [date]).select(KEY)
    schema = f"{KEY} {rows.schema[KEY].dataType.simpleString()}"
    if part is None:
        part = _write_first_ids(change, rows.distinct(), rows, date)
    return part, schema


def _write_first_ids(change: Change, ids: DataFrame, rows: DataFrame, date: str) -> Part:
    """Writes distinct ids as they leave the shuffle that made them distinct."""
    return change.write(IDS, ids, date, key=KEY, buckets=_buckets(change, [], rows.select(KEY)),
                        as_dealt=True)


def known_ids(change: Change, dates: list[str]) -> list[DataFrame]:
    """The ids that earlier dates added, one bucketed table per date."""
    return [change.store.bucketed(*_ids_of(change, d), KEY) for d in dates]


def _buckets(change: Change, earlier: list[str], ids: DataFrame) -> int:
    """As many buckets as the store has; for its first ids as many as a task's bytes ask for.

    Then a multiple of the partitions Spark shuffles to, so that distinct ids, by whose hash both
    are formed, need no second exchange: every bucket lies in one partition.
    """
    kept = change.state().tables.get(IDS, {})
    for date in earlier:
        if date in kept:
            return kept[date].buckets
    least = int(change.store.spark.conf.get("spark.sql.shuffle.partitions"))
    return least * max(1, -(-measured_bytes(ids) // (SHUFFLE_TASK_BYTES * least)))


def _held(change: Change, prints: str, dates: list[str], by: list[str] | None,
          dump: DataFrame) -> DataFrame:
    """Fingerprint of the store: of what was kept, or of its rows where a date has none."""
    if not dates:
        return snapshot_fingerprint(dump.limit(0), by)
    if set(dates) <= set(change.state().dates(prints)):
        return fingerprint_together(change.rows(prints, dates).drop(DATE), by)
    return snapshot_fingerprint(change.rows(TRANSACTIONS, dates).drop(DATE), by)


def _basis(dims: Dimensions) -> str:
    """What seat totals depend on beside the rows of their date: the states, for the ratios."""
    states = dims.states.df
    row = states.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*sorted(states.columns)).cast("decimal(38,0)")).alias("h")).first()
    return f"states {row['n']} {row['h']}"


def current_totals(change: Change, dims: Dimensions, dates: list[str]) -> DataFrame:
    """Seat totals of all rows of the store: those kept with each date, added up.

    A date's totals are kept with the state they rest on, and taken from its rows again where
    there are none or the states are others now.
    """
    basis = _basis(dims)
    for date in dates:
        part = change.state().tables.get(TOTALS, {}).get(date)
        if part is None or part.basis != basis:
            contracts = clean_contracts(change.rows(TRANSACTIONS, [date]).drop(DATE))
            change.write(TOTALS, seat_totals(contracts, ratios_from=dims.states), date, basis)
    return added_totals(change.rows(TOTALS, dates).drop(DATE))


def _side_by_side(write, marts: dict[str, DataFrame]) -> None:
    """Writes the marts at the same time: each alone would leave most of a cluster idle."""
    with ThreadPoolExecutor(len(marts)) as pool:
        list(pool.map(lambda name: write(name, marts[name]), marts))


def publish_marts(marts: dict[str, DataFrame], root: str, snapshot_date: str) -> None:
    """Writes dated marts to plain folders."""
    _side_by_side(lambda name, df: write_snapshot(df, f"{root}/{name}", snapshot_date), marts)


def register_views(spark: SparkSession, root: str) -> None:
    """Makes the latest marts of a store queryable in SQL under their published names."""
    store = Store(spark, root)
    for name in MARTS:
        store.latest(name).createOrReplaceTempView(name)
