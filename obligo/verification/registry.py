"""The registered queries: each runs a library function over the derived source tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obligo.functions import clean
from obligo.functions.keys import bucket, hash_number, natural_key
from obligo.operators import (
    enrich,
    hashtree,
    intervals,
    migration,
    snapshots,
    terms,
    totals,
)
from obligo.operators.numbering import dense_numbers
from obligo.plans import marts, serving
from obligo.plans.copy import copy_tables
from obligo.plans.refresh import TRANSACTIONS, refresh
from obligo.session import scratch_folder
from obligo.sinks import append, tables
from obligo.sinks.store import Store
from obligo.sinks.tables import stored
from obligo.sources import catalogue
from obligo.sources.dimensions import group_labels, industry_labels, state_demographics
from obligo.sources.legislators import read_legislators
from obligo.sources.relational import equal_depth_bounds, range_predicates
from obligo.sources.transactions import project_contracts, project_grants
from obligo.verification.fixtures import ROSTER_MIN_START, SEAT_MIN_START, Source, source

# Parameters of the registered queries.
INDUSTRY = "Industry 07"
AFTER = "1998"
CHUNKS = 100
ROWS_PER_CHUNK = 1000
DOCUMENTS_PER_FILE = 5000
COPY_PIECES = 8
COPY_CELLS = 4096
TREE_BUCKETS = 256
TERM_YEARS = 4
JANUARY, FEBRUARY = "2020-01-05", "2020-02-05"

# What the catalogue of the test tables would say: key columns and constraint type per table.
# The supplier table has no key, the key of events is no primary key, recent_orders is a view.
KEYS = {
    "nation": (["n_nationkey"], "PRIMARY KEY"),
    "customer": (["c_custkey"], "PRIMARY KEY"),
    "part": (["p_partkey"], "PRIMARY KEY"),
    "orders": (["o_orderkey"], "PRIMARY KEY"),
    "lineitem": (["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "PRIMARY KEY"),
    "events": (["event_id"], "UNIQUE"),
}
TABLES = [*KEYS, "supplier"]


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, at the very end, so that results compare across engines."""
    return df.select(
        *[
            F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else f.name
            for f in df.schema.fields
        ]
    )


def texts(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def keyed(df: DataFrame) -> DataFrame:
    """Year and district as the text they are published as."""
    return texts(df, "year", "district")


def prints(df: DataFrame) -> DataFrame:
    return texts(df, *[c for c in df.columns if c.endswith(("hash_sum", "hash_xor"))])


# -- sources that need more than one call -------------------------------------------------


def roster_files(s: Source) -> str:
    """The roster as files that each hold one JSON array.

    Documents fall into buckets of bounded size by a hash; each bucket is one array and file.
    """

    def make() -> str:
        path = f"{scratch_folder(s.spark)}/roster-{uuid4().hex}"
        documents = s.roster()[0].unionByName(s.roster()[1]).select(
            F.to_json(F.struct("name", "terms")).alias("document"))
        buckets = -(-documents.count() // DOCUMENTS_PER_FILE) or 1
        arrays = documents.groupBy(bucket(F.col("document"), buckets).alias("bucket")).agg(
            F.concat(F.lit("["), F.array_join(F.collect_list("document"), ","), F.lit("]"))
            .alias("value"))
        arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
        return path

    return s.once("roster files", make)


def json_scan(s: Source) -> DataFrame:
    return terms.flatten_terms(read_legislators(s.spark, roster_files(s)))


def json_split_scan(s: Source) -> DataFrame:
    """The same arrays, each read by as many tasks as it has splits."""
    return terms.flatten_terms(
        read_legislators(s.spark, roster_files(s), split_arrays=True))


def catalogue_of(s: Source) -> dict[str, DataFrame]:
    """Catalogue relations of the test tables; the row counts come from the tables."""
    relations = {
        "information_schema.tables": s.spark.createDataFrame(
            [("public", t, "BASE TABLE") for t in TABLES] + [("public", "recent_orders", "VIEW")],
            "table_schema string, table_name string, table_type string",
        ),
        "information_schema.key_column_usage": s.spark.createDataFrame(
            [(t, c, f"{t}_key") for t, (columns, _) in KEYS.items() for c in columns],
            "table_name string, column_name string, constraint_name string",
        ),
        "information_schema.table_constraints": s.spark.createDataFrame(
            [(f"{t}_key", kind) for t, (_, kind) in KEYS.items()],
            "constraint_name string, constraint_type string",
        ),
        "estimates": catalogue.counted_rows({t: s.table(t) for t in TABLES}),
    }
    read = relations.__getitem__
    return {
        "tables": catalogue.base_tables(read),
        "keys": catalogue.key_columns(read),
        "constraints": catalogue.constraints(read),
        "estimates": catalogue.row_estimates(read, "estimates"),
    }


def migration_plan(s: Source) -> DataFrame:
    plan = migration.migration_plan(**catalogue_of(s), rows_per_chunk=ROWS_PER_CHUNK)
    return plan.withColumn("pkey", F.array_join("pkey", ","))


def refreshed_store(s: Source) -> str:
    """A store that has taken a first dump and the one of the following month.

    The first dump came again out of order and was refused, the second came twice.
    """

    def make() -> str:
        root = f"{scratch_folder(s.spark)}/store-{uuid4().hex}"
        refresh(s.spark, root, s.old_snapshot(), JANUARY, s.dims())
        refresh(s.spark, root, s.new_snapshot(), FEBRUARY, s.dims())
        try:
            refresh(s.spark, root, s.old_snapshot(), JANUARY, s.dims())
        except ValueError:
            refresh(s.spark, root, s.new_snapshot(), FEBRUARY, s.dims())
        return root

    return s.once("store", make)


def localized_diff(s: Source) -> DataFrame:
    """Compares snapshots that differ in one state, with the old one's kept fingerprints."""
    old, new, prints = s.local_snapshots()
    return snapshots.localized_diff(old, new, ["state"], old_prints=prints)


def copy_of(s: Source, sources: dict[str, DataFrame]) -> str:
    """A folder with the tables after two copies from Parquet to Parquet.

    What the plan lists beside them is left out by the list of tables to copy.
    """
    root = f"{scratch_folder(s.spark)}/copy-{uuid4().hex}"
    plan = migration.migration_plan(**catalogue_of(s), rows_per_chunk=ROWS_PER_CHUNK)

    def read(name: str, key: list[str], pieces: int) -> DataFrame:
        return sources[name].coalesce(pieces)

    def write(df: DataFrame, name: str, chunks: int, key: list[str]) -> None:
        tables.write_files(df, f"{root}/{name}", "overwrite")

    for _ in range(2):
        copy_tables(plan, read, write, only=list(sources), partitions=COPY_PIECES)
    return root


def copied_table(s: Source) -> DataFrame:
    """Line items with all their columns and one that is named like a chunk, copied."""
    source = s.table("lineitem").withColumn("chunk", F.col("l_orderkey") % 7)
    copied = s.spark.read.parquet(f"{copy_of(s, {'lineitem': source})}/lineitem")
    assert copied.dtypes == source.dtypes
    return copied.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))


def compared_copy(source: DataFrame, copied: DataFrame) -> DataFrame:
    """Rows of a copy, and how many differ from the source or are there more or less often.

    Rows fall into cells by a hash of all their values. A cell's count and hash sum are added up
    where the rows are read; only rows of cells in which the two sides differ are compared one by
    one.
    """
    both = source.withColumn("_side", F.lit(1)).unionByName(copied.withColumn("_side", F.lit(-1)))
    # A null leaves the hash as it is, so it also says which values are missing.
    row = F.xxhash64(*source.columns, *[F.col(c).isNull() for c in source.columns])
    cell, h = F.pmod(row, F.lit(COPY_CELLS)), row.cast("decimal(20,0)")
    cells = stored(source.sparkSession, both.groupBy(cell.alias("cell")).agg(
        F.sum("_side").alias("d"), F.count(F.when(F.col("_side") < 0, 1)).alias("n"),
        F.sum(F.when(F.col("_side") < 0, -h).otherwise(h)).alias("h")), "cells")
    differing = [r["cell"] for r in cells.filter("d <> 0 OR h <> 0").select("cell").collect()]
    rows = both.filter(cell.isin(differing)).groupBy(*source.columns).agg(
        F.sum("_side").alias("d"))
    none = F.lit(0).cast("long")
    return cells.select("n", none.alias("differs")).unionByName(
        rows.select(none.alias("n"), F.abs("d").alias("differs"))).agg(
        F.sum("n").alias("n_rows"), F.sum("differs").alias("n_differing"))


def copied_tables(s: Source) -> DataFrame:
    """Every table with a primary key, copied: rows, columns, and rows that differ from the source."""
    names = [t for t, (_, kind) in KEYS.items() if kind == "PRIMARY KEY"]
    root = copy_of(s, {t: s.table(t) for t in names})
    union = None
    for name in names:
        source, copied = s.table(name), s.spark.read.parquet(f"{root}/{name}")
        part = compared_copy(source, copied).select(
            F.lit(name).alias("table_name"), "n_rows",
            F.lit(len(copied.columns)).alias("n_columns"), "n_differing")
        union = part if union is None else union.unionByName(part)
    return union


def equal_depth_pieces(s: Source) -> DataFrame:
    """Orders whose numbers have gaps, split at quantiles: rows, and whether pieces are even."""
    keys = s.table("lineitem").select(
        F.when(F.col("l_orderkey") % 10 == 0, F.col("l_orderkey") * 500)
        .otherwise(F.col("l_orderkey")).alias("id"))
    clauses = range_predicates("id", equal_depth_bounds(keys, "id", COPY_PIECES))
    piece = sum((F.when(F.expr(c), F.lit(i)).otherwise(0) for i, c in enumerate(clauses)), F.lit(0))
    once = sum((F.expr(c).cast("int") for c in clauses), F.lit(0))
    sizes = keys.filter(once == 1).groupBy(piece.alias("piece")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_pieces"),
        (F.max("n") <= 2 * F.avg("n")).alias("even"))


def tree_diff(s: Source) -> DataFrame:
    """Compares snapshots that differ in one state, by the hash trees stored with them."""
    old, new, _ = s.local_snapshots()
    root = f"{scratch_folder(s.spark)}/trees-{uuid4().hex}"
    for name, df in (("old", old), ("new", new)):
        hashtree.write_tree(df, f"{root}/{name}", buckets=TREE_BUCKETS)
    return hashtree.tree_diff(s.spark, f"{root}/old", f"{root}/new", buckets=TREE_BUCKETS)


def totals_by_term(s: Source) -> DataFrame:
    """Seat totals with everybody whose term holds the year, by ranges of years."""
    current, historical = s.seats()
    held = terms.flatten_terms(current).unionByName(
        terms.flatten_terms(historical).filter(F.col("start_year") >= SEAT_MIN_START))
    found = intervals.interval_join(
        totals.seat_totals(s.contracts(), by_industry=False), held, ["state", "district"],
        "year", "start_year", "end_year", TERM_YEARS)
    return texts(found.select("state", "district", "year", "firstname", "lastname", "typeofrep",
                              "party", "amount"), "year", "district")


def appended_batches(s: Source) -> DataFrame:
    """Transactions appended in chunks by runs of which the first two stop at the fourth."""
    root, tries = f"{scratch_folder(s.spark)}/append-{uuid4().hex}", []
    rows = s.projected().select("txn_id", "amount")
    deliver, swap = append.file_target(s.spark, f"{root}/table", "may")

    def failing(chunk_rows: DataFrame, chunk: int) -> None:
        deliver(chunk_rows, chunk)
        tries.append(chunk)
        if chunk == 4 and tries.count(4) < 3:
            raise InterruptedError

    for _ in range(3):
        try:
            append.append_chunks(rows, f"{root}/ledger", "may", "txn_id", failing, swap)
        except InterruptedError:
            continue
    return append.read_batches(s.spark, f"{root}/table").drop("batch")


def latest(s: Source, name: str) -> DataFrame:
    return Store(s.spark, refreshed_store(s)).latest(name)


# -- the queries --------------------------------------------------------------------------


def _mart(name: str, **options) -> Callable[[Source], DataFrame]:
    return lambda s: marts.mart(name, s.contracts(), s.dims(), **options)


_BY_STATE = {"chamber_key": "state", "compat": False}

_QUERIES: dict[str, Callable[[Source], DataFrame]] = {
    # sources
    "project_contracts": lambda s: project_contracts(s.fpds()),
    "project_grants": lambda s: project_grants(s.fabs()),
    "stable_row_id": lambda s: s.table("lineitem")
    .select(
        natural_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    (F.col("l_extendedprice") - 50000).cast("decimal(18,2)")).alias("txn_id")
    )
    .withColumn("row_id", hash_number(F.col("txn_id"), "md5").cast("string")),
    "dense_row_numbers": lambda s: dense_numbers(
        s.table("lineitem").select("l_returnflag", "l_orderkey", "l_linenumber"),
        ["l_orderkey", "l_linenumber"], ["l_returnflag"], "row_no", "n_rows"),
    "naics_labels_all": lambda s: industry_labels(s.naics()),
    "naics_labels_4": lambda s: group_labels(s.naics()),
    "state_dim_2010": lambda s: state_demographics(s.state_data()),
    "legislator_json_scan": json_scan,
    "legislator_json_split": json_split_scan,
    "mart_probe": lambda s: serving.probe(s.stored_mart("legis_by_year_hr")),
    # cleaning
    "clean_year": lambda s: s.fpds()
    .select("action_date", clean.clean_year(F.col("action_date")).alias("year"))
    .distinct(),
    "clean_year_strict": lambda s: s.fpds()
    .select(F.replace("action_date", F.lit("-"), F.lit("")).alias("compact"))
    .select(
        "compact",
        clean.clean_year(F.col("compact")).alias("compat"),
        clean.clean_year(F.col("compact"), "strict").alias("strict"),
    )
    .distinct(),
    "clean_district": lambda s: s.fpds()
    .select(
        F.col("legal_entity_congressional").alias("label"),
        clean.clean_district(F.col("legal_entity_congressional")).alias("district"),
    )
    .distinct(),
    "clean_country": lambda s: s.projected()
    .groupBy("state", clean.clean_country(F.col("country_code")).alias("country_code"))
    .agg(F.count(F.lit(1)).alias("n_rows")),
    "industry_prefix": lambda s: s.projected()
    .groupBy("code", clean.industry_prefix(F.col("code")).alias("industry"))
    .agg(F.count(F.lit(1)).alias("n_rows")),
    # legislators
    "terms_flat": lambda s: terms.flatten_terms(s.roster()[0].unionByName(s.roster()[1])),
    "legislator_years": lambda s: terms.legislator_years(
        s.roster()[0].unionByName(s.roster()[1])
    ),
    "legislator_union": lambda s: terms.legislator_years(*s.roster(), ROSTER_MIN_START),
    # attribution
    "label_preserving_join": lambda s: keyed(
        enrich.labels_with_contracts(s.contracts_full_code(), s.all_labels())
    ),
    "contracts_with_industry": lambda s: keyed(
        enrich.with_industry(s.contracts(), s.dims().labels)
    ),
    "contracts_with_state": lambda s: keyed(enrich.with_state(s.contracts(), s.dims().states)),
    "contracts_with_legislator": lambda s: keyed(
        enrich.with_legislator(s.contracts(), s.dims().legislators)
    ),
    "contracts_with_senator": lambda s: keyed(
        enrich.with_senator(s.contracts(), s.dims().legislators)
    ),
    "grants_with_legislator": lambda s: keyed(
        enrich.with_legislator(
            s.grants().withColumn("district", clean.whole_number(F.col("district"))),
            s.dims().legislators,
        )
    ),
    "govcontract_data": lambda s: enrich.contract_detail(
        s.contracts_full_code(), s.all_labels(), s.dims().legislators
    ),
    "govgrant_data": lambda s: enrich.grant_detail(s.grants(), s.dims().legislators),
    "govgrant_data_dedup": lambda s: enrich.grant_detail(
        s.grants(), s.dims().legislators, dedup=True
    ),
    "enriched_distinct": lambda s: keyed(enrich.enriched(s.contracts(), s.dims(), "rep")),
    # marts
    **{name: _mart(name) for name in marts.MARTS},
    **{
        f"{kind}_by_year_sen_by_state": _mart(f"{kind}_by_year_sen", **_BY_STATE)
        for kind in ("legis", "indus", "state")
    },
    "net_obligation": lambda s: keyed(
        totals.net_obligation(s.contracts(), ["year", "code", "state", "district"])
    ),
    "indus_by_year_roster": lambda s: marts.mart(
        "indus_by_year_hr", s.contracts(), s.roster_dims()
    ),
    "totals_by_term": totals_by_term,
    "overlap_report": lambda s: totals.overlap_report(s.contracts(), s.dims()),
    "mart_with_snapshot": lambda s: tables.with_snapshot(
        s.stored_mart("legis_by_year_hr"), JANUARY
    ),
    # report queries, over stored marts
    "industry_list": lambda s: serving.industry_list(s.stored_mart("legis_by_year_hr")),
    "industry_party_series": lambda s: serving.industry_party_series(
        s.stored_mart("indus_by_year_hr"), INDUSTRY
    ),
    "industry_party_series_all": lambda s: serving.industry_party_series(
        s.stored_mart("indus_by_year_hr")
    ),
    "party_pivot": lambda s: serving.party_pivot(s.stored_mart("indus_by_year_hr")),
    "top_legislators": lambda s: serving.top_legislators(
        s.stored_mart("legis_by_year_hr"), INDUSTRY, AFTER
    ),
    "top_legislators_all": lambda s: serving.top_legislators_all(
        s.stored_mart("legis_by_year_hr"), AFTER
    ),
    # snapshots
    "snapshot_diff": lambda s: snapshots.snapshot_diff(s.old_snapshot(), s.new_snapshot()),
    "snapshot_new_rows": lambda s: snapshots.new_rows(s.old_snapshot(), s.new_snapshot()),
    "snapshot_carryover": lambda s: snapshots.carry_over(s.old_snapshot(), s.new_snapshot()),
    "snapshot_append": lambda s: snapshots.append_new(s.old_snapshot(), s.new_snapshot()),
    "snapshot_fingerprint": lambda s: prints(
        snapshots.snapshot_fingerprint(s.new_snapshot(), algo="md5")
    ),
    "snapshot_compare": lambda s: prints(
        snapshots.compare_snapshots(s.old_snapshot(), s.new_snapshot(), algo="md5")
    ),
    "fingerprint_by_group": lambda s: prints(
        snapshots.snapshot_fingerprint(s.new_snapshot(), ["state", "code"], "md5")
    ),
    "localized_diff": localized_diff,
    "tree_diff": tree_diff,
    "refreshed_mart": lambda s: latest(s, "legis_by_year_hr").drop("snapshot_date"),
    "latest_snapshot": lambda s: latest(s, "state_by_year_hr"),
    "refreshed_transactions": lambda s: Store(s.spark, refreshed_store(s)).rows(TRANSACTIONS)
    .drop("snapshot_date"),
    # copying
    "copied_table": copied_table,
    "copied_tables": copied_tables,
    "appended_batches": appended_batches,
    "equal_depth_pieces": equal_depth_pieces,
    "chunk_assignment": lambda s: tables.assign_chunks(
        s.fpds().select("txn_id"), "txn_id", CHUNKS, "md5"
    ),
    "chunk_row_counts": lambda s: tables.chunk_row_counts(s.fpds(), "txn_id", CHUNKS, "md5"),
    "chunk_plan": lambda s: migration.chunk_plan(catalogue_of(s)["estimates"], ROWS_PER_CHUNK),
    "chunk_plan_from_footers": lambda s: migration.chunk_plan(
        catalogue.footer_estimates(s.spark, {t: s.path(t) for t in TABLES})
        .select("table_name", "approx_cnt"), ROWS_PER_CHUNK),
    "migration_plan": migration_plan,
}


def _registered(run: Callable[[Source], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: as_doubles(run(source(spark, folder)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _registered(run) for name, run in _QUERIES.items()}
