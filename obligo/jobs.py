"""Command line of the jobs, for spark-submit.

    jobs.py contracts --input IN --output OUT
    jobs.py grants    --input IN --output OUT
    jobs.py marts     --input IN --output OUT --date 2020-01-05
    jobs.py refresh   --input IN --output STORE --date 2020-02-05
    jobs.py copy      --output OUT --from SRC [--only state_data overall_totals]

IN holds the source tables as parquet folders (transaction_fpds, transaction_fabs, naics,
state_data) and legislators-current.json and legislators-historical.json. With ``--from PREFIX``
the tables are read over JDBC instead, from the database named by PREFIX_URL, PREFIX_DRIVER,
PREFIX_USER and PREFIX_PASSWORD in the environment. The transactions are then split by ranges of
an indexed number (``--range id 0 72000000``) or, without one, by a hash of their key (``--key``).
``--key`` names the columns that identify a transaction; the id is built from them where the table
has no ``txn_id``. ``--to PREFIX`` writes detail tables, marts and copies to a database instead of
files, ``--lines`` reads legislators from files with a document per line, which Spark can split.

A job leaves nothing behind but its results: its intermediate tables are removed at the end.
"""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from obligo.operators.enrich import Dimensions, contract_detail, grant_detail
from obligo.operators.joins import measure, release
from obligo.operators.migration import migration_plan
from obligo.operators.terms import legislator_years
from obligo.plans.copy import READ_PARTITIONS, copy_tables
from obligo.plans.marts import all_marts
from obligo.plans.refresh import publish_marts, refresh
from obligo.session import build_session, job_scratch, size_shuffles
from obligo.sinks.tables import (
    DETAIL_CHUNKS,
    MART_CHUNKS,
    with_snapshot,
    write_chunks,
    write_files,
    write_relation,
)
from obligo.sources import catalogue
from obligo.sources.dimensions import group_labels, industry_labels, state_demographics
from obligo.sources.legislators import read_legislators
from obligo.sources.relational import (
    Connection,
    read_by_key,
    read_by_range,
    read_relation,
    read_split,
)
from obligo.sources.transactions import (
    clean_contracts,
    clean_grants,
    project_contracts,
    project_grants,
)

FACTS = ("transaction_fpds", "transaction_fabs")


def table(spark: SparkSession, options: argparse.Namespace, name: str) -> DataFrame:
    """A source table: parquet below the input folder, or a relation of the source database."""
    if not options.source:
        return spark.read.parquet(f"{options.input}/{name}")
    database = Connection.from_environment(options.source)
    if name in FACTS and options.range:
        column, lower, upper = options.range
        return read_by_range(spark, database, name, column, int(lower), int(upper),
                             READ_PARTITIONS)
    if name in FACTS:
        return read_by_key(spark, database, name, options.key, READ_PARTITIONS)
    return read_relation(spark, database, name)


def publish(spark: SparkSession, options: argparse.Namespace, df: DataFrame, name: str,
            key: str, chunks: int) -> None:
    """A result as chunked files, or as a table of the target database, which must not exist."""
    if options.target:
        write_relation(df, Connection.from_environment(options.target), name, "error", chunks, key)
    else:
        write_chunks(df, f"{options.output}/{name}", key, chunks, "error")


def people(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    return legislator_years(*[
        read_legislators(spark, f"{options.input}/legislators-{which}.json", not options.lines)
        for which in ("current", "historical")
    ])


def dimensions(spark: SparkSession, options: argparse.Namespace) -> Dimensions:
    return Dimensions.measured(
        group_labels(table(spark, options, "naics")),
        state_demographics(table(spark, options, "state_data")),
        people(spark, options),
    )


def projected(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    return project_contracts(table(spark, options, "transaction_fpds"), options.key)


def contracts(spark: SparkSession, options: argparse.Namespace) -> None:
    sized = measure({
        "labels": industry_labels(table(spark, options, "naics")),
        "legislators": people(spark, options),
    })
    rows = clean_contracts(projected(spark, options), roll_up_code=False)
    detail = contract_detail(rows, sized["labels"], sized["legislators"])
    publish(spark, options, detail, "govcontract_data", "txn_id", DETAIL_CHUNKS)
    release(sized)


def grants(spark: SparkSession, options: argparse.Namespace) -> None:
    rows = clean_grants(project_grants(table(spark, options, "transaction_fabs"), options.key))
    sized = measure({"people": people(spark, options)})
    publish(spark, options, grant_detail(rows, sized["people"]), "govgrant_data", "txn_id",
            DETAIL_CHUNKS)
    release(sized)


def marts(spark: SparkSession, options: argparse.Namespace) -> None:
    rows = clean_contracts(projected(spark, options))
    dims = dimensions(spark, options)
    built = all_marts(spark, rows, dims)
    if options.target:
        database = Connection.from_environment(options.target)
        for name, mart in built.items():
            write_relation(with_snapshot(mart, options.date), database, name, "append",
                           MART_CHUNKS, "year")
    else:
        publish_marts(built, options.output, options.date)
    dims.release()


def refreshed(spark: SparkSession, options: argparse.Namespace) -> None:
    dims = dimensions(spark, options)
    report = refresh(spark, options.output, projected(spark, options), options.date, dims)
    report.show(truncate=False)
    dims.release()


def copy(spark: SparkSession, options: argparse.Namespace) -> None:
    database = Connection.from_environment(options.source)
    read = partial(read_relation, spark, database)
    plan = migration_plan(catalogue.base_tables(read), catalogue.key_columns(read),
                          catalogue.constraints(read), catalogue.row_estimates(read))

    def write(df: DataFrame, name: str, chunks: int, key: list[str]) -> None:
        if options.target:
            write_relation(df, Connection.from_environment(options.target), name, "error")
        else:
            write_files(df, f"{options.output}/{name}", "overwrite")

    copy_tables(plan, partial(read_split, spark, database, equal_depth=True), write, options.only)


JOBS = {"contracts": contracts, "grants": grants, "marts": marts, "refresh": refreshed,
        "copy": copy}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__,
                                     formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--input")
    parser.add_argument("--output")
    parser.add_argument("--date", help="snapshot date of marts and refresh")
    parser.add_argument("--from", dest="source", help="prefix of the database's settings")
    parser.add_argument("--to", dest="target", help="prefix of the target database's settings")
    parser.add_argument("--lines", action="store_true", help="legislators: a document per line")
    parser.add_argument("--key", nargs="+", default=["txn_id"], help="key columns of the facts")
    parser.add_argument("--range", nargs=3, metavar=("COLUMN", "LOWER", "UPPER"),
                        help="indexed number to split the facts by")
    parser.add_argument("--only", nargs="+", help="tables to copy")
    parser.add_argument("--shuffle-bytes", type=int, help="bytes the largest shuffle will move")
    options = parser.parse_args(arguments)
    if options.job in ("marts", "refresh") and not options.date:
        parser.error(f"{options.job} needs --date")
    if options.job == "copy" and not options.source:
        parser.error("copy needs --from")
    if not options.output and (options.job == "refresh" or not options.target):
        parser.error(f"{options.job} needs --output")
    spark = build_session(f"obligo {options.job}")
    if options.shuffle_bytes:
        size_shuffles(spark, options.shuffle_bytes)
    with job_scratch(spark):
        JOBS[options.job](spark, options)


if __name__ == "__main__":
    main()
