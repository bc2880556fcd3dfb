"""Source tables in the shape the jobs expect, derived by Spark from the test tables.

The transaction table is derived once per session and written to the scratch folder; every query
then reads it as it would read a delivered table, with pruned columns and pushed-down filters.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obligo.operators.enrich import Dimensions
from obligo.operators.joins import Sized, measure
from obligo.operators.snapshots import snapshot_fingerprint
from obligo.operators.terms import legislator_years
from obligo.plans.marts import mart
from obligo.session import remove_folder, scratch_folder
from obligo.sinks.tables import stored, write_evenly
from obligo.sources.dimensions import group_labels, industry_labels, state_demographics
from obligo.sources.transactions import (
    clean_contracts,
    clean_grants,
    project_contracts,
    project_grants,
)

# Historical terms of the derived rosters that begin earlier are left out.
SEAT_MIN_START = 1997
ROSTER_MIN_START = 1997
# The state in which the localized snapshots differ.
CHANGED = "07"
# Broadcast limit of the dimensions with the derived roster, in bytes.
SMALL_LIMIT = 20_000


class Source:
    """The derived tables of one folder of test tables, each made at most once per session."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._made: dict[str, object] = {}

    def once(self, name: str, make: Callable[[], object]):
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def spread(self, name: str) -> DataFrame:
        """The table, over all cores where its files alone would make fewer tasks than that."""
        df = self.table(name)
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

    def stored_evenly(self, df: DataFrame, name: str) -> DataFrame:
        """Stores a source table in files of about equally many rows.

        The joins that derive it leave even files unless a key is hot or a row has many copies;
        only then are the rows dealt once more.
        """
        path = f"{scratch_folder(self.spark)}/{name}-{uuid4().hex}"
        even = write_evenly(df, path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        if even:
            return kept
        files = max(
            self.spark.sparkContext.defaultParallelism,
            int(self.spark.conf.get("spark.sql.shuffle.partitions")),
        )
        dealt = stored(self.spark, kept.repartition(files), name)
        remove_folder(self.spark, path)
        return dealt

    # -- transactions ---------------------------------------------------------------------

    def transactions(self) -> DataFrame:
        return self.once(
            "transactions",
            lambda: self.stored_evenly(
                derive_transactions(
                    self.spread("lineitem"),
                    self.table("orders"),
                    self.table("customer"),
                    self.table("part"),
                ),
                "transactions",
            ),
        )

    def fpds(self) -> DataFrame:
        return self.transactions().drop("cfda_title")

    def fabs(self) -> DataFrame:
        return self.transactions().drop("naics")

    def projected(self) -> DataFrame:
        return project_contracts(self.fpds())

    def contracts(self) -> DataFrame:
        """Cleaned contracts with four-character codes."""
        return clean_contracts(self.projected())

    def contracts_full_code(self) -> DataFrame:
        return clean_contracts(self.projected(), roll_up_code=False)

    def grants(self) -> DataFrame:
        return clean_grants(project_grants(self.fabs()))

    def old_snapshot(self) -> DataFrame:
        return self.projected()

    def new_snapshot(self) -> DataFrame:
        return next_snapshot(self.projected())

    def local_snapshots(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Two snapshots that differ in one state, and the old one's fingerprint per state."""
        old = with_second_state(self.projected())
        prints = self.once(
            "old prints", lambda: stored(self.spark, snapshot_fingerprint(old, ["state"]), "prints")
        )
        return old, next_in_one_state(old), prints

    # -- dimensions -----------------------------------------------------------------------

    def naics(self) -> DataFrame:
        return derive_naics(self.table("part"))

    def state_data(self) -> DataFrame:
        return derive_state_data(self.table("nation"), self.table("customer"))

    def seats(self) -> tuple[DataFrame, DataFrame]:
        """Current and historical documents of the holders of seats."""
        return derive_seats(self.table("nation"))

    def seat_years(self) -> DataFrame:
        current, historical = self.seats()
        return legislator_years(current, historical, SEAT_MIN_START)

    def roster(self) -> tuple[DataFrame, DataFrame]:
        """Current and historical documents, as delivered files."""

        def make() -> tuple[DataFrame, DataFrame]:
            current, historical = derive_roster(self.spread("orders"))
            return (
                stored(self.spark, current, "roster-current"),
                stored(self.spark, historical, "roster-historical"),
            )

        return self.once("roster", make)

    def dims(self) -> Dimensions:
        return self.once(
            "dims",
            lambda: Dimensions.measured(
                group_labels(self.naics()),
                state_demographics(self.state_data()),
                self.seat_years(),
            ),
        )

    def roster_dims(self) -> Dimensions:
        """Dimensions whose legislators grow with the data, beyond what may be broadcast."""
        return self.once(
            "roster_dims",
            lambda: Dimensions.measured(
                group_labels(self.naics()),
                state_demographics(self.state_data()),
                legislator_years(*self.roster(), ROSTER_MIN_START),
                limit=SMALL_LIMIT,
            ),
        )

    def all_labels(self) -> Sized:
        """Labels of every code length."""
        return self.once(
            "all_labels", lambda: measure({"labels": industry_labels(self.naics())})["labels"]
        )

    # -- stored marts ---------------------------------------------------------------------

    def stored_mart(self, name: str) -> DataFrame:
        return self.once(
            f"mart {name}",
            lambda: stored(self.spark, mart(name, self.contracts(), self.dims()), name),
        )


_sources: dict[tuple[str, str], Source] = {}


def source(spark: SparkSession, folder: str) -> Source:
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _sources:
        _sources[key] = Source(spark, folder)
    return _sources[key]


def derive_transactions(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                        part: DataFrame) -> DataFrame:
    """Line items as obligation actions.

    Two date formats and missing dates, returns as negative amounts, districts with and without
    their state in front, unusable and missing districts, two spellings of the country.

    Line items are shuffled twice, in numbers and not in the texts made of them, and never sorted:
    orders and parts are what the joins hash.
    """
    lines = lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag = 'R' AS returned",
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS price", "CAST(l_shipdate AS DATE) AS shipped",
    )
    buyers = orders.join(customer, F.expr("o_custkey = c_custkey"))
    rows = lines.join(buyers.hint("shuffle_hash"), F.expr("l_orderkey = o_orderkey")).join(
        part.hint("shuffle_hash"), F.expr("l_partkey = p_partkey")
    )
    return rows.selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,"
        " price) AS txn_id",
        "CASE WHEN l_linenumber = 7 THEN NULL"
        " WHEN l_linenumber % 2 = 0 THEN date_format(shipped, 'MM/dd/yyyy')"
        " ELSE CAST(shipped AS STRING) END AS action_date",
        "CAST(CASE WHEN returned THEN -price ELSE price END AS DECIMAL(18,2))"
        " AS federal_action_obligation",
        "lpad(CAST(c_nationkey AS STRING), 2, '0') AS legal_entity_state_code",
        "CASE WHEN c_custkey % 11 = 0 THEN 'ZZ' WHEN c_custkey % 13 = 0 THEN NULL"
        " WHEN c_custkey % 3 = 0 THEN lpad(CAST(c_nationkey AS STRING), 2, '0')"
        "  || lpad(CAST(c_custkey % 5 AS STRING), 2, '0')"
        " ELSE CAST(c_custkey % 5 AS STRING) END AS legal_entity_congressional",
        "'11' || lpad(substr(p_brand, 7), 2, '0') || lpad(CAST(p_size AS STRING), 2, '0')"
        " AS naics",
        "p_type AS cfda_title",
        "CASE WHEN c_nationkey % 4 = 0 THEN 'USA' ELSE 'UNITED STATES' END"
        " AS legal_entity_country_code",
    )


def next_snapshot(projected: DataFrame) -> DataFrame:
    """The following month: some amounts raised, some actions gone, some added."""
    kept = projected.filter(~F.col("txn_id").like("%9-2-%")).withColumn(
        "amount",
        F.when(F.col("txn_id").like("%7-1-%"), F.col("amount") + 1)
        .otherwise(F.col("amount"))
        .cast("decimal(18,2)"),
    )
    added = projected.filter(F.col("txn_id").like("%3-4-%")).withColumn(
        "txn_id", F.concat("txn_id", F.lit("-n"))
    )
    return kept.unionByName(added)


def with_second_state(projected: DataFrame) -> DataFrame:
    """Some ids have a second row in the state that will change, next to the row in their own."""
    again = projected.filter(F.col("txn_id").like("%5-3-%")).withColumn("state", F.lit(CHANGED))
    return projected.unionByName(again)


def next_in_one_state(old: DataFrame) -> DataFrame:
    """Amounts raised and rows gone in one state only."""
    changed = F.col("state") == CHANGED
    return old.filter(~(changed & F.col("txn_id").like("%15-3-%"))).withColumn(
        "amount",
        F.when(changed & F.col("txn_id").like("%7-1-%"), F.col("amount") + 1)
        .otherwise(F.col("amount"))
        .cast("decimal(18,2)"),
    )


def derive_naics(part: DataFrame) -> DataFrame:
    """Labels for four-character groups (the last five stay unlabelled) and some longer codes.

    Every code has another description in an earlier vintage.
    """
    brand = F.lpad(F.expr("substr(p_brand, 7)"), 2, "0")
    size = F.lpad(F.col("p_size").cast("string"), 2, "0")
    groups = part.filter("CAST(substr(p_brand, 7) AS INT) <= 20").select(
        F.concat(F.lit("11"), brand).alias("code"),
        F.concat(F.lit("Industry "), brand).alias("description"),
    )
    niches = part.filter("p_size <= 10").select(
        F.concat(F.lit("11"), brand, size).alias("code"),
        F.concat(F.lit("Niche "), brand, F.lit("-"), size).alias("description"),
    )
    unused = part.agg(F.lit("9999").alias("code"), F.lit("No contracts here").alias("description"))
    labels = groups.distinct().unionByName(niches.distinct()).unionByName(unused)
    earlier = labels.select("code", F.concat(F.lit("Former "), "description").alias("description"))
    return labels.withColumn("year", F.lit(2017)).unionByName(
        earlier.withColumn("year", F.lit(2012)))


def derive_state_data(nation: DataFrame, customer: DataFrame) -> DataFrame:
    """Two vintages per state; one state is missing and one has no population.

    The population counts the state's customers, so it is derived from the whole table.
    """
    counted = customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_customers"))
    return (
        nation.filter("n_nationkey <> 23")
        .join(counted, F.expr("n_nationkey = c_nationkey"), "left")
        .withColumn("year", F.explode(F.array(F.lit(2000), F.lit(2010))))
        .selectExpr(
            "lpad(CAST(n_nationkey AS STRING), 2, '0') AS code",
            "n_name AS name",
            "year",
            "CAST(CASE WHEN n_nationkey <> 24 THEN 500000 + 37001 * n_nationkey"
            " + (year - 2000) * 1000 + coalesce(n_customers, 0) END AS INT) AS population",
            "CAST(40000.25 + 711 * n_nationkey AS DECIMAL(12,2)) AS median_household_income",
        )
    )


_DOCUMENT = (
    "transform({starts}, y0 -> named_struct("
    "'type', {type},"
    " 'start', CAST(y0 AS STRING) || '-01-03',"
    " 'end', CAST(y0 + {length} AS STRING) || '-01-03',"
    " 'state', {state}, 'district', {district}, 'party', {party})) AS terms"
)


def derive_seats(nation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Current and historical holders: five seats and a senator per state.

    Terms last two years and share their hand-over year; the seat changes holder in 2001. One
    state in five has another senator, who is listed with a district.
    """
    seats = nation.withColumn(
        "d", F.explode(F.array(*[F.lit(d) for d in (0, 1, 2, 3, 4, 8, 9)]))
    ).filter("d <> 8 OR n_nationkey % 5 = 0")
    names = "named_struct('first', 'F' || n_nationkey, 'last', 'L' || n_nationkey || '_' || d{})"
    parts = {
        "type": "CASE WHEN d >= 8 THEN 'sen' ELSE 'rep' END",
        "length": "2",
        "state": "lpad(CAST(n_nationkey AS STRING), 2, '0')",
        "district": "CASE WHEN d = 9 THEN NULL WHEN d = 8 THEN 3L ELSE CAST(d AS BIGINT) END",
        "party": "CASE WHEN (n_nationkey + d) % 7 = 0 THEN 'Independent'"
        " WHEN (n_nationkey + d) % 2 = 0 THEN 'Democrat' ELSE 'Republican' END",
    }
    historical = seats.selectExpr(
        names.format("") + " AS name", _DOCUMENT.format(starts="array(1995, 1997)", **parts)
    )
    current = seats.selectExpr(
        names.format("") + " AS name", _DOCUMENT.format(starts="array(1999)", **parts)
    ).unionByName(
        seats.selectExpr(
            names.format(" || 'b'") + " AS name",
            _DOCUMENT.format(starts="array(2001)", **parts),
        )
    )
    return current, historical


def derive_roster(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Current and historical legislators, one document per order, with one to four terms.

    Terms last zero to three years; one in fifty ends before it starts.
    """
    documents = orders.selectExpr(
        "o_orderkey",
        "named_struct('first', 'F' || (o_custkey % 97), 'last', 'L' || o_orderkey) AS name",
        _DOCUMENT.format(
            starts="transform(sequence(0, CAST(o_orderkey % 4 AS INT)),"
            " i -> year(o_orderdate) + 2 * i)",
            type="CASE WHEN o_orderkey % 6 = 0 THEN 'sen' ELSE 'rep' END",
            length="CASE WHEN o_orderkey % 50 = 0 THEN -1 ELSE o_custkey % 4 END",
            state="lpad(CAST(o_custkey % 25 AS STRING), 2, '0')",
            district="CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey % 40 END",
            party="CASE WHEN o_custkey % 7 = 0 THEN 'Independent'"
            " WHEN o_custkey % 2 = 0 THEN 'Democrat' ELSE 'Republican' END",
        ),
    )
    return (
        documents.filter("o_orderkey % 3 = 0").select("name", "terms"),
        documents.filter("o_orderkey % 3 <> 0").select("name", "terms"),
    )
