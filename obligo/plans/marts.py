"""The published marts, each a sum of seat totals over the holders of the seat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obligo.operators.enrich import Dimensions
from obligo.operators.joins import join_dimension
from obligo.operators.totals import credit, seat_totals
from obligo.schemas import INDUSTRY_MART, LEGISLATOR_MART, RATIO_TOTAL, STATE_MART, TOTAL
from obligo.sinks.tables import stored

# Suffix of the published table -> chamber (fixed values).
CHAMBERS = {"hr": "rep", "sen": "sen"}
MARTS = [f"{kind}_by_year_{suffix}" for kind in ("legis", "indus", "state") for suffix in CHAMBERS]


def _largest(*columns: str) -> list[Column]:
    names = {"median_household_income": "med_hh_income"}
    return [F.max(c).alias(names.get(c, c)) for c in columns]


def _total(column: str, kind=TOTAL) -> Column:
    return F.sum(column).cast(kind).alias(column)


def legislators_by_year(totals: DataFrame, dims: Dimensions, chamber: str,
                        chamber_key: str = "district") -> DataFrame:
    """Amount per legislator, year and industry; contracts without an industry are one group.

    The district is the largest *text* ('9' is larger than '10'), and legislators who share
    their name are one group.
    """
    rows = credit(totals, dims, chamber, chamber_key).withColumn(
        "district", F.col("district").cast("string")
    )
    rows = join_dimension(rows, dims.labels, ["code"])
    rows = join_dimension(rows, dims.states, ["state"])
    mart = rows.groupBy("year", "firstname", "lastname", "description").agg(
        *_largest("typeofrep", "party", "district", "state_name", "population",
                  "median_household_income"),
        _total("amount"),
    )
    return mart.withColumn("year", F.col("year").cast("string")).select(*LEGISLATOR_MART)


def industries_by_year(totals: DataFrame, dims: Dimensions, chamber: str,
                       chamber_key: str = "district") -> DataFrame:
    """Amount per industry, year, state and party; only contracts with an industry."""
    rows = join_dimension(credit(totals, dims, chamber, chamber_key), dims.labels, ["code"],
                          "inner").filter(F.col("description").isNotNull())
    rows = join_dimension(rows, dims.states, ["state"])
    mart = rows.groupBy("description", "year", "state", "party").agg(
        _total("amount"), *_largest("state_name", "population", "median_household_income")
    )
    return mart.withColumn("year", F.col("year").cast("string")).select(*INDUSTRY_MART)


def states_by_year(totals: DataFrame, dims: Dimensions, chamber: str,
                   chamber_key: str = "district", compat: bool = True) -> DataFrame:
    """Amount per state, year and party, per head and per dollar of household income.

    ``totals`` must carry the ratio sums. ``compat`` keeps the published behaviour that the
    senate table is a copy of the house table.
    """
    if compat:
        chamber, chamber_key = CHAMBERS["hr"], "district"
    rows = join_dimension(credit(totals, dims, chamber, chamber_key), dims.states, ["state"])
    mart = rows.groupBy("year", "state", "party").agg(
        _total("amount"),
        *_largest("state_name", "population", "median_household_income"),
        _total("contract_pp", RATIO_TOTAL),
        _total("contract_pd", RATIO_TOTAL),
    )
    return mart.withColumn("year", F.col("year").cast("string")).select(*STATE_MART)


def mart(name: str, contracts: DataFrame, dims: Dimensions, chamber_key: str = "district",
         compat: bool = True) -> DataFrame:
    """One mart by its published name, straight from the cleaned contracts."""
    kind, _, suffix = name.rpartition("_")
    chamber = CHAMBERS[suffix]
    if kind == "legis_by_year":
        return legislators_by_year(seat_totals(contracts), dims, chamber, chamber_key)
    if kind == "indus_by_year":
        return industries_by_year(seat_totals(contracts), dims, chamber, chamber_key)
    if kind == "state_by_year":
        totals = seat_totals(contracts, by_industry=False, ratios_from=dims.states)
        return states_by_year(totals, dims, chamber, chamber_key, compat)
    raise ValueError(f"no mart named {name!r}")


def all_marts(spark: SparkSession, contracts: DataFrame, dims: Dimensions,
              senate_key: str = "district", compat: bool = True) -> dict[str, DataFrame]:
    """All six marts from one scan of the contracts.

    The seat totals feed all six. They are written once to the scratch folder rather than
    cached, so that losing an executor does not mean scanning the contracts again.
    """
    totals = stored(spark, seat_totals(contracts, ratios_from=dims.states), "seat_totals")
    return marts_of(totals, dims, senate_key, compat)


def marts_of(totals: DataFrame, dims: Dimensions, senate_key: str = "district",
             compat: bool = True) -> dict[str, DataFrame]:
    """All six marts from stored seat totals that carry the ratio sums."""
    marts = {}
    for suffix, chamber in CHAMBERS.items():
        key = senate_key if suffix == "sen" else "district"
        marts[f"legis_by_year_{suffix}"] = legislators_by_year(totals, dims, chamber, key)
        marts[f"indus_by_year_{suffix}"] = industries_by_year(totals, dims, chamber, key)
        marts[f"state_by_year_{suffix}"] = states_by_year(totals, dims, chamber, key, compat)
    return marts
