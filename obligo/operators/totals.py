"""Summing transactions before anything is attached to them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obligo.functions.clean import ratio
from obligo.operators.enrich import SEAT_KEYS, Dimensions, with_state
from obligo.operators.joins import Sized, join_dimension
from obligo.schemas import RATIO_TOTAL, TOTAL

RATIO_DIGITS = 6


def net_obligation(transactions: DataFrame, keys: list[str]) -> DataFrame:
    """Value of what was agreed: the signed actions of one key, added up."""
    return transactions.groupBy(*keys).agg(
        F.sum("amount").cast(TOTAL).alias("net_amount"),
        F.count(F.lit(1)).alias("n_actions"),
    )


def seat_totals(contracts: DataFrame, by_industry: bool = True,
                ratios_from: Sized | None = None) -> DataFrame:
    """Contracts summed per seat (state, district) and year and, on request, industry code.

    Every mart is a sum over the holders of a seat, so the amounts can be added up first and
    attached afterwards. The facts are scanned once, combined on the map side, and shuffled only
    as partial sums whose number is bounded by seats x years x codes, whatever the data size; a
    hot seat is one row per task. Contracts without state or year can never be attached and are
    left out before the shuffle. A missing district stays, for the chamber without districts.

    ``ratios_from`` adds the sums of the per-row ratios, which are rounded row by row and so
    have to be taken before the aggregation.
    """
    facts = contracts.filter(F.col("state").isNotNull() & F.col("year").isNotNull())
    sums = [F.sum("amount").cast(TOTAL).alias("amount"), F.count(F.lit(1)).alias("n_actions")]
    if ratios_from is not None:
        facts = with_state(facts, ratios_from)
        sums += [
            _ratio_total("population").alias("contract_pp"),
            _ratio_total("median_household_income").alias("contract_pd"),
        ]
    return facts.groupBy(*SEAT_KEYS["district"], *(["code"] if by_industry else [])).agg(*sums)


def added_totals(parts: DataFrame) -> DataFrame:
    """Seat totals of several sets of contracts from the seat totals of each."""
    sums = [F.sum("amount").cast(TOTAL).alias("amount"), F.sum("n_actions").alias("n_actions")]
    sums += [F.sum(c).cast(RATIO_TOTAL).alias(c) for c in ("contract_pp", "contract_pd")
             if c in parts.columns]
    keys = [*SEAT_KEYS["district"], *(["code"] if "code" in parts.columns else [])]
    return parts.groupBy(*keys).agg(*sums)


def _ratio_total(base: str) -> Column:
    return F.sum(ratio(F.col("amount"), F.col(base), RATIO_DIGITS).cast(RATIO_TOTAL)).cast(
        RATIO_TOTAL
    )


def credit(totals: DataFrame, dims: Dimensions, chamber: str,
           chamber_key: str = "district") -> DataFrame:
    """Credits each seat total to every holder of the seat in that year.

    With ``chamber_key="state"`` the holders have no district, and neither has the result.
    """
    people = dims.holders.df.filter(F.col("typeofrep") == chamber)
    if chamber_key == "state":
        people = people.drop("district").dropDuplicates()
        totals = totals.withColumn("district", F.lit(None).cast("bigint"))
    # Totals have one row per seat, year and code, so no key of them is hot.
    return join_dimension(totals, replace(dims.holders, df=people), SEAT_KEYS[chamber_key],
                          "inner", salts=1)


def overlap_report(contracts: DataFrame, dims: Dimensions, chamber: str = "rep") -> DataFrame:
    """Seats with more than one holder in a year, and the amount credited more than once."""
    keys = SEAT_KEYS["district"]
    shared = (
        dims.holders.df.filter((F.col("typeofrep") == chamber) & F.col("district").isNotNull())
        .groupBy(*keys)
        .agg(F.countDistinct("firstname", "lastname").alias("n_holders"))
        .filter(F.col("n_holders") > 1)
    )
    totals = seat_totals(contracts, by_industry=False)
    rows = join_dimension(totals, replace(dims.holders, df=shared), keys, "inner")
    return rows.select(
        *keys,
        "n_holders",
        "amount",
        (F.col("amount") * (F.col("n_holders") - 1)).cast(TOTAL).alias("extra_amount"),
    )
