"""The queries behind the report page, over stored marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obligo.functions.clean import ratio
from obligo.schemas import TOTAL

# Fixed values of the report.
PARTIES = ["Democrat", "Republican"]
NO_INDUSTRY = "None"
AFTER_YEAR = "2014"
TOP = 15
MILLION = 1_000_000
# Columns that make rows of any mart distinct, as far as a mart has them.
PROBE_ORDER = ["year", "firstname", "lastname", "description", "state", "party"]
REPORT = ["firstname", "lastname", "description", "party", "district", "state_name", "year"]


def probe(mart: DataFrame) -> DataFrame:
    """One row, to see that a mart is there: the first in the order of the mart's key."""
    key = [c for c in PROBE_ORDER if c in mart.columns]
    return mart.orderBy(*[F.asc_nulls_first(c) for c in key]).limit(1)


def industry_list(legislator_mart: DataFrame) -> DataFrame:
    """Names of all industries, sorted; neither null nor 'None'."""
    return (
        legislator_mart.select("description")
        .filter(F.col("description") != NO_INDUSTRY)
        .distinct()
        .orderBy("description")
    )


def industry_party_series(industry_mart: DataFrame, industry: str | None = None) -> DataFrame:
    """Amount per year and party of one industry, or of every industry."""
    rows = industry_mart
    if industry is not None:
        rows = rows.filter(F.col("description") == industry)
    return (
        rows.groupBy("year", "party", "description")
        .agg(F.sum("amount").cast(TOTAL).alias("amount"))
        .orderBy("year", "party", "description")
    )


def party_pivot(industry_mart: DataFrame, industry: str | None = None) -> DataFrame:
    """One row per year with the amounts of the two large parties side by side.

    A year in which one of them has no amount keeps its row, so the two series stay aligned.
    """
    rows = industry_mart
    if industry is not None:
        rows = rows.filter(F.col("description") == industry)
    return (
        rows.groupBy("year", "description")
        .pivot("party", PARTIES)
        .agg(F.sum("amount").cast(TOTAL))
        .withColumnsRenamed({p: p.lower() for p in PARTIES})
        .filter(F.coalesce(*[F.col(p.lower()) for p in PARTIES]).isNotNull())
        .orderBy("year", "description")
    )


def _by_amount() -> list[Column]:
    """Largest amount first; the other columns make the order total."""
    return [F.desc("amount"), F.asc("year"), F.asc("lastname"), F.asc("firstname")]


def _report_columns() -> list[Column]:
    amount = F.col("amount")
    return [
        *[F.col(c) for c in REPORT],
        ratio(amount, F.lit(MILLION), 2).alias("amount_r"),
        ratio(amount, F.col("population"), 2).alias("contract_pp"),
        ratio(amount, F.col("med_hh_income"), 2).alias("contract_income"),
    ]


def top_legislators(legislator_mart: DataFrame, industry: str, after_year: str = AFTER_YEAR,
                    n: int = TOP) -> DataFrame:
    """The n largest legislator-years of one industry. Years compare as text."""
    return (
        legislator_mart.filter((F.col("description") == industry) & (F.col("year") > after_year))
        .orderBy(*_by_amount())
        .limit(n)
        .select(*_report_columns())
    )


def top_legislators_all(legislator_mart: DataFrame, after_year: str = AFTER_YEAR,
                        n: int = TOP) -> DataFrame:
    """The n largest legislator-years of every industry, with their rank.

    Spark keeps only n rows per industry and task before it shuffles for the rank.
    """
    rank = F.row_number().over(Window.partitionBy("description").orderBy(*_by_amount()))
    return (
        legislator_mart.filter((F.col("description") != NO_INDUSTRY) & (F.col("year") > after_year))
        .withColumn("rank", rank)
        .filter(F.col("rank") <= n)
        .select("rank", *_report_columns())
    )
