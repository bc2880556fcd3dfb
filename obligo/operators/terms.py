"""From legislator documents to one row per legislator and year of service."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obligo.functions.clean import calendar_year
from obligo.schemas import LEGISLATOR_YEAR

# Historical terms that begin earlier are left out (fixed value).
HISTORICAL_START_YEAR = 2000


def flatten_terms(legislators: DataFrame) -> DataFrame:
    """One row per term."""
    return legislators.select(
        F.col("name.first").alias("firstname"),
        F.col("name.last").alias("lastname"),
        F.explode("terms").alias("t"),
    ).select(
        "firstname",
        "lastname",
        F.col("t.type").alias("typeofrep"),
        F.col("t.party").alias("party"),
        F.col("t.state").alias("state"),
        F.col("t.district").alias("district"),
        calendar_year(F.col("t.start")).alias("start_year"),
        calendar_year(F.col("t.end")).alias("end_year"),
    )


def expand_years(terms: DataFrame, min_start_year: int | None = None) -> DataFrame:
    """One row per term and calendar year, first and last year included.

    Consecutive terms therefore share their hand-over year. A term that ends before it starts
    has no years. With ``min_start_year``, terms that begin earlier are left out altogether.
    """
    if min_start_year is not None:
        terms = terms.filter(F.col("start_year") >= min_start_year)
    return (
        terms.filter(F.col("end_year") >= F.col("start_year"))
        .withColumn("year", F.explode(F.sequence("start_year", "end_year")))
        .select(*LEGISLATOR_YEAR)
    )


def legislator_years(current: DataFrame, historical: DataFrame | None = None,
                     min_start_year: int = HISTORICAL_START_YEAR) -> DataFrame:
    """Years of service of current legislators and, from ``min_start_year`` on, of former ones."""
    years = expand_years(flatten_terms(current))
    if historical is None:
        return years
    return years.unionByName(expand_years(flatten_terms(historical), min_start_year))
