"""Small dimension tables of one vintage each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Vintages and code length of the published tables (fixed values).
LABEL_YEAR = 2017
CENSUS_YEAR = 2010
GROUP_CODE_LENGTH = 4


def industry_labels(naics: DataFrame, year: int = LABEL_YEAR,
                    code_length: int | None = None) -> DataFrame:
    """Industry names of one vintage, of all code lengths or of one."""
    labels = naics.filter(F.col("year") == year)
    if code_length is not None:
        labels = labels.filter(F.length("code") == code_length)
    return labels.select("code", "description")


def group_labels(naics: DataFrame, year: int = LABEL_YEAR) -> DataFrame:
    return industry_labels(naics, year, GROUP_CODE_LENGTH)


def state_demographics(state_data: DataFrame, year: int = CENSUS_YEAR) -> DataFrame:
    return state_data.filter(F.col("year") == year).select(
        F.col("code").alias("state"),
        F.col("name").alias("state_name"),
        "population",
        "median_household_income",
    )
