"""Transaction tables: one row per obligation action, amounts signed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obligo.functions.clean import clean_country, clean_district, clean_year, industry_prefix
from obligo.functions.keys import natural_key
from obligo.schemas import MONEY

ID = "txn_id"


def _id(key: Sequence[str] | None) -> Column:
    """The id the table has, or one built from the columns that together identify a row."""
    return natural_key(*key).alias(ID) if key and list(key) != [ID] else F.col(ID)


def project_contracts(raw: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """The contract columns the jobs use, under their short names.

    ``key`` names the columns that identify a transaction where the table has no ``txn_id``.
    Amounts are taken with two decimals, as they are booked: finer ones are rounded half up, and
    an amount of 10^16 or more stops the job.
    """
    return raw.select(
        _id(key),
        F.col("action_date").alias("year"),
        F.col("federal_action_obligation").cast(MONEY).alias("amount"),
        F.col("legal_entity_state_code").alias("state"),
        F.col("legal_entity_congressional").alias("district"),
        F.col("naics").alias("code"),
        F.col("legal_entity_country_code").alias("country_code"),
    )


def project_grants(raw: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """The grant columns the jobs use; grants carry a programme title instead of a code."""
    return raw.select(
        _id(key),
        F.col("action_date").alias("year"),
        F.col("federal_action_obligation").cast(MONEY).alias("amount"),
        F.col("legal_entity_state_code").alias("state"),
        F.col("legal_entity_congressional").alias("district"),
        F.col("cfda_title").alias("industry"),
        F.col("legal_entity_country_code").alias("country_code"),
    )


def clean_contracts(projected: DataFrame, year_mode: str = "compat",
                    roll_up_code: bool = True) -> DataFrame:
    """Typed year and district, one spelling of the country, and four-character codes on request."""
    cleaned = {
        "year": clean_year(F.col("year"), year_mode),
        "district": clean_district(F.col("district")),
        "country_code": clean_country(F.col("country_code")),
    }
    if roll_up_code:
        cleaned["code"] = industry_prefix(F.col("code"))
    return projected.withColumns(cleaned)


def clean_grants(projected: DataFrame, year_mode: str = "compat") -> DataFrame:
    """Grants get only their year cleaned; district and country stay as delivered."""
    return projected.withColumn("year", clean_year(F.col("year"), year_mode))
