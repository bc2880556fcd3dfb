"""Cleaning of free-text columns, as native column expressions.

Everything here stays inside whole-stage codegen; nothing is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values of the cleaning rules.
EARLIEST_YEAR = 1300
COUNTRY_SYNONYM = ("USA", "UNITED STATES")
INDUSTRY_PREFIX_LENGTH = 4
WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"


def whole_number(text: Column) -> Column:
    """The text as a bigint, or null where it is not a whole number (blanks around it are fine).

    The pattern is tested first because a failing ``try_cast`` raises and catches an exception
    per row: on dates of which half end in no number, that made the cleaning ten times slower.
    """
    return F.when(text.rlike(WHOLE_NUMBER), text.try_cast("bigint"))


def clean_year(date_text: Column, mode: str = "compat") -> Column:
    """Year of a free-text date whose year stands at the end or at the start.

    ``compat`` keeps the published behaviour: a last-four number below 1300 is returned as it is,
    provided the first four characters are a number too ('20190102' gives 102).
    ``strict`` returns the first four characters in that case ('20190102' gives 2019).
    """
    last = whole_number(F.right(date_text, F.lit(4)))
    first = whole_number(F.left(date_text, F.lit(4)))
    if mode == "compat":
        early = F.when(first.isNotNull(), last)
    elif mode == "strict":
        early = first
    else:
        raise ValueError(f"mode must be 'compat' or 'strict', not {mode!r}")
    return F.when(last.isNull(), first).when(last >= EARLIEST_YEAR, last).otherwise(early)


def clean_district(label: Column) -> Column:
    """District number of a label that may carry its state in front ('CA36' and '36' give 36)."""
    return whole_number(F.when(F.length(label) > 2, F.right(label, F.lit(2))).otherwise(label))


def clean_country(country: Column) -> Column:
    synonym, name = COUNTRY_SYNONYM
    return F.when(country == synonym, F.lit(name)).otherwise(country)


def industry_prefix(code: Column) -> Column:
    """Rolls an industry code of up to six characters up to its four-character group."""
    return F.substring(code, 1, INDUSTRY_PREFIX_LENGTH)


def calendar_year(iso_date: Column) -> Column:
    return whole_number(F.left(iso_date, F.lit(4)))


def ratio(amount: Column, base: Column, digits: int) -> Column:
    """``round(amount / base, digits)``; null for a null or zero base.

    The amount is widened so that the quotient carries 18 decimals before it is rounded.
    """
    return F.round(F.try_divide(amount.cast("decimal(25,7)"), base), digits)


def register_sql_functions(spark: SparkSession) -> None:
    """Makes the cleaning rules callable from SQL text; Catalyst inlines the bodies."""
    number = f"CASE WHEN {{0}} RLIKE r'{WHOLE_NUMBER}' THEN TRY_CAST({{0}} AS BIGINT) END"
    last, first = (f"({number.format(f'{side}(s, 4)')})" for side in ("right", "left"))
    synonym, name = COUNTRY_SYNONYM
    bodies = {
        "to_year": (
            "BIGINT",
            f"CASE WHEN {last} IS NULL THEN {first}"
            f" WHEN {last} >= {EARLIEST_YEAR} OR {first} IS NOT NULL THEN {last} END",
        ),
        "to_district": (
            "BIGINT",
            number.format("(CASE WHEN length(s) > 2 THEN right(s, 2) ELSE s END)"),
        ),
        "to_country": ("STRING", f"CASE WHEN s = '{synonym}' THEN '{name}' ELSE s END"),
        "to_industry": ("STRING", f"substring(s, 1, {INDUSTRY_PREFIX_LENGTH})"),
    }
    for function, (kind, body) in bodies.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {function}(s STRING) RETURNS {kind} RETURN {body}"
        )
