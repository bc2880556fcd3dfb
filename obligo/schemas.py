"""Schemas of the source documents and column orders of the published tables."""

from __future__ import annotations

from pyspark.sql import types as T

TERM = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("start", T.StringType()),
        T.StructField("end", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("district", T.LongType()),
        T.StructField("party", T.StringType()),
    ]
)

LEGISLATOR = T.StructType(
    [
        T.StructField(
            "name",
            T.StructType(
                [T.StructField("first", T.StringType()), T.StructField("last", T.StringType())]
            ),
        ),
        T.StructField("terms", T.ArrayType(TERM)),
    ]
)

MONEY = T.DecimalType(18, 2)
TOTAL = T.DecimalType(28, 2)
RATIO_TOTAL = T.DecimalType(38, 6)

# Column orders of the published tables (fixed values).
LEGISLATOR_YEAR = ["firstname", "lastname", "typeofrep", "party", "state", "district", "year"]
CONTRACT_DETAIL = [
    "state", "district", "year", "code", "description", "txn_id", "amount", "country_code",
    "firstname", "lastname", "typeofrep", "party",
]
GRANT_DETAIL = [
    "state", "district", "year", "txn_id", "amount", "industry", "country_code",
    "firstname", "lastname", "typeofrep", "party",
]
LEGISLATOR_MART = [
    "firstname", "lastname", "typeofrep", "party", "district", "state_name", "population",
    "med_hh_income", "amount", "year", "description",
]
INDUSTRY_MART = [
    "amount", "state_name", "population", "med_hh_income", "year", "description", "state", "party",
]
STATE_MART = [
    "amount", "state_name", "population", "med_hh_income", "contract_pp", "contract_pd",
    "year", "state", "party",
]
