"""A small world with the awkward cases in it, as DataFrames."""

import random
from decimal import Decimal

from obligo.operators.enrich import Dimensions

CONTRACTS = (
    "txn_id string, year bigint, amount decimal(18,2), state string, district bigint,"
    " code string, country_code string"
)


def contracts(spark, n=600, hot=0.4, seed=1):
    """Contracts of which a large share falls on one seat, year and code."""
    r = random.Random(seed)
    made = []
    for i in range(n):
        if r.random() < hot:
            seat = ("AA", 9, 2001, "1111")
        else:
            seat = (r.choice(["AA", "BB", "CC", None]), r.choice([1, 9, 10, None]),
                    r.choice([2000, 2001, 2002, None]), r.choice(["1111", "2222", "3333", None]))
        state, district, year, code = seat
        amount = None if r.random() < 0.02 else Decimal(r.randint(-10**7, 10**7)) / 100
        made.append((f"t{i}", year, amount, state, district, code, "UNITED STATES"))
    return spark.createDataFrame(made, CONTRACTS).repartition(4)


def legislators(spark):
    """Overlapping terms, identical rows, namesakes, a party switch, senators."""
    people = [
        ("A", "One", "rep", "Democrat", "AA", 9, 2000),
        ("A", "One", "rep", "Democrat", "AA", 9, 2001),
        ("A", "One", "rep", "Democrat", "AA", 9, 2001),
        ("B", "Two", "rep", "Republican", "AA", 9, 2001),
        ("A", "One", "rep", "Democrat", "AA", 10, 2001),
        ("C", "Six", "rep", "Democrat", "BB", 1, 2002),
        ("C", "Six", "rep", "Independent", "BB", 1, 2002),
        ("D", "Ten", "rep", "Republican", "CC", 10, 2000),
        ("S", "Sen", "sen", "Democrat", "AA", None, 2001),
        ("S", "Sen", "sen", "Democrat", "AA", None, 2001),
        ("T", "Sen", "sen", "Republican", "AA", None, 2001),
        ("U", "Sen", "sen", "Republican", "BB", None, 2002),
    ]
    return spark.createDataFrame(
        people, "firstname string, lastname string, typeofrep string, party string, state string,"
        " district bigint, year bigint")


def labels(spark):
    return spark.createDataFrame(
        [("1111", "Mining"), ("2222", "Milling"), ("9999", "Unused")],
        "code string, description string")


def states(spark):
    return spark.createDataFrame(
        [("AA", "Alpha", 1570912, Decimal("43490.00")), ("BB", "Beta", 0, None)],
        "state string, state_name string, population int, median_household_income decimal(12,2)")


def dims(spark):
    return Dimensions.measured(labels(spark), states(spark), legislators(spark))


def combined(spark, facts):
    """The literal attribution: every join a plain left join of the facts."""
    return (
        facts.join(labels(spark), "code", "left")
        .join(states(spark), "state", "left")
        .join(legislators(spark), ["state", "district", "year"], "left")
    )
