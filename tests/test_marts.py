from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import world
from obligo.operators import totals
from obligo.plans import marts
from obligo.schemas import INDUSTRY_MART, LEGISLATOR_MART, STATE_MART

from conftest import plan, rows


@pytest.fixture(scope="module")
def facts(spark):
    return world.contracts(spark).cache()


@pytest.fixture(scope="module")
def dims(spark):
    return world.dims(spark)


def attributes():
    return [F.max("state_name").alias("state_name"), F.max("population").alias("population"),
            F.max("median_household_income").alias("med_hh_income")]


def literal(combined, kind):
    """The mart as it is specified: DISTINCT of the joined rows, then one aggregation."""
    d = combined.distinct()
    year = F.col("year").cast("string").alias("year")
    if kind == "legis":
        return d.groupBy(year, "firstname", "lastname", "description").agg(
            F.max("typeofrep").alias("typeofrep"), F.max("party").alias("party"),
            F.max(F.col("district").cast("string")).alias("district"),
            *attributes(), F.sum("amount").cast("decimal(28,2)").alias("amount"),
        ).select(*LEGISLATOR_MART)
    if kind == "indus":
        return d.filter("description is not null").groupBy(
            "description", year, "state", "party"
        ).agg(F.sum("amount").cast("decimal(28,2)").alias("amount"), *attributes()).select(
            *INDUSTRY_MART)
    wide = F.col("amount").cast("decimal(25,7)")
    return d.groupBy(year, "state", "party").agg(
        F.sum("amount").cast("decimal(28,2)").alias("amount"), *attributes(),
        F.sum(F.round(F.try_divide(wide, "population"), 6)).cast("decimal(38,6)")
        .alias("contract_pp"),
        F.sum(F.round(F.try_divide(wide, "median_household_income"), 6)).cast("decimal(38,6)")
        .alias("contract_pd"),
    ).select(*STATE_MART)


@pytest.mark.parametrize("kind", ["legis", "indus", "state"])
def test_house_marts_equal_the_literal_definition(spark, facts, dims, kind):
    combined = world.combined(spark, facts).filter("typeofrep = 'rep'")
    expected = literal(combined, kind)
    got = marts.mart(f"{kind}_by_year_hr", facts, dims)
    assert got.columns == expected.columns
    assert rows(got) == rows(expected) != []


def test_senate_marts_are_empty_by_district(facts, dims):
    assert marts.mart("legis_by_year_sen", facts, dims).isEmpty()
    assert marts.mart("indus_by_year_sen", facts, dims).isEmpty()


def test_senate_state_mart_is_a_copy_of_the_house_unless_corrected(facts, dims):
    house = rows(marts.mart("state_by_year_hr", facts, dims))
    assert rows(marts.mart("state_by_year_sen", facts, dims)) == house
    assert marts.mart("state_by_year_sen", facts, dims, compat=False).isEmpty()
    by_state = marts.mart("state_by_year_sen", facts, dims, chamber_key="state", compat=False)
    assert rows(by_state) not in (house, [])


@pytest.mark.parametrize("kind", ["legis", "indus", "state"])
def test_senate_marts_by_state_equal_the_literal_definition(spark, facts, dims, kind):
    senators = world.legislators(spark).filter("typeofrep = 'sen'").drop("district")
    combined = (
        facts.withColumn("district", F.lit(None).cast("bigint"))
        .join(world.labels(spark), "code", "left").join(world.states(spark), "state", "left")
        .join(senators, ["state", "year"])
    )
    got = marts.mart(f"{kind}_by_year_sen", facts, dims, chamber_key="state", compat=False)
    assert rows(got) == rows(literal(combined, kind)) != []


def test_all_marts_from_one_scan_equal_the_single_marts(spark, facts, dims):
    together = marts.all_marts(spark, facts, dims)
    assert list(sorted(together)) == sorted(marts.MARTS)
    for name, df in together.items():
        assert rows(df) == rows(marts.mart(name, facts, dims)), name


def test_district_is_the_largest_text_and_namesakes_merge(facts, dims):
    mart = marts.mart("legis_by_year_hr", facts, dims)
    one = mart.filter("lastname = 'One' and year = '2001' and description = 'Mining'").collect()
    assert [r.district for r in one] == ["9"]


def test_contracts_without_industry_are_a_group_of_the_legislator_mart_only(facts, dims):
    assert marts.mart("legis_by_year_hr", facts, dims).filter("description is null").count() > 0
    assert marts.mart("indus_by_year_hr", facts, dims).filter("description is null").isEmpty()


def test_both_holders_of_a_shared_year_get_the_whole_amount(spark, dims):
    facts = spark.createDataFrame(
        [("t", 2001, Decimal("7.00"), "AA", 9, "1111", "X")], world.CONTRACTS)
    mart = marts.mart("legis_by_year_hr", facts, dims)
    assert sorted((r.lastname, r.amount) for r in mart.collect()) == [
        ("One", Decimal("7.00")), ("Two", Decimal("7.00"))]
    report = totals.overlap_report(facts, dims).collect()
    assert [tuple(r) for r in report] == [("AA", 9, 2001, 2, Decimal("7.00"), Decimal("7.00"))]


def test_ratios_are_rounded_row_by_row(spark, dims):
    facts = spark.createDataFrame(
        [(f"t{i}", 2001, Decimal("1.00"), "AA", 9, "1111", "X") for i in range(3)],
        world.CONTRACTS)
    mart = marts.mart("state_by_year_hr", facts, dims).filter("party = 'Democrat'").first()
    assert mart.contract_pp == 3 * round(Decimal(1) / 1570912, 6)
    assert mart.contract_pd == 3 * round(Decimal(1) / Decimal("43490.00"), 6)


def test_zero_population_gives_no_ratio(spark, dims):
    facts = spark.createDataFrame(
        [("t", 2002, Decimal("1.00"), "BB", 1, "1111", "X")], world.CONTRACTS)
    mart = marts.mart("state_by_year_hr", facts, dims)
    assert {(r.contract_pp, r.contract_pd) for r in mart.collect()} == {(None, None)}


def test_net_obligation(spark):
    actions = spark.createDataFrame(
        [("2019", "519130", "Recipient", Decimal(a), 36, "CA")
         for a in ("45000.00", "-20000.00", "5000.00")],
        "year string, code string, recipient string, amount decimal(18,2), district int,"
        " state string")
    net = totals.net_obligation(actions, ["year", "code", "recipient", "district", "state"])
    assert [(r.net_amount, r.n_actions) for r in net.collect()] == [(Decimal("30000.00"), 3)]


def test_facts_are_summed_before_the_only_shuffle_of_the_facts(facts, dims):
    text = plan(marts.mart("legis_by_year_hr", facts, dims))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("txn_id" in line for line in exchanges)
    assert "partial_sum" in text and "SortMergeJoin" not in text and "Cartesian" not in text


def test_unknown_mart(facts, dims):
    with pytest.raises((KeyError, ValueError)):
        marts.mart("other_hr", facts, dims)


def test_dimensions_can_be_released(spark):
    d = world.dims(spark)
    d.release()
    assert not d.labels.df.is_cached
