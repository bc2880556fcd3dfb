from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import world
from obligo.operators import enrich
from obligo.operators.joins import Sized
from obligo.schemas import CONTRACT_DETAIL, GRANT_DETAIL

from conftest import plan, rows


@pytest.fixture(scope="module")
def facts(spark):
    return world.contracts(spark).cache()


@pytest.fixture(scope="module")
def dims(spark):
    return world.dims(spark)


@pytest.mark.parametrize("n_bytes", [1, 10**12])
def test_labels_with_contracts_is_labels_left_join_contracts(spark, facts, n_bytes):
    labels = world.labels(spark)
    expected = labels.join(facts, "code", "left")
    got = enrich.labels_with_contracts(facts, Sized(labels, n_bytes))
    assert rows(got.select(*expected.columns)) == rows(expected)
    unused = got.filter("code = '9999'").collect()
    assert len(unused) == 1 and unused[0].txn_id is None


def test_contracts_are_not_shuffled_for_their_labels(facts, dims):
    joined = enrich.labels_with_contracts(facts.select("code", "txn_id"), dims.labels)
    exchanges = [line for line in plan(joined).splitlines() if "Exchange hashpartitioning" in line]
    assert not any("txn_id" in line for line in exchanges)


def test_detail_keeps_contracts_without_legislator_and_repeats(spark, facts, dims):
    expected = (
        world.labels(spark).join(facts, "code", "left")
        .join(world.legislators(spark), ["state", "district", "year"], "left")
    )
    got = enrich.contract_detail(facts, dims.labels, dims.legislators)
    assert got.columns == CONTRACT_DETAIL
    assert got.count() == expected.count()
    assert got.filter("firstname is null and txn_id is not null").count() > 0
    distinct = enrich.contract_detail(facts, dims.labels, dims.legislators, dedup=True)
    assert distinct.count() == expected.distinct().count() < expected.count()
    assert dict(got.dtypes)["year"] == dict(got.dtypes)["district"] == "string"


def test_grants_match_by_number_but_keep_their_district(spark, dims):
    grants = spark.createDataFrame(
        [("g1", 2001, Decimal("1.00"), "AA", "09", "Title", "USA"),
         ("g2", 2001, Decimal("1.00"), "AA", "ZZ", "Title", "USA"),
         ("g3", 2001, Decimal("1.00"), "AA", "AA10", "Title", "USA")],
        "txn_id string, year bigint, amount decimal(18,2), state string, district string,"
        " industry string, country_code string")
    got = enrich.grant_detail(grants, dims.legislators)
    assert got.columns == GRANT_DETAIL
    assert sorted((r.txn_id, r.district, r.lastname) for r in got.collect() if r.lastname) == [
        ("g1", "09", "One"), ("g1", "09", "One"), ("g1", "09", "Two")]
    assert {r.txn_id: r.district for r in got.collect()} == {"g1": "09", "g2": "ZZ", "g3": "AA10"}
    assert {r.country_code for r in got.collect()} == {"USA"}


@pytest.mark.parametrize("chamber", ["rep", "sen"])
@pytest.mark.parametrize("distinct", ["holders", "rows"])
def test_enriched_is_the_distinct_of_the_literal_join(spark, facts, dims, chamber, distinct):
    literal = world.combined(spark, facts).filter(F.col("typeofrep") == chamber).distinct()
    got = enrich.enriched(facts, dims, chamber, distinct=distinct)
    assert rows(got.select(*literal.columns)) == rows(literal)
    assert literal.isEmpty() == (chamber == "sen")


def test_distinct_rows_also_removes_repeated_transactions(facts, dims):
    twice = facts.union(facts)
    once = enrich.enriched(facts, dims, "rep").count()
    assert enrich.enriched(twice, dims, "rep").count() == 2 * once
    assert enrich.enriched(twice, dims, "rep", distinct="rows").count() == once
    with pytest.raises(ValueError):
        enrich.enriched(facts, dims, "rep", distinct="other")


def test_equal_amounts_of_separate_actions_survive(spark, dims):
    facts = spark.createDataFrame(
        [(f"t{i}", 2001, Decimal("5.00"), "AA", 9, "1111", "X") for i in range(3)],
        world.CONTRACTS)
    got = enrich.enriched(facts, dims, "rep").filter("lastname = 'One'")
    assert got.agg(F.sum("amount")).first()[0] == Decimal("15.00")


def test_each_senator_of_a_state_gets_the_contract(spark, facts, dims):
    senators = world.legislators(spark).filter("typeofrep = 'sen'").drop("district")
    expected = facts.join(senators, ["state", "year"], "left")
    got = enrich.with_senator(facts, dims.legislators)
    assert rows(got.select(*expected.columns)) == rows(expected)
    assert {r.lastname for r in got.filter("state = 'CC'").collect()} == {None}


def test_left_joins_keep_every_contract_once(facts, dims):
    assert enrich.with_industry(facts, dims.labels).count() == facts.count()
    assert enrich.with_state(facts, dims.states).count() == facts.count()
    assert enrich.with_state(facts, dims.states).filter("state_name is null").count() > 0
