import json
from argparse import Namespace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import world
from obligo import jobs
from obligo.plans import marts, serving
from obligo.plans.refresh import register_views
from obligo.session import scratch_folder, size_shuffles
from obligo.sinks.tables import read_snapshots
from obligo.sources.transactions import clean_contracts, project_contracts

from conftest import rows


def document(r):
    term = {"type": r.typeofrep, "state": r.state, "party": r.party,
            "start": f"{r.year}-01-03", "end": f"{r.year}-12-31"}
    if r.district is not None:
        term["district"] = r.district
    return {"name": {"first": r.firstname, "last": r.lastname}, "terms": [term]}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Source tables and legislator files as they would be delivered."""
    root = tmp_path_factory.mktemp("input")
    raw = world.contracts(spark, 200).selectExpr(
        "txn_id", "CAST(year AS STRING) || '-01-02' AS action_date",
        "amount AS federal_action_obligation", "state AS legal_entity_state_code",
        "state || lpad(CAST(district AS STRING), 2, '0') AS legal_entity_congressional",
        "code || '30' AS naics", "'Title' AS cfda_title", "'USA' AS legal_entity_country_code")
    raw.drop("cfda_title").write.parquet(f"{root}/transaction_fpds")
    raw.drop("naics").withColumn(
        "legal_entity_congressional", F.substring("legal_entity_congressional", 3, 2)
    ).write.parquet(f"{root}/transaction_fabs")
    world.labels(spark).withColumn("year", F.lit(2017)).write.parquet(f"{root}/naics")
    world.states(spark).selectExpr(
        "state AS code", "state_name AS name", "population", "median_household_income",
        "2010 AS year").write.parquet(f"{root}/state_data")
    people = [document(r) for r in world.legislators(spark).collect()]
    (root / "legislators-current.json").write_text(json.dumps(people[:5], indent=1))
    (root / "legislators-historical.json").write_text(json.dumps(people[5:], indent=1))
    return str(root)


def test_detail_jobs(spark, folder, tmp_path):
    for job, name in (("contracts", "govcontract_data"), ("grants", "govgrant_data")):
        jobs.main([job, "--input", folder, "--output", str(tmp_path)])
        written = spark.read.parquet(f"{tmp_path}/{name}")
        assert written.count() > 0
        assert written.filter("lastname is not null").count() > 0 or name == "govcontract_data"
        files = list((tmp_path / name).glob("chunk=*/*.parquet"))
        assert len(files) == len(list((tmp_path / name).glob("chunk=*")))


def test_marts_job_and_the_published_sql(spark, folder, tmp_path):
    jobs.main(["marts", "--input", folder, "--output", str(tmp_path), "--date", "2020-01-05"])
    raw = spark.read.parquet(f"{folder}/transaction_fpds")
    expected = marts.mart("legis_by_year_hr", clean_contracts(project_contracts(raw)),
                          world.dims(spark))
    got = read_snapshots(spark, f"{tmp_path}/legis_by_year_hr").drop("snapshot_date")
    assert rows(got) == rows(expected) != []

    register_views(spark, str(tmp_path))
    listed = spark.sql("SELECT DISTINCT description FROM legis_by_year_hr"
                       " WHERE description != 'None' ORDER BY description")
    assert rows(listed) == rows(serving.industry_list(expected))
    series = spark.sql(
        "SELECT year, party, description, SUM(amount) AS amount FROM indus_by_year_hr"
        " WHERE description = :industry GROUP BY year, party, description ORDER BY year, party",
        args={"industry": "Mining"})
    assert rows(series) == rows(
        serving.industry_party_series(spark.table("indus_by_year_hr"), "Mining")) != []


@pytest.fixture
def clean(spark):
    """Nothing stays of a job but its result."""
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    root = Path(scratch_folder(spark))
    jobs_before = set(root.glob("job-*"))
    yield
    assert set(root.glob("job-*")) == jobs_before
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() <= before


def test_jobs_on_tables_without_an_id(spark, folder, tmp_path, clean):
    source = tmp_path / "in"
    for name in ("transaction_fpds", "transaction_fabs"):
        spark.read.parquet(f"{folder}/{name}").selectExpr(
            "* EXCEPT (txn_id)", "substr(txn_id, 1, 2) AS award", "substr(txn_id, 3) AS action"
        ).write.parquet(f"{source}/{name}")
    for name in ("naics", "state_data"):
        spark.read.parquet(f"{folder}/{name}").write.parquet(f"{source}/{name}")
    for which in ("current", "historical"):
        people = json.loads(Path(f"{folder}/legislators-{which}.json").read_text())
        (source / f"legislators-{which}.json").write_text(
            "\n".join(json.dumps(p) for p in people))
    key = ["--key", "award", "action", "--lines"]
    jobs.main(["contracts", "--input", str(source), "--output", str(tmp_path), *key])
    jobs.main(["grants", "--input", str(source), "--output", str(tmp_path), *key])
    jobs.main(["refresh", "--input", str(source), "--output", str(tmp_path / "store"), *key,
               "--date", "2020-01-05"])
    ids = read_snapshots(spark, f"{tmp_path}/store/transactions").select("txn_id")
    assert ids.count() == ids.distinct().count() == 200
    jobs.main(["marts", "--input", str(source), "--output", str(tmp_path / "marts"), *key,
               "--date", "2020-01-05"])
    jobs.main(["marts", "--input", folder, "--output", str(tmp_path / "given"),
               "--date", "2020-01-05"])
    for name in marts.MARTS:
        assert rows(read_snapshots(spark, f"{tmp_path}/marts/{name}")) == rows(
            read_snapshots(spark, f"{tmp_path}/given/{name}"))


def test_results_to_a_database(spark, folder, monkeypatch, clean):
    monkeypatch.setenv("DST_URL", "jdbc:x")
    calls = []
    monkeypatch.setattr(jobs, "write_relation", lambda df, target, name, mode, *more: calls.append(
        (target.url, name, mode, more, df.columns)))
    jobs.main(["contracts", "--input", folder, "--to", "DST"])
    jobs.main(["marts", "--input", folder, "--to", "DST", "--date", "2020-01-05"])
    (url, name, mode, more, _), *built = calls
    assert (url, name, mode, more) == ("jdbc:x", "govcontract_data", "error", (100, "txn_id"))
    assert [c[1] for c in built] and {c[1] for c in built} == set(marts.MARTS)
    assert all(c[2] == "append" and c[4][-1] == "snapshot_date" for c in built)


def test_refresh_job(spark, folder, tmp_path):
    for date in ("2020-01-05", "2020-02-05"):
        jobs.main(["refresh", "--input", folder, "--output", str(tmp_path), "--date", date])
    assert read_snapshots(spark, f"{tmp_path}/transactions").count() == 200


def test_missing_arguments(tmp_path):
    for arguments in (["marts", "--output", "x"], ["copy", "--output", "x"],
                      ["contracts", "--input", "x"], ["refresh", "--date", "d", "--to", "X"]):
        with pytest.raises(SystemExit):
            jobs.main(arguments)


def test_shuffles_are_sized(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 10**9) == 200
        assert size_shuffles(spark, 100 * 10**12) == 186265
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_facts_are_split_where_they_come_from_a_database(monkeypatch):
    monkeypatch.setenv("SRC_URL", "jdbc:x")
    calls = []

    class Reader:
        def jdbc(self, url, relation, **options):
            calls.append((relation, options))

    class Session:
        read = Reader()

    options = Namespace(source="SRC", range=["id", "0", "72000000"], key=["txn_id"])
    jobs.table(Session, options, "transaction_fpds")
    jobs.table(Session, options, "naics")
    options.range = None
    jobs.table(Session, options, "transaction_fabs")
    (_, ranged), (name, plain), (_, hashed) = calls
    assert ranged["column"] == "id" and ranged["upperBound"] == 72_000_000
    assert name == "naics" and set(plain) == {"properties"}
    assert len(hashed["predicates"]) == ranged["numPartitions"] == 200
