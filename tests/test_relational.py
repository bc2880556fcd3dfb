from functools import partial

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obligo.sinks.tables import write_relation
from obligo.sources import catalogue
from obligo.sources.relational import (
    Connection,
    equal_depth_bounds,
    key_predicates,
    range_predicates,
    read_by_key,
    read_by_range,
    read_relation,
    read_split,
)


class Reader:
    """Stands in for a session: records what would be asked of the database."""

    def __init__(self):
        self.read = self
        self.calls = []

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        return self


SOURCE = Connection("jdbc:x", {"user": "u", "password": "secret"})


def test_predicates_split_without_overlap_or_gap(spark):
    df = spark.range(5000).select(F.col("id"), F.concat(F.lit("k"), "id").alias("name"))
    clauses = key_predicates(["id", "name"], 7, lambda c: f"CAST({c} AS STRING)")
    parts = [df.filter(c) for c in clauses]
    counts = [p.count() for p in parts]
    assert sum(counts) == 5000
    assert max(counts) < 1.3 * 5000 / 7
    union = parts[0]
    for p in parts[1:]:
        union = union.union(p)
    assert union.distinct().count() == 5000


def test_missing_key_parts_are_read_too(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
    clauses = key_predicates(["x", "y"], 3, lambda c: f"CAST({c} AS STRING)")
    assert sum(df.filter(c).count() for c in clauses) == 2


def test_predicate_count_is_checked():
    assert len(key_predicates("k", 1)) == 1
    for n in (0, 16**4 + 1):
        with pytest.raises(ValueError):
            key_predicates("k", n)


def test_what_is_asked_of_the_database():
    reader = Reader()
    read_relation(reader, SOURCE, "(SELECT code FROM naics) n")
    read_by_range(reader, SOURCE, "transaction_fpds", "id", 0, 72_000_000, 200)
    read_by_key(reader, SOURCE, "transaction_fpds", "txn_id", 200)
    (_, table, options), (_, _, ranged), (_, _, keyed) = reader.calls
    assert table == "(SELECT code FROM naics) n"
    assert options["properties"] == {"fetchsize": "10000", **SOURCE.options}
    assert (ranged["column"], ranged["lowerBound"], ranged["upperBound"],
            ranged["numPartitions"]) == ("id", 0, 72_000_000, 200)
    assert len(keyed["predicates"]) == 200


@pytest.mark.parametrize("key,kind,bounds,expected", [
    (["id"], "bigint", (3, 900), ("id", 3, 901)),
    (["id"], "decimal(12,0)", (3, 900), ("id", 3, 901)),
    (["id"], "decimal(12,2)", (3, 900), None),
    (["name"], "string", None, None),
    (["id", "name"], "bigint", None, None),
])
def test_split_reads_use_a_numeric_key(key, kind, bounds, expected):
    class Split(Reader):
        schema = T._parse_datatype_string(f"id {kind}, name string")

        def first(self):
            return bounds

    reader = Split()
    read_split(reader, SOURCE, "t", key, 6)
    _, table, options = reader.calls[-1]
    assert table == "t"
    if expected:
        assert (options["column"], options["lowerBound"], options["upperBound"]) == expected
        assert options["numPartitions"] == 6
    else:
        assert len(options["predicates"]) == 6
    reader.calls.clear()
    read_split(reader, SOURCE, "t", key, 1)
    assert [set(c[2]) for c in reader.calls] == [{"properties"}]


def test_split_read_of_an_empty_table_is_one_piece():
    class Empty(Reader):
        schema = T._parse_datatype_string("id bigint")

        def first(self):
            return None, None

    reader = Empty()
    read_split(reader, SOURCE, "t", ["id"], 4)
    assert all(set(c[2]) == {"properties"} for c in reader.calls)


def test_credentials_come_from_the_environment_and_are_not_shown(monkeypatch):
    monkeypatch.setenv("SRC_URL", "jdbc:x")
    monkeypatch.setenv("SRC_PASSWORD", "secret")
    found = Connection.from_environment("SRC")
    assert found.options == {"password": "secret"}
    assert "secret" not in repr(found)


class Writer:
    """Stands in for a DataFrame that is written."""

    def __init__(self):
        self.write = self
        self.options, self.calls, self.parts = {}, [], None

    def repartition(self, *parts):
        self.parts = parts[0]
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def jdbc(self, url, table, mode, properties):
        self.calls.append((url, table, mode))


def test_relational_sink_options():
    df = Writer()
    write_relation(df, SOURCE, "mart")
    write_relation(df, SOURCE, "mart", "append", connections=10)
    assert df.calls == [("jdbc:x", "mart", "error"), ("jdbc:x", "mart", "append")]
    assert df.options["batchsize"] == 1000
    assert df.parts == 10
    with pytest.raises(ValueError):
        write_relation(df, SOURCE, "mart", "overwrite")


def test_catalogue_scans(spark):
    relations = {
        "information_schema.tables": spark.createDataFrame(
            [("public", "a", "BASE TABLE"), ("public", "v", "VIEW"), ("other", "b", "BASE TABLE")],
            "table_schema string, table_name string, table_type string"),
        "information_schema.key_column_usage": spark.createDataFrame(
            [("a", "x", "a_key", 1)],
            "table_name string, column_name string, constraint_name string, n int"),
        "information_schema.table_constraints": spark.createDataFrame(
            [("a_key", "PRIMARY KEY", "a")],
            "constraint_name string, constraint_type string, table_name string"),
        catalogue.ROW_ESTIMATES: spark.createDataFrame(
            [(12.0, "a")], "approx_cnt float, table_name string"),
    }
    read = relations.__getitem__
    assert [tuple(r) for r in catalogue.base_tables(read).collect()] == [("a",)]
    assert [tuple(r) for r in catalogue.key_columns(read).collect()] == [("a", "x", "a_key")]
    assert [tuple(r) for r in catalogue.constraints(read).collect()] == [("a_key", "PRIMARY KEY")]
    assert [tuple(r) for r in catalogue.row_estimates(read).collect()] == [("a", 12.0)]
    assert partial(read_relation, None, SOURCE)  # how a live database is plugged in


def test_counted_rows(spark):
    counts = catalogue.counted_rows({"a": spark.range(3), "b": spark.range(0)})
    assert {r.table_name: r.approx_cnt for r in counts.collect()} == {"a": 3, "b": 0}


def test_pieces_of_equal_depth_split_skewed_ids(spark):
    """Nine tenths of the ids lie in a hundredth of their range."""
    ids = spark.range(20_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") * 500).otherwise(F.col("id") * 5).alias("id"))
    pieces = 16
    clauses = range_predicates("id", equal_depth_bounds(ids, "id", pieces))
    sizes = [ids.filter(c).count() for c in clauses]
    assert sum(sizes) == 20_000 and len(clauses) == pieces
    assert max(sizes) < 2 * 20_000 / pieces
    low, high = ids.agg(F.min("id"), F.max("id")).first()
    stride = ids.groupBy(F.floor((F.col("id") - low) * pieces / (high + 1 - low))).count()
    assert max(r["count"] for r in stride.collect()) > 10_000  # what equal strides would do


@pytest.mark.parametrize("values", [[], [None, None], [5] * 50, [1, None, 2], list(range(-9, 9))])
def test_every_row_is_in_one_piece(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "id long")
    clauses = range_predicates("id", equal_depth_bounds(rows, "id", 4))
    assert sum(rows.filter(c).count() for c in clauses) == len(values)
    assert equal_depth_bounds(rows, "id", 1) == []


def test_split_of_equal_depth_hands_over_the_ranges(spark):
    """The key column is read by strides first, then the table by the ranges of its quantiles."""
    asked = []

    class Reader:
        def jdbc(self, url, relation, **options):
            asked.append((relation, options))
            if "bounds" in relation:
                return spark.createDataFrame([(0, 99)], "lo long, hi long")
            return spark.range(100).withColumnRenamed("id", "k")

    class Session:
        read = Reader()

    read_split(Session(), Connection("jdbc:x"), "t", ["k"], 4, equal_depth=True)
    assert asked[-2][0] == "(SELECT k FROM t) keys" and asked[-2][1]["numPartitions"] == 4
    assert asked[-1][0] == "t" and len(asked[-1][1]["predicates"]) == 4


def test_numbers_beyond_64_bits_are_split_by_hash(spark):
    asked = []

    class Reader:
        def jdbc(self, url, relation, **options):
            asked.append(options)
            return spark.createDataFrame([], "k decimal(30,0)")

    class Session:
        read = Reader()

    read_split(Session(), Connection("jdbc:x"), "t", ["k"], 4)
    assert "md5" in asked[-1]["predicates"][0]


def test_row_counts_from_footers_read_no_data(spark, tmp_path):
    spark.range(1000).selectExpr("id", "repeat('x', 50) AS t").repartition(4).write.parquet(
        f"{tmp_path}/a")
    spark.range(0).write.parquet(f"{tmp_path}/b")
    found = catalogue.footer_estimates(spark, {"a": f"{tmp_path}/a", "b": f"{tmp_path}/b"})
    size = sum(f.stat().st_size for f in (tmp_path / "a").glob("*.parquet"))
    got = {r.table_name: tuple(r)[1:] for r in found.collect()}
    assert got == {"a": (1000, 4, size), "b": (0, 0, 0)}
    assert "ReadSchema: struct<>" in found._jdf.queryExecution().executedPlan().toString()
