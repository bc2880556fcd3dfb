import json
import random

import pytest
from obligo.sources.json_arrays import json_documents, read_json_arrays

from conftest import plan, rows

SCHEMA = "id long, name string, nested struct<a:string,list:array<struct<x:int,y:string>>>"
TEXTS = ["plain", "}{", "a \"quoted\" {brace}", "\\", "\\\\\"}", "[{},{}]", "é} \n", "", None,
         "\"", "{" * 20, "}" * 20, "\t\\u007d"]


def made(n, seed=1):
    r = random.Random(seed)
    return [{"id": i, "name": r.choice(TEXTS), "nested": r.choice([None, {
        "a": r.choice(TEXTS),
        "list": [{"x": j, "y": r.choice(TEXTS)} for j in range(r.randint(0, 4))]}])}
        for i in range(n)]


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_is_read_by_many_tasks(spark, tmp_path, small_splits, indent):
    objects = made(400)
    path = tmp_path / "array.json"
    path.write_text(json.dumps(objects, indent=indent, ensure_ascii=indent is None))
    assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 10
    found = json_documents(spark, str(path))
    assert [json.loads(r.document) for r in found.orderBy("number").collect()] == objects
    whole = spark.read.schema(SCHEMA).option("multiLine", True).json(str(path))
    assert rows(read_json_arrays(spark, str(path), SCHEMA)) == rows(whole)


def test_several_files_lines_and_empty_arrays(spark, tmp_path, small_splits):
    for i, n in enumerate((0, 1, 150)):
        (tmp_path / f"{i}.json").write_text("\n" + json.dumps(made(n, i), indent=1) + "\n\n")
    lines = made(50, 9)
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(o) for o in lines))
    found = json_documents(spark, str(tmp_path)).collect()
    got = sorted((json.loads(r.document) for r in found), key=str)
    assert got == sorted(made(1, 1) + made(150, 2) + lines, key=str)


def test_texts_are_shuffled_twice_and_never_joined(spark, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps(made(20)))
    text = plan(json_documents(spark, str(tmp_path)))
    assert text.count("Exchange hashpartitioning") == 2 and "Join" not in text
