import hashlib
import zlib

import cases
import duckdb
import pytest

from obligo.llm import merkle


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return hashed(*[field(row.get(c)) for c in merkle.FIELDS])


def tree(nodes):
    """The last node and, per leaf, what stands before and after it at each level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, i in enumerate(at):
            run = i // 3 * 3
            paths[k].append(("".join(level[run:i]), "".join(level[i + 1:run + 3])))
            at[k] = i // 3
        level = [hashed(*level[i:i + 3]) for i in range(0, len(level), 3)]
    return level[0], paths


def tampered(row):
    text, even = row["text"], zlib.crc32(str(row["doc_id"] if row["doc_id"] is not None
                                             else "null").encode()) % 2 == 0
    return {**row, "text": text.replace("\n", "")} if even and text is not None else row


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = [tree([leaf(r) for r in by[s]]) for s in sources]
    root, upper = tree([t[0] for t in trees])
    out = []
    for s, (subroot, paths), rest in zip(sources, trees, upper):
        for r, path in zip(by[s], paths):
            path = path + rest
            node = leaf(tampered(r))
            for before, after in path:
                node = hashed(before, node, after)
            proof = hashed(*[b + a for b, a in path])
            out.append((r["doc_id"], leaf(r), subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def frame(spark, rows):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    return spark.createDataFrame([tuple(r.get(c) for c in merkle.FIELDS) for r in rows], schema)


def got(spark, docs, folder):
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return sorted(map(tuple, merkle.query(spark, folder).collect()), key=str)


def as_rows(docs):
    return [r.asDict() for r in docs.select(*merkle.FIELDS).collect()]


@pytest.mark.parametrize("sizes", [[1], [4, 1, 27, 28, 3, 10, 82, 2]])
def test_trees_of_all_shapes(spark, tmp_path, sizes):
    rows = [{"doc_id": 1000 * s - i, "source": f"s{s}" if s else None, "text": f"a\nb{i}",
             "n_chars": i} for s, n in enumerate(sizes) for i in range(n)]
    assert got(spark, frame(spark, rows), str(tmp_path)) == expected(rows)


def test_sources_are_in_the_order_of_their_bytes(spark, tmp_path):
    sources = [None, "", "Z", "a", "é", "𐀀", "￮", "="]
    rows = [{"doc_id": i, "source": s, "text": "\n" * (i % 3)} for i, s in enumerate(sources * 3)]
    assert got(spark, frame(spark, rows), str(tmp_path)) == expected(rows)


def test_awkward_rows(spark, tmp_path):
    docs = cases.awkward(spark)
    found = got(spark, docs, str(tmp_path))
    assert found == expected(as_rows(docs))
    assert {r[-1] for r in found} == {True, False}


def test_empty_table_and_text_ids(spark, tmp_path):
    assert got(spark, cases.awkward(spark).limit(0), str(tmp_path)) == []
    named = cases.awkward(spark).filter("doc_id IS NOT NULL").selectExpr(
        "'d' || doc_id AS doc_id", "source", "lang", "n_chars", "text")
    rows = as_rows(named)
    want = {r[1] for r in map(lambda r: (r["doc_id"], leaf(r)), rows)}
    assert {r[1] for r in got(spark, named, str(tmp_path))} == want


def test_paths_lead_to_the_root_and_numbers_are_dense(spark):
    docs = frame(spark, [{"doc_id": i, "source": "ab"[i % 5 == 0], "text": str(i)}
                         for i in range(100)])
    found = merkle.manifest(spark, docs.select("doc_id", "source", merkle.leaf().alias("leaf")))
    rows = found.withColumn("reached", merkle.folded(found.leaf, found.path)).collect()
    assert {r.reached for r in rows} == {r.root for r in rows} and len(rows) == 100
    for source, n in (("a", 80), ("b", 20)):
        of = sorted((r.doc_id, r.number) for r in rows if r.source == source)
        assert [x for _, x in of] == list(range(n))


@pytest.mark.skipif(not cases.HAVE_TABLES, reason="no test tables")
def test_query_equals_brute_force_and_sql(spark):
    found = merkle.query(spark, cases.MIDDLE)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{cases.MIDDLE}/documents.parquet'")
    result = duck.execute(merkle.SQL)
    names, rows = [c[0] for c in result.description], sorted(result.fetchall(), key=str)
    assert sorted(map(tuple, found.select(*names).collect()), key=str) == rows
    import pyarrow.parquet as pq

    table = pq.read_table(f"{cases.MIDDLE}/documents.parquet").to_pylist()
    assert names[:2] == ["doc_id", "leaf"] and rows == expected(table)
