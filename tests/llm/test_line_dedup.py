import hashlib

import cases
import duckdb
import pytest

from obligo.llm import line_dedup

SPACE = " \t\n\x0b\x0c\r"


def expected(pairs, length=20, documents=3):
    pairs = [(i, t or "") for i, t in pairs]
    holders = {}
    for i, t in pairs:
        for line in t.split("\n"):
            key = cases.lower(line.strip(SPACE))
            if len(key) >= length:
                holders.setdefault(key, set()).add(i)
    out = []
    for i, t in pairs:
        lines, kept = t.split("\n"), []
        for line in lines:
            have = holders.get(cases.lower(line.strip(SPACE)), ())
            largest = max((x for x in have if x is not None), default=None)
            if len(have) < documents or i == largest:
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in df.collect()), key=str)


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    assert got(line_dedup.line_dedup(spark, docs)) == expected((r[0], r[1]) for r in cases.ROWS)


def test_empty_table(spark):
    assert got(line_dedup.line_dedup(spark, cases.awkward(spark).limit(0))) == []


def test_positions_ties_and_repeats_within_a_document(spark):
    shared, other = "a line that many documents share", "another line, which only two hold"
    texts = [f"{shared}\nfirst\n{shared.upper()}\x0b", f"x\n{other}\n\n{shared}", f"{shared} ",
             f"{other}\n\t{shared}\r\nend\n{shared}", "\n", shared[:19]]
    docs = cases.documents(spark, texts)
    assert got(line_dedup.line_dedup(spark, docs)) == expected(enumerate(texts))


def test_a_document_of_many_lines(spark):
    lines = [f"line number {i} of a long document" for i in range(5000)]
    texts = ["\n".join(lines), "\n".join(lines[1::2]), "\n".join(lines[::3])]
    docs = cases.documents(spark, texts)
    assert got(line_dedup.line_dedup(spark, docs)) == expected(enumerate(texts))


@pytest.mark.skipif(not cases.HAVE_TABLES, reason="no test tables")
def test_query_equals_sql_and_brute_force(spark):
    rows = sorted(tuple(r) for r in line_dedup.query(spark, cases.SMALL).collect())
    want = [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest())
            for r in expected(cases.given(cases.SMALL))]
    assert rows == sorted(want)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{cases.SMALL}/documents.parquet'")
    assert sorted(duck.execute(line_dedup.SQL).fetchall()) == rows
