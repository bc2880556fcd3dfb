import hashlib

import cases
import duckdb
import numpy as np
import pytest

from obligo.llm import exact_dedup
from obligo.llm.exact_dedup import ExactDedup, layers, slots_of


def decided(df):
    return sorted(
        ((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()),
        key=str,
    )


def expected(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(cases.lower(t or ""), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = [keep]
        for i in ids:
            kept = i in left
            if kept:
                left.remove(i)
            out.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    want = expected((r[0], r[1]) for r in cases.ROWS)
    assert decided(exact_dedup.exact_dedup(spark, docs)) == want
    kept = ExactDedup(spark, docs).kept_rows(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        (w[0] for w in want if w[3]), key=str)


def test_empty_table(spark):
    docs = cases.awkward(spark).limit(0)
    assert decided(exact_dedup.exact_dedup(spark, docs)) == []
    assert ExactDedup(spark, docs).kept_rows(docs).count() == 0


def test_slices_give_the_same(spark):
    texts = [f"Text {i % 7000}" for i in range(9000)]
    docs = cases.documents(spark, texts)
    sliced = ExactDedup(spark, docs, filter_bytes=1 << 12)
    assert sliced.filters.slices > 2
    assert decided(sliced.decisions()) == expected(enumerate(texts))
    assert sorted(r.doc_id for r in sliced.kept_rows(docs).collect()) == list(range(2000, 9000))


def test_every_slice_reads_its_own_folder_once_per_pass(spark, monkeypatch):
    docs = cases.documents(spark, [f"Text {i % 9000}" for i in range(12_000)])
    read, made = [], exact_dedup.Filters.part

    def part(self, path, i, columns):
        found = made(self, path, i, columns)
        files = found.inputFiles() if found is not None else []
        assert all(f"slice={i}/" in f for f in files)
        read.append((path, i))
        return found

    monkeypatch.setattr(exact_dedup.Filters, "part", part)
    dedup = ExactDedup(spark, docs, filter_bytes=1 << 11)
    assert dedup.filters.slices > 9
    assert len(read) == len(set(read)) == dedup.filters.slices
    kept = dedup.kept_rows(docs)
    assert len(read) == len(set(read)) == 2 * dedup.filters.slices
    assert kept.count() == 9000 and len(read) == 2 * dedup.filters.slices


def test_single_texts_pass_the_filter_unshuffled(spark):
    docs = cases.documents(spark, [f"Text {i}" for i in range(5000)] + ["copy"] * 3000)
    dedup = ExactDedup(spark, docs)
    flagged = dedup.filters.flagged(docs.withColumn("digest", exact_dedup.digest()))
    singles = flagged.filter(~flagged.maybe)
    assert 4800 < singles.count() <= 5000
    assert singles.filter("text = 'copy'").count() == 0


def test_a_digest_met_twice_has_all_its_slots_in_the_second_layer():
    digests = [bytes([i]) * 32 for i in range(200)]
    for some in (digests[:3], digests[:50]):
        once, again = layers(slots_of(some + some[:2], 1 << 16).astype(np.int64))
        for d in some[:2]:
            assert set(slots_of([d], 1 << 16)[0].tolist()) <= set(again.tolist())
        assert not set(once) & set(again)


@pytest.mark.skipif(not cases.HAVE_TABLES, reason="no test tables")
def test_query_equals_sql_and_brute_force(spark):
    got = decided(exact_dedup.query(spark, cases.SMALL))
    assert got == expected(cases.given(cases.SMALL))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{cases.SMALL}/documents.parquet'")
    columns = "doc_id, keep_id, group_size, kept, text_sha256"
    assert sorted(duck.execute(f"SELECT {columns} FROM ({exact_dedup.SQL})").fetchall(),
                  key=str) == got
