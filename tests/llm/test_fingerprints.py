import hashlib
import re

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from obligo.llm import fingerprints
from obligo.llm.fingerprints import BINS, PLACE, as_text, likeness, signature

from conftest import plan


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def chained(*values):
    """Spark's xxhash64 over texts and longs; nothing is added for a null."""
    seed = 42
    for v in values:
        if v is None:
            continue
        data = v.encode() if isinstance(v, str) else v.to_bytes(
            4 if abs(v) < 1 << 20 else 8, "little", signed=True)
        seed = xxh64_intdigest(data, seed)
    return signed(seed)


def chained_longs(*values):
    seed = 42
    for v in values:
        seed = xxh64_intdigest(v.to_bytes(8, "little", signed=True), seed)
    return signed(seed)


def brute_signature(value):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", value) if w]
    seen, numbered = {}, []
    for i in range(len(words)):
        kmer = chained(*words[i:i + 3]) & ~PLACE
        j = seen[kmer] = seen.get(kmer, -1) + 1
        if j:
            seed = xxh64_intdigest(kmer.to_bytes(8, "little", signed=True), 42)
            own = signed(xxh64_intdigest(j.to_bytes(4, "little"), seed)) & ~PLACE
        else:
            own = kmer
        numbered.append(own | i)
    out = []
    for b in range(-BINS // 2, BINS // 2):
        least = sorted(x for x in numbered if x >> 59 == b)[:2]
        least.sort(key=lambda x: x & PLACE)
        out.append(chained_longs(*[x & ~PLACE for x in least]) & 0xFFFFFFFF if least else None)
    return out


TEXTS = ["", " \n", "one", "one two", "a b c d e f g", "x y z " * 40, "the cat the cat the cat",
         " ".join(f"w{i % 37} v{i % 11}" for i in range(500)), "é\x85ü ñ\xa0ö"]


def test_signature_is_that_of_the_definition(spark):
    docs = cases.documents(spark, TEXTS)
    got = [r.s for r in docs.orderBy("doc_id").select(signature(F.col("text")).alias("s"))
           .collect()]
    assert got == [brute_signature(t) for t in TEXTS]


def test_order_of_passages_matters_and_small_edits_do_not(spark):
    rng = np.random.default_rng(5)
    words = [f"w{x}" for x in rng.integers(5000, size=1500)]
    moved = [w for i in rng.permutation(150) for w in words[10 * i:10 * i + 10]]
    edited = ["x" if i % 300 == 7 else w for i, w in enumerate(words)]
    other = [f"v{x}" for x in rng.integers(5000, size=1500)]
    rows = [(" ".join(words), " ".join(y)) for y in (words, edited, moved, other)]
    near = [r.n for r in spark.createDataFrame(rows, "a string, b string").select(
        likeness(signature(F.col("a")), signature(F.col("b"))).alias("n")).collect()]
    assert near[0] == 1.0 and near[1] > 0.8 and near[3] == 0.0
    kmers = [{tuple(x[i:i + 3]) for i in range(len(x))} for x in (words, moved)]
    jaccard = len(kmers[0] & kmers[1]) / len(kmers[0] | kmers[1])
    assert near[2] < jaccard * 0.75  # as a set of k-mers the moved text is much nearer


def expected(pairs):
    """Key, length, hash of the edited text, by descending id, ids missing last."""
    pairs = sorted(pairs, key=lambda x: (x[0] is None, -(x[0] or 0)))
    out = []
    for k, (i, t) in enumerate(pairs):
        following = pairs[(k + 1) % len(pairs)][1]
        n = len(t) // 3
        edited = t[:len(t) - n] + following[:n]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in df.collect()), key=str)


def edited(spark, docs):
    return fingerprints.fingerprinted(spark, docs).select(
        "doc_id", F.length("text").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"))


def test_next_document_over_pieces_of_the_order(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ORDERED_TOGETHER", 7)
    texts = [(i * 3 - 50, f"Dokument {i} 日本 " * (i % 9)) for i in range(100)] + [(None, "last")]
    assert got(edited(spark, cases.documents(spark, texts))) == expected(texts)
    single = [(4, "only this one")]
    assert got(edited(spark, cases.documents(spark, single))) == expected(single)


def test_awkward_rows(spark):
    found = fingerprints.fingerprinted(spark, cases.awkward(spark)).select(
        "doc_id", as_text(F.col("sketch")).alias("f"), F.length("text").alias("n")).collect()
    assert sorted((str(r.doc_id), r.n) for r in found) == sorted(
        (str(r[0]), len(r[1] or "")) for r in cases.ROWS)
    assert len({r.f for r in found if r.n == len(cases.LONG)}) == 1
    assert fingerprints.fingerprinted(spark, cases.awkward(spark).limit(0)).count() == 0


@pytest.mark.skipif(not cases.HAVE_TABLES, reason="no test tables")
def test_query_equals_brute_force_without_python(spark):
    df = fingerprints.query(spark, cases.SMALL)
    assert "Python" not in plan(df) and "Pandas" not in plan(df) and "Arrow" not in plan(df)
    rows = df.collect()
    pairs = cases.given(cases.SMALL)
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in rows),
                  key=str) == expected(pairs)
    text = dict(pairs)
    for r in rows:
        want = ["-" if x is None else f"{x:08x}" for x in brute_signature(text[r.doc_id])]
        assert r.fingerprint == ".".join(want)
        a, b = r.fingerprint.split("."), r.edited_fingerprint.split(".")
        filled = [x for x in zip(a, b) if x != ("-", "-")]
        assert r.near_edited == pytest.approx(
            sum(x == y for x, y in filled) / len(filled) if filled else 1.0)
