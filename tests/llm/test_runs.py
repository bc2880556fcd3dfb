import hashlib
import random
import zlib

import cases
import numpy as np
import pytest

from obligo.llm import runs
from obligo.llm.runs import Grammar, word_runs


def brute(words):
    """Runs by comparing all words at every distance; of one stretch the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(24, 3 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e, q) for (s, e), q in found.items())


def some_words(rng):
    kinds = rng.choice([1, 2, 3, 5, 30])
    words = [rng.randrange(kinds) for _ in range(rng.randint(0, 260))]
    for _ in range(rng.randint(0, 4)):
        at = rng.randrange(len(words) + 1)
        block = words[at:at + rng.randint(1, 40)]
        if block:
            words[at:at] = (block * 150)[:rng.randint(0, 150)]
    if rng.random() < 0.3:
        words = words * rng.randint(1, 4)
    if rng.random() < 0.1:
        a, b = [0], [0, 1]
        for _ in range(rng.randint(3, 11)):
            a, b = b, b + a
        words = b
    return words


def side_by_side(texts):
    numbers, borders, used = [], [0], 0
    for words in texts:
        numbers += [w + used for w in words]
        used += max(words, default=0) + 1
        borders.append(len(numbers))
    return np.array(numbers, np.int64), np.array(borders)


def expanded(grammar):
    """The words that the symbols which are left derive."""
    stack, out = list(grammar.symbols[::-1]), []
    while stack:
        symbol = stack.pop()
        if symbol < grammar.words:
            out.append(symbol)
        else:
            rule = symbol - grammar.words
            stack += [grammar.right[rule], grammar.left[rule]]
    return out


def test_runs_of_made_texts_are_those_of_brute_force():
    rng, total = random.Random(5), 0
    for _ in range(250):
        texts = [some_words(rng) for _ in range(rng.randint(1, 5))]
        words, borders = side_by_side(texts)
        want = sorted(((s + b, e + b, q) for b, t in zip(borders.tolist(), texts)
                       for s, e, q in brute(t)), key=lambda r: (r[0], r[2]))
        assert [tuple(r) for r in word_runs(words, borders).tolist()] == want, texts
        total += len(want)
    assert total > 300


def test_the_grammar_derives_the_texts_and_leaves_no_pair_twice():
    rng = random.Random(6)
    for _ in range(50):
        words, borders = side_by_side([some_words(rng) for _ in range(3)])
        if not len(words):
            continue
        grammar = Grammar(words)
        assert expanded(grammar) == words.tolist()
        pairs = list(zip(grammar.symbols[:-1], grammar.symbols[1:]))
        assert len(set(pairs)) == len(pairs)
        assert set(borders[:-1][np.diff(borders) > 0]) <= set(grammar.places)
        for r, at in enumerate(grammar.first):
            size = grammar.length[grammar.words + r]
            half = grammar.length[grammar.left[r]]
            assert size == half + grammar.length[grammar.right[r]] and at + size <= len(words)


def test_a_repeated_word_takes_few_rules():
    words = np.zeros(200_000, np.int64)
    assert len(Grammar(words).left) < 40
    assert word_runs(words, np.array([0, len(words)])).tolist() == [[0, 200_000, 1]]


def test_limits_of_length_and_period():
    def found(words):
        numbers, borders = side_by_side([words])
        return word_runs(numbers, borders).tolist()

    assert found([0] * 23) == [] and found([0] * 24) == [[0, 24, 1]]
    eleven = list(range(11))
    assert found((eleven * 4)[:32]) == [] and found((eleven * 4)[:33]) == [[0, 33, 11]]
    assert found([20, *(eleven * 4), 30]) == [[1, 45, 11]]


def collected(df):
    return {r.doc_id: r for r in df.collect()}


def test_collapsed_text_keeps_the_first_period(spark):
    text = "start\n" + "one two  three\t" * 9 + "end"
    row = collected(runs.periodic_runs(spark, cases.documents(spark, [text])))[0]
    assert [tuple(r) for r in row.runs] == [(1, 27, 3)]
    assert row.collapsed == "start one two three end"


def test_awkward_rows_and_empty_table(spark):
    docs = cases.awkward(spark)
    found = runs.periodic_runs(spark, docs).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in cases.ROWS)
    for r in found:
        assert [tuple(x) for x in r.runs] == ([(0, 200_000, 1)] if r.doc_id == 5 else [])
    assert {r.collapsed for r in found if r.doc_id in (1, 5, 6)} == {"", "word"}
    assert runs.periodic_runs(spark, docs.limit(0)).count() == 0
    named = docs.withColumn("doc_id", docs.doc_id.cast("string"))
    assert runs.periodic_runs(spark, named).schema["doc_id"].dataType.simpleString() == "string"


def altered(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_words_are_repeated_as_stated(spark):
    texts = [f"\x0b w{i}  a\n" + " ".join(f"x{j}" for j in range(i % 60)) + " y z\x1c"
             for i in range(400)]
    made = collected(runs.made_periodic(cases.documents(spark, [*texts, "", None])))
    for i, t in enumerate([*texts, ""]):
        assert made[i].text.encode().split() == altered(i, t.encode().split())
    assert made[401].text == ""


@pytest.mark.skipif(not cases.HAVE_TABLES, reason="no test tables")
def test_query_equals_brute_force(spark):
    rows, texts = collected(runs.query(spark, cases.SMALL)), dict(cases.given(cases.SMALL))
    assert rows.keys() == texts.keys()
    some = 0
    for doc_id, r in rows.items():
        words = altered(doc_id, (texts[doc_id] or "").encode().split())
        if len(words) > 3000:
            continue  # brute force takes the square of the words
        found = brute(words)
        some += bool(found)
        spelled = "".join(f"{s},{e - s},{q}\n" for s, e, q in
                          sorted(found, key=lambda x: (x[0], x[2])))
        dropped = {i for s, e, q in found for i in range(s + q, e)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
        best = min(found, default=None, key=lambda x: (-(x[1] - x[0]) / x[2], x[0], x[2]))
        s, e, q = best or (None, None, None)
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (
            len(found), s, best and e - s, q, best and 1000 * (e - s) // q)
        assert r.runs_sha256 == hashlib.sha256(spelled.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
    assert some > 5
