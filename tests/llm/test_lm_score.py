import collections
import math
import re
import tracemalloc
import zlib

import cases
import numpy as np
import pytest

from obligo.llm import lm_score
from obligo.llm.lm_score import (
    CLASSES,
    END,
    HEADS,
    Model,
    Numbers,
    Vocabulary,
    counts_of,
    ending_of,
    expected,
    expected_at_start,
    feature_rows,
    key_of,
    observed,
    step,
)


def tokens(value):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", cases.lower(value or "")) if w] + ["\n"]


def base(pairs):
    """held out, tokens, known tokens, training tokens and base score of every row."""
    pairs = list(pairs)
    held = [zlib.crc32(("null" if i is None else str(i)).encode()) % 10 == 0 for i, _ in pairs]
    counts = collections.Counter()
    for (_, t), out in zip(pairs, held):
        if not out:
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    rows = []
    for (i, t), out in zip(pairs, held):
        words = tokens(t)
        score = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        rows.append((i, out, len(words), sum(counts[w] > 0 for w in words), n, score))
    return sorted(rows, key=str)


def compare(df, pairs):
    rows = df.collect()
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score)
                  for r in rows), key=str)
    want = base(pairs)
    got.sort(key=lambda r: (str(r[:5]), r[5]))
    want.sort(key=lambda r: (str(r[:5]), r[5]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want])
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    return rows


def test_awkward_rows(spark):
    compare(lm_score.scored(spark, cases.awkward(spark)), [(r[0], r[1]) for r in cases.ROWS])


def test_empty_table(spark):
    assert lm_score.scored(spark, cases.awkward(spark).limit(0)).count() == 0


def test_tokens_beyond_the_broadcast_are_joined(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "KNOWN", 5)
    texts = [f"the cat number{i % 11} sat on the mat{i}" for i in range(120)]
    compare(lm_score.scored(spark, cases.documents(spark, texts)), enumerate(texts))


def test_probabilities_of_all_tokens_add_up_to_one(spark):
    texts = [f"the cat{i % 7} sat on the mat{i} {'der Hund' if i % 2 else 'la casa'}"
             for i in range(200)]
    counts = counts_of(cases.documents(spark, texts).select("doc_id", "text")).cache()
    vocabulary = Vocabulary(spark, counts)
    known = {r.key: r.n for r in counts.filter("NOT pair").collect()}
    assert vocabulary.tokens == sum(len(tokens(t)) for t in texts)
    inside = np.zeros(CLASSES)
    ranks = vocabulary.ranks()
    for key, n in known.items():
        rank = ranks[key]
        inside[vocabulary.classes[rank]] += 10 ** vocabulary.inside[rank]
    # Besides, every class has a place for unknown tokens (a head only itself).
    unknown = 0.1 / 10 ** vocabulary.outside
    assert inside[:HEADS] == pytest.approx(np.ones(HEADS))
    assert (inside + unknown)[HEADS:] == pytest.approx(np.ones(CLASSES - HEADS))
    weights = np.random.default_rng(0).normal(size=(64, lm_score.OUTCOMES)).astype(np.float32)
    model, rows = Model(vocabulary.prior, weights), np.arange(40).reshape(10, 4)
    logs = np.array([model.logs(rows, np.full(10, c)) for c in range(CLASSES)])
    assert np.exp(logs).sum(0) == pytest.approx(np.ones(10), abs=1e-4)
    counts.unpersist()


def test_history_stops_at_the_begin_of_a_text():
    keys = np.array([3, 4, 5, 3, 4, 5, 3])
    rows = feature_rows(keys, np.array([0, 3, 6]), 1 << 14)
    assert (rows[0] == rows[3]).all() and (rows[1] == rows[4]).all()
    assert (rows[0] == rows[6]).all() and (rows[1] != rows[2]).any()
    assert rows.min() >= 0 and rows.max() < 1 << 14


def chain(n):
    """Classes of which most are the next of five, and what comes before them."""
    rng = np.random.default_rng(1)
    classes = np.ones(n, np.int64)
    for i in range(1, n):
        classes[i] = (classes[i - 1] + 1) % 5 * 9 if rng.random() < 0.9 else rng.integers(5) * 9
    return classes, feature_rows(classes, np.array([0]), 256)


def sums_of(rows, classes, model=None):
    """Seen outcomes or, of a model, expected ones."""
    outer, inner = np.zeros((256, 8)), np.zeros((256 * 8, 8))
    if model is None:
        observed(rows, classes, inner)
        outer = inner.sum(1).reshape(256, 8)
    else:
        expected(model, rows, classes, outer, inner)
    return np.c_[outer, inner.reshape(256, 64)]


def test_sums_are_the_two_parts_of_the_gradient():
    classes, rows = chain(300)
    prior = np.r_[np.full(8, 1 / 8), np.full(64, 1 / 8)]
    seen = sums_of(rows, classes)
    weights = np.random.default_rng(2).normal(size=seen.shape).astype(np.float32) / 4
    sums = sums_of(rows, classes, Model(prior, weights))

    def likelihood(w):
        return Model(prior, w).logs(rows, classes).sum()

    for row in np.unique(rows)[:4]:
        for outcome in (0, 3, 8, 30, 71):
            up, down = weights.copy(), weights.copy()
            up[row, outcome] += 0.05
            down[row, outcome] -= 0.05
            slope = (likelihood(up) - likelihood(down)) / 0.1
            assert seen[row, outcome] - sums[row, outcome] == pytest.approx(slope, abs=0.05)
    start = sums_of(rows, classes, Model(prior, np.zeros(seen.shape, np.float32)))
    assert expected_at_start(seen, prior) == pytest.approx(start, abs=1e-3)


def test_steps_learn_what_follows():
    classes, rows = chain(6000)
    prior = np.r_[np.full(8, 1 / 8), np.full(64, 1 / 8)]
    seen = sums_of(rows[:5000], classes[:5000])
    weights = np.zeros((256, 72), np.float32)
    means = []
    for _ in range(4):
        sums = sums_of(rows[:5000], classes[:5000], Model(prior, weights))
        weights += step(seen, sums, prior, 0.4)
        means.append(Model(prior, weights).logs(rows[5000:], classes[5000:]).mean())
    assert means == sorted(means) and means[-1] > -1.0


def test_scores_do_not_depend_on_the_partitions(spark):
    texts = [f"the cat{i % 7} sat on the mat{i} {'der Hund' if i % 2 else 'la casa'}" * (i % 5)
             for i in range(300)]
    docs = cases.documents(spark, texts)
    scores = [sorted((r.doc_id, r.score) for r in lm_score.scored(spark, d, (0.4, 0.4)).collect())
              for d in (docs.coalesce(1), docs.repartition(4), docs.repartition(32))]
    for other in scores[1:]:
        assert [x for _, x in other] == pytest.approx([x for _, x in scores[0]], rel=1e-6)


def test_every_context_of_the_training_documents_has_weights(spark):
    train = cases.documents(spark, [f"text{i} of its own" for i in range(200)])
    counts = counts_of(train.select("doc_id", "text")).cache()
    vocabulary = Vocabulary(spark, counts)
    weights = lm_score.trained_weights(spark, train, spark.sparkContext.broadcast(vocabulary))
    flat = lm_score.Flat([t.text.encode() for t in train.collect()],
                         Numbers(vocabulary.ranks()), vocabulary)
    assert (weights[flat.rows] != 0).any(2).all()
    counts.unpersist()


def test_rows_grow_with_the_vocabulary(spark):
    sizes = []
    for n in (10, 60_000):
        counts = spark.range(n).selectExpr("false AS pair", "-id - 1 AS key", "2L AS n")
        sizes.append(Vocabulary(spark, counts).rows)
    assert sizes[0] < sizes[1] <= 1 << lm_score.MOST_BITS


def test_keys_carry_the_ending_and_memory_may_be_forgotten(monkeypatch):
    keys = np.array([key_of(b"station"), key_of(b"nation"), key_of(END)])
    assert (keys < 0).all() and ending_of(keys)[0] == ending_of(keys)[1]
    monkeypatch.setattr(lm_score, "REMEMBERED", 2)
    numbers = Numbers({key_of(b"a"): 0})
    assert [numbers[w] for w in (b"a", b"b", b"c", b"a")] == [0, key_of(b"b"), key_of(b"c"), 0]


@pytest.mark.skipif(not cases.HAVE_TABLES, reason="no test tables")
def test_query_has_the_exact_base_and_beats_it_on_unseen_texts(spark):
    rows = compare(lm_score.query(spark, cases.MIDDLE), cases.given(cases.MIDDLE))
    unseen = [r for r in rows if r.held_out]
    per_token = [sum(x) / sum(r.n_tokens for r in unseen) for x in (
        [r.base_score for r in unseen], [r.score for r in unseen])]
    assert per_token[1] > per_token[0] + 0.28


def test_the_query_trains_beyond_the_step_from_zero_weights(spark):
    texts = [f"the cat sat on the mat and the dog sat on the {x}" for x in ("log", "mat", "rug")] * 60
    train = cases.documents(spark, texts)
    counts = counts_of(train.select("doc_id", "text")).cache()
    shared = spark.sparkContext.broadcast(Vocabulary(spark, counts))
    vocabulary, means = shared.value, []
    flat = lm_score.Flat([t.encode() for t in texts], Numbers(vocabulary.ranks()), vocabulary)
    for rates in (lm_score.RATES[:1], lm_score.RATES):
        weights = lm_score.trained_weights(spark, train, shared, rates)
        means.append(Model(vocabulary.prior, weights).logs(flat.rows, flat.classes).mean())
    default = lm_score.trained_weights(spark, train, shared)
    assert default == pytest.approx(weights) and means[1] > means[0] + 0.02
    counts.unpersist()


def test_many_tokens_get_the_keys_of_single_ones():
    words = [bytes(97 + (i * k) % 26 for i in range(n)) for n in range(1, 70) for k in (1, 3)]
    texts = [b"", b" ", b"\n", b"A b\x0b\x0cc\r\nd", b"\x00 x\x00", "É\x1c \x85z\xa0".encode(),
             b"  ".join(words), b"x"]
    split = [re.findall(rb"[^\x20\x09-\x0D]+", cases.lower(t.decode()).encode()) + [END]
             for t in texts]
    keys = [key_of(w) for x in split for w in x]
    lengths, numbers = Numbers().of(texts)
    assert lengths.tolist() == [len(x) for x in split] and numbers.tolist() == keys
    ranks = {k: i for i, k in enumerate(sorted(set(keys), key=str)[::2])}
    assert Numbers(ranks).of(texts)[1].tolist() == [ranks.get(k, k) for k in keys]
    assert [len(x) for x in Numbers().of([])] == [0, 0]


def test_numbers_are_stored_as_bytes_and_read_back(spark):
    texts = ["the cat sat", "", "a dog sat on the cat", "the the"] * 20
    docs = cases.documents(spark, texts)
    counts = counts_of(docs.select("doc_id", "text")).cache()
    vocabulary = Vocabulary(spark, counts)
    vocabulary.keys, vocabulary.classes = vocabulary.keys[:3], vocabulary.classes[:3]
    shared = spark.sparkContext.broadcast(vocabulary)
    rows = lm_score.numbered(docs, shared).toArrow().combine_chunks()
    assert rows.column_names == ["doc_id", "source", "known", "rare"]
    got = lm_score.Flat.of_numbers(*(rows[c].combine_chunks() for c in ("known", "rare")), vocabulary)
    ids = rows["doc_id"].to_pylist()
    want = lm_score.Flat([texts[i].encode() for i in ids], Numbers(vocabulary.ranks()), vocabulary)
    for name in ("numbers", "lengths", "begins", "classes", "rows"):
        assert (getattr(got, name) == getattr(want, name)).all()
    assert (got.numbers < 0).any() and (got.numbers >= 0).any()
    counts.unpersist()


def test_a_step_needs_little_beside_its_matrices():
    rng = np.random.default_rng(3)
    prior = np.r_[np.full(8, 1 / 8), np.full(64, 1 / 8)]
    seen = rng.random((1 << 16, lm_score.OUTCOMES), np.float32)
    tracemalloc.start()
    change = step(seen, expected_at_start(seen, prior), prior, 0.3, seen)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert change.shape == seen.shape and most < 3 * seen.nbytes
