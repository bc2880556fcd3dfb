import cases
import numpy as np
import pytest

from obligo.llm import quality
from obligo.llm.quality import HIGH, LABELLERS, LOW, NONE, PATTERNS, Read, posterior_of, votes_of


def pattern(votes):
    return int(sum(v * 3 ** (len(votes) - 1 - i) for i, v in enumerate(votes)))


def test_votes_of_patterns():
    votes = [LOW, HIGH, NONE, LOW, NONE, HIGH, HIGH, LOW]
    assert votes_of(np.array([pattern(votes)]))[0].tolist() == votes


def test_labellers_vote_by_whole_texts():
    def votes(value):
        found = votes_of(np.array([Read(value.encode()).pattern]))[0]
        return dict(zip(LABELLERS, found.tolist()))

    assert LOW not in votes(" ".join(
        f"the cat{i} of number{i * 7} was on a mat{i} by night{i}." for i in range(40))).values()
    assert votes("word### other%%% thing&&& " * 10)["symbols"] == LOW
    assert votes("home | shop | news | about | " * 10)["lone_signs"] == LOW
    assert votes("one one one one two two two two three three three")["repeats"] == LOW
    assert votes("BUY!! THIS!! NOW!! AND!! SAVE!! MORE!! " * 3)["capitals"] == LOW
    short = votes("too short")
    assert short["repeats"] == short["sameness"] == short["long_words"] == NONE
    assert set(votes("").values()) == {NONE} and LOW not in short.values()
    assert votes("@@@@ #### $$$$ %%%%")["lone_signs"] == LOW
    assert votes("That*** atly.###")["symbols"] == LOW
    assert votes("!!!! !!!! !!!!")["lone_signs"] == LOW
    assert votes("x" * 1450)["long_words"] == LOW
    # What comes late in a long text counts as much.
    assert votes("the cat is on a mat " * 3000 + "junk### " * 30_000)["symbols"] == LOW


def test_expectation_maximisation_recovers_accuracies():
    rng = np.random.default_rng(0)
    n, kinds = 40_000, len(LABELLERS)
    truth = rng.choice(kinds + 1, n, p=[0.8, *[0.2 / kinds] * kinds])
    rates = np.full((kinds + 1, kinds), 0.1)
    rates[0] = 0.01
    rates[np.arange(kinds) + 1, np.arange(kinds)] = 0.9
    votes = np.where(rng.random((n, kinds)) < rates[truth], LOW, HIGH)
    votes[rng.random((n, kinds)) < 0.1] = NONE
    counts = np.bincount(votes @ 3 ** np.arange(kinds)[::-1], minlength=PATTERNS)
    posterior, found, shares = posterior_of(counts.astype(float))
    assert shares[0] == pytest.approx(0.8, abs=0.03)
    assert np.abs(found - rates).max() < 0.2
    high = posterior[votes @ 3 ** np.arange(kinds)[::-1]] > 0.5
    # One labeller alone often stands against seven, so some stay in doubt.
    assert (high == (truth == 0)).mean() > 0.9


def test_awkward_rows_and_empty_table(spark):
    docs = cases.awkward(spark)
    rows = quality.quality(spark, docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in cases.ROWS)
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 6)}) == 1  # no words either way
    assert quality.quality(spark, docs.limit(0)).count() == 0


def some_texts(n):
    return [f"the cat{i % 7} of number{i % 11} was on a mat{i % 5} by night." if i % 3 else
            f"junk### word%%% thing{i % 4}&&& #### other*** " * 3 for i in range(n)]


def test_scores_do_not_depend_on_the_partitions(spark):
    docs = cases.documents(spark, some_texts(300))
    found = [sorted((r.doc_id, r.score, r.kept) for r in quality.quality(spark, d).collect())
             for d in (docs.coalesce(1), docs.repartition(4), docs.repartition(32))]
    for other in found[1:]:
        assert [r[2] for r in other] == [r[2] for r in found[0]]
        assert [r[1] for r in other] == pytest.approx([r[1] for r in found[0]], abs=1e-6)


def test_scorer_equals_brute_force(spark):
    """The same rounds over plain sums of dense rows."""
    texts = some_texts(120)
    read = quality.features(cases.documents(spark, texts)).cache()
    posterior = np.linspace(0, 1, PATTERNS)
    found = quality.trained_weights(spark, read, posterior, 0.7)
    x, wanted = np.zeros((len(texts), quality.FEATURES)), np.zeros(len(texts))
    for i, t in enumerate(texts):
        one = Read(t.encode())
        np.add.at(x[i], one.ids, one.values)
        wanted[i] = posterior[one.pattern]
    used = np.flatnonzero(x.any(0))
    x, start = x[:, used], np.where(used == quality.ONE, np.log(0.7 / 0.3), 0.0)
    weights = ahead = start
    bound = (x * x.sum(1, keepdims=True)).sum(0) / 4
    for turn in range(quality.ROUNDS):
        gradient = x.T @ (wanted - 1 / (1 + np.exp(-x @ ahead)))
        new = ahead + (gradient - quality.RIDGE * (ahead - start)) / (bound + quality.RIDGE)
        weights, ahead = new, new + turn / (turn + 3) * (new - weights)
    assert found[used] == pytest.approx(weights, abs=1e-3)
    assert not found[np.setdiff1d(np.arange(quality.FEATURES), [*used, quality.ONE])].any()
    read.unpersist()


def test_every_step_lowers_the_loss(spark):
    texts = some_texts(90)
    read = quality.features(cases.documents(spark, texts)).cache()
    posterior, weights, losses = np.linspace(1, 0, PATTERNS), np.zeros(quality.FEATURES), []
    rows = [Read(t.encode()) for t in texts]
    for _ in range(4):
        p = np.array([quality.probability(weights[r.ids] @ r.values) for r in rows])
        y = np.array([posterior[r.pattern] for r in rows])
        losses.append(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum())
        gradient, bound = quality.corpus_sums(spark, read, weights, posterior)
        weights = weights + gradient / (bound + 1e-9)
    assert losses == sorted(losses, reverse=True) and losses[-1] < losses[0]
    read.unpersist()


@pytest.mark.skipif(not cases.HAVE_TABLES, reason="no test tables")
def test_agrees_with_labels_it_has_not_read(spark):
    folder = "/root/testdata/sf0.1"
    scored = quality.query(spark, folder).toPandas()
    both = scored.merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    good = both.quality == 1
    ranks, n = both.score.rank(), good.sum()
    assert (ranks[good].sum() - n * (n + 1) / 2) / (n * (~good).sum()) > 0.99
    assert both.kept[good].mean() > 0.99 and both.kept[~good].mean() < 0.15
