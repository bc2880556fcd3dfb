import zlib

import cases
import numpy as np
import pytest

from obligo.llm import toxicity
from obligo.llm.toxicity import Lexicon, Trees, features, isotonic, learned_words


def test_awkward_rows(spark):
    docs, labels = cases.awkward(spark), cases.labels(spark)
    scored = toxicity.toxicity(spark, docs, labels).collect()
    assert sorted((str(r.doc_id) for r in scored)) == sorted(str(r[0]) for r in cases.ROWS)
    for r in scored:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        name = "null" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(name.encode()) % 5 == 0)
    kept = toxicity.clean_rows(spark, docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in scored)


def test_empty_tables(spark):
    docs, labels = cases.awkward(spark), cases.labels(spark)
    assert toxicity.toxicity(spark, docs.limit(0), labels).count() == 0
    assert toxicity.clean_rows(spark, docs.limit(0), labels).count() == 0
    unlabelled = toxicity.toxicity(spark, docs, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.0}


def test_label_of_a_held_out_document_changes_nothing(spark):
    texts = [f"you are an idiot number {i}" if i % 3 == 0 else f"a calm text number {i}"
             for i in range(300)]
    docs = cases.documents(spark, texts)
    marks = [(i, int(i % 3 == 0)) for i in range(300)]
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in marks]
    scores = [
        [r.score for r in toxicity.toxicity(
            spark, docs, spark.createDataFrame(m, "doc_id long, toxic int"))
         .orderBy("doc_id").collect()]
        for m in (marks, flipped)
    ]
    assert scores[0] == scores[1]
    assert all((s >= 0.5) == (i % 3 == 0) for i, s in enumerate(scores[0]))


def test_stems_are_learned_from_training_texts(spark):
    texts = [(f"plain words here {i} zqarn{'abcdefghij'[i % 10]}", 1) if i % 2 else
             (f"plain words here {i}", 0) for i in range(400)]
    train = spark.createDataFrame(texts, "text string, y int")
    found = learned_words(train)
    assert b"zqarn*" in found and b"plain" not in found
    lexicon = Lexicon(found)
    assert lexicon[b"zqarnunseen"] > 0 and lexicon[b"plain"] == 0


def test_features_see_obfuscation_and_proximity():
    lexicon, you = Lexicon({b"idiot": 2.0}), frozenset([b"you"])
    names = toxicity.FEATURES

    def of(value):
        return dict(zip(names, features(value.encode(), lexicon, you)))

    assert of("you 1d10t i.d.i.o.t id*iot")["hidden_lexicon"] >= 1
    near, far = of("you idiot"), of("you " + "x " * 30 + "idiot")
    assert near["nearest_you"] < far["nearest_you"] and near["close_share"] > far["close_share"]
    assert of("")["words"] == 0 and len(of("é" * 50_000)) == len(names)
    assert of("WHAT?!!")["shouted"] > 0 and of("WHAT?!!")["runs"] > 0


def test_trees_fit_an_interaction_and_calibration_rises():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    margin = Trees().fit(x[:2000], y[:2000]).margin(x[2000:])
    assert ((margin > 0) == (y[2000:] > 0.5)).mean() > 0.95
    at, level = isotonic(margin, y[2000:])
    assert (np.diff(at) > 0).all() and (np.diff(level) >= 0).all()
    assert 0 <= level.min() and level.max() <= 1


@pytest.mark.skipif(not cases.HAVE_TABLES, reason="no test tables")
def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    scored = toxicity.query(spark, folder).filter("held_out").toPandas()
    marks = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    both = scored.merge(marks, on="doc_id")
    toxic = both.toxic == 1
    ranks = both.score.rank()
    n = toxic.sum()
    auc = (ranks[toxic].sum() - n * (n + 1) / 2) / (n * (~toxic).sum())
    assert auc > 0.97
    assert (both.predicted[~toxic] == 0).mean() > 0.99
    assert (both.predicted[toxic] == 1).mean() > 0.8
