"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text are densities of a lexicon, the proximity of its words to a second person,
rates of capitals, of punctuation and of obfuscated words. The lexicon has three parts: a fixed
list of plain insults, and the words and word beginnings that stand out in toxic training
documents. It is learned, and the trees are fitted, on at most TRAIN_ROWS labelled rows, drawn by
a hash of the id; their scores on held-back parts of these rows give the calibration. Features of
all rows are computed in one pass over whole texts.

Defined cases: a null or empty text has features of zero words and gets a score like any other;
labels that are null or whose document is missing are ignored, of several labels of one id the
largest counts; without a label of both kinds every score is the share of toxic labels (0 without
any); repeated rows give repeated rows; a null id counts as the text 'null' in the checksum and
never joins a label.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obligo.llm.common import (
    LOWER_BYTES,
    ROW,
    byte_texts,
    checksum_mod,
    documents,
    given_back,
    prepare,
    text,
    whole_rows,
)
from obligo.sinks.tables import stored

HELD_OUT_FOLDS = 5
# Labelled rows the trees are fitted on at most (a documented bound of the classifier).
TRAIN_ROWS = 40_000
# A learned word has at least so many documents and a log-odds z value of at least so much.
LEAST_DOCUMENTS, LEAST_Z, LEARNED_WORDS = 8, 5.0, 2_000
# Lengths in bytes of the word beginnings, and what marks them in the lexicon.
STEMS, STEM = (4, 5, 6), b"*"
INSULT_WEIGHT = 2.0
# Words whose weight a task remembers.
REMEMBERED = 150_000
THRESHOLD = 0.5

# Plain insults and second-person words of the languages at hand (fixed values).
INSULTS = """
idiot idiots moron morons stupid dumb loser losers scum clown pathetic worthless trash garbage
disgusting filthy imbecile fool jerk hate kill vermin ugly retard bastard
""".split()
SECOND_PERSON = """
you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre vos usted
ustedes tus ti
""".split()
# Signs that stand for letters in obfuscated words (fixed values).
LOOKALIKES = bytes.maketrans(b"013457@$!", b"oieastasi")

NOT_WORD = bytes(i for i in range(128) if not (chr(i).isalnum()))
TO_SPACE = bytes.maketrans(NOT_WORD, b" " * len(NOT_WORD))
OBFUSCATED = re.compile(rb"(?<![^\s])[A-Za-z]+(?:[0-9@$!*_.#-]+[A-Za-z]+)+(?![^\s.,;:!?])")
SPACED = re.compile(rb"(?<![A-Za-z])(?:[A-Za-z][ .*_-]){2,}[A-Za-z](?![A-Za-z])")
NOT_LETTERS = bytes(i for i in range(128) if not chr(i).isalpha())
SHOUTED = re.compile(rb"\b[A-Z]{3,}\b")
RUNS = re.compile(rb"[!?]{2,}|(?:[#%&*$@]){3,}")
FEATURES = """
words lexicon_density lexicon_count distinct_lexicon strongest learned_sum learned_mean you_density
nearest_you close_share capitals shouted exclaims questions punctuation runs digits obfuscated
hidden_lexicon word_length
""".split()
WINDOW = 6


class Lexicon(dict):
    """Weights of words: their own or that of their longest known beginning, else zero."""

    def __init__(self, known: dict[bytes, float]):
        super().__init__()
        self.known = known

    def __missing__(self, word: bytes) -> float:
        weight = self.known.get(word, 0.0)
        if not weight and len(word) >= STEMS[0]:
            weight = next((x for k in reversed(STEMS) if (x := self.known.get(word[:k] + STEM))),
                          0.0)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = weight
        return weight


def features(data: bytes, lexicon: Lexicon, you: frozenset[bytes]) -> list[float]:
    """The feature values of one text, in the order of FEATURES."""
    lowered = data.translate(LOWER_BYTES)
    words = lowered.translate(TO_SPACE).split()
    n = max(len(words), 1)
    hits = [i for i, w in enumerate(words) if lexicon[w]]
    weights = [lexicon[words[i]] for i in hits]
    seconds = np.array([i for i, w in enumerate(words) if w in you], np.int64)
    nearest, close = 50.0, 0.0
    if hits and len(seconds):
        at = np.searchsorted(seconds, hits)
        left = np.abs(np.array(hits) - seconds[np.maximum(at - 1, 0)])
        right = np.abs(seconds[np.minimum(at, len(seconds) - 1)] - np.array(hits))
        gaps = np.minimum(left, right)
        nearest, close = float(min(gaps.min(), 50)), float((gaps <= WINDOW).mean())
    bytes_of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters = max(int(bytes_of[65:91].sum() + bytes_of[97:123].sum()), 1)
    size = max(len(data), 1)
    odd = OBFUSCATED.findall(data)
    spaced = SPACED.findall(data)
    hidden = sum(
        1 for w in odd
        if lexicon[(x := w.translate(LOWER_BYTES)).translate(LOOKALIKES, b"*_.#-")]
        or lexicon[x.translate(None, NOT_LETTERS)]
    ) + sum(1 for w in spaced if lexicon[w.translate(LOWER_BYTES, NOT_LETTERS)])
    signs = int(bytes_of[33:48].sum() + bytes_of[58:65].sum())
    return [
        np.log1p(len(words)), 100 * len(hits) / n, len(hits), len({words[i] for i in hits}),
        max(weights, default=0.0), sum(weights), 100 * sum(weights) / n, 100 * len(seconds) / n,
        nearest, close, bytes_of[65:91].sum() / letters, 100 * len(SHOUTED.findall(data)) / n,
        100 * bytes_of[33] / size, 100 * bytes_of[63] / size, 100 * signs / size,
        100 * len(RUNS.findall(data)) / n, 100 * bytes_of[48:58].sum() / size,
        100 * (len(odd) + len(spaced)) / n, hidden, len(lowered) / n,
    ]


# -- trees --------------------------------------------------------------------------------

BINS = 64


class Trees:
    """Boosted regression trees for the logistic loss, over binned features."""

    def __init__(self, rounds: int = 80, depth: int = 4, rate: float = 0.1, least: float = 2.0):
        self.rounds, self.depth, self.rate, self.least = rounds, depth, rate, least

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)],
                        1).astype(np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.start = float(np.log(share / (1 - share)))
        self.trees = []
        b, margin = self.binned(x), np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            tree, step = self._grow(b, y - p, p * (1 - p))
            self.trees.append(tree)
            margin += self.rate * step
        return self

    def _grow(self, b, gradient, curvature):
        """One tree, level by level; a node is (feature, bin) and a leaf a value."""
        node = np.zeros(len(b), np.int64)
        split, value = {}, {}
        columns = b.shape[1]
        for _ in range(self.depth):
            ids = np.unique(node)
            ids = ids[[i not in value for i in ids]]
            for i in ids:
                rows = np.flatnonzero(node == i)
                flat = (b[rows] + np.arange(columns) * BINS).ravel()
                g = np.bincount(flat, np.repeat(gradient[rows], columns), columns * BINS)
                h = np.bincount(flat, np.repeat(curvature[rows], columns), columns * BINS)
                g, h = g.reshape(columns, BINS).cumsum(1), h.reshape(columns, BINS).cumsum(1)
                gt, ht = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + 1) + (gt - g)**2 / (ht - h + 1) - gt**2 / (ht + 1)
                gain[(h < self.least) | (ht - h < self.least)] = -np.inf
                f, c = np.unravel_index(np.argmax(gain), gain.shape)
                if gain[f, c] <= 1e-6:
                    continue
                split[int(i)] = (int(f), int(c))
                node[rows] = 2 * i + 1 + (b[rows, f] > c)
        out = np.zeros(len(b))
        for i in np.unique(node):
            rows = node == i
            value[int(i)] = float(gradient[rows].sum() / (curvature[rows].sum() + 1))
            out[rows] = value[int(i)]
        return (split, value), out

    def margin(self, x: np.ndarray) -> np.ndarray:
        b, out = self.binned(x), np.full(len(x), self.start)
        for split, value in self.trees:
            node = np.zeros(len(b), np.int64)
            for i in sorted(split):
                f, c = split[i]
                rows = node == i
                node[rows] = 2 * i + 1 + (b[rows, f] > c)
            out += self.rate * np.array([value.get(i, 0.0) for i in node.tolist()])
        return out


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing step fit of the label on the margin, for interpolation."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, sum of margins
    for m, label in zip(margin[order], y[order]):
        blocks.append([float(label), 1.0, float(m)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    # A label more of either kind keeps small blocks away from 0 and 1.
    share = y.mean()
    at = np.array([m / n for _, n, m in blocks])
    level = np.array([(s + share) / (n + 1) for s, n, _ in blocks])
    return at, np.maximum.accumulate(level)


class Model:
    def __init__(self, x: np.ndarray, y: np.ndarray, part: np.ndarray):
        self.share = float(y.mean()) if len(y) else 0.0
        self.trees = None
        if len(y) == 0 or y.min() == y.max():
            return
        folds = [part == k for k in range(3)]
        if all(0 < y[~f].mean() < 1 for f in folds if f.any() and (~f).any()):
            unseen = np.zeros(len(y))
            for f in folds:
                if f.any() and (~f).any():
                    unseen[f] = Trees().fit(x[~f], y[~f]).margin(x[f])
        else:
            unseen = Trees().fit(x, y).margin(x)
        self.at, self.level = isotonic(unseen, y)
        self.trees = Trees().fit(x, y)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.share)
        return np.clip(np.interp(self.trees.margin(x), self.at, self.level), 0.0, 1.0)


# -- the jobs -----------------------------------------------------------------------------


def labelled(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """doc_id, text and label of at most about ``rows`` training rows, drawn by a hash of the id."""
    marks = (
        labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("y"))
        .filter("y IS NOT NULL AND label_id IS NOT NULL")
        .groupBy("label_id").agg(F.max("y").alias("y"))
        .filter(F.crc32(F.col("label_id").cast("string")) % HELD_OUT_FOLDS != 0)
    )
    n = marks.count()
    if n > rows:
        marks = marks.filter(F.pmod(F.xxhash64("label_id"), F.lit(1_000_003)) < int(
            1_000_003 * rows / n))
    # At most about ``rows`` pairs of numbers, so they go to the texts and not the other way round.
    return docs.select("doc_id", text().alias("text")).join(
        F.broadcast(marks), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "y")


def learned_words(train: DataFrame) -> dict[bytes, float]:
    """Words and beginnings that stand out in toxic texts with their log-odds.

    At most LEARNED_WORDS; equal texts count once.
    """
    train = train.withColumn("text_hash", F.xxhash64("text")).dropDuplicates(["text_hash", "y"])

    def words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, list[int]] = {}
        for batch in batches:
            for data, y in zip(byte_texts(batch.column(0)), batch.column(1).to_pylist()):
                found = set(data.translate(LOWER_BYTES).translate(TO_SPACE).split())
                stems = {w[:k] + STEM for k in STEMS for w in found if len(w) >= k}
                for w in found | stems:
                    counts.setdefault(w, [0, 0])[y] += 1
        yield pa.RecordBatch.from_pydict({
            "word": pa.array(list(counts), pa.binary()),
            "clean": pa.array([c[0] for c in counts.values()], pa.int64()),
            "toxic": pa.array([c[1] for c in counts.values()], pa.int64()),
        })

    totals = train.agg(F.coalesce(F.sum("y"), F.lit(0)), F.count(F.lit(1))).first()
    toxic, clean = totals[0], totals[1] - totals[0]
    if not toxic or not clean:
        return {}
    odds = F.log((F.col("toxic") + 0.5) / (F.lit(toxic) - F.col("toxic") + 0.5)) - F.log(
        (F.col("clean") + 0.5) / (F.lit(clean) - F.col("clean") + 0.5))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    found = (
        train.select("text", "y")
        .mapInArrow(given_back(words), "word binary, clean long, toxic long")
        .groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(F.col("clean") + F.col("toxic") >= LEAST_DOCUMENTS)
        .withColumns({"odds": odds, "z": odds / error})
        .filter(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "word").limit(LEARNED_WORDS)
    )
    return {bytes(r["word"]): float(r["odds"]) for r in found.collect()}


def feature_batches(known: dict[bytes, float]):
    lexicon = Lexicon(known)
    you = frozenset(w.encode() for w in SECOND_PERSON)

    def of(column: pa.Array) -> np.ndarray:
        rows = [features(x, lexicon, you) for x in byte_texts(column)]
        return np.array(rows, np.float64).reshape(-1, len(FEATURES))

    return of


def trained(spark: SparkSession, docs: DataFrame, labels: DataFrame,
            rows: int = TRAIN_ROWS):
    """A function from an Arrow column of texts to scores, ready to be sent to tasks."""
    prepare(spark)
    train = stored(spark, labelled(docs, labels, rows).repartition(
        spark.sparkContext.defaultParallelism, "doc_id"), "labelled")
    lexicon = {w.encode(): INSULT_WEIGHT for w in INSULTS} | learned_words(train)
    of = feature_batches(lexicon)

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "y": batch.column(2),
                "x": pa.array(list(of(batch.column(1)).astype(np.float32)),
                              pa.list_(pa.float32())),
            })

    id_type = train.schema["doc_id"].dataType.simpleString()
    # At most ``rows`` rows of a fixed number of features.
    read = train.mapInArrow(given_back(over), f"doc_id {id_type}, y int, x array<float>")
    got = read.withColumn(
        "part", F.pmod(F.xxhash64("doc_id"), F.lit(3)).cast("int")).toPandas()
    got = got.sort_values(["doc_id", "y"], kind="stable")
    x = np.array(got["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    model = Model(x, got["y"].to_numpy(np.float64), got["part"].to_numpy())
    shared = spark.sparkContext.broadcast((model, lexicon))

    made = []  # the feature function of this task, with the words it remembers

    def score(column: pa.Array) -> np.ndarray:
        model, lexicon = shared.value
        if not len(column):
            return np.zeros(0)
        if not made:
            made.append(feature_batches(lexicon))
        return model.score(made[0](column).astype(np.float32).astype(np.float64))

    return score


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, whether it was held out, score and prediction of every row."""
    score = trained(spark, docs, labels)

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "held_out": batch.column(2),
                "score": score(batch.column(1)),
            })

    id_type = docs.schema["doc_id"].dataType.simpleString()
    held_out = (checksum_mod(HELD_OUT_FOLDS) == 0).alias("held_out")
    return (
        docs.select("doc_id", text().alias("text"), held_out)
        .mapInArrow(given_back(over), f"doc_id {id_type}, held_out boolean, score double")
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


def clean_rows(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not predicted to be toxic, with all their columns."""
    score = trained(spark, docs, labels)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(score(texts), pa.float64())

    return (
        whole_rows(docs).filter(scored(text(f"{ROW}.text")) < THRESHOLD).select(f"{ROW}.*")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark, documents(spark, sf_dir),
                    spark.read.parquet(f"{sf_dir}/labels.parquet"))
