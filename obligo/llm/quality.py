"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every document: low quality, high quality, or no vote.
Low quality comes in kinds, one per labeller, of which others may or may not take notice.
Expectation-maximisation estimates from the counts of vote patterns over all documents how often
each labeller votes low on documents of high quality and of each kind of low quality, where it
votes, and how many there are of each; this gives a posterior per pattern.
The posteriors are the soft labels of a linear scorer over hashed words, word shapes and rates.
Its features are read once and stored. In each round tasks add up the gradient of all documents at
common weights, and the driver makes one accelerated step, per feature as long as the curvature
allows. Sums do not depend on how the documents are split, so neither do the scores. No given
label is read.

There are 3 ** labellers patterns, so the counts that reach the driver are bounded.

Defined cases: a null or empty text has no words, gets the posterior of its votes and a score like
any other; repeated rows get equal results each; a null id stays null; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obligo.llm.common import (
    LOWER_BYTES,
    array_blocks,
    byte_texts,
    documents,
    given_back,
    joined_blocks,
    prepare,
    summed_blocks,
    text,
)
from obligo.sinks.tables import stored

LOW, HIGH, NONE = 0, 1, 2
# Labellers: a rate, the bound from which it votes low, the one up to which it votes high.
LABELLERS = {
    "symbols": (0.03, 0.01),
    "lone_signs": (0.10, 0.02),
    "repeats": (0.08, 0.02),
    "capitals": (0.30, 0.10),
    "exclaims": (0.10, 0.02),
    "sameness": (0.75, 0.60),
    "no_short_words": (0.95, 0.85),
    "long_words": (0.50, 0.30),
}
PATTERNS = 3 ** len(LABELLERS)
LEAST_WORDS = 10  # for the rates that compare words
OF_MANY_WORDS = ("repeats", "sameness", "no_short_words", "long_words")
LONGEST = 30  # bytes per word that no prose has
STRETCH = 200  # words among which repeats make a text monotonous
# Where expectation-maximisation starts: share of each kind of low quality; how often a labeller
# votes low on documents of high quality, of the kind it looks for, and of other kinds.
START_SHARE, START_HIGH, START_OWN, START_OTHER = 0.02, 0.01, 0.9, 0.15
# What the first may rise to and the second fall to, so that the kinds keep their meaning.
MOST_HIGH, LEAST_OWN = 0.05, 0.6
# Documents, and votes of each labeller per class, that the start counts for.
PSEUDO_DOCUMENTS, PSEUDO_VOTES = 100.0, 5.0
STEPS = 500

FEATURE_BITS = 16
FEATURES = 1 << FEATURE_BITS
ROUNDS = 16
# Curvature that a weight starts with, which holds back features met seldom.
RIDGE = 0.5
# Values of features lie in (0, 1] and are stored in so many steps.
STEPS_OF_VALUES = 65_535
THRESHOLD = 0.5
BLOCK_ROWS = 4096
ONE = crc32(b"one") & (FEATURES - 1)  # the feature that every document has

SHAPE = bytes.maketrans(
    bytes(range(256)),
    bytes(65 if 65 <= i < 91 else 97 if 97 <= i < 123 or i >= 128 else 48 if 48 <= i < 58 else i
          for i in range(256)),
)
SIGNS = [i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,'\"-|"]


def rates_of(data: bytes, words: list[bytes], shapes: Counter) -> list[float]:
    """The rates of the labellers, in their order; -1 where a text is too short for one.

    Signs, capitals and exclamation marks say something of a single word. A text without blanks
    is one long word, whatever its number of words.
    """
    n = len(words)
    if not n:
        return [-1.0] * len(LABELLERS)
    bytes_of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lone = capitals = exclaims = short = long = 0
    for shape, k in shapes.items():
        body = shape.rstrip(b"!?.,;:")
        if b"a" not in shape and b"A" not in shape and b"0" not in shape:
            lone += k
            continue
        short += k * (len(body) <= 3)
        long += k * (len(body) > 8)
        if body.startswith(b"A") and b"a" not in body and len(body) > 1:
            capitals += k
        if shape.endswith(b"!"):
            exclaims += k
    lettered = max(n - lone, 1)
    stretches = [words[i:i + STRETCH] for i in range(0, n, STRETCH)]
    rates = [
        float(bytes_of[SIGNS].sum()) / len(data),
        lone / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        capitals / n,
        exclaims / n,
        1 - sum(len(set(x)) for x in stretches) / n,
        1 - short / lettered,
        long / lettered,
    ]
    if n < LEAST_WORDS:
        for i, labeller in enumerate(LABELLERS):
            if labeller in OF_MANY_WORDS:
                rates[i] = -1.0
        if len(data) > LONGEST * n:
            rates[-1] = long / lettered
    return rates


class Read:
    """What is read of one text: vote pattern, hashed features and their values."""

    def __init__(self, data: bytes):
        words = data.split()
        shapes = Counter(w.translate(SHAPE) for w in words)
        n = max(len(words), 1)
        rates = rates_of(data, words, shapes)
        self.pattern = 0
        for rate, (low, high) in zip(rates, LABELLERS.values()):
            vote = NONE if rate < 0 else LOW if rate >= low else HIGH if rate <= high else NONE
            self.pattern = self.pattern * 3 + vote
        counts = Counter(crc32(w) for w in data.translate(LOWER_BYTES).split())
        for shape, k in shapes.items():
            own = crc32(b"shape " + shape[:1] + shape[-3:])
            counts[own] = counts.get(own, 0) + k
        ids = np.fromiter(counts, np.int64, len(counts)) & (FEATURES - 1)
        values = np.sqrt(np.fromiter(counts.values(), np.float64, len(counts)) / n)
        # Every rate falls into one of nine steps, each a feature of its own.
        steps = [crc32(b"rate %d %d" % (i, int(np.ceil(min(max(r, -0.125), 1.0) * 8))))
                 for i, r in enumerate(rates)]
        self.ids = np.r_[ids, np.array(steps) & (FEATURES - 1), ONE]
        self.values = np.r_[values, np.ones(len(steps) + 1)]


def votes_of(pattern: np.ndarray) -> np.ndarray:
    """Votes of all labellers, one row per pattern."""
    powers = 3 ** np.arange(len(LABELLERS))[::-1]
    return pattern[:, None] // powers % 3


def posterior_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of high quality per pattern, rates of low votes, and shares of the classes.

    ``counts`` has the number of documents per pattern. Class 0 is high quality, class j + 1 the
    low quality that labeller j looks for. A labeller that does not vote says nothing.
    """
    n = len(LABELLERS)
    votes = votes_of(np.arange(PATTERNS))
    low, voted = (votes == LOW).astype(float), (votes != NONE).astype(float)
    rates = np.full((n + 1, n), START_OTHER)
    rates[0], rates[np.arange(n) + 1, np.arange(n)] = START_HIGH, START_OWN
    shares = np.r_[1 - n * START_SHARE, np.full(n, START_SHARE)]
    first_rates, first_shares = rates, shares
    for _ in range(STEPS):
        joint = low @ np.log(rates).T + (voted - low) @ np.log(1 - rates).T + np.log(shares)
        joint -= joint.max(1, keepdims=True)
        posterior = np.exp(joint)
        posterior /= posterior.sum(1, keepdims=True)
        mass = posterior * counts[:, None]
        if not counts.any():
            break
        shares = (mass.sum(0) + PSEUDO_DOCUMENTS * first_shares) / (
            mass.sum() + PSEUDO_DOCUMENTS)
        new = (mass.T @ low + PSEUDO_VOTES * first_rates) / (mass.T @ voted + PSEUDO_VOTES)
        new = np.clip(new, 1e-6, 1 - 1e-6)
        new[0] = np.minimum(new[0], MOST_HIGH)
        own = (np.arange(n) + 1, np.arange(n))
        new[own] = np.maximum(new[own], LEAST_OWN)
        done = np.abs(new - rates).max() < 1e-8
        rates = new
        if done:
            break
    return posterior[:, 0], rates, shares


def features(docs: DataFrame) -> DataFrame:
    """doc_id, vote pattern, and the features and values of every document as 16-bit numbers."""

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            patterns, ids, values = [], [], []
            for data in byte_texts(batch.column(1)):
                x = Read(data)
                patterns.append(x.pattern)
                ids.append(x.ids.astype("<u2").tobytes())
                steps = np.maximum(np.rint(x.values * STEPS_OF_VALUES), 1)
                values.append(np.minimum(steps, STEPS_OF_VALUES).astype("<u2").tobytes())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "pattern": pa.array(patterns, pa.int32()),
                "ids": pa.array(ids, pa.binary()), "features": pa.array(values, pa.binary())})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text().alias("text")).mapInArrow(
        given_back(over), f"doc_id {id_type}, pattern int, ids binary, features binary")


class Rows:
    """Some documents as one sparse matrix: features, values, and where documents begin."""

    def __init__(self, ids: pa.Array, values: pa.Array):
        ids, values = ids.to_pylist(), values.to_pylist()
        self.sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.ids = np.frombuffer(b"".join(ids), "<u2").astype(np.int64)
        self.values = np.frombuffer(b"".join(values), "<u2") / STEPS_OF_VALUES

    def times(self, weights: np.ndarray) -> np.ndarray:
        """One number per document; every document has a feature."""
        return np.add.reduceat(weights[self.ids] * self.values, self.begins)

    def back(self, numbers: np.ndarray) -> np.ndarray:
        """One number per feature."""
        return np.bincount(self.ids, self.values * np.repeat(numbers, self.sizes),
                           minlength=FEATURES)


def probability(margins: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margins, -30, 30)))


def pattern_counts(read: DataFrame) -> np.ndarray:
    """Documents per vote pattern, over all documents."""
    out = np.zeros(PATTERNS)
    for r in read.groupBy("pattern").count().collect():
        out[r["pattern"]] = r["count"]
    return out


def corpus_sums(spark: SparkSession, read: DataFrame, weights: np.ndarray,
                posterior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of all documents at these weights, and a bound of the curvature, per feature.

    The bound is a quarter of the sum of a feature's values times the sum of all values beside it:
    steps of the inverse of it never overshoot, however features go together. Tasks read several
    partitions, so that not every small one hands in sums of its own.
    """
    shared = spark.sparkContext.broadcast((weights, posterior))

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, target = shared.value
        sums = np.zeros((FEATURES, 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = Rows(batch.column(1), batch.column(2))
            wanted = target[batch.column(0).to_numpy()]
            sums[:, 0] += rows.back(wanted - probability(rows.times(common)))
            sums[:, 1] += rows.back(np.add.reduceat(rows.values, rows.begins) / 4)
        if sums.any():
            yield pa.RecordBatch.from_pandas(
                array_blocks(sums, BLOCK_ROWS).astype({"block": "int32"}), preserve_index=False)

    tasks = max(spark.sparkContext.defaultParallelism, read.rdd.getNumPartitions() // 16)
    blocks = read.select("pattern", "ids", "features").coalesce(tasks).mapInArrow(
        over, "block int, value binary")
    total = joined_blocks(summed_blocks(blocks).collect(), 2 * FEATURES).reshape(-1, 2)
    shared.destroy()
    return total[:, 0].astype(np.float64), total[:, 1].astype(np.float64)


def trained_weights(spark: SparkSession, read: DataFrame, posterior: np.ndarray,
                    share_high: float) -> np.ndarray:
    """Weights of the linear scorer after all rounds; it starts from the share of high quality.

    Each step starts from where the last two point to, by which the error falls with the square
    of the rounds.
    """
    start = np.zeros(FEATURES)
    start[ONE] = np.log(share_high / (1 - share_high))
    weights = ahead = start
    for turn in range(ROUNDS):
        gradient, curvature = corpus_sums(spark, read, ahead, posterior)
        new = ahead + (gradient - RIDGE * (ahead - start)) / (curvature + RIDGE)
        weights, ahead = new, new + turn / (turn + 3) * (new - weights)
    return weights


def quality(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, score, whether the document is kept, and the posterior of its votes."""
    prepare(spark)
    read = stored(spark, features(docs), "quality-features")
    posterior, _, shares = posterior_of(pattern_counts(read))
    weights = trained_weights(spark, read, posterior, float(np.clip(shares[0], 0.01, 0.99)))
    shared = spark.sparkContext.broadcast((weights, posterior))

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, posterior = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "score": probability(Rows(batch.column(2), batch.column(3)).times(weights)),
                "posterior": posterior[batch.column(1).to_numpy()],
            })

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(over, f"doc_id {id_type}, score double, posterior double").withColumn(
        "kept", F.col("score") >= THRESHOLD)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark, documents(spark, sf_dir))
