"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

The probability of a token is that of its class, given the tokens before it, times its share of
the class. Classes are the HEADS most frequent tokens, each on its own, and CLUSTERS clusters of
all other tokens by their ending, formed from what endings follow each other. The softmax over
classes is factored once more, into BRANCHES branches and the classes of each. Its hashed features
are the token before, the two before as a pair, and the second and third before (skips), each
token by a key of its own. Shares within a class are smoothed counts over all training documents,
with one place for unknown tokens per class, so the probabilities of all tokens add up to one.

Counts cover all training documents, and so does each round of training: tasks add up, at common
weights, how often every feature was followed by every outcome and how often the model expects it.
The gradient is the difference of the two sums; the step takes the logarithm of their ratio, so
that a sum of few observations and one of many move the weights alike. Sums do not depend on how
the documents are split, so neither do the scores. At the start, with all weights zero, the
expectation follows from the counts, so the first round needs no softmax; every later one expects
by the weights so far. ``rates`` has a step for each round. The rounds and the scoring read the
tokens of the documents as numbers, which are stored once. Texts are scored in sparse numpy batches,
a feature row looked up for each token.

The feature rows grow with the square root of the number of distinct tokens, up to a bound that
keeps the broadcast of the weights at 300 MB. The KNOWN most frequent tokens are broadcast (a fixed
bound). Occurrences of all others are joined with the stored counts by a shuffle, so no table of
the size of the vocabulary passes one task or the driver.

Defined cases: a null or empty text is its end token alone; ids may be null or repeat, every row
gets its score; without training documents every token is unknown; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from obligo.llm.common import (
    LOWER_BYTES,
    array_blocks,
    byte_texts,
    checksum_mod,
    documents,
    prepare,
    stretches,
    summed_blocks,
    text,
)
from obligo.sinks.tables import stored

HELD_OUT_FOLDS = 10
PRIOR = 0.1
END = b"\n"  # no word contains it
KNOWN = 100_000
HEADS, CLUSTERS = 24, 40
CLASSES = HEADS + CLUSTERS
BRANCHES = INNER = 8  # the classes are BRANCHES times INNER
OUTCOMES = BRANCHES + CLASSES  # of the two softmaxes, per feature row
# Endings of tokens: the last bytes, hashed to so many numbers, kept in the low bits of a key.
ENDING_BYTES, ENDINGS = 3, 4096
FOLLOWED = 64  # hashed endings of the token before that describe an ending
FEATURES = 4
LEAST_BITS, MOST_BITS = 12, 20
# Steps of the rounds, and how many observations the prior counts for at a feature. The features of
# a token share its outcomes; only from the second round on does a step see what the others explain.
RATES = (0.5, 0.3, 0.3, 0.3)
PRIOR_WEIGHT = 5.0
MOST_EXPONENT = 60.0  # far below what 32-bit floats hold
BATCH_TOKENS = 65_536
# Tokens whose sums one task adds up at most.
TASK_TOKENS = 100_000_000
# Long tokens a worker remembers; of shorter ones many are hashed at once.
REMEMBERED = 300_000
LONG_BYTES = 32
# Bytes of the texts whose tokens are in one array.
FLAT_BYTES = 2_000_000
RANK_BYTES = 4
BLOCK_ROWS = 256
STEP_ROWS = 4096


# -- tokens -------------------------------------------------------------------------------


def key_of(token: bytes) -> int:
    """A negative number: 51 bits of the token's hash above 12 of its ending."""
    ending = xxh64_intdigest(token[-ENDING_BYTES:]) % ENDINGS
    return -((xxh64_intdigest(token) >> 13 << 12 | ending) + 1)


# Of XXH64.
PRIMES = [np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
    0x27D4EB2F165667C5)]
WITHIN_WORDS = np.ones(256, bool)
WITHIN_WORDS[np.frombuffer(b" \t\n\v\f\r", np.uint8)] = False


def ending_of(keys: np.ndarray) -> np.ndarray:
    return (-keys - 1) & (ENDINGS - 1)


def hashes_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XXH64 of byte strings in ``data`` that are shorter than LONG_BYTES, all at once.

    The hash takes eight bytes at a time, then four, then single ones. ``data`` goes on for eight
    bytes or more after the last string.
    """
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    fours = np.ndarray(len(data) - 3, "<u4", data, strides=(1,))

    def turned(x: np.ndarray, bits: int) -> np.ndarray:
        return x << np.uint64(bits) | x >> np.uint64(64 - bits)

    h = lengths.astype(np.uint64) + PRIMES[4]
    for size, read in ((8, eights), (4, fours), (1, data)):
        for k in range(LONG_BYTES // 8 - 1 if size == 8 else 4 // size):
            # How far into the string the reads of this size begin.
            done = k * size + (0 if size == 8 else lengths & -8 if size == 4 else lengths & -4)
            some = np.flatnonzero(lengths >= done + size)
            if not len(some):
                break
            part = read[(starts + done)[some]].astype(np.uint64)
            if size == 8:
                part = turned(part * PRIMES[1], 31) * PRIMES[0]
                h[some] = turned(h[some] ^ part, 27) * PRIMES[0] + PRIMES[3]
            elif size == 4:
                h[some] = turned(h[some] ^ part * PRIMES[0], 23) * PRIMES[1] + PRIMES[2]
            else:
                h[some] = turned(h[some] ^ part * PRIMES[4], 11) * PRIMES[0]
    h = (h ^ h >> np.uint64(33)) * PRIMES[1]
    h = (h ^ h >> np.uint64(29)) * PRIMES[2]
    return h ^ h >> np.uint64(32)


class Numbers(dict):
    """Number of a token: its rank if it is known, else its key."""

    def __init__(self, ranks: dict[int, int] | None = None):
        super().__init__()
        self.ranks = ranks or {}
        known = np.fromiter(self.ranks, np.int64, len(self.ranks))
        order = np.argsort(known)
        self.sorted = known[order]
        self.rank = np.fromiter(self.ranks.values(), np.int64, len(known))[order]

    def of(self, texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens every text has, and the numbers of all of them."""
        # The end token is the one line feed that counts; spaces keep it apart from the words.
        joined = b"".join([y for x in texts for y in (x, b" \n ")]).translate(LOWER_BYTES)
        data = np.frombuffer(joined + bytes(8), np.uint8)
        sizes = np.fromiter((len(x) + 3 for x in texts), np.int64)
        ends = np.cumsum(sizes) - 2
        inside = WITHIN_WORDS[data]
        inside[ends] = True
        inside[len(joined):] = False
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        starts, stops = edges[::2], edges[1::2]
        lengths = stops - starts
        keys = self.keys(data, starts, lengths)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, keys), len(self.sorted) - 1)
            keys = np.where(self.sorted[at] == keys, self.rank[at], keys)
        for i in np.flatnonzero(lengths >= LONG_BYTES):
            keys[i] = self[joined[starts[i]:stops[i]]]
        return np.diff(np.searchsorted(starts, ends), prepend=-1), keys

    @staticmethod
    def keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The same as ``key_of`` for every token shorter than LONG_BYTES."""
        hashed = hashes_of(data, starts, np.minimum(lengths, LONG_BYTES - 1))
        ending = hashed % np.uint64(ENDINGS)
        some = np.flatnonzero(lengths > ENDING_BYTES)
        ending[some] = hashes_of(data, (starts + lengths - ENDING_BYTES)[some],
                                 np.full(len(some), ENDING_BYTES)) % np.uint64(ENDINGS)
        hashed = hashed >> np.uint64(13) << np.uint64(12)
        return -((hashed | ending).astype(np.int64) + 1)

    def __missing__(self, token: bytes) -> int:
        key = key_of(token)
        number = self.ranks.get(key, key)
        if len(self) >= REMEMBERED:
            self.clear()
        self[token] = number
        return number


# -- counts -------------------------------------------------------------------------------


def counts_of(train: DataFrame) -> DataFrame:
    """``pair`` false: count per token key; true: per ending and ending before it."""

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(ENDINGS * FOLLOWED, np.int64)
        numbers = Numbers()
        parts: list[np.ndarray] = []
        held = 0

        def emit() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_pydict({
                "pair": np.zeros(len(keys), bool), "key": keys, "n": n.astype(np.int64)})

        for batch in batches:
            for texts in stretches(batch.column(0), FLAT_BYTES):
                lengths, keys = numbers.of(list(byte_texts(texts)))
                ends = ending_of(keys)
                follow = ends[1:] * FOLLOWED + ends[:-1] % FOLLOWED
                within = np.delete(follow, np.cumsum(lengths)[:-1] - 1)  # none across two texts
                pairs += np.bincount(within, minlength=len(pairs))
                parts.append(keys)
                held += len(keys)
            if held > 4_000_000:
                yield emit()
                parts, held = [], 0
        if parts:
            yield emit()
        found = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_pydict({
            "pair": np.ones(len(found), bool), "key": found, "n": pairs[found]})

    return (
        train.select("text").mapInArrow(over, "pair boolean, key long, n long")
        .groupBy("pair", "key").agg(F.sum("n").alias("n"))
    )


def clusters_of(pairs: np.ndarray) -> np.ndarray:
    """Cluster of every ending, by k-means over what comes before it (square roots of shares)."""
    totals = pairs.sum(1)
    shares = np.sqrt(pairs / np.maximum(totals, 1)[:, None])
    used = np.flatnonzero(totals)
    cluster = np.arange(ENDINGS) % CLUSTERS
    if len(used) <= CLUSTERS:
        return cluster
    order = used[np.argsort(-totals[used], kind="stable")]
    centres = shares[order[:CLUSTERS]].copy()
    weight = np.sqrt(totals[used])[:, None]
    for _ in range(25):
        distance = ((centres**2).sum(1)[None] - 2 * shares[used] @ centres.T)
        nearest = distance.argmin(1)
        for k in range(CLUSTERS):
            mine = nearest == k
            if mine.any():
                centres[k] = (shares[used][mine] * weight[mine]).sum(0) / weight[mine].sum()
    cluster[used] = nearest
    return cluster


class Vocabulary:
    """Known tokens, classes and the smoothed shares; of bounded size."""

    def __init__(self, spark: SparkSession, counts: DataFrame):
        words = counts.filter("NOT pair")
        levels = F.floor(F.log2("n") * 8).alias("level")
        histogram = sorted(
            (tuple(r) for r in words.groupBy(levels).agg(
                F.count(F.lit(1)), F.min("n")).collect()), reverse=True)
        least, kept = None, 0
        for _, n, smallest in histogram:
            if kept + n > KNOWN:
                break
            least, kept = smallest, kept + n
        self.least = least if least is not None else 1 << 62
        known = words.filter(F.col("n") >= self.least).select("key", "n").toPandas()
        known = known.sort_values(["n", "key"], ascending=[False, True], kind="stable")
        self.keys = known["key"].to_numpy(np.int64)
        counted = known["n"].to_numpy(np.float64)
        pairs = np.zeros(ENDINGS * FOLLOWED)
        found = counts.filter("pair").select("key", "n").toPandas()
        pairs[found["key"].to_numpy(np.int64)] = found["n"]
        self.cluster = clusters_of(pairs.reshape(ENDINGS, FOLLOWED))

        ending = F.bitwise_not(F.col("key")).bitwiseAND(F.lit(ENDINGS - 1)).alias("ending")
        per_ending = words.groupBy(ending).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"))
        total, types = np.zeros(CLASSES), np.zeros(CLASSES)
        for r in per_ending.collect():
            k = HEADS + self.cluster[r["ending"]]
            total[k] += r["n"]
            types[k] += r["v"]
        self.tokens, self.types = int(total.sum()), int(types.sum())
        self.classes = HEADS + self.cluster[ending_of(self.keys)]
        for i in range(min(HEADS, len(self.keys))):
            total[self.classes[i]] -= counted[i]
            types[self.classes[i]] -= 1
            self.classes[i] = i
            total[i], types[i] = counted[i], 0
        self.base = np.log10(counted + PRIOR)
        self.constant = float(np.log10(self.tokens + PRIOR * (self.types + 1)))
        # log10 of the denominator of a share; a head has its class for itself.
        self.outside = np.log10(total + PRIOR * (types + 1))
        self.inside = self.base - self.outside[self.classes]
        self.inside[:HEADS] = 0.0
        mass = (total + PRIOR).reshape(BRANCHES, INNER)
        self.prior = np.concatenate(
            [mass.sum(1) / mass.sum(), (mass / mass.sum(1, keepdims=True)).ravel()])
        bits = round(np.log2(max(self.types, 1)) / 2 + 6)
        self.rows = 1 << min(max(bits, LEAST_BITS), MOST_BITS)

    def ranks(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), range(len(self.keys))))

    def key_of_number(self, numbers: np.ndarray) -> np.ndarray:
        """The key of every token, from its rank or its key."""
        return self.looked_up(self.keys, numbers, lambda rare: rare)

    def class_of(self, numbers: np.ndarray) -> np.ndarray:
        return self.looked_up(
            self.classes, numbers, lambda rare: HEADS + self.cluster[ending_of(rare)])

    @staticmethod
    def looked_up(of_ranks: np.ndarray, numbers: np.ndarray, of_keys: Callable) -> np.ndarray:
        if not len(of_ranks):
            return of_keys(numbers)
        found = np.take(of_ranks, numbers, mode="clip")
        rare = np.flatnonzero(numbers < 0)
        found[rare] = of_keys(numbers[rare])
        return found


# -- the model ----------------------------------------------------------------------------


def feature_rows(keys: np.ndarray, begins: np.ndarray, n_rows: int) -> np.ndarray:
    """Rows of the weights for every token, one column per feature.

    Before a text begins there is a symbol of its own.
    """
    symbols = keys.astype(np.uint64)
    before = []
    for k in (1, 2, 3):
        shifted = np.zeros_like(symbols)
        shifted[k:] = symbols[:-k] if k < len(symbols) + 1 else 0
        for first in range(k):  # of the next text where one is short, which has none before either
            shifted[begins[begins + first < len(keys)] + first] = 0
        before.append(shifted)
    one, two, three = before
    mix, other = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    shift = np.uint64(64 - (n_rows.bit_length() - 1))

    rows = np.empty((len(keys), FEATURES), np.int32)
    for j, value in enumerate((one + np.uint64(1), one * mix ^ two * other + np.uint64(7),
                               two + np.uint64(1 << 40), three + np.uint64(1 << 41))):
        value *= mix
        value ^= value >> np.uint64(32)
        value *= other
        value >>= shift
        rows[:, j] = value
    return rows


class Model:
    """Weights per feature row: of the branches, and of the classes of every branch."""

    def __init__(self, prior: np.ndarray, weights: np.ndarray):
        logs = np.log(prior).astype(np.float32)
        self.prior = logs[:BRANCHES], logs[BRANCHES:].reshape(BRANCHES, INNER)
        self.weights = (np.ascontiguousarray(weights[:, :BRANCHES]),
                        np.ascontiguousarray(weights[:, BRANCHES:]).reshape(-1, INNER))
        self.small = max(weights.max(initial=0), -weights.min(initial=0)) * FEATURES < MOST_EXPONENT

    def logits(self, rows: np.ndarray, branch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of all branches, and of the classes within the given branch, one row per token."""
        outer = np.empty((len(rows), BRANCHES), np.float32)
        outer[:] = self.prior[0]
        inner = np.take(self.prior[1], branch, 0, mode="clip")
        found = np.empty_like(outer)
        for j in range(FEATURES):
            row = rows[:, j].astype(np.int64)
            outer += np.take(self.weights[0], row, 0, found, "clip")
            inner += np.take(self.weights[1], row * BRANCHES + branch, 0, found, "clip")
        if not self.small:  # exponents would overflow
            outer -= outer.max(1, keepdims=True)
            inner -= inner.max(1, keepdims=True)
        return outer, inner

    def probabilities(self, rows: np.ndarray, branch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same as probabilities."""
        parts = self.logits(rows, branch)
        for part in parts:
            total = np.exp(part, out=part).reshape(-1)
            while len(total) > len(rows):  # neighbours, faster than a sum over short rows
                total = total[::2] + total[1::2]
            part /= total[:, None]
        return parts

    def logs(self, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of a class, for a batch of feature rows."""
        total, ones = np.zeros(len(rows)), np.ones(INNER, np.float32)
        places = np.arange(len(rows)) * INNER
        for part, own in zip(self.logits(rows, classes // INNER),
                             (classes // INNER, classes % INNER)):
            total += part.reshape(-1)[places + own]
            total -= np.log(np.exp(part, out=part) @ ones)
        return total


def observed(rows: np.ndarray, classes: np.ndarray, inner: np.ndarray) -> None:
    """Adds how often each feature row was followed by each class; one row per row and branch."""
    ones = np.ones(len(rows))
    for j in range(FEATURES):
        np.add.at(inner.reshape(-1), rows[:, j].astype(np.int64) * CLASSES + classes, ones)


def expected(model: Model, rows: np.ndarray, classes: np.ndarray, outer: np.ndarray,
             inner: np.ndarray) -> None:
    """Adds how often the model expects each branch, and each class of a branch that came.

    ``outer`` has a row per feature row, ``inner`` one per feature row and branch. Both are added to
    in place, two outcomes at a time as the parts of a complex number: numpy adds at given places
    several times faster in one dimension than by rows, and without the sort that distinct rows take.
    """
    pairs = INNER // 2  # as many as BRANCHES // 2
    sums = [x.reshape(-1).view(np.complex128) for x in (outer, inner)]
    places = np.empty((BATCH_TOKENS, pairs), np.int64)
    for s in range(0, len(rows), BATCH_TOKENS):
        part, branch = rows[s:s + BATCH_TOKENS], classes[s:s + BATCH_TOKENS] // INNER
        found = [x.astype(np.float64).reshape(-1).view(np.complex128)
                 for x in model.probabilities(part, branch)]
        places = places[:len(part)]
        for j in range(FEATURES):
            row = part[:, j].astype(np.int64)
            for total, at, values in zip(sums, (row, row * BRANCHES + branch), found):
                at = at * pairs
                for k in range(pairs):
                    np.add(at, k, out=places[:, k])
                np.add.at(total, places.reshape(-1), values)


def expected_at_start(seen: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """What a model without weights expects: the prior, as often as a feature was met."""
    sums = np.empty(seen.shape, np.float32)
    for s in range(0, len(seen), STEP_ROWS):
        of_branch = seen[s:s + STEP_ROWS, :BRANCHES]
        sums[s:s + STEP_ROWS, :BRANCHES] = of_branch.sum(1, keepdims=True) * prior[:BRANCHES]
        sums[s:s + STEP_ROWS, BRANCHES:] = np.repeat(of_branch, INNER, axis=1) * prior[BRANCHES:]
    return sums


def step(seen: np.ndarray, model_sums: np.ndarray, prior: np.ndarray, rate: float,
         weights: np.ndarray | float = 0.0) -> np.ndarray:
    """Change of the weights, in the direction of the gradient, seen less expected.

    The prior counts as PRIOR_WEIGHT observations on either side, so rare features move little. Of
    these the model expects as many as the weights so far say, so rounds do not add up to weights
    that fit a rare feature's few observations alone.
    """
    start = PRIOR_WEIGHT * prior
    change = np.empty(seen.shape, np.float32)
    for s in range(0, len(seen), STEP_ROWS):  # what is made of a matrix of doubles stays small
        part = slice(s, s + STEP_ROWS)
        so_far = np.exp(weights[part] if isinstance(weights, np.ndarray) else weights)
        change[part] = rate * np.log((seen[part] + start) / (model_sums[part] + start * so_far))
    return change


class Flat:
    """The tokens of a batch of texts in one array."""

    def __init__(self, texts: list[bytes], numbers: Numbers, vocabulary: Vocabulary):
        self.place(*numbers.of(texts), vocabulary)

    @classmethod
    def of_numbers(cls, known: pa.Array, rare: pa.Array, vocabulary: Vocabulary) -> Flat:
        """The same from the numbers of every text, as ``numbered`` has them."""
        flat = cls.__new__(cls)
        numbers = np.frombuffer(b"".join(known.to_pylist()), np.int32).astype(np.int64)
        numbers[numbers < 0] = np.frombuffer(b"".join(rare.to_pylist()), np.int64)
        lengths = pc.binary_length(known).to_numpy().astype(np.int64) // RANK_BYTES
        flat.place(lengths, numbers, vocabulary)
        return flat

    def place(self, lengths: np.ndarray, numbers: np.ndarray, vocabulary: Vocabulary) -> None:
        self.lengths, self.numbers = lengths, numbers
        self.begins = np.cumsum(lengths) - lengths
        self.classes = vocabulary.class_of(numbers)
        self.rows = feature_rows(
            vocabulary.key_of_number(numbers), self.begins, vocabulary.rows)


def byte_lists(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Stretches of an array between edges, as bytes."""
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [
        None, pa.py_buffer((edges * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def numbered(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """The documents with the tokens of their texts as numbers, in place of the texts.

    ``known`` has a 32-bit rank per token, -1 if it is not among the known; ``rare`` has the 64-bit
    keys of these. Bytes pass the JVM as they are, arrays number by number.
    """
    kept = [c for c in docs.columns if c != "text"]
    schema = docs.select(*kept).withColumn("known", F.lit(b"")).withColumn("rare", F.lit(b"")).schema

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers(shared.value.ranks())
        for batch in batches:
            at_row = 0
            for texts in stretches(batch.column(0), FLAT_BYTES):
                lengths, found = numbers.of(list(byte_texts(texts)))
                edges = np.r_[0, np.cumsum(lengths)]
                at_rare = np.flatnonzero(found < 0)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at_row, len(texts)) for c in batch.columns[1:]),
                     byte_lists(np.maximum(found, -1).astype(np.int32), edges),
                     byte_lists(found[at_rare], np.searchsorted(at_rare, edges))],
                    [*kept, "known", "rare"])
                at_row += len(texts)

    return docs.select("text", *kept).mapInArrow(over, schema)


def corpus_sums(spark: SparkSession, train: DataFrame, shared: Broadcast,
                weights: np.ndarray | None = None) -> np.ndarray:
    """Sums over all training documents: seen outcomes or, at given weights, expected ones.

    ``train`` has their numbers. Tasks read several partitions, so that not every small one hands
    in sums of its own.
    """
    vocabulary = shared.value
    current = None if weights is None else spark.sparkContext.broadcast(weights)
    tasks = max(spark.sparkContext.defaultParallelism, -(-vocabulary.tokens // TASK_TOKENS))

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        model = None if current is None else Model(vocabulary.prior, current.value)
        outer = np.zeros((vocabulary.rows, BRANCHES))
        inner = np.zeros((vocabulary.rows * BRANCHES, INNER))
        for batch in batches:
            flat = Flat.of_numbers(batch.column(0), batch.column(1), vocabulary)
            if model is None:
                observed(flat.rows, flat.classes, inner)
            else:
                expected(model, flat.rows, flat.classes, outer, inner)
        if inner.any():
            if model is None:
                outer = inner.sum(1).reshape(outer.shape)
            total = np.c_[outer, inner.reshape(len(outer), CLASSES)]
            yield pa.RecordBatch.from_pandas(
                array_blocks(total, BLOCK_ROWS).astype({"block": "int32"}), preserve_index=False)

    blocks = train.select("known", "rare").coalesce(tasks).mapInArrow(over, "block int, value binary")
    total = np.zeros((vocabulary.rows, OUTCOMES), np.float32)
    for r in summed_blocks(blocks).toLocalIterator():  # the driver has one partition beside the sums
        first = r["block"] * BLOCK_ROWS
        total[first:first + BLOCK_ROWS] = np.frombuffer(r["value"], np.float32).reshape(-1, OUTCOMES)
    if current is not None:
        current.destroy()
    return total


def trained_weights(spark: SparkSession, train: DataFrame, shared: Broadcast,
                    rates: tuple[float, ...] = RATES) -> np.ndarray:
    """The feature weights after all rounds, one per rate.

    ``train`` has texts or, where these are stored already, their numbers.
    """
    prior = shared.value.prior
    found = train if "known" in train.columns else stored(
        spark, numbered(train.select("text"), shared), "numbers")
    seen = corpus_sums(spark, found, shared)
    weights = step(seen, expected_at_start(seen, prior), prior, rates[0])
    for rate in rates[1:]:
        sums = corpus_sums(spark, found, shared, weights)
        weights += step(seen, sums, prior, rate, weights)
    return weights


def scored(spark: SparkSession, docs: DataFrame,
           rates: tuple[float, ...] = RATES) -> DataFrame:
    """One row per document with the columns of the query."""
    prepare(spark)
    rows = docs.select("doc_id", text().alias("text"),
                       (checksum_mod(HELD_OUT_FOLDS) == 0).alias("held_out"))
    train = rows.filter("NOT held_out").select("doc_id", "text")
    counts = stored(spark, counts_of(train), "token-counts")
    vocabulary = Vocabulary(spark, counts)
    shared = spark.sparkContext.broadcast(vocabulary)
    found = stored(spark, numbered(rows, shared), "numbers")
    weights = spark.sparkContext.broadcast(
        trained_weights(spark, found.filter("NOT held_out"), shared, rates))

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        learned = Model(vocabulary.prior, weights.value)
        base = np.r_[vocabulary.base, 0.0]
        inside = np.r_[vocabulary.inside, 0.0]
        for batch in batches:
            flat = Flat.of_numbers(batch.column(2), batch.column(3), vocabulary)
            n, rare = flat.numbers, flat.numbers < 0
            at = np.where(rare, len(base) - 1, n)  # the added last place counts nothing
            model = inside[at] - np.where(rare, vocabulary.outside[flat.classes], 0.0)
            for i in range(0, len(n), BATCH_TOKENS):
                logs = learned.logs(flat.rows[i:i + BATCH_TOKENS],
                                    flat.classes[i:i + BATCH_TOKENS])
                model[i:i + BATCH_TOKENS] += logs / np.log(10)
            at_rare = np.flatnonzero(rare)
            edges = np.searchsorted(at_rare, np.r_[flat.begins, len(n)])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "held_out": batch.column(1),
                "n_tokens": flat.lengths,
                "n_found": flat.lengths - np.diff(edges),
                "base_part": np.add.reduceat(base[at], flat.begins),
                "model_part": np.add.reduceat(model, flat.begins),
                "rare": pa.ListArray.from_arrays(
                    pa.array(edges, pa.int32()), pa.array(n[at_rare])),
            })

    id_type = docs.schema["doc_id"].dataType.simpleString()
    parts = stored(
        spark,
        found.select("doc_id", "held_out", "known", "rare").mapInArrow(
            over, f"doc_id {id_type}, held_out boolean, n_tokens long, n_found long, "
            "base_part double, model_part double, rare array<bigint>")
        .withColumn("row", F.monotonically_increasing_id()),
        "score-parts",
    )
    logs = F.log10(F.coalesce("n", F.lit(0)) + F.lit(PRIOR))
    looked_up = (
        parts.select("row", F.explode("rare").alias("key"))
        .join(counts.filter(~F.col("pair") & (F.col("n") < vocabulary.least))
              .select("key", "n"), "key", "left")
        .groupBy("row").agg(F.sum(logs).alias("rare_logs"), F.count("n").alias("rare_found"))
    )
    more = F.coalesce("rare_logs", F.lit(0.0))
    return parts.drop("rare").join(looked_up, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_found") + F.coalesce("rare_found", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base_part") + more - F.col("n_tokens") * F.lit(vocabulary.constant))
        .alias("base_score"),
        (F.col("model_part") + more).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, documents(spark, sf_dir))
