"""Secret scan: fixed patterns, and strings that look random to character Markov models.

Two first-order Markov models over characters are counted on labelled strings of all documents:
what the fixed patterns find counts as random, long strings made of words, numbers and signs
between them as ordinary identifiers; other strings have no label and train neither model. A
string that no pattern covers is reported where the logarithm of its likelihood ratio exceeds the
logarithm of the prior odds against it, taken from the numbers of labelled strings, and of the
cost of a false report. The counts of the models are added up in Spark; what reaches the driver
is two tables of character pairs, whatever the input.

Spans are in code points, the end exclusive. Those of one kind never overlap; of the model they
never overlap one of a pattern either.

Defined cases: a null text is empty and has no span; without a labelled random string their model
is uniform; repeated rows give repeated rows; a null id stays null; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obligo.llm.common import documents, prepare, text

KINDS = ("assign", "access", "hex", "markov")
BASE = KINDS[:3]

# The fixed patterns and the shortest match, for `assign` of its value (fixed values).
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{16,}")  # a match of [0-9a-f]+ is a whole run
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

# Strings the models judge.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
# Those of them that are ordinary by their form: words in one case or camel case, and numbers.
ORDINARY = re.compile(
    r"(?:(?:(?:[A-Z]?[a-z]{2,}+)++[0-9]{0,2}|[A-Z]++|[0-9]++|[A-Za-z])(?:[+/_=-]++|$))++")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
EDGE = len(ALPHABET)  # before the first and after the last character
STATES = EDGE + 1
CODE = np.full(256, EDGE, np.int64)
CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(EDGE)
SMOOTHING = 0.5
# Cost of a false report against that of a missed one.
FALSE_COST = 1_000.0


def base_spans(value: str) -> list[tuple[int, int, int, int]]:
    """Start, number of the kind, end, and start of the secret part, by start."""
    found = []
    lowered = value.lower()
    if any(w in lowered for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(value)
                  if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in value:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(value)
                  if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(value)]
    return sorted(found)


def candidates(value: str, taken: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Long strings that touch no span of a pattern."""
    found = [m.span() for m in CANDIDATE.finditer(value)]
    if not taken or not found:
        return found
    covered = []  # the spans joined to disjoint ones
    for start, _, end, _ in taken:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    ends = [e for _, e in covered]

    def free(start: int, end: int) -> bool:
        at = bisect_left(ends, start + 1)
        return at == len(covered) or covered[at][0] >= end

    return [x for x in found if free(*x)]


def transitions(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the character pairs of all strings with their edges, and where each begins."""
    data = np.frombuffer(("\n" + "\n".join(strings) + "\n").encode("latin-1", "replace"), np.uint8)
    codes = CODE[data]
    starts = np.cumsum([0] + [len(s) + 1 for s in strings[:-1]]) if strings else np.zeros(0, int)
    return codes[:-1] * STATES + codes[1:], starts


def pair_counts(docs: DataFrame) -> DataFrame:
    """Label, character pair and count; pair -1 counts the strings."""

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, STATES * STATES), np.int64)
        strings = np.zeros(2, np.int64)
        for batch in batches:
            ordinary, random = [], []
            for value in batch.column(0).to_pylist():
                spans = base_spans(value)
                random += [value[s:e] for _, _, e, s in spans]
                ordinary += [x for s, e in candidates(value, spans)
                             if ORDINARY.fullmatch(x := value[s:e])]
            for label, found in enumerate((ordinary, random)):
                if found:
                    pairs, _ = transitions(found)
                    counts[label] += np.bincount(pairs, minlength=STATES * STATES)
                    strings[label] += len(found)
        label, pair = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "random": pa.array(np.r_[label, 0, 1], pa.int32()),
            "pair": pa.array(np.r_[pair, -1, -1], pa.int32()),
            "n": pa.array(np.r_[counts[label, pair], strings], pa.int64()),
        })

    return (
        docs.select(text().alias("text"))
        .mapInArrow(over, "random int, pair int, n long")
        .groupBy("random", "pair").agg(F.sum("n").alias("n"))
    )


class Markov:
    """Log-likelihood ratio of random to ordinary per character pair, and the threshold."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        counts = np.zeros((2, STATES * STATES))
        strings = np.zeros(2)
        for label, pair, n in rows:
            if pair < 0:
                strings[label] = n
            else:
                counts[label, pair] = n
        counts = counts.reshape(2, STATES, STATES)
        rates = np.log((counts + SMOOTHING) / (counts + SMOOTHING).sum(axis=2, keepdims=True))
        self.ratio = (rates[1] - rates[0]).ravel()
        self.threshold = float(np.log((strings[0] + 1) / (strings[1] + 1)) + np.log(FALSE_COST))

    def ratios(self, strings: list[str]) -> np.ndarray:
        """Log-likelihood ratio of each string."""
        if not strings:
            return np.zeros(0)
        pairs, starts = transitions(strings)
        # The pair that ends a string is the one before the next begins.
        return np.add.reduceat(self.ratio[pairs], starts)

    def random(self, strings: list[str]) -> np.ndarray:
        return self.ratios(strings) > self.threshold


def trained(docs: DataFrame) -> Markov:
    return Markov([(r["random"], r["pair"], r["n"]) for r in pair_counts(docs).collect()])


def secrets(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id and the spans (kind, start, end) of every text, by start, then kind."""
    prepare(spark)
    shared = spark.sparkContext.broadcast(trained(docs))

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([
            ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            values = batch.column(1).to_pylist()
            spans = [base_spans(v) for v in values]
            judged = [(i, s, e) for i, v in enumerate(values) for s, e in candidates(v, spans[i])]
            found = shared.value.random([values[i][s:e] for i, s, e in judged])
            for (i, s, e), secret in zip(judged, found):
                if secret:
                    spans[i].append((s, 3, e, s))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "spans": pa.array([
                    [{"kind": KINDS[k], "start": s, "end": e} for s, k, e, _ in sorted(x)]
                    for x in spans
                ], spans_type),
            })

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text().alias("text")).mapInArrow(
        over, f"doc_id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    found = secrets(spark, documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id", *[of(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
