"""Periodic runs of words, found on a grammar of each text.

A run is a stretch of words with smallest period q (words q apart are identical) that no
neighbouring word extends, at least 3 q words and at least ``LEAST`` long.

Re-Pair is applied in rounds to the word numbers of some texts side by side. The numbers of a word
differ between texts, so that no rule spans two of them. A round replaces, of all pairs that occur
at least twice in their text, the occurrences whose pair is more frequent than those overlapping
them; rounds end when no pair occurs twice. Each rule, and each border between two symbols that
are left, stands for one border between words. Every run lies across the border of the smallest
rule or text that holds it, and there it is whole; so runs are looked for at these borders only,
once per rule, and those of a rule are translated to all places it derives. Stretches of one period
that overlap by a period are merged, which removes what is part of a longer run.

Of a run across a border, half lies on one side, so at least 4 words and half a period of words on
that side recur a period further. For periods of [2 g, 4 g) the g words next to the border are
looked up among those that occur twice; the stretch around a border and its recurrence is then
compared word by word, which decides.

Defined cases: a null or empty text has no word and no run; words are compared byte by byte;
repeated rows and ids give repeated rows, each found in its own text; a null id stays null; an
empty table gives an empty result. A text of any length is worked on as a whole, in one task, with
some hundred bytes of memory per word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obligo.llm.common import STRETCH_BYTES, documents, prepare, stretches, text

# Shortest run in words and in periods.
LEAST, TIMES = 24, 3
GRAM = 4  # words that recur next to the border of any run: half of LEAST less 8, and q/2 beyond
SPACES = r"[\x20\x09-\x0D]+"
RUN = "struct<start:bigint,length:bigint,period:bigint>"


class Grammar:
    """Rules of Re-Pair over some texts side by side, and the symbols that are left of each.

    Symbols below ``words`` are words; symbol ``words + r`` derives ``left[r]``, ``right[r]``.
    ``first[r]`` is a place it derives, ``length`` the number of words of every symbol.
    """

    def __init__(self, words: np.ndarray):
        symbols, places = words.astype(np.int64), np.arange(len(words))
        self.words = int(words.max()) + 1 if len(words) else 0
        left, right, first, lengths = [], [], [], [np.ones(self.words, np.int64)]
        made = self.words
        self.repeated = np.zeros(len(words), bool)  # word pairs that occur twice in their text
        fresh = np.ones(max(len(words) - 1, 0), bool)
        while True:
            at, pair, counts = self._pairs(symbols, np.flatnonzero(fresh))
            if made == self.words:
                self.repeated[at] = True
            if not len(at):
                break
            chosen = self._dominant(at, pair, counts)
            at, pair = at[chosen], pair[chosen]
            kinds, one, rule = np.unique(pair, return_index=True, return_inverse=True)
            left.append(symbols[at[one]])
            right.append(symbols[at[one] + 1])
            first.append(places[at[one]])
            known = np.concatenate(lengths)
            lengths.append(known[left[-1]] + known[right[-1]])
            repeated = np.zeros(len(symbols), bool)  # may occur twice in the next round
            repeated[np.flatnonzero(fresh)[self._again]] = True
            symbols[at] = made + rule
            changed = np.zeros(len(symbols), bool)
            changed[at] = True
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, places, changed, repeated = (
                x[stay] for x in (symbols, places, changed, repeated))
            made += len(kinds)
            fresh = repeated[:-1] | changed[:-1] | changed[1:]
        none = [np.zeros(0, np.int64)]
        self.left, self.right, self.first = (
            np.concatenate(x or none) for x in (left, right, first))
        self.length = np.concatenate(lengths)
        self.symbols, self.places = symbols, places

    def _pairs(self, symbols: np.ndarray, at: np.ndarray):
        """Where pairs occur that occur twice, in order, with the number and count of each pair."""
        codes = symbols[at] << 32 | symbols[at + 1]
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        begins = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else order
        sizes = np.diff(np.r_[begins, len(codes)])
        pair, counts = np.empty(len(codes), np.int64), np.empty(len(codes), np.int64)
        pair[order] = np.repeat(np.arange(len(begins)), sizes)
        counts[order] = np.repeat(sizes, sizes)
        self._again = counts > 1
        return at[self._again], pair[self._again], counts[self._again]

    @staticmethod
    def _dominant(at: np.ndarray, pair: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Occurrences to replace: more frequent than those they overlap, every other of aaa."""
        value = counts << 32 | (np.int64(1 << 31) - pair)
        n = len(at)
        joined = at[1:] == at[:-1] + 1
        before = np.r_[0, np.where(joined, value[:-1], 0)]
        after = np.r_[np.where(joined, value[1:], 0), 0]
        index = np.arange(n)
        begin = np.maximum.accumulate(np.where(before != value, index, 0))
        end = np.minimum.accumulate(np.where(after != value, index, n)[::-1])[::-1]
        return ((index - begin) % 2 == 0) & (before[begin] < value) & (after[end] < value)


def _spread(lows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every row number and every position lows[row] .. lows[row] + sizes[row] - 1."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return rows, lows[rows] + inside


class Grams:
    """Grams of words that occur twice, for doubling lengths, and where they recur."""

    def __init__(self, words: np.ndarray, repeated: np.ndarray):
        n = len(words)
        self.n, self.size = n, GRAM
        alive = repeated.copy()
        alive[:-1] &= repeated[1:]
        alive[:-2] &= repeated[2:]
        alive[max(n - 3, 0):] = False
        # Codes mix the words; equal grams have equal codes, others hardly ever.
        pairs = self._mixed(words.astype(np.uint64), np.roll(words, -1).astype(np.uint64))
        self.codes = self._mixed(pairs, np.roll(pairs, -2))
        self._keep(np.flatnonzero(alive))

    @staticmethod
    def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        mixed = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(
            0xBF58476D1CE4E5B9) + np.uint64(1)
        return mixed ^ (mixed >> np.uint64(32))

    def _keep(self, at: np.ndarray) -> None:
        """Of the grams at these places those that occur twice, by gram, then by place."""
        codes = self.codes[at]
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        new = np.r_[True, codes[1:] != codes[:-1]] if len(codes) else np.zeros(0, bool)
        kinds = np.cumsum(new) - 1
        twice = np.bincount(kinds, minlength=1)[kinds] > 1 if len(kinds) else new
        at, kinds = at[order][twice], kinds[twice]
        self.kind = np.full(self.n, -1, np.int64)
        self.kind[at] = kinds
        self.keys = kinds * self.n + at

    def double(self) -> None:
        """From grams of a length to those of twice the length."""
        at = np.flatnonzero(self.kind >= 0)
        at = at[at + 2 * self.size <= self.n]
        at = at[self.kind[at + self.size] >= 0]
        self.codes[at] = self._mixed(self.codes[at], self.codes[at + self.size])
        self.size *= 2
        self._keep(at)

    def recurring(self, at: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Row numbers of ``at`` and places in [low, high] where the gram at ``at`` recurs."""
        rows = np.flatnonzero((low <= high) & (at >= 0) & (at + self.size <= self.n))
        rows = rows[self.kind[at[rows]] >= 0]
        base = self.kind[at[rows]] * self.n
        start = np.searchsorted(self.keys, base + np.maximum(low[rows], 0))
        stop = np.searchsorted(self.keys, base + np.minimum(high[rows], self.n - 1), "right")
        picked, where = _spread(start, np.maximum(stop - start, 0))
        return rows[picked], self.keys[where] - base[picked]


def _stretch(words: np.ndarray, at: int, period: int, low: int, high: int) -> tuple[int, int]:
    """The stretch of words in [low, high) around ``at`` and ``at + period`` of that period."""
    forward, width = at, 32
    while forward + period < high:
        stop = min(forward + width, high - period)
        same = words[forward:stop] == words[forward + period:stop + period]
        if not same.all():
            forward += int(np.argmin(same))
            break
        forward, width = stop, 2 * width
    back, width = at, 32
    while back > low:
        stop = max(back - width, low)
        same = words[stop:back] == words[stop + period:back + period]
        if not same.all():
            back -= int(np.argmin(same[::-1]))
            break
        back, width = stop, 2 * width
    return back, forward + period


def _border_runs(words: np.ndarray, repeated: np.ndarray, border: np.ndarray, low: np.ndarray,
                 high: np.ndarray) -> np.ndarray:
    """Runs of the words [low, high) across each border: rows of border number, start, end, period.

    A multiple of a run's period has the same stretch and is left out.
    """
    found: list[tuple[int, int, int, int]] = []
    # The longest stretch found at each border: its period, and how far it reaches to either side.
    period, right, left = (np.zeros(len(border), np.int64) for _ in range(3))
    grams, shortest, most = Grams(words, repeated), 1, (high - low) // TIMES
    while len(grams.keys) and (most >= shortest).any():
        longest = np.minimum(4 * grams.size - 1, most)
        after = grams.recurring(border, border + shortest, border + longest)
        before = grams.recurring(
            border - grams.size, border - grams.size - longest, border - grams.size - shortest)
        row = np.r_[after[0], before[0]]
        at = np.r_[border[after[0]], before[1] + grams.size]  # the stretch holds at, at + q - 1
        q = np.r_[after[1] - border[after[0]], border[before[0]] - at[len(after[0]):]]
        forward = np.arange(len(row)) < len(after[0])
        side = np.where(forward, right[row], left[row])
        q_of = np.maximum(period[row], 1)
        keep = ~((period[row] > 0) & (q % q_of == 0) & (side >= q))
        # Half a period of words recurs; some of them are compared first.
        reach = (q + 1) // 2 - 1
        for part in range(4):
            step = reach * part // 3
            here = np.where(forward, at + step, at - 1 - step)
            inside = (here >= low[row]) & (here + q < high[row])
            here = np.where(inside, here, 0)
            keep &= inside & (words[here] == words[np.where(inside, here + q, 0)])
        for i in np.flatnonzero(keep)[np.argsort(q[keep], kind="stable")]:
            r, p = int(row[i]), int(q[i])
            known = int(period[r])
            if known and p % known == 0 and p <= (right[r] if forward[i] else left[r]):
                continue
            anchor = int(at[i]) if forward[i] else int(at[i]) - 1
            start, end = _stretch(words, anchor, p, int(low[r]), int(high[r]))
            if end - start >= max(LEAST, TIMES * p):
                found.append((r, start, end, p))
                if end - start > right[r] + left[r]:
                    period[r], right[r], left[r] = p, end - border[r], border[r] - start
        shortest = 4 * grams.size
        grams.double()
    if not found:
        return np.zeros((0, 4), np.int64)
    rows = np.array(sorted(set(found)), np.int64)
    return rows[np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)]]


def _translated(grammar: Grammar, rule: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Runs (start, end, period) of rules at every place that the rules derive."""
    n = len(grammar.left)
    holds = np.zeros(grammar.words + n, bool)
    holds[grammar.words + rule] = True
    for r in range(n):
        holds[grammar.words + r] |= holds[grammar.left[r]] | holds[grammar.right[r]]
    places: dict[int, list[np.ndarray]] = defaultdict(list)
    top = np.flatnonzero(holds[grammar.symbols])
    for s in np.unique(grammar.symbols[top]):
        places[int(s)].append(grammar.places[top[grammar.symbols[top] == s]])
    of_rule: dict[int, list[int]] = defaultdict(list)
    for i, r in enumerate(rule):
        of_rule[int(r)].append(i)
    out = []
    for r in range(n - 1, -1, -1):
        symbol = grammar.words + r
        if not holds[symbol] or symbol not in places:
            continue
        derived = np.concatenate(places.pop(symbol))
        for child, offset in ((grammar.left[r], 0),
                              (grammar.right[r], grammar.length[grammar.left[r]])):
            if holds[child]:
                places[int(child)].append(derived + offset)
        for i in of_rule.get(r, ()):
            start, end, period = runs[i]
            shift = derived - grammar.first[r]
            out.append(np.stack([start + shift, end + shift, np.full(len(shift), period)], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def _merged(runs: np.ndarray) -> np.ndarray:
    """Maximal stretches: those of one period that overlap by a period are one."""
    runs = np.unique(runs[:, [2, 0, 1]], axis=0)
    out: list[list[int]] = []
    for period, start, end in runs.tolist():
        if out and out[-1][0] == period and start + period <= out[-1][2]:
            out[-1][2] = max(out[-1][2], end)
        else:
            out.append([period, start, end])
    return np.array(out, np.int64).reshape(-1, 3)[:, [1, 2, 0]]


def word_runs(words: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """All runs (start, end, period) of texts side by side, by start, then period.

    ``borders`` are where texts begin and, last, the number of words. Word numbers of different
    texts differ.
    """
    if len(words) < LEAST:
        return np.zeros((0, 3), np.int64)
    grammar = Grammar(words)
    long = np.flatnonzero(grammar.length[grammar.words:] >= LEAST)
    begin = grammar.first[long]
    inner = grammar.places[1:]
    inner = inner[~np.isin(inner, borders)]
    text_of = np.searchsorted(borders, inner, "right") - 1
    low = np.r_[begin, borders[text_of]]
    high = np.r_[begin + grammar.length[grammar.words + long], borders[text_of + 1]]
    border = np.r_[begin + grammar.length[grammar.left[long]], inner]
    worth = high - low >= LEAST
    numbers = np.flatnonzero(worth)
    found = _border_runs(words, grammar.repeated, border[worth], low[worth], high[worth])
    found[:, 0] = numbers[found[:, 0]]
    of_rules = found[:, 0] < len(long)
    inside = _translated(grammar, long[found[of_rules, 0]], found[of_rules, 1:])
    runs = _merged(np.concatenate([inside, found[~of_rules, 1:]]))
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _numbered(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, their numbers side by side, and where texts begin."""
    counter = count()
    split = [t.split() for t in texts]  # bytes split at the six ASCII white spaces alone
    sizes = [len(w) for w in split]
    numbers = np.empty(sum(sizes), np.int64)
    borders = np.cumsum([0, *sizes])
    for i, words in enumerate(split):
        number = defaultdict(counter.__next__)
        numbers[borders[i]:borders[i + 1]] = [number[w] for w in words]
    return split, numbers, borders


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    stay = np.ones(len(words), bool)
    for start, length, period in runs:
        stay[start + period:start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(stay))


def periodic_runs(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, runs (start, length and period in words, by start, then period) and collapsed text."""
    prepare(spark)

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))
        for batch in batches:
            done = 0
            for part in stretches(batch.column(1), STRETCH_BYTES):
                split, numbers, borders = _numbered(part.cast(pa.binary()).to_pylist())
                found = word_runs(numbers, borders)
                of = np.searchsorted(borders, found[:, 0], "right") - 1
                runs: list[list[tuple[int, int, int]]] = [[] for _ in split]
                for i, (start, end, period) in zip(of.tolist(), found.tolist()):
                    runs[i].append((start - int(borders[i]), end - start, period))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(done, len(part)),
                    "runs": pa.array([
                        [{"start": s, "length": n, "period": p} for s, n, p in x] for x in runs
                    ], kind),
                    "collapsed": pa.array(
                        [_collapsed(w, r) for w, r in zip(split, runs)], pa.binary()
                    ).cast(pa.string()),
                })
                done += len(part)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text().alias("text")).mapInArrow(
        over, f"doc_id {id_type}, runs array<{RUN}>, collapsed string")


def made_periodic(docs: DataFrame) -> DataFrame:
    """doc_id and text; of every tenth text, by a hash of the id, the end repeats some words."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    words = F.filter(F.split(text(), SPACES), lambda w: w != "")
    n, g = F.col("_n"), F.col("_g")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    repeating = F.transform(
        F.col("_words"),
        lambda w, i: F.when(i < a, w).otherwise(
            F.element_at("_words", (a + (i - a) % p + 1).cast("int"))))
    altered = (
        docs.select("doc_id", text().alias("text"), h.alias("_h"))
        .withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
        .withColumn("_n", F.size("_words").cast("long"))
        .withColumn("_g", F.floor(F.col("_h") / 10))
    )
    return altered.select(
        "doc_id", F.when(n > 0, F.array_join(repeating, " ")).otherwise(F.col("text"))
        .alias("text"))


def _spelled(runs: Column) -> Column:
    lines = F.transform(runs, lambda r: F.concat(
        F.concat_ws(",", *[r[x].cast("string") for x in ("start", "length", "period")]),
        F.lit("\n")))
    return F.array_join(lines, "")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(spark, made_periodic(documents(spark, sf_dir)))

    def better(a: Column, b: Column) -> Column:
        """The run of greater length by period; the earlier in the list of equal ones."""
        return F.when(
            a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)

    best = F.aggregate("runs", F.lit(None).cast(RUN), better)
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{x}").alias(x) for x in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(_spelled(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
