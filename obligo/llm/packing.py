"""Sum-of-squares packing of tokenised documents into sequences of fixed length.

Every text becomes token ids and an end id; longer documents are cut into pieces of the sequence
length. A piece is placed where the sum over all gaps g of N(g) squared becomes smallest, N(g)
being the number of open sequences with g tokens left (a full sequence has no gap). Opening a new
sequence is one of the choices.

Pieces are dealt into groups of about GROUP_PIECES by a hash of their position, so a group is
bounded whatever the table holds, and each group is packed on its own, longest pieces first. The
sequences a group could not fill are packed once more as items of a smaller number of larger
rounds, until one group holds all that is left or a round brings fewer than a tenth of them
together, which leaves at most a few sequences a group unfilled; in the rounds a sequence counts as one item of its
level, so its pieces only move by an offset. Only lengths and numbers of pieces are shuffled,
never texts or ids.

Defined cases: a null or empty text is the end id alone; rows with equal or null ids are packed
each on its own; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from string import punctuation
from unicodedata import normalize

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obligo.llm.common import LOWER_BYTES, documents, given_back, prepare, stretches, text
from obligo.sinks.tables import stored

LENGTH = 4096
END_ID = 1
GROUP_PIECES = 20_000
# A sequence with at most this share of free tokens is not opened again in later rounds.
FILLED_SHARE = 0.002
# Words whose ids a worker remembers, about half of them at least.
REMEMBERED = 250_000
# Bytes of texts whose words are looked up, and whose ids are gathered, together.
CODED_BYTES, GATHERED_BYTES = 12_000_000, 2_000_000
TOGETHER = 500
# Letters from this one on have no simple lower case for sure (fixed value).
SIMPLE_LETTERS = "\u0180"
# What the tokenizer's last piece of a word ends in (fixed value).
WORD_END = "</w>"
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def plain_forms(words: pa.StringArray) -> list[str]:
    """The parts the tokenizer cuts each word into, as it spells them; empty if not plain to see.

    Letters are one part, closing punctuation another. Letters are limited to those whose lower
    case is simple.
    """
    lowered = pc.ascii_lower(words)
    signs = re.escape(punctuation)
    parted = pc.replace_substring_regex(lowered, f"^([^{signs}]+)([{signs}]+)$", r"\1 \2")
    letters = pc.utf8_is_alpha(pc.utf8_rtrim(lowered, punctuation))
    ascii_only = pc.string_is_ascii(lowered)
    forms = pc.if_else(letters, parted, "").to_pylist()
    for i in np.flatnonzero(pc.and_not(letters, ascii_only).to_numpy(zero_copy_only=False)):
        stem, space, tail = normalize("NFC", forms[i]).partition(" ")
        simple = max(stem) < SIMPLE_LETTERS and (stem := stem.lower()).isalpha()
        forms[i] = stem + space + tail if simple else ""
    return forms


class Encoder:
    """Ids of texts as little-endian 32-bit integers, with a memory of words.

    The tokenizer drops white space and never joins what white space separates, so the ids of a
    text are those of its words one after the other.
    """

    def __init__(self, path: str):
        # Spark has a worker per core already.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same model without what finds the parts of a text, for parts already found.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        # Words met lately, and those met before them: the oldest are forgotten first.
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.remembered = REMEMBERED

    @classmethod
    def of_worker(cls, path: str, remembered: int = REMEMBERED) -> Encoder:
        """The encoder of this Python worker, which outlives its tasks."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        _ENCODERS[path].remembered = remembered
        return _ENCODERS[path]

    def _learn(self, words: list[str]) -> None:
        """Encodes plain words many at a time, cut where their last part ends, others alone."""
        forms = plain_forms(pa.array(words, pa.string()))
        others = [w for w, form in zip(words, forms) if not form]
        plain = [w for w, form in zip(words, forms) if form]
        forms = [form for form in forms if form]
        for i in range(0, len(plain), TOGETHER):
            some, spelled = plain[i:i + TOGETHER], forms[i:i + TOGETHER]
            ids = np.array(self.model.encode_batch_fast(
                [" ".join(spelled)], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
            last = np.cumsum([1 + (" " in form) for form in spelled]) - 1
            if len(ends) != last[-1] + 1:
                others += some
                continue
            flat, cuts = ids.tobytes(), ends[last].tolist()
            self.memory.update(zip(some, [flat[s:e] for s, e in zip([0, *cuts], cuts)]))
        if others:
            found = self.tokenizer.encode_batch(others, add_special_tokens=False)
            self.memory.update(
                (w, np.array(x.ids, "<u4").tobytes()) for w, x in zip(others, found))

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of words, which may repeat."""
        get = self.memory.get
        found = [get(w) for w in words]
        missing = [i for i, x in enumerate(found) if x is None]
        if not missing:
            return found
        if len(self.memory) > self.remembered:
            self.memory, self.older = {}, self.memory
        new = []
        for word in dict.fromkeys(words[i] for i in missing):
            if word in self.older:
                self.memory[word] = self.older[word]
            else:
                new.append(word)
        self._learn(new)
        for i in missing:
            found[i] = self.memory[words[i]]
        return found

    def encode(self, value: str) -> bytes:
        """Ids of one text. Case makes no difference, but for the names of special tokens."""
        data = value.encode()
        words = (data if b"<|" in data else data.translate(LOWER_BYTES)).split()
        return b"".join(self.ids_of([w.decode() for w in words]))

    def encode_all(self, texts: pa.StringArray) -> Iterator[bytes]:
        """Ids of many texts: every distinct word is looked up once, the ids are gathered."""
        if pc.any(pc.match_substring(texts, "<|")).as_py():
            yield from (self.encode(x) for x in texts.to_pylist())
            return
        splits = [pc.ascii_split_whitespace(pc.ascii_lower(x))
                  for x in stretches(texts, GATHERED_BYTES)]
        cuts = [x.offsets.to_numpy() - x.offsets[0].as_py() for x in splits]
        coded = pa.chunked_array([x.flatten() for x in splits], pa.string())
        del splits
        coded = coded.dictionary_encode().unify_dictionaries().chunks
        values = self.ids_of(coded[0].dictionary.to_pylist() if coded else [])
        sizes = np.fromiter(map(len, values), np.int32, len(values)) // 4
        starts = np.cumsum(sizes, dtype=np.int32) - sizes
        flat = np.frombuffer(b"".join(values), "<u4")
        for part, ends in zip(coded, cuts):
            at = part.indices.to_numpy()
            word_sizes = sizes[at]
            word_ends = np.cumsum(word_sizes, dtype=np.int32)
            places = np.repeat(starts[at] - (word_ends - word_sizes), word_sizes)
            places += np.arange(len(places), dtype=np.int32)
            ids = flat[places].tobytes()
            bounds = (np.r_[0, word_ends][ends].astype(np.int64) * 4).tolist()
            yield from (ids[s:e] for s, e in zip(bounds[:-1], bounds[1:]))


_ENCODERS: dict[str, Encoder] = {}


def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to about CODED_BYTES, so that a common word is looked up less often."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= CODED_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def pieces(docs: DataFrame, length: int = LENGTH, path: str | None = None,
           remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, piece, start, length and checksum of the ids of every piece."""
    path = path or tokenizer_path()
    end = np.array([END_ID], "<u4").tobytes()

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of_worker(path, remembered)
        for batch in gathered(batches):
            at, number, start, size, checksum = [], [], [], [], []
            for row, ids in enumerate(encoder.encode_all(batch.column(1))):
                ids += end
                for k, s in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[s:s + 4 * length]
                    at.append(row)
                    number.append(k)
                    start.append(s // 4)
                    size.append(len(part) // 4)
                    checksum.append(zlib.crc32(part))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).take(pa.array(at, pa.int64())),
                "piece": pa.array(number, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(size, pa.int64()),
                "ids_crc32": pa.array(checksum, pa.int64()),
            })

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text().alias("text")).mapInArrow(
        given_back(over), f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the sequence and offset in it of every item, in the order given.

    Placing an item of size s into a gap g takes one from N(g) and adds one to N(g - s); the sum
    of squares changes by 2 (N(g - s) - N(g) + 1), without the first part where g - s is zero.
    Of equal changes the smallest gap is taken, a new sequence last.
    """
    count = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence = np.empty(len(sizes), np.int64)
    offset = np.empty(len(sizes), np.int64)
    made = 0
    for i, s in enumerate(sizes.tolist()):
        open_gaps = np.flatnonzero(count[s:capacity]) + s
        new_change = 2 * count[capacity - s] + 1 if s < capacity else 0
        gap = capacity
        if len(open_gaps):
            left = open_gaps - s
            change = 2 * (1 - count[open_gaps]) + 2 * np.where(left > 0, count[left], 0)
            change -= left == 0
            best = int(np.argmin(change))
            if change[best] <= new_change:
                gap = int(open_gaps[best])
        if gap == capacity:
            number, made = made, made + 1
        else:
            number = bins[gap].pop()
            count[gap] -= 1
        sequence[i], offset[i] = number, capacity - gap
        if gap > s:
            bins[gap - s].append(number)
            count[gap - s] += 1
    return sequence, offset


def round_of(items: DataFrame, groups: int, capacity: int) -> DataFrame:
    """Packs items (``item``, ``level``) in groups; adds ``sequence`` and ``place`` in it."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["level", "item"], ascending=[False, True], kind="stable")
        sequence, place = sum_of_squares(group["level"].to_numpy(), capacity)
        # The smallest item names the sequence, so names are the same whenever a task is repeated.
        name = group["item"].groupby(sequence).transform("min")
        return pd.DataFrame({"item": group["item"], "level": group["level"],
                             "sequence": name, "place": place})

    return (
        items.withColumn("dealt", F.pmod(F.xxhash64("item"), F.lit(groups)))
        .groupBy("dealt")
        .applyInPandas(pack, "item long, level long, sequence long, place long")
    )


def packed(spark: SparkSession, docs: DataFrame, length: int = LENGTH,
           group_pieces: int = GROUP_PIECES, path: str | None = None,
           remembered: int = REMEMBERED) -> DataFrame:
    """Every piece with the sequence it belongs to and its offset there.

    ``remembered`` bounds the words whose ids a worker keeps; the ids do not depend on it.
    """
    prepare(spark)
    # Stored, so that the numbers of the pieces stay the same whatever is computed again.
    table = stored(spark, pieces(docs, length, path, remembered).withColumn(
        "item", F.monotonically_increasing_id()), "pieces")
    whole = table.filter(F.col("length") == length).withColumns(
        {"sequence_id": F.col("item"), "offset": F.lit(0).cast("long")})
    items = table.filter(F.col("length") < length).select("item", F.col("length").alias("level"))
    # ``places`` maps items to sequences; a later round maps sequences to sequences.
    n, rounds = items.count(), []
    while n:
        groups = -(-n // group_pieces)
        done = stored(spark, round_of(items, groups, length), "packed")
        rounds.append(done)
        if groups == 1:
            break
        levels = done.groupBy("sequence").agg(F.sum("level").alias("level"))
        items = stored(
            spark,
            levels.filter(F.col("level") < length * (1 - FILLED_SHARE))
            .select(F.col("sequence").alias("item"), "level"),
            "unfilled",
        )
        left = items.count()
        if left > 0.9 * n:  # nearly all items are too long to share a sequence
            break
        n = left
    part = table.filter(F.col("length") < length)
    if not rounds:
        return _output(whole)
    part = part.join(rounds[0].select("item", "sequence", "place"), "item")
    for done in rounds[1:]:
        moved = done.select(F.col("item").alias("sequence"), F.col("sequence").alias("later"),
                            F.col("place").alias("shift"))
        part = part.join(moved, "sequence", "left").select(
            *[c for c in part.columns if c not in ("sequence", "place")],
            F.coalesce("later", "sequence").alias("sequence"),
            (F.col("place") + F.coalesce("shift", F.lit(0))).alias("place"),
        )
    part = part.withColumns({"sequence_id": F.col("sequence"), "offset": F.col("place")})
    return _output(whole).unionByName(_output(part))


def _output(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark, documents(spark, sf_dir))
