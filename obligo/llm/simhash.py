"""SimHash near-deduplication over deletion-variant signatures.

A fingerprint of 64 bits is cut into two segments. Of two fingerprints that differ in at most
three bits, one segment differs in at most one. So every segment is indexed under its variants
with one bit masked out: two fingerprints meet in at least one variant of one segment if and only
if that segment differs in at most one bit. Rows with equal variants come together by an equality
shuffle and are verified by their whole bit distance.

Equal fingerprints are reduced to one before they are indexed, which removes groups of copies.
Where fingerprints share a variant, their links are not listed: within it a search from one
fingerprint after another gives a spanning forest, at most one link per member, with the same
connected components as all the links. A variant shared by more than HOT fingerprints is not
searched as it is: the other segment, which differs in at most three bits, is cut into four parts
of which one is equal, and its members are shuffled once more under each of their parts. So no
variant's members are held by one task, and the search stays near linear where they are not alike.
Components of all forests are found by alternating star contractions.

Defined cases: a null text is empty; a text without words has fingerprint zero and links like any
other; a text shorter than the shingle is one shingle; rows with a null id take part, their
component is the smallest id reachable (null if there is none); repeated rows give repeated rows;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from obligo.llm.common import (
    LOWER_BYTES,
    ROW,
    byte_texts,
    documents,
    given_back,
    id_or_zero,
    prepare,
    text,
    whole_rows,
)
from obligo.sinks.tables import stored

SEED = 42
SHINGLE = 3
MAX_DISTANCE = 3
BITS = 64
SEGMENT = 32
# Fingerprints under one variant that are searched as they are.
HOT = 4096
PART = 8  # bits of a part of the other segment; more parts than bits may differ
# Hashes whose bits are counted at a time.
COUNT_AT_ONCE = 1 << 16


def fingerprint(data: bytes, words: int = SHINGLE) -> int:
    """Bit i is set if it is set in more than half of the shingles' hashes."""
    tokens = data.translate(LOWER_BYTES).split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(words, len(tokens))
    spans = zip(starts[:len(tokens) - width + 1].tolist(), ends[width - 1:].tolist())
    hashes = np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in spans), np.uint64)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), COUNT_AT_ONCE):
        part = hashes[i:i + COUNT_AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """doc_id, ``fp`` (the fingerprint as a signed long) and the hash of the text of every row."""

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(x, words) for x in byte_texts(batch.column(1))]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "fp": np.array(values, np.uint64).view(np.int64),
                "text_hash": batch.column(2),
            })

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64(text()).alias("text_hash")).mapInArrow(
        given_back(over), f"doc_id {id_type}, fp long, text_hash long")


def variants(fps: np.ndarray) -> np.ndarray:
    """All index keys of fingerprints, one row each.

    A key is the segment with one bit masked, below it the number of the masked bit and of the
    segment in place of the other segment: segment 32 bits, segment number, masked bit.
    """
    keys = np.empty((len(fps), BITS), np.uint64)
    for s in range(BITS // SEGMENT):
        segment = (fps >> np.uint64(s * SEGMENT)) & np.uint64((1 << SEGMENT) - 1)
        for b in range(SEGMENT):
            masked = segment & ~np.uint64(1 << b)
            keys[:, s * SEGMENT + b] = (masked << np.uint64(8)) | np.uint64(s * SEGMENT + b)
    return keys


def forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what chains of fingerprints within the distance connect.

    Each fingerprint reached is compared once with those not yet reached, so a dense group costs
    about one comparison per member.
    """
    links = []
    rest = fps
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            near = np.bitwise_count(rest ^ queue[-1]) <= distance
            at = queue.pop()
            if near.any():
                found = rest[near]
                links.extend((int(at), int(x)) for x in found.view(np.int64))
                queue.extend(found)
                rest = rest[~near]
    return links


def candidate_links(distinct: DataFrame, distance: int) -> DataFrame:
    """Links between distinct fingerprints (``a``, ``b``) that keep every connection."""

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(fps), 10_000):
                part = fps[i:i + 10_000]
                yield pa.RecordBatch.from_pydict({
                    "key": variants(part).reshape(-1).view(np.int64),
                    "fp": np.repeat(part, BITS).view(np.int64),
                })

    first = (
        distinct.select("fp")
        .mapInArrow(given_back(index), "key long, fp long")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(given_back(verifier(distance, HOT)), "a long, b long, deferred boolean")
    )
    found = stored(distinct.sparkSession, first, "found-links")
    again = (
        found.filter("deferred").select("a", "b")
        .repartition("a")
        .sortWithinPartitions("a")
        .mapInArrow(given_back(verifier(distance, None)), "a long, b long, deferred boolean")
    )
    return found.filter("NOT deferred").unionByName(again).select("a", "b").distinct()


def part_keys(keys: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """For members of variants, one row each, the variant with each part of the other segment."""
    other = np.uint64(SEGMENT) - np.uint64(SEGMENT) * (
        (keys & np.uint64(255)) // np.uint64(SEGMENT))  # where the segment not indexed begins
    mix = np.uint64(0x9E3779B97F4A7C15)
    parts = []
    for i in range(SEGMENT // PART):
        value = fps >> (other + np.uint64(i * PART)) & np.uint64((1 << PART) - 1)
        mixed = (keys * mix ^ (value << np.uint64(8) | np.uint64(i))) * mix
        parts.append(mixed ^ mixed >> np.uint64(32))
    return np.stack(parts, 1)


def verifier(distance: int, hot: int | None) -> Callable:
    """A function over rows of key and fingerprint, sorted by key, that gives their links.

    Members of a key with more than ``hot`` are deferred: given back under their part keys.
    """

    def split(keys: np.ndarray, fps: np.ndarray, deferring: int | None) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        ends = np.r_[starts[1:], len(keys)]
        unsigned = fps.view(np.uint64)
        sizes = ends - starts
        late = np.zeros(len(starts), bool)
        if hot is not None:
            late = sizes > hot
            if deferring is not None:
                late |= keys[starts] == deferring
        pairs = starts[(sizes == 2) & ~late]
        near = np.bitwise_count(unsigned[pairs] ^ unsigned[pairs + 1]) <= distance
        a, b = [fps[pairs[near]]], [fps[pairs[near] + 1]]
        for s, e in zip(starts[(sizes > 2) & ~late], ends[(sizes > 2) & ~late]):
            found = np.array(forest(unsigned[s:e], distance), object).reshape(-1, 2)
            a.append(found[:, 0].astype(np.uint64).view(np.int64))
            b.append(found[:, 1].astype(np.int64))
        a, b = np.concatenate(a), np.concatenate(b)
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
        members = np.repeat(late, sizes)
        under = part_keys(keys[members].view(np.uint64), unsigned[members])
        return pa.RecordBatch.from_pydict({
            "a": np.r_[both[:, 0], under.reshape(-1).view(np.int64)],
            "b": np.r_[both[:, 1], np.repeat(fps[members], under.shape[1])],
            "deferred": np.repeat([False, True], [len(both), under.size])})

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.int64)
        deferring = None  # the last key, once it was found to be hot
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([fps, batch.column(1).to_numpy(zero_copy_only=False)])
            if not len(keys):
                continue
            whole = np.searchsorted(keys, keys[-1])  # the last key may go on in the next batch
            if hot is not None and (len(keys) - whole > hot or keys[-1] == deferring):
                before, deferring = deferring, keys[-1]
                if whole:
                    yield split(keys[:whole], fps[:whole], before)
                yield split(keys[whole:], fps[whole:], deferring)
                whole = len(keys)
            elif whole:
                yield split(keys[:whole], fps[:whole], deferring)
            keys, fps = keys[whole:], fps[whole:]
        if len(keys):
            yield split(keys, fps, deferring)

    return verify


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node of the links.

    Alternates two contractions until nothing changes: every node passes its smallest neighbour
    to its larger neighbours, then to its smaller ones. Each round is written to the shared
    folder, so a lost executor costs no more than one round.
    """

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = stored(spark, links.select("a", "b"), "links")
    mark = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Stored: a node may have most of the others as neighbours, and a join of two plain
        # exchanges can be split by size.
        smallest = stored(
            spark, both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "smallest")
        large = stored(
            spark,
            both.join(smallest, "a").filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct(),
            "large",
        )
        least = stored(spark, large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a")
        new = stored(
            spark,
            small.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
                         .alias("a"), F.col("m").alias("b"))
            .unionByName(small.select("a", F.col("m").alias("b")))
            .filter("a <> b").distinct(),
            "small",
        )
        edges, before = new, mark
        mark = state(edges)
        if mark == before:
            break
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def near_groups(spark: SparkSession, prints: DataFrame, distance: int) -> DataFrame:
    """``fp``, ``root`` and ``component_id`` for every fingerprint of a stored table."""
    distinct = stored(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(spark, candidate_links(distinct, distance))
    labelled = stored(
        spark,
        distinct.join(roots, F.col("fp") == F.col("node"), "left")
        .select("fp", "first", F.coalesce("root", "fp").alias("root")),
        "labelled",
    )
    ids = stored(
        spark, labelled.groupBy("root").agg(F.min("first").alias("component_id")), "ids")
    return stored(spark, labelled.join(ids, "root").select("fp", "root", "component_id"), "groups")


def grouped(spark: SparkSession, docs: DataFrame, words: int, distance: int) -> DataFrame:
    """doc_id, ``fp``, hash of the text, root and component of every row."""
    if not 0 <= distance <= MAX_DISTANCE:
        raise ValueError(f"two segments find at most {MAX_DISTANCE} differing bits")
    prepare(spark)
    prints = stored(spark, fingerprints(docs, words), "fingerprints")
    return prints.join(near_groups(spark, prints, distance), "fp")


def near_dedup(spark: SparkSession, docs: DataFrame, words: int = SHINGLE,
               distance: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, fingerprint and component of every row."""
    return grouped(spark, docs, words, distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def kept_rows(spark: SparkSession, docs: DataFrame, words: int = SHINGLE,
              distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows that stay with all their columns, one of each component.

    It is the row with the smallest id; of different texts with this id one stays, by the hash of
    the text, and of repeated rows one. A row without an id stays only where no other is there.
    """
    key = ["no_id", "id", "text_hash"]

    def keyed(df: DataFrame, doc_id: str, text_hash) -> DataFrame:
        return df.withColumns({
            "no_id": F.col(doc_id).isNull(), "id": id_or_zero(df, doc_id),
            "text_hash": text_hash,
        })

    stay = stored(
        spark,
        keyed(grouped(spark, docs, words, distance), "doc_id", F.col("text_hash"))
        .groupBy("root").agg(F.min(F.struct(*key)).alias("stay")).select("stay.*"),
        "stay",
    )
    rows = keyed(whole_rows(docs), f"{ROW}.doc_id", F.xxhash64(text(f"{ROW}.text")))
    return rows.join(stay, key).dropDuplicates(key).select(f"{ROW}.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(spark, documents(spark, sf_dir))
