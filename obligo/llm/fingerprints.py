"""Document fingerprints by Order MinHash, with DataFrame functions only.

The k-mers of a text are its runs of KMER words (shorter at its end). Each gets the number of its
occurrence, so repeats count. A hash deals the numbered k-mers into BINS bins and orders them
there; in every bin the PICKED smallest are selected, put back into the order they have in the
text, and hashed as a tuple. Exchanged passages thus change the signature although the set of
k-mers stays, which makes it follow the edit distance and not only the common content. One hash
with bins stands for one order per signature element. Two signatures are as alike as the share of
their filled bins that are equal.

A hash and the position share one long: the upper 40 bits are the hash, the lower 24 the position.
Positions beyond that wrap, which only weakens the order within texts of over 16 million words.

Equal texts have equal fingerprints; texts without words have the empty one and are alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obligo.llm.common import documents, id_or_zero, text
from obligo.sinks.tables import stored

KMER = 3
BIN_BITS = 5
BINS = 1 << BIN_BITS
POSITION_BITS = 24
PLACE = (1 << POSITION_BITS) - 1
SPACE = r"[\x20\x09-\x0D]+"
# Documents of one piece of the global order, about.
ORDERED_TOGETHER = 20_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hash_part(numbered: Column) -> Column:
    return numbered.bitwiseAND(F.lit(~PLACE))


def bin_of(numbered: Column) -> Column:
    return F.shiftright(numbered, 64 - BIN_BITS)


def kmers(words: Column) -> Column:
    """Hash and position of every k-mer, in the order of the hash, repeats in text order."""
    return F.sort_array(F.transform(words, lambda word, i: hash_part(
        F.xxhash64(word, *[F.get(words, i + j) for j in range(1, KMER)])
    ).bitwiseOR(i.cast("long").bitwiseAND(F.lit(PLACE)))))


def changes(values: Column, part: Callable[[Column], Column]) -> Column:
    """Indexes of a sorted array at which a part of the value is another than before."""
    return F.filter(
        F.sequence(F.lit(0), F.size(values) - 1),
        lambda i: (i == 0) | (part(F.get(values, i)) != part(F.get(values, i - 1))),
    )


def occurrence_numbered(sorted_kmers: Column) -> Column:
    """First occurrences keep their hash, the j-th repeat gets one of k-mer and j; sorted."""

    def numbered(starts: Column) -> Column:
        def length(r: Column) -> Column:
            return F.coalesce(F.get(starts, r + 1), F.size(sorted_kmers)) - F.get(starts, r)

        def repeats(r: Column) -> Column:
            def again(j: Column) -> Column:
                own = F.get(sorted_kmers, F.get(starts, r) + j)
                return hash_part(F.xxhash64(hash_part(own), j)).bitwiseOR(
                    own.bitwiseAND(F.lit(PLACE)))

            return F.transform(F.sequence(F.lit(1), length(r) - 1), again)

        repeated = F.filter(F.sequence(F.lit(0), F.size(starts) - 1), lambda r: length(r) > 1)
        return F.sort_array(F.concat(
            F.transform(starts, lambda i: F.get(sorted_kmers, i)),
            F.flatten(F.transform(repeated, repeats)),
        ))

    return let(changes(sorted_kmers, hash_part), numbered)


def tuples(numbered: Column) -> Column:
    """Hash per bin of its two smallest k-mers in text order; null for an empty bin."""

    def entry(i: Column) -> Column:
        one, two = F.get(numbered, i), F.get(numbered, i + 1)
        in_order = one.bitwiseAND(F.lit(PLACE)) <= two.bitwiseAND(F.lit(PLACE))
        first, second = hash_part(one), hash_part(two)
        alone = two.isNull() | (bin_of(one) != bin_of(two))
        hashed = F.when(alone, F.xxhash64(first)).when(in_order, F.xxhash64(first, second))
        return F.struct(
            bin_of(one).alias("bin"),
            hashed.otherwise(F.xxhash64(second, first)).bitwiseAND(F.lit(0xFFFFFFFF))
            .alias("hash"),
        )

    return let(
        F.transform(changes(numbered, bin_of), entry),
        lambda entries: F.transform(
            F.sequence(F.lit(-BINS // 2).cast("long"), F.lit(BINS // 2 - 1).cast("long")),
            lambda b: F.get(F.filter(entries, lambda e: e["bin"] == b), F.lit(0))["hash"],
        ),
    )


def signature(value: Column) -> Column:
    """The signature of a text: BINS numbers, null where a bin is empty."""
    words = F.array_remove(F.split(value, SPACE), "")
    filled = let(words, lambda w: F.when(
        F.size(w) > 0, let(kmers(w), lambda k: let(occurrence_numbered(k), tuples))))
    return F.coalesce(filled, F.array_repeat(F.lit(None).cast("long"), BINS))


def as_text(sketch: Column) -> Column:
    """Eight hex digits per bin, a dash for an empty one."""
    return F.array_join(F.transform(sketch, lambda x: F.coalesce(
        F.lower(F.lpad(F.hex(x), 8, "0")), F.lit("-"))), ".")


def likeness(one: Column, other: Column) -> Column:
    """Share of equal bins among those that are filled in either signature."""
    filled = F.size(F.filter(F.arrays_zip(one.alias("a"), other.alias("b")),
                             lambda x: x["a"].isNotNull() | x["b"].isNotNull()))
    equal = F.size(F.filter(F.arrays_zip(one.alias("a"), other.alias("b")),
                            lambda x: x["a"] == x["b"]))
    return F.when(filled == 0, F.lit(1.0)).otherwise(equal / filled)


# -- the next document --------------------------------------------------------------------

KEY = ["id", "no_id", "text_hash"]


def keyed(docs: DataFrame) -> DataFrame:
    """Key and text, and nothing else, so that both uses of the rows share one exchange."""
    return docs.select(
        id_or_zero(docs).alias("id"), F.col("doc_id").isNull().alias("no_id"),
        F.xxhash64(text()).alias("text_hash"), text().alias("text"))


def successors(spark: SparkSession, keys: DataFrame, rows: int) -> DataFrame:
    """Every key with the next in descending order of the id, the last with the first.

    The order is made by range partitioning and stored with the number of the partition. Within a
    partition the next key is the next row; a window over one row per partition links them.
    """
    parts = max(1, -(-rows // ORDERED_TOGETHER))
    order = [F.col("no_id").asc(), F.col("id").desc(), F.col("text_hash").desc()]
    ranged = stored(
        spark,
        keys.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()),
        "ordered",
    )
    within = Window.partitionBy("part").orderBy(*order)
    inner = ranged.withColumn("next", F.lead(F.struct(*KEY)).over(within))
    heads = ranged.groupBy("part").agg(F.max(F.struct(
        (~F.col("no_id")).alias("has_id"), "id", "text_hash")).alias("h"))
    # One row per partition of the order.
    ends = Window.orderBy("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding,
                                               Window.unboundedFollowing)
    heads = heads.select("part", F.struct(
        "h.id", (~F.col("h.has_id")).alias("no_id"), "h.text_hash").alias("head"))
    linked = heads.select("part", F.coalesce(
        F.lead("head").over(ends), F.first("head").over(whole)).alias("head"))
    return inner.join(linked, "part").select(
        *KEY, "n_chars", F.coalesce("next", "head").alias("next"))


def fingerprinted(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documented columns of every row, with signatures as numbers.

    The text is shuffled once, by its key; from there the beginning that the predecessor needs
    goes to the predecessor's key. Rows that repeat id and text are one document in the order.
    """
    rows = keyed(docs)
    keys = stored(
        spark,
        rows.select(*KEY, F.length("text").cast("long").alias("n_chars")).distinct(), "keys")
    n = keys.count()
    pairs = stored(
        spark,
        successors(spark, keys, n).select(
            *[F.col(f"next.{c}").alias(c) for c in KEY],
            F.struct(*KEY).alias("before"),
            F.floor(F.col("n_chars") / 3).cast("int").alias("taken")),
        "pairs",
    )
    signed = rows.withColumn("sketch", signature(F.col("text")))
    beginnings = signed.join(pairs, KEY).select(
        *[F.col(f"before.{c}").alias(c) for c in KEY], "taken",
        F.expr("substring(text, 1, taken)").alias("beginning"),
        F.col("sketch").alias("next_sketch"),
    )
    if rows.count() > n:  # repeated rows
        beginnings = beginnings.dropDuplicates(KEY)
    return signed.join(beginnings, KEY).withColumns({
        "doc_id": F.when(~F.col("no_id"), F.col("id")),
        "edited": F.concat(F.expr("substring(text, 1, length(text) - taken)"), "beginning"),
    })


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited = fingerprinted(spark, documents(spark, sf_dir)).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), "sketch", "next_sketch",
        signature(F.col("edited")).alias("edited_sketch"))
    return edited.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
