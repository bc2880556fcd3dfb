"""Mixing sources to target weights by temperature.

The token share p of a source becomes the weight p**a / sum(p**a). The exponent a is bisected in
[0, 1]: it is the largest at which the weights reach the target entropy, but never so small that a
source would be repeated more often than the limit. The weights are realised by passes over block
permutations: the documents of a source fall into BLOCKS blocks by a hash, every pass takes the
blocks in an order of its own, and the last pass ends where the token budget of the source is
used up, within a block at a document.

A source may hold any part of the rows. Its tokens are added up per block before they are
shuffled, and the only ordered sums run over the BLOCKS blocks of a source and over the documents
of the one block that the budget cuts. What decides about a row is four numbers per source, so
texts are not shuffled where the table of sources is small enough for Spark to broadcast.

Defined cases: a document has one token per word and one for its end, so an empty or null text has
one; documents without a source form one of their own; repeated rows are documents of their own
that are taken together; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obligo.llm.common import ROW, documents, text, whole_rows
from obligo.sinks.tables import stored

BLOCKS = 1024
# Entropy of the weights to reach, as a share of that of equal weights.
TARGET_ENTROPY = 0.95
# Most passes over a source, and tokens to take as a share of those there are.
MOST_PASSES = 4.0
BUDGET = 1.0
SEED = 20
# Points of one job of the bisection (each job halves the interval four times), and its end.
POINTS, PRECISION = 15, 1e-6


def keyed(df: DataFrame, doc_id: Column, source: Column, value: Column) -> DataFrame:
    """Adds key of the source, tokens, hash of the document and its block."""
    return df.withColumns({
        "mix_key": F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("")),
        "mix_tokens": F.regexp_count(value, F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + 1,
        "mix_hash": F.xxhash64(F.lit(SEED), doc_id, value),
    }).withColumn("mix_block", F.pmod("mix_hash", F.lit(BLOCKS)).cast("int"))


def block_order(number: Column) -> Column:
    """Place of a block in the permutation of a pass."""
    return F.xxhash64(F.lit(SEED), number, "mix_key", "mix_block")


def document_order(number: Column) -> Column:
    return F.xxhash64(F.lit(SEED), number, "mix_hash")


def exponent(sources: DataFrame, target_entropy: float, most_passes: float,
             budget: float) -> float:
    """The exponent for a stored table of sources with their ``share``."""
    n, least = sources.agg(F.count(F.lit(1)), F.min("share")).first()
    if n < 2:
        return 1.0

    def fits(points: list[float]) -> list[bool]:
        """Whether an exponent is small enough for the entropy and too small for the limit."""
        sums = sources.agg(*[
            x for a in points for x in (
                F.sum(F.pow("share", F.lit(a))),
                F.sum(F.pow("share", F.lit(a)) * F.log("share")))
        ]).first()
        entropies = [math.log(sums[2 * i]) - a * sums[2 * i + 1] / sums[2 * i]
                     for i, a in enumerate(points)]
        passes = [budget * least ** (a - 1) / sums[2 * i] for i, a in enumerate(points)]
        return [h >= target_entropy * math.log(n) or r > most_passes
                for h, r in zip(entropies, passes)]

    low, high = 0.0, 1.0  # low fits, or is where the search ends; high does not
    if fits([1.0])[0]:
        return 1.0
    while high - low > PRECISION:
        step = (high - low) / (POINTS + 1)
        points = [low + step * (i + 1) for i in range(POINTS)]
        held = fits(points)
        low = max([low, *(p for p, ok in zip(points, held) if ok)])
        high = min(high, low + step)
    return round(low, 5)


def plan(spark: SparkSession, docs: DataFrame, target_entropy: float = TARGET_ENTROPY,
         most_passes: float = MOST_PASSES, budget: float = BUDGET) -> DataFrame:
    """One row per source: its share, weight, whole passes and where the last pass ends."""
    narrow = stored(
        spark,
        keyed(docs.select("doc_id", "source", text().alias("text")), F.col("doc_id"),
              F.col("source"), F.col("text"))
        .select("mix_key", "mix_tokens", "mix_hash", "mix_block"),
        "mix-documents",
    )
    blocks = stored(
        spark,
        narrow.groupBy("mix_key", "mix_block").agg(F.sum("mix_tokens").alias("tokens")),
        "mix-blocks",
    )
    per_source = blocks.groupBy("mix_key").agg(F.sum("tokens").alias("total"))
    everything = blocks.agg(F.sum("tokens")).first()[0] or 0
    sources = stored(
        spark, per_source.withColumn("share", F.col("total") / F.lit(everything)), "mix-sources")
    a = exponent(sources, target_entropy, most_passes, budget)
    scale = sources.agg(F.sum(F.pow("share", F.lit(a)))).first()[0] or 1.0
    weights = sources.withColumns({
        "exponent": F.lit(a),
        "weight": F.pow("share", F.lit(a)) / F.lit(scale),
    }).withColumn("wanted", F.round(F.col("weight") * F.lit(budget * everything)).cast("long"))
    weights = weights.withColumns({
        "passes": F.expr("wanted div total").cast("int"),
        "rest": F.expr("wanted % total"),
    })

    in_order = Window.partitionBy("mix_key").orderBy("block_at", "mix_block").rowsBetween(
        Window.unboundedPreceding, 0)
    cut = (
        blocks.join(weights.select("mix_key", "passes", "rest"), "mix_key")
        .withColumn("block_at", block_order(F.col("passes")))
        .withColumn("up_to", F.sum("tokens").over(in_order))
        .filter((F.col("up_to") > F.col("rest")) & (F.col("up_to") - F.col("tokens")
                                                    <= F.col("rest")))
        .select("mix_key", "mix_block", "passes", "block_at",
                (F.col("rest") - F.col("up_to") + F.col("tokens")).alias("left"))
    )
    cut = stored(spark, cut, "mix-cut")
    within = Window.partitionBy("mix_key").orderBy("document_at").rowsBetween(
        Window.unboundedPreceding, 0)
    last = (
        narrow.join(cut, ["mix_key", "mix_block"])
        .withColumn("document_at", document_order(F.col("passes")))
        .withColumn("up_to", F.sum("mix_tokens").over(within))
        # Up to the document of which more than half would be over the budget.
        .filter(F.col("up_to") * 2 - F.col("mix_tokens") <= F.col("left") * 2)
        .groupBy("mix_key").agg(F.max("document_at").alias("last_document"))
    )
    return stored(
        spark,
        weights.join(cut.select("mix_key", F.col("block_at").alias("last_block")), "mix_key",
                     "left")
        .join(last, "mix_key", "left"),
        "mix-plan",
    )


def taken(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Keyed rows, each as often as it is taken, with the number of the pass."""
    at = block_order(F.col("passes"))
    partial = (at < F.col("last_block")) | (
        (at == F.col("last_block"))
        & F.coalesce(document_order(F.col("passes")) <= F.col("last_document"), F.lit(False)))
    copies = F.col("passes") + F.coalesce(partial, F.lit(False)).cast("int")
    return (
        rows.join(decided.drop("total"), "mix_key")
        .withColumn("mix_copies", copies)
        .filter("mix_copies > 0")
        .withColumn("mix_pass", F.explode(F.sequence(F.lit(0), F.col("mix_copies") - 1)))
    )


def mixed(spark: SparkSession, docs: DataFrame, **targets: float) -> DataFrame:
    """One row for every time a document is taken, with pass, block and place of the block."""
    decided = plan(spark, docs, **targets)
    rows = keyed(docs.select("doc_id", "source", text().alias("text")), F.col("doc_id"),
                 F.col("source"), F.col("text"))
    return taken(rows.drop("text"), decided).select(
        "doc_id", "source", F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_pass").alias("pass"), F.col("mix_block").alias("block"),
        block_order(F.col("mix_pass")).alias("block_order"),
        document_order(F.col("mix_pass")).alias("document_order"), "weight", "exponent",
    )


def mixed_rows(spark: SparkSession, docs: DataFrame, **targets: float) -> DataFrame:
    """The taken rows with all their columns; a row taken in two passes is there twice."""
    decided = plan(spark, docs, **targets)
    rows = keyed(whole_rows(docs), F.col(f"{ROW}.doc_id"), F.col(f"{ROW}.source"),
                 text(f"{ROW}.text"))
    return taken(rows, decided).select(f"{ROW}.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(spark, documents(spark, sf_dir))
