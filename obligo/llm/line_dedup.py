"""Deduplication of lines that several documents share.

Lines are exploded with their position and normalised to keys; a key is hashed to 128 bits, and
per hash the documents are counted. Lines of keys over the threshold go in every document but the
one with the largest id; the lines that stay are put together again by position.

What is shuffled are hashes: a line that a third of all documents hold is one partial count per
task, and in the join its rows are split by size. The text itself is shuffled once, to meet the
positions it loses.

Defined cases: a null or empty text is one empty line; a document is counted by its id, so rows
that share an id count once, and all rows with the largest id keep their lines; rows without an id
count as one document smaller than any other; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obligo.llm.common import documents, id_or_zero, lower_ascii, text
from obligo.sinks.tables import stored

LEAST_LENGTH = 20
LEAST_DOCUMENTS = 3
# White space that a key has none of at its ends (fixed values).
SPACE = " \t\n\x0b\x0c\r"


def key_of(line: Column) -> Column:
    return lower_ascii(F.trim(line, F.lit(SPACE)))


def lines_of(docs: DataFrame, least_length: int) -> DataFrame:
    """doc_id, hash of the text, position and hash of the key (two longs) of every line."""
    return (
        docs.select("doc_id", text().alias("text"))
        .select("doc_id", F.xxhash64("text").alias("text_hash"),
                F.posexplode(F.split("text", "\n", -1)).alias("position", "line"))
        .filter(F.length("line") >= least_length)
        .withColumn("line_key", key_of(F.col("line")))
        .filter(F.length("line_key") >= least_length)
        .select("doc_id", "text_hash", "position", F.xxhash64("line_key").alias("h1"),
                F.xxhash64(F.lit(1), "line_key").alias("h2"))
    )


def line_dedup(spark: SparkSession, docs: DataFrame, least_length: int = LEAST_LENGTH,
               least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """doc_id, number of lines, number of dropped lines and the text that is left."""
    lines = stored(spark, lines_of(docs, least_length), "lines")
    shared = stored(
        spark,
        lines.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
        .filter(F.col("n") >= least_documents).select("h1", "h2", "keeper"),
        "shared-lines",
    )
    lost = stored(
        spark,
        lines.join(shared, ["h1", "h2"])
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(id_or_zero(docs).alias("id"),
                 F.col("doc_id").isNull().alias("no_id"), "text_hash")
        .agg(F.collect_set("position").alias("lost")),
        "lost-lines",
    )
    whole = docs.select("doc_id", text().alias("text")).withColumns({
        "id": id_or_zero(docs), "no_id": F.col("doc_id").isNull(),
        "text_hash": F.xxhash64("text"),
    })
    joined = whole.join(lost, ["id", "no_id", "text_hash"], "left")
    parts = joined.select("doc_id", "lost", F.split("text", "\n", -1).alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "lost")
    kept = F.when(F.col("lost").isNull(), F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"))
    return parts.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(spark, documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS position
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
    FROM lines
), shared AS (
    SELECT line_key, max(doc_id) AS keeper FROM keyed WHERE length(line_key) >= 20
    GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.*, s.keeper IS NOT NULL AND s.keeper <> k.doc_id AS lost
    FROM keyed k LEFT JOIN shared s USING (line_key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT lost), ''))
           AS kept_sha256
FROM marked GROUP BY doc_id
"""
