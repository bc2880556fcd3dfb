"""Reading large JSON arrays in many tasks.

A file that holds one JSON array has no border that a reader could split it at without reading all
before: a brace may stand in a text, and whether it does depends on every quote before it. Spark's
own reader therefore takes such a file in one task. Here the file is read in fragments that end at
closing braces, by splits as any text file. What a fragment changes is known without what comes
before it: the number of quotes and, for either state at its start, the braces outside texts. Sums
of these over the fragments before give the state and the depth at each fragment, so the borders of
the documents; sums are made within each split and carried over the splits, one row per split.
They are made of the numbers alone; the texts are shuffled once by split and once by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obligo.sinks.tables import stored

CLOSING = "}"
_SPLIT = ["file", "split"]


def _before(value: str) -> Column:
    """Sum of ``value`` over the rows of the split before each, with what its seed brings."""
    rows = Window.partitionBy(*_SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(rows), F.lit(0))


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _followed(fragments: DataFrame, seeds: DataFrame) -> DataFrame:
    """State, depth and number at each fragment, as far as the seeds of the splits bring them.

    A seed is a row before the first fragment of a split, with the sums over the splits before, so
    running sums within the split begin with it. All sums have one window: one shuffle, one sort.
    """
    seed = F.col("at") < 0
    rows = fragments.unionByName(seeds, allowMissingColumns=True)
    rows = rows.withColumn("open", _before("quotes") % 2)
    # A brace within a text closes nothing.
    rows = rows.withColumn("closes", ((F.col("open") + F.col("quotes")) % 2 == 0).cast("int"))
    opens = F.when(F.col("open") == 0, F.col("opens")).otherwise(F.col("opens_within"))
    rows = rows.withColumn("change", F.when(seed, F.col("depth")).otherwise(opens - F.col("closes")))
    rows = rows.withColumn("after", _before("change") + F.col("change"))
    ends = ((F.col("closes") == 1) & (F.col("after") == 0)).cast("int")
    rows = rows.withColumn("ends", F.when(seed, F.col("number")).otherwise(ends))
    return rows.withColumn("documents_before", _before("ends"))


def _seeds(rows: DataFrame, value: str, name: str, kept: list[str]) -> DataFrame:
    """The seeds of all splits, one row for each: those ``kept`` and the sums of ``value``."""
    seed = F.col("at") < 0
    over = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*_SPLIT).agg(
        F.sum(F.when(~seed, F.col(value))).cast("long").alias("_sum"),
        *[F.sum(F.when(seed, F.col(k))).cast("long").alias(k) for k in kept])
    return stored(rows.sparkSession, sums.select(
        *_SPLIT, F.lit(-1).cast("long").alias("at"), *kept,
        F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias(name)), "json-seeds")


def json_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The objects of JSON arrays as texts: file, number of the object in it, and object.

    Also takes objects one after the other without an array round them. Only valid JSON is split
    rightly. An object is put together in one task; a file of any size is not.
    """
    value = F.col("value")
    # Escaped signs are no quotes. No escape ends in a brace, so none spans two fragments.
    plain = F.when(F.contains(value, F.lit("\\")), F.regexp_replace(value, r"\\.", "")).otherwise(
        value)
    # Outside of texts is every other part, from the first where no text was open before.
    outside = F.array_join(
        F.filter(F.split("_plain", '"', -1), lambda part, i: i % 2 == 0), "")
    text = spark.read.option("lineSep", CLOSING).text(paths)
    fragments = stored(spark, text.select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), plain.alias("_plain"))
        .withColumn("quotes", _count(F.col("_plain"), '"').cast("long"))
        .withColumn("opens", _count(outside, "{"))
        .withColumn("opens_within", _count(F.col("_plain"), "{") - F.col("opens"))
        .drop("_plain"), "json-fragments")
    # The numbers go through these sums without the texts.
    sizes = fragments.drop("value").withColumns(
        {name: F.lit(None).cast("long") for name in ("depth", "number")})
    seeds = _seeds(sizes, "quotes", "quotes", [])
    seeds = _seeds(_followed(sizes, seeds), "change", "depth", ["quotes"])
    seeds = _seeds(_followed(sizes, seeds), "ends", "number", ["quotes", "depth"])
    numbered = _followed(fragments, seeds).filter(F.col("at") >= 0)
    # What comes after the last object of a file ends none.
    return (
        numbered.groupBy("file", F.col("documents_before").alias("number"))
        .agg(F.sum("ends").alias("ends"),
             F.array_sort(F.collect_list(F.struct("split", "at", "value"))).alias("parts"))
        .filter(F.col("ends") > 0)
        .select("file", "number", F.regexp_replace(F.concat(F.array_join(
            F.transform("parts", lambda p: p["value"]), CLOSING), F.lit(CLOSING)),
            r"^[\s,\[]+", "").alias("document"))
    )


def read_json_arrays(spark: SparkSession, paths: str | list[str],
                     schema: T.StructType | str) -> DataFrame:
    """The objects of JSON arrays with a declared schema, as Spark's reader gives them."""
    found = json_documents(spark, paths)
    return found.select(F.from_json("document", schema).alias("_row")).select("_row.*")
