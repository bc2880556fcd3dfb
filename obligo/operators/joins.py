"""Joining facts to dimensions whose size has been measured."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Broadcast threshold of the published configuration, in bytes (fixed value).
BROADCAST_BYTES = 50_000_000
SALTS = 64
# A key is hot with this share of the rows; there are at most its inverse of them.
HOT_SHARE = 0.001
# Keys the sketch tracks: its error is then well below the share.
TRACKED = 16_384
# Hash slots of the bitmaps that stand for a list of keys.
SLOTS = 1 << 28


@dataclass(frozen=True)
class Sized:
    """A DataFrame with its measured size in bytes."""

    df: DataFrame
    n_bytes: int
    limit: int = BROADCAST_BYTES

    def fits(self, limit: int | None = None) -> bool:
        return self.n_bytes <= (self.limit if limit is None else limit)


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of one row: 16 for the row, 8 per column, and the texts."""
    size: Column = F.lit(16 + 8 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
    return size


def measure(frames: dict[str, DataFrame], limit: int = BROADCAST_BYTES) -> dict[str, Sized]:
    """Measures several small tables in one job.

    The measurement is one map-side aggregate per table, so a table that turns out to be large
    costs a scan and never reaches the driver. Each table is persisted, so that what was
    measured is what is joined, and it is not derived again by every job that uses it.
    """
    kept = {name: frame.persist() for name, frame in frames.items()}
    total = None
    for name, frame in kept.items():
        part = frame.agg(F.coalesce(F.sum(_row_bytes(frame)), F.lit(0)).alias("n_bytes")).select(
            F.lit(name).alias("name"), "n_bytes"
        )
        total = part if total is None else total.unionByName(part)
    found = {row["name"]: row["n_bytes"] for row in total.collect()} if kept else {}
    return {name: Sized(frame, int(found[name]), limit) for name, frame in kept.items()}


def release(sized: dict[str, Sized]) -> None:
    """Gives back what ``measure`` persisted."""
    for part in sized.values():
        part.df.unpersist()


def measured_bytes(df: DataFrame) -> int:
    """Size of a stored table in bytes, by one map-side aggregate."""
    return int(df.agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()[0])


def _key_hash(on: list[str]) -> Column:
    """A hash of the key that is the same where only the types of the columns differ."""
    return F.xxhash64(*[F.col(c).cast("string") for c in on])


def heavy_keys(facts: DataFrame, on: list[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that at least this share of the rows have, by a frequent-items sketch.

    The sketch counts the most frequent keys of its part of the rows and drops the others, and
    sketches add up, so one scan of the key columns and one row per task find them. A key above
    the share is never missed; a missing key counts as one.
    """
    found = facts.select(_key_hash(on).alias("h")).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(h, {round(1 / share)}, {TRACKED})").alias("top")).first()
    return [r["item"] for r in found["top"] or [] if r["count"] >= share * found["n"]]


def bitmaps(slots: DataFrame, slot: str = "slot") -> DataFrame:
    """A set of slot numbers as bitmaps of 4 KB: ``bitmap`` is its number, ``bits`` what is set.

    The numbers are dealt by bitmap first, so that no task makes bitmaps that others make too.
    """
    return (
        slots.select(F.bitmap_bucket_number(slot).alias("bitmap"),
                     F.bitmap_bit_position(slot).alias("at"))
        .repartition("bitmap").groupBy("bitmap").agg(F.bitmap_construct_agg("at").alias("bits")))


def in_bitmaps(df: DataFrame, slot: Column, maps: DataFrame) -> DataFrame:
    """Rows whose slot is set in the bitmaps, which are broadcast.

    A semi join: Spark would move a later one below an inner join, and its shuffle with it.
    """
    placed = df.withColumn("_slot", slot)
    at = F.bitmap_bit_position("_slot")
    byte = F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1
    return placed.join(
        F.broadcast(maps), (F.bitmap_bucket_number("_slot") == F.col("bitmap")) & is_set, "left_semi"
    ).select(*df.columns)


def maybe_listed(df: DataFrame, listed: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose key is listed, and a few others whose key shares a hash slot with those.

    Before a join by a shuffle this leaves rows where they are that it would drop. What is
    broadcast is bounded: a bit per slot, 32 MB if all are taken. A missing key matches a missing
    one here, so it depends on the join whether it does in the end.
    """
    slot = F.pmod(_key_hash(on), F.lit(SLOTS))
    return in_bitmaps(df, slot, bitmaps(listed.select(slot.alias("slot"))))


def join_dimension(facts: DataFrame, dimension: Sized, on: list[str], how: str = "left",
                   limit: int | None = None, salts: int = SALTS,
                   hot: list[int] | None = None) -> DataFrame:
    """Joins facts to a dimension without moving the facts where the dimension is small.

    At most ``limit`` bytes (by default the limit of the dimension): broadcast hash join, no
    shuffle of the facts. Beyond that: shuffled join on (key, salt). The facts of hot keys, which
    ``heavy_keys`` finds unless they are given, are spread over ``salts`` salts, and only the rows
    of the dimension with these keys are repeated; all others have one salt. Adaptive skew
    handling splits what is still too large. ``salts=1`` is for facts in which no key can be hot.
    """
    if how not in ("left", "inner"):
        raise ValueError("facts are the left side: how must be 'left' or 'inner'")
    if dimension.fits(limit):
        return facts.join(F.broadcast(dimension.df), on, how)
    others = [c for c in facts.columns if c not in on] or facts.columns
    hot = hot if hot is not None or salts == 1 else heavy_keys(facts, on)
    if not hot or salts == 1:
        return facts.join(dimension.df, on, how)
    is_hot = _key_hash(on).isin(hot)
    salt = F.when(is_hot, F.pmod(F.xxhash64(*others), F.lit(salts))).otherwise(0).cast("int")
    salted = facts.withColumn("_salt", salt)
    last = F.when(is_hot, F.lit(salts - 1)).otherwise(F.lit(0))
    copies = dimension.df.withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
