"""Row identity, hash buckets and order-insensitive fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASHES = ("xxhash64", "murmur3", "md5")


def natural_key(*parts: Column | str) -> Column:
    """A stable row id from the columns that together identify a row.

    A backslash stands before every ``-`` and backslash of a part, and a missing part is ``\\N``,
    so different parts never give the same id. Plain parts read as they are, joined by ``-``.
    """
    def spelled(part: Column | str) -> Column:
        text = (F.col(part) if isinstance(part, str) else part).cast("string")
        escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("-"),
                            F.lit("\\-"))
        return F.coalesce(escaped, F.lit("\\N"))

    return F.concat_ws("-", *[spelled(p) for p in parts])


def hash_number(text: Column, algo: str = "xxhash64") -> Column:
    """A bigint hash of a text. ``md5`` keeps 60 bits and can be recomputed by other engines."""
    if algo == "xxhash64":
        return F.xxhash64(text)
    if algo == "murmur3":
        return F.hash(text).cast("bigint")
    if algo == "md5":
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    raise ValueError(f"algo must be one of {HASHES}, not {algo!r}")


def bucket(key: Column, buckets: int | Column, algo: str = "xxhash64") -> Column:
    """Deterministic bucket 0..buckets-1 of a row: the same row is always in the same bucket."""
    n = buckets if isinstance(buckets, Column) else F.lit(buckets)
    return F.pmod(hash_number(key, algo), n).cast("int")


def row_text(key: Column, amount: Column) -> Column:
    return F.concat_ws("|", F.coalesce(key, F.lit("null")),
                       F.coalesce(amount.cast("string"), F.lit("null")))


def fingerprint(key: Column, amount: Column, algo: str = "xxhash64") -> list[Column]:
    """Aggregates that depend on the bag of (key, amount) pairs, not on their order.

    Row count, exact sum of the row hashes and their XOR: all three combine on the map side,
    so a hot key or group costs nothing extra.
    """
    h = hash_number(row_text(key, amount), algo)
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"),
        F.coalesce(F.bit_xor(h), F.lit(0)).alias("hash_xor"),
    ]
