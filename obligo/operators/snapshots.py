"""Comparing, extracting and appending dated snapshots of a transaction table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obligo.functions.keys import fingerprint
from obligo.operators.joins import BROADCAST_BYTES, Sized, maybe_listed, measured_bytes
from obligo.sinks.tables import stored

KEY = "txn_id"
AMOUNT = "amount"


def _side(side: str, column: Column) -> Column:
    return F.when(F.col("_side") == side, column)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str = KEY,
                  amount: str = AMOUNT) -> DataFrame:
    """Keys that are new, missing, or whose amount changed, with both amounts.

    Both snapshots are added up per key in one aggregation instead of being joined. Where the
    key is unique the sums are the amounts themselves. Where a key has many rows they meet as
    partial sums, never as pairs, and a key counts as unchanged only if both snapshots hold the
    same bag of amounts: the hashes of the one side then cancel those of the other.
    """
    tagged = old.select(key, amount, F.lit("old").alias("_side")).unionByName(
        new.select(key, amount, F.lit("new").alias("_side"))
    )
    h = F.xxhash64(amount).cast("decimal(20,0)")
    per_key = tagged.groupBy(key).agg(
        F.sum(_side("old", F.col(amount))).alias("old_amount"),
        F.sum(_side("new", F.col(amount))).alias("new_amount"),
        F.count(_side("old", F.lit(1))).alias("_old_rows"),
        F.count(_side("new", F.lit(1))).alias("_new_rows"),
        F.sum(_side("old", h).otherwise(-h)).alias("_bag"),
    )
    same = (
        (F.col("_bag") == 0)
        & (F.col("_old_rows") == F.col("_new_rows"))
        & F.col("old_amount").eqNullSafe(F.col("new_amount"))
    )
    status = (
        F.when(F.col("_old_rows") == 0, F.lit("new"))
        .when(F.col("_new_rows") == 0, F.lit("missing"))
        .when(~same, F.lit("changed"))
    )
    return (
        per_key.withColumn("status", status)
        .filter(F.col("status").isNotNull())
        .select(key, "old_amount", "new_amount", "status")
    )


def distinct_keys(df: DataFrame, key: str = KEY) -> DataFrame:
    """The distinct keys of a snapshot, stored.

    Repeated keys are combined on the map side before they are shuffled, so a hot key is one row.
    Stored, they reach a join by a plain exchange, and adaptive execution can split the rows that
    are filtered wherever one key holds too many of them.
    """
    return stored(df.sparkSession, df.select(key).distinct(), "keys")


def new_rows(old: DataFrame | None, new: DataFrame, key: str = KEY,
             known: DataFrame | None = None) -> DataFrame:
    """Rows of the new snapshot whose key the old one does not have.

    ``known`` are the distinct keys of the old snapshot where they are kept, for instance bucketed
    by the key. A row without a key is never known.
    """
    return new.join(distinct_keys(old, key) if known is None else known, key, "left_anti")


def unknown_keys(new: DataFrame, known: list[DataFrame], key: str = KEY) -> DataFrame:
    """The distinct keys of the new snapshot that none of the key tables has.

    The keys are combined on the map side and shuffled once. Tables that are stored in buckets of
    the key, of one number, are joined where they lie: their side of the plan has no exchange.
    """
    keys = new.select(key).distinct()
    for table in known:
        keys = keys.join(table.select(key), key, "left_anti")
    return keys


def rows_of_keys(df: DataFrame, keys: DataFrame, key: str = KEY,
                 limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rows whose key is listed, by stored distinct keys.

    The list is measured. Up to ``limit`` bytes it is broadcast and no row is moved; beyond that
    bitmaps of the keys' hashes are, and the rows they leave are shuffled with the keys. Adaptive
    execution splits a key that is hot.
    """
    if Sized(keys, measured_bytes(keys)).fits(limit):
        return df.join(F.broadcast(keys), key, "left_semi")
    return maybe_listed(df, keys, [key]).join(keys, key, "left_semi")


def carry_over(old: DataFrame | None, new: DataFrame, key: str = KEY,
               known: DataFrame | None = None) -> DataFrame:
    """Rows of the new snapshot whose key the old one has."""
    return new.join(distinct_keys(old, key) if known is None else known, key, "left_semi")


def append_new(old: DataFrame, new: DataFrame, key: str = KEY) -> DataFrame:
    """The old snapshot plus what is new in the new one; carried-over rows stay as they were."""
    return old.unionByName(new_rows(old, new, key))


def snapshot_fingerprint(df: DataFrame, by: list[str] | None = None, algo: str = "xxhash64",
                         key: str = KEY, amount: str = AMOUNT) -> DataFrame:
    """Fingerprint of the amounts of a snapshot, as a whole or per group."""
    return df.groupBy(*(by or [])).agg(*fingerprint(F.col(key), F.col(amount), algo))


def _sides(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.withColumn("_side", F.lit("old")).unionByName(new.withColumn("_side", F.lit("new")))


def compare_fingerprints(old: DataFrame, new: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Puts two fingerprints of the same grain side by side: 'same' or 'changed'."""
    values = ["n_rows", "hash_sum", "hash_xor"]
    picks = [
        F.max(_side(side, F.col(v))).alias(f"{side}_{v}") for side in ("old", "new") for v in values
    ]
    same = reduce(
        lambda a, b: a & b, [F.col(f"old_{v}").eqNullSafe(F.col(f"new_{v}")) for v in values]
    )
    return (
        _sides(old, new)
        .groupBy(*(by or []))
        .agg(*picks)
        .withColumn("status", F.when(same, F.lit("same")).otherwise(F.lit("changed")))
    )


def fingerprint_together(parts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Fingerprint of several sets of rows from the fingerprints of each."""
    return parts.groupBy(*(by or [])).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("hash_sum"), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"),
        F.coalesce(F.bit_xor("hash_xor"), F.lit(0)).alias("hash_xor"),
    )


def fingerprint_without(whole: DataFrame, part: DataFrame,
                        by: list[str] | None = None) -> DataFrame:
    """Fingerprint of a snapshot without some of its rows, from the two fingerprints.

    Counts and hash sums subtract, and XOR undoes itself, so the rows need not be read again.
    """
    signed = whole.withColumn("_sign", F.lit(1)).unionByName(part.withColumn("_sign", F.lit(-1)))
    rest = signed.groupBy(*(by or [])).agg(
        F.sum(F.col("n_rows") * F.col("_sign")).alias("n_rows"),
        F.sum(F.when(F.col("_sign") > 0, F.col("hash_sum")).otherwise(-F.col("hash_sum")))
        .cast("decimal(38,0)")
        .alias("hash_sum"),
        F.bit_xor("hash_xor").alias("hash_xor"),
    )
    return rest.filter(F.col("n_rows") > 0) if by else rest


def compare_snapshots(old: DataFrame, new: DataFrame, by: list[str] | None = None,
                      algo: str = "xxhash64", key: str = KEY, amount: str = AMOUNT) -> DataFrame:
    """Whether the carried-over part of the new snapshot is what the old one holds.

    Rows whose key is new are not compared; rows that went missing show as a change.
    """
    kept = carry_over(old, new, key)
    return compare_fingerprints(
        snapshot_fingerprint(old, by, algo, key, amount),
        snapshot_fingerprint(kept, by, algo, key, amount),
        by,
    )


def localized_diff(old: DataFrame, new: DataFrame, by: list[str], algo: str = "xxhash64",
                   key: str = KEY, amount: str = AMOUNT, limit: int = BROADCAST_BYTES,
                   old_prints: DataFrame | None = None) -> DataFrame:
    """The same rows as ``snapshot_diff``, comparing row by row only where groups differ.

    A fingerprint per group is one map-side aggregate, so unchanged groups are never shuffled.
    Choose groups that are few against the rows (a year, a state). ``old_prints`` are the
    fingerprints of the old snapshot where they were kept with it; then only the new one is read
    for them. The keys found in groups that differ are then compared with all their rows, also
    those in other groups, so an id that spans groups is compared as a whole. The lists of groups
    and of keys are measured: up to ``limit`` bytes they are broadcast to filter the scans, beyond
    that bitmaps of their hashes are, and only the rows these leave are shuffled.
    """
    if old_prints is None:
        old_prints = snapshot_fingerprint(old, by, algo, key, amount)
    compared = compare_fingerprints(
        old_prints, snapshot_fingerprint(new, by, algo, key, amount), by)
    groups = _listed(compared.filter(F.col("status") == "changed").select(*by), "groups")
    keys = _listed(
        _matching(old, groups, by, limit).select(key)
        .unionByName(_matching(new, groups, by, limit).select(key)).distinct(),
        "keys",
    )
    return snapshot_diff(_matching(old, keys, [key], limit), _matching(new, keys, [key], limit),
                         key, amount)


def _listed(rows: DataFrame, name: str) -> Sized:
    """Stored and measured, so that a join can be chosen by its size."""
    kept = stored(rows.sparkSession, rows, name)
    return Sized(kept, measured_bytes(kept))


def _matching(df: DataFrame, listed: Sized, by: list[str], limit: int) -> DataFrame:
    """Rows whose values are listed; a missing value matches a missing one."""
    fits = listed.fits(limit)
    if not fits:
        df = maybe_listed(df, listed.df, by)
    renamed = listed.df.toDF(*[f"_listed_{c}" for c in by])
    matches = reduce(lambda a, b: a & b, [df[c].eqNullSafe(renamed[f"_listed_{c}"]) for c in by])
    return df.join(F.broadcast(renamed) if fits else renamed, matches, "left_semi")
