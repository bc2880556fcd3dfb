"""Reading remote relations over JDBC."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Hex digits of the MD5 text that ranges are cut on: up to 65,536 ranges.
_HEX_DIGITS = 4
# Rows per round trip. Some drivers otherwise hold the whole result of a partition in memory.
FETCH_ROWS = 10_000
# Decimal digits that always fit 64 bits.
LONG_DIGITS = 18
# Relative error of a cut: a piece over this.
DEPTH_ACCURACY = 50


@dataclass(frozen=True)
class Connection:
    """Address and driver options of a remote database. Credentials never live in code."""

    url: str
    options: dict[str, str] = field(default_factory=dict, repr=False)

    @classmethod
    def from_environment(cls, prefix: str) -> Connection:
        """Takes <prefix>_URL and, where set, <prefix>_DRIVER, _USER and _PASSWORD."""
        names = {"driver": "DRIVER", "user": "USER", "password": "PASSWORD"}
        found = {k: os.environ.get(f"{prefix}_{v}") for k, v in names.items()}
        return cls(os.environ[f"{prefix}_URL"], {k: v for k, v in found.items() if v})

    def reading(self) -> dict[str, str]:
        return {"fetchsize": str(FETCH_ROWS), **self.options}


def read_relation(spark: SparkSession, source: Connection, relation: str) -> DataFrame:
    """A table, or a sub-query written as ``(SELECT ...) alias``, through one connection."""
    return spark.read.jdbc(source.url, relation, properties=source.reading())


def read_by_range(spark: SparkSession, source: Connection, relation: str, column: str,
                  lower: int, upper: int, partitions: int) -> DataFrame:
    """Partitioned by a numeric column. The bounds set the stride; they filter nothing.

    With an index on the column each partition reads only its range, so this is the form for
    large tables that have a numeric key.
    """
    return spark.read.jdbc(source.url, relation, column=column, lowerBound=lower,
                           upperBound=upper, numPartitions=partitions,
                           properties=source.reading())


def read_split(spark: SparkSession, source: Connection, relation: str, key: list[str],
               partitions: int, equal_depth: bool = False) -> DataFrame:
    """A table in so many pieces: by ranges of its key where that is one whole number.

    The ranges are strides between the smallest and the largest key or, with ``equal_depth``, hold
    about equally many rows whatever gaps the numbers have: the key column alone is then read
    first, by strides, and cut at its quantiles. Other keys, and numbers beyond 64 bits, are split
    by hash ranges. A table of one piece is read through one connection.
    """
    whole = read_relation(spark, source, relation)
    if partitions <= 1:
        return whole
    kind = whole.schema[key[0]].dataType if len(key) == 1 else None
    numeric = isinstance(kind, T.IntegralType) or (
        isinstance(kind, T.DecimalType) and kind.scale == 0 and kind.precision <= LONG_DIGITS)
    if not numeric:
        return read_by_key(spark, source, relation, key, partitions)
    column = key[0]
    lower, upper = read_relation(
        spark, source, f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {relation}) bounds"
    ).first()
    if lower is None:
        return whole
    if not equal_depth:
        return read_by_range(
            spark, source, relation, column, int(lower), int(upper) + 1, partitions)
    keys = read_by_range(spark, source, f"(SELECT {column} FROM {relation}) keys", column,
                         int(lower), int(upper) + 1, partitions)
    bounds = equal_depth_bounds(keys, column, partitions)
    return spark.read.jdbc(source.url, relation, predicates=range_predicates(column, bounds),
                           properties=source.reading())


def equal_depth_bounds(keys: DataFrame, column: str, pieces: int) -> list[int]:
    """Values that cut a whole-number column into pieces of about equally many rows.

    They are taken from a quantile summary, which tasks fill on their own rows and which add up,
    so nothing is sorted or moved. Where one value fills several pieces it is one bound.
    """
    shares = [i / pieces for i in range(1, pieces)]
    if not shares:
        return []
    cuts = keys.agg(F.percentile_approx(
        F.col(column).cast("bigint"), shares, DEPTH_ACCURACY * pieces)).first()[0]
    return sorted(set(cuts or []))


def range_predicates(column: str, bounds: list[int]) -> list[str]:
    """WHERE clauses for the ranges between bounds, without overlap or gap, nulls in the first."""
    if not bounds:
        return [f"{column} IS NULL OR {column} IS NOT NULL"]
    inner = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{column} IS NULL OR {column} <= {bounds[0]}", *inner, f"{column} > {bounds[-1]}"]


def read_by_key(spark: SparkSession, source: Connection, relation: str, key: str | list[str],
                partitions: int, key_text: Callable[[str], str] | None = None) -> DataFrame:
    """Partitioned by a hash range of a stable key, so every row is read exactly once.

    Unlike an unordered row number, the key gives each row the same partition in every one of
    the partition queries, also when an executor is lost and a partition is read again. The
    database scans the table for each partition unless it has an index on the MD5 expression.
    """
    return spark.read.jdbc(source.url, relation,
                           predicates=key_predicates(key, partitions, key_text),
                           properties=source.reading())


def key_predicates(key: str | list[str], partitions: int,
                   key_text: Callable[[str], str] | None = None) -> list[str]:
    """WHERE clauses that split a relation evenly, without overlap or gap, by MD5 ranges.

    ``md5`` of a text has the same spelling in the common dialects. ``key_text`` renders one key
    column as text where plain CAST does not suit the remote dialect.
    """
    most = 16**_HEX_DIGITS
    if not 1 <= partitions <= most:
        raise ValueError(f"partitions must be between 1 and {most}")
    render = key_text or (lambda column: f"CAST({column} AS VARCHAR(4000))")
    columns = [key] if isinstance(key, str) else list(key)
    text = " || '|' || ".join(f"COALESCE({render(c)}, '')" for c in columns)
    prefix = f"substr(md5({text}), 1, {_HEX_DIGITS})"
    edges = [f"{i * most // partitions:0{_HEX_DIGITS}x}" for i in range(partitions)]
    clauses = []
    for i, edge in enumerate(edges):
        upper = f" AND {prefix} < '{edges[i + 1]}'" if i + 1 < partitions else ""
        clauses.append(f"{prefix} >= '{edge}'{upper}")
    return clauses
