"""Joining points to intervals without a row per point of each interval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_join(points: DataFrame, intervals: DataFrame, on: list[str], point: str,
                  start: str, end: str, width: int, how: str = "inner") -> DataFrame:
    """Points with every interval of the same key that holds them, both ends included.

    Intervals are repeated once per stretch of ``width`` they touch, points fall into one; the
    join is by equality on (key, stretch) and the ends are compared in it, so there is no nested
    loop, and a key with many intervals is split along the line. Choose a width near the usual
    length of an interval: each then touches about two. Intervals without a start or end, or that
    end before they start, hold no point; a point without a value is in none.

    ``point``, ``start`` and ``end`` are whole numbers, like days or years. With ``how="left"``
    points in no interval are kept.
    """
    if how not in ("left", "inner"):
        raise ValueError("points are the left side: how must be 'left' or 'inner'")
    if width < 1:
        raise ValueError("width must be positive")
    first, last = (F.floor(F.col(c) / width).cast("bigint") for c in (start, end))
    touched = intervals.filter(F.col(start) <= F.col(end)).withColumn(
        "_stretch", F.explode(F.sequence(first, last)))
    for name in on:
        touched = touched.withColumnRenamed(name, f"_of_{name}")
    placed = points.withColumn("_place", F.floor(F.col(point) / width).cast("bigint"))
    matches = (F.col("_place") == F.col("_stretch")) & F.col(point).between(
        F.col(start), F.col(end))
    for name in on:
        matches = matches & (F.col(name) == F.col(f"_of_{name}"))
    return placed.join(touched, matches, how).drop(
        "_place", "_stretch", *[f"_of_{name}" for name in on])
