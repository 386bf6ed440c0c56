"""Joins against unique keys that stay balanced when one key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.session import BROADCAST_ROWS

HOT_ROWS = 100_000


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join (inner or left) with a table that has one row per ``key``.

    A proven-small table is broadcast. Otherwise only the keys that are hot on
    the left (at most ``max_rows`` of them by choice of the threshold) are
    broadcast and the rest is shuffled, so no task receives a hot key whole; rows
    without a key take part in no shuffle.
    ``right`` is read more than once: hand in a stored one.
    """
    if right.limit(max_rows + 1).count() <= max_rows:
        return left.join(F.broadcast(right), key, how)
    counts = left.groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    threshold = max(hot_rows, total // max_rows)
    hot = F.broadcast(counts.filter(F.col("_n") > threshold).select(key))
    hot_right = F.broadcast(right.join(hot, key, "left_semi"))
    hot_part = left.join(hot, key, "left_semi").join(hot_right, key, how)
    # Null keys match nothing and would all be shuffled to one task.
    named = left.filter(F.col(key).isNotNull())
    cold_part = named.join(hot, key, "left_anti").join(right, key, how)
    both = hot_part.unionByName(cold_part)
    if how == "inner":
        return both
    unnamed = left.filter(F.col(key).isNull()).join(F.broadcast(right.limit(0)), key, how)
    return both.unionByName(unnamed)


def unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of either side without a partner: key, side."""
    only_left = left.join(right, key, "left_anti").select(key, F.lit("left").alias("side"))
    only_right = right.join(left, key, "left_anti").select(key, F.lit("right").alias("side"))
    return only_left.unionByName(only_right)
