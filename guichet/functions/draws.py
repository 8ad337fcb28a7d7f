"""Reproducible random draws: a function of the seed and the row's key alone.

The draw does not depend on partitioning, so a recomputed task repeats it, and any
engine with md5 can repeat it too.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def draw_key(seed: int | str, *parts: Column) -> Column:
    """32 hex digits, uniform over keys."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def draw_long(key: Column) -> Column:
    """The first 60 bits of a draw as a non-negative long."""
    return F.conv(F.substring(key, 1, 15), 16, 10).cast("long")


def draw_bucket(key: Column) -> Column:
    """The first 16 bits: 65,536 equal buckets that keep the order of the draws."""
    return F.substring(key, 1, 4)
