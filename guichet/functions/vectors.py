"""Similarity expressions on array columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import as_col

RANK_DIGITS = 9  # similarities are compared at this precision, so float noise never reorders ties


def _doubles(c: Column | str) -> Column:
    return as_col(c).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def l2_norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(_doubles(a), F.lit(0.0), lambda s, x: s + x * x))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 when either vector is all zeros."""
    norms = l2_norm(a) * l2_norm(b)
    return F.when(norms > 0, dot(a, b) / norms).otherwise(F.lit(0.0))


def squared_l2(a: Column | str, b: Column | str) -> Column:
    diff = F.zip_with(_doubles(a), _doubles(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(diff, F.lit(0.0), lambda s, x: s + x)


def to_distance(similarity: Column | str) -> Column:
    return F.lit(1.0) - as_col(similarity)


def to_percent(similarity: Column | str) -> Column:
    return as_col(similarity) * 100
