"""Similarity of vectors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The metrics an index can have; True where a higher score is nearer.
METRICS = {"cosine": True, "dotproduct": True, "euclidean": False}


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))


def similarity(a: Column, b: Column, metric: str) -> Column:
    """Score of two double arrays of one length; null for cosine of a zero vector."""
    if metric == "cosine":
        return F.try_divide(dot(a, b), norm(a) * norm(b))
    if metric == "dotproduct":
        return dot(a, b)
    if metric == "euclidean":
        return F.sqrt(
            F.aggregate(
                F.zip_with(a, b, lambda x, y: (x - y) * (x - y)),
                F.lit(0.0), lambda acc, x: acc + x,
            )
        )
    raise ValueError(f"unknown metric {metric!r}, expected one of {sorted(METRICS)}")
