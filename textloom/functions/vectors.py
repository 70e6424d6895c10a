"""Arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; null when either vector has length zero."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def sigmoid(x: Column | str) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def relu(x: Column | str) -> Column:
    return F.greatest(F.col(x) if isinstance(x, str) else x, F.lit(0.0))
