"""Scores over arrays, row by row inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax(scores: Column) -> Column:
    """Index from 0 of the first maximum."""
    return F.array_position(scores, F.array_max(scores)) - 1


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def unit(a: Column) -> Column:
    """The vector scaled to length 1."""
    norm = F.sqrt(dot(a, a))
    return F.transform(a, lambda x: x.cast("double") / norm)


def token_vectors(flat: Column, dim: int) -> Column:
    """A flat array as consecutive vectors of ``dim`` values."""
    starts = F.sequence(F.lit(0), (F.size(flat) / dim).cast("int") - 1)
    return F.transform(starts, lambda i: F.slice(flat, i * dim + 1, dim))


def mean_best_cosine(a: Column, b: Column) -> Column:
    """Mean over the unit vectors of ``a`` of their best cosine with one of ``b``."""
    best = F.transform(a, lambda x: F.array_max(F.transform(b, lambda y: dot(x, y))))
    return F.aggregate(best, F.lit(0.0), lambda acc, v: acc + v) / F.size(a)


def f_measure(precision: Column, recall: Column) -> Column:
    return F.when(precision + recall != 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))
