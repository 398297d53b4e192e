"""Vectors as array columns; double arithmetic in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where a vector has no length, null where one is null."""
    size = norm(a) * norm(b)
    return F.when(size == 0, 0.0).otherwise(dot(a, b) / F.nullif(size, F.lit(0.0)))


def l1(a: Column, b: Column) -> Column:
    """Mean absolute difference."""
    return _sum(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))) / F.nullif(F.size(a), F.lit(0))


def to_unit_range(a: Column) -> Column:
    """Values from 0..1 to -1..1."""
    return F.transform(a, lambda x: x.cast("double") * 2 - 1)


def template_score(before: Column, after: Column, before_template: Column, after_template: Column) -> Column:
    """Mean similarity of both sides to their own template, 0.2 less for each side nearer to the other, at least 0."""
    bb, aa, ba, ab = cosine(before, before_template), cosine(after, after_template), cosine(before, after_template), cosine(after, before_template)
    crossed = (ba > bb).cast("int") + (ab > aa).cast("int")
    return F.round(F.greatest(F.lit(0.0), (bb + aa) / 2 - 0.2 * crossed), 4)
