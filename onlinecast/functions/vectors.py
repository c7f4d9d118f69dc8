"""Vector functions on ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def dot(a: str | Column, b: str | Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def squared_distance(a: str | Column, b: str | Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def cosine_to_ones(x: str | Column) -> Column:
    """Cosine similarity of ``x`` to the all-ones vector; 0 for a zero vector."""
    x = F.col(x) if isinstance(x, str) else x
    total = _sum(F.transform(x, lambda v: v.cast("double")))
    norm = F.sqrt(_sum(F.transform(x, lambda v: v.cast("double") * v)))
    return F.when(norm == 0, F.lit(0.0)).otherwise(total / (norm * F.sqrt(F.size(x))))


def linear_output(x: str | Column, params: str | Column, inputs: int, output: int) -> Column:
    """Output ``output`` of a linear model; each output stores its weights, then its bias."""
    start = output * (inputs + 1)
    weights = F.slice(params, start + 1, inputs)
    return dot(x, weights) + F.element_at(params, start + inputs + 1)
