"""Vectors as whole numbers: which rows take part, and their scaled components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def scaled(vector: Column, factor: int, limit: float) -> Column:
    """floor(factor * x) of each component; null for a null or empty vector, or one with a component that is null, not finite or over the limit."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * factor > limit))
    return F.when((F.size(x) > 0) & ~F.coalesce(bad, F.lit(True)), F.transform(x, lambda c: F.floor(c * factor)))


def common_length(rows: DataFrame, column: str) -> int:
    """The length that most vectors have, of several the least; 0 for no rows."""
    counts = rows.groupBy(F.size(column).alias("length")).count()
    first = counts.orderBy(F.desc("count"), "length").first()
    return first["length"] if first else 0


def whole_vectors(rows: DataFrame, vector: str, factor: int, limit: float, *kept: Column, name: str = "x") -> tuple[DataFrame, int]:
    """`kept` columns and floor(factor * component) as an array of longs, of rows that take part; and the vectors' length.

    Left out are null and empty vectors, those with a null or non-finite component or one that is over `limit` when scaled, and
    those of another length than most.
    """
    found = rows.select(*kept, scaled(F.col(vector), factor, limit).alias(name)).filter(F.col(name).isNotNull())
    length = common_length(found, name)
    return found.filter(F.size(name) == length), length
