"""Putting results of several relations side by side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def align(keys: list[str], *parts: DataFrame) -> DataFrame:
    """Full outer merge of relations that are unique on ``keys`` and share no other column.

    One union and one small group-by take the place of a chain of joins. Groups a part does not
    have show NULL in its columns.
    """
    measures = [name for part in parts for name in part.columns if name not in keys]
    return union_all(parts).groupBy(*keys).agg(*[F.max(name).alias(name) for name in measures])


def fold(keys: list[str], *parts: tuple[DataFrame, list[Column]]) -> DataFrame:
    """Aggregates of several relations in one group-by on the shared ``keys``.

    Each part is a relation with its aggregates. They read columns only that part has, or guard
    shared ones by such a column, as the rows of the other parts show NULL there. All parts are
    combined on the map side and meet in a single shuffle.
    """
    aggregates = [column for _, columns in parts for column in columns]
    return union_all([rows for rows, _ in parts]).groupBy(*keys).agg(*aggregates)
