"""Writes that update stored documents, as transformations from old to new."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def merge_fields(parts: Iterable[DataFrame], keys: Iterable[str]) -> DataFrame:
    """One document per key from partial documents with different fields.

    Each field has one writer, so the maximum is its only value. Parts that are
    already aggregated by the keys share their partitioning with the result.
    """
    keys = list(keys)
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    fields = [c for c in union.columns if c not in keys]
    return union.groupBy(*keys).agg(*[F.max(f).alias(f) for f in fields])


def merge_into(stored: DataFrame, changes: DataFrame, keys: Iterable[str], within: Iterable[str] = ()) -> DataFrame:
    """Stored documents with the changed fields replaced; new keys are added.

    A null in ``changes`` leaves the stored field alone. Both tables meet in one
    aggregation by the keys, where null keys are equal, and not in a join. ``within``
    names some of the keys whose groups are to lie in one task each, for writing.
    """
    newest = lambda f: F.max_by(f, F.when(F.col(f).isNotNull(), F.col("_order")))
    return _together(stored, changes, list(keys), lambda f, both: newest(f) if both else F.max(f), list(within))


def apply_increment(stored: DataFrame, increment: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Stored counts plus an increment; a missing field or key starts from zero.

    Fields only in ``stored`` are kept. A field neither side has for a key stays null.
    """
    return _together(stored, increment, list(keys), lambda f, both: F.sum(f) if both else F.max(f))


def _together(
    stored: DataFrame, changes: DataFrame, keys: list[str], combine: Callable[[str, bool], Column], within: list[str] = [],
) -> DataFrame:
    """One row per key; each side has at most one. ``combine`` is told whether both sides have the field."""
    rows = stored.withColumn("_order", F.lit(0)).unionByName(changes.withColumn("_order", F.lit(1)), allowMissingColumns=True)
    if within:
        rows = rows.repartition(*within)
    fields = [c for c in dict.fromkeys(stored.columns + changes.columns) if c not in keys]
    return rows.groupBy(*keys).agg(*[combine(f, f in stored.columns and f in changes.columns).alias(f) for f in fields])
