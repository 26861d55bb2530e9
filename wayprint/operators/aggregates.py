"""Grouped measures. Each is one aggregation with a map-side partial step."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from wayprint.constants import PREFERENCE_LABELS, PREFERENCE_THRESHOLD, REPEAT_ABOVE
from wayprint.functions import integer_mean_of, label_flag, limbs_of, mean_of, present, reaches, with_amount


def count_by(df: DataFrame, keys: Iterable[str], out: str, having: str | None = None) -> DataFrame:
    """Rows per key; ``having`` is a SQL condition on the result."""
    counted = df.groupBy(*keys).agg(_rows().alias(out))
    return counted.filter(having) if having else counted


def sum_by(df: DataFrame, keys: Iterable[str], value: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def mean_by(df: DataFrame, keys: Iterable[str], amount: str, out: str) -> DataFrame:
    """Mean of the non-null amounts per key."""
    return mean_and_count_by(df, keys, amount, out, "_n").drop("_n")


def mean_and_count_by(df: DataFrame, keys: Iterable[str], amount: str, mean: str, n: str) -> DataFrame:
    """Mean and number of the amounts, in one pass; text that is no number is no amount."""
    return _with_limbs(df, amount).groupBy(*keys).agg(mean_of(*_limb_sums(), _rows()).alias(mean), _rows().alias(n))


def integer_mean_by(df: DataFrame, keys: Iterable[str], amount: str, out: str) -> DataFrame:
    """Truncated sum divided by the count, as an integer."""
    return _with_limbs(df, amount).groupBy(*keys).agg(integer_mean_of(*_limb_sums(), _rows()).alias(out))


def repeat_flag_by(df: DataFrame, keys: Iterable[str], out: str, above: int = REPEAT_ABOVE) -> DataFrame:
    return df.groupBy(*keys).agg((_rows() > above).alias(out))


def label_sums_by(df: DataFrame, keys: Iterable[str], text: str, labels: Mapping[str, str]) -> DataFrame:
    """Per key, in how many rows the text contains each label."""
    return df.groupBy(*keys).agg(*[
        F.sum(label_flag(text, label)).alias(field) for field, label in labels.items()
    ])


def majority_label_by(
    df: DataFrame,
    keys: Iterable[str],
    score: str,
    out: str,
    labels: tuple[str, str] = PREFERENCE_LABELS,
    threshold: float = PREFERENCE_THRESHOLD,
    rows: str | None = None,
) -> DataFrame:
    """First label when the mean score reaches the threshold, else the second.

    Scores are numbers held as text; rows without a number do not count. ``rows`` names a
    count of equal rows that each row stands for, when they were counted before.
    """
    n = F.col(rows) if rows else F.lit(1).cast("bigint")
    scored = _with_limbs(df, score)
    sums = [F.sum(F.col(limb) * n) for limb in limbs_of("_of")]
    return scored.groupBy(*keys).agg(F.when(reaches(*sums, F.sum(n), threshold), labels[0]).otherwise(labels[1]).alias(out))


def total(df: DataFrame, out: str) -> DataFrame:
    """Number of rows of the table."""
    return df.agg(_rows().alias(out))


def distinct_total(df: DataFrame, column: str, out: str) -> DataFrame:
    """Number of distinct non-null values, exact, without one task holding them all."""
    return df.select(column).filter(present(column)).distinct().agg(_rows().alias(out))


def _with_limbs(df: DataFrame, amount: str) -> DataFrame:
    """Rows that have the amount, with its limbs."""
    return with_amount(df.filter(present(amount)), amount, "_of").filter(present("_of_whole"))


def _limb_sums() -> list[Column]:
    return [F.sum(limb) for limb in limbs_of("_of")]


def _rows() -> Column:
    return F.count(F.lit(1))
