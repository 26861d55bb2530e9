"""Row filters as column expressions, in forms that reach the parquet scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wayprint.constants import DAY_ZONE


def in_values(col: str | Column, values: Iterable[str]) -> Column:
    """Membership in a value list; repeated values have no effect."""
    return _col(col).isin(list(dict.fromkeys(values)))


def present(*cols: str) -> Column:
    """Every listed column is non-null."""
    return F.expr(" and ".join(f"`{c}` is not null" for c in cols))


def any_present(*cols: str) -> Column:
    """At least one listed column is non-null."""
    return F.expr(" or ".join(f"`{c}` is not null" for c in cols))


def has_prefix(col: str | Column, prefix: str) -> Column:
    return _col(col).startswith(prefix)


def any_prefix(col: str | Column, prefixes: Iterable[str]) -> Column:
    return reduce(or_, (_col(col).startswith(p) for p in prefixes))


def not_blank(col: str | Column) -> Column:
    """Neither null nor the empty string."""
    return _col(col).isNotNull() & (_col(col) != "")


def in_window(
    df: DataFrame,
    column: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    zone: str = DAY_ZONE,
) -> Column:
    """``start <= column < end`` in whole days of ``zone``; a missing bound is open.

    Rows without a time belong to every span with an open start and to no other,
    so a base of "everything before" and the days after it cover each row once.

    An instant column is compared with the instants of local midnight, a
    zone-less timestamp with local midnight itself, and a date with the date.
    Bounds fold to literals, so the filter can be pushed to the scan.
    """
    kind = df.schema[column].dataType
    conditions = []
    if start is not None:
        conditions.append(F.col(column) >= _midnight(start, kind, zone))
    if end is not None:
        before = F.col(column) < _midnight(end, kind, zone)
        conditions.append(before if start is not None else before | F.col(column).isNull())
    return reduce(and_, conditions, F.lit(True))


def day_window(df: DataFrame, column: str, as_of: dt.date, zone: str = DAY_ZONE) -> Column:
    """The day before ``as_of``: ``[as_of - 1 day, as_of)``."""
    return in_window(df, column, as_of - dt.timedelta(days=1), as_of, zone)


def _midnight(day: dt.date, kind: T.DataType, zone: str) -> Column:
    if isinstance(kind, T.DateType):
        return F.lit(day)
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
    if isinstance(kind, T.TimestampType):
        return F.lit(f"{day} 00:00:00 {zone}").cast("timestamp")
    raise TypeError(f"no day window over {kind.simpleString()}")


def _col(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col
