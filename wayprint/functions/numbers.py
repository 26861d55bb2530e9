"""Numbers: amounts that add exactly, means from (sum, count), the priority case.

An amount is held in three whole numbers, its *limbs*: the part before the point, eight
places after it and eight more. Each is a BIGINT, so sums run at the speed of counts,
do not depend on the order of rows, and carry over only once, when a mean is taken.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

LIMBS = ("whole", "high", "low")
LIMB = 10**8
# Digits that a double keeps of any decimal number, and the places that the limbs have.
DIGITS, PLACES = 15, 16
MOST = 9.0e18
# Below this a double has eight places beside its other digits; its error is this share of it.
EIGHT_PLACES_BELOW, ERROR = 4.0e6, 2.0**-50


def limbs_of(name: str) -> list[str]:
    """Columns of the amount ``name``."""
    return [f"{name}_{limb}" for limb in LIMBS]


def number_of(df: DataFrame, column: str) -> Column:
    """The column as a number: text that is no number becomes null, the rest keeps its type."""
    if isinstance(df.schema[column].dataType, T.NumericType):
        return F.col(column)
    return F.col(column).try_cast("double")


def with_amount(df: DataFrame, column: str | Column, name: str) -> DataFrame:
    """``df`` with the limbs of an amount, all null where there is none.

    A double is taken as the decimal number of fifteen digits nearest to it, which is the
    number that was written, with sixteen places at most. What cannot be held is an
    error and never dropped: a number that is too large, not finite, or so small that
    nothing of it would remain.
    """
    if isinstance(column, str):
        column = number_of(df, column)
    df = df.withColumn("_amount", column)
    kind, v = df.schema["_amount"].dataType, F.col("_amount")
    if isinstance(kind, T.IntegralType):
        whole, rest = v.cast("bigint"), F.when(v.isNotNull(), F.lit(0).cast("bigint"))
    elif isinstance(kind, T.DecimalType):
        whole = v.cast("bigint")
        rest = F.round((v - whole.cast("decimal(19,0)")).cast("decimal(38,18)"), PLACES) * F.lit(Decimal(10**PLACES))
        rest = _held(v, rest.cast("bigint"), whole)
    else:
        v = v.cast("double")
        df = df.withColumn("_whole", F.when(F.abs(v) < MOST, v).when(v.isNotNull(), _refused(v)).cast("bigint"))
        df = df.withColumn("_part", v - F.col("_whole").cast("double"))
        whole, rest = F.col("_whole"), _scaled(F.col("_part"), v)
    names = limbs_of(name)
    df = df.withColumns({names[0]: whole, "_rest": rest})
    high, low = F.expr(f"_rest div {LIMB}L"), F.expr(f"_rest % {LIMB}L")
    if "_part" in df.columns:
        high = F.coalesce(high, F.rint(F.col("_part") * F.lit(float(LIMB))).cast("bigint"))
        low = F.coalesce(low, F.when(F.col("_part").isNotNull(), F.lit(0).cast("bigint")))
    return df.withColumns({names[1]: high, names[2]: low}).drop("_amount", "_rest", "_whole", "_part")


def _scaled(part: Column, v: Column) -> Column:
    """What lies behind the point of a double in units of the last place, rounded to the digits that it has.

    Null for a number of up to eight places, which is nearly every amount: it differs from
    a whole number of units of the eighth place by no more than a double's error.
    """
    size, units = F.abs(v), part * F.lit(float(LIMB))
    plain = (size < EIGHT_PLACES_BELOW) & (F.abs(units - F.rint(units)) <= size * F.lit(LIMB * ERROR))
    places = F.greatest(F.least(F.lit(DIGITS - 1) - F.floor(F.log10(size)), F.lit(PLACES)), F.lit(0)).cast("int")
    up = F.get(F.array(*[F.lit(float(10**p)) for p in range(PLACES + 1)]), places)
    down = F.get(F.array(*[F.lit(10 ** (PLACES - p)).cast("bigint") for p in range(PLACES + 1)]), places)
    found = F.rint(part * up).cast("bigint") * down
    return F.when(part.isNull() | plain, F.lit(None).cast("bigint")).otherwise(_held(v, found, v.cast("bigint")))


def _held(v: Column, rest: Column, whole: Column) -> Column:
    return F.when((v == 0) | (whole != 0) | (rest != 0), rest).when(v.isNotNull(), _refused(v))


def _refused(v: Column) -> Column:
    return F.raise_error(F.concat(F.lit("an amount that cannot be added exactly: "), v.cast("string"))).cast("bigint")


def carried(whole: Column, high: Column, low: Column) -> tuple[Column, Column, Column]:
    """Limbs of the same number with high and low from 0 up to, not including, ``LIMB``."""
    zero = F.lit(0).cast("bigint")
    high, low = F.coalesce(high, zero), F.coalesce(low, zero)
    rest = F.pmod(low, F.lit(LIMB))
    high = high + _times(low - rest)
    return whole + _times(high - F.pmod(high, F.lit(LIMB))), F.pmod(high, F.lit(LIMB)), rest


def _times(multiple: Column) -> Column:
    return F.call_function("div", multiple, F.lit(LIMB).cast("bigint"))


def decimal_of(whole: Column, high: Column, low: Column) -> Column:
    """The amount as a decimal number, exactly."""
    def part(limb: Column, unit: str) -> Column:
        return F.coalesce(limb, F.lit(0).cast("bigint")).cast("decimal(19,0)") * F.lit(Decimal(unit))

    return whole.cast("decimal(36,16)") + part(high, "0.00000001") + part(low, "0.0000000000000001")


def mean_of(whole: str | Column, high: str | Column, low: str | Column, n: str | Column) -> Column:
    """Mean of amounts from the sums of their limbs; null when there are none.

    The sum is rounded to a double once. Mostly it has eight places and fits a double
    in units of the last; the quotient by their power of ten is then the same number.
    """
    whole, high, low, n = map(_col, (whole, high, low, n))
    zero = F.lit(0).cast("bigint")
    short = (F.coalesce(low, zero) == 0) & (F.abs(whole) < 80_000_000) & (F.abs(F.coalesce(high, zero)) < 10**15)
    units = whole * F.lit(LIMB).cast("bigint") + F.coalesce(high, zero)
    total = F.when(short, units.cast("double") / F.lit(float(LIMB))).otherwise(decimal_of(whole, high, low).cast("double"))
    return F.try_divide(total, n.cast("double"))


def integer_mean_of(whole: str | Column, high: str | Column, low: str | Column, n: str | Column) -> Column:
    """Truncated sum divided by the count, without a fraction."""
    whole, high, low = carried(*map(_col, (whole, high, low)))
    truncated = whole + F.when((whole < 0) & ((high > 0) | (low > 0)), 1).otherwise(0)
    return F.call_function("div", truncated.cast("bigint"), F.nullif(_col(n).cast("bigint"), F.lit(0).cast("bigint")))


def reaches(whole: str | Column, high: str | Column, low: str | Column, n: str | Column, threshold: float) -> Column:
    """Whether the mean is at least the threshold, decided on exact numbers."""
    return decimal_of(*map(_col, (whole, high, low))) >= F.lit(Decimal(str(threshold))) * _col(n).cast("decimal(20,0)")


def priority_of(flags: Iterable[tuple[str, int]]) -> Column:
    """Value of the first flag that equals 1, else 0."""
    case = F.lit(0)
    for name, value in reversed(list(flags)):
        case = F.when(F.col(name) == 1, F.lit(value)).otherwise(case)
    return case


def _col(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col
