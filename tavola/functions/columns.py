"""Column expressions used by more than one operator.

Money is summed exactly, as two integers: whole units and millionths. Integer
addition gives the same total whatever the partitioning, and stays in generated
code, where summing decimals is several times slower. Rounding comes once, after
the sum. Digits beyond the sixth of a single value are rounded off.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.functions.fixed import SEASON_MONTHS


def as_column(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cents(x: str | Column) -> Column:
    return F.rint(as_column(x) * 100).cast("bigint")


def exact_sum(x: str | Column) -> Column:
    """Sum as ``decimal(38,6)``; partial sums of it can be added up again."""
    value = as_column(x)
    millionths = F.rint((value - F.floor(value)) * 1e6).cast("bigint")
    whole = F.sum(F.floor(value)).cast("decimal(28,0)")
    rest = F.sum(millionths).cast("decimal(28,0)") * F.lit("0.000001").cast("decimal(6,6)")
    return (whole + rest).cast("decimal(38,6)")


def in_cents(total: Column) -> Column:
    """An exact total rounded half up to two digits, as a double."""
    return F.round(total, 2).cast("double")


def money_sum(x: str | Column) -> Column:
    return in_cents(exact_sum(x))


def money_avg(x: str | Column) -> Column:
    return F.try_divide(exact_sum(x).cast("double"), F.count(as_column(x)))


def six_digit_avg(x: str | Column) -> Column:
    """Average rounded to six digits, which hides the order of addition."""
    return F.round(F.avg(as_column(x)), 6)


def percent(part: str | Column, whole: str | Column) -> Column:
    """``part / whole`` in percent, two digits; null when ``whole`` is zero."""
    return F.round(F.try_divide(as_column(part), as_column(whole)) * 100, 2)


def band(x: str | Column, bounds: Iterable[tuple[float, str]], rest: str) -> Column:
    """Label of the first bound that ``x`` is strictly above, else ``rest``."""
    value, label = as_column(x), None
    for bound, name in bounds:
        test = value > F.lit(bound)
        label = F.when(test, name) if label is None else label.when(test, name)
    return F.lit(rest) if label is None else label.otherwise(rest)


def day(ts: str | Column) -> Column:
    return as_column(ts).cast("date")


def weekend_flag(ts: str | Column) -> Column:
    """1 on Saturday and Sunday, else 0; a missing date counts as a weekday."""
    return F.coalesce(F.dayofweek(as_column(ts)).isin(1, 7), F.lit(False)).cast("int")


def season(ts: str | Column) -> Column:
    *named, (last, _) = SEASON_MONTHS.items()
    month, label = F.month(as_column(ts)), None
    for name, months in named:
        test = month.isin(*months)
        label = F.when(test, name) if label is None else label.when(test, name)
    return label.otherwise(last)


def one_row_to_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    """Turn a one-row frame of same-typed measures into ``(key, value)`` rows."""
    return df.unpivot([], list(df.columns), key, value)


def share_shuffle(df: DataFrame, *counts: str, measures: Iterable[str] = ()) -> DataFrame:
    """``df`` for a scalar average beside ``df`` itself.

    A count is never negative and a measure never below minus infinity, so no row
    goes. But naming them keeps them in the plan of the average, which then equals the
    plan of ``df`` up to its shuffle, and Spark shuffles once for both.
    """
    for name in counts:
        df = df.filter(F.col(name) >= 0)
    for name in measures:
        df = df.filter(F.coalesce(F.col(name), F.lit(0.0)) > F.lit(float("-inf")))
    return df


def null_safe_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key``, where a missing key meets a missing key."""
    other = right.withColumnRenamed(key, f"other_{key}")
    same = F.col(key).eqNullSafe(F.col(f"other_{key}"))
    return left.join(other, same, how).drop(f"other_{key}")


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows; the last of ``order`` must be unique to settle ties."""
    return df.orderBy(*order).limit(k)
