"""Engine-stable numeric column helpers.

Money is summed as ``decimal`` (exact, order independent) and turned into a double
only at the end. Ratios are computed in double with a fixed operation order, and
rounded by ``floor(x * 10^d + 0.5) / 10^d`` (half toward +inf) so that every engine
returns the same bits; ``ROUND`` on doubles differs between engines at .5 ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: str | Column) -> Column:
    return _c(c).cast("double")


def round_half_up(c: str | Column, digits: int = 2) -> Column:
    scale = 10 ** digits
    return F.floor(dbl(c) * scale + 0.5) / scale


def pct(num: str | Column, den: str | Column) -> Column:
    """num * 100 / den in double; NULL when the denominator is 0 or NULL."""
    return F.try_divide(dbl(num) * 100, F.nullif(dbl(den), F.lit(0.0)))


def pct2(num: str | Column, den: str | Column) -> Column:
    return round_half_up(pct(num, den), 2)


def sum_if(cond: Column, value: str | Column, zero=0) -> Column:
    """SUM(CASE WHEN cond THEN value ELSE 0 END)."""
    return F.sum(F.when(cond, _c(value)).otherwise(F.lit(zero)))


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def year_month(c: str | Column) -> Column:
    """Timestamp -> 'yyyy-MM' text."""
    return F.date_format(_c(c), "yyyy-MM")
