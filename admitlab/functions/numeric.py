"""Exact rounding helpers.

``round(avg(x), d)`` on doubles depends on summation order, so two engines (or
two runs with different partitioning) can disagree in the last cent.  These
helpers keep the numerator and denominator as integers (decimal(38,0)) and
round half away from zero in integer arithmetic; only the final division by
10^d happens in floating point, which is exact and engine independent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BIG = "decimal(38,0)"


def rdiv(num: Column, den: Column, digits: int) -> Column:
    """num/den rounded to ``digits`` places, half away from zero; NULL if den is 0 or NULL."""
    s = 10 ** digits
    n = num.cast(_BIG)
    d = F.nullif(den, F.lit(0)).cast(_BIG)
    q = (F.abs(n) * (2 * s) + d).cast(_BIG)
    d2 = (d * 2).cast(_BIG)
    # integer division without a lossy decimal quotient: (q - q mod d2) / d2 is exact
    whole = ((q - q % d2).cast(_BIG) / d2).cast(_BIG)
    # sign applied to the integer: a negative value rounding to 0 gives 0.0, never -0.0
    signed = F.when(n < 0, -whole).otherwise(whole)
    return signed.cast("double") / F.lit(float(s))


def scaled_sum(col: Column, scale: int) -> Column:
    """SUM(col * 10^scale) as an exact integer (col has ``scale`` decimals)."""
    return F.sum((col * (10 ** scale)).cast("decimal(18,0)"))


def ravg(col: Column, scale: int, digits: int) -> Column:
    """AVG(col) rounded to ``digits`` places, exact (aggregate expression)."""
    m = 10 ** scale
    return rdiv(scaled_sum(col, scale), F.count(col) * m, digits)


def cents(col: Column) -> Column:
    """Money column as a whole number of cents (bigint)."""
    return (col * 100).cast("bigint")


def money(col: Column) -> Column:
    """Decimal sum or amount as double (exact conversion of a decimal)."""
    return col.cast("double")
