"""Null-keeping bounds, guarded division and rounding."""

from pyspark.sql import Column, functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clip(value: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound a value; null stays null (`greatest`/`least` would replace it by the bound)."""
    value = _column(value)
    bounded = value
    if hi is not None:
        above = (value > F.lit(float(hi))) & ~F.isnan(value)  # NaN sorts above every number
        bounded = F.when(above, F.lit(float(hi))).otherwise(bounded)
    if lo is not None:
        bounded = F.when(value < F.lit(float(lo)), F.lit(float(lo))).otherwise(bounded)
    return bounded


def clip_between(value: Column, lo: Column, hi: Column) -> Column:
    """Bound a value by two columns."""
    return F.when(value < lo, lo).when(value > hi, hi).otherwise(value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null for a zero denominator, in ANSI mode too."""
    return F.try_divide(numerator, denominator)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    quotient = ratio(numerator, denominator)
    return F.when(not_finite(quotient), F.lit(0.0)).otherwise(quotient)


def finite(value: Column | str) -> Column:
    """Null for null and NaN, the value otherwise."""
    value = _column(value).cast("double")
    return F.when(~F.isnan(value), value)


def not_finite(value: Column | str) -> Column:
    """True for null, NaN and both infinities."""
    value = _column(value).cast("double")
    return value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(float("inf")))


def half_even(value: Column, digits: int) -> Column:
    """Round to even on ties."""
    return F.bround(value, digits)


def rounded(value: Column | str, digits: int = 6) -> Column:
    """Report rounding; adding 0.0 turns -0.0 into 0.0."""
    return F.round(_column(value), digits) + F.lit(0.0)


def edges_below(value: Column, edges: list[float], inclusive: bool = False) -> Column:
    """Number of edges smaller than the value (or not larger, when inclusive), as a binary search of comparisons."""
    edges = sorted(edges)

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        middle = (lo + hi) // 2
        edge = F.lit(float(edges[middle]))
        passed = value >= edge if inclusive else value > edge
        return F.when(passed, search(middle + 1, hi)).otherwise(search(lo, middle))

    return F.when(value.isNotNull(), search(0, len(edges)))
