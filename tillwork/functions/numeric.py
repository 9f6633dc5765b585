"""Numeric rules shared by all operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """NaN and both infinities count as missing."""
    c = as_col(c).cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)


def divide(a: Column | str, b: Column | str) -> Column:
    """Division that yields NULL for a zero denominator."""
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))


def divide_or_zero(a: Column | str, b: Column | str) -> Column:
    """Division for display tables: missing and undefined results become 0."""
    return F.coalesce(divide(a, b), F.lit(0.0))


def half_even(c: Column | str, digits: int = 0) -> Column:
    """Banker's rounding, the rounding rule of the report tables."""
    return F.bround(as_col(c), digits)


def sum_or_zero(c: Column | str) -> Column:
    """Sum whose value for an all-NULL group is 0."""
    return F.coalesce(F.sum(as_col(c)), F.lit(0).cast("double"))


def pearson(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation; NULL where a side is constant (the built-in fails there under ANSI rules)."""
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y)))


def product(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a * b, cols, F.lit(1.0))


def total(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols, F.lit(0.0))


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def saturation(c: Column | str, alpha: float, beta: float) -> Column:
    """Diminishing-returns response ``alpha * (1 - exp(-beta * x))``."""
    return F.lit(float(alpha)) * (F.lit(1.0) - F.exp(-F.lit(float(beta)) * as_col(c)))
