"""Cleaning: projections, casts, renames, row and column filters."""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.functions.dates import parse_date
from tillwork.functions.hashing import hash_order
from tillwork.functions.numeric import all_of, finite
from tillwork.functions.text import clean_text, snake_name
from tillwork.operators.ordered import first_per_key, take_by_hash


def finite_numbers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN and infinities of the floating-point columns become NULL (done on ingest)."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite(c) for c in names})


def clean_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = columns or columns_of_type(df, "string")
    return df.withColumns({c: clean_text(c) for c in names})


def snake_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_name(c) for c in df.columns])


def coalesce_columns(df: DataFrame, columns: Sequence[str], name: str, drop_sources: bool = True) -> DataFrame:
    """First non-NULL value of several columns."""
    merged = F.coalesce(*[F.col(c) for c in columns])
    keep = [c for c in df.columns if not (drop_sources and c in columns) and c != name]
    return df.select(*keep, merged.alias(name))


def change_type(df: DataFrame, columns: Sequence[str], dtype: str) -> DataFrame:
    """Cast; text that cannot be read as the type becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(dtype) for c in columns})


def parse_dates(df: DataFrame, column: str, pattern: str = "dd/MM/yyyy") -> DataFrame:
    return df.withColumn(column, parse_date(column, pattern))


def clean_product_table(
    df: DataFrame, key: str, order: Sequence[Column], merges: dict[str, Sequence[str]] | None = None
) -> DataFrame:
    """Clean strings, merge duplicate columns, keep one row per key, snake-case names."""
    df = clean_strings(df)
    for name, sources in (merges or {}).items():
        df = coalesce_columns(df, sources, name)
    return snake_names(first_per_key(df, [key], order))


def clean_order_table(
    df: DataFrame,
    integers: Sequence[str],
    date: str,
    renames: dict[str, str] | None = None,
    pattern: str = "dd/MM/yyyy",
) -> DataFrame:
    """Cast integers, parse the ledger date, clean strings, snake-case and rename."""
    texts = [c for c in columns_of_type(df, "string") if c not in (*integers, date)]
    df = parse_dates(change_type(df, integers, "bigint"), date, pattern)
    return snake_names(clean_strings(df, texts)).withColumnsRenamed(renames or {})


def remove_duplicates(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: str = "first"
) -> DataFrame:
    """One row per key: the first or the last in an explicit total order."""
    if keep == "last":
        order = [_reverse(c) for c in order]
    return first_per_key(df, keys, order)


def _reverse(c: Column | str) -> Column:
    return F.desc(c) if isinstance(c, str) else c.desc()


def derive_where_present(df: DataFrame, column: str, name: str, op: Callable[[Column], Column]) -> DataFrame:
    """``op(column)`` for rows that have a value, NULL elsewhere."""
    return df.withColumn(name, F.when(F.col(column).isNotNull(), op(F.col(column))))


def features_and_target(df: DataFrame, keys: Sequence[str], target: str) -> tuple[DataFrame, DataFrame]:
    """Feature frame (keys kept) and ``(keys, target)`` frame."""
    return df.drop(target), df.select(*keys, target)


def select_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Keep-list projection; an empty list keeps everything."""
    return df.select(*keep) if keep else df


def find_columns(
    df: DataFrame, keyword: str, except_columns: Sequence[str] = (), case_sensitive: bool = True
) -> list[str]:
    """Names containing a keyword (the surveyed ``drop_cols`` returns names and drops nothing)."""
    flags = 0 if case_sensitive else re.IGNORECASE
    return [c for c in df.columns if re.search(re.escape(keyword), c, flags) and c not in except_columns]


def drop_columns_like(
    df: DataFrame, keyword: str, except_columns: Sequence[str] = (), case_sensitive: bool = True
) -> DataFrame:
    return df.drop(*find_columns(df, keyword, except_columns, case_sensitive))


_TYPE_TESTS: dict[str, Callable[[T.DataType], bool]] = {
    "number": lambda t: isinstance(t, T.NumericType),
    "string": lambda t: isinstance(t, T.StringType),
    "bool": lambda t: isinstance(t, T.BooleanType),
    "date": lambda t: isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)),
    "non_number": lambda t: not isinstance(t, T.NumericType),
}


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``number``, ``string``, ``bool``, ``date`` or ``non_number`` columns."""
    return [f.name for f in df.schema if _TYPE_TESTS[kind](f.dataType)]


def segregate(
    df: DataFrame,
    measure: str,
    identity: Sequence[str],
    categories: Sequence[str] = (),
    with_measure: bool = True,
) -> dict[str, DataFrame]:
    """Split rows on whether the measure is present and project numeric, identity, category parts.

    The numeric part always holds the numeric columns; the surveyed code returns
    the non-numeric ones for rows without the measure, against its description.
    """
    present = F.col(measure).isNotNull()
    rows = df.filter(present if with_measure else ~present)
    numeric = [c for c in columns_of_type(df, "number") if c not in (*identity, *categories)]
    return {
        "numeric": rows.select(*identity, *numeric),
        "identity": rows.select(*identity),
        "category": rows.select(*identity, *categories),
    }


def _drop_flagged(df: DataFrame, flags: DataFrame) -> DataFrame:
    row = flags.first()
    return df.drop(*[c for c in row.__fields__ if row[c]])


def drop_constant(df: DataFrame, numeric: bool = True) -> DataFrame:
    """Drop numeric columns of zero variance, or columns with at most one distinct value."""
    names = columns_of_type(df, "number") if numeric else df.columns
    if not names:
        return df
    if numeric:
        tests = [F.coalesce(F.var_samp(c) == 0, F.lit(False)).alias(c) for c in names]
    else:
        tests = [(F.min(c).eqNullSafe(F.max(c))).alias(c) for c in names]
    return _drop_flagged(df, df.agg(*tests))


def drop_all_zero(df: DataFrame) -> DataFrame:
    """Drop numeric columns whose every value is zero; a NULL keeps the column."""
    names = columns_of_type(df, "number")
    tests = [F.coalesce(F.min(F.coalesce(F.col(c) == 0, F.lit(False))), F.lit(False)).alias(c) for c in names]
    return _drop_flagged(df, df.agg(*tests)) if names else df


def _known(df: DataFrame, columns: Sequence[str]) -> list[str]:
    for c in columns:
        if c not in df.columns:
            warnings.warn(f"no column {c!r}, skipped", stacklevel=3)
    return [c for c in columns if c in df.columns]


def log_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``log(1 + x)``; unknown columns are skipped with a warning."""
    return df.withColumns({c: F.log1p(F.col(c)) for c in _known(df, columns)})


def negate_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Multiply by -1: what the surveyed "inverse" transform computes."""
    return df.withColumns({c: -F.col(c) for c in _known(df, columns)})


def sample_fraction(df: DataFrame, keys: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """Exactly ``round(fraction * n)`` rows, chosen by seeded hash order of the key."""
    taken = take_by_hash(df, keys, seed, {"taken": F.bround(F.lit(fraction) * F.col("n"))})
    return taken.filter("taken").drop("taken")


def sample_approximate(df: DataFrame, keys: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """About ``fraction`` of the rows in one filter: no count, no shuffle."""
    cut = format(int(fraction * 0xFFFFFFFF), "08x")
    return df.filter(F.substring(hash_order(keys, seed), 1, 8) < cut)


def filter_positive(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(all_of([F.col(c) > 0 for c in columns]))


def residual_flags(
    df: DataFrame, actual: str, predicted: str, threshold: float = 0.3, error: str = "abs"
) -> DataFrame:
    """Add ``residual`` and ``residual_flag``.

    A row is ``OverPrediction`` or ``UnderPrediction`` where the prediction
    misses the actual value by more than ``threshold`` of it, else ``Others``.
    The named columns are used; the surveyed code ignores its arguments.
    """
    y, p = F.col(actual), F.col(predicted)
    gap = F.abs(p - y)
    flag = (
        F.when(p > y * (1 + threshold), "OverPrediction")
        .when(p < y * (1 - threshold), "UnderPrediction")
        .otherwise("Others")
    )
    return df.withColumns({"residual": F.try_divide(gap, y) if error == "pe" else gap, "residual_flag": flag})


def forecast_flags(
    df: DataFrame, actual: str, predicted: str, threshold: float = 0.3, floor: float = 100.0
) -> DataFrame:
    """``good`` / ``over predict`` / ``under predict``, judged only where actuals exceed ``floor``."""
    y, p = F.col(actual), F.col(predicted)
    flag = (
        F.when((y > floor) & (p > y * (1 + threshold)), "over predict")
        .when((y > floor) & (p < y * (1 - threshold)), "under predict")
        .otherwise("good")
    )
    return df.withColumn("forecast_flag", flag)
