"""Time-series features over panels.

A panel holds one row per (group, date); ``panel`` builds it and combines raw
rows before the shuffle.  Windows over a series go over blocks of it: a short
series is one block, a long one is cut into overlapping blocks, so that also a
single series spreads over the cluster.  Operators on raw rows
(``customer_history``) never open a window over a customer's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql import types as T

from tillwork.functions.dates import roll_to_weekday
from tillwork.functions.numeric import all_of, divide, total
from tillwork.operators.ordered import dense_ids, known_around, running_before, series_blocks
from tillwork.operators.smoothing import smoothing_backtest, smoothing_search  # noqa: F401
from tillwork.session import attach_row, fits_single_task, materialise, small_side


def _window(date_col: str, group_cols: Sequence[str] = ()):
    """Order within the blocks that ``series_blocks`` has made."""
    return Window.partitionBy(*[F.col(c) for c in group_cols], F.col("_block")).orderBy(date_col)


def _value_columns(df: DataFrame, date_col: str, group_cols: Sequence[str], columns) -> list[str]:
    skip = {date_col, *group_cols}
    return list(columns) if columns is not None else [c for c in df.columns if c not in skip]


def panel(
    df: DataFrame, date_col: str, group_cols: Sequence[str], aggregates: dict[str, Column], step: str = "1 day"
) -> DataFrame:
    """One row per group and date on a dense calendar; cells without rows hold NULL."""
    groups = list(group_cols)
    base = df.filter(all_of([F.col(c).isNotNull() for c in (*groups, date_col)])).groupBy(*groups, date_col).agg(
        *[v.alias(k) for k, v in aggregates.items()])
    bounds = base.agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    days = F.explode(F.sequence("_lo", "_hi", F.expr(f"interval {step}"))).alias(date_col)
    if not groups:
        return bounds.select(days).join(base, date_col, "left")
    spine = attach_row(base.select(*groups).distinct(), bounds).select(*groups, days)
    return spine.join(base, [*groups, date_col], "left")


# ---- customer history on raw rows ------------------------------------------

def customer_history(df: DataFrame, customer: str, date_col: str, key: str) -> DataFrame:
    """Add ``first_time_customer`` and ``days_since_last_purchase``.

    The flag is 1 on all rows at the customer's first date.  The days are
    counted from the previous row of the customer in (date, key) order, 0 for
    the first; dates count by day.  Rows are first reduced to (customer, day), so the ordered step
    sees at most one row per calendar day even for a customer with most rows.
    """
    days = df.filter(F.col(customer).isNotNull() & F.col(date_col).isNotNull()).groupBy(
        F.col(customer).alias("_c"), F.to_date(date_col).alias("_d")).agg(F.min(key).alias("_first_key"))
    order = Window.partitionBy("_c").orderBy("_d")
    days = days.select(
        "_c", "_d", "_first_key",
        F.row_number().over(order).alias("_nth"),
        F.coalesce(F.date_diff("_d", F.lag("_d").over(order)), F.lit(0)).alias("_gap"),
    )
    joined = df.join(days, (F.col(customer) == F.col("_c")) & (F.to_date(date_col) == F.col("_d")), "left")
    return joined.withColumns({
        "first_time_customer": F.coalesce((F.col("_nth") == 1).cast("int"), F.lit(0)),
        "days_since_last_purchase": F.when(F.col(key) == F.col("_first_key"), F.col("_gap")).otherwise(0),
    }).drop("_c", "_d", "_first_key", "_nth", "_gap")


# ---- lags, adstock, rolling ------------------------------------------------

def create_lag(
    df: DataFrame, date_col: str, lags: Sequence[int], group_cols: Sequence[str] = (), suffix: str = "",
    columns: Sequence[str] | None = None, limit: int | bool | None = None,
) -> DataFrame:
    """``{col}_{n}{suffix}``: values n rows back, gaps filled from the next known lagged value.

    Default columns are all but the date and group columns, compared by name
    (the surveyed code tests for substrings of the date column's name).
    """
    names = _value_columns(df, date_col, group_cols, columns)
    small = fits_single_task(df, limit)
    order = _window(date_col, group_cols)
    rows = series_blocks(df.select(*group_cols, date_col, *names), group_cols, [date_col], max(0, *lags), max(0, *[-n for n in lags]), small)
    made = [f"{c}_{n}{suffix}" for n in lags for c in names]
    shifted = rows.select(*group_cols, date_col, "_own", *[
        F.lag(c, n).over(order).alias(f"{c}_{n}{suffix}") for n in lags for c in names]).filter("_own").drop("_own")
    known = known_around(shifted, {c: F.col(c) for c in made}, group_cols, [date_col], small)
    return known.select(*group_cols, date_col, *[F.col(f"{c}_ahead").alias(c) for c in made])


def decay_rate(half_life: float) -> float:
    return 0.5 ** (1.0 / half_life)


def create_adstock(
    df: DataFrame, date_col: str, half_lives: Sequence[float], group_cols: Sequence[str] = (), suffix: str = "",
    columns: Sequence[str] | None = None, max_memory: int = 0, limit: int | bool | None = None,
) -> DataFrame:
    """``{col}_{n}{suffix}``: carry-over of past values with the given half-lives.

    With ``max_memory`` = L the last L rows count, as window expressions over a
    single sort.  With 0 the memory is unlimited: ``a[t] = x[t] + d * a[t-1]`` is
    summed within blocks of a series, and what a block ends with is carried into
    the next one by the power of the decay.
    """
    names = _value_columns(df, date_col, group_cols, columns)
    small = fits_single_task(df, limit)
    if max_memory:
        order = _window(date_col, group_cols)

        def finite_memory(c: str, n: float) -> Column:
            d = decay_rate(n)
            return total([F.lag(F.col(c).cast("double"), j, 0.0).over(order) * F.lit(d**j) for j in range(max_memory)])

        rows = series_blocks(df.select(*group_cols, date_col, *names), group_cols, [date_col], max_memory - 1, 0, small)
        return rows.select(*group_cols, date_col, "_own", *[
            finite_memory(c, n).alias(f"{c}_{n}{suffix}") for n in half_lives for c in names]).filter("_own").drop("_own")
    named = {f"_a{k}": f"{c}_{n}{suffix}" for k, (n, c) in enumerate((n, c) for n in half_lives for c in names)}
    results = [(c, n, r) for r, (n, c) in zip(named, ((n, c) for n in half_lives for c in names))]
    keys = [*group_cols, date_col]
    rows = series_blocks(df.select(*keys, *[F.col(c).cast("double").alias(c) for c in names]), group_cols, [date_col], limit=small)
    schema = T.StructType([rows.schema[k] for k in (*keys, "_block", "_pos")] + [T.StructField(r, T.DoubleType()) for _, _, r in results])

    def carry(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date_col, kind="stable")
        out = pdf[[*keys, "_block", "_pos"]].copy()
        for c, n, name in results:
            out[name] = decayed_sums(pdf[c].to_numpy(dtype="float64"), decay_rate(n))
        return out

    made = rows.groupBy(*group_cols, "_block").applyInPandas(carry, schema)
    if small:
        return made.select(*keys, *[F.col(r).alias(name) for r, name in named.items()])
    # blocks are as long as the first position of the next one says
    made = materialise(made)
    ends = made.groupBy(*group_cols, "_block").agg(F.min("_pos").alias("_start"), *[
        F.max_by(r, "_pos").alias(f"_end_{r}") for _, _, r in results])
    before = Window.partitionBy(*[F.col(c) for c in group_cols] or [F.lit(0)]).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    past = F.collect_list(F.struct(F.col("_start").alias("s"), *[F.col(f"_end_{r}").alias(r) for _, _, r in results])).over(before)
    ends = ends.withColumn("_past", past)

    def carried_in(r: str, n: float) -> Column:
        """What earlier blocks leave at the last row before a block: their ends, each decayed by the rows between."""
        ends_with, until = F.transform("_past", lambda e: e[r]), F.transform("_past", lambda e: e["s"])
        pairs = F.arrays_zip(ends_with.alias("end"), F.concat(F.slice(until, 2, F.size(until)), F.array("_start")).alias("next"))
        total_ = F.aggregate(pairs, F.lit(0.0), lambda sum_, p: sum_ + p["end"] * F.pow(
            F.lit(decay_rate(n)), (F.col("_start") - p["next"]).cast("double")))
        return F.when(F.size("_past") == 0, F.lit(0.0)).otherwise(total_)

    carried = [carried_in(r, n).alias(f"_in_{r}") for _, n, r in results]
    ends = ends.select(*[F.col(c).alias(f"_k_{c}") for c in group_cols], F.col("_block").alias("_k_block"), F.col("_start"), *carried)
    same = all_of([F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in group_cols] + [F.col("_block") == F.col("_k_block")])
    joined = made.join(small_side(ends), same)
    return joined.select(*keys, *[
        (F.col(r) + F.col(f"_in_{r}") * F.pow(F.lit(decay_rate(n)), (F.col("_pos") - F.col("_start") + 1).cast("double"))).alias(named[r])
        for _, n, r in results])


def decayed_sums(x: np.ndarray, d: float, width: int = 64) -> np.ndarray:
    """``a[t] = x[t] + d * a[t-1]``, a stretch of ``width`` values at a time; a missing value makes all later ones missing."""
    known = int(np.argmax(np.isnan(x))) if np.isnan(x).any() else len(x)
    out = np.full(len(x), np.nan)
    padded = np.zeros(-(-known // width) * width)
    padded[:known] = x[:known]
    steps = np.arange(width)
    powers = np.where(steps[:, None] >= steps, d ** np.maximum(steps[:, None] - steps, 0.0), 0.0)
    sums, last, ahead = padded.reshape(-1, width) @ powers.T, 0.0, d ** (steps + 1.0)
    for row in sums:
        row += last * ahead
        last = row[-1]
    out[:known] = sums.reshape(-1)[:known]
    return out


def rolling_mean(
    df: DataFrame, columns: Sequence[str], date_col: str, window: int, remove_rows: str = "keep",
    group_cols: Sequence[str] = (), limit: int | bool | None = None,
) -> DataFrame:
    """Mean of the last ``window`` rows, NULL unless all of them are present.

    ``keep`` keeps the NULL rows, ``drop`` removes rows with any, ``append``
    puts the raw values of the first ``window - 1`` rows back.  Rows are taken
    in date order within the groups.
    """
    if remove_rows not in ("keep", "drop", "append"):
        raise ValueError("remove_rows is one of 'keep', 'drop', 'append'")
    order = _window(date_col, group_cols)
    last = order.rowsBetween(-(window - 1), 0)
    means = {f"_m_{c}": F.when(F.count(c).over(last) == window, F.avg(c).over(last)) for c in columns}
    rows = series_blocks(df.select(*group_cols, date_col, *columns), group_cols, [date_col], window - 1, 0, limit)
    rows = rows.withColumns(means).filter("_own")
    complete = all_of([F.col(f"_m_{c}").isNotNull() for c in columns])
    early = F.col("_pos") < window - 1
    if remove_rows == "drop":
        rows = rows.filter(complete)
    elif remove_rows == "append":
        rows = rows.filter(complete | early)
    value = (lambda c: F.when(early, F.col(c)).otherwise(F.col(f"_m_{c}"))) if remove_rows == "append" else (
        lambda c: F.col(f"_m_{c}"))
    return rows.select(*group_cols, date_col, *[value(c).alias(c) for c in columns])


# ---- filling ---------------------------------------------------------------

def _filled(df, columns, date_col, group_cols, side, limit):
    rows = known_around(df, {c: F.col(c) for c in columns}, group_cols, [date_col], limit)
    return rows.select(*[F.col(f"{c}_{side}").alias(c) if c in columns else F.col(c) for c in df.columns])


def fill_forward(
    df: DataFrame, columns: Sequence[str], date_col: str, group_cols: Sequence[str] = (), limit: int | None = None
) -> DataFrame:
    """The last known value in date order; also for tables that are no panel, of any group size."""
    return _filled(df, columns, date_col, group_cols, "back", limit)


def fill_backward(
    df: DataFrame, columns: Sequence[str], date_col: str, group_cols: Sequence[str] = (), limit: int | None = None
) -> DataFrame:
    """The next known value in date order."""
    return _filled(df, columns, date_col, group_cols, "ahead", limit)


def interpolate(
    df: DataFrame, columns: Sequence[str], date_col: str, group_cols: Sequence[str] = (), limit: int | None = None
) -> DataFrame:
    """Linear by row position between known values; the ends take the nearest known value."""
    rows = running_before(df.withColumn("_row", F.lit(1).cast("bigint")), group_cols, [date_col], ["_row"], limit)
    pos = F.col("_row_before").cast("double")
    known = {f"_{c}": F.when(F.col(c).isNotNull(), F.struct(pos.alias("p"), F.col(c).cast("double").alias("v"))) for c in columns}
    rows = known_around(rows, known, group_cols, [date_col], limit)
    out = {}
    for c in columns:
        lo, hi = F.col(f"_{c}_back"), F.col(f"_{c}_ahead")
        slope = (hi["v"] - lo["v"]) * divide(pos - lo["p"], hi["p"] - lo["p"])
        out[c] = F.coalesce(F.col(c).cast("double"), lo["v"] + slope, lo["v"], hi["v"])
    return rows.select(*[out[c].alias(c) if c in out else F.col(c) for c in df.columns])


# ---- seasonality and trend -------------------------------------------------

def seasonal_index(
    df: DataFrame, value: str, date_col: str, granularity: str = "week", granularity_col: str | None = None,
    thresholds: Sequence[float] | None = None,
) -> DataFrame:
    """Mean by ISO week or month over the overall mean, as ``s_index_weekly`` / ``s_index_monthly``.

    With two ``thresholds`` (low, high) the index becomes a class: 1 above
    high, -1 below low, else 0.
    """
    if thresholds is not None and len(thresholds) != 2:
        raise ValueError("two thresholds are required, lower and upper")
    part = {"week": F.weekofyear, "month": F.month}[granularity]
    key = F.col(granularity_col) if granularity_col else part(date_col)
    name = "s_index_weekly" if granularity == "week" else "s_index_monthly"
    rows = df.withColumn("_season", key)
    sums = rows.groupBy("_season").agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    overall = sums.agg(divide(F.sum("_s"), F.sum("_n")).alias("_overall"))
    index = attach_row(sums, overall).select(
        F.col("_season").alias("_key"), divide(divide("_s", "_n"), "_overall").alias(name))
    joined = rows.join(small_side(index), F.col("_season") == F.col("_key"), "left").drop("_season", "_key")
    if thresholds is not None:
        low, high = thresholds
        # a missing index compares false on both sides, hence class 0
        joined = joined.withColumn(name, F.when(F.col(name) > high, 1).when(F.col(name) < low, -1).otherwise(0))
    return joined


def decompose(
    df: DataFrame, value: str, date_col: str, method: str = "additive", period: int = 52,
    group_cols: Sequence[str] = (), limit: int | bool | None = None,
) -> DataFrame:
    """Add the ``seasonal`` component of a classical decomposition.

    The trend is a centred moving average (half weights at both ends for an
    even period).  The component is joined to the rows by date and group.
    """
    if method not in ("additive", "multiplicative"):
        raise ValueError("method is 'additive' or 'multiplicative'")
    order = _window(date_col, group_cols)
    half = period // 2
    x = F.col(value).cast("double")
    if period % 2:
        trend = F.sum(x).over(order.rowsBetween(-half, half)) / period
    else:
        inner = F.sum(x).over(order.rowsBetween(-(half - 1), half - 1))
        trend = (inner + 0.5 * (F.lag(x, half).over(order) + F.lead(x, half).over(order))) / period
    full = F.count(x).over(order.rowsBetween(-half, half)) == 2 * half + 1
    rows = series_blocks(df, group_cols, [date_col], half, half, limit).withColumn("_trend", F.when(full, trend)).filter("_own")
    rows = rows.withColumn("_phase", F.pmod("_pos", F.lit(period)))
    additive = method == "additive"
    detrended = x - F.col("_trend") if additive else divide(x, "_trend")
    phases = rows.groupBy(*group_cols, "_phase").agg(F.avg(detrended).alias("_p"))
    series = Window.partitionBy(*[F.col(c) for c in group_cols]) if group_cols else Window.partitionBy(F.lit(0))
    centre = F.avg("_p").over(series)
    phases = phases.select(*group_cols, "_phase",
                           (F.col("_p") - centre if additive else divide("_p", centre)).alias("seasonal"))
    return rows.join(phases, [*group_cols, "_phase"], "left").drop("_trend", "_phase").select(*df.columns, "seasonal")


def linear_trend(
    df: DataFrame, date_col: str, granularity: str = "Day", year_month: Sequence[str] = ()
) -> DataFrame:
    """Add ``trend``, computed from the first date without building a calendar.

    Day: 1, 2, ... per calendar day.  Week: 1, 2, ... per Sunday, other days
    NULL.  Month: year difference plus month number, on Sundays only (the
    formula of the surveyed code, without a factor 12); given year and month
    columns are read from the data.
    """
    if granularity not in ("Day", "Week", "Month"):
        raise ValueError("granularity is 'Day', 'Week' or 'Month'")
    d = F.to_date(date_col)
    first = df.agg(F.min(d).alias("_first"))
    if granularity == "Month" and year_month:
        year, month = (F.col(c) for c in year_month)
        rows = attach_row(df, df.agg(F.min(year).alias("_year")))
        return rows.withColumn("trend", year - F.col("_year") + month).drop("_year")
    rows = attach_row(df, first)
    sunday = roll_to_weekday(F.col("_first"))
    on_sunday = F.weekday(d) == 6
    trend = {
        "Day": F.date_diff(d, "_first") + 1,
        "Week": F.when(on_sunday, (F.date_diff(d, sunday) / 7 + 1).cast("int")),
        "Month": F.when(on_sunday, F.year(d) - F.year(sunday) + F.month(d)),
    }[granularity]
    return rows.withColumn("trend", trend).drop("_first")


def rolling_origin_folds(
    df: DataFrame, date_col: str, group_cols: Sequence[str] = (), n_splits: int = 6, gap: int = 0,
    n_test: int = 24, stride: int = 4, limit: int | bool | None = None,
) -> DataFrame:
    """Cross-validation folds: ``fold`` and ``role`` (train or test), newest fold first.

    Fold k tests on ``n_test`` points ending ``k * stride`` points before the
    end and trains on everything earlier than ``gap`` points before them.
    """
    placed = running_before(df.withColumn("_row", F.lit(1).cast("bigint")), group_cols, [date_col], ["_row"], limit)
    rows = placed.select(*df.columns, (F.col("_row_total") - F.col("_row_before")).alias("_back"))
    folds = rows.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    at = F.col("_back") - F.col("fold") * stride
    role = F.when((at >= 1) & (at <= n_test), "test").when(at > n_test + gap, "train")
    return folds.withColumn("role", role).filter(F.col("role").isNotNull()).drop("_back")


def group_ids(df: DataFrame, group_cols: Sequence[str], name: str = "id") -> DataFrame:
    """Add the dense 0-based number of each row's group in key order."""
    return df.join(small_side(dense_ids(df, group_cols, name)), list(group_cols))
