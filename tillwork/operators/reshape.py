"""Mapped aggregation, melt, pivot and the spend tables built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.numeric import all_of, divide_or_zero, sum_or_zero

#: Configuration tables (mappings, coefficients) are small by definition.
CONFIG_ROWS = 10_000


def config_rows(df: DataFrame, limit: int = CONFIG_ROWS) -> list[dict]:
    """Rows of a configuration table; refused if it is not small."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows: not a configuration table")
    return [r.asDict() for r in rows]


def mapped_aggregate(df: DataFrame, mapping: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Average the variables mapped as ``Mean``, sum the others, per key, in one grouping."""
    return _mapped(df, config_rows(mapping), keys)


def _mapped(df: DataFrame, rows: list[dict], keys: Sequence[str]) -> DataFrame:
    exprs = [
        (F.avg(r["variable_name"]) if r["aggregation_type"] == "Mean" else sum_or_zero(r["variable_name"]))
        .alias(r["variable_name"])
        for r in rows
    ]
    return df.filter(all_of([F.col(k).isNotNull() for k in keys])).groupBy(*keys).agg(*exprs)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str = "variable", val: str = "value") -> DataFrame:
    return df.unpivot([F.col(c) for c in ids], [F.col(c).cast("double").alias(c) for c in values], var, val)


def pivot(
    df: DataFrame, index: Sequence[str], columns: str, levels: Sequence, value: str, agg: str = "avg"
) -> DataFrame:
    """Long to wide over a fixed list of levels."""
    return df.groupBy(*index).pivot(columns, list(levels)).agg(F.expr(f"{agg}(`{value}`)"))


def _melt_mapped(df: DataFrame, rows: list[dict], keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Melt the mapped variables and add their mapping attributes without a join."""
    entries = [
        F.struct(
            F.lit(r["variable_name"]).alias("variable_name"),
            *[F.lit(r[a]).alias(a) for a in attributes],
            F.col(r["variable_name"]).cast("double").alias("value"),
        )
        for r in rows
    ]
    return df.select(*keys, F.inline(F.array(*entries)))


def spend_activity(df: DataFrame, mapping: DataFrame, date_col: str, group_col: str | None = None) -> DataFrame:
    """Long spend-versus-activity table per date, group, activity root and description."""
    rows = config_rows(mapping)
    keys = [date_col] + ([group_col] if group_col else [])
    attributes = ["variable_activity_root", "variable_description", "variable_category"]
    long = _melt_mapped(_mapped(df, rows, keys), rows, keys, attributes)
    levels = sorted({r["variable_category"] for r in rows})
    if "Spend" not in levels:
        raise ValueError("the mapping has no 'Spend' category")
    index = [*keys, "variable_activity_root", "variable_description"]
    # one average per category; the names stay data, so "GRP" cannot clash with a "grp" column
    wide = long.filter(F.col("value").isNotNull()).groupBy(*index).agg(
        *[F.avg(F.when(F.col("variable_category") == x, F.col("value"))).alias(f"_v{i}") for i, x in enumerate(levels)])
    spend = F.col(f"_v{levels.index('Spend')}").alias("Spend")
    activities = [F.struct(F.lit(x).alias("activity_type"), F.col(f"_v{i}").alias("Activity"))
                  for i, x in enumerate(levels) if x != "Spend"]
    return wide.select(*index, spend, F.inline(F.array(*activities)))


def cost_per_activity(
    df: DataFrame,
    date_col: str,
    description: str | None = None,
    activity: str | None = None,
    start=None,
    end=None,
    group: tuple[str, str] | None = None,
) -> DataFrame:
    """Spend, activity and cost per activity by date; names match whatever their case.

    Without ``group = (column, value)`` the rows of all groups are summed.
    Undefined costs are 0.
    """
    tests: list[Column] = []
    if description is not None:
        tests.append(F.lower("variable_description") == description.lower())
    if activity is not None:
        tests.append(F.lower("activity_type") == activity.lower())
    if start is not None:
        tests.append(F.col(date_col) >= F.lit(start))
    if end is not None:
        tests.append(F.col(date_col) <= F.lit(end))
    if group is not None:
        tests.append(F.col(group[0]) == group[1])
    keys = [date_col, "variable_description", "activity_type"]
    summed = df.filter(all_of(tests)).groupBy(*keys).agg(
        sum_or_zero("Spend").alias("Spend"), sum_or_zero("Activity").alias("Activity"))
    return summed.withColumn("cost_per_act", divide_or_zero("Spend", "Activity"))


def quarterly_spend(
    df: DataFrame, mapping: DataFrame, year_col: str, quarter_col: str, group_col: str | None = None
) -> DataFrame:
    """Mapped variables per quarter in long form.

    Year and quarter are joined as text; the surveyed code joins the printed
    form of whole columns when they are not text already.
    """
    rows = config_rows(mapping)
    keyed = df.withColumn("YEAR_QTR", F.concat(F.col(year_col).cast("string"), F.col(quarter_col).cast("string")))
    keys = ["YEAR_QTR"] + ([group_col] if group_col else [])
    return _melt_mapped(_mapped(keyed, rows, keys), rows, keys, ["variable_description"])


def quarterly_series(spend: DataFrame, description: str, group: tuple[str, str] | None = None) -> DataFrame:
    """One description summed by quarter, over all groups or one."""
    rows = spend.filter(F.col("variable_description") == description)
    if group is not None:
        rows = rows.filter(F.col(group[0]) == group[1])
    return rows.groupBy("YEAR_QTR").agg(sum_or_zero("value").alias("value"))


def actual_vs_predicted(
    df: DataFrame, date_col: str, group: tuple[str, str] | None = None, is_log: bool = False
) -> DataFrame:
    """``actuals`` and ``preds`` by date, summed over all groups or for one."""
    value = (lambda c: F.exp(F.col(c))) if is_log else F.col
    rows = df.filter(F.col(group[0]) == group[1]) if group else df
    return rows.groupBy(date_col).agg(*[sum_or_zero(value(c)).alias(c) for c in ("actuals", "preds")])
