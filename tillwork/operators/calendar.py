"""Calendar attributes, date rolling and holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions import dates
from tillwork.session import small_side


def add_fiscal_calendar(df: DataFrame, date_col: str, calendar: DataFrame | None = None, calendar_date: str | None = None) -> DataFrame:
    """Calendar attributes ``Year``, ``Month``, ``Week``, ``Quarter``, or a left join to a given calendar."""
    if calendar is not None:
        right = calendar.withColumnRenamed(calendar_date or date_col, "_calendar_day")
        return df.join(small_side(right), F.col(date_col) == F.col("_calendar_day"), "left").drop("_calendar_day")
    return df.withColumns({
        "Year": dates.year_label(date_col),
        "Month": dates.month_name(date_col),
        "Week": dates.week_label(date_col),
        "Quarter": dates.quarter_label(date_col),
    })


def move_to_weekday(df: DataFrame, date_col: str, target_day: int = 6) -> DataFrame:
    """Roll dates forward to a weekday: 0 is Monday, 6 is Sunday."""
    return df.withColumn(date_col, dates.roll_to_weekday(date_col, target_day))


def move_to_month_end(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn(date_col, dates.roll_to_month_end(date_col))


def add_holidays(
    df: DataFrame, holidays: DataFrame, date_col: str, holiday_col: str, granularity: str = "Day", day_move: int = 6
) -> DataFrame:
    """Left join the number of holidays per date as ``Is_Holiday``, 0 where there is none.

    Holidays are rolled to the week's day or the month's end first; the weekly
    path fails on a wrong parameter name in the surveyed code and works here.
    """
    days = holidays.select(F.to_date(holiday_col).alias("_holiday"))
    if granularity == "Week":
        days = move_to_weekday(days, "_holiday", day_move)
    elif granularity == "Month":
        days = move_to_month_end(days, "_holiday")
    counts = days.filter(F.col("_holiday").isNotNull()).groupBy("_holiday").agg(F.count(F.lit(1)).alias("Is_Holiday"))
    joined = df.join(small_side(counts), F.col(date_col) == F.col("_holiday"), "left").drop("_holiday")
    return joined.withColumn("Is_Holiday", F.coalesce("Is_Holiday", F.lit(0).cast("bigint")))
