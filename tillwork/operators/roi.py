"""Contribution and return on investment of a linear model."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwork.functions.numeric import divide, total
from tillwork.session import materialise


def contribution(df: DataFrame, target: str, coefficients: dict[str, float]) -> DataFrame:
    """Share of the target explained by each feature: ``sum(x) * beta / sum(y)``."""
    row = df.agg(F.sum(target).alias("_y"), *[F.sum(c).alias(f"_x{i}") for i, c in enumerate(coefficients)])
    parts = [
        F.struct(F.lit(c).alias("feature"), divide(F.col(f"_x{i}") * F.lit(float(b)), "_y").alias("contribution"))
        for i, (c, b) in enumerate(coefficients.items())
    ]
    return row.select(F.inline(F.array(*parts)))


def roi(df: DataFrame, target: str, coefficients: dict[str, float], columns: Sequence[str], cost: str) -> DataFrame:
    """Return of the chosen features: their contribution times sales over cost."""
    y = F.sum(target)
    share = total([divide(F.sum(c) * F.lit(float(coefficients[c])), y) for c in columns])
    return df.agg(divide(share * y, F.sum(cost)).alias("roi"))


def optimal_visits(
    segments: DataFrame,
    key: str,
    response: Callable[[Column], Column],
    coefficient: str = "coefficient",
    margin: str = "margin",
    cost: str = "cost",
    each_step: int = 4096,
) -> DataFrame:
    """First step whose incremental return falls below 1, for each segment.

    ``step`` is the 0-based step index the surveyed code returns and ``visits``
    the number of visits before that step.  The first ``each_step`` steps are
    tried one by one.  Segments that are open after them are searched by nested
    intervals, which finds the first step if returns diminish from there on.
    Both columns are NULL where the return is unknown (a NULL or zero cost); a
    return that is 1 or more even after 2**50 visits is an error.
    """
    n = F.col("n").cast("double")
    gain = (response(n + 1) - response(n)) * F.col(coefficient)
    inc = divide(gain * F.col(margin), cost)

    def first_below(rows: DataFrame, tried: Column) -> DataFrame:
        steps = rows.withColumn("n", F.explode(tried)).withColumn("_inc", inc)
        return steps.groupBy(key).agg(
            F.min(F.when(F.col("_inc") < 1, F.col("n"))).alias("visits"), F.count("_inc").alias("_known"))

    def segments_of(rows: DataFrame) -> DataFrame:
        named = rows.select(F.col(key).alias("_key"), *[c for c in rows.columns if c in ("visits", "_low")])
        return segments.join(named, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")

    near = materialise(first_below(segments, F.sequence(F.lit(1).cast("bigint"), F.lit(each_step).cast("bigint"))))
    found = near.filter("visits IS NOT NULL OR _known = 0").select(key, "visits")
    far = near.filter("visits IS NULL AND _known > 0").select(key)
    if far.limit(1).count():
        doubled = F.array(*[F.lit(each_step * 2**k).cast("bigint") for k in range(60) if each_step * 2**k <= 2**50])
        held = materialise(first_below(segments_of(far), doubled).select(
            key, "visits", F.greatest(F.floor(F.col("visits") / 2), F.lit(each_step)).alias("_low")))
        if held.filter("visits IS NULL").limit(1).count():
            raise ValueError("the incremental return of a segment never falls below 1")
        while held.filter("visits > _low + 1").limit(1).count():
            width = F.greatest(F.lit(1).cast("bigint"), F.floor((F.col("visits") - F.col("_low")) / 64))
            inner = segments_of(held).withColumn("_high", F.col("visits"))
            steps = inner.withColumn("n", F.explode(F.sequence(F.col("_low") + width, F.col("_high"), width))).withColumn("_inc", inc)
            cut = steps.groupBy(key, "_low", "_high").agg(F.min(F.when(F.col("_inc") < 1, F.col("n"))).alias("_first"))
            high, step = F.coalesce("_first", "_high"), F.greatest(
                F.lit(1).cast("bigint"), F.floor((F.col("_high") - F.col("_low")) / 64))
            held = materialise(cut.select(key, high.alias("visits"), F.greatest(F.col("_low"), high - step).alias("_low")))
        found = found.union(held.select(key, "visits"))
    return found.select(key, (F.col("visits") - 1).alias("step"), "visits")


def visit_curve(
    segments: DataFrame, key: str, response: Callable[[Column], Column], coefficient: str = "coefficient",
    margin: str = "margin", cost: str = "cost", max_visits: int = 12,
) -> DataFrame:
    """Contribution, return and incremental return for 1..max_visits visits."""
    n = F.col("visits").cast("double")
    steps = segments.withColumn("visits", F.explode(F.sequence(F.lit(1), F.lit(max_visits))))
    steps = steps.withColumn("contribution", response(n) * F.col(coefficient))
    previous = F.lag("contribution").over(Window.partitionBy(key).orderBy("visits"))
    return steps.select(
        key, "visits", "contribution",
        divide(F.col("contribution") * F.col(margin), F.col(cost) * n).alias("roi"),
        divide((F.col("contribution") - previous) * F.col(margin), cost).alias("incremental_roi"),
    )
