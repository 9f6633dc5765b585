"""Exploratory tables: correlation, information value, distributions, time series."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.numeric import all_of, divide, half_even, pearson, total
from tillwork.operators.clean import columns_of_type
from tillwork.operators.ordered import quantile_row, quantile_table, top_per_key
from tillwork.session import attach_row


# ---- correlation -----------------------------------------------------------

def pair_statistics(df: DataFrame, pairs: Sequence[tuple[str, str]], statistic=pearson, name: str = "corr") -> DataFrame:
    """Long ``(x, y, <name>)`` for column pairs, pairwise complete, in one aggregate."""
    def one(x, y):
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        value = statistic(F.when(both, F.col(x).cast("double")), F.when(both, F.col(y).cast("double")))
        return F.when(F.isnan(value), None).otherwise(value)

    row = df.agg(*[one(x, y).alias(f"_{i}") for i, (x, y) in enumerate(pairs)])
    parts = [F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"_{i}").alias(name))
             for i, (x, y) in enumerate(pairs)]
    return row.select(F.inline(F.array(*parts)))


def idv_dv_correlation(df: DataFrame, idv: Sequence[str], dv: Sequence[str]) -> DataFrame:
    """Pearson correlation of every independent with every dependent variable."""
    return pair_statistics(df, [(x, y) for x in idv for y in dv if x != y])


def correlation_table(df: DataFrame, columns: Sequence[str] | None = None, above: float | None = None) -> DataFrame:
    """All column pairs with their correlation and its absolute value."""
    names = list(columns or columns_of_type(df, "number"))
    table = pair_statistics(df, list(combinations(names, 2))).withColumn("abs_corr", F.abs("corr"))
    return table.filter(F.col("abs_corr") > above) if above is not None else table


def covariance_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns or columns_of_type(df, "number"))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    return pair_statistics(df, pairs, F.covar_samp, "cov")


def correlated_with_earlier(df: DataFrame, threshold: float, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns correlated above the threshold with a column before them."""
    return correlation_table(df, columns, threshold).select(F.col("y").alias("column")).distinct()


def decorrelate(df: DataFrame, threshold: float = 0.75, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop columns correlated above the threshold with a column after them.

    This rule picks the other member of a pair than ``correlated_with_earlier``;
    both exist in the surveyed flows and are kept apart by name.
    """
    found = correlation_table(df, columns, threshold).select("x").distinct().collect()
    return df.drop(*[r["x"] for r in found])


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """The p x p matrix over complete rows, from one aggregate (p is a column count)."""
    names = list(columns)
    rows = df.filter(all_of([F.col(c).isNotNull() for c in names]))
    values = pair_statistics(rows, list(combinations(names, 2))).collect()
    at = {c: i for i, c in enumerate(names)}
    matrix = np.eye(len(names))
    for r in values:
        v = np.nan if r["corr"] is None else r["corr"]
        matrix[at[r["x"]], at[r["y"]]] = matrix[at[r["y"]], at[r["x"]]] = v
    return matrix


def vif_values(matrix: np.ndarray) -> np.ndarray:
    """Variance inflation factors: the diagonal of the inverse correlation matrix."""
    return np.diag(np.linalg.inv(matrix)) if len(matrix) > 1 else np.ones(len(matrix))


def vif(df: DataFrame, idv: Sequence[str], dv: str, digits: int = 2) -> DataFrame:
    """VIF of each independent variable and its correlation with the target, rounded half to even."""
    names = list(idv)
    matrix = correlation_matrix(df, [*names, dv])
    factors = vif_values(matrix[:-1, :-1])
    rows = [(c, float(factors[i]), float(matrix[i, -1])) for i, c in enumerate(names)]
    table = df.sparkSession.createDataFrame(rows, "variable string, vif double, corr_dv double")
    return table.select("variable", half_even("vif", digits).alias("vif"), half_even("corr_dv", digits).alias("corr_dv"))


def vif_prune(df: DataFrame, columns: Sequence[str], limit: float = 15.0) -> tuple[list[str], DataFrame]:
    """Drop the column of largest VIF until all are within the limit.

    The correlation matrix is computed once; each step only inverts a smaller
    sub-matrix of it.  Returns the kept names and a log of the steps.
    """
    names, log = list(columns), []
    matrix = correlation_matrix(df, names)
    keep = list(range(len(names)))
    while len(keep) > 1:
        sub = matrix[np.ix_(keep, keep)]
        factors = vif_values(sub) if np.linalg.cond(sub) < 1e12 else np.full(len(keep), np.inf)
        worst = int(np.argmax(factors))
        if factors[worst] <= limit:
            break
        log.append((len(log) + 1, names[keep[worst]], float(factors[worst])))
        del keep[worst]
    final = vif_values(matrix[np.ix_(keep, keep)])
    log += [(0, names[k], float(v)) for k, v in zip(keep, final)]
    table = df.sparkSession.createDataFrame(log, "dropped_at int, variable string, vif double")
    return [names[k] for k in keep], table


# ---- categorical against target --------------------------------------------

def woe_table(df: DataFrame, feature: str, target: str) -> DataFrame:
    """Per level: counts by class, weight of evidence and information value.

    Levels that miss a class have no weight (NULL) and add nothing.
    """
    zero, one = F.count(F.when(F.col(target) == 0, 1)), F.count(F.when(F.col(target) == 1, 1))
    levels = df.filter(F.col(feature).isNotNull()).groupBy(feature).agg(zero.alias("n0"), one.alias("n1"))
    totals = df.filter(F.col(feature).isNotNull()).agg(zero.alias("_t0"), one.alias("_t1"))
    p0, p1 = divide("n0", "_t0"), divide("n1", "_t1")
    woe = F.when((F.col("n0") > 0) & (F.col("n1") > 0), F.ln(divide(p0, p1)))
    scored = attach_row(levels, totals).withColumns({"woe": woe, "iv": (p0 - p1) * woe})
    return scored.drop("_t0", "_t1")


def information_value(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Total information value per feature; all features in one pass over the long table."""
    names = list(features)
    long = df.select(target, *[F.col(c).cast("string").alias(c) for c in names]).unpivot(
        [F.col(target)], [F.col(c) for c in names], "feature", "level").filter(F.col("level").isNotNull())
    zero, one = F.count(F.when(F.col(target) == 0, 1)), F.count(F.when(F.col(target) == 1, 1))
    levels = long.groupBy("feature", "level").agg(zero.alias("n0"), one.alias("n1"))
    totals = levels.groupBy("feature").agg(F.sum("n0").alias("_t0"), F.sum("n1").alias("_t1"))
    p0, p1 = divide("n0", "_t0"), divide("n1", "_t1")
    part = F.when((F.col("n0") > 0) & (F.col("n1") > 0), (p0 - p1) * F.ln(divide(p0, p1)))
    return levels.join(totals, "feature").groupBy("feature").agg(F.sum(part).alias("iv"))


def correlation_ratio(df: DataFrame, category: str, value: str) -> DataFrame:
    """Correlation ratio eta; rows with a NULL category or value are left out on both sides."""
    rows = df.filter(F.col(category).isNotNull() & F.col(value).isNotNull())
    groups = rows.groupBy(category).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v"))
    grand = groups.agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("_grand"))
    between = F.sum(F.col("n") * F.pow(F.col("m") - F.col("_grand"), 2))
    within = F.sum(F.col("n") * F.col("v"))
    eta = F.when(between == 0, F.lit(0.0)).otherwise(F.sqrt(divide(between, between + within)))
    return attach_row(groups, grand).agg(eta.alias("eta"))


def entropy(counts: Sequence[Column]) -> Column:
    """Entropy in nats of class counts."""
    n = total([c.cast("double") for c in counts])
    parts = []
    for c in counts:
        p = divide(c, n)
        parts.append(F.when(c > 0, -p * F.ln(p)).otherwise(F.lit(0.0)))
    return total(parts)


def quantile_bin(column: str, edges: Sequence[Column]) -> Column:
    """Right-closed bin 1..n of a value between ascending edges; the lowest edge is in bin 1."""
    inner = list(edges)[1:-1]
    return F.when(F.col(column).isNotNull(),
                  F.lit(1) + sum(((F.col(column) > e).cast("int") for e in inner), F.lit(0)))


def with_quantile_bins(df: DataFrame, columns: Sequence[str], bins: int, prefix: str = "bin_") -> DataFrame:
    """Add ``bin_<column>`` by exact quantile edges of the whole column."""
    probs = [i / bins for i in range(bins + 1)]
    edges = quantile_row(df, columns, probs)
    joined = attach_row(df, edges)
    out = joined.withColumns({
        f"{prefix}{c}": quantile_bin(c, [F.col(f"{c}_q{i}") for i in range(bins + 1)]) for c in columns})
    return out.select(*df.columns, *[f"{prefix}{c}" for c in columns])


def information_gain(df: DataFrame, numeric: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """Information gain of a binary target from each numeric feature in quantile bins."""
    names = list(numeric)
    binned = with_quantile_bins(df.select(target, *names), names, bins)
    long = binned.unpivot([F.col(target)], [F.col(f"bin_{c}") for c in names], "feature", "bin")
    zero, one = F.count(F.when(F.col(target) == 0, 1)), F.count(F.when(F.col(target) == 1, 1))
    cells = long.filter(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(zero.alias("n0"), one.alias("n1"))
    weight = (F.col("n0") + F.col("n1")) * entropy([F.col("n0"), F.col("n1")])
    table = cells.groupBy("feature").agg(
        F.sum("n0").alias("t0"), F.sum("n1").alias("t1"), F.sum(weight).alias("inner"))
    gain = entropy([F.col("t0"), F.col("t1")]) - divide("inner", F.col("t0") + F.col("t1"))
    return table.select(F.regexp_replace("feature", "^bin_", "").alias("feature"), gain.alias("info_gain"))


def index_table(df: DataFrame, level: str, elements: dict[str, Column]) -> DataFrame:
    """Share of each element in a level over the share of the level, times 100, rounded."""
    counts = df.filter(F.col(level).isNotNull()).groupBy(level).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count(F.when(e, 1)).alias(k) for k, e in elements.items()])
    totals = counts.agg(F.sum("_n").alias("_all"), *[F.sum(k).alias(f"_t{i}") for i, k in enumerate(elements)])
    joined = attach_row(counts, totals)
    share = divide("_n", "_all")
    return joined.select(level, *[
        half_even(divide(divide(k, f"_t{i}"), share) * 100, 0).alias(k) for i, k in enumerate(elements)])


def confusion_flags(actual: str, predicted: str) -> dict[str, Column]:
    a, p = F.col(actual), F.col(predicted)
    return {"TN": (a == 0) & (p == 0), "TP": (a == 1) & (p == 1), "FN": (a == 1) & (p == 0), "FP": (a == 0) & (p == 1)}


def confusion_by_feature(df: DataFrame, actual: str, predicted: str, feature: str) -> DataFrame:
    return index_table(df, feature, confusion_flags(actual, predicted))


def residual_by_feature(df: DataFrame, feature: str, flag: str) -> DataFrame:
    levels = ("good", "over predict", "under predict")
    return index_table(df, feature, {x: F.col(flag) == x for x in levels})


# ---- distributions ---------------------------------------------------------

def equal_width_bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin 1..bins between the extremes; the maximum falls into the last bin."""
    raw = F.floor(divide(x - low, high - low) * bins) + 1
    return F.least(F.coalesce(raw, F.when(x.isNotNull(), F.lit(1))), F.lit(bins)).cast("int")


def density_table(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Histogram per column with mean, median and sd on every row."""
    names = list(columns)
    data = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    stats = data.agg(*[e for c in names for e in (
        F.avg(c).alias(f"_mean_{c}"), F.stddev_samp(c).alias(f"_sd_{c}"),
        F.min(c).alias(f"_min_{c}"), F.max(c).alias(f"_max_{c}"))]).crossJoin(quantile_row(data, names, [0.5]))
    entries = [F.struct(
        F.lit(c).alias("column"), F.col(c).alias("x"), F.col(f"_mean_{c}").alias("mean"),
        F.col(f"{c}_q0").alias("median"), F.col(f"_sd_{c}").alias("sd"),
        F.col(f"_min_{c}").alias("low"), F.col(f"_max_{c}").alias("high")) for c in names]
    long = attach_row(data, stats).select(F.inline(F.array(*entries))).filter(F.col("x").isNotNull())
    long = long.withColumn("bin", equal_width_bin(F.col("x"), F.col("low"), F.col("high"), bins))
    return long.groupBy("column", "bin").agg(
        F.count(F.lit(1)).alias("n"), *[F.max(k).alias(k) for k in ("mean", "median", "sd", "low", "high")])


# The percentile points of the tail tables.
BOTTOM_PERCENTILES = (0.2, 0.4, 0.6, 0.8, 1.0)
TOP_PERCENTILES = (99.0, 99.2, 99.4, 99.6, 99.8)


def percentile_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long ``(column, metric, value)``: mean, sd, min, median, max and both tails."""
    names = list(columns)
    points = [50.0, *BOTTOM_PERCENTILES, *TOP_PERCENTILES]
    labels = ["median", *[f"p{p:g}" for p in points[1:]]]
    tails = quantile_table(df, names, [p / 100 for p in points]).select(
        "column", F.posexplode("q").alias("_i", "value"))
    label = F.element_at(F.array(*map(F.lit, labels)), F.col("_i") + 1)
    tails = tails.select("column", label.alias("metric"), "value")
    moments = {"mean": F.avg, "sd": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(*[fn(F.col(c).cast("double")).alias(f"_{m}_{i}") for i, c in enumerate(names) for m, fn in moments.items()])
    parts = [F.struct(F.lit(c).alias("column"), F.lit(m).alias("metric"), F.col(f"_{m}_{i}").alias("value"))
             for i, c in enumerate(names) for m in moments]
    return row.select(F.inline(F.array(*parts))).unionByName(tails)


def frequency_top(df: DataFrame, columns: Sequence[str] | None = None, n: int = 10) -> DataFrame:
    """The ``n`` most frequent levels per non-numeric column, ties by value."""
    names = list(columns or columns_of_type(df, "non_number"))
    long = df.select(*[F.col(c).cast("string").alias(c) for c in names]).unpivot(
        [], [F.col(c) for c in names], "column", "value").filter(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return top_per_key(counts, ["column"], [F.desc("n"), F.col("value")], n, rank="rank")


def bivariate_counts(df: DataFrame, x: str, y: str) -> DataFrame:
    """Counts of two categorical columns with the share of each pair within x."""
    counts = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(x).agg(F.sum("n").alias("_t"))
    return counts.join(totals, x).select(x, y, "n", divide("n", "_t").alias("share"))


def bivariate_box(df: DataFrame, category: str, value: str) -> DataFrame:
    """Five-number summary, mean and count of a numeric column per category."""
    rows = df.filter(F.col(category).isNotNull())
    box = quantile_table(rows, [value], [0, 0.25, 0.5, 0.75, 1], by=[category])
    mean = rows.groupBy(category).agg(F.count(value).alias("n"), F.avg(value).alias("mean"))
    names = ("min", "q1", "median", "q3", "max")
    return box.select(category, *[F.col("q")[i].alias(k) for i, k in enumerate(names)]).join(mean, category)


def bivariate_grid(df: DataFrame, x: str, y: str, bins: int = 10) -> DataFrame:
    """Binned scatter of two numeric columns."""
    rows = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).dropna()
    ends = rows.agg(*[f(c).alias(f"{k}{c}") for c in ("_x", "_y") for k, f in (("lo", F.min), ("hi", F.max))])
    cells = attach_row(rows, ends).select(
        equal_width_bin(F.col("_x"), F.col("lo_x"), F.col("hi_x"), bins).alias("bin_x"),
        equal_width_bin(F.col("_y"), F.col("lo_y"), F.col("hi_y"), bins).alias("bin_y"))
    return cells.groupBy("bin_x", "bin_y").agg(F.count(F.lit(1)).alias("n"))


def butterfly(df: DataFrame, category: str, target: str) -> DataFrame:
    """Share of each level within the two classes of a binary target."""
    counts = df.filter(F.col(category).isNotNull()).groupBy(category).agg(
        F.count(F.when(F.col(target) == 0, 1)).alias("n0"), F.count(F.when(F.col(target) == 1, 1)).alias("n1"))
    totals = counts.agg(F.sum("n0").alias("_t0"), F.sum("n1").alias("_t1"))
    return attach_row(counts, totals).select(
        category, "n0", "n1", divide("n0", "_t0").alias("share0"), divide("n1", "_t1").alias("share1"))


def class_histogram(df: DataFrame, value: str, target: str, bins: int = 10) -> DataFrame:
    """Bin counts of a numeric column for each class."""
    rows = df.select(F.col(value).cast("double").alias("_x"), target).dropna()
    ends = rows.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    binned = attach_row(rows, ends).withColumn("bin", equal_width_bin(F.col("_x"), F.col("_lo"), F.col("_hi"), bins))
    return binned.groupBy("bin", target).agg(F.count(F.lit(1)).alias("n"))


def normality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Skewness, excess kurtosis and the Jarque-Bera statistic per column."""
    names = list(columns)
    row = df.agg(*[e for i, c in enumerate(names) for e in (
        F.count(c).alias(f"_n{i}"), F.skewness(c).alias(f"_s{i}"), F.kurtosis(c).alias(f"_k{i}"))])
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("n"), F.col(f"_s{i}").alias("skewness"),
                      F.col(f"_k{i}").alias("kurtosis")) for i, c in enumerate(names)]
    table = row.select(F.inline(F.array(*parts)))
    jb = F.col("n") / 6 * (F.pow("skewness", 2) + F.pow("kurtosis", 2) / 4)
    return table.withColumn("jarque_bera", jb)


def segmented_summary(df: DataFrame, segment: str, columns: Sequence[str]) -> DataFrame:
    """Count, missing, mean, sd and quartiles of each column per segment."""
    names = list(columns)
    rows = df.filter(F.col(segment).isNotNull())
    moments = rows.groupBy(segment).agg(F.count(F.lit(1)).alias("_n"), *[e for i, c in enumerate(names) for e in (
        F.count(c).alias(f"_c{i}"), F.avg(c).alias(f"_m{i}"), F.stddev_samp(c).alias(f"_s{i}"))])
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"_c{i}").alias("n"),
                      (F.col("_n") - F.col(f"_c{i}")).alias("n_missing"),
                      F.col(f"_m{i}").alias("mean"), F.col(f"_s{i}").alias("sd")) for i, c in enumerate(names)]
    moments = moments.select(segment, F.inline(F.array(*parts)))
    box = quantile_table(rows, names, [0.25, 0.5, 0.75], by=[segment])
    box = box.select(segment, "column", *[F.col("q")[i].alias(k) for i, k in enumerate(("q1", "median", "q3"))])
    return moments.join(box, [segment, "column"])


# ---- time series -----------------------------------------------------------

def series_summary(df: DataFrame, time: str, value: str, by: Sequence[str], period: str = "day") -> DataFrame:
    """Rows, total and mean per period and identifier."""
    return df.groupBy(*by, F.date_trunc(period, time).alias("period")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"))


def series_gaps(df: DataFrame, time: str, by: Sequence[str], step: str = "1 day") -> DataFrame:
    """Periods between an identifier's first and last that have no row.

    Works on the distinct periods of an identifier, so the work per
    identifier is bounded by the calendar and not by its rows.
    """
    unit = step.split()[1]
    days = df.filter(F.col(time).isNotNull()).groupBy(*by, F.date_trunc(unit, time).alias("period")).agg(F.lit(1))
    spans = days.groupBy(*by).agg(F.min("period").alias("_lo"), F.max("period").alias("_hi"),
                                  F.collect_set("period").alias("_have"))
    every = F.sequence("_lo", "_hi", F.expr(f"interval {step}"))
    return spans.select(*by, F.explode(F.array_except(every, "_have")).alias("gap"))
