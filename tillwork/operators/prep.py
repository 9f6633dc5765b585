"""Outliers, imputation, scaling, encoding and response curves."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.numeric import any_of, divide, saturation
from tillwork.operators.clean import columns_of_type
from tillwork.operators.eda import quantile_bin, woe_table
from tillwork.operators.joins import join_dimension
from tillwork.operators.ordered import quantile_row
from tillwork.operators.quality import missing_proportions
from tillwork.operators.split import quantile_edges
from tillwork.operators.timeseries import fill_backward, fill_forward, interpolate
from tillwork.session import attach_row, small_side

# ---- outliers --------------------------------------------------------------


def outlier_bounds(df: DataFrame, columns: Sequence[str], method: str = "iqr", low: float = 0.01, high: float = 0.99) -> DataFrame:
    """One row of ``<column>_lo`` / ``<column>_hi``.

    ``iqr``: quartiles -/+ 1.5 IQR; ``zscore`` and ``mean``: mean -/+ 3 sample
    sd; ``percentile``: the given quantiles.
    """
    if method == "iqr":
        row = quantile_row(df, columns, [0.25, 0.75])
        spread = {c: F.col(f"{c}_q1") - F.col(f"{c}_q0") for c in columns}
        return row.select(*[e for c in columns for e in (
            (F.col(f"{c}_q0") - 1.5 * spread[c]).alias(f"{c}_lo"), (F.col(f"{c}_q1") + 1.5 * spread[c]).alias(f"{c}_hi"))])
    if method in ("zscore", "mean"):
        return df.agg(*[e for c in columns for e in (
            (F.avg(c) - 3 * F.stddev_samp(c)).alias(f"{c}_lo"), (F.avg(c) + 3 * F.stddev_samp(c)).alias(f"{c}_hi"))])
    if method == "percentile":
        row = quantile_row(df, columns, [low, high])
        return row.select(*[e for c in columns for e in (
            F.col(f"{c}_q0").alias(f"{c}_lo"), F.col(f"{c}_q1").alias(f"{c}_hi"))])
    raise ValueError("method is 'iqr', 'zscore', 'mean' or 'percentile'")


def apply_bounds(df: DataFrame, bounds: DataFrame, columns: Sequence[str], direction: int = 0, treatment: str | None = None) -> DataFrame:
    """Show, ``remove`` or ``cap`` values beyond one row of bounds.

    ``direction`` is 0 for both sides, 1 for high, -1 for low values.  A NULL
    is never an outlier; without a treatment the rows with any outlier remain.
    """
    rows = attach_row(df, bounds)

    def beyond(c: str) -> Column:
        tests = []
        if direction <= 0:
            tests.append(F.col(c) < F.col(f"{c}_lo"))
        if direction >= 0:
            tests.append(F.col(c) > F.col(f"{c}_hi"))
        return F.coalesce(any_of(tests), F.lit(False))

    if treatment == "cap":
        def capped(c: str) -> Column:
            x = F.col(c).cast("double")
            if direction <= 0:
                x = F.when(x < F.col(f"{c}_lo"), F.col(f"{c}_lo")).otherwise(x)
            if direction >= 0:
                x = F.when(F.col(c) > F.col(f"{c}_hi"), F.col(f"{c}_hi")).otherwise(x)
            return x

        return rows.withColumns({c: capped(c) for c in columns}).select(*df.columns)
    found = any_of([beyond(c) for c in columns])
    if treatment not in (None, "remove"):
        raise ValueError("treatment is None, 'remove' or 'cap'")
    return rows.filter(~found if treatment == "remove" else found).select(*df.columns)


def treat_outliers(
    df: DataFrame, columns: Sequence[str], direction: int = 0, method: str = "iqr", treatment: str | None = None
) -> DataFrame:
    return apply_bounds(df, outlier_bounds(df, columns, method), columns, direction, treatment)


@dataclass
class OutlierModel:
    """Bounds learnt on one frame and applied to others; the bounds are a one-row table."""

    columns: Sequence[str]
    method: str = "mean"
    low: float = 0.01
    high: float = 0.99
    bounds: DataFrame | None = field(default=None, repr=False)

    def fit(self, df: DataFrame) -> "OutlierModel":
        self.bounds = outlier_bounds(df, self.columns, self.method, self.low, self.high)
        return self

    def transform(self, df: DataFrame, drop: bool = False) -> DataFrame:
        return apply_bounds(df, self.bounds, self.columns, 0, "remove" if drop else "cap")


def trim_top(df: DataFrame, column: str, share: float = 0.95) -> DataFrame:
    """Rows below the given quantile of a column."""
    rows = attach_row(df, quantile_row(df, [column], [share]))
    return rows.filter(F.col(column) < F.col(f"{column}_q0")).select(*df.columns)


# ---- imputation ------------------------------------------------------------

def mode_row(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the most frequent value of each column, ties to the smallest.

    Values are counted by a grouping, so no task holds the counts of a whole column.
    """
    row = None
    for c in columns:
        counts = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        best = counts.agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col("_v").alias("v")))["v"].alias(c))
        row = best if row is None else row.crossJoin(best)
    return row


def fill_values(df: DataFrame, columns: Sequence[str], method: str, value=None) -> DataFrame | None:
    """One row of replacement values for ``mean``, ``median``, ``most_frequent`` or ``constant``."""
    if method == "mean":
        return df.agg(*[F.avg(c).alias(c) for c in columns])
    if method == "median":
        return quantile_row(df, columns, [0.5]).select(*[F.col(f"{c}_q0").alias(c) for c in columns])
    if method == "most_frequent":
        return mode_row(df, columns)
    values = value if isinstance(value, dict) else {c: value for c in columns}
    return df.sparkSession.range(1).select(*[F.lit(values[c]).alias(c) for c in columns if c in values])


def fill_from_row(df: DataFrame, row: DataFrame) -> DataFrame:
    names = [c for c in row.columns if c in df.columns]
    joined = attach_row(df, row.select(*[F.col(c).alias(f"_fill_{c}") for c in names]))
    return joined.select(*[
        F.coalesce(F.col(c), F.col(f"_fill_{c}")).alias(c) if c in names else F.col(c) for c in df.columns])


def impute(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "mean", value=None,
    date_col: str | None = None, group_cols: Sequence[str] = (),
) -> DataFrame:
    """Fill missing values: mean, median, most_frequent, constant, ffill, bfill or custom (interpolation).

    Without ``columns`` all numeric columns are treated.  The ordered methods
    need ``date_col``.
    """
    names = list(columns) if columns is not None else columns_of_type(df, "number")
    ordered = {"ffill": fill_forward, "bfill": fill_backward, "custom": interpolate}
    if method in ordered:
        if date_col is None:
            raise ValueError(f"{method} needs the date column that orders the rows")
        return ordered[method](df, names, date_col, group_cols)
    if method not in ("mean", "median", "most_frequent", "constant"):
        raise ValueError(f"unknown method {method!r}")
    return fill_from_row(df, fill_values(df, names, method, value))


def impute_by_method(
    df: DataFrame, methods: dict[str, Sequence[str]], values: dict | None = None, date_col: str | None = None,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Fill several sets of columns in one call: ``{method: columns}``, with ``values`` for the constant method.

    Every method sees the columns as they came; a column named twice is an error.
    """
    named = [c for columns in methods.values() for c in columns]
    if len(named) != len(set(named)):
        raise ValueError("a column is given to more than one method")
    for method, columns in methods.items():
        df = impute(df, list(columns), method, values, date_col, group_cols)
    return df


def impute_with_threshold(df: DataFrame, threshold: float = 0.2, method: str = "mean") -> DataFrame:
    """Drop columns with a larger missing share, impute the numeric rest where it has holes."""
    shares = {r["column"]: r["missing_share"] for r in missing_proportions(df).collect()}
    kept = df.drop(*[c for c, share in shares.items() if share > threshold])
    return impute(kept, [c for c in columns_of_type(kept, "number") if shares[c] > 0], method)


# ---- scaling ---------------------------------------------------------------

def scale_columns(df: DataFrame, columns: Sequence[str], strategy: str, flag_col: str, train: str = "train", test: str = "test") -> DataFrame:
    """Scale by statistics of the train rows; rows of neither flag are dropped.

    ``custom`` divides by the maximum, ``minmax`` and ``standard`` are as
    named (population sd); a zero scale counts as 1.  All columns are kept,
    where the surveyed ``custom`` strategy returns only the scaled ones.
    """
    on_train = {c: F.when(F.col(flag_col) == train, F.col(c).cast("double")) for c in columns}
    needed = {"custom": (("hi", F.max),), "minmax": (("lo", F.min), ("hi", F.max)),
              "standard": (("m", F.avg), ("s", F.stddev_pop))}
    if strategy not in needed:
        raise ValueError("strategy is 'custom', 'minmax' or 'standard'")
    stats = df.agg(*[fn(on_train[c]).alias(f"_{k}_{c}") for c in columns for k, fn in needed[strategy]])

    def unit(scale: Column) -> Column:
        return F.when(scale == 0, F.lit(1.0)).otherwise(scale)

    def scaled(c: str) -> Column:
        x = F.col(c).cast("double")
        if strategy == "custom":
            return divide(x, f"_hi_{c}")
        if strategy == "minmax":
            return (x - F.col(f"_lo_{c}")) / unit(F.col(f"_hi_{c}") - F.col(f"_lo_{c}"))
        return (x - F.col(f"_m_{c}")) / unit(F.col(f"_s_{c}"))

    rows = attach_row(df.filter(F.col(flag_col).isin(train, test)), stats)
    return rows.withColumns({c: scaled(c) for c in columns}).select(*df.columns)


# ---- encoding --------------------------------------------------------------

def target_means(df: DataFrame, category: str, target: str) -> DataFrame:
    """Smoothed target mean per category: ``prior (1 - s) + mean s`` with ``s = 1 / (1 + exp(1 - n))``.

    A category seen once takes the prior.
    """
    groups = df.filter(F.col(category).isNotNull()).groupBy(category).agg(
        F.count(target).alias("_n"), F.avg(target).alias("_mean"))
    joined = attach_row(groups, df.agg(F.avg(target).alias("_prior")))
    s = 1 / (1 + F.exp(-(F.col("_n") - 1.0)))
    value = F.when(F.col("_n") <= 1, F.col("_prior")).otherwise(F.col("_prior") * (1 - s) + F.col("_mean") * s)
    return joined.select(category, value.alias("encoded"), "_prior")


@dataclass
class TargetEncoder:
    """Smoothed target means per category column; unseen and NULL categories take the prior."""

    columns: Sequence[str]
    target: str
    tables: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    prior: DataFrame | None = field(default=None, repr=False)

    def fit(self, df: DataFrame) -> "TargetEncoder":
        self.tables = {c: small_side(target_means(df, c, self.target).drop("_prior")) for c in self.columns}
        self.prior = df.agg(F.avg(self.target).alias("_prior"))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = attach_row(df, self.prior)
        for c in self.columns:
            out = join_dimension(out, self.tables[c], [(c, c)], "left").withColumn(
                c if c not in df.columns else f"_enc_{c}", F.coalesce("encoded", "_prior")).drop("encoded")
        return out.select(*[F.col(f"_enc_{c}").alias(c) if c in self.columns else F.col(c) for c in df.columns])


@dataclass
class FeatureTable:
    """Encode categories, fill encoded and numeric columns with train medians; fit once, apply anywhere."""

    categories: Sequence[str]
    numbers: Sequence[str]
    target: str
    encoder: TargetEncoder | None = None
    medians: DataFrame | None = field(default=None, repr=False)

    def fit(self, df: DataFrame) -> "FeatureTable":
        self.encoder = TargetEncoder(self.categories, self.target).fit(df)
        self.medians = fill_values(df, self.numbers, "median")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return fill_from_row(self.encoder.transform(df), self.medians)


def one_hot(df: DataFrame, column: str, levels: Sequence) -> DataFrame:
    """0/1 column per fixed level."""
    return df.withColumns({f"{column}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in levels})


@dataclass
class WoeEncoder:
    """Weight-of-evidence encoding of quantile bins of numeric columns against a binary target.

    Learnt bins are driver-side edges (one short list per column) and a table
    of one row per bin.  Bins that miss a class encode as 0.
    """

    columns: Sequence[str]
    target: str
    bins: int = 5
    edges: dict[str, list[float]] = field(default_factory=dict)
    weights: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def _binned(self, df: DataFrame, c: str) -> DataFrame:
        return df.withColumn("_bin", quantile_bin(c, [F.lit(e) for e in self.edges[c]]))

    def fit(self, df: DataFrame) -> "WoeEncoder":
        for c in self.columns:
            self.edges[c] = quantile_edges(df, c, self.bins)
            self.weights[c] = small_side(woe_table(self._binned(df, c), "_bin", self.target).select("_bin", "woe"))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c in self.columns:
            out = join_dimension(self._binned(out, c), self.weights[c], [("_bin", "_bin")], "left")
            out = out.withColumn(f"{c}_woe", F.coalesce("woe", F.lit(0.0))).drop("_bin", "woe")
        return out


def select_features(df: DataFrame, features: Sequence[str], target: str, top: int, continuous_target: bool = True) -> list[str]:
    """The ``top`` numeric features by univariate test, with Spark's own selector."""
    from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler

    rows = df.select(*features, target).dropna()
    packed = VectorAssembler(inputCols=list(features), outputCol="_x").transform(rows)
    selector = UnivariateFeatureSelector(featuresCol="_x", labelCol=target, outputCol="_s", selectionMode="numTopFeatures")
    selector = selector.setFeatureType("continuous").setLabelType("continuous" if continuous_target else "categorical")
    model = selector.setSelectionThreshold(top).fit(packed)
    return [features[i] for i in model.selectedFeatures]


# ---- response curves -------------------------------------------------------

def s_curves(
    df: DataFrame, date_col: str, alphas: Sequence[float], betas: Sequence[float], group_cols: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``{col}_alpha{i}_beta{j}`` for every parameter pair; one projection, no grouping needed."""
    names = list(columns) if columns is not None else [c for c in df.columns if c not in {date_col, *group_cols}]
    curves = [saturation(c, a, b).alias(f"{c}_alpha{i}_beta{j}")
              for i, a in enumerate(alphas) for j, b in enumerate(betas) for c in names]
    return df.select(*group_cols, date_col, *curves)


def s_curve_map(spark, alphas: Sequence[float], betas: Sequence[float]) -> DataFrame:
    """Parameter names and values used by ``s_curves``."""
    rows = [(f"alpha{i}", float(a)) for i, a in enumerate(alphas)] + [(f"beta{j}", float(b)) for j, b in enumerate(betas)]
    return spark.createDataFrame(rows, "Name string, Value double")
