"""Sales attribution: marketing-mix decomposition, ROAS, price attribution.

Models are data: coefficient tables of a few rows per group are joined to the
panel, and everything else is a projection of column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.dates import quarter_label
from tillwork.functions.numeric import divide, product, sum_or_zero, total
from tillwork.operators.prep import fill_values
from tillwork.operators.reshape import config_rows
from tillwork.session import attach_row, small_side


# ---- marketing-mix attribution ---------------------------------------------

def _with_model(
    data: DataFrame, coefficients: DataFrame, act_vs_preds: DataFrame, date_col: str, variables: Sequence[str]
) -> tuple[DataFrame, str]:
    """Panel rows with their group's coefficients and their actual and predicted values."""
    group = coefficients.columns[0]
    rows = data.select(date_col, group, *[F.col(c).cast("double").alias(c) for c in variables])
    rows = rows.join(small_side(coefficients), group, "left")
    return rows.join(act_vs_preds.select(date_col, group, "actuals", "preds"), [date_col, group], "left"), group


def additive_attribution(
    data: DataFrame, coefficients: DataFrame, act_vs_preds: DataFrame, date_col: str,
    marketing: Sequence[str], control: Sequence[str],
) -> DataFrame:
    """Contributions ``beta * x``, rescaled so that base plus contributions give the actual value."""
    names = [*marketing, *control]
    rows, group = _with_model(data, coefficients, act_vs_preds, date_col, names)
    ratio = divide(F.col("actuals") - F.col("Intercept"), F.col("preds") - F.col("Intercept"))
    return rows.select(date_col, group, F.col("Intercept").alias("base"), *[
        (F.col(f"beta_{c}") * F.col(c) * ratio).alias(f"ac_{c}") for c in names])


def multiplicative_attribution(
    data: DataFrame, coefficients: DataFrame, act_vs_preds: DataFrame, date_col: str,
    marketing: Sequence[str], control: Sequence[str],
) -> DataFrame:
    """Attribution of a log model; actuals and predictions are given as logarithms.

    The control and marketing parts of the prediction are each shared out in
    proportion to ``part * (1 - exp(-beta x))``.  A part without any effect
    has undefined shares, which are NULL.
    """
    names = [*marketing, *control]
    rows, group = _with_model(data, coefficients, act_vs_preds, date_col, names)
    effect = {c: F.col(f"_e_{c}") for c in names}
    rows = rows.withColumns({
        **{f"_e_{c}": F.exp(F.col(f"beta_{c}") * F.col(c)) for c in names},
        "actuals": F.exp("actuals"), "preds": F.exp("preds"),
    })
    rows = rows.withColumn("_control", product([effect[c] for c in control]) * F.col("e_intercept"))
    rows = rows.withColumn("_marketing", F.col("preds") - F.col("_control"))
    part = {**{c: F.col("_marketing") for c in marketing}, **{c: F.col("_control") for c in control}}
    rows = rows.withColumns({f"_r_{c}": part[c] * (1 - divide(F.lit(1.0), effect[c])) for c in names})
    sums = {**{c: total([F.col(f"_r_{k}") for k in marketing]) for c in marketing},
            **{c: total([F.col(f"_r_{k}") for k in control]) for c in control}}
    level = divide(F.col("actuals") - F.col("e_intercept"), "preds")
    return rows.select(date_col, group, F.col("e_intercept").alias("base"), *[
        (divide(F.col(f"_r_{c}") * part[c], sums[c]) * level).alias(f"ac_{c}") for c in names])


def _period(date_col: str, time_period: str) -> Column:
    if time_period not in ("quarter", "year"):
        raise ValueError("time_period is 'quarter' or 'year'")
    return quarter_label(date_col) if time_period == "quarter" else F.year(date_col).cast("string")


def _period_sums(df: DataFrame, period: Column, columns: Sequence[str], prefix: str, overall: bool) -> DataFrame:
    rows = df.select(period.alias("period"), *columns)
    grouped = rows.rollup("period") if overall else rows.groupBy("period")
    label = F.when(F.grouping_id() == 1, "Overall").otherwise(F.col("period")) if overall else F.col("period")
    sums = [sum_or_zero(c).alias(f"{prefix}{i}") for i, c in enumerate(columns)] + [F.count(F.lit(1)).alias(f"{prefix}_rows")]
    if not overall:
        return grouped.agg(*sums)
    return grouped.agg(label.alias("_label"), *sums).select(
        F.col("_label").alias("period"), f"{prefix}_rows", *[f"{prefix}{i}" for i in range(len(columns))])


def _by_period(data, attribution, time_period, mapping, date_col, overall):
    rows = config_rows(mapping)
    period = _period(date_col, time_period)
    spend = _period_sums(data, period, [r["variable_spend"] for r in rows], "s", overall)
    gain = _period_sums(attribution, period, [f"ac_{r['variable_name']}" for r in rows], "a", overall)
    # both sides hold one row per period of the calendar
    joined = spend.join(gain, "period", "full_outer")
    found = joined.collect()
    if any(r["s_rows"] != r["a_rows"] for r in found):
        raise ValueError("data and attribution differ in their number of rows")
    table = data.sparkSession.createDataFrame(found, joined.schema)
    return table, [r["variable_description"] for r in rows]


def roas(
    data: DataFrame, attribution: DataFrame, time_period: str, mapping: DataFrame, date_col: str
) -> DataFrame:
    """Return on spend per period and ``Overall``, one column per described variable.

    Both sides are joined by period, not divided by position.
    """
    joined, names = _by_period(data, attribution, time_period, mapping, date_col, True)
    return joined.select("period", *[divide(f"a{i}", f"s{i}").alias(n) for i, n in enumerate(names)])


def efficiency(
    data: DataFrame, attribution: DataFrame, time_period: str, mapping: DataFrame, date_col: str
) -> DataFrame:
    """Share of attribution over share of spend within each period."""
    joined, names = _by_period(data, attribution, time_period, mapping, date_col, False)
    gains, spends = (total([F.col(f"{k}{i}") for i in range(len(names))]) for k in ("a", "s"))
    return joined.select("period", *[
        divide(divide(f"a{i}", gains), divide(f"s{i}", spends)).alias(n) for i, n in enumerate(names)])


# ---- price attribution -----------------------------------------------------

BASELINE_ACTIONS = ("MEAN", "MEDIAN", "MODE", "MAX", "MIN", "AS IS")


def baseline_values(df: DataFrame, config: DataFrame, variables: Sequence[str]) -> DataFrame:
    """One row with the baseline ``_base_<variable>`` of each configured variable.

    An action is a statistic, a number, or blank for 0 (NULL counts as blank).
    ``AS IS`` and variables without an action have no baseline and no column.
    """
    actions = {r["Parameters"]: (r["Action"] or "").strip().upper() for r in config_rows(config)
               if r["Parameters"] in variables}
    moments = {"MEAN": F.avg, "MAX": F.max, "MIN": F.min}
    simple, medians, modes = [], [], []
    for name, action in actions.items():
        if action in moments:
            simple.append(moments[action](F.col(name).cast("double")).alias(f"_base_{name}"))
        elif action == "MEDIAN":
            medians.append(name)
        elif action == "MODE":
            modes.append(name)
        elif action != "AS IS":
            try:
                constant = float(action or 0)
            except ValueError:
                raise ValueError(f"unknown action {action!r} for {name!r}") from None
            simple.append(F.lit(constant).alias(f"_base_{name}"))
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *simple)
    for method, names in (("median", medians), ("most_frequent", modes)):
        if names:
            values = fill_values(df, names, method)
            row = row.crossJoin(values.select(*[F.col(c).cast("double").alias(f"_base_{c}") for c in names]))
    return row.drop("_rows")


def linear_predictor(
    df: DataFrame, coefficients: dict[str, float], intercept: float, random_intercepts: DataFrame | None = None,
    group: str | None = None, name: str = "linear_prediction", values: dict[str, Column] | None = None,
) -> DataFrame:
    """``intercept + sum(beta x)``, plus the group's random intercept for mixed models."""
    values = values or {}
    fixed = total([values.get(c, F.col(c)) * F.lit(float(b)) for c, b in coefficients.items()]) + F.lit(float(intercept))
    if random_intercepts is None:
        return df.withColumn(name, fixed)
    extra = random_intercepts.select(F.col("group_var").alias("_group"), F.col("beta").alias("_random"))
    joined = df.join(small_side(extra), F.col(group) == F.col("_group"), "left")
    return joined.withColumn(name, fixed + F.col("_random")).drop("_group", "_random")


def _spread_residual(raw: dict[str, Column], increment: Column) -> dict[str, Column]:
    """Share the unexplained part among the raw contributions in proportion to their size."""
    size = total([F.abs(r) for r in raw.values()])
    rest = increment - total(list(raw.values()))
    return {k: r + divide(F.abs(r), size) * rest for k, r in raw.items()}


def attribution_without_baseline(
    df: DataFrame, date_col: str, group: str, coefficients: dict[str, float], intercept: float,
    base_variables: Sequence[str], random_intercepts: DataFrame | None = None, intercept_name: str = "(Intercept)",
) -> DataFrame:
    """Split predicted sales into base and impact variables.

    Base variables telescope in configuration order from the intercept; impact
    variables take the rest.  The random intercept is in the prediction but
    not in the base, as in the surveyed flow.  Undefined shares are 0.
    """
    base = [c for c in base_variables if c in coefficients]
    impact = [c for c in coefficients if c not in base]
    rows = linear_predictor(df, coefficients, intercept, random_intercepts, group, "_p")
    term = {c: F.col(c) * F.lit(float(b)) for c, b in coefficients.items()}
    rows = rows.withColumns({
        "_b": total([term[c] for c in base]) + F.lit(float(intercept)),
        "_i": total([term[c] for c in impact]),
    })
    both = F.col("_b") + F.col("_i")
    rows = rows.withColumns({f"_raw_{c}": F.exp(both) - F.exp(both - term[c]) for c in impact})
    shared = _spread_residual({c: F.col(f"_raw_{c}") for c in impact}, F.exp("_p") - F.exp("_b"))
    out = {"Predicted_sales": F.exp("_p")}
    out.update({f"{c}_contribution_impact": v for c, v in shared.items()})
    running = F.lit(float(intercept))
    out[f"{intercept_name}_contribution_base"] = F.exp(running)
    for c in base:
        out[f"{c}_contribution_base"] = F.exp(running + term[c]) - F.exp(running)
        running = running + term[c]
    return rows.select(group, date_col, *[F.coalesce(v, F.lit(0.0)).alias(k) for k, v in out.items()])


def attribution_with_baseline(
    df: DataFrame, date_col: str, group: str, coefficients: dict[str, float], intercept: float, config: DataFrame,
    random_intercepts: DataFrame | None = None, intercept_name: str = "(Intercept)",
) -> DataFrame:
    """Attribution of sales against baseline values of the configured variables.

    ``AS IS`` and unlisted variables get no contribution.  Every group keeps
    its own rows; the surveyed code predicts each group on all rows and
    returns the last group only.
    """
    listed = {r["Parameters"]: (r["Action"] or "").strip().upper() for r in config_rows(config)}
    active = [c for c in coefficients if c in listed and listed[c] != "AS IS"]
    baselines = baseline_values(df, config, list(coefficients))
    rows = attach_row(df, baselines)
    at_base = {c: F.col(f"_base_{c}") for c in active}
    rows = linear_predictor(rows, coefficients, intercept, random_intercepts, group, "_p")
    rows = linear_predictor(rows, coefficients, intercept, random_intercepts, group, "_pb", at_base)

    def raw(c: str) -> Column:
        beta = F.lit(float(coefficients[c]))
        return F.exp("_p") - F.exp(F.col("_p") - F.col(c) * beta + at_base[c] * beta)

    rows = rows.withColumns({f"_raw_{c}": raw(c) for c in active})
    increment = F.exp("_p") - F.exp("_pb")
    shared = _spread_residual({c: F.col(f"_raw_{c}") for c in active}, increment)
    out = {"Predicted_sales": F.exp("_p"), "Predicted_baseline_sales": F.exp("_pb"),
           f"{intercept_name}_contribution_inc_base": F.lit(0.0)}
    out.update({f"{c}_contribution_inc_base": v for c, v in shared.items()})
    return rows.select(group, date_col, *[F.coalesce(v, F.lit(0.0)).alias(k) for k, v in out.items()])


def contribution_rollup(contributions: DataFrame, date_col: str, group: str, period: str = "day") -> DataFrame:
    """Long ``(group, period, model_coefficient_name, units, pct_units)`` by day, quarter or year.

    ``pct_units`` is the share of predicted sales.  Sums are taken wide, then
    laid out long, so each input row is read once whatever the number of variables.
    """
    d = F.col(date_col)
    label = {
        "day": F.date_format(d, "yyyy-MM-dd"),
        "quarter": quarter_label(d, "-Q"),
        "year": F.year(d).cast("string"),
    }[period]
    names = [c for c in contributions.columns if c not in (date_col, group)]
    sums = contributions.groupBy(group, label.alias("period")).agg(
        *[sum_or_zero(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(names)])
    predicted = F.col(f"_{names.index('Predicted_sales')}")
    entries = [F.struct(F.lit(c).alias("model_coefficient_name"), F.col(f"_{i}").alias("units"),
                        divide(F.col(f"_{i}"), predicted).alias("pct_units")) for i, c in enumerate(names)]
    return sums.select(group, "period", F.inline(F.array(*entries)))
