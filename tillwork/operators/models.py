"""Model fitting and scoring as Spark jobs."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    GBTRegressor, GeneralizedLinearRegression, LinearRegression, RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions.numeric import finite, total
from tillwork.operators import bounded, gram, roi
from tillwork.operators.attribution import linear_predictor
from tillwork.operators.eda import correlation_matrix
from tillwork.operators.metrics import regression_metrics
from tillwork.operators.ordered import take_by_hash
from tillwork.operators.prep import trim_top
from tillwork.session import attach_row, materialise, small_side

COEFFICIENT_TABLE = "feature string, coefficient double, std_error double, t_value double, p_value double, vif double"


# ---- least squares ---------------------------------------------------------

def ols(df: DataFrame, xs: Sequence[str], y: str) -> gram.LinearFit:
    """Ordinary least squares with inference from one aggregate job."""
    return gram.solve_ols(gram.collect_gram(df, xs, y))


def coefficient_table(spark: SparkSession, fit: gram.LinearFit) -> DataFrame:
    table = spark.createDataFrame(fit.rows(), COEFFICIENT_TABLE)
    return table.withColumns({"r2": F.lit(fit.r2), "r2_adj": F.lit(fit.r2_adj), "n": F.lit(fit.n).cast("bigint")})


def score_linear(df: DataFrame, coefficients: dict[str, float], intercept: float, name: str = "yhat") -> DataFrame:
    """Scoring is one projection."""
    return linear_predictor(df, coefficients, intercept, name=name)


def logit(df: DataFrame, xs: Sequence[str], target: str, max_iter: int = 25) -> DataFrame:
    """Binary logit with inference: coefficient, standard error, t and p value.

    The two classes are mapped to 0 and 1 in sort order.
    """
    levels = sorted(r[0] for r in df.select(target).filter(F.col(target).isNotNull()).distinct().limit(3).collect())
    if len(levels) != 2:
        raise ValueError(f"{target!r} does not have exactly two classes")
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in xs],
                     (F.col(target) == F.lit(levels[1])).cast("double").alias("_y")).dropna()
    packed = VectorAssembler(inputCols=list(xs), outputCol="_x").transform(rows)
    model = GeneralizedLinearRegression(
        family="binomial", link="logit", featuresCol="_x", labelCol="_y", maxIter=max_iter).fit(packed)
    s = model.summary
    names = [*xs, "intercept"]
    values = zip(names, [*model.coefficients.toArray().tolist(), model.intercept],
                 s.coefficientStandardErrors, s.tValues, s.pValues)
    return df.sparkSession.createDataFrame(
        [tuple([n, *map(float, v)]) for n, *v in values],
        "feature string, coefficient double, std_error double, t_value double, p_value double")


def logit_accuracy(
    df: DataFrame, coefficients: dict[str, float], intercept: float, target: str, threshold: float = 0.5
) -> DataFrame:
    """One row ``(n, accuracy)``: share of rows whose class the logit model calls right.

    The classes are mapped to 0 and 1 in sort order; rows with a missing value do not count.
    """
    known = df.dropna(subset=[*coefficients, target])
    scored = score_logit(attach_row(known, known.agg(F.max(target).alias("_one"))), coefficients, intercept, threshold, "_p", "_called")
    right = ((F.col(target) == F.col("_one")).cast("int") == F.col("_called")).cast("int")
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(right).alias("accuracy"))


def score_logit(
    df: DataFrame, coefficients: dict[str, float], intercept: float, threshold: float = 0.5,
    probability: str = "probability", label: str = "predicted",
) -> DataFrame:
    """Probability, and class 1 where it is above the threshold."""
    scored = linear_predictor(df, coefficients, intercept, name="_z")
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_z")))
    return scored.withColumn(probability, p).withColumn(label, (F.col(probability) > threshold).cast("int")).drop("_z")


# ---- marketing-mix linear models -------------------------------------------

def train_linear_model(
    df: DataFrame, idv: Sequence[str], dv: str, flag_col: str, date_col: str, group_col: str,
    model_type: str = "ridge", alpha: float = 1.0,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Non-negative ridge or lasso on the train rows.

    Returns the feature table, the coefficient matrix per group (equal betas,
    with ``Intercept`` and ``e_intercept``), and actual versus predicted values
    of train and test rows.
    """
    if model_type not in ("ridge", "lasso"):
        raise ValueError("model_type is 'ridge' or 'lasso'")
    g = gram.collect_gram(df.filter(F.col(flag_col) == "train"), idv, dv)
    solve = gram.solve_ridge if model_type == "ridge" else gram.solve_lasso
    w = solve(g, alpha, positive=True)
    intercept = g.intercept(w)
    spark = df.sparkSession
    features = spark.createDataFrame(
        [*[(c, float(v)) for c, v in zip(idv, w)], ("Intercept", intercept)], "`feature names` string, `feature coefficients` double")
    groups = df.select(group_col).distinct()
    matrix = groups.select(
        group_col, *[F.lit(float(v)).alias(f"beta_{c}") for c, v in zip(idv, w)],
        F.lit(intercept).alias("Intercept"), finite(F.exp(F.lit(intercept))).alias("e_intercept"))
    scored = score_linear(df.filter(F.col(flag_col).isin("train", "test")), dict(zip(idv, map(float, w))), intercept, "preds")
    return features, matrix, scored.select(date_col, group_col, flag_col, F.col(dv).alias("actuals"), "preds")


def coefficient_matrix(
    long: DataFrame, features: Sequence[str], intercept: str, group_col: str, groups: DataFrame
) -> DataFrame:
    """Matrix per group from long coefficient names.

    Fixed effects apply to every group; ``feature|group[value]`` is added for
    its group, where ``1`` stands for the intercept.  Absent effects are 0.
    """
    wanted = [*features, intercept]
    name, value = F.col("feature names"), F.col("feature coefficients")
    # what stands before the last bar is the effect, what stands in the last brackets behind it the group
    parts = F.split(name, r"\|")
    grouped = F.element_at(parts, -1)
    of_group = (F.size(parts) > 1) & grouped.contains("[") & grouped.endswith("]")
    fixed = long.agg(*[F.coalesce(F.sum(F.when(name == c, value)), F.lit(0.0)).alias(f"_f{i}") for i, c in enumerate(wanted)])
    effect = F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "|")
    random = long.filter(of_group).select(
        F.when(effect == "1", intercept).otherwise(effect).alias("_effect"),
        F.substring_index(F.element_at(F.split(grouped, r"\["), -1), "]", 1).alias("_group"), value.alias("_value"))
    random = random.groupBy("_group").agg(*[
        F.sum(F.when(F.col("_effect") == c, F.col("_value"))).alias(f"_r{i}") for i, c in enumerate(wanted)])
    rows = attach_row(groups.select(group_col).distinct(), fixed)
    rows = rows.join(random, F.col(group_col).cast("string") == F.col("_group"), "left")
    effects = [F.col(f"_f{i}") + F.coalesce(f"_r{i}", F.lit(0.0)) for i in range(len(wanted))]
    out = [e.alias(f"beta_{c}") for e, c in zip(effects, features)]
    return rows.select(group_col, *out, effects[-1].alias(intercept), F.exp(effects[-1]).alias("e_intercept"))


def elastic_net_by_group(
    df: DataFrame, xs: Sequence[str], y: str, by: Sequence[str], alpha: float = 0.5, strength: float = 0.1,
    box: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """One elastic net per group, optionally with bounds on coefficients: long coefficients."""
    lower = np.array([(box or {}).get(c, (-np.inf, np.inf))[0] for c in xs])
    upper = np.array([(box or {}).get(c, (-np.inf, np.inf))[1] for c in xs])
    table = gram.gram_table(df, xs, y, by)
    return gram.solve_each_group(
        table, xs, y, by, lambda g: gram.solve_elastic_net(g, alpha, strength, lower, upper))


def score_by_group(df: DataFrame, coefficients: DataFrame, xs: Sequence[str], by: Sequence[str], name: str = "yhat") -> DataFrame:
    """Score rows with their group's long coefficients; groups without a model give NULL."""
    wide = coefficients.groupBy(*by).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("coefficient"))).alias(f"_b{i}") for i, c in enumerate(["intercept", *xs])])
    joined = df.join(small_side(wide), list(by), "left")
    return joined.withColumn(name, total([F.col(f"_b{i + 1}") * F.col(c) for i, c in enumerate(xs)]) + F.col("_b0")).select(
        *df.columns, name)


# ---- mixed effects ---------------------------------------------------------

def _moments(pdf: pd.DataFrame, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and raw cross products of ``[1, xs, y]`` per group, as a batch of matrices."""
    n = pdf["n"].to_numpy(dtype=float)
    mean = np.stack(pdf["mean"].to_numpy()).astype(float)
    upper = np.stack(pdf["cov"].to_numpy()).astype(float)
    cov = np.zeros((len(n), p, p))
    i, j = np.triu_indices(p)
    cov[:, i, j] = upper
    cov[:, j, i] = upper
    m = np.concatenate([np.ones((len(n), 1)), mean], axis=1)
    cross = m[:, :, None] * m[:, None, :]
    cross[:, 1:, 1:] += cov
    return n, cross * n[:, None, None]


def _effect_system(cross: np.ndarray, z: list[int], beta, d, sigma2) -> tuple[np.ndarray, np.ndarray]:
    """Matrix and right side of the equations of every group's random effects."""
    ztz = cross[:, z][:, :, z]
    ztx, zty = cross[:, z, :-1], cross[:, z, -1]
    return ztz / sigma2 + np.linalg.inv(d)[None], (zty - ztx @ beta) / sigma2


def _effect_bounds(groups: int, z: list[int], beta, box) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the effects such that common coefficient and effect lie in the box."""
    return tuple(np.repeat((side - beta[z])[None, :], groups, axis=0) for side in box)


def _random_effects(cross: np.ndarray, z: list[int], beta, d, sigma2):
    """Posterior mean and covariance of every group's random effects."""
    a, r = _effect_system(cross, z, beta, d, sigma2)
    m = np.linalg.inv(a)
    return np.einsum("gij,gj->gi", m, r), m


def _bounded_sums(pdf: pd.DataFrame, p: int, z: list[int], beta, d, sigma2, box) -> np.ndarray:
    """Sums over groups for the common coefficients, flattened: of the bounded totals, and of the equations of the other columns."""
    _, cross = _moments(pdf, p)
    total = beta[z] + bounded.box_minimum(*_effect_system(cross, z, beta, d, sigma2), *_effect_bounds(len(cross), z, beta, box))
    rest = [i for i in range(p) if i not in z]
    right = cross[:, rest, -1] - np.einsum("grq,gq->gr", cross[:, rest][:, :, z], total)
    return np.concatenate([total.sum(0), cross[:, rest][:, :, rest].sum(0).ravel(), right.sum(0), [len(cross)]])


def _expectation(pdf: pd.DataFrame, p: int, z: list[int], beta, d, sigma2) -> np.ndarray:
    """Sums over groups that the maximisation step needs, flattened."""
    n, cross = _moments(pdf, p)
    u, m = _random_effects(cross, z, beta, d, sigma2)
    ztz, ztx, zty = cross[:, z][:, :, z], cross[:, z, :-1], cross[:, z, -1]
    xtz_u = np.einsum("gqp,gq->gp", ztx, u)
    second = np.einsum("gi,gj->gij", u, u) + m
    rss = cross[:, -1, -1] - 2 * (u * zty).sum(1) + np.einsum("gij,gij->g", ztz, second)
    return np.concatenate([
        cross[:, :-1, :-1].sum(0).ravel(), (cross[:, :-1, -1] - xtz_u).sum(0), second.sum(0).ravel(),
        [rss.sum(), n.sum(), len(n)]])


def linear_mixed_effects(
    df: DataFrame, xs: Sequence[str], y: str, group: str, random: Sequence[str] = (), rounds: int = 500,
    tol: float = 1e-8, box: dict[str, tuple[float, float]] | None = None,
) -> tuple[dict[str, float], DataFrame]:
    """Random intercept and slopes by group, fitted by expectation-maximisation.

    The data are read once, into p x p statistics per group, which stay
    distributed: each step of the fit sums over them in one Spark job, whose
    tasks return one vector each.  Steps are extrapolated (SQUAREM, Varadhan and
    Roland 2008), which takes a few dozen of them; a fit that does not settle in
    ``rounds`` extrapolations is an error.  Returns the common coefficients and a
    table of group effects and total coefficients.  ``box`` bounds the totals of
    the named coefficients: with the variances of the free fit, common and total
    coefficients are those with the least penalised error inside the bounds.
    ``violation`` tells how far a group is from the conditions of its best point.
    """
    names = ["intercept", *xs]
    effects = ["intercept", *random]
    z = [names.index(c) for c in effects]
    p, q = len(xs) + 1, len(z)
    stats = materialise(gram.gram_table(df, xs, y, [group]))
    g = gram.collect_gram(df, xs, y)
    w = np.linalg.pinv(g.sxx) @ g.sxy
    sigma2 = max(float(g.cov[-1, -1] - w @ g.sxy), 1e-12)
    limits = None if box is None else tuple(
        np.array([box.get(c, (-np.inf, np.inf))[side] for c in effects], dtype=float) for side in (0, 1))

    def split(theta: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        d = theta[p:-1].reshape(q, q)
        return theta[:p], (d + d.T) / 2, float(np.exp(theta[-1]))

    def step(theta: np.ndarray) -> np.ndarray:
        args = (p, z, *split(theta))

        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = [_expectation(pdf, *args) for pdf in batches if len(pdf)]
            if sums:
                yield pd.DataFrame({"s": [np.sum(sums, axis=0)]})

        s = np.sum([r["s"] for r in stats.mapInPandas(part, "s array<double>").collect()], axis=0)
        xtx, rest = s[: p * p].reshape(p, p), s[p * p:]
        right, second = rest[:p], rest[p: p + q * q].reshape(q, q)
        rss, n, groups = rest[p + q * q:]
        beta = np.linalg.solve(xtx, right)
        noise = max((rss - 2 * beta @ right + beta @ xtx @ beta) / n, 1e-12)
        return np.concatenate([beta, (second / groups + np.eye(q) * 1e-12).ravel(), [np.log(noise)]])

    theta = np.concatenate([[g.intercept(w)], w, (np.eye(q) * sigma2 * 0.1).ravel(), [np.log(sigma2)]])
    for _ in range(rounds):
        once = step(theta)
        first = once - theta
        if np.max(np.abs(first[:p]) / (1 + np.abs(once[:p]))) < tol:
            theta = once
            break
        twice = step(once)
        bend = twice - once - first
        length = -max(1.0, float(np.linalg.norm(first) / max(np.linalg.norm(bend), 1e-300)))
        ahead = theta - 2 * length * first + length**2 * bend
        usable = np.isfinite(ahead).all() and np.linalg.eigvalsh(split(ahead)[1]).min() > 0 and abs(ahead[-1] - twice[-1]) < 2
        theta = ahead if usable else twice
    else:
        raise RuntimeError(f"the mixed model did not settle in {rounds} rounds")
    beta, d, sigma2 = split(theta)
    rest = [i for i in range(p) if i not in z]

    def turn(beta: np.ndarray) -> np.ndarray:
        """Best common coefficients for the best bounded totals under ``beta``."""
        args = (p, z, beta, d, sigma2, limits)

        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = [_bounded_sums(pdf, *args) for pdf in batches if len(pdf)]
            if sums:
                yield pd.DataFrame({"s": [np.sum(sums, axis=0)]})

        sums, out = np.sum([r["s"] for r in stats.mapInPandas(part, "s array<double>").collect()], axis=0), beta.copy()
        out[z] = sums[:q] / sums[-1]
        if rest:
            out[rest] = np.linalg.solve(sums[q : q + len(rest) ** 2].reshape(len(rest), -1), sums[q + len(rest) ** 2 : -1])
        return out

    for _ in range(rounds if limits else 0):  # convex in common and total coefficients, solved in turns that are extrapolated
        once = turn(beta)
        first = once - beta
        if np.max(np.abs(first) / (1 + np.abs(once))) < tol:
            break
        bend = turn(once) - once - first
        length = -max(1.0, float(np.linalg.norm(first) / max(np.linalg.norm(bend), 1e-300)))
        ahead = beta - 2 * length * first + length**2 * bend
        beta = turn(ahead) if np.isfinite(ahead).all() else once

    final = (beta.copy(), d.copy(), sigma2)
    key = f"`{group}` {df.schema[group].dataType.simpleString()}"

    def effects_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            _, cross = _moments(pdf, p)
            a, r = _effect_system(cross, z, *final)
            edges = _effect_bounds(len(a), z, final[0], limits or (np.full(len(z), -np.inf), np.full(len(z), np.inf)))
            u = bounded.box_minimum(a, r, *edges)
            off = bounded.violation(a, r, u, *edges)
            rows = [[k, c, float(v), float(final[0][at] + v), float(w)] for k, group_u, w in zip(pdf[group], u, off)
                    for c, v, at in zip(effects, group_u, z)]
            yield pd.DataFrame(rows, columns=[group, "feature", "effect", "coefficient", "violation"])

    table = stats.mapInPandas(effects_of, f"{key}, feature string, effect double, coefficient double, violation double")
    return dict(zip(names, beta.tolist())), table


def hierarchical_shrinkage(
    df: DataFrame, xs: Sequence[str], y: str, group: str, prior_sd: float | dict[str, float] = 1.0,
    prior_mean: dict[str, float] | None = None, bounds: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Posterior mean and sd of each group's coefficients under normal priors, in closed form.

    Prior means default to the pooled fit, the noise variance is the pooled
    one.  ``bounds`` cut the posterior to a range: mean and sd are those of the
    cut distribution (``bounded.box_moments``).  This replaces sampling.
    """
    pooled = ols(df, xs, y)
    names = ["intercept", *xs]
    centre = np.array([(prior_mean or {}).get(c, v) for c, v in zip(names, pooled.coefficients)])
    sd = np.array([prior_sd.get(c, 1.0) if isinstance(prior_sd, dict) else prior_sd for c in names], dtype=float)
    sigma2, p = pooled.sigma2, len(names)
    precision = np.diag(1 / sd**2)
    low, high = (np.array([(bounds or {}).get(c, (-np.inf, np.inf))[side] for c in names], dtype=float) for side in (0, 1))
    key = f"`{group}` {df.schema[group].dataType.simpleString()}"

    def posterior(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            n, cross = _moments(pdf, p)
            cov = np.linalg.inv(cross[:, :-1, :-1] / sigma2 + precision[None])
            mean = np.einsum("gij,gj->gi", cov, cross[:, :-1, -1] / sigma2 + (precision @ centre)[None])
            if bounds:
                mean, cov = bounded.box_moments(mean, cov, *(np.repeat(side[None, :], len(n), axis=0) for side in (low, high)))
            rows = [[k, int(count), c, float(m[i]), float(np.sqrt(v[i, i]))]
                    for k, count, m, v in zip(pdf[group], n, mean, cov) for i, c in enumerate(names)]
            yield pd.DataFrame(rows, columns=[group, "n", "feature", "posterior_mean", "posterior_sd"])

    return gram.gram_table(df, xs, y, [group]).mapInPandas(
        posterior, f"{key}, n bigint, feature string, posterior_mean double, posterior_sd double")


# ---- selection -------------------------------------------------------------

def stepwise(
    df: DataFrame, y: str, candidates: Sequence[str], necessary: Sequence[str] = (), negative: Sequence[str] = (),
    p_limit: float = 0.1,
) -> gram.LinearFit:
    """Forward selection on p-values and signs; every fit uses one set of statistics.

    A candidate qualifies if all p-values stay within the limit and every
    coefficient has its required sign (negative if it contains any of the
    ``negative`` patterns) and the sign of its correlation with the response.
    """
    names = list(dict.fromkeys([*necessary, *candidates]))
    g = gram.collect_gram(df, names, y)
    selected = list(necessary)
    remaining = [c for c in names if c not in selected]

    def qualifies(fit: gram.LinearFit) -> bool:
        for i, c in enumerate(fit.names[1:], start=1):
            sign = np.sign(fit.coefficients[i])
            required = -1 if any(re.search(k, c) for k in negative) else 1
            if fit.p_values[i] > p_limit or sign != required or sign != np.sign(g.cov[g.names.index(c), -1]):
                return False
        return True

    while remaining:
        fits = [(gram.solve_ols(g.subset([*selected, c])), c) for c in remaining]
        good = [(f.p_values[-1], c) for f, c in fits if qualifies(f)]
        if not good:
            break
        best = min(good)[1]
        selected.append(best)
        remaining.remove(best)
    if not selected:
        raise ValueError("no candidate qualifies")
    return gram.solve_ols(g.subset(selected))


def modelling_iteration(
    df: DataFrame, xs: Sequence[str], y: str, rtm: Sequence[str], cost: str, margin_cost: str, share: float = 0.95
) -> DataFrame:
    """One modelling round as a single record: trim, fit, errors, contributions, returns, VIF, p-values."""
    kept = trim_top(df, y, share)
    fit = ols(kept, xs, y)
    coef = fit.as_dict()
    errors = regression_metrics(score_linear(kept, coef, fit.intercept), y, "yhat").select(
        F.col("mape_finite").alias("mape"), "wmape")
    contributions = roi.contribution(kept, y, coef)
    wide = contributions.agg(
        *[F.max(F.when(F.col("feature") == c, F.col("contribution"))).alias(f"{c}_contrib") for c in xs],
        F.sum(F.when(F.col("feature").isin(*rtm), F.col("contribution"))).alias("rtm_contribution"))
    record = errors.crossJoin(wide)
    record = record.crossJoin(roi.roi(kept, y, coef, rtm, cost).withColumnRenamed("roi", "roi_sales"))
    record = record.crossJoin(roi.roi(kept, y, coef, rtm, margin_cost).withColumnRenamed("roi", "roi_margin"))
    fixed = {"n": fit.n, "r2": fit.r2, "r2_adj": fit.r2_adj, "n_features": len(xs), "intercept": fit.intercept,
             "any_p_over_limit": bool((fit.p_values > 0.1).any())}
    for i, c in enumerate(fit.names):
        fixed[f"{c}_pvalue"] = float(fit.p_values[i])
        if i:
            fixed[c] = float(fit.coefficients[i])
            fixed[f"{c}_vif"] = float(fit.vif[i - 1])
    return record.select(*record.columns, *[F.lit(v).alias(f"{k}") for k, v in fixed.items()])


# ---- Spark ML models -------------------------------------------------------

def _assembled(df: DataFrame, xs: Sequence[str], y: str) -> DataFrame:
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in xs], F.col(y).cast("double").alias("label")).dropna()
    return VectorAssembler(inputCols=list(xs), outputCol="features").transform(rows).select("features", "label")


#: Rows of a partition that tree models hold at most; they keep every row as objects, many times its size in a file.
TREE_ROWS = 1_000_000


def evened(rows: DataFrame, most: int = TREE_ROWS) -> DataFrame:
    """The rows in partitions of some ``most`` rows where one has more; else as they are."""
    total, largest = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    return rows.repartition(-(-total // most)) if (largest or 0) > most else rows


def _importance_table(spark: SparkSession, xs: Sequence[str], values) -> DataFrame:
    return spark.createDataFrame([(c, float(v)) for c, v in zip(xs, values)], "feature string, importance double")


def boosted_grid(
    df: DataFrame, xs: Sequence[str], y: str, depths: Sequence[int] = (3,), trees: int = 20, folds: int = 2,
    seed: int = 42, parallelism: int = 4,
) -> tuple[object, DataFrame, DataFrame]:
    """Gradient-boosted trees with a cross-validated grid: model, scores, importances."""
    rows = evened(_assembled(df, xs, y)).persist()
    gbt = GBTRegressor(maxIter=trees, seed=seed)
    grid = ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).build()
    search = CrossValidator(estimator=gbt, estimatorParamMaps=grid, evaluator=RegressionEvaluator(metricName="rmse"),
                            numFolds=folds, parallelism=parallelism, seed=seed).fit(rows)
    rows.unpersist()
    spark = df.sparkSession
    scores = spark.createDataFrame(list(zip(map(int, depths), map(float, search.avgMetrics))), "max_depth int, rmse double")
    return search.bestModel, scores, _importance_table(spark, xs, search.bestModel.featureImportances.toArray())


def forest_importance(df: DataFrame, xs: Sequence[str], y: str, trees: int = 20, depth: int = 5, seed: int = 42) -> DataFrame:
    model = RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=seed).fit(evened(_assembled(df, xs, y)))
    return _importance_table(df.sparkSession, xs, model.featureImportances.toArray())


def prepare_training(
    df: DataFrame, keys: Sequence[str], train_size: float = 0.75, drop_missing: Sequence[str] = (), seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Remove rows with missing required values and split train and validation parts."""
    rows = df.dropna(subset=list(drop_missing)) if drop_missing else df
    # stored, since either part would find the cut anew each time it is read
    marked = materialise(take_by_hash(rows, keys, seed, {"_train": F.bround(F.lit(train_size) * F.col("n"))}))
    return marked.filter("_train").drop("_train"), marked.filter("NOT _train").drop("_train")


def model_search(train: DataFrame, validation: DataFrame, xs: Sequence[str], y: str, top: int = 10, trees: int = 10, seed: int = 42) -> DataFrame:
    """Fit several estimators and settings, rank them by validation RMSE."""
    # every setting reads both parts, the tree models several times
    fit_on, check_on = evened(_assembled(train, xs, y)).persist(), _assembled(validation, xs, y).persist()
    settings = [
        ("linear", LinearRegression()),
        ("ridge", LinearRegression(regParam=0.1, elasticNetParam=0.0)),
        ("lasso", LinearRegression(regParam=0.1, elasticNetParam=1.0)),
        ("forest", RandomForestRegressor(numTrees=trees, maxDepth=5, seed=seed)),
        ("boosted", GBTRegressor(maxIter=trees, maxDepth=3, seed=seed)),
    ]
    rows = []
    for name, estimator in settings:
        scored = Pipeline(stages=[estimator]).fit(fit_on).transform(check_on)
        m = regression_metrics(scored, "label", "prediction").first()
        rows.append((name, float(m["rmse"]), float(m["mae"]), float(m["r2"])))
    rows.sort(key=lambda r: r[1])
    fit_on.unpersist()
    check_on.unpersist()
    return train.sparkSession.createDataFrame(
        [(i + 1, *r) for i, r in enumerate(rows[:top])], "rank int, model string, rmse double, mae double, r2 double")


def correlation_signs(df: DataFrame, xs: Sequence[str], y: str) -> dict[str, float]:
    """Correlation of each feature with the response, as used by sign checks."""
    matrix = correlation_matrix(df, [*xs, y])
    return {c: float(matrix[i, -1]) for i, c in enumerate(xs)}
