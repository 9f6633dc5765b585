"""Sufficient statistics of linear models in one aggregate, and small solvers over them.

Whatever the number of rows, one pass yields counts, means and covariances per
model; solving works on p x p matrices only (p is a column count).  Fits per
group keep the statistics distributed, one row per group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions.numeric import all_of


def gram_table(df: DataFrame, xs: Sequence[str], y: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., n, mean, cov)`` over complete rows; columns are ``[*xs, y]``.

    ``cov`` is the upper triangle of the population covariance, row by row.
    Covariance aggregates are centred, hence stable for large values.
    """
    names = [*xs, y]
    rows = df.filter(all_of([F.col(c).isNotNull() for c in (*by, *names)]))
    c = [F.col(k).cast("double") for k in names]
    upper = [F.covar_pop(c[i], c[j]) for i in range(len(c)) for j in range(i, len(c))]
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(k) for k in c]).alias("mean"), F.array(*upper).alias("cov"))


@dataclass
class Gram:
    """Moments of ``[*xs, y]`` over n rows."""

    names: list[str]
    n: int
    mean: np.ndarray
    cov: np.ndarray

    @classmethod
    def from_row(cls, names: Sequence[str], n, mean, cov) -> "Gram":
        p = len(mean)
        full = np.zeros((p, p))
        full[np.triu_indices(p)] = np.asarray(cov, dtype=float)
        full = full + np.triu(full, 1).T
        return cls(list(names), int(n), np.asarray(mean, dtype=float), full)

    def subset(self, xs: Sequence[str]) -> "Gram":
        at = [self.names.index(c) for c in (*xs, self.names[-1])]
        return Gram([self.names[i] for i in at], self.n, self.mean[at], self.cov[np.ix_(at, at)])

    @property
    def xs(self) -> list[str]:
        return self.names[:-1]

    @property
    def sxx(self) -> np.ndarray:
        return self.cov[:-1, :-1]

    @property
    def sxy(self) -> np.ndarray:
        return self.cov[:-1, -1]

    def intercept(self, beta: np.ndarray) -> float:
        return float(self.mean[-1] - self.mean[:-1] @ beta)


def collect_gram(df: DataFrame, xs: Sequence[str], y: str) -> Gram:
    row = gram_table(df, xs, y).first()
    if row is None or not row["n"]:
        raise ValueError("no complete rows to fit on")
    return Gram.from_row([*xs, y], row["n"], row["mean"], row["cov"])


# ---- distribution functions ------------------------------------------------

def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    d = 1.0 / max(1.0 - (a + b) * x / (a + 1), tiny)
    c, value = 1.0, d
    for m in range(1, 500):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    return front * value


def t_p_value(t: float, freedom: float) -> float:
    """Two-sided p-value of a t statistic."""
    return incomplete_beta(freedom / 2, 0.5, freedom / (freedom + t * t))


# ---- solvers ---------------------------------------------------------------

@dataclass
class LinearFit:
    """Ordinary least squares with inference; index 0 of the arrays is the intercept."""

    names: list[str]
    coefficients: np.ndarray
    std_errors: np.ndarray
    t_values: np.ndarray
    p_values: np.ndarray
    vif: np.ndarray
    r2: float
    r2_adj: float
    n: int
    sigma2: float

    def as_dict(self) -> dict[str, float]:
        return dict(zip(self.names[1:], self.coefficients[1:].tolist()))

    @property
    def intercept(self) -> float:
        return float(self.coefficients[0])

    def rows(self) -> list[tuple]:
        return [
            (name, *(float(a[i]) for a in (self.coefficients, self.std_errors, self.t_values, self.p_values)),
             None if i == 0 else float(self.vif[i - 1]))
            for i, name in enumerate(self.names)
        ]


def solve_ols(g: Gram) -> LinearFit:
    """Least squares with intercept from the moments."""
    p = len(g.xs)
    if g.n <= p + 1:
        raise ValueError(f"{g.n} complete rows are too few for {p} features")
    inverse = np.linalg.inv(g.sxx)
    beta = inverse @ g.sxy
    explained = float(beta @ g.sxy)
    total = float(g.cov[-1, -1])
    freedom = g.n - p - 1
    sse = max(total - explained, 0.0) * g.n
    sigma2 = sse / freedom
    mx = g.mean[:-1]
    variances = np.concatenate([
        [sigma2 * (1 / g.n + mx @ inverse @ mx / g.n)], sigma2 * np.diag(inverse) / g.n])
    coef = np.concatenate([[g.intercept(beta)], beta])
    errors = np.sqrt(variances)
    with np.errstate(divide="ignore", invalid="ignore"):
        t = coef / errors
    p_values = np.array([t_p_value(float(v), freedom) if np.isfinite(v) else 0.0 for v in t])
    r2 = explained / total if total > 0 else 0.0
    return LinearFit(["intercept", *g.xs], coef, errors, t, p_values, np.diag(inverse) * np.diag(g.sxx),
                     r2, 1 - (1 - r2) * (g.n - 1) / freedom, g.n, sigma2)


def solve_penalised(
    sxx: np.ndarray, sxy: np.ndarray, l1: float = 0.0, l2: float = 0.0,
    lower: np.ndarray | float = -np.inf, upper: np.ndarray | float = np.inf, tol: float = 1e-12, max_iter: int = 100_000,
) -> np.ndarray:
    """Minimise ``w'Sw/2 - s'w + l1 |w| + l2 w'w/2`` within bounds, by coordinate descent."""
    p = len(sxy)
    lower, upper = np.broadcast_to(lower, p), np.broadcast_to(upper, p)
    w = np.clip(np.zeros(p), lower, upper)
    scale = np.diag(sxx) + l2
    for _ in range(max_iter):
        shift = 0.0
        for j in range(p):
            if scale[j] <= 0:
                continue
            rest = sxy[j] - sxx[j] @ w + sxx[j, j] * w[j]
            new = np.sign(rest) * max(abs(rest) - l1, 0.0) / scale[j]
            new = min(max(new, lower[j]), upper[j])
            shift = max(shift, abs(new - w[j]) * math.sqrt(scale[j]))
            w[j] = new
        if shift < tol * max(1.0, math.sqrt(abs(float(sxy @ w)) + 1e-30)):
            return w
    raise RuntimeError(f"coordinate descent did not settle in {max_iter} rounds")


def solve_ridge(g: Gram, alpha: float, positive: bool = False) -> np.ndarray:
    """``|y - Xw|^2 + alpha |w|^2``."""
    return solve_penalised(g.sxx, g.sxy, 0.0, alpha / g.n, 0.0 if positive else -np.inf)


def solve_lasso(g: Gram, alpha: float, positive: bool = False) -> np.ndarray:
    """``|y - Xw|^2 / 2n + alpha |w|_1``."""
    return solve_penalised(g.sxx, g.sxy, alpha, 0.0, 0.0 if positive else -np.inf)


def solve_elastic_net(g: Gram, alpha: float, strength: float, lower=-np.inf, upper=np.inf) -> np.ndarray:
    """``|y - Xw|^2 / 2n + strength (alpha |w|_1 + (1 - alpha) |w|^2 / 2)``."""
    return solve_penalised(g.sxx, g.sxy, strength * alpha, strength * (1 - alpha), lower, upper)


def solve_each_group(table: DataFrame, xs: Sequence[str], y: str, by: Sequence[str], solve) -> DataFrame:
    """Apply ``solve(Gram) -> coefficients`` to every row of a statistics table.

    Python sees one row of p x p statistics per group, never the data rows.
    Every group gets a row for each coefficient; one that its rows do not
    determine is what the penalty makes it, or 0.
    """
    names = [*xs, y]
    keys = ", ".join(f"`{b}` {table.schema[b].dataType.simpleString()}" for b in by)
    schema = f"{keys}, n bigint, feature string, coefficient double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for record in pdf.to_dict("records"):
                g = Gram.from_row(names, record["n"], record["mean"], record["cov"])
                w = solve(g)
                key = [record[b] for b in by]
                rows.append([*key, g.n, "intercept", g.intercept(w)])
                rows += [[*key, g.n, c, float(v)] for c, v in zip(xs, w)]
            yield pd.DataFrame(rows, columns=[*by, "n", "feature", "coefficient"])

    return table.mapInPandas(run, schema)
