"""Exponential smoothing of series of any length, for all settings of a grid at once.

A step of simple, Holt or Holt-Winters smoothing maps the state (level, slope,
season) to the next one by a matrix that depends on the settings only, plus the new
value times a vector.  So a run of values is an affine map: the matrix of its length,
and what it gives from a zero state.  Every chunk of a series makes the latter on
its own, and the maps of the chunks are then composed in order.  Inside a chunk the
same is done with stretches that run side by side.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.operators.ordered import running_before
from tillwork.session import materialise

#: Values of a series that one task runs through.
CHUNK = 100_000
KINDS = ("simple", "trend", "seasonal")
FOLDS = {"n_splits": 6, "gap": 0, "n_test": 24, "stride": 4}


class Smoother:
    """One kind of smoothing under some settings (alpha, beta, gamma); states are arrays (..., setting, level and slope and season)."""

    def __init__(self, kind: str, settings: Sequence[tuple[float, float, float]], period: int):
        self.kind, self.settings = kind, settings
        self.period = period if kind == "seasonal" else 1
        self.size = {"simple": 1, "trend": 2, "seasonal": 2 + period}[kind]
        self.alpha, self.beta, self.gamma = (np.array([s[i] for s in settings]) for i in range(3))
        if kind == "simple":
            self.beta = np.zeros_like(self.beta)
        self._matrices: dict[tuple[int, int], np.ndarray] = {}

    def step(self, state: np.ndarray, v: np.ndarray, phase: np.ndarray) -> np.ndarray:
        """The states after one value for each row of states (row, setting, size)."""
        a, b, g = self.alpha, self.beta, self.gamma
        rows, out = np.arange(len(state)), state.copy()
        season = state[rows, :, 2 + phase] if self.kind == "seasonal" else 0.0
        slope = state[:, :, 1] if self.size > 1 else 0.0
        level = a * (v[:, None] - season) + (1 - a) * (state[:, :, 0] + slope)
        out[:, :, 0] = level
        if self.size > 1:
            out[:, :, 1] = b * (level - state[:, :, 0]) + (1 - b) * slope
        if self.kind == "seasonal":
            out[rows, :, 2 + phase] = g * (v[:, None] - level) + (1 - g) * season
        return out

    def matrix(self, phase: int, n: int) -> np.ndarray:
        """What ``n`` steps from a phase on do to a state: (setting, size, size)."""
        if (phase, n) not in self._matrices:
            unit = np.eye(self.size)

            def steps(first: int, count: int) -> np.ndarray:
                state = np.repeat(unit[:, None, :], len(self.settings), axis=1)
                for k in range(count):
                    state = self.step(state, np.zeros(self.size), np.full(self.size, (first + k) % self.period))
                return state.transpose(1, 2, 0)

            whole, rest = divmod(n, self.period)
            out = np.linalg.matrix_power(steps(phase, self.period), whole)
            self._matrices[phase, n] = steps(phase, rest) @ out
        return self._matrices[phase, n]

    def run(self, state: np.ndarray, phase: int, n: int, response: np.ndarray) -> np.ndarray:
        """The state (setting, size) after a run of ``n`` values whose response from a zero state is known."""
        return (self.matrix(phase, n) @ state[:, :, None])[:, :, 0] + response

    def response(self, x: np.ndarray, first: int) -> np.ndarray:
        """The state after the values ``x``, the first of which stands at ``first``, from a zero state."""
        width = max(1, int(np.sqrt(len(x))))
        lanes = -(-len(x) // width)
        state = np.zeros((lanes, len(self.settings), self.size))
        begins = np.arange(lanes) * width
        for k in range(width):
            live = np.flatnonzero(begins + k < len(x))
            state[live] = self.step(state[live], x[begins[live] + k], (first + begins[live] + k) % self.period)
        total = state[0]
        for lane in range(1, lanes):
            total = self.run(total, (first + lane * width) % self.period, min(width, len(x) - lane * width), state[lane])
        return total

    def start(self, head: np.ndarray, train: int) -> np.ndarray:
        """The state before the first value that counts, from the first values of a series of ``train`` values."""
        state = np.zeros(self.size)
        state[0] = head[0]
        if self.size > 1 and train > 1:
            state[1] = head[1] - head[0]
        if self.kind == "seasonal" and train >= 2 * self.period:
            state[0] = head[: self.period].mean()
            state[1] = (head[self.period : 2 * self.period].mean() - state[0]) / self.period
            state[2:] = head[: self.period] - state[0]
        return np.repeat(state[None, :], len(self.settings), axis=0)

    def forecast(self, state: np.ndarray, train: int, ahead: int) -> np.ndarray:
        """(setting, ahead): the next values after a series of ``train`` values."""
        steps = np.arange(1, ahead + 1)
        out = np.repeat(state[:, :1], ahead, axis=1)
        if self.size > 1:
            out = out + state[:, 1:2] * steps
        if self.kind == "seasonal":
            out = out + state[:, 2 + (train + steps - 1) % self.period]
        return out


def _folds(total: int, plan: dict) -> list[tuple[int, int, int, int]]:
    """(fold, values to learn from, first and last tested place) of a series of ``total`` values."""
    out = []
    for fold in range(plan["n_splits"]):
        end = total - fold * plan["stride"]
        cut = end - plan["n_test"]
        if cut > 0 and cut - plan["gap"] >= 2:
            out.append((fold, cut - plan["gap"], cut, end))
    return out


def backtest_grid(
    df: DataFrame, date_col: str, value: str, group_cols: Sequence[str], settings: dict[str, Sequence[tuple[float, float, float]]],
    period: int = 7, chunk: int = CHUNK, **folds,
) -> DataFrame:
    """rmse, mape and mae per group, model, fold and setting (alpha, beta, gamma) over rolling-origin folds.

    ``settings`` gives the settings to try for each kind of ``KINDS``.  Rows
    without a value are left out; a series is its values by date.  Folds that
    leave fewer than two values to learn from are left out.  A task holds
    ``chunk`` values, and for a series one state for each setting and chunk.
    """
    plan, by = {**FOLDS, **folds}, list(group_cols)
    unknown = set(settings) - set(KINDS)
    if unknown:
        raise ValueError(f"kinds are {', '.join(KINDS)}, not {', '.join(sorted(unknown))}")
    smoothers = {k: Smoother(k, list(s), period) for k, s in settings.items() if s}
    rows = df.select(*by, date_col, F.col(value).cast("double").alias("_x")).filter("_x IS NOT NULL").withColumn("_one", F.lit(1).cast("bigint"))
    placed = running_before(rows, by, [date_col, "_x"], ["_one"], False).withColumn("_chunk", F.floor(F.col("_one_before") / chunk))
    keys = [df.schema[c] for c in by]
    part = T.StructType([*keys, T.StructField("role", T.StringType()), T.StructField("start", T.LongType()), T.StructField("n", T.LongType()),
                         T.StructField("total", T.LongType()), T.StructField("data", T.ArrayType(T.DoubleType()))])

    def respond(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_one_before")
        x, first, total = pdf["_x"].to_numpy(), int(pdf["_one_before"].iloc[0]), int(pdf["_one_total"].iloc[0])
        wanted, end, out = _folds(total, plan), first + len(x), []
        cuts = sorted({first, end, *(c for c in (1, *(train for _, train, _, _ in wanted)) if first < c < end)})
        for kind, smoother in smoothers.items():
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a or kind == "seasonal":  # the others begin with the second value
                    out.append((kind, a, b - a, total, smoother.response(x[a - first : b - first], a).ravel()))
        tested = min((cut for _, _, cut, _ in wanted), default=end)
        for role, low, high in (("head", first, min(end, 2 * period)), ("tail", max(first, tested), end)):
            if low < high:
                out.append((role, low, high - low, total, x[low - first : high - first]))
        rows = pd.DataFrame(out, columns=["role", "start", "n", "total", "data"])
        return pd.concat([pd.DataFrame({c: [pdf[c].iloc[0]] * len(rows) for c in by}), rows], axis=1)

    parts = materialise(placed.groupBy(*by, "_chunk").applyInPandas(respond, part))
    found = T.StructType([*keys, T.StructField("model", T.StringType()), T.StructField("fold", T.IntegerType()),
                          *[T.StructField(m, T.DoubleType()) for m in ("alpha", "beta", "gamma", "rmse", "mape", "mae")]])

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("start")
        values = {r: pdf[pdf["role"] == r] for r in ("head", "tail")}
        head = np.concatenate([*values["head"]["data"]])
        tail, tail_at = (np.concatenate([*values["tail"]["data"]]), int(values["tail"]["start"].iloc[0])) if len(values["tail"]) else (np.zeros(0), 0)
        wanted, out = _folds(int(pdf["total"].iloc[0]), plan), []
        for kind, smoother in smoothers.items():
            runs = [(int(a), int(n), np.array(c).reshape(-1, smoother.size)) for a, n, c in pdf.loc[pdf["role"] == kind, ["start", "n", "data"]].itertuples(index=False)]
            first = 0 if kind == "seasonal" else 1
            for long in (True, False):  # a series of two periods begins in another state than a shorter one
                ends = {train: (fold, cut, end) for fold, train, cut, end in wanted if (train >= 2 * period) == long or kind != "seasonal"}
                if not ends or (not long and kind != "seasonal"):
                    continue
                state = smoother.start(head, min(ends))
                states = {first: state}
                for a, n, c in runs:
                    state = states[a + n] = smoother.run(state, a % smoother.period, n, c)
                for train, (fold, cut, end) in ends.items():
                    test = tail[cut - tail_at : end - tail_at]
                    ahead = smoother.forecast(states[train], train, end - train)[:, cut - train :]
                    miss, nonzero = test - ahead, test != 0
                    rmse, mae = np.sqrt((miss**2).mean(axis=1)), np.abs(miss).mean(axis=1)
                    mape = np.abs(miss[:, nonzero] / test[nonzero]).mean(axis=1) if nonzero.any() else [None] * len(miss)
                    out += [(kind, fold, *s, r, p, m) for s, r, p, m in zip(smoother.settings, rmse, mape, mae)]
        rows = pd.DataFrame(out, columns=[f.name for f in found.fields[len(by):]])
        rows = rows.astype({"model": str, "fold": "int32"} | {c: "float64" for c in rows.columns[2:]})
        return pd.concat([pd.DataFrame({c: [pdf[c].iloc[0]] * len(rows) for c in by}, dtype=None if out else object), rows], axis=1)

    return parts.groupBy(*by).applyInPandas(compose, found)


def smoothing_backtest(
    df: DataFrame, date_col: str, value: str, group_cols: Sequence[str], kinds: Sequence[str] = KINDS,
    alpha: float = 0.3, beta: float = 0.1, gamma: float = 0.1, period: int = 7, **folds,
) -> DataFrame:
    """Backtest exponential smoothing per series over rolling-origin folds: rmse, mape and mae per group, model and fold."""
    one = {k: [(alpha, beta, gamma)] for k in kinds}
    return backtest_grid(df, date_col, value, group_cols, one, period, **folds).drop("alpha", "beta", "gamma")


def smoothing_search(
    df: DataFrame, date_col: str, value: str, group_cols: Sequence[str], kinds: Sequence[str] = KINDS,
    grid: Sequence[float] = (0.05, 0.1, 0.3, 0.5, 0.7, 0.9), period: int = 7, **folds,
) -> DataFrame:
    """The best setting of every series and model: alpha, beta, gamma, rmse (mean over the folds) and n_folds.

    Every kind tries all combinations of the grid in the settings it has (beta
    and gamma are null where it has none), in one run through the values.  Of
    equal ones, at nine digits of the value, the smallest setting counts.
    """
    used = {"simple": 1, "trend": 2, "seasonal": 3}
    settings = {k: [(*s, *[0.0] * (3 - used[k])) for s in product(sorted(grid), repeat=used[k])] for k in kinds}
    scored = backtest_grid(df, date_col, value, group_cols, settings, period, **folds)
    means = scored.groupBy(*group_cols, "model", "alpha", "beta", "gamma").agg(F.avg("rmse").alias("rmse"), F.count("*").alias("n_folds"))
    rank = F.row_number().over(Window.partitionBy(*group_cols, "model").orderBy(F.expr("bround(rmse, 9)"), "alpha", "beta", "gamma"))
    best = means.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    has = lambda c, n: F.when(F.col("model").isin([k for k in KINDS if used[k] >= n]), F.col(c)).alias(c)
    return best.select(*group_cols, "model", "alpha", has("beta", 2), has("gamma", 3), "rmse", "n_folds")
