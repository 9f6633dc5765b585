"""Model search by successive halving.

All settings start on a small part of the rows, chosen by a hash of the key; the
better ones go on to a part that is some times larger and holds the one before, up
to all rows.  Linear settings of a round need no scan of their own: the moments of
its rows, one aggregate for each way of filling gaps, serve all penalties, and
their errors follow from the moments of the validation rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions.hashing import hash_order, hash_prefix
from tillwork.operators import gram
from tillwork.operators.prep import fill_from_row, fill_values
from tillwork.session import materialise

FILLS = ("drop", "mean", "median", "zero")
#: Hex digits of the hash that deals rows to parts.
DIGITS = 7


@dataclass(frozen=True)
class Setting:
    """One model to try: its kind, how gaps are filled, and its parameters."""

    model: str
    fill: str
    parameters: tuple[tuple[str, float], ...] = field(default=())

    def text(self) -> str:
        return ", ".join(f"{k}={v:g}" for k, v in self.parameters)


def settings_grid(fills: Sequence[str] = FILLS, penalties: Sequence[float] = (0.001, 0.01, 0.1, 1.0), depths: Sequence[int] = (3, 6),
                  trees: Sequence[int] = (10, 20)) -> list[Setting]:
    """Every kind of model with every combination of its parameters and fillings."""
    shapes = [("linear", ())]
    shapes += [(k, (("penalty", p),)) for k in ("ridge", "lasso") for p in penalties]
    shapes += [("elastic", (("penalty", p), ("share", s))) for p in penalties for s in (0.2, 0.5, 0.8)]
    shapes += [(k, (("depth", d), ("trees", t))) for k in ("forest", "boosted") for d in depths for t in trees]
    return [Setting(m, f, p) for f in fills for m, p in shapes]


def _filled(rows: DataFrame, learn: DataFrame, xs: Sequence[str], how: str) -> tuple[DataFrame, DataFrame]:
    """``learn`` and ``rows`` without gaps in ``xs``; values come from ``learn``, ``drop`` fills only the rows to be judged."""
    if how not in FILLS:
        raise ValueError(f"a filling is one of {', '.join(FILLS)}")
    values = fill_values(learn, xs, "constant", 0.0) if how == "zero" else fill_values(learn, xs, "median" if how == "median" else "mean")
    values = materialise(values.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in xs]))
    return learn.dropna(subset=list(xs)) if how == "drop" else fill_from_row(learn, values), fill_from_row(rows, values)


def _linear(g: gram.Gram, setting: Setting) -> np.ndarray:
    """Coefficients on features of unit variance, brought back to the features' own scale."""
    sd = np.sqrt(np.diag(g.sxx))
    unit = np.where(sd > 0, sd, 1.0)
    sxx, sxy, p = g.sxx / np.outer(unit, unit), g.sxy / unit, dict(setting.parameters)
    if setting.model == "linear":
        return np.linalg.pinv(sxx) @ sxy / unit
    share = {"ridge": 0.0, "lasso": 1.0}.get(setting.model, p.get("share", 0.0))
    strength = p["penalty"] * math.sqrt(max(float(g.cov[-1, -1]), 0.0)) if share else p["penalty"]
    return gram.solve_penalised(sxx, sxy, strength * share, strength * (1 - share) if share else strength) / unit


def _error(check: gram.Gram, w: np.ndarray, intercept: float) -> float:
    """Root mean squared error from the moments of the judged rows."""
    mean = check.mean[-1] - intercept - check.mean[:-1] @ w
    spread = check.cov[-1, -1] - 2 * w @ check.sxy + w @ check.sxx @ w
    return math.sqrt(max(0.0, float(spread + mean**2)))


def _tree_error(learn: DataFrame, check: DataFrame, xs: Sequence[str], y: str, setting: Setting, seed: int) -> float:
    p = {k: int(v) for k, v in setting.parameters}
    kind = {"featuresCol": "_x", "labelCol": y, "seed": seed, "maxDepth": p["depth"]}
    model = RandomForestRegressor(numTrees=p["trees"], **kind) if setting.model == "forest" else GBTRegressor(maxIter=p["trees"], **kind)
    packed = VectorAssembler(inputCols=list(xs), outputCol="_x")
    scored = model.fit(packed.transform(learn).select("_x", y)).transform(packed.transform(check).select("_x", y))
    return math.sqrt(scored.agg(F.avg((F.col(y) - F.col("prediction")) ** 2)).first()[0])


def halving_search(
    train: DataFrame, validation: DataFrame, xs: Sequence[str], y: str, keys: Sequence[str], settings: Sequence[Setting] | None = None,
    first_share: float = 1 / 9, factor: int = 3, seed: int = 42,
) -> DataFrame:
    """(rank, model, fill, parameters, round, rows, rmse) of every setting, with the last round it took part in.

    A round keeps the best 1 / ``factor`` of its settings, at least one, by the
    error on the validation rows, which every setting is judged on; of equal
    ones the earlier in the list.  The share of the training rows grows by
    ``factor`` from ``first_share`` to 1.  Later rounds rank before earlier ones.
    Penalties are on features of unit variance.  Rows without ``y`` are left out.
    """
    numbers = [F.col(c).cast("double").alias(c) for c in (*xs, y)]
    # a salt of its own: the training part may have been chosen by the same hash of the same keys
    place = (hash_prefix(hash_order(list(keys), f"{seed}-rounds"), DIGITS) / F.lit(float(16**DIGITS))).alias("_at")
    learn = materialise(train.select(*numbers, place).filter(F.col(y).isNotNull()))
    check = materialise(validation.select(*numbers).filter(F.col(y).isNotNull()))
    open_, share, round_ = list(settings or settings_grid()), first_share, 1
    done: list[tuple[Setting, int, int, float]] = []
    while True:
        part = learn if share >= 1 - 1e-9 else materialise(learn.filter(F.col("_at") < share))
        rows, scores = part.count(), []
        for how in dict.fromkeys(s.fill for s in open_):
            own = [s for s in open_ if s.fill == how]
            fit_on, judged = _filled(check, part, xs, how)
            linear = [s for s in own if s.model not in ("forest", "boosted")]
            if linear:
                g, against = gram.collect_gram(fit_on, xs, y), gram.collect_gram(judged, xs, y)
                for s in linear:
                    w = _linear(g, s)
                    scores.append((_error(against, w, g.intercept(w)), s))
            if len(linear) < len(own):
                scores += [(_tree_error(fit_on, judged, xs, y, s, seed), s) for s in own if s not in linear]
        scores.sort(key=lambda e: (round(e[0], 12), open_.index(e[1])))
        last = share >= 1 - 1e-9
        kept = 0 if last else max(1, len(scores) // factor)
        done += [(s, round_, rows, error) for error, s in scores[kept:]]
        if last:
            break
        open_, share, round_ = [s for _, s in scores[:kept]], min(1.0, share * factor), round_ + 1
    done.sort(key=lambda e: (-e[1], e[3]))
    table = [(i + 1, s.model, s.fill, s.text(), r, n, e) for i, (s, r, n, e) in enumerate(done)]
    return train.sparkSession.createDataFrame(table, "rank int, model string, fill string, parameters string, round int, rows bigint, rmse double")
