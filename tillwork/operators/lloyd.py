"""K-means for several numbers of clusters at once, on raw, scaled or reduced vectors.

Every round reads the points once and serves all numbers of clusters: a task adds up,
for each of them, the points nearest to each centre, and sends only the sums.
Scaling and principal components come from the means and products of one earlier
aggregate, so points are transformed where they are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators.balls import matrix
from tillwork.session import materialise

METHODS = ("raw", "scaled", "pca")
#: Points, by hash, among which the first centres are chosen; all points take part in the rounds.
FIRST_SAMPLE = 5_000


def _joined(a, b):
    """Number, mean and sums of products around it of two sets of vectors."""
    if a is None:
        return b
    (n, mean, spread), (k, m, s) = a, b
    gap, total = m - mean, n + k
    return total, mean + gap * (k / total), spread + s + np.outer(gap, gap) * (n * k / total)


def moments(points: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, mean and covariance of the vectors in ``v``, from one row of sums for each task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0))
                m = x.mean(axis=0)
                total = _joined(total, (len(x), m, (x - m).T @ (x - m)))
        if total is not None:
            n, m, s = total
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([m]), pa.array([s.ravel()])], ["n", "m", "s"])

    total = None
    for r in points.select("v").mapInArrow(add, "n bigint, m array<double>, s array<double>").collect():
        total = _joined(total, (r["n"], np.array(r["m"]), np.array(r["s"]).reshape(len(r["m"]), -1)))
    n, mean, spread = total or (0, None, None)
    if not n:
        raise ValueError("no vectors")
    return n, mean, spread / n


def transformation(points: DataFrame, method: str, variance: float = 0.95) -> tuple[np.ndarray, np.ndarray]:
    """Shift and matrix of ``(v - shift) @ matrix`` for a method; ``pca`` keeps as many components as reach the share of variance."""
    if method not in METHODS:
        raise ValueError(f"method is one of {', '.join(METHODS)}")
    _, mean, cov = moments(points)
    if method == "raw":
        return np.zeros_like(mean), np.eye(len(mean))
    if method == "scaled":
        sd = np.sqrt(np.diag(cov))
        return mean, np.diag(1 / np.where(sd > 0, sd, 1.0))
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = int(np.searchsorted(np.cumsum(values) / max(values.sum(), 1e-300), variance - 1e-12) + 1)
    return mean, vectors[:, : min(kept, len(values))]


def first_centres(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centres among the rows of ``x``, each drawn by its squared distance to those before."""
    chosen = [x[rng.integers(len(x))]]
    nearest = ((x - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k:
        total = nearest.sum()
        chosen.append(x[rng.choice(len(x), p=nearest / total)] if total > 0 else x[rng.integers(len(x))])
        nearest = np.minimum(nearest, ((x - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1))


def kmeans(df: DataFrame, vector: str, ks: Sequence[int], method: str = "raw", seed: int = 42, max_iter: int = 50, tol: float = 1e-6
           ) -> tuple[DataFrame, dict[int, float]]:
    """``df`` with a column ``cluster_<k>`` for each number of clusters, and the inertia of each.

    Inertia is the sum of squared distances to the nearest centre, in the space
    of the method.  A centre that loses all points stays where it is.  Rounds
    end for a number of clusters when no centre moves by more than ``tol`` of
    the spread.  Null vectors get no cluster.
    """
    points = materialise(df.select(F.col(vector).cast("array<double>").alias("v")).filter("v IS NOT NULL"))
    shift, turn = transformation(points, method)
    chosen = points.orderBy(F.xxhash64("v"), "v").limit(FIRST_SAMPLE).collect()
    sample = (np.array([r["v"] for r in chosen]) - shift) @ turn
    centres = {k: first_centres(sample, k, np.random.default_rng(seed + k)) for k in ks}
    scale = max(float(sample.var(axis=0).sum()), 1e-300)
    open_ = set(ks)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([((matrix(batch.column(0)) - shift) @ turn).tobytes()], pa.binary())], ["x"])

    # a round reads blocks of transformed points, not one array after another
    packed, width = materialise(points.mapInArrow(pack, "x binary")), turn.shape[1]

    def sums(of: dict[int, np.ndarray]):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = {k: (np.zeros((k, c.shape[1])), np.zeros(k)) for k, c in of.items()}
            for x in (np.frombuffer(b.as_py()).reshape(-1, width) for batch in batches for b in batch.column(0)):
                for k, c in of.items():
                    label = _squares(x, c).argmin(axis=1)
                    total[k][0][:] += (label == np.arange(k)[:, None]).astype(float) @ x
                    total[k][1][:] += np.bincount(label, minlength=k)
            for k, (s, n) in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([s.ravel()]), pa.array([n])], ["k", "s", "n"])

        return add

    for _ in range(max_iter):
        if not open_:
            break
        found = packed.mapInArrow(sums({k: centres[k] for k in open_}), "k int, s array<double>, n array<double>")
        total: dict[int, list] = {}
        for r in found.collect():  # a few sums of each task; an iterator would read the partitions one by one
            s, n = np.array(r["s"]).reshape(r["k"], -1), np.array(r["n"])
            total[r["k"]] = [s, n] if r["k"] not in total else [total[r["k"]][0] + s, total[r["k"]][1] + n]
        for k, (s, n) in total.items():
            new = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], centres[k])
            if ((new - centres[k]) ** 2).sum(axis=1).max() <= tol**2 * scale:
                open_.discard(k)
            centres[k] = new

    @F.arrow_udf("array<struct<label int, square double>>")
    def nearest(vectors: pa.Array) -> pa.Array:
        live = np.flatnonzero(~np.array(vectors.is_null()))
        x = (matrix(vectors.take(pa.array(live))) - shift) @ turn if len(live) else np.zeros((0, turn.shape[1]))
        squares = [_squares(x, centres[k]) for k in ks]
        label = np.stack([s.argmin(axis=1) for s in squares], axis=1).astype(np.int32) if len(live) else np.zeros((0, len(ks)), np.int32)
        square = np.stack([s.min(axis=1) for s in squares], axis=1) if len(live) else np.zeros((0, len(ks)))
        entries = pa.StructArray.from_arrays([pa.array(label.ravel()), pa.array(square.ravel())], ["label", "square"])
        sizes = np.zeros(len(vectors) + 1, np.int32)
        sizes[live + 1] = len(ks)
        return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), entries, mask=pa.array(np.array(vectors.is_null()))) if len(vectors) else pa.array(
            [], pa.list_(entries.type))

    marked = materialise(df.withColumn("_near", nearest(F.col(vector).cast("array<double>"))))
    inertia = marked.agg(*[F.sum(F.col("_near")[i]["square"]).alias(f"s{i}") for i in range(len(ks))]).first()
    labelled = marked.select(*df.columns, *[F.col("_near")[i]["label"].alias(f"cluster_{k}") for i, k in enumerate(ks)])
    return labelled, {k: float(inertia[i] or 0.0) for i, k in enumerate(ks)}
