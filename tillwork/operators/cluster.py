"""Clustering jobs, cluster profiles and cluster quality."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tillwork.functions.numeric import divide
from tillwork.operators import balls, lloyd
from tillwork.session import attach_row, materialise

#: Points per block in the exact pairwise measures.
BLOCK_ROWS = 1024
#: Groups that points are cut into where that leaves enough in each, bytes of vectors of a group, and groups of a partition.
GROUPS, GROUP_BYTES, PART_GROUPS = 24, 2 << 20, 16
#: Points of either side whose distances are found and summed up while they are in the cache.
TILE = 1_024


# ---- profiles --------------------------------------------------------------

def cluster_profile(
    df: DataFrame, label: str, columns: Sequence[str], ratio: bool = True, low: float = 0.7, high: float = 1.3
) -> DataFrame:
    """Long ``(feature, cluster, value, overall, flag)``.

    ``value`` is the cluster mean over the overall mean, or the plain mean;
    the flag marks ratios outside ``low`` and ``high``.  Sums and counts per
    cluster serve both the cluster and the overall means.
    """
    names = list(columns)
    sums = df.filter(F.col(label).isNotNull()).groupBy(label).agg(
        *[e for i, c in enumerate(names) for e in (F.sum(c).alias(f"_s{i}"), F.count(c).alias(f"_n{i}"))])
    overall = sums.agg(*[divide(F.sum(f"_s{i}"), F.sum(f"_n{i}")).alias(f"_o{i}") for i in range(len(names))])
    entries = [F.struct(F.lit(c).alias("feature"), divide(f"_s{i}", f"_n{i}").alias("mean"), F.col(f"_o{i}").alias("overall"))
               for i, c in enumerate(names)]
    long = attach_row(sums, overall).select(F.col(label).alias("cluster"), F.inline(F.array(*entries)))
    share = divide("mean", "overall")
    flag = F.when(share < low, "low").when(share > high, "high").otherwise("")
    return long.select("feature", "cluster", (share if ratio else F.col("mean")).alias("value"), "overall", flag.alias("flag"))


# ---- vectors ---------------------------------------------------------------

def as_vectors(df: DataFrame, source, output: str = "features") -> DataFrame:
    """A vector column from one array column or from several numeric columns."""
    if isinstance(source, str):
        return df.withColumn(output, array_to_vector(F.col(source).cast("array<double>")))
    return VectorAssembler(inputCols=list(source), outputCol=output).transform(df)


def pca_reduce(df: DataFrame, variance: float = 0.95, features: str = "features", output: str = "reduced") -> tuple[DataFrame, DataFrame]:
    """Project to as many components as reach the variance share; at least two are required.

    Returns the projected rows and the table of explained variance.
    """
    size = df.select(features).first()[0].size
    full = PCA(k=size, inputCol=features, outputCol=output).fit(df)
    shares = full.explainedVariance.toArray()
    k = int(np.searchsorted(np.cumsum(shares), variance - 1e-12) + 1)
    k = min(k, size)
    if k < 2:
        raise ValueError("one component already explains the requested variance; use the raw data")
    rows = PCA(k=k, inputCol=features, outputCol=output).fit(df).transform(df)
    table = df.sparkSession.createDataFrame(
        [(i + 1, float(v), float(c), i < k) for i, (v, c) in enumerate(zip(shares, np.cumsum(shares)))],
        "component int, explained double, cumulative double, kept boolean")
    return rows, table


def kmeans_sweep(
    df: DataFrame, low: int, high: int, features: str = "features", seed: int = 42, max_iter: int = 20
) -> tuple[DataFrame, dict[int, DataFrame]]:
    """K-means for k = low..high: table of inertia and silhouette per k, and the labelled rows per k."""
    judge = ClusteringEvaluator(featuresCol=features, predictionCol="cluster", metricName="silhouette")
    rows, labelled = [], {}
    for k in range(low, high + 1):
        model = KMeans(k=k, seed=seed, initMode="k-means||", maxIter=max_iter, featuresCol=features, predictionCol="cluster").fit(df)
        labelled[k] = model.transform(df)
        rows.append((k, float(model.summary.trainingCost), float(judge.evaluate(labelled[k]))))
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double"), labelled


def cluster_sweep(
    df: DataFrame, key: str, vector: str, low: int, high: int, method: str = "raw", seed: int = 42, max_iter: int = 50, exact: bool = False
) -> tuple[DataFrame, DataFrame]:
    """K-means for k = low..high on ``raw``, ``scaled`` or ``pca`` vectors, all k in the same rounds (``operators.lloyd``).

    Returns (method, k, inertia, silhouette), and ``df`` with a column
    ``cluster_<k>`` for each k.  The silhouette is the mean over all points, on
    the given vectors: of squared distances at linear cost, or of Euclidean ones
    (``exact``) at quadratic cost.
    """
    ks = list(range(low, high + 1))
    labelled, inertia = lloyd.kmeans(df, vector, ks, method, seed, max_iter)
    rows = []
    for k in ks:
        points = labelled.filter(F.col(vector).isNotNull())
        judged = (silhouette_exact if exact else silhouette_squared)(points, key, vector, f"cluster_{k}")
        rows.append((method, k, inertia[k], judged.agg(F.avg("silhouette")).first()[0]))
    return df.sparkSession.createDataFrame(rows, "method string, k int, inertia double, silhouette double"), labelled


# ---- silhouette with squared distances: linear cost ------------------------

def cell_moments(df: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, i, m, q, n) of the i-th components in each cluster: their mean, their mean square, and the vectors that have one.

    Nulls do not count for the means.  A batch of rows is summed up in one go;
    vectors are not written out component by component.
    """
    kind = df.schema[label].dataType.simpleString()
    rows = df.select(F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy()
            if not sizes.sum():
                continue
            coded, values, width = batch.column(0).dictionary_encode(null_encoding="encode"), batch.column(1).flatten(), int(sizes.max())
            row = np.repeat(np.arange(len(sizes)), sizes)
            cell = coded.indices.to_numpy()[row].astype(np.int64) * width + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            live = values.is_valid().to_numpy(zero_copy_only=False)
            x, at, cells = values.drop_null().to_numpy(), cell[live], len(coded.dictionary) * width
            sums = [np.bincount(c, w, cells).reshape(-1, width) for c, w in ((cell, None), (at, None), (at, x), (at, x * x))]
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary, *(pa.array(list(t.astype(np.int64 if i < 2 else np.float64))) for i, t in enumerate(sums))], ["label", "n", "c", "s", "q"])

    parts = rows.mapInArrow(add, f"label {kind}, n array<bigint>, c array<bigint>, s array<double>, q array<double>")
    cells = parts.select("label", F.posexplode(F.arrays_zip("n", "c", "s", "q")).alias("i", "z")).filter("z.n > 0").groupBy("label", "i").agg(
        *[F.sum(f"z.{c}").alias(c) for c in "ncsq"])
    return cells.select("label", "i", divide("s", "c").alias("m"), divide("q", "c").alias("q"), "n")


def _distances(clusters: list) -> Callable:
    """Mean squared distance of a vector to each cluster; null where a component is missing on either side."""
    whole = [i for i, c in enumerate(clusters) if None not in c["mean"]]
    widths = {w: [i for i in whole if len(clusters[i]["mean"]) == w] for w in {len(clusters[i]["mean"]) for i in whole}}

    @F.arrow_udf("array<double>")
    def distances(vectors: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy()
        gaps = np.zeros(len(vectors), bool)
        held = np.maximum(sizes, 0)
        gaps[np.repeat(np.arange(len(vectors)), held)[~vectors.flatten().is_valid().to_numpy(zero_copy_only=False)]] = True
        out, known = np.zeros((len(vectors), len(clusters))), np.zeros((len(vectors), len(clusters)), bool)
        for width, own in widths.items():
            rows = np.flatnonzero((sizes == width) & ~gaps)
            if len(rows):
                x = balls.matrix(vectors.take(pa.array(rows)))
                mean = np.array([clusters[i]["mean"] for i in own])
                out[np.ix_(rows, own)] = (x * x).sum(axis=1)[:, None] - 2 * x @ mean.T + np.array([clusters[i]["sq"] for i in own])
                known[np.ix_(rows, own)] = True
        return pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1) * len(clusters), pa.int32()), pa.array(out.ravel(), mask=~known.ravel()))

    return distances


def silhouette_squared(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """Silhouette per row with squared Euclidean distances, exact at linear cost.

    The mean squared distance to a cluster follows from its size, mean vector
    and mean squared norm, so only one small row per cluster is compared with
    each data row.  Rows carry plain arrays.
    """
    rows = df.select(key, label, F.col(vector).cast("array<double>").alias("_v"))
    clusters = cell_moments(rows, label, "_v").groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("mean"),
        F.sum("q").alias("sq"), F.max("n").alias("n")).filter("label IS NOT NULL").collect()
    scored = rows.withColumn("_all", _distances(clusters)("_v")) if clusters else rows.withColumn("_all", F.array().cast("array<double>"))
    kind = df.schema[label].dataType
    named = F.array(*[F.struct(F.lit(c["label"]).cast(kind).alias("label"), F.lit(c["n"]).alias("n")) for c in clusters])
    named = named if clusters else F.array().cast(f"array<struct<label:{kind.simpleString()},n:bigint>>")

    def to_cluster(c, d):
        own = c["label"] == F.col(label)
        # a row does not count towards its own cluster's mean distance
        return F.struct(own.alias("own"), c["n"].alias("n"), F.when(own, divide(d * c["n"], c["n"] - 1)).otherwise(d).alias("d"))

    scored = scored.withColumn("_d", F.zip_with(named, "_all", to_cluster))
    a = F.filter("_d", lambda x: x["own"])[0]
    b = F.array_min(F.transform(F.filter("_d", lambda x: ~x["own"]), lambda x: x["d"]))
    value = F.when(a["n"] <= 1, F.lit(0.0)).otherwise(divide(b - a["d"], F.greatest(a["d"], b)))
    return scored.select(key, label, F.coalesce(value, F.lit(0.0)).alias("silhouette"))


# ---- exact pairwise measures -----------------------------------------------

def _block_pairs(df: DataFrame, key: str, vector: str, label: str, block_rows: int, fold, schema: str) -> DataFrame:
    """Fold every pair of groups of points into a few rows.

    Points are cut into evenly filled groups by key hash, of ``block_rows`` points
    at least and some ``GROUP_BYTES`` at most, and packed into one row per group.
    Partitions of groups meet in a Cartesian product, which reads them where they
    are stored and shuffles nothing; each unordered pair of groups meets once in a
    task, which returns aggregates only, never pairs.  The measures that use this
    are quadratic by definition; ``silhouette_squared`` is the linear choice.
    """
    rows = df.select(F.col(key).alias("k"), F.col(label).alias("c"), F.col(vector).cast("array<double>").alias("v"))
    count, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    held = max(block_rows, min(-(-count // GROUPS), GROUP_BYTES // (8 * max(1, width or 0))))
    groups, tasks = max(1, -(-count // held)), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(groups, max(-(-groups // PART_GROUPS), math.ceil(math.sqrt(8 * tasks))))
    packed = rows.withColumn("b", F.pmod(F.xxhash64("k"), F.lit(groups)).cast("int")).repartition(parts, "b").groupBy("b").agg(
        F.collect_list(F.struct("k", "c", "v")).alias("points"))
    packed = materialise(packed)
    left = packed.select(F.col("b").alias("a"), F.col("points").alias("left"))
    right = packed.select("b", F.col("points").alias("right"))
    pairs = left.join(right.hint("shuffle_replicate_nl"), F.col("a") <= F.col("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, x, y in zip(*(batch.column(i) for i in range(4))):
                found = fold(a.as_py() == b.as_py(), _points(x.values), _points(y.values))
                yield from pa.Table.from_pandas(found, fields, preserve_index=False).to_batches()

    fields = to_arrow_schema(StructType.fromDDL(schema))
    return pairs.select("a", "b", "left", "right").mapInArrow(run, schema)


def _points(packed):
    keys, labels = (np.array(packed.field(c).to_pylist()) for c in ("k", "c"))
    vectors = packed.field("v")
    whole = not vectors.null_count and len(np.unique(np.diff(vectors.offsets.to_numpy()))) == 1
    return keys, labels, balls.matrix(vectors) if whole else np.array(vectors.to_pylist(), dtype="float64")


def silhouette_exact(df: DataFrame, key: str, vector: str, label: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Silhouette per row with Euclidean distances; 0 for clusters of one row."""
    key_type = df.schema[key].dataType.simpleString()
    label_type = df.schema[label].dataType.simpleString()

    def fold(same: bool, left, right) -> pd.DataFrame:
        sides = [np.unique(labels, return_inverse=True) for _, labels, _ in (left, right)]
        hot = [(at[:, None] == np.arange(len(kinds))).astype(float) for kinds, at in sides]
        sums = np.zeros((len(left[0]), len(sides[1][0]))), np.zeros((len(right[0]), len(sides[0][0])))
        for i in range(0, len(left[0]), TILE):
            for j in range(0, len(right[0]), TILE):
                rows, cols = slice(i, i + TILE), slice(j, j + TILE)
                d = balls.distances(left[2][rows], right[2][cols])
                sums[0][rows] += d @ hot[1][cols]
                if not same:
                    sums[1][cols] += d.T @ hot[0][rows]
        parts = []
        for (keys, _, _), (kinds, _), n, s in ((left, sides[1], hot[1], sums[0]), (right, sides[0], hot[0], sums[1])):
            parts.append(pd.DataFrame({"k": np.repeat(keys, len(kinds)), "c": np.tile(kinds, len(keys)), "s": s.ravel(),
                                       "n": np.tile(n.sum(axis=0).astype(int), len(keys))}))
            if same:
                break
        return pd.concat(parts)

    sums = _block_pairs(df, key, vector, label, block_rows, fold, f"k {key_type}, c {label_type}, s double, n bigint")
    sums = sums.groupBy("k", "c").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    own = df.select(F.col(key).alias("k"), F.col(label).alias("_own"))
    joined = sums.join(own, "k")
    mine = F.col("c") == F.col("_own")
    stats = joined.groupBy("k", "_own").agg(
        F.max(F.when(mine, divide("s", F.col("n") - 1))).alias("a"), F.max(F.when(mine, F.col("n"))).alias("n"),
        F.min(F.when(~mine, divide("s", "n"))).alias("b"))
    value = F.when(F.col("n") <= 1, F.lit(0.0)).otherwise(divide(F.col("b") - F.col("a"), F.greatest("a", "b")))
    return stats.select(F.col("k").alias(key), F.col("_own").alias(label), F.coalesce(value, F.lit(0.0)).alias("silhouette"))


def _by_label(side):
    """Points of one group, by their labels."""
    order = np.argsort(side[1], kind="stable")
    return tuple(t[order] for t in side)


def label_distances(df: DataFrame, key: str, vector: str, label: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Nearest, farthest and summed distance for every unordered pair of labels."""
    label_type = df.schema[label].dataType.simpleString()

    def fold(same: bool, left, right) -> pd.DataFrame:
        met: dict = {}
        (_, ours, x), (_, theirs, y) = (_by_label(side) for side in (left, right))
        for i in range(0, len(ours), block_rows):
            for j in range(i if same else 0, len(theirs), block_rows):
                rows, cols = slice(i, i + block_rows), slice(j, j + block_rows)
                d = balls.distances(x[rows], y[cols])
                (c, rs, rn), (e, cs, cn) = (np.unique(side, return_index=True, return_counts=True) for side in (ours[rows], theirs[cols]))
                count = rn[:, None] * cn
                off = np.tril_indices(len(d)) if same and i == j else None  # each point of a tile meets the later ones only
                facts = []
                for add, none in ((np.minimum, np.inf), (np.maximum, -np.inf), (np.add, 0.0)):
                    if off is not None:
                        d[off] = none
                    facts.append(add.reduceat(add.reduceat(d, cs, axis=1), rs, axis=0))
                if off is not None:
                    count = np.triu(count, 1) + np.diag(rn * (rn - 1) // 2)
                for r, k in zip(*np.nonzero(count)):
                    pair = (c[r], e[k]) if c[r] <= e[k] else (e[k], c[r])
                    lo, hi, total, n = met.get(pair, (np.inf, -np.inf, 0.0, 0))
                    met[pair] = (min(lo, float(facts[0][r, k])), max(hi, float(facts[1][r, k])), total + float(facts[2][r, k]), n + int(count[r, k]))
        return pd.DataFrame([(*pair, *facts) for pair, facts in met.items()], columns=["c1", "c2", "nearest", "farthest", "total", "pairs"])

    schema = f"c1 {label_type}, c2 {label_type}, nearest double, farthest double, total double, pairs bigint"
    cells = _block_pairs(df, key, vector, label, block_rows, fold, schema)
    return cells.groupBy("c1", "c2").agg(
        F.min("nearest").alias("nearest"), F.max("farthest").alias("farthest"),
        F.sum("total").alias("total"), F.sum("pairs").alias("pairs"))


def _touching(df: DataFrame, vector: str, label: str) -> DataFrame:
    """Pairs of labels (c1 < c2) that share a point."""
    rows = df.select(F.col(vector).cast("array<double>").alias("v"), F.col(label).alias("c")).dropna().distinct()
    labels = rows.groupBy("v").agg(F.array_sort(F.collect_list("c")).alias("cs")).filter(F.size("cs") > 1)
    return labels.select(F.explode("cs").alias("c1"), "cs").select("c1", F.explode("cs").alias("c2")).filter("c1 < c2").distinct()


def dunn_search(
    df: DataFrame, key: str, vector: str, label: str, diameter: str = "farthest", inter: str = "nearest",
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, dict]:
    """``dunn_index``, and for each searched distance how many pairs of blocks there are and were visited.

    Nearest points of different labels and the widest label are searched by
    bounds (``operators.balls``).  Sums of distances (``mean_cluster``) and the
    farthest points of every pair of labels take all pairs, and so do labels that
    share a point, since a pair of labels at distance 0 does not count.
    """
    if diameter not in ("farthest", "mean_cluster") or inter not in ("nearest", "farthest"):
        raise ValueError("diameter is 'farthest' or 'mean_cluster', inter is 'nearest' or 'farthest'")
    spark, blocks, work = df.sparkSession, balls.blocks_of(df, vector, label, block_rows), {}
    if diameter == "farthest":
        width, *work["diameter"] = balls.extreme(blocks, farthest=True, apart=False)
    else:
        sums = balls.sums_within(blocks)
        width = sums.agg(F.max(divide("total", "size"))).first()[0]
    if inter == "nearest" and not _touching(df, vector, label).limit(1).count():
        apart, *work["distance"] = balls.extreme(blocks, farthest=False, apart=True)
    else:
        cells = label_distances(df, key, vector, label, block_rows).filter(F.col("c1") != F.col("c2"))
        apart = cells.agg(F.min(F.when(F.col(inter) > 0, F.col(inter)))).first()[0]
    out = spark.createDataFrame([(apart, width)], "min_distance double, max_diameter double")
    return out.withColumn("dunn", divide("min_distance", "max_diameter")), work


def dunn_index(
    df: DataFrame, key: str, vector: str, label: str, diameter: str = "farthest", inter: str = "nearest",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Smallest non-zero distance between clusters over the largest cluster diameter.

    ``mean_cluster`` divides the sum of pair distances by the cluster's size,
    as the surveyed code does.
    """
    return dunn_search(df, key, vector, label, diameter, inter, block_rows)[0]
