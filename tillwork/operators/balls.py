"""Extreme distances within and between clusters, with most pairs of points left out.

Points of a cluster that lie together are packed in a block, known by the ball
around its mean.  By the triangle inequality the distances between two blocks lie
between the distance of their centres less and plus both radii.  Pairs of blocks
are visited in rounds, those with the best bound first, and left out as soon as
their bound cannot beat what was found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.session import materialise

#: Points of a block, blocks whose centres are compared in one go, and pairs of blocks of the first round.
BLOCK_ROWS, CENTRES, FIRST_ROUND = 1_024, 1_024, 64
#: Bytes of the blocks of a group whose pairs with another group are visited in one task, and most such tasks of a round.
CELL_BYTES, CELL_TASKS = 16 << 20, 256
#: Directions whose signs tell which points of a cluster lie together.
DIRECTIONS = 12
#: Covers rounding of the bounds.
MARGIN = 1e-9
#: Points compared in one product, differences written out in one go, and the share of the squared lengths below which
#: a squared distance is found by plain differences.
PRODUCT_ROWS, DIFFERENCES, NEAR = 256, 2**19, 1e-4
#: Points of one label that meet others of it in one go.
SUM_ROWS = 4_096


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances by one matrix product, around the mean of ``y``.

    Points that lie together lose digits in a product; their distances come from
    plain differences, so equal points give exactly 0.
    """
    with np.errstate(invalid="ignore", over="ignore"):  # as plain differences do with missing or huge values
        broken = [~np.isfinite(np.einsum("ij,ij->i", t, t)) for t in (x, y)]
        sound = y[~broken[1]] if broken[1].any() else y
        centre = sound.mean(axis=0) if len(sound) else 0.0
        a, b = (np.where(bad[:, None], 0.0, t - centre) if bad.any() else t - centre for t, bad in zip((x, y), broken))
    long, wide = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    out = np.empty((len(x), len(y)))
    right, most = np.vstack([b.T, np.ones(len(y)), wide]), wide.max(initial=0.0)
    for i in range(0, len(x), PRODUCT_ROWS):
        part = slice(i, i + PRODUCT_ROWS)
        d = np.matmul(np.column_stack([-2 * a[part], long[part], np.ones(len(a[part]))]), right, out=out[part])
        row, col = np.nonzero(d < NEAR * (long[part] + most)[:, None])
        near = d[row, col] < NEAR * (long[part][row] + wide[col])
        row, col = row[near], col[near]
        d[row, col] = _plain(x[part], y, row, col)
    with np.errstate(invalid="ignore", over="ignore"):
        for i in np.flatnonzero(broken[0]):
            out[i] = ((y - x[i]) ** 2).sum(axis=1)
        for j in np.flatnonzero(broken[1]):
            out[:, j] = ((x - y[j]) ** 2).sum(axis=1)
    return out


def _plain(x: np.ndarray, y: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Squared distances of some pairs by plain differences."""
    out, step = np.empty(len(row)), max(1, DIFFERENCES // max(1, x.shape[1]))
    for i in range(0, len(row), step):
        diff = y[col[i : i + step]] - x[row[i : i + step]]
        out[i : i + step] = (diff * diff).sum(axis=1)
    return out


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances; equal points give exactly 0."""
    d = squares(x, y)
    return np.sqrt(d, out=d)


def matrix(lists: pa.Array) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _places(mean: np.ndarray):
    """The orthant of each point around the mean of all, after some fixed directions."""
    directions = np.random.default_rng(17).standard_normal((len(mean), DIRECTIONS))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                signs = (matrix(batch.column("v")) - mean) @ directions > 0
                yield batch.append_column("place", pa.array(signs @ (1 << np.arange(DIRECTIONS))[::-1], pa.int32()))

    return place


def _packed(rows: int):
    """Consecutive points of one label as blocks: label, centre, radius, the point next to the centre, and all points."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, held = None, []

        def block() -> pa.RecordBatch:
            points = np.array(held)
            centre = points.mean(axis=0)
            far = distances(centre[None, :], points)[0]
            return pa.RecordBatch.from_arrays(
                [pa.array([label], kind), pa.array([centre]), pa.array([far.max()]), pa.array([points[far.argmin()]]), pa.array([points.ravel()]), pa.array([len(held)], pa.int64())],
                ["c", "centre", "radius", "middle", "points", "n"])

        for batch in batches:
            kind = batch.column("c").type
            for c, v in zip(batch.column("c").to_pylist(), matrix(batch.column("v")) if batch.num_rows else []):
                if held and (c != label or len(held) == rows):
                    yield block()
                    held = []
                label = c
                held.append(v)
        if held:
            yield block()

    return pack


def blocks_of(df: DataFrame, vector: str, label: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(b, c, centre, radius, middle, points, n) for each block of points with one label; null labels and vectors take no part."""
    rows = df.select(F.col(label).alias("c"), F.col(vector).cast("array<double>").alias("v")).dropna()
    sums = rows.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m")).orderBy("i").collect()
    kind = df.schema[label].dataType.simpleString()
    near = rows.mapInArrow(_places(np.array([r["m"] for r in sums])), f"c {kind}, v array<double>, place int")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["c", "place", F.xxhash64("v")]
    packed = near.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("place").mapInArrow(
        _packed(block_rows), f"c {kind}, centre array<double>, radius double, middle array<double>, points array<double>, n bigint")
    return materialise(packed.withColumn("b", F.monotonically_increasing_id()))


def _bounds(farthest: bool, apart: bool, limit: float | None):
    """Without a limit the best distance between middles, else the pairs of blocks whose bound beats it, and how many there are."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for same, left, right in zip(*(batch.column(i) for i in range(3))):
                x, y = left.values, right.values
                labels = [np.unique(np.array(t.field("c").to_pylist(), object).astype(str), return_inverse=True) for t in (x, y)]
                names = [t[0][t[1]] for t in labels]
                fits = (names[0][:, None] != names[1]) if apart else (names[0][:, None] == names[1])
                if same.as_py():
                    fits &= (np.triu if not apart else lambda m: np.triu(m, 1))(np.ones_like(fits))
                if limit is None:
                    d = distances(matrix(x.field("middle")), matrix(y.field("middle")))[fits]
                    best = (d.max() if farthest else d.min()) if len(d) else None
                    yield pa.RecordBatch.from_arrays([pa.array([best], pa.float64())], ["best"])
                    continue
                wide = x.field("radius").to_numpy()[:, None] + y.field("radius").to_numpy()
                d = distances(matrix(x.field("centre")), matrix(y.field("centre")))
                bound = d + wide if farthest else np.maximum(0.0, d - wide)
                a, b = np.nonzero(fits & ((bound + MARGIN > limit) if farthest else (bound - MARGIN < limit)))
                yield pa.RecordBatch.from_arrays(
                    [x.field("b").take(pa.array(a)), y.field("b").take(pa.array(b)), pa.array(-bound[a, b] if farthest else bound[a, b]), pa.nulls(len(a), pa.int64())],
                    ["a", "b", "bound", "pairs"])
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64()), pa.array([int(fits.sum())], pa.int64())],
                                                 ["a", "b", "bound", "pairs"])

    return compare


def _meet(farthest: bool):
    """The extreme distance of the pairs of blocks of each cell; a cell's blocks come before its pairs."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, best = None, {}, None
        for batch in batches:
            for h, g, a, b, points, n in zip(*(batch.column(i) for i in range(6))):
                if (h.as_py(), g.as_py()) != cell:
                    cell, held = (h.as_py(), g.as_py()), {}
                if b.is_valid:
                    d = squares(held[a.as_py()], held[b.as_py()])
                    here = math.sqrt(d.max() if farthest else d.min())
                    best = here if best is None else max(best, here) if farthest else min(best, here)
                else:
                    held[a.as_py()] = points.values.to_numpy(zero_copy_only=False).reshape(n.as_py(), -1).copy()
        yield pa.RecordBatch.from_arrays([pa.array([best], pa.float64())], ["best"])

    return meet


def _cell_groups(count: int, size: int, tasks: int) -> int:
    """Groups that so many blocks of ``size`` bytes are cut into; their pairs are the cells, at least as many as tasks."""
    return max(1, -(-count // max(1, CELL_BYTES // (size + 1))), min(count, math.ceil(math.sqrt(2 * tasks))))


def _in_cells(pairs: DataFrame, points: DataFrame, groups: int) -> DataFrame:
    """(h, g, a, b, points, n): the blocks that the pairs of two groups of blocks need, each once, and then the pairs."""
    group = lambda c: F.pmod(F.xxhash64(c), F.lit(groups))
    one, other = F.struct(group("a").alias("g"), F.col("a").alias("b")), F.struct(group("b").alias("g"), "b")
    sides = pairs.select(F.least(one, other).alias("x"), F.greatest(one, other).alias("y"))
    asked = sides.select(F.col("x.g").alias("h"), F.col("y.g").alias("g"), F.col("x.b").alias("a"), F.col("y.b").alias("b"))
    needed = asked.select("h", "g", F.explode(F.array("a", "b")).alias("a")).distinct()
    sent = needed.join(points.withColumnRenamed("b", "a"), "a").select("h", "g", "a", F.lit(None).cast("bigint").alias("b"), "points", "n")
    asked = asked.select("h", "g", "a", "b", F.lit(None).cast("array<double>").alias("points"), F.lit(None).cast("bigint").alias("n"))
    parts = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(CELL_TASKS, groups * (groups + 1) // 2))
    return sent.unionByName(asked).repartition(parts, "h", "g").sortWithinPartitions("h", "g", F.col("b").isNotNull(), "a")


def extreme(blocks: DataFrame, farthest: bool, apart: bool) -> tuple[float | None, int, int]:
    """The smallest or largest distance between points of different labels, or of one label; pairs of blocks, and those visited.

    One label's points also meet themselves, so its largest distance is 0 at least.
    """
    spark, count = blocks.sparkSession, blocks.count()
    groups = max(1, -(-count // CENTRES))
    packed = blocks.withColumn("g", F.pmod(F.xxhash64("b"), F.lit(groups)).cast("int")).groupBy("g").agg(
        F.collect_list(F.struct("b", "c", "centre", "radius", "middle")).alias("held"))
    left = packed.select(F.col("g").alias("h"), F.explode(F.sequence("g", F.lit(groups - 1))).alias("g"), F.col("held").alias("one"))
    pairs = left.join(packed.select("g", F.col("held").alias("other")), "g").select((F.col("h") == F.col("g")).alias("same"), "one", "other")
    better = F.max if farthest else F.min
    found = pairs.mapInArrow(_bounds(farthest, apart, None), "best double").agg(better("best")).first()[0]
    if found is None:
        return None, 0, 0
    schema = "a bigint, b bigint, bound double, pairs bigint"
    open_ = materialise(pairs.mapInArrow(_bounds(farthest, apart, found), schema))
    total, size, visited = open_.agg(F.sum("pairs")).first()[0], FIRST_ROUND, 0
    points = blocks.select("b", "points", "n")
    cells = _cell_groups(count, 8 * points.agg(F.max(F.size("points"))).first()[0], int(spark.conf.get("spark.sql.shuffle.partitions")))
    open_ = open_.filter("a IS NOT NULL").select("a", "b", "bound")
    while True:
        last = open_.orderBy("bound", "a", "b").limit(size)
        last = materialise(last)
        here = last.agg(F.count("*"), F.max(F.struct("bound", "a", "b"))).first()
        if not here[0]:
            return found, total, visited
        visited += here[0]
        seen = _in_cells(last, points, cells).mapInArrow(_meet(farthest), "best double").agg(better("best")).first()[0]
        found = max(found, seen) if farthest else min(found, seen)
        edge = F.struct(*[F.lit(here[1][k]).alias(k) for k in ("bound", "a", "b")])
        beats = F.col("bound") < (MARGIN - found if farthest else found + MARGIN)
        open_ = open_.filter((F.struct("bound", "a", "b") > edge) & beats)
        size *= 4


def sums_within(blocks: DataFrame) -> DataFrame:
    """(c, total, size): sum of the distances of all pairs of points of each label, a quadratic number of terms by definition.

    Blocks of a label are joined to groups of some ``SUM_ROWS`` points, which meet
    in a Cartesian product that reads them where they are stored: a label with most
    of the points is spread as well, and nothing is sent once for each pair.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, same, x, n, y, m in zip(*(batch.column(i) for i in range(6))):
                x, y = (v.values.to_numpy(zero_copy_only=False).reshape(k.as_py(), -1) for v, k in ((x, n), (y, m)))
                total = sum(float(distances(x[i : i + PRODUCT_ROWS], y).sum()) for i in range(0, len(x), PRODUCT_ROWS)) / (2 if same.as_py() else 1)
                yield pa.RecordBatch.from_arrays([pa.array([c.as_py()], batch.column(0).type), pa.array([total])], ["c", "total"])

    kind, tasks = blocks.schema["c"].dataType.simpleString(), int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = blocks.groupBy("c").agg(F.sum("n").alias("size"), F.max("n").alias("most"))
    group = F.floor((F.row_number().over(Window.partitionBy("c").orderBy("b")) - 1) / F.greatest(F.lit(1), F.floor(F.lit(SUM_ROWS) / F.col("most"))))
    groups = blocks.select("b", "c", "n").join(sizes.select("c", "most"), "c").select("b", "c", group.alias("g"))
    groups = materialise(groups)
    parts = max(1, min(groups.select("c", "g").distinct().count(), math.ceil(math.sqrt(8 * tasks))))
    packed = materialise(blocks.drop("c").join(groups, "b").repartition(parts, "c", "g").groupBy("c", "g").agg(
        F.flatten(F.collect_list("points")).alias("points"), F.sum("n").alias("n")))
    other = packed.select(F.col("c").alias("c2"), F.col("g").alias("g2"), F.col("points").alias("y"), F.col("n").alias("m"))
    pairs = packed.join(other.hint("shuffle_replicate_nl"), (F.col("c") == F.col("c2")) & (F.col("g") <= F.col("g2")))
    totals = pairs.select("c", (F.col("g") == F.col("g2")).alias("same"), "points", "n", "y", "m").mapInArrow(add, f"c {kind}, total double")
    return totals.groupBy("c").agg(F.sum("total").alias("total")).join(sizes.drop("most"), "c")
