"""Factor models: exact best inner products, and biased factors by stochastic gradient steps.

Best items: items are put in blocks by falling length.  A user's n-th score so far
is at least the product of the user's length and that of the next block's longest
item as soon as nothing further can enter the list; blocks are read in rounds, each
as many as all before, by the users that are still open.

Biased factors: users and items are dealt to blocks, ratings to the pair of blocks
they join.  In a turn every block of users meets one block of items, another one in
the next turn, so no two tasks of a turn change the same factors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.operators.balls import matrix
from tillwork.operators.ordered import running_before, top_per_key
from tillwork.session import attach_row, materialise, removed, small_side, written

#: Items and users of a block of the search.
ITEM_ROWS, USER_ROWS = 1_024, 2_048
#: Partitions of the item blocks at least, and blocks of a partition at most where that takes more.
SHARES, SHARE_BLOCKS = 4, 64
#: Covers rounding of the bound.
MARGIN = 1e-9
#: Ratings and factors of a pair of blocks of the gradient steps.
BLOCK_RATINGS, BLOCK_IDS = 1_000_000, 250_000
#: Tasks that sort the ratings of pairs of blocks, at most unless shuffles have more.
CELL_TASKS = 256
#: An item that a step rates more often moves as if it was rated so often.
ITEM_STEPS = 32


# ---- best inner products ----------------------------------------------------

def _length(vector: str) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))


def _scores(n: int):
    """The best of one block of items for each user of a block who has not closed, without what the user has."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for users, items in zip(batch.column(0), batch.column(1)):
                users, items = users.values, items.values
                names, longest = items.field("i"), items.field("length")[0].as_py()
                last, length = users.field("last").to_numpy(zero_copy_only=False), users.field("length").to_numpy()
                use = np.flatnonzero(~(length * longest + MARGIN < last))  # no n-th score yet is NaN
                if not len(use):
                    continue
                s = matrix(users.field("v").take(pa.array(use))) @ matrix(items.field("v")).T
                had = users.field("had").take(pa.array(use))
                place = pc.index_in(had.flatten(), value_set=names).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(use)), np.diff(had.offsets.to_numpy()))[~np.isnan(place)]
                open_ = ~(s + MARGIN < last[use, None])
                open_[row, place[~np.isnan(place)].astype(np.int64)] = False
                row, col = np.nonzero(open_)
                found = s[row, col]
                by_name = pc.rank(names, "ascending", tiebreaker="first").to_numpy()[col]
                order = np.lexsort((by_name, -found, row))
                rank = np.arange(len(order)) - np.searchsorted(row[order], row[order])
                order = order[rank < n]
                yield pa.RecordBatch.from_arrays(
                    [users.field("u").take(pa.array(use[row[order]])), names.take(pa.array(col[order])), pa.array(found[order])], ["u", "i", "score"])

    return score


def _meetings(people: DataFrame, blocks: DataFrame, parts: int, low: int, high: int) -> DataFrame:
    """(users, items): every part of the users with every block from ``low`` to ``high``, a Cartesian product that neither copies nor broadcasts them."""
    tasks = int(people.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = people.withColumn("part", F.pmod(F.xxhash64("u"), F.lit(parts))).repartition(min(parts, tasks), "part").groupBy("part").agg(
        F.collect_list(F.struct("u", "v", "length", "had", "last")).alias("users"))
    read = blocks.filter((F.col("b") >= low) & (F.col("b") < high)).hint("shuffle_replicate_nl")
    return asked.crossJoin(read).select("users", "items")


def best_products(users: DataFrame, items: DataFrame, user: str, item: str, vector: str, n: int, seen: DataFrame | None = None,
                  item_rows: int = ITEM_ROWS, user_rows: int = USER_ROWS) -> tuple[DataFrame, DataFrame]:
    """The ``n`` items with the largest inner product for every user, and what it took.

    The first table is (user, item, score, rank), ties by item; without the pairs
    (user, item) of ``seen``.  The second is (user, blocks, n_blocks): the blocks
    of items that a user read, and that there are.  Exact: a user stops where
    the bound on all further items is below the n-th score.  Null vectors take no
    part; ids are meant to be unique.
    """
    kinds = users.schema[user].dataType.simpleString(), items.schema[item].dataType.simpleString()
    rows = items.select(F.col(item).alias("i"), F.col(vector).cast("array<double>").alias("v")).dropna().withColumn("length", _length("v"))
    rows = rows.withColumns({"short": -F.col("length"), "one": F.lit(1).cast("bigint")})
    placed = running_before(rows.select("i", "short", "one"), [], ["short", "i"], ["one"], False)
    rows = rows.drop("short", "one").join(placed.select("i", F.floor(F.col("one_before") / item_rows).alias("b")), "i")
    size = rows.count()
    shares = max(1, min(-(-size // item_rows), max(SHARES, -(-size // (item_rows * SHARE_BLOCKS)))))
    blocks = materialise(rows.repartition(shares, "b").groupBy("b").agg(F.reverse(F.array_sort(F.collect_list(F.struct("length", "i", "v")))).alias("items")))
    count = blocks.count()
    people = users.select(F.col(user).alias("u"), F.col(vector).cast("array<double>").alias("v")).dropna().withColumn("length", _length("v"))
    has = F.array().cast(f"array<{kinds[1]}>")
    if seen is not None:
        had = seen.select(F.col(user).alias("u"), F.col(item).alias("i")).groupBy("u").agg(F.collect_set("i").alias("had"))
        people = people.join(had, "u", "left").withColumn("had", F.coalesce("had", has))
    else:
        people = people.withColumn("had", has)
    people = materialise(people)
    parts = max(1, -(-people.count() // user_rows))
    open_ = people.withColumns({"last": F.lit(float("nan")), "read": F.lit(0).cast("bigint")})
    best, reads, low, high = None, [], 0, 1
    while True:
        found = _meetings(open_, blocks, parts, low, high).mapInArrow(_scores(n), f"u {kinds[0]}, i {kinds[1]}, score double")
        both = found if best is None else best.unionByName(found)
        best = materialise(top_per_key(both, ["u"], [F.desc("score"), F.col("i")], n))
        low, high = high, 2 * high
        if low >= count:
            reads.append(open_.select("u", F.lit(count).cast("bigint").alias("blocks")))
            break
        full = best.groupBy("u").agg(F.when(F.count("*") >= n, F.min("score")).alias("nth"))
        after = blocks.filter(F.col("b") == low).select(F.col("items")[0]["length"].alias("longest"))
        state = attach_row(open_.drop("last").join(full, "u", "left"), after.agg(F.max("longest").alias("longest")))
        state = materialise(state.withColumn("closed", F.coalesce(F.col("length") * F.col("longest") + MARGIN < F.col("nth"), F.lit(False))))
        reads.append(state.filter("closed").select("u", F.lit(low).cast("bigint").alias("blocks")))
        open_ = state.filter("NOT closed").withColumn("last", F.coalesce("nth", F.lit(float("nan")))).drop("nth", "longest", "closed")
        if not open_.limit(1).count():
            break
    work = reads[0]
    for more in reads[1:]:
        work = work.unionByName(more)
    ranked = top_per_key(best, ["u"], [F.desc("score"), F.col("i")], n, rank="rank")
    return (ranked.select(F.col("u").alias(user), F.col("i").alias(item), "score", "rank"),
            work.select(F.col("u").alias(user), "blocks", F.lit(count).cast("bigint").alias("n_blocks")))


# ---- biased factors ----------------------------------------------------------

def _first(ids: pa.Array, hashes: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """Small factors that depend on the id and the seed only."""
    x = hashes.view(np.uint64)[:, None] ^ (np.arange(1, rank + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x >> np.uint64(11)).astype(np.float64) / 2**53 - 0.5) * 0.2


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ratings of each pair of blocks as one row of flat lists."""
    key, held = None, []

    def cell() -> pa.RecordBatch:
        n, columns = sum(len(t[0]) for t in held), [pa.concat_arrays([t[c] for t in held]) for c in range(3)]
        lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), c) for c in columns]
        return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int64()) for k in key), *lists], ["t", "ub", "ib", "u", "i", "r"])

    for batch in batches:
        if not batch.num_rows:
            continue
        place = [batch.column(c).to_numpy() for c in range(3)]
        starts = np.flatnonzero(np.r_[True, np.any([p[1:] != p[:-1] for p in place], axis=0)])
        for low, high in zip(starts, np.r_[starts[1:], batch.num_rows]):
            here = tuple(int(p[low]) for p in place)
            if held and here != key:
                yield cell()
                held = []
            key = here
            # copies, so that no batch is kept for a part of it
            held.append([pa.array(batch.column(c).slice(low, high - low).to_numpy().copy()) for c in range(3, 6)])
    if held:
        yield cell()


def _turn(mean: float, rank: int, rate: float, reg: float, rounds: int = 1):
    """Gradient steps over the ratings of one pair of blocks; factors are rows of (bias, factors)."""

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                ub, ib, users, items, u, k, r = (batch.column(c)[n] for c in range(7))
                p, q = (x.values.to_numpy(zero_copy_only=False).reshape(-1, rank + 1).copy() for x in (users, items))
                if u.is_valid:
                    u, k, r = (x.values.to_numpy().astype(kind) for x, kind in ((u, np.int64), (k, np.int64), (r, np.float64)))
                    turn = np.arange(len(u)) - np.searchsorted(u, u)  # the user's first rating, second rating, ...
                    stages = np.split(np.argsort(turn, kind="stable"), np.cumsum(np.bincount(turn))[:-1])
                    for at in stages * rounds:
                        _step(p, q, u[at], k[at], r[at] - mean, rate, reg)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(["u", "i"]), pa.array([ub.as_py(), ib.as_py()], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, p.size, p.size + q.size], pa.int32()), pa.array(np.concatenate([p.ravel(), q.ravel()])))],
                    ["side", "block", "factors"])

    return steps


def _step(p: np.ndarray, q: np.ndarray, u: np.ndarray, k: np.ndarray, r: np.ndarray, rate: float, reg: float) -> None:
    """One step for a rating of each of some users; ``r`` are ratings less their mean."""
    a, b = p[u], q[k]
    miss = r - a[:, 0] - b[:, 0] - (a[:, 1:] * b[:, 1:]).sum(axis=1)
    own, theirs = a[:, 0].copy(), b[:, 0].copy()
    a[:, 0] = b[:, 0] = 1.0  # a bias moves by the miss itself
    gain, move = miss[:, None] * a, miss[:, None] * b
    a[:, 0], b[:, 0] = own, theirs
    gain -= reg * b
    move -= reg * a
    p[u] = a + rate * move
    often = np.bincount(k, minlength=len(q))
    total = np.stack([np.bincount(k, column, len(q)) for column in np.ascontiguousarray(gain.T)], axis=1)
    q += rate * total * (np.minimum(often, ITEM_STEPS) / np.maximum(often, 1))[:, None]


def biased_factors(ratings: DataFrame, user: str, item: str, rating: str, rank: int = 8, epochs: int = 12, rate: float = 0.01, reg: float = 0.1,
                   seed: int = 42, blocks: int | None = None) -> tuple[float, DataFrame, DataFrame]:
    """Mean rating, and (id, bias, factors) of users and items: rating = mean + biases + product of the factors.

    Within a pair of blocks the first ratings of all users are one step, then
    their second ones, and so on.  An item rated several times in a step takes
    the mean of its gradients, times at most ``ITEM_STEPS``.  The number of
    blocks follows the ratings and ids; the result depends on it and on the seed,
    not on partitions.  Null ids and ratings are left out.
    """
    rows = materialise(ratings.select(F.col(user).alias("u"), F.col(item).alias("i"), F.col(rating).cast("double").alias("r")).dropna())
    facts = rows.agg(F.avg("r"), F.count("*")).first()
    if facts[0] is None:
        raise ValueError("no ratings")
    mean = float(f"{facts[0]:.12g}")  # the last digits of a sum depend on the order of its partitions
    ids = {c: rows.select(c).distinct() for c in ("u", "i")}
    if blocks is None:
        widest = max(t.count() for t in ids.values())
        blocks = max(1, int(np.ceil(np.sqrt(facts[1] / BLOCK_RATINGS))), -(-widest // BLOCK_IDS))
    packed, placed, sides = {}, {}, []
    for c in ids:
        packed[c] = materialise(ids[c].withColumn("hash", F.xxhash64(c)).withColumn("block", F.pmod(F.col("hash"), F.lit(blocks))).groupBy("block").agg(
            F.array_sort(F.collect_list(F.struct("hash", F.col(c).alias("id")))).alias("all")))
        placed[c] = packed[c].select("block", F.posexplode("all").alias("at", "e")).select("block", "at", F.col("e.id").alias(c))

        def begin(batches: Iterator[pa.RecordBatch], c=c) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, all_ in zip(batch.column(0), batch.column(1)):
                    first = _first(all_.values.field("id"), all_.values.field("hash").to_numpy(), rank, seed)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c]), pa.array([block.as_py()], pa.int64()), pa.array([np.hstack([np.zeros((len(first), 1)), first]).ravel()])], ["side", "block", "factors"])

        sides.append(packed[c].mapInArrow(begin, "side string, block bigint, factors array<double>"))
    # a file for each block: a reader holds all rows of a file at once
    state = written(sides[0].unionByName(sides[1]), "factors", 1)
    coded = rows.join(placed["u"].withColumnsRenamed({"block": "ub", "at": "ua"}), "u").join(
        small_side(placed["i"].withColumnsRenamed({"block": "ib", "at": "ia"})), "i")
    coded = coded.select(F.pmod(F.col("ib") - F.col("ub"), F.lit(blocks)).cast("bigint").alias("t"), F.col("ub").cast("bigint"), F.col("ib").cast("bigint"),
                         F.col("ua").alias("u"), F.col("ia").alias("i"), "r")
    tasks = int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = coded.repartition(max(tasks, min(blocks * blocks, CELL_TASKS)), "ub", "ib").sortWithinPartitions("t", "ub", "ib", "u", "i", "r")
    cells = written(sorted_.mapInArrow(_cells, "t bigint, ub bigint, ib bigint, u array<int>, i array<int>, r array<double>"), "cells", 1, "t")
    # the only pair of a single block meets itself in all turns, so they need no files between them
    for turn in range(epochs * blocks if blocks > 1 else min(epochs, 1)):
        users = state.filter("side = 'u'").select(F.col("block").alias("ub"), F.col("factors").alias("users"))
        items = state.filter("side = 'i'").select(F.col("block").alias("ib"), F.col("factors").alias("items"))
        here = cells.filter(F.col("t") == turn % blocks).drop("t", "ib")
        pair = users.withColumn("ib", F.pmod(F.col("ub") + turn, F.lit(blocks))).join(items, "ib").join(here, "ub", "left")
        after = written(pair.select("ub", "ib", "users", "items", "u", "i", "r").mapInArrow(
            _turn(mean, rank, rate, reg, epochs if blocks == 1 else 1), "side string, block bigint, factors array<double>"), "factors", 1)
        removed(state)
        state = after
    out = []
    for c, name in zip(ids, (user, item)):
        kind = rows.schema[c].dataType.simpleString()

        def name_rows(batches: Iterator[pa.RecordBatch], name=name) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for all_, flat in zip(batch.column(0), batch.column(1)):
                    row = flat.values.to_numpy(zero_copy_only=False).reshape(-1, rank + 1)
                    vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1) * rank, pa.int32()), pa.array(row[:, 1:].ravel()))
                    yield pa.RecordBatch.from_arrays([all_.values.field("id"), pa.array(row[:, 0].copy()), vectors], [name, "bias", "factors"])

        flat = state.filter(F.col("side") == c).select("block", "factors")
        out.append(materialise(packed[c].join(flat, "block").select("all", "factors").mapInArrow(
            name_rows, f"`{name}` {kind}, bias double, factors array<double>")))
    removed(state)
    removed(cells)
    return mean, *out


def predict_factors(targets: DataFrame, model: tuple, user: str, item: str, name: str = "prediction") -> DataFrame:
    """Mean, biases and the product of the factors; an unknown user or item has neither bias nor factors."""
    mean, users, items = model
    sides = [t.select(c, F.col("bias").alias(f"_b{k}"), F.col("factors").alias(f"_f{k}")) for k, (t, c) in enumerate(((users, user), (items, item)))]
    rows = targets.join(sides[0], user, "left").join(sides[1], item, "left")
    product = F.aggregate(F.zip_with("_f0", "_f1", lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)
    value = F.lit(mean) + F.coalesce("_b0", F.lit(0.0)) + F.coalesce("_b1", F.lit(0.0)) + F.coalesce(product, F.lit(0.0))
    return rows.withColumn("_value", value).select(*targets.columns, F.col("_value").alias(name))
