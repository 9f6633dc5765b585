"""Recommendation: utility tables, neighbours, ratings, candidates, evaluation.

Interactions stay in long form ``(user, item, value)``; wide tables are made
only for a fixed list of items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.functions.hashing import hash_order, hash_prefix
from tillwork.functions.numeric import any_of, divide
from tillwork.operators import factors
from tillwork.operators.joins import keep_missing
from tillwork.operators.metrics import regression_metrics
from tillwork.operators.neighbours import neighbour_search, user_neighbours  # noqa: F401
from tillwork.operators.ordered import dense_ids, top_per_key
from tillwork.session import LOCAL_ROWS, attach_row, dealt, materialise, small_side

#: Items handled together in one array or matrix.
ITEM_BLOCK = 10_000


# ---- utility tables --------------------------------------------------------

def utility(df: DataFrame, user: str, item: str, value: str | None = None, agg: str = "count") -> DataFrame:
    """Long user-by-item table: interaction counts, or an aggregate of a value."""
    rows = df.filter(F.col(user).isNotNull() & F.col(item).isNotNull())
    expr = F.count(F.lit(1)).cast("double") if value is None else F.expr(f"{agg}(`{value}`)").cast("double")
    return rows.groupBy(user, item).agg(expr.alias("value"))


def utility_matrix(
    df: DataFrame, user: str, pivots: dict[str, Sequence], value: str | None = None, agg: str = "count"
) -> DataFrame:
    """Wide zero-filled table over fixed levels of one or several columns.

    Column names are ``<column>_<level>``.  The aggregate applies to every
    pivot column, also to a single one.  All columns come from one grouping.
    """
    def cell(column: str, level) -> Column:
        hit = F.col(column) == F.lit(level)
        if value is None:
            return F.count(F.when(hit, 1)).cast("double")
        fn = {"sum": F.sum, "mean": F.avg, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}[agg]
        return F.coalesce(fn(F.when(hit, F.col(value))).cast("double"), F.lit(0.0))

    exprs = [cell(c, v).alias(f"{c}_{v}") for c, levels in pivots.items() for v in levels]
    used = any_of([F.col(c).isNotNull() for c in pivots])
    return df.filter(F.col(user).isNotNull() & used).groupBy(user).agg(*exprs)


def aligned_utility(
    train: DataFrame, test: DataFrame, user: str, item: str, levels: Sequence, value: str | None = None, agg: str = "count"
) -> tuple[DataFrame, DataFrame]:
    """Train and test matrices over the same columns, each from its own rows."""
    return tuple(utility_matrix(df, user, {item: levels}, value, agg) for df in (train, test))


def unseen_items(users: DataFrame, seen: DataFrame, items: DataFrame, user: str, item: str) -> DataFrame:
    """Every (user, item) pair that is not in ``seen``.

    The catalog is cut into blocks of items; each user meets each block once
    and subtracts the block items already seen, so the pairs are written out
    only at the end and no pair is joined or deduplicated.
    """
    catalog = items.select(item).dropna().distinct()
    size = catalog.count()
    blocks = max(1, -(-size // ITEM_BLOCK))
    block = F.pmod(F.xxhash64(item), F.lit(blocks))
    packed = catalog.withColumn("_block", block).groupBy("_block").agg(F.collect_list(item).alias("_items"))
    packed = F.broadcast(packed) if size <= LOCAL_ROWS else packed
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))
    asked = users.select(user).dropna().distinct().withColumn("_block", F.explode(numbers))
    had = seen.select(user, item).dropna().withColumn("_block", block).groupBy(user, "_block").agg(
        F.collect_set(item).alias("_seen"))
    pairs = asked.join(had, [user, "_block"], "left").join(packed, "_block")
    left = F.array_except("_items", F.coalesce("_seen", F.array().cast(packed.schema["_items"].dataType)))
    return pairs.select(user, F.explode(left).alias(item))


def top_items(scores: DataFrame, user: str, item: str, score: str, n: int) -> DataFrame:
    """The ``n`` best items per user with their rank, ties by item."""
    return top_per_key(scores, [user], [F.desc(score), F.col(item)], n, rank="rank")


def as_lists(ranked: DataFrame, user: str, item: str, score: str) -> DataFrame:
    """One row per user with the ordered array of ``(item, score)``."""
    packed = ranked.groupBy(user).agg(F.array_sort(F.collect_list(F.struct("rank", item, score))).alias("_r"))
    return packed.select(user, F.transform(
        "_r", lambda s: F.struct(s[item].alias("item"), s[score].alias("score"))).alias("recommendations"))


# ---- nearest users ---------------------------------------------------------

def neighbour_scores(
    long: DataFrame, neighbours: DataFrame, user: str, item: str, value: str = "value", k: int = 10
) -> DataFrame:
    """Propensity of every user for the items of the neighbourhood: ``(user, item, score)``.

    A user's own value stands where it is not 0; otherwise the mean over the
    ``k`` neighbours, zeros included.  The exact value 1 becomes -1, which
    marks an item as bought.
    """
    theirs = long.select(F.col(user).alias("neighbour"), item, value)
    means = neighbours.select(user, "neighbour").join(theirs, "neighbour").groupBy(user, item).agg(
        F.max(F.when(F.col("neighbour") == F.col(user), F.col(value))).alias("_own"),
        (F.sum(value) / k).alias("_mean"))
    own = F.coalesce("_own", F.lit(0.0))
    score = F.when(own != 0, own).when(F.col("_mean") > 0, F.col("_mean")).otherwise(0.0)
    return means.select(user, item, F.when(score == 1, -1.0).otherwise(score).alias("score"))


def recommend_from_neighbours(
    long: DataFrame, neighbours: DataFrame, user: str, item: str, n: int, value: str = "value", k: int = 10
) -> DataFrame:
    return top_items(neighbour_scores(long, neighbours, user, item, value, k), user, item, "score", n)


# ---- ratings ---------------------------------------------------------------

def rescale(df: DataFrame, column: str, low: float, high: float, name: str | None = None) -> DataFrame:
    """Min-max rescale a rating column to a range; the bounds used are kept for the inverse."""
    ends = df.agg(F.min(column).cast("double").alias("_from"), F.max(column).cast("double").alias("_to"))
    share = divide(F.col(column) - F.col("_from"), F.col("_to") - F.col("_from"))
    return attach_row(df, ends).withColumn(name or column, share * (high - low) + low)


def rescale_inverse(df: DataFrame, column: str, low: float, high: float, name: str | None = None) -> DataFrame:
    """Back from the range to the bounds kept by ``rescale``."""
    share = (F.col(column) - low) / (high - low)
    return df.withColumn(name or column, share * (F.col("_to") - F.col("_from")) + F.col("_from"))


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), c))


#: Ratings of a user up to which all of them may stay in one partition.
USER_RATINGS = 100_000


def ratings_by_user(ratings: DataFrame, user: str, item: str, rating: str, *more: str) -> DataFrame:
    """The ratings as a stored table, in partitions by user unless one user has very many."""
    rows = materialise(ratings.select(user, item, rating, *more))
    sizes = rows.groupBy(user).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    return dealt(rows, [user], sizes[0]) if sizes[0] and sizes[1] <= USER_RATINGS else rows


def baselines(
    ratings: DataFrame, user: str, item: str, rating: str, epochs: int = 10, damp_user: float = 15.0, damp_item: float = 10.0,
    stored: bool = False,
) -> tuple[float, DataFrame, DataFrame]:
    """Global mean, user biases and item biases by damped alternating means.

    The ratings are dealt to partitions by user once, so that a turn shuffles
    only sums of items; ``stored`` ones come from ``ratings_by_user``.
    """
    ratings = ratings if stored else ratings_by_user(ratings, user, item, rating)
    mean = ratings.agg(F.avg(rating)).first()[0]
    if mean is None:
        raise ValueError("no ratings")
    users = None
    for epoch in range(epochs):
        rows = ratings.join(users, user) if users is not None else ratings.withColumn("b_user", F.lit(0.0))
        items = rows.groupBy(item).agg(
            (F.sum(F.col(rating) - mean - F.col("b_user")) / (damp_item + F.count(F.lit(1)))).alias("b_item"))
        items = small_side(items)  # a catalog; spares the ratings a shuffle on hot items
        users = ratings.join(items, item).groupBy(user).agg(
            (F.sum(F.col(rating) - mean - F.col("b_item")) / (damp_user + F.count(F.lit(1)))).alias("b_user"))
        if epoch % 3 == 2:
            users = materialise(users)
    return mean, users, items


def predict_baseline(targets: DataFrame, model: tuple, user: str, item: str, name: str = "prediction") -> DataFrame:
    """``mean + user bias + item bias``; an unknown user or item has no bias."""
    mean, users, items = model
    rows = targets.join(items, item, "left").join(users, user, "left")
    value = F.lit(mean) + F.coalesce("b_user", F.lit(0.0)) + F.coalesce("b_item", F.lit(0.0))
    return rows.withColumn(name, value).select(*targets.columns, name)


def one_rating_per_pair(ratings: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """Mean rating of each (user, item): bounds a user's list by the catalog, however often they rated."""
    return ratings.select(user, item, rating).dropna().groupBy(user, item).agg(
        F.avg(F.col(rating).cast("double")).alias(rating))


#: Items of a user that are paired in one row; longer lists are paired block by block.
PAIR_BLOCK = 1024


def item_pairs(ratings: DataFrame, user: str, item: str, rating: str, block: int = PAIR_BLOCK, fold: str | None = None, folds: int = 1) -> DataFrame:
    """Co-rating statistics ``(i, j, n, si, sj, sii, sjj, sij)`` of ordered item pairs, i and j different.

    A user's items are packed by blocks of the catalog, and blocks meet in
    pairs, so no row is larger than a block and a user with very many items is
    spread over many rows.  The pairs are made and summed up on the map side;
    a task ships one row per item pair.

    With a column ``fold`` (0 to ``folds`` - 1, the same for all ratings of a pair of
    user and item) there is a row for each fold, with its number in ``fold``: the
    statistics without the ratings of that fold.  They are the sums of all pairs
    less those of the pairs that touch the fold, so all folds come from one run.
    """
    one = one_rating_per_pair(ratings, user, item, rating)
    if fold is not None:
        one = ratings.select(user, item, rating, fold).dropna().groupBy(user, item).agg(
            F.avg(F.col(rating).cast("double")).alias(rating), F.min(fold).cast("int").alias("_fold"))
    blocks = max(1, -(-one.select(item).distinct().count() // block))
    entry = [F.col(item).alias("i"), F.col(rating).alias("r"), *([F.col("_fold").alias("f")] if fold is not None else [])]
    packed = one.withColumn("_block", F.pmod(F.xxhash64(item), F.lit(blocks))).groupBy(user, "_block").agg(F.collect_list(F.struct(*entry)).alias("_left"))
    if blocks == 1:
        both = packed.withColumn("_right", F.col("_left")).withColumn("_other", F.col("_block"))
    else:
        packed = materialise(packed)
        other = packed.select(F.col(user).alias("_u"), F.col("_block").alias("_other"), F.col("_left").alias("_right"))
        both = packed.join(other, (F.col(user) == F.col("_u")) & (F.col("_block") <= F.col("_other")))
    # within a block each pair is taken from its smaller item, across blocks it is met once
    pairs = both.select(F.explode("_left").alias("a"), "_right", (F.col("_block") < F.col("_other")).alias("_apart"))
    pairs = pairs.select("a", F.explode(F.filter("_right", lambda b: F.col("_apart") | (F.col("a.i") < b["i"]))).alias("b"))
    x, y = F.col("a.r"), F.col("b.r")
    terms = {"n": F.lit(1.0), "si": x, "sj": y, "sii": x * x, "sjj": y * y, "sij": x * y}
    sums = [F.sum(t).alias(c) for c, t in terms.items()]
    if fold is not None:
        touches = lambda k: (F.col("a.f") == k) | (F.col("b.f") == k)
        sums += [F.coalesce(F.sum(F.when(touches(k), t)), F.lit(0.0)).alias(f"{c}{k}") for k in range(folds) for c, t in terms.items()]
    found = pairs.groupBy(F.col("a.i").alias("i"), F.col("b.i").alias("j")).agg(*sums)
    if fold is not None:
        without = [F.struct(F.lit(k).alias("fold"), *[(F.col(c) - F.col(f"{c}{k}")).alias(c) for c in terms]) for k in range(folds)]
        found = found.select("i", "j", F.inline(F.array(*without))).filter("n > 0")
    found = materialise(found)
    kept = ["fold"] if fold is not None else []
    mirrored = found.select(F.col("j").alias("i"), F.col("i").alias("j"), *kept, "n", F.col("sj").alias("si"), F.col("si").alias("sj"),
                            F.col("sjj").alias("sii"), F.col("sii").alias("sjj"), "sij")
    return found.select("i", "j", *kept, *terms).unionByName(mirrored)


def _per_target(targets: DataFrame, ratings: DataFrame, pairs: DataFrame, user: str, item: str, rating: str, weight: str):
    """Rows (user, item, j, r, w): each target with the user's rated items that have a pair entry."""
    rated = one_rating_per_pair(ratings, user, item, rating).select(
        F.col(user).alias("_u"), F.col(item).alias("j"), F.col(rating).alias("r"))
    rows = targets.select(user, item).distinct().join(rated, F.col(user) == F.col("_u")).drop("_u")
    # a target meets all items of its user, so the rows are many times the ratings: they should not be shuffled on hot items
    return rows.join(small_side(pairs.select(F.col("i").alias(item), "j", F.col(weight).alias("w"))), [item, "j"])


def _fold_targets(
    targets: DataFrame, ratings: DataFrame, pairs: DataFrame, user: str, item: str, rating: str, weight: str, k: int | None,
) -> DataFrame:
    """Per target: ``s0 = sum w``, ``s1 = sum w r`` and ``n`` over the user's rated items with an entry (i, j).

    With ``k``, only the k entries of largest weight count and weights must be positive.
    """
    rows = _per_target(targets, ratings, pairs, user, item, rating, weight)
    if k is not None:
        rows = rows.filter(F.col("w") > 0)
        if pairs.select("j").distinct().limit(k + 1).count() > k:  # fewer rated items need no ranking
            rows = top_per_key(rows, [user, item], [F.desc("w"), F.col("j")], k)
    return rows.groupBy(user, item).agg(
        F.sum("w").alias("s0"), F.sum(F.col("w") * F.col("r")).alias("s1"), F.count(F.lit(1)).cast("double").alias("n"))


def slope_one(
    ratings: DataFrame, targets: DataFrame, user: str, item: str, rating: str, name: str = "prediction", pairs: DataFrame | None = None
) -> DataFrame:
    """User mean plus the mean deviation between the item and the items the user rated.

    Without a co-rated item the prediction is the user mean, for unknown users the global mean.
    ``pairs`` are the statistics of ``item_pairs``, where they are known.
    """
    pairs = (item_pairs(ratings, user, item, rating) if pairs is None else pairs).withColumn("dev", (F.col("si") - F.col("sj")) / F.col("n"))
    folded = _fold_targets(targets, ratings, pairs, user, item, rating, "dev", None)
    folded = folded.select(user, item, (F.col("s0") / F.col("n")).alias("_dev"))
    users = ratings.groupBy(user).agg(F.avg(rating).alias("_mu"))
    overall = ratings.agg(F.avg(rating).alias("_all"))
    rows = attach_row(targets.join(users, user, "left").join(folded, [user, item], "left"), overall)
    value = F.coalesce("_mu", "_all") + F.coalesce("_dev", F.lit(0.0))
    return rows.withColumn(name, value).select(*targets.columns, name)


def item_similarities(ratings: DataFrame, user: str, item: str, rating: str, measure: str = "msd", pairs: DataFrame | None = None) -> DataFrame:
    """Item similarities over co-rating users: mean squared difference, cosine or Pearson."""
    p = item_pairs(ratings, user, item, rating) if pairs is None else pairs
    n = F.col("n")
    value = {
        "msd": 1.0 / (1.0 + (F.col("sii") + F.col("sjj") - 2 * F.col("sij")) / n),
        "cosine": divide("sij", F.sqrt(F.col("sii") * F.col("sjj"))),
        "pearson": divide(n * F.col("sij") - F.col("si") * F.col("sj"),
                          F.sqrt(n * F.col("sii") - F.col("si") * F.col("si")) * F.sqrt(n * F.col("sjj") - F.col("sj") * F.col("sj"))),
    }[measure]
    return p.select("i", "j", "n", value.alias("sim"))


def item_knn(
    ratings: DataFrame, targets: DataFrame, user: str, item: str, rating: str, variant: str = "means", k: int = 40,
    measure: str = "msd", name: str = "prediction", user_based: bool = False, pairs: DataFrame | None = None,
) -> DataFrame:
    """Neighbour predictions: ``basic``, ``means``, ``zscore`` or ``baseline``.

    Ratings are centred (and scaled) per variant, averaged over the ``k`` most
    similar items the user rated, and brought back to the target item's level.
    Without neighbours that level alone, for unknown items the global mean.
    ``user_based`` swaps the roles: the ``k`` most similar users who rated the
    item, and the level of the target's user; it pairs the users of each item.
    """
    if user_based:
        return item_knn(ratings, targets, item, user, rating, variant, k, measure, name, pairs=pairs)
    pairs = item_similarities(ratings, user, item, rating, measure, pairs)
    overall = ratings.agg(F.avg(rating).alias("_all"))
    if variant == "baseline":
        ratings = ratings_by_user(ratings, user, item, rating)
        model = baselines(ratings, user, item, rating, stored=True)
        centred = predict_baseline(ratings, model, user, item, "_level").withColumn("_scale", F.lit(1.0))
        level = predict_baseline(targets, model, user, item, "_level").withColumn("_scale", F.lit(1.0))
    else:
        stats = small_side(ratings.groupBy(item).agg(F.avg(rating).alias("_m"), F.stddev_pop(rating).alias("_s")))
        zero, one = F.lit(0.0), F.lit(1.0)
        shift = zero if variant == "basic" else F.col("_m")
        scale = F.when(F.col("_s") > 0, F.col("_s")).otherwise(one) if variant == "zscore" else one
        if variant not in ("basic", "means", "zscore"):
            raise ValueError("variant is 'basic', 'means', 'zscore' or 'baseline'")
        centred = ratings.join(stats, item).withColumns({"_level": shift, "_scale": scale})
        level = targets.join(stats, item, "left").withColumns({"_level": shift, "_scale": scale})
    centred = centred.select(user, item, ((F.col(rating) - F.col("_level")) / F.col("_scale")).alias("_c"))
    folded = _fold_targets(targets, centred, pairs, user, item, "_c", "sim", k)
    folded = folded.select(user, item, (F.col("s1") / F.col("s0")).alias("_gain"))
    rows = attach_row(level.join(folded, [user, item], "left"), overall)
    base = F.when(F.col("_gain").isNull(), F.col("_all")).otherwise(F.lit(0.0)) if variant == "basic" else F.coalesce("_level", "_all")
    value = base + F.coalesce(F.col("_scale"), F.lit(1.0)) * F.coalesce("_gain", F.lit(0.0))
    return rows.withColumn(name, value).select(*targets.columns, name)


def normal_predictor(
    ratings: DataFrame, targets: DataFrame, user: str, item: str, rating: str, seed: int = 42, name: str = "prediction"
) -> DataFrame:
    """Draws from a normal distribution with the ratings' mean and sd, fixed by key and seed."""
    def uniform(tag: str) -> Column:
        return (hash_prefix(hash_order([user, item], f"{seed}{tag}"), 7) + 0.5) / F.lit(float(16**7))

    z = F.sqrt(-2 * F.ln(uniform("a"))) * F.cos(2 * math.pi * uniform("b"))
    stats = ratings.agg(F.avg(rating).alias("_m"), F.stddev_pop(rating).alias("_s"))
    return attach_row(targets, stats).withColumn(name, F.col("_m") + F.col("_s") * z).select(*targets.columns, name)


def co_clustering(
    ratings: DataFrame, targets: DataFrame, user: str, item: str, rating: str, user_clusters: int = 3,
    item_clusters: int = 3, epochs: int = 5, seed: int = 0, name: str = "prediction",
) -> DataFrame:
    """Co-clustering: averages of co-clusters, corrected by user and item offsets.

    Each epoch is three aggregations over the ratings; cluster averages are a
    handful of numbers, and assignments are checkpointed tables.
    """
    base = materialise(ratings.select(user, item, F.col(rating).cast("double").alias("_r")).dropna())
    u_mean = base.groupBy(user).agg(F.avg("_r").alias("_um"))
    i_mean = base.groupBy(item).agg(F.avg("_r").alias("_im"))
    overall = base.agg(F.avg("_r")).first()[0]
    start = lambda key, n: F.pmod(hash_prefix(hash_order([key], seed), 6), F.lit(n))
    u = materialise(u_mean.withColumn("_uc", start(user, user_clusters)))
    i = small_side(i_mean.withColumn("_ic", start(item, item_clusters)))

    def averages(u: DataFrame, i: DataFrame):
        cells = base.join(u.select(user, "_uc"), user).join(i.select(item, "_ic"), item).groupBy("_uc", "_ic").agg(
            F.sum("_r").alias("s"), F.count(F.lit(1)).alias("n")).collect()
        s, n = np.zeros((user_clusters, item_clusters)), np.zeros((user_clusters, item_clusters))
        for r in cells:
            s[r["_uc"], r["_ic"]], n[r["_uc"], r["_ic"]] = r["s"], r["n"]
        mean = lambda a, b: np.where(b > 0, a / np.maximum(b, 1), overall)
        return mean(s.sum(1), n.sum(1)), mean(s.sum(0), n.sum(0)), mean(s, n)

    def pick(values, column: Column) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), column + 1)

    def cell(co: np.ndarray, row, col) -> Column:
        if isinstance(row, int):
            return pick(co[row], col)
        return pick(co[:, col], row)

    for _ in range(epochs):
        ua, ia, co = averages(u, i)
        rows = base.join(u, user).join(i, item)
        item_part = F.col("_im") - pick(ia, F.col("_ic"))
        cost = [F.sum(F.pow(F.col("_r") - (cell(co, c, F.col("_ic")) + F.col("_um") - float(ua[c]) + item_part), 2)).alias(f"_e{c}")
                for c in range(user_clusters)]
        best = rows.groupBy(user).agg(*cost)
        least = F.array_min(F.array(*[F.struct(F.col(f"_e{c}").alias("e"), F.lit(c).alias("c")) for c in range(user_clusters)]))["c"]
        u = materialise(u_mean.join(best.select(user, least.alias("_uc")), user))
        ua, ia, co = averages(u, i)
        rows = base.join(u, user).join(i, item)
        user_part = F.col("_um") - pick(ua, F.col("_uc"))
        cost = [F.sum(F.pow(F.col("_r") - (cell(co, F.col("_uc"), c) + F.col("_im") - float(ia[c]) + user_part), 2)).alias(f"_e{c}")
                for c in range(item_clusters)]
        best = rows.groupBy(item).agg(*cost)
        least = F.array_min(F.array(*[F.struct(F.col(f"_e{c}").alias("e"), F.lit(c).alias("c")) for c in range(item_clusters)]))["c"]
        i = small_side(i_mean.join(best.select(item, least.alias("_ic")), item))
    ua, ia, co = averages(u, i)
    rows = targets.join(u, user, "left").join(i, item, "left")
    flat = pick(co.ravel(), F.col("_uc") * item_clusters + F.col("_ic"))
    both = flat + F.col("_um") - pick(ua, F.col("_uc")) + F.col("_im") - pick(ia, F.col("_ic"))
    value = F.coalesce(both, F.col("_um"), F.col("_im"), F.lit(overall))
    return rows.withColumn(name, value).select(*targets.columns, name)


# ---- factor models ---------------------------------------------------------

#: Ratings of a block of the factor models, and blocks there are at least; a task holds a block, with the factors it needs.
BLOCK_RATINGS, BLOCKS = 500_000, 10


def _als(coded: DataFrame, **settings) -> ALSModel:
    """Factors of ``coded`` ratings (_uid, _iid, _r), in as many blocks as they need."""
    blocks = max(BLOCKS, -(-coded.count() // BLOCK_RATINGS))
    return ALS(userCol="_uid", itemCol="_iid", ratingCol="_r", numUserBlocks=blocks, numItemBlocks=BLOCKS, **settings).fit(coded)


def als_predict(
    ratings: DataFrame, targets: DataFrame, user: str, item: str, rating: str, rank: int = 8, reg: float = 0.1,
    max_iter: int = 8, nonnegative: bool = False, seed: int = 42, name: str = "prediction",
) -> DataFrame:
    """Explicit factor model by alternating least squares; unknown users or items get the global mean."""
    users = materialise(dense_ids(ratings, [user], "_uid"))
    items = small_side(dense_ids(ratings, [item], "_iid"))
    coded = ratings.join(users, user).join(items, item).select("_uid", "_iid", F.col(rating).cast("float").alias("_r"))
    model = _als(materialise(coded), rank=rank, regParam=reg, maxIter=max_iter, nonnegative=nonnegative, seed=seed, coldStartStrategy="nan")
    asked = targets.join(users, user, "left").join(items, item, "left")
    scored = model.transform(asked.withColumns({"_uid": F.coalesce("_uid", F.lit(-1)), "_iid": F.coalesce("_iid", F.lit(-1))}))
    rows = attach_row(scored, ratings.agg(F.avg(rating).alias("_all")))
    value = F.when(F.isnan("prediction") | F.col("prediction").isNull(), F.col("_all")).otherwise(F.col("prediction").cast("double"))
    return rows.withColumn("_value", value).select(*targets.columns, F.col("_value").alias(name))


def als_implicit(
    interactions: DataFrame, user: str, item: str, value: str, n: int, users: DataFrame | None = None, rank: int = 8,
    reg: float = 0.1, alpha: float = 10.0, max_iter: int = 8, seed: int = 42, keep_seen: bool = False,
) -> DataFrame:
    """Top-n unseen items per user from an implicit factor model: ``(user, item, score, rank)``.

    The lists are exact (``factors.best_products``): a user reads the items by
    falling length of their factors, until none can enter the list any more.
    """
    user_ids = materialise(dense_ids(interactions, [user], "_uid"))
    item_ids = small_side(dense_ids(interactions, [item], "_iid"))
    coded = interactions.join(user_ids, user).join(item_ids, item).groupBy("_uid", "_iid").agg(
        F.sum(value).cast("float").alias("_r"))
    model = _als(materialise(coded), rank=rank, regParam=reg, alpha=alpha, maxIter=max_iter, implicitPrefs=True, seed=seed)
    wanted = user_ids if users is None else user_ids.join(users.select(user).distinct(), user, "left_semi")
    left = model.userFactors.select(F.col("id").alias("_uid"), "features").join(wanted, "_uid").select(user, "features")
    right = model.itemFactors.select(F.col("id").alias("_iid"), "features").join(item_ids, "_iid").select(item, "features")
    return factors.best_products(left, right, user, item, "features", n, None if keep_seen else interactions.select(user, item))[0]


# ---- explicit models by name -----------------------------------------------

MODELS = ("svd", "nmf", "slopeone", "baselineonly", "normalpredictor", "knnbasic", "knnwithmeans", "knnwithzscore",
          "knnbaseline", "coclustering")


def fit_predict(
    model: str, ratings: DataFrame, targets: DataFrame, user: str, item: str, rating: str,
    scale: tuple[float, float] | None = None, **params,
) -> DataFrame:
    """Train the named model on ``ratings`` and predict ``targets``, within the rating scale."""
    args = (ratings, targets, user, item, rating)
    if model == "baselineonly":
        out = predict_baseline(targets, baselines(ratings, user, item, rating, **params), user, item)
    elif model == "svd":
        out = factors.predict_factors(targets, factors.biased_factors(ratings, user, item, rating, **params), user, item)
    elif model == "nmf":
        out = als_predict(*args, nonnegative=True, **params)
    elif model == "slopeone":
        out = slope_one(*args, **params)
    elif model == "normalpredictor":
        out = normal_predictor(*args, **params)
    elif model == "coclustering":
        out = co_clustering(*args, **params)
    elif model in ("knnbasic", "knnwithmeans", "knnwithzscore", "knnbaseline"):
        out = item_knn(*args, variant=model.removeprefix("knn").removeprefix("with"), **params)
    else:
        raise ValueError(f"unknown model {model!r}, choose from {MODELS}")
    return out.withColumn("prediction", clamp(F.col("prediction"), *scale)) if scale else out


def rank_items(
    model: str, ratings: DataFrame, users: DataFrame, items: DataFrame, user: str, item: str, rating: str, n: int = 0,
    unseen_only: bool = False, **params,
) -> DataFrame:
    """Rank the given items for the given users; ``n`` of 0 or less ranks all of them.

    Every given item is ranked, rated ones too, as the surveyed flow does;
    ``unseen_only`` leaves out what a user has rated.  One row is made for each
    pair of a user and an item that is asked for.
    """
    targets = unseen_items(users, ratings if unseen_only else ratings.limit(0), items, user, item)
    scored = fit_predict(model, ratings, targets, user, item, rating, **params)
    if n > 0:
        return top_items(scored, user, item, "prediction", n)
    order = Window.partitionBy(user).orderBy(F.desc("prediction"), item)
    return scored.withColumn("rank", F.row_number().over(order))


def compare_models(
    ratings: DataFrame, user: str, item: str, rating: str, models: Sequence[str] = MODELS, folds: int = 3, seed: int = 42,
    scale: tuple[float, float] | None = None,
) -> DataFrame:
    """Cross-validated RMSE and MAE per model, best first; folds by hash of the pair.

    The models that use pairs of items share one run over the pairs for all
    folds and variants, and all models the ratings in partitions by user.
    """
    marked = ratings.withColumn("_fold", F.pmod(hash_prefix(hash_order([user, item], seed), 6), F.lit(folds)))
    folded = ratings_by_user(marked, user, item, rating, "_fold")
    by_pairs = [m for m in models if m == "slopeone" or m.startswith("knn")]
    pairs = item_pairs(folded, user, item, rating, fold="_fold", folds=folds) if by_pairs else None
    results = []
    for model in models:
        for k in range(folds):
            train = folded.filter(F.col("_fold") != k).drop("_fold")
            test = folded.filter(F.col("_fold") == k).drop("_fold")
            known = {"pairs": pairs.filter(F.col("fold") == k).drop("fold")} if model in by_pairs else {}
            scored = fit_predict(model, train, test, user, item, rating, scale, **known)
            m = regression_metrics(scored, rating, "prediction").select("n", "rmse", "mae").first()
            results.append((model, k, m["n"], m["rmse"], m["mae"]))
    table = ratings.sparkSession.createDataFrame(results, "model string, fold int, n bigint, rmse double, mae double")
    return table.groupBy("model").agg(F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae")).orderBy("rmse")


# ---- graph features --------------------------------------------------------

def neighbour_mean(
    edges: DataFrame, source: str, target: str, features: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Mean of the sources' features per target of the distinct edges."""
    links = edges.select(source, target).dropna().distinct()
    joined = links.join(features.select(F.col(key).alias(source), *columns), source)
    return joined.groupBy(target).agg(*[F.avg(c).alias(c) for c in columns])


def two_hop_mean(
    edges: DataFrame, user: str, item: str, features: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """User features averaged to items and back to users: the aggregation of a two-layer graph model."""
    per_item = neighbour_mean(edges, user, item, features, user, columns)
    return neighbour_mean(edges, item, user, per_item, item, columns)


def drop_seen(scores: DataFrame, seen: DataFrame, user: str, item: str) -> DataFrame:
    return keep_missing(scores, seen, [user, item])
