"""Reproducible train/test splits.

Rows are ordered by a hash of their key and a seed, so a split does not
depend on partitioning, task order or engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions.hashing import hash_order
from tillwork.operators.eda import quantile_bin
from tillwork.operators.ordered import quantile_table, take_by_hash, top_per_key


def quantile_edges(df: DataFrame, column: str, bins: int, unique: bool = True) -> list[float]:
    """Exact quantile edges of a column, a short list; repeated edges are an error unless allowed."""
    row = quantile_table(df, [column], [i / bins for i in range(bins + 1)]).first()
    edges = list(row["q"]) if row is not None and row["q"] is not None else []
    if unique and len(set(edges)) != len(edges):
        raise ValueError(f"bin edges of {column!r} are not unique: {edges}")
    return edges


def quantile_bins(df: DataFrame, column: str, bins: int = 10, name: str = "bin") -> DataFrame:
    """Right-closed quantile bins 1..n; equal values always share a bin."""
    edges = [F.lit(e) for e in quantile_edges(df, column, bins)]
    return df.withColumn(name, quantile_bin(column, edges))


def stratified_split(
    df: DataFrame, keys: Sequence[str], by, test_size: float = 0.2, seed: int = 42, name: str = "split"
) -> DataFrame:
    """Mark ``round(test_size * n)`` rows of every stratum as test, the rest as train.

    ``by`` is a column name or a function ``DataFrame -> Column``.  Strata
    belong to their own rows; in the surveyed code they slip after a sort.
    """
    rows = df.withColumn("_stratum", by(df) if callable(by) else F.col(by))
    taken = take_by_hash(rows, keys, seed, {"taken": F.bround(F.lit(test_size) * F.col("n"))}, ["_stratum"])
    return taken.withColumn(name, F.when(F.col("taken"), "test").otherwise("train")).drop("_stratum", "taken")


def stratified_split_numeric(
    df: DataFrame, keys: Sequence[str], target: str, bins: int = 10, test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Stratified split on quantile bins of a numeric target."""
    edges = [F.lit(e) for e in quantile_edges(df, target, bins, unique=False)]
    return stratified_split(df, keys, lambda _: quantile_bin(target, edges), test_size, seed)


def split_per_user(
    df: DataFrame, user: str, keys: Sequence[str], samples: int = 5, fraction: float = 0.3, seed: int = 7,
    name: str = "split",
) -> DataFrame:
    """Seeded test rows per user; only users present on both sides are kept.

    A user with one row has no test row, one with fewer than ``samples`` rows
    gives ``round(fraction * n)``, others give ``samples``.  Only the first
    ``samples`` rows per user are ever ranked; all rows are then compared with
    their user's cut.
    """
    known = df.filter(F.col(user).isNotNull())
    position = F.struct(hash_order(keys, seed).alias("h"), *[F.col(k) for k in keys])
    sizes = known.groupBy(user).agg(F.count(F.lit(1)).alias("_n"))
    want = F.when(F.col("_n") == 1, 0).when(F.col("_n") < samples, F.bround(F.lit(fraction) * F.col("_n"))).otherwise(samples)
    sizes = sizes.withColumn("_want", want.cast("int")).filter((F.col("_want") > 0) & (F.col("_want") < F.col("_n")))
    first = top_per_key(known.select(user, position.alias("_cut")), [user], [F.col("_cut")], samples, rank="_at")
    cuts = first.join(sizes, user).filter(F.col("_at") == F.col("_want")).select(F.col(user).alias("_user"), "_cut")
    marked = known.join(cuts, F.col(user) == F.col("_user"))
    side = F.when(position <= F.col("_cut"), "test").otherwise("train")
    return marked.withColumn(name, side).drop("_user", "_cut")


def split_by_date(df: DataFrame, user: str, date_col: str, after, name: str = "split") -> DataFrame:
    """Test rows are later than ``after``; only users present on both sides are kept."""
    late = F.coalesce(F.col(date_col) > F.lit(after), F.lit(False))
    sides = df.filter(F.col(user).isNotNull()).groupBy(F.col(user).alias("_user")).agg(
        F.max(late).alias("_any"), F.min(late).alias("_all"))
    common = sides.filter(F.col("_any") & ~F.col("_all")).select("_user")
    kept = df.join(common, F.col(user) == F.col("_user"), "left_semi")
    return kept.withColumn(name, F.when(late, "test").otherwise("train"))


def edge_split(
    df: DataFrame, keys: Sequence[str], validation: float = 0.1, test: float = 0.1, seed: int = 42, name: str = "split"
) -> DataFrame:
    """Exact shares of rows for test and validation, the rest for training."""
    n_test, n_val = F.floor(F.lit(test) * F.col("n")), F.floor(F.lit(validation) * F.col("n"))
    both = take_by_hash(df, keys, seed, {"_test": n_test, "_held": n_test + n_val})
    side = F.when(F.col("_test"), "test").when(F.col("_held"), "validation").otherwise("train")
    return both.withColumn(name, side).drop("_test", "_held")
