"""Joins, key-set analysis and pre-join checks.

No operator hints a broadcast of a data-dependent side: Spark broadcasts below
its size threshold and otherwise runs a sort-merge join, whose hot keys are
split at run time (skew join settings in ``session``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.numeric import all_of


def _pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    return [(k, k) if isinstance(k, str) else tuple(k) for k in on]


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    counts = df.filter(all_of([F.col(k).isNotNull() for k in keys])).groupBy(*keys)
    return counts.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail if a master table repeats a key (the many-to-one check of a merge)."""
    found = duplicate_keys(df, keys).limit(1).collect()
    if found:
        raise ValueError(f"key {list(keys)} is not unique, e.g. {found[0]}")
    return df


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on,
    how: str = "inner",
    validate: bool = False,
    null_matches: bool = False,
) -> DataFrame:
    """Fact-to-dimension join on ``on`` (names, or (fact, dim) pairs); dim keys are dropped.

    ``null_matches`` treats NULL keys as equal, as the surveyed merges do;
    by default such rows do not match.
    """
    pairs = _pairs(on)
    if validate:
        require_unique(dim, [b for _, b in pairs])
    right = dim.withColumnsRenamed({b: f"_dim_{b}" for _, b in pairs})
    test = [
        F.col(a).eqNullSafe(F.col(f"_dim_{b}")) if null_matches else F.col(a) == F.col(f"_dim_{b}")
        for a, b in pairs
    ]
    joined = fact.join(right, all_of(test), how)
    return joined.drop(*[f"_dim_{b}" for _, b in pairs])


def keep_matching(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows whose key is in ``keys`` (semi join)."""
    return _filter_join(df, keys, on, "left_semi")


def keep_missing(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows whose key is not in ``keys`` (anti join)."""
    return _filter_join(df, keys, on, "left_anti")


def _filter_join(df: DataFrame, keys: DataFrame, on, how: str) -> DataFrame:
    pairs = _pairs(on)
    right = keys.select(*[F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(pairs)]).distinct()
    return df.join(right, all_of([F.col(a) == F.col(f"_k{i}") for i, (a, _) in enumerate(pairs)]), how)


def orphan_impact(fact: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Fact rows without a dimension row: keys, rows and their share in percent.

    Facts are counted per key first, so a key that holds most of the rows
    reaches the join as one row.
    """
    pairs = _pairs(on)
    counts = fact.groupBy(*[a for a, _ in pairs]).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(*[F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(pairs)]).distinct()
    known = known.withColumn("_known", F.lit(True))
    joined = counts.join(known, all_of([F.col(a) == F.col(f"_k{i}") for i, (a, _) in enumerate(pairs)]), "left")
    orphan = F.col("_known").isNull()
    return joined.agg(
        F.count(F.when(orphan, 1)).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("orphan_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
    ).withColumn("orphan_pct", F.bround(F.try_divide(F.col("orphan_rows") * 100.0, F.col("total_rows")), 2))


def key_membership(a: DataFrame, b: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct non-NULL keys of both sides with ``in_a`` / ``in_b``.

    One grouping over the union of both key columns replaces a full outer
    join: equal keys are combined before the shuffle.
    """
    keys = list(keys) if keys else [c for c in a.columns if c in b.columns]
    sides = [
        df.select(*keys, F.lit(in_a).alias("in_a"), F.lit(not in_a).alias("in_b")).dropna(subset=keys)
        for df, in_a in ((a, True), (b, False))
    ]
    return sides[0].unionByName(sides[1]).groupBy(*keys).agg(
        F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b")
    )


def _region_label() -> Column:
    return F.when(F.col("in_a") & F.col("in_b"), "A^B").when(F.col("in_a"), "A-B").otherwise("B-A")


def set_analyse(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str] | None = None,
    simplify: bool = True,
    exceptions_only: bool = False,
) -> DataFrame:
    """Venn analysis of two key sets: long ``(region, n)`` counts, or the members.

    Regions are A-B, B-A, A^B (in both) and AuB (in either).
    """
    members = key_membership(a, b, keys)
    if not simplify:
        members = members.withColumn("region", _region_label()).drop("in_a", "in_b")
        return members.filter(F.col("region") != "A^B") if exceptions_only else members
    only_a, only_b = F.col("in_a") & ~F.col("in_b"), F.col("in_b") & ~F.col("in_a")
    regions = [("A-B", F.count(F.when(only_a, 1))), ("B-A", F.count(F.when(only_b, 1)))]
    if not exceptions_only:
        regions += [("A^B", F.count(F.when(F.col("in_a") & F.col("in_b"), 1))), ("AuB", F.count(F.lit(1)))]
    row = members.agg(*[expr.alias(f"_{i}") for i, (_, expr) in enumerate(regions)])
    pairs = [F.struct(F.lit(name).alias("region"), F.col(f"_{i}").alias("n")) for i, (name, _) in enumerate(regions)]
    return row.select(F.inline(F.array(*pairs)))


def merge_expectations(a: DataFrame, b: DataFrame, on, how: str = "inner") -> DataFrame:
    """One-row report before a join: key-set sizes, type match, NULL keys, warnings.

    A NULL key on either side raises the NULL warning; the surveyed code lets
    the right side overwrite the left.
    """
    pairs = _pairs(on)
    keys = [x for x, _ in pairs]
    right = b.withColumnsRenamed({y: x for x, y in pairs if x != y})
    match = all(a.schema[k].dataType == right.schema[k].dataType for k in keys)
    venn = key_membership(a, right, keys).agg(
        F.count(F.when(F.col("in_a") & ~F.col("in_b"), 1)).alias("a_minus_b"),
        F.count(F.when(F.col("in_b") & ~F.col("in_a"), 1)).alias("b_minus_a"),
        F.count(F.when(F.col("in_a") & F.col("in_b"), 1)).alias("a_and_b"),
        F.count(F.lit(1)).alias("a_or_b"),
    )

    def has_null(df: DataFrame, name: str) -> DataFrame:
        any_null = ~all_of([F.col(k).isNotNull() for k in keys])
        return df.agg(F.coalesce(F.max(any_null), F.lit(False)).alias(name))

    report = venn.crossJoin(has_null(a, "a_nulls")).crossJoin(has_null(right, "b_nulls"))
    loss_b = F.col("b_minus_a") != 0 if how in ("left", "inner") else F.lit(False)
    loss_a = F.col("a_minus_b") != 0 if how in ("right", "inner") else F.lit(False)
    return report.select(
        "*",
        F.lit(match).alias("types_match"),
        (F.col("a_nulls") | F.col("b_nulls")).alias("nulls_warning"),
        loss_b.alias("warn_b_minus_a"),
        loss_a.alias("warn_a_minus_b"),
    )


def merge_info(left: DataFrame, right: DataFrame, merged: DataFrame) -> DataFrame:
    """Rows and columns of both inputs and of the merged table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("frame"), F.lit(len(df.columns)).alias("n_cols"), "n_rows"
        )
        for name, df in (("left_df", left), ("right_df", right), ("merged_df", merged))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def common_groups(train: DataFrame, test: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both frames restricted to the groups they share."""
    return keep_matching(train, test, key), keep_matching(test, train, key)
