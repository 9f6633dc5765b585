"""Data-quality rules and column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.hashing import digest_sum, row_digest
from tillwork.functions.numeric import divide, finite
from tillwork.operators.clean import columns_of_type
from tillwork.operators.ordered import quantile_row, top_per_key
from tillwork.session import attach_row


def check_rules(df: DataFrame, rules: dict[str, Column], types: dict[str, str] | None = None) -> DataFrame:
    """Evaluate row rules and column types in one pass: ``(rule, checked, violations, success)``.

    A rule is a boolean column; rows where it is NULL are not checked.  The
    result layout is ours, since the surveyed checks come from another package.
    """
    parts = []
    exprs = [F.count(F.lit(1)).alias("_all")]
    for i, (name, rule) in enumerate(rules.items()):
        exprs += [F.count(rule).alias(f"_n{i}"), F.count(F.when(~rule, 1)).alias(f"_v{i}")]
        parts.append(F.struct(F.lit(name).alias("rule"), F.col(f"_n{i}").alias("checked"),
                              F.col(f"_v{i}").alias("violations")))
    for column, expected in (types or {}).items():
        wrong = df.schema[column].dataType.simpleString() != expected
        parts.append(F.struct(
            F.lit(f"{column} is {expected}").alias("rule"), F.col("_all").alias("checked"),
            (F.col("_all") if wrong else F.lit(0).cast("bigint")).alias("violations")))
    table = df.agg(*exprs).select(F.inline(F.array(*parts)))
    return table.withColumn("success", F.col("violations") == 0)


def equal_rounded(a: Column, b: Column, digits: int = 2) -> Column:
    """Rule: two columns agree after half-even rounding."""
    return F.bround(a, digits) == F.bround(b, digits)


def missing_proportions(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Per column: rows, missing rows and missing share, in one scan."""
    names = [c for c in (columns or df.columns) if c not in by]
    table = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"_c{i}") for i, c in enumerate(names)]
    )
    pairs = [F.struct(F.lit(c).alias("column"), (F.col("n_rows") - F.col(f"_c{i}")).alias("n_missing"))
             for i, c in enumerate(names)]
    long = table.select(*by, "n_rows", F.inline(F.array(*pairs)))
    return long.withColumn("missing_share", divide("n_missing", "n_rows"))


def columns_missing_over(df: DataFrame, threshold: float) -> list[str]:
    """Columns whose missing share exceeds the threshold."""
    rows = missing_proportions(df).filter(F.col("missing_share") > threshold).collect()
    return [r["column"] for r in rows]


def distinct_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, value, n)`` over all columns, values as text, NULLs left out.

    One shuffle on (column, value) serves every column; equal values are
    combined before it.
    """
    names = list(columns or df.columns)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in names]).unpivot(
        [], [F.col(c) for c in names], "column", "value"
    )
    return long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def variable_summary(
    df: DataFrame, columns: Sequence[str] | None = None, samples: int = 3, approximate: bool = False
) -> DataFrame:
    """Per column: type, number of distinct values, and its first values in text order."""
    names = list(columns or df.columns)
    types = F.create_map(*[F.lit(x) for c in names for x in (c, df.schema[c].dataType.simpleString())])
    values = distinct_values(df, names)
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in names])
        unique = row.unpivot([], [F.col(c) for c in names], "column", "n_unique")
    else:
        unique = values.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
    first = top_per_key(values, ["column"], [F.col("value")], samples, rank="_at")
    first = first.groupBy("column").agg(
        F.concat_ws(", ", F.transform(F.array_sort(F.collect_list(F.struct("_at", "value"))), lambda s: s["value"]))
        .alias("samples"))
    return unique.join(first, "column").select(
        "column", types[F.col("column")].alias("dtype"), "n_unique", "samples")


def data_health(df: DataFrame) -> DataFrame:
    """Long ``(metric, value)``: shape, column kinds, missing and duplicate percentages."""
    digest = row_digest(df.columns)
    per_row = df.select(digest.alias("_d"), *[F.col(c).isNull().cast("int").alias(f"_m{i}")
                                              for i, c in enumerate(df.columns)])
    counts = per_row.groupBy("_d").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(sum((F.col(f"_m{i}") for i in range(len(df.columns))), F.lit(0))).alias("missing"),
    )
    row = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_rows"),
                     F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"))
    width = len(df.columns)
    numbers, texts, dates = (len(columns_of_type(df, k)) for k in ("number", "string", "date"))
    metrics = {
        "rows": F.col("rows").cast("double"),
        "columns": F.lit(float(width)),
        "numeric_columns": F.lit(float(numbers + dates)),
        "other_columns": F.lit(float(width - numbers - dates)),
        "text_columns": F.lit(float(texts)),
        "missing_pct": F.bround(divide(F.col("missing") * 100, F.col("rows") * width), 4),
        "duplicate_rows_pct": F.bround(divide((F.col("rows") - F.col("distinct_rows")) * 100, "rows"), 4),
    }
    pairs = [F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in metrics.items()]
    return row.select(F.inline(F.array(*pairs)))


def duplicate_columns(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Pairs of columns that agree on every row.

    Columns are first compared by an order-insensitive sum of (key, value)
    digests; only pairs with equal sums are compared value by value.
    """
    names = [c for c in df.columns if c not in key]
    sums = df.agg(*[digest_sum(row_digest([*key, c])).alias(f"_{i}") for i, c in enumerate(names)]).first()
    pairs = [(names[i], names[j]) for i in range(len(names)) for j in range(i + 1, len(names))
             if sums[i] is not None and sums[i] == sums[j]
             and df.schema[names[i]].dataType == df.schema[names[j]].dataType]
    schema = "column string, duplicate_of string"
    if not pairs:
        return df.sparkSession.createDataFrame([], schema)
    tests = df.agg(*[F.min(F.col(a).eqNullSafe(F.col(b))).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(b).alias("column"), F.lit(a).alias("duplicate_of"), F.col(f"_{i}").alias("same"))
            for i, (a, b) in enumerate(pairs)]
    return tests.select(F.inline(F.array(*rows))).filter("same").drop("same")


def outlier_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per numeric column: rows beyond mean +/- 3 sd, beyond 1.5 IQR, and infinite values.

    Infinities are counted on the raw column; the other rules ignore them.
    """
    values = df.select(*[finite(c).alias(c) for c in columns],
                       *[(F.abs(F.col(c)) == float("inf")).alias(f"_inf_{c}") for c in columns])
    stats = values.agg(*[x for c in columns for x in (F.avg(c).alias(f"_m_{c}"), F.stddev_samp(c).alias(f"_s_{c}"))])
    bounds = stats.crossJoin(quantile_row(values, columns, [0.25, 0.75]))
    checked = attach_row(values, bounds)
    exprs, parts = [], []
    for i, c in enumerate(columns):
        m, s, x = F.col(f"_m_{c}"), F.col(f"_s_{c}"), F.col(c)
        q1, q3 = F.col(f"{c}_q0"), F.col(f"{c}_q1")
        exprs += [
            F.count(F.when((x < m - 3 * s) | (x > m + 3 * s), 1)).alias(f"_sd{i}"),
            F.count(F.when((x < q1 - 1.5 * (q3 - q1)) | (x > q3 + 1.5 * (q3 - q1)), 1)).alias(f"_iqr{i}"),
            F.count(F.when(F.col(f"_inf_{c}"), 1)).alias(f"_inf{i}"),
        ]
        parts.append(F.struct(F.lit(c).alias("column"), F.col(f"_sd{i}").alias("n_sd"),
                              F.col(f"_iqr{i}").alias("n_iqr"), F.col(f"_inf{i}").alias("n_inf")))
    return checked.agg(*exprs).select(F.inline(F.array(*parts)))
