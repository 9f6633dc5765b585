"""Order-dependent primitives that never put a whole group into one task.

Ranks, exact quantiles, dense ids and exact seeded samples need a global or
per-group order.  Each has two equal paths: where the input was counted and is
small, one window or one ``percentile`` aggregate; otherwise the rows are range-partitioned on (group, value), so that even a group holding most
of the data is spread over many chunks, and only the per-chunk totals (a few
rows per group) are accumulated in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwork.functions.hashing import hash_order, hash_prefix
from tillwork.functions.numeric import all_of, any_of
from tillwork.session import attach_row, fits_single_task, materialise, small_side


def _group_window(by: Sequence[str]):
    return Window.partitionBy(*[F.col(b) for b in by]) if by else Window.partitionBy(F.lit(0))


def range_chunks(df: DataFrame, order: Sequence[str], chunks: int | None = None) -> DataFrame:
    """Range-partition on ``order`` and number the ranges in ``_chunk``.

    The tagged rows are checkpointed, so that every later stage sees the same
    chunk borders even when an executor is lost in between.
    """
    n = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *[F.col(c) for c in order])
    return materialise(ranged.withColumn("_chunk", F.spark_partition_id()))


def running_before(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    weights: Sequence[str],
    limit: int | bool | None = None,
) -> DataFrame:
    """Add ``<w>_before`` (sum over rows earlier in the group) and ``<w>_total``.

    ``order`` must be unique within the group: callers pass distinct values
    with their counts, or a total order.
    """
    by, order = list(by), list(order)
    if fits_single_task(df, limit):
        group = _group_window(by)
        run = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        extra = {}
        for w in weights:
            extra[f"{w}_before"] = F.coalesce(F.sum(w).over(run), F.lit(0))
            extra[f"{w}_total"] = F.sum(w).over(group)
        return df.withColumns(extra)
    chunked = range_chunks(df, by + order)
    totals = chunked.groupBy(*by, "_chunk").agg(*[F.sum(w).alias(f"_sum_{w}") for w in weights])
    group = _group_window(by)
    in_order = group.orderBy("_chunk")
    columns = [F.col(b).alias(f"_k_{b}") for b in by] + [F.col("_chunk").alias("_k_chunk")]
    for w in weights:
        columns.append((F.sum(f"_sum_{w}").over(in_order) - F.col(f"_sum_{w}")).alias(f"_off_{w}"))
        columns.append(F.sum(f"_sum_{w}").over(group).alias(f"{w}_total"))
    offsets = totals.select(*columns)
    same = all_of([F.col(b).eqNullSafe(F.col(f"_k_{b}")) for b in by] + [F.col("_chunk") == F.col("_k_chunk")])
    inner = Window.partitionBy(*by, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = chunked.join(offsets, same)
    before = {f"{w}_before": F.col(f"_off_{w}") + F.coalesce(F.sum(w).over(inner), F.lit(0)) for w in weights}
    keep = [c for c in df.columns] + [x for w in weights for x in (f"{w}_before", f"{w}_total")]
    return joined.withColumns(before).select(*keep)


#: Rows of a long series that one task orders.
SERIES_BLOCK = 100_000


def series_blocks(
    df: DataFrame, by: Sequence[str], order: Sequence[str], back: int = 0, ahead: int = 0, limit: int | bool | None = None,
    size: int = SERIES_BLOCK,
) -> DataFrame:
    """Cut every group into ordered blocks for windows that reach ``back`` and ``ahead`` rows.

    Adds ``_pos`` (0-based place in the group), ``_block`` and ``_own``.  A row
    near the border of its block also appears in the next one, with ``_own``
    false: windows go over (group, block), and only own rows are kept after
    them.  A small input is one block a group.  ``order`` must be unique within
    the group.
    """
    by, order = list(by), list(order)
    if fits_single_task(df, limit):
        place = F.row_number().over(_group_window(by).orderBy(*order)).cast("bigint") - 1
        return df.withColumns({"_pos": place, "_block": F.lit(0).cast("bigint"), "_own": F.lit(True)})
    size = max(size, back, ahead)
    placed = running_before(df.withColumn("_row", F.lit(1).cast("bigint")), by, order, ["_row"], False)
    block, inside = F.floor(F.col("_row_before") / size), F.col("_row_before") % size

    def copy(number: Column, own: bool) -> Column:
        return F.struct(number.alias("_block"), F.lit(own).alias("_own"))

    copies = F.filter(F.array(
        copy(block, True), F.when(inside >= size - back, copy(block + 1, False)),
        F.when((inside < ahead) & (block > 0), copy(block - 1, False))), lambda c: c.isNotNull())
    return placed.select(*df.columns, F.col("_row_before").alias("_pos"), F.inline(copies))


def known_around(
    df: DataFrame, values: dict[str, Column], by: Sequence[str], order: Sequence[str], limit: int | bool | None = None
) -> DataFrame:
    """Add ``<name>_back`` and ``<name>_ahead``: the last known value at or before a row, the first at or after it.

    For large inputs the rows are cut into ordered chunks; each chunk fills
    itself, and one small row per (group, chunk) carries the value across.
    """
    by, order, names = list(by), list(order), list(values)
    rows = df.withColumns({f"_v_{n}": v for n, v in values.items()})
    small = fits_single_task(df, limit)
    if not small:
        rows = range_chunks(rows, by + order)
    keys = by if small else [*by, "_chunk"]
    inner = _group_window(keys).orderBy(*order)
    back = inner.rowsBetween(Window.unboundedPreceding, 0)
    ahead = inner.rowsBetween(0, Window.unboundedFollowing)
    found = rows.withColumns({
        **{f"{n}_back": F.last(f"_v_{n}", ignorenulls=True).over(back) for n in names},
        **{f"{n}_ahead": F.first(f"_v_{n}", ignorenulls=True).over(ahead) for n in names},
    })
    columns = [*df.columns, *[f"{n}_{side}" for n in names for side in ("back", "ahead")]]
    if small:
        return found.select(*columns)
    at = F.struct(*[F.col(c) for c in order])
    ends = rows.groupBy(*by, "_chunk").agg(*[e for n in names for e in (
        F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), at)).alias(f"_last_{n}"),
        F.min_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), at)).alias(f"_first_{n}"))])
    chunks = _group_window(by).orderBy("_chunk")
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    after = chunks.rowsBetween(1, Window.unboundedFollowing)
    carried = ends.select(
        *[F.col(b).alias(f"_k_{b}") for b in by], F.col("_chunk").alias("_k_chunk"),
        *[F.last(f"_last_{n}", ignorenulls=True).over(before).alias(f"_in_{n}_back") for n in names],
        *[F.first(f"_first_{n}", ignorenulls=True).over(after).alias(f"_in_{n}_ahead") for n in names])
    same = all_of([F.col(b).eqNullSafe(F.col(f"_k_{b}")) for b in by] + [F.col("_chunk") == F.col("_k_chunk")])
    joined = found.join(small_side(carried), same)
    return joined.withColumns({
        c: F.coalesce(F.col(c), F.col(f"_in_{c}")) for c in columns[len(df.columns):]}).select(*columns)


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct non-NULL values per group with their counts ``n`` (partial aggregation)."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


#: Up to so many rows the ``percentile`` aggregate beats the two extra scans (measured).
PERCENTILE_ROWS = 50_000


def quantile_table(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    limit: int | None = None,
) -> DataFrame:
    """Exact, linearly interpolated quantiles: ``(by..., column, q array<double>)``.

    Small inputs use the ``percentile`` aggregate.  For large ones whole-column
    quantiles are narrowed down in two scans, and grouped quantiles come from
    distributed ranks of the distinct values.
    """
    by, columns, probs = list(by), list(columns), [float(p) for p in probs]
    if fits_single_task(df, PERCENTILE_ROWS if limit is None else limit):
        wide = df.groupBy(*by).agg(
            *[F.percentile(F.col(c).cast("double"), F.array(*map(F.lit, probs))).alias(f"_q{i}")
              for i, c in enumerate(columns)]
        )
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_q{i}").alias("q"))
                          for i, c in enumerate(columns)])
        return wide.select(*by, F.inline(pairs))
    numbers = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    if not by:
        found = _narrowed_quantiles(numbers, columns, probs, limit)
        if found is not None:
            return df.sparkSession.createDataFrame(list(found.items()), "column string, q array<double>")
    long = numbers.unpivot([F.col(b) for b in by], [F.col(c) for c in columns], "column", "value")
    keys = [*by, "column"]
    ranked = running_before(value_counts(long, "value", keys), keys, ["value"], ["n"], limit)
    start, end = F.col("n_before"), F.col("n_before") + F.col("n")
    picks = []
    for i, p in enumerate(probs):
        pos = F.lit(p) * (F.col("n_total") - 1)
        for tag, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            picks.append(F.max(F.when((at >= start) & (at < end), F.col("value"))).alias(f"_{tag}{i}"))
    totals = F.max("n_total").alias("_n")
    table = ranked.groupBy(*keys).agg(totals, *picks)
    parts = []
    for i, p in enumerate(probs):
        pos = F.lit(p) * (F.col("_n") - 1)
        parts.append(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (pos - F.floor(pos)))
    return table.select(*keys, F.array(*parts).alias("q"))


#: Accuracy of the sketch that brackets a quantile: rank error at most n / ACCURACY.
ACCURACY = 10_000


def _narrowed_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], limit: int | None
) -> dict[str, list[float] | None] | None:
    """Exact quantiles of whole columns without shuffling the column.

    One scan brackets every quantile by a sketch with a guaranteed rank error;
    a second counts the rows below each bracket on the map side and groups
    only the values inside it, a small share of the rows.  Returns None if a
    rank should lie outside its bracket; the caller then ranks all values.
    """
    slack = 2.0 / ACCURACY
    marks = [m for p in probs for m in (max(p - slack, 0.0), min(p + slack, 1.0))]
    sketch = df.agg(*[e for i, c in enumerate(columns) for e in (
        F.count(c).alias(f"n{i}"), F.min(c).alias(f"min{i}"), F.max(c).alias(f"max{i}"),
        F.percentile_approx(c, [float(m) for m in marks], ACCURACY).alias(f"m{i}"))]).first()
    cells = []
    for i, c in enumerate(columns):
        if not sketch[f"n{i}"]:
            continue
        for k, p in enumerate(probs):
            low = sketch[f"min{i}"] if p - slack <= 0 else sketch[f"m{i}"][2 * k]
            high = sketch[f"max{i}"] if p + slack >= 1 else sketch[f"m{i}"][2 * k + 1]
            cells.append((i, k, c, low, high, p * (sketch[f"n{i}"] - 1)))
    result: dict[str, list[float] | None] = {c: ([None] * len(probs) if sketch[f"n{i}"] else None)
                                             for i, c in enumerate(columns)}
    if not cells:
        return result
    below = df.agg(*[F.count(F.when(F.col(c) < low, 1)).alias(f"b{i}_{k}") for i, k, c, low, _, _ in cells]).first()
    inside = F.filter(F.array(*[
        F.when(F.col(c).between(low, high), F.struct(F.lit(i).alias("i"), F.lit(k).alias("k"), F.col(c).alias("v")))
        for i, k, c, low, high, _ in cells]), lambda x: x.isNotNull())
    near = any_of([F.col(c).between(low, high) for _, _, c, low, high, _ in cells])
    counts = df.filter(near).select(F.inline(inside)).groupBy("i", "k", "v").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_before(counts, ["i", "k"], ["v"], ["n"], limit)
    picks = []
    for i, k, _, _, _, pos in cells:
        start = F.col("n_before") + F.lit(below[f"b{i}_{k}"])
        here = (F.col("i") == i) & (F.col("k") == k)
        for tag, at in (("lo", int(pos)), ("hi", -int(-pos // 1))):
            hit = here & (F.lit(at) >= start) & (F.lit(at) < start + F.col("n"))
            picks.append(F.max(F.when(hit, F.col("v"))).alias(f"{tag}{i}_{k}"))
    values = ranked.agg(*picks).first()
    for i, k, c, _, _, pos in cells:
        lo, hi = values[f"lo{i}_{k}"], values[f"hi{i}_{k}"]
        if lo is None or hi is None:
            return None
        result[c][k] = lo + (hi - lo) * (pos - int(pos))
    return result


def quantile_row(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], limit: int | None = None
) -> DataFrame:
    """One row with ``<column>_q<i>`` for every column and probability."""
    table = quantile_table(df, columns, probs, limit=limit)
    return table.agg(
        *[F.max(F.when(F.col("column") == c, F.col("q")[i])).alias(f"{c}_q{i}")
          for c in columns for i in range(len(probs))]
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order`` (a total order).

    The rank filter is pushed below the shuffle as a group limit, so each map
    task ships one row per key however many copies a key has.
    """
    return top_per_key(df, keys, order, 1)


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows per key in ``order``, optionally with their rank column."""
    name = rank or "_rank"
    window = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def take_by_hash(
    df: DataFrame,
    keys: Sequence[str],
    seed: int | str,
    takes: dict[str, Column],
    strata: Sequence[str] = (),
    digits: int | None = None,
) -> DataFrame:
    """Flag exactly the requested number of rows per stratum, lowest in seeded hash order.

    ``takes`` maps flag names to expressions over the stratum size ``n``; the
    flags share one order, so a larger request includes a smaller one.  Rows
    are counted per hash prefix; only the rows of the prefix that holds a cut
    are ranked, which gives the exact position of the cut.  No stratum is ever
    sorted as a whole, and flagging is a comparison per row.  NULL strata are
    dropped.
    """
    strata, keys, flags = list(strata), list(keys), list(takes)
    digits = digits or 4  # any number of digits gives the same rows
    rows = df.filter(all_of([F.col(s).isNotNull() for s in strata])) if strata else df
    digest = hash_order(keys, seed)
    position = F.struct(digest.alias("_h"), *[F.col(k) for k in keys])
    slim = rows.select(*strata, position.alias("_at"), hash_prefix(digest, digits).alias("_prefix"))
    sizes = slim.groupBy(*strata, "_prefix").agg(F.count(F.lit(1)).alias("_rows"))
    group = _group_window(strata)
    sizes = sizes.select(
        *strata, "_prefix", "_rows",
        (F.sum("_rows").over(group.orderBy("_prefix")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(group).alias("n"),
    )
    wants = F.array(*[F.struct(F.lit(i).alias("_flag"), F.least(t.cast("bigint"), F.col("n")).alias("_want"))
                      for i, t in enumerate(takes.values())])
    cut = sizes.select(*strata, "_prefix", "_rows", "_before", F.inline(wants))
    cut = cut.filter((F.col("_before") < F.col("_want")) & (F.col("_want") <= F.col("_before") + F.col("_rows")))
    cut = cut.select(*strata, "_prefix", "_flag", (F.col("_want") - F.col("_before")).alias("_need"))
    on_cut = slim.join(small_side(cut), [*strata, "_prefix"])
    rank = F.row_number().over(Window.partitionBy(*strata, "_prefix", "_flag").orderBy("_at"))
    last = on_cut.withColumn("_rank", rank).filter(F.col("_rank") == F.col("_need"))
    last = last.groupBy(*[F.col(s).alias(f"_s_{s}") for s in strata]).agg(
        *[F.max(F.when(F.col("_flag") == i, F.col("_at"))).alias(f"_cut{i}") for i in range(len(flags))])
    if strata:
        same = all_of([F.col(s) == F.col(f"_s_{s}") for s in strata])
        marked = rows.join(small_side(last), same, "left")
    else:
        marked = attach_row(rows, small_side(last))
    marked = marked.withColumns({
        f: F.coalesce(position <= F.col(f"_cut{i}"), F.lit(False)) for i, f in enumerate(flags)})
    return marked.select(*df.columns, *flags)


def dense_ids(df: DataFrame, columns: Sequence[str], name: str = "id", limit: int | None = None) -> DataFrame:
    """Distinct non-NULL key tuples with a dense 0-based id in key order."""
    columns = list(columns)
    distinct = df.select(*columns).dropna().distinct().withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_before(distinct, [], columns, ["_one"], limit)
    return ranked.select(*columns, F.col("_one_before").alias(name))
