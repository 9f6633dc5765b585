"""Filter interaction audit: what each filter removes in every order of the filters.

The sets of filters that were already applied form a lattice.  Every document is
reduced to the set of filters that it fails, and each group to one count for each
such set; from these follows how many documents survive any set of applied
filters.  An edge of the lattice applies one more filter, and removes the
difference of its two states.  The orders that reach a state are counted forwards
from the empty set, those that leave it backwards from the full set; their product
weighs the edge in the Shapley sums, and the steps of each order are read from the
same edges.
"""

from __future__ import annotations

from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import signals
from .store import spill

LETTERS = "ABCDE"
SYMBOLS = signals.byte_class("#$%&*|")
COUNTED = ["documents", "good", "toxic"]


def reaching(filters: int) -> list[int]:
    """Orders of filters that lead from nothing to each set of applied filters."""
    orders = [0] * 2**filters
    orders[0] = 1
    for state in range(2**filters):
        for one in range(filters):
            if not state >> one & 1:
                orders[state | 1 << one] += orders[state]
    return orders


def leaving(filters: int) -> list[int]:
    """Orders of the other filters that lead from each set of applied filters to all of them."""
    orders = [0] * 2**filters
    orders[-1] = 1
    for state in reversed(range(2**filters)):
        for one in range(filters):
            if not state >> one & 1:
                orders[state] += orders[state | 1 << one]
    return orders


def _measure(texts: pa.Array) -> dict:
    words = signals.words(texts)
    different = words.different()
    upper, points, symbols = signals.totals(texts, signals.UPPER, signals.LEADS, SYMBOLS)
    fails = (words.count < 200, 100 * different < 50 * words.count, 100 * upper > 2 * points, symbols > 0)
    return {"mask": sum(x.astype("int32") << k for k, x in enumerate(fails))}


@F.arrow_udf(T.StructType([T.StructField("mask", T.IntegerType())]))
def _text_mask(texts: pa.Array) -> pa.Array:
    return signals.struct_of(texts, _measure)


def failed_filters(df: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(doc_id, part, mask) for each row: bit k of ``mask`` tells that it fails filter k of ``LETTERS``.

    A: under 200 words; B: under half of the words differ; C: over 2 % of the
    characters are in A-Z; D: any of ``#$%&*|``; E: another row with a smaller id
    has the same text, by its SHA-256.  A null text is empty, a null part the
    empty string.  A row without id takes part, but is not compared by E; rows
    that share id and text do not fail E for each other.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{part}`"), F.lit("")).alias("part"),
                     F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"), _text_mask(whole).getField("mask").alias("mask"))
    rows = spill(rows, "masks")
    # the join is on id and digest, so that copies of one text are spread over all tasks
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    later = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return rows.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", F.when(later, F.col("mask").bitwiseOR(F.lit(16))).otherwise(F.col("mask")).alias("mask"))


def survivors(masks: DataFrame) -> DataFrame:
    """(part, documents, good, toxic): for each set of applied filters how many rows fail none of them, from (part, mask, good, toxic)."""
    states = range(2 ** len(LETTERS))
    counts = masks.groupBy("part", "mask").agg(
        F.count("*").alias("documents"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    one = lambda c, m: F.coalesce(F.max(F.when(F.col("mask") == m, F.col(c))), F.lit(0)).cast("long")
    table = spill(counts.groupBy("part").agg(*[F.array(*[one(c, m) for m in states]).alias(c) for c in COUNTED]), "states")
    left = lambda c, s: sum((F.get(c, F.lit(m)) for m in states if m and not m & s), F.get(c, F.lit(0)))
    return table.select("part", *[F.array(*[left(c, s) for s in states]).alias(c) for c in COUNTED])


def interactions(masks: DataFrame) -> DataFrame:
    """One row for each part, order of all filters and step, from (part, mask, good, toxic).

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley.  ``removed`` and what is lost are read from the
    edge that the step takes, ``redundant`` and ``unique_fails`` from the first and
    the last edge of its filter; ``shapley`` is the sum of what the filter removes
    over all orders.  No input gives no row.
    """
    filters = range(len(LETTERS))
    everything, before, after = 2 ** len(LETTERS) - 1, reaching(len(LETTERS)), leaving(len(LETTERS))
    bit = lambda k: F.lit(1 << k)
    edge = lambda c, state, other: F.get(c, state) - F.get(c, other)
    weighed = [sum(before[s] * after[s | 1 << k] * edge("documents", F.lit(s), F.lit(s | 1 << k)) for s in range(everything) if not s >> k & 1)
               for k in filters]
    alive = survivors(masks).withColumn("shapley", F.array(*weighed))
    orders = F.array(*[F.lit("".join(order)) for order in permutations(LETTERS)])
    steps = alive.select("*", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step"))
    place = F.instr(F.lit(LETTERS), F.substring("filter_order", F.col("step"), F.lit(1))) - 1
    earlier = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    state = sum((F.when(F.contains(earlier, F.lit(LETTERS[k])), bit(k)).otherwise(0) for k in filters), F.lit(0))
    steps = steps.withColumns({"one": place, "state": state}).withColumn("bit", F.call_function("shiftleft", F.lit(1), F.col("one")))
    now, then = F.col("state"), F.col("state") + F.col("bit")
    gone = edge("documents", now, then)
    return steps.select(
        "part", "filter_order", "step", F.get("documents", then).alias("kept"), gone.alias("removed"),
        (edge("documents", F.lit(0), F.col("bit")) - gone).alias("redundant"),
        edge("documents", F.lit(everything) - F.col("bit"), F.lit(everything)).alias("unique_fails"),
        edge("good", now, then).alias("good_lost"), edge("toxic", now, then).alias("toxic_lost"), F.get("shapley", F.col("one")).alias("shapley"))


def audited(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """The rows of ``interactions`` for documents and their labels (doc_id, quality, toxic).

    A document counts as good or toxic if any of its label rows says 1; labels
    of no document do not matter, documents without label are neither.
    """
    known = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    return interactions(failed_filters(df, doc_id, text, part).join(known, "doc_id", "left").select("part", "mask", "good", "toxic"))
