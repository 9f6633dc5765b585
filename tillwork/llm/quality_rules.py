"""Quality rules with thresholds that follow the data.

Each text is measured; each measure goes into a quantile sketch for its language
and source.  A sketch counts values in buckets of 1/64 relative width, so sketches
merge by addition, in any order and to the same result.  The quartiles of a
sketch give the bounds of its group: values far outside of them fail.  Groups with
few texts take the merged sketch of their language, or of everything.  The bounds
are joined back, and texts that break a rule go.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.session import attach_row

from . import signals
from .store import spill, unused

#: Values below are exact buckets; above, each doubling has half as many.
EXACT_BITS = 7
#: Groups with fewer texts use the next wider sketch.
FEWEST = 100
#: Bounds lie this many interquartile ranges beyond the quartiles.
REACH = 3
SYMBOLS = signals.byte_class("#*$%&|<>")
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """A measure for each ``scale`` words, and how far beyond its bounds it may lie."""

    name: str
    measure: str
    scale: int
    slack: int
    both_sides: bool = False


RULES = (
    Rule("word_length", "word_chars", 1000, 500, both_sides=True),
    Rule("symbols", "n_symbols", 10_000, 1000),
    Rule("repeated_lines", "n_dup_lines", 10_000, 500),
    Rule("repeated_words", "n_repeat_words", 10_000, 4000),
)


def _measure(texts: pa.Array) -> dict:
    words, lines = signals.words(texts), signals.lines(texts)
    chars, symbols = signals.totals(texts, signals.LEADS & ~signals.BLANK, SYMBOLS)
    return dict(zip(MEASURES, (words.count, chars, symbols, lines.count - lines.different(), words.repeated())))


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def measures(texts: pa.Array) -> pa.Array:
    """Words, code points in words, symbols, lines equal to an earlier one, and words in repeated windows of three."""
    return signals.struct_of(texts, _measure)


def base_failed(measured: Column) -> Column:
    """Too short, or mostly repetition, whatever the group."""
    return (measured["n_words"] < 50) | (100 * measured["n_repeat_words"] > 50 * measured["n_words"])


def value(measured: Column, rule: Rule) -> Column:
    """The measure of a rule as a whole number; null without words."""
    ratio = rule.scale * measured[rule.measure]
    return F.when(measured["n_words"] > 0, F.floor((ratio - ratio % measured["n_words"]) / measured["n_words"]).cast("long"))


def bucket(number: Column) -> Column:
    """The bucket of a number from 0."""
    step = F.greatest(F.length(F.bin(number)) - EXACT_BITS, F.lit(0))
    return (step * 2 ** (EXACT_BITS - 1)).cast("long") + F.call_function("shiftright", number, step)


def largest_in(number: Column) -> Column:
    """The largest value of a bucket."""
    half = 2 ** (EXACT_BITS - 1)
    step = F.greatest(F.floor(number / half) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", number - step * half + 1, step) - 1


def sketches(rows: DataFrame) -> DataFrame:
    """Sketches (wide, lang, source, rule, bucket, n) of ``rows`` (lang, source, measured).

    ``wide`` 0 is a source of a language, 1 a language, 2 everything; the wider ones are sums of the others.
    """
    values = F.array(*[F.struct(F.lit(r.name).alias("rule"), bucket(value(F.col("measured"), r)).alias("bucket")) for r in RULES])
    narrow = rows.filter("measured.n_words > 0").select("lang", "source", F.explode(values).alias("at"))
    narrow = spill(narrow.groupBy("lang", "source", "at.rule", "at.bucket").agg(F.count("*").alias("n")), "sketches")
    none = F.lit(None).cast("string")
    wide = [F.struct(F.lit(w).alias("wide"), (F.col("l") if w < 2 else none).alias("lang"), (F.col("s") if w < 1 else none).alias("source"))
            for w in range(3)]
    narrow = narrow.withColumnsRenamed({"lang": "l", "source": "s"})
    return narrow.select(F.inline(F.array(*wide)), "rule", "bucket", "n").groupBy("wide", "lang", "source", "rule", "bucket").agg(F.sum("n").alias("n"))


def bounds(rows: DataFrame) -> DataFrame:
    """(lang, source, bounds): for each rule the lowest and highest value that passes, after the sketches of ``rows``."""
    group = ["wide", "lang", "source"]
    by = Window.partitionBy(*group, "rule")
    ranked = sketches(rows).withColumns({"upto": F.sum("n").over(by.orderBy("bucket")), "all": F.sum("n").over(by)})
    quartile = lambda k: largest_in(F.min(F.when(4 * F.col("upto") >= k * F.col("all"), F.col("bucket"))))
    found = ranked.groupBy(*group, "rule").agg(F.max("all").alias("n"), quartile(1).alias("q1"), quartile(3).alias("q3"))
    reach = REACH * (F.col("q3") - F.col("q1"))
    limit = {}
    for r in RULES:
        own = F.col("rule") == r.name
        limit[f"{r.name}_low"] = F.max(F.when(own, F.col("q1") - reach - r.slack)) if r.both_sides else F.lit(None).cast("long")
        limit[f"{r.name}_high"] = F.max(F.when(own, F.col("q3") + reach + r.slack))
    table = spill(found.groupBy(*group).agg(F.max("n").alias("n"), F.struct(*[c.alias(k) for k, c in limit.items()]).alias("bounds")), "bounds")
    at = lambda w, name: table.filter(F.col("wide") == w).select(
        *["lang", "source"][: 2 - w], F.col("n").alias(f"n{w}"), F.col("bounds").alias(name))
    wider = at(1, "by_lang").withColumnRenamed("lang", "l")
    overall = table.filter("wide = 2").agg(F.first("bounds").alias("overall"))
    out = attach_row(at(0, "own").join(wider, F.col("lang").eqNullSafe(F.col("l")), "left"), overall)
    use = F.when(F.col("n0") >= FEWEST, F.col("own")).when(F.col("n1") >= FEWEST, F.col("by_lang")).otherwise(F.col("overall"))
    return out.select("lang", "source", use.alias("bounds"))


def broken(measured: Column, limits: Column) -> Column:
    """Names of the rules that a text breaks."""
    tests = []
    for r in RULES:
        out = value(measured, r) > limits[f"{r.name}_high"]
        if r.both_sides:
            out = out | (value(measured, r) < limits[f"{r.name}_low"])
        tests.append(F.when(out, F.lit(r.name)))
    return F.array_compact(F.array(*tests))


def _with_bounds(rows: DataFrame, limits: DataFrame, lang: Column, source: Column, name: str) -> DataFrame:
    """``rows`` with the bounds of their group; Spark broadcasts them where they are small and splits hot groups where not."""
    g, s = unused(rows, f"{name}_lang"), unused(rows, f"{name}_source")
    other = limits.select(F.col("lang").alias(g), F.col("source").alias(s), F.col("bounds").alias(name))
    return rows.join(other, lang.eqNullSafe(F.col(g)) & source.eqNullSafe(F.col(s)), "left")


def judged(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row for each row: doc_id, lang, source, the measures, base_failed, broken (names of rules), kept.

    A null text is empty and has no words; without words a row fails the base.
    Null languages and sources are groups of their own.  Repeated rows count as
    often as they stand.  No input gives no row.
    """
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source"),
                     measures(F.col(f"`{text}`")).alias("measured"))
    rows = spill(rows, "measures")
    found = _with_bounds(rows, bounds(rows.select("lang", "source", "measured")), F.col("lang"), F.col("source"), "limits")
    found = found.withColumns({"base_failed": base_failed(F.col("measured")), "broken": broken(F.col("measured"), F.col("limits"))})
    return found.select("doc_id", "lang", "source", "measured.*", "base_failed", "broken",
                        (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"))


def filtered(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``df`` that pass the base and the rules of their group, with the columns they had.

    The texts are read twice, once for the sketches and once to filter; they are not shuffled unless the bounds
    are too many to broadcast.
    """
    rows = df.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source"), measures(F.col(f"`{text}`")).alias("measured"))
    limits, name, own = bounds(rows), unused(df, "measured"), unused(df, "bounds")
    found = _with_bounds(df.withColumn(name, measures(F.col(f"`{text}`"))), limits, F.col(f"`{lang}`"), F.col(f"`{source}`"), own)
    passes = ~base_failed(F.col(name)) & (F.size(broken(F.col(name), F.col(own))) == 0)
    return found.filter(passes).select(*[F.col(f"`{c}`") for c in df.columns])
