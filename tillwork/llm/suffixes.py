"""Repeated passages by a sparse suffix array.

Of each text only the suffixes at minimiser positions are kept: the position of
the smallest run number among every ``SPREAD`` neighbouring runs of ``RUN``
words.  A passage of ``RUN + SPREAD - 1`` words has such a position, at the same
place in all its copies.  Suffixes whose first run occurs once are dropped, the
others are sorted by what follows, neighbours are compared, and matches are
extended left and right.  Of a run with more suffixes than neighbours, every
window of ``PASSAGE`` words around it is looked up as well, so that no match is
left out.  Matches of one text that touch become one passage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import Held, spill
from .words import U64, grams, slices, text_buffer, words_of

#: Words of the shortest passage that counts.
PASSAGE = 50
#: Words of a run; with windows of SPREAD runs a passage holds one minimiser at least.
RUN = 20
SPREAD = PASSAGE - RUN + 1
#: Words that a suffix carries on either side of its run: enough to decide on PASSAGE words.
SIDE = PASSAGE - RUN
#: Bytes of a carried word.
BYTES = 3
#: Neighbours in suffix order that a suffix is compared with.
NEAR = 16
#: Sorted suffixes that are compared at once.
PART = 20_000


def _sliding(values: np.ndarray, width: int, lowest: bool) -> np.ndarray:
    """Minimum or maximum of each ``width`` neighbours."""
    take, size, out = (np.minimum if lowest else np.maximum), 1, values
    while 2 * size <= width:
        out, size = take(out[:-size], out[size:]), 2 * size
    return take(out[: len(out) - (width - size)], out[width - size :]) if width > size else out


def minimisers(runs: np.ndarray) -> np.ndarray:
    """Positions of the runs that are smallest among ``SPREAD`` neighbours; of equal ones in a row every sixteenth."""
    if len(runs) < SPREAD:
        return np.zeros(0, np.int64)
    low = _sliding(runs, SPREAD, True)
    edge = np.zeros(SPREAD - 1, U64)
    at = np.flatnonzero(_sliding(np.r_[edge, low, edge], SPREAD, False) == runs)
    fresh = np.r_[True, runs[at[1:]] != runs[at[:-1]]]
    step = (at - at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]) // 16
    return at[fresh | np.r_[True, step[1:] != step[:-1]]]


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("run", T.LongType())])))
def suffixes(texts: pa.Array) -> pa.Array:
    """Minimiser positions of each text and their run numbers."""
    kept, numbers, sizes = [], [], []
    for _, part in slices(texts):
        words = words_of(part)
        runs = grams(words.hash, RUN)
        for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            own = runs[first : max(first, last - RUN + 1)]
            at = minimisers(own)
            kept.append(at)
            numbers.append(own[at])
            sizes.append(len(at))
    if not kept:
        return pa.array([], pa.list_(pa.struct([("at", pa.int32()), ("run", pa.int64())])))
    both = pa.StructArray.from_arrays([pa.array(np.concatenate(kept).astype(np.int32)),
                                       pa.array(np.concatenate(numbers).view(np.int64))], ["at", "run"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]).astype(np.int32)), both)


@F.arrow_udf(T.ArrayType(T.StructType([
    T.StructField("at", T.IntegerType()), T.StructField("run", T.LongType()), T.StructField("before", T.BinaryType()),
    T.StructField("n_before", T.IntegerType()), T.StructField("after", T.BinaryType()), T.StructField("n_after", T.IntegerType())])))
def surroundings(texts: pa.Array, places: pa.Array) -> pa.Array:
    """What stands before (nearest word first) and after the run at each place of each text."""
    parts, sizes = [], []
    reach = np.arange(SIDE)
    for start, part in slices(texts):
        words = words_of(part)
        runs = grams(words.hash, RUN)
        short = np.ascontiguousarray(words.hash.view(np.uint8).reshape(-1, 8)[:, :BYTES])
        own = places.slice(start, len(part))
        size = np.array([len(p) for p in own])
        sizes.append(size)
        first, last = np.repeat(words.first[:-1], size), np.repeat(words.first[1:], size)
        at = first + own.flatten().to_numpy()
        sides = []
        for step, room in ((-1 - reach, at - first), (RUN + reach, last - at - RUN)):
            room = np.minimum(SIDE, room)
            near = short[np.clip(at[:, None] + step, 0, max(0, len(short) - 1))]
            near[reach[None, :] >= room[:, None]] = 0
            sides += [_rows(near.reshape(len(at), SIDE * BYTES)), pa.array(room.astype(np.int32))]
        parts.append(pa.StructArray.from_arrays(
            [pa.array((at - first).astype(np.int32)), pa.array(runs[at].view(np.int64)), *sides],
            ["at", "run", "before", "n_before", "after", "n_after"]))
    kind = pa.struct([("at", pa.int32()), ("run", pa.int64()), ("before", pa.binary()), ("n_before", pa.int32()),
                      ("after", pa.binary()), ("n_after", pa.int32())])
    ends = np.cumsum(np.r_[0, *sizes]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(parts) if parts else pa.array([], kind))


@F.arrow_udf(T.ArrayType(T.StructType([
    T.StructField("at", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("window", T.LongType())])))
def windows(texts: pa.Array, places: pa.Array) -> pa.Array:
    """The windows of ``PASSAGE`` words around the run at each place of each text: where they start, and their numbers."""
    kind = pa.struct([("at", pa.int32()), ("start", pa.int32()), ("window", pa.int64())])
    parts, sizes = [], []
    for start, part in slices(texts):
        words = words_of(part)
        numbers = grams(words.hash, PASSAGE)
        for first, last, own in zip(words.first[:-1].tolist(), words.first[1:].tolist(), places.slice(start, len(part))):
            at = np.repeat(np.asarray(own.as_py(), np.int64), SIDE + 1)
            begin = at - np.tile(np.arange(SIDE + 1), len(own))
            fits = (begin >= 0) & (begin + PASSAGE <= last - first)
            at, begin = at[fits], begin[fits]
            sizes.append(len(at))
            parts.append(pa.StructArray.from_arrays(
                [pa.array(at.astype(np.int32)), pa.array(begin.astype(np.int32)), pa.array(numbers[first + begin].view(np.int64))],
                ["at", "start", "window"]))
    ends = np.cumsum([0, *sizes]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(parts) if parts else pa.array([], kind))


def _rows(table: np.ndarray) -> pa.Array:
    """Each row of a byte table as a binary value."""
    ends = np.arange(len(table) + 1, dtype=np.int32) * np.int32(table.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(table), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(table))])


CARRIED = ("doc", "text_hash", "at", "run", "before", "n_before", "after", "n_after")
CARRIED_TYPES = "doc long, text_hash long, at int, run long, before binary, n_before int, after binary, n_after int"
MATCH_TYPES = "first int, last int, best int, partner long"


def _common(x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Equal words from the start of each row, ``limit`` at most."""
    equal = (x == y).all(axis=2)
    n = np.where(equal.all(axis=1), SIDE, equal.argmin(axis=1))
    return np.minimum(n, limit)


def _table(column: pa.ChunkedArray) -> np.ndarray:
    """The binary values of a column, all of the same size, as words of ``BYTES``."""
    return np.concatenate([text_buffer(c)[0] for c in column.chunks]).reshape(len(column), SIDE, BYTES)


def matches(rows: pa.Table) -> pa.Table:
    """How far the matches of each suffix of sorted rows reach among its neighbours, and the longest one."""
    n = rows.num_rows
    doc, text, at, run, n_before, n_after = (rows.column(c).to_numpy() for c in ("doc", "text_hash", "at", "run", "n_before", "n_after"))
    before, after = (_table(rows.column(c)) for c in ("before", "after"))
    best, first, last, partner = np.zeros(n, np.int64), at.copy(), at.copy(), np.full(n, -1)
    for d in range(1, min(NEAR, n - 1) + 1):
        i = np.flatnonzero(run[:-d] == run[d:])
        if not len(i):
            break
        j = i + d
        left = _common(before[i], before[j], np.minimum(n_before[i], n_before[j]))
        right = _common(after[i], after[j], np.minimum(n_after[i], n_after[j]))
        total = left + RUN + right
        own = (doc[i] == doc[j]) & (text[i] == text[j]) & (np.abs(at[i] - at[j]) < total)
        good = (total >= PASSAGE) & ~own
        for a, b in ((i[good], j[good]), (j[good], i[good])):
            first[a] = np.minimum(first[a], at[a] - left[good])
            last[a] = np.maximum(last[a], at[a] + RUN + right[good])
            longer = total[good] > best[a]
            a, b = a[longer], b[longer]
            best[a], partner[a] = total[good][longer], b
    hit = np.flatnonzero(best)
    return pa.table({"doc": doc[hit], "text_hash": text[hit], "at": at[hit].astype(np.int32), "first": first[hit].astype(np.int32), "last": last[hit].astype(np.int32),
                     "best": best[hit].astype(np.int32), "partner": doc[partner[hit]]})


def _sorted_part(batches):
    """Matches within one part of the sorted suffixes."""
    held = None
    for batch in batches:
        fresh = pa.Table.from_batches([batch])
        for start in range(0, fresh.num_rows, PART):
            rows = fresh.slice(start, PART)
            rows = rows if held is None else pa.concat_tables([held, rows])
            yield from matches(rows).cast(MATCHES).to_batches()
            held = rows.slice(max(0, rows.num_rows - NEAR))


MATCHED = f"doc long, text_hash long, at int, {MATCH_TYPES}"
MATCHES = pa.schema([(p.split()[0], {"long": pa.int64(), "int": pa.int32()}[p.split()[1]]) for p in MATCHED.split(", ")])


def _known_windows(docs: DataFrame) -> DataFrame:
    """The same as the sorted suffixes give, of suffixes in ``many``: each of their windows that stands elsewhere too."""
    own = docs.select("doc", "text_hash", F.explode(windows("text", "many")).alias("w")).select("doc", "text_hash", "w.*")
    own = spill(own, "windows")
    place = F.struct("doc", "text_hash", "start")
    twice = own.groupBy("window").agg(F.min(place).alias("low"), F.max(place).alias("high")).filter("low < high")
    elsewhere = [(F.col(f"{c}.doc") != F.col("doc")) | (F.col(f"{c}.text_hash") != F.col("text_hash"))
                 | (F.abs(F.col(f"{c}.start") - F.col("start")) >= PASSAGE) for c in ("low", "high")]
    partner = F.when(F.col("low.doc") != F.col("doc"), F.col("low.doc")).otherwise(F.col("high.doc"))
    return own.join(spill(twice, "known-windows"), "window").filter(elsewhere[0] | elsewhere[1]).select(
        "doc", "text_hash", "at", F.col("start").alias("first"), (F.col("start") + PASSAGE).alias("last"),
        F.lit(PASSAGE).alias("best"), partner.alias("partner"))


def repeated_passages(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each passage of ``PASSAGE`` words or more that stands elsewhere too.

    Columns: doc_id, first_word, last_word (exclusive), n_words, match_doc_id (a
    document that shares the longest part that was compared), n_matches (matching
    suffixes).  Words
    stand between blanks, A-Z count as a-z.  A passage that repeats within one
    document counts where its two places do not overlap.  Rows without id or
    text take no part; rows that repeat id and text are one document; texts
    under ``PASSAGE`` words have no passage; no input gives no row.

    All suffixes of a run are compared with one another, on words of ``8 * BYTES``
    bits.  Where a run has more than ``NEAR + 1`` of them, a suffix is compared with
    ``NEAR`` neighbours in suffix order, which name its partner, and each of its
    windows of ``PASSAGE`` words is looked up, which finds all the rest.  Equal
    suffixes of such a run are spread over parts of the sorted table by document
    and place, so a passage in very many documents is no hot group.
    """
    key = F.xxhash64("text")
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text")).dropna().withColumn("text_hash", key)
    found = docs.select("doc", "text_hash", F.explode(suffixes("text")).alias("s")).select("doc", "text_hash", "s.*")
    held = Held()
    found = held.keep(found)
    often = found.groupBy("run").agg(F.count("*").alias("n")).filter("n > 1").select("run", (F.col("n") > NEAR + 1).alias("hot"))
    places = spill(found.join(spill(often, "runs"), "run"), "repeated").groupBy("doc", "text_hash").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("at"))).alias("few"), F.collect_set(F.when(F.col("hot"), F.col("at"))).alias("many"))
    around = spill(docs.join(places, ["doc", "text_hash"]).dropDuplicates(["doc", "text_hash"]).select(
        "doc", "text_hash", "many", F.when(F.size("many") > 0, F.col("text")).alias("text"),
        surroundings("text", "few").alias("few_s"), surroundings("text", "many").alias("many_s")), "surroundings")
    held.release()
    order = ["run", "after", "doc", "at"]
    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), around.rdd.getNumPartitions())
    few, many = (around.select("doc", "text_hash", F.explode(c).alias("s")).select("doc", "text_hash", "s.*").select(*CARRIED)
                 for c in ("few_s", "many_s"))
    few = few.repartition(ranges, "run").sortWithinPartitions(*order).mapInArrow(_sorted_part, MATCHED)
    many = many.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(_sorted_part, MATCHED)
    known = _known_windows(around.filter(F.size("many") > 0).select("doc", "text_hash", "text", "many"))
    spans = few.unionByName(many).unionByName(known).groupBy("doc", "text_hash", "at").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max(F.struct("best", "partner")).alias("best"))
    along = Window.partitionBy("doc", "text_hash").orderBy("first", "last", "at")
    reached = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("opens", F.coalesce(F.col("first") > reached, F.lit(True)).cast("int"))
    spans = spans.withColumn("passage", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return spans.groupBy("doc", "text_hash", "passage").agg(
        F.min("first").cast("long").alias("first_word"), F.max("last").cast("long").alias("last_word"),
        F.max("best").getField("partner").alias("match_doc_id"), F.count("*").alias("n_matches"),
    ).select(F.col("doc").alias("doc_id"), "first_word", "last_word", (F.col("last_word") - F.col("first_word")).alias("n_words"),
             "match_doc_id", "n_matches")
