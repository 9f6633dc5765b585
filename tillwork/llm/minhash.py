"""Near duplicates by HyperMinHash registers, banded, estimated and verified on full shingle sets.

A register keeps of the smallest hash value in its bucket the number of leading
zeros (6 bits) and the bits behind them (10 bits).  Every bucket has a hash
function of its own, so that short texts fill all of them.  Four registers are
one long, which is a band as it stands.

Texts with equal shingle sets are one class.  Classes that share a band are
compared with the lowest class of the band's bucket first, which settles large
groups at linear cost; what is still apart in a bucket is then compared block
by block, so that no pair is left out.  Pairs pass on the collision-corrected
estimate and are then verified on the whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .graph import components
from .store import Held, discard, spill, unused
from .words import U64, distinct, grams, mix, numbers, release, slices, words_of

#: Words of a shingle.
SHINGLE = 5
#: Similarity of linked texts, in percent.
PERCENT = 80
#: Bands of four registers: at 80 % one pair in 38,000 shares no band, at 85 % one in 2.5 million.
BANDS, ROWS = 20, 4
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: Pairs whose estimate is so far below the limit (five standard deviations) are not verified.
SLACK = 0.2
#: Classes in a block of the second round.
BLOCK = 512

_FLIP, _FACTOR = numbers(REGISTERS, 3), numbers(REGISTERS, 5) | U64(1)


def shingle_sets(texts: pa.Array, k: int = SHINGLE):
    """Sorted distinct shingle numbers of each whole text; a shorter text is one shingle, an empty one has none."""
    for _, part in slices(texts):
        words = words_of(part)
        runs = grams(words.hash, k)
        for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            if last - first >= k:
                yield distinct(runs[first : last - k + 1])
            elif last > first:
                yield grams(words.hash[first:last], last - first) ^ U64(last - first)
            else:
                yield np.zeros(0, U64)


def registers(values: np.ndarray) -> np.ndarray:
    """The registers of a set as longs, four registers in each."""
    low = np.full(REGISTERS, U64(2**64 - 1))
    for at in range(0, len(values), 4096):
        hashed = (values[at : at + 4096, None] ^ _FLIP) * _FACTOR
        np.minimum(low, hashed.min(axis=0), out=low)
    bits = low.astype(np.float64).view(np.uint64)
    zeros = np.clip(1086 - (bits >> U64(52)).astype(np.int64), 0, 63).astype(np.uint16)
    rest = ((bits >> U64(52 - MANTISSA)) & U64(2**MANTISSA - 1)).astype(np.uint16)
    return (zeros << np.uint16(MANTISSA) | rest).view(np.int64)


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that a register of two disjoint sets of these sizes is equal.

    Sum over the leading-zero counts: within one of them a cell of the mantissa
    holds the minimum of a set of n with about n * width * (1 - x) ** (n - 1).
    """
    n, m = np.maximum(n, 1).astype(float)[:, None], np.maximum(m, 1).astype(float)[:, None]
    zeros = np.arange(64)[None, :]
    power = np.maximum(n + m - 1, 1)
    high, low = np.log1p(-np.minimum(2.0**-zeros, 1 - 1e-16)), np.log1p(-(2.0 ** -(zeros + 1)))
    mass = np.exp(power * low) - np.exp(power * high)
    return np.minimum(0.999, (2.0 ** -(zeros + 1 + MANTISSA) * n * m / power * mass).sum(axis=1))


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimate for rows of registers (as longs) and set sizes."""
    same = (a.view(np.uint16).reshape(len(a), -1) == b.view(np.uint16).reshape(len(b), -1)).mean(axis=1)
    by_chance = chance(n, m)
    return (same - by_chance) / (1 - by_chance)


def _matrix(lists: pa.Array) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False)).reshape(len(lists), BANDS)


@F.arrow_udf(T.StructType([T.StructField("n_shingles", T.LongType()), T.StructField("low", T.LongType()),
                           T.StructField("high", T.LongType()), T.StructField("registers", T.ArrayType(T.LongType()))]))
def signature(texts: pa.Array) -> pa.Array:
    rows = []
    for values in shingle_sets(texts):
        if not len(values):
            rows.append((0, None, None, None))
            continue
        low, high = np.add.reduce(mix(values)), np.add.reduce(mix(values ^ U64(0xA0761D6478BD642F)))
        rows.append((len(values), int(low.view(np.int64)), int(high.view(np.int64)), registers(values)))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
    parts = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.StructArray.from_arrays(parts, ["n_shingles", "low", "high", "registers"])


@F.arrow_udf(T.BinaryType())
def full_set(texts: pa.Array) -> pa.Array:
    return pa.array([s.tobytes() for s in shingle_sets(texts)], pa.binary())


@F.arrow_udf(T.DoubleType())
def estimated(a: pa.Array, b: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
    if not len(a):
        return pa.array([], pa.float64())
    return pa.array(estimate(_matrix(a), _matrix(b), n.to_numpy(), m.to_numpy()))


@F.arrow_udf(T.LongType())
def shared(a: pa.Array, b: pa.Array) -> pa.Array:
    """Common members of two packed sets."""
    release()
    return pa.array([_common(np.frombuffer(x.as_py(), U64), np.frombuffer(y.as_py(), U64)) for x, y in zip(a, b)], pa.int64())


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Common members of two sorted sets, neither of them empty."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def _similar(df: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with registers whose sizes and estimate leave the limit possible."""
    sized = df.filter(100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
    return sized.withColumn("guess", estimated("x", "y", "n", "m")).filter(F.col("guess") >= percent / 100 - SLACK)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that reach the limit on their full sets."""
    first = sets.select(F.col("class").alias("a"), F.col("members").alias("s"))
    second = sets.select(F.col("class").alias("b"), F.col("members").alias("t"))
    both = pairs.join(first, "a").join(second, "b")
    sizes = (F.octet_length("s") + F.octet_length("t")) / 8
    return both.withColumn("common", shared("s", "t")).filter(
        100 * F.col("common") >= percent * (sizes - F.col("common"))).select("a", "b")


UNIT = ["band", "key", "i", "j"]
MEMBERS = "band int, key long, i long, j long, class long, component long, pairs binary"


def _block_pairs(percent: int):
    """Candidates between one block of classes that are apart and one block of all classes of a bucket.

    Gives the classes that have candidates, a row each, and all pairs in one packed row.
    """

    def compare(rows: pa.Table) -> pa.Table:
        release()
        unit = [rows.column(c)[0].as_py() for c in UNIT]
        side = rows.column("other").to_numpy().astype(bool)
        ids, comp, n = (rows.column(c).to_numpy() for c in ("class", "component", "n"))
        regs = _matrix(rows.column("registers"))
        left, right = np.flatnonzero(side), np.flatnonzero(~side)
        found = []
        for i in left.tolist():
            js = right[(comp[right] != comp[i]) & (100 * np.minimum(n[right], n[i]) >= percent * np.maximum(n[right], n[i]))]
            if len(js):
                equal = regs[js] == regs[i]
                js = js[equal.argmax(axis=1) == unit[0]]  # the first band that they share speaks for the pair
            if len(js):
                guess = estimate(regs[js], np.repeat(regs[i : i + 1], len(js), 0), n[js], np.repeat(n[i], len(js)))
                likely = guess >= percent / 100 - SLACK
                found.append((np.full(likely.sum(), ids[i]), ids[js[likely]], guess[likely]))
        if not found:
            return _members(unit, np.zeros(0, np.int64), np.zeros(0, np.int64), [])
        x, y, guess = map(np.concatenate, zip(*found))
        order = np.argsort(-guess, kind="stable")  # the likeliest first
        used, first = np.unique(ids, return_index=True)
        some = np.isin(used, np.r_[x, y])
        return _members(unit, used[some], comp[first[some]], [np.stack([x[order], y[order]]).tobytes()])

    return compare


def _members(unit: list[int], ids: np.ndarray, comp: np.ndarray, pairs: list[bytes]) -> pa.Table:
    n = len(ids) + len(pairs)
    columns = [pa.array([u] * n, pa.int32() if k == 0 else pa.int64()) for k, u in enumerate(unit)]
    empty = [None] * len(pairs)
    return pa.table([*columns, pa.array([*ids.tolist(), *empty], pa.int64()), pa.array([*comp.tolist(), *empty], pa.int64()),
                     pa.array([None] * len(ids) + pairs, pa.binary())], [*UNIT, "class", "component", "pairs"])


def _verify_block(percent: int):
    """Links of one block pair that join components, verified on full sets; a pair that is joined already is passed over."""

    def verify(members: pa.Table, pairs: pa.Table) -> pa.Table:
        release()
        sets = {c: np.frombuffer(s.as_py(), U64) for c, s in zip(members.column("class").to_pylist(), members.column("members"))}
        place = dict(zip(members.column("class").to_pylist(), members.column("component").to_pylist()))
        parent = {c: c for c in place.values()}
        links = []

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for packed in pairs.column("pairs"):
            for a, b in np.frombuffer(packed.as_py(), np.int64).reshape(2, -1).T.tolist():
                x, y = root(place[a]), root(place[b])
                if x != y:
                    common = _common(sets[a], sets[b])
                    if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                        parent[x] = y
                        links.append((a, b))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return verify


def _apart(members: DataFrame, comp: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links between classes that share a bucket, lie in different components and have not been compared.

    Blocks of a bucket are compared by registers first, then the classes with
    candidates bring their sets; only links that join components come out.
    """
    placed = members.join(comp.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    bucket = placed.groupBy("band", "key").agg(
        F.count("*").alias("size"), F.min(F.struct("class", "component")).alias("lowest"),
        F.min("component").alias("from"), F.max("component").alias("to"))
    bucket = spill(bucket.filter((F.col("size") > 2) & (F.col("from") < F.col("to"))).select("band", "key", "size", "lowest"), "buckets")
    open_ = placed.join(bucket, ["band", "key"]).filter(F.col("class") != F.col("lowest.class")).withColumn(
        "other", F.col("component") != F.col("lowest.component"))
    others = open_.groupBy("band", "key").agg(F.sum(F.col("other").cast("long")).alias("others"))
    open_ = open_.join(spill(others, "others"), ["band", "key"]).filter("others > 0").join(
        classes.select("class", "n", "registers"), "class")
    many = F.ceil(F.col("others") / BLOCK).cast("long"), F.ceil(F.col("size") / BLOCK).cast("long")
    spread = F.xxhash64("class")
    columns = ["band", "key", "class", "component", "n", "registers"]
    left = open_.filter("other").select(
        *columns, F.lit(True).alias("other"), F.pmod(spread, many[0]).alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), many[1] - 1)).alias("j"))
    right = open_.select(
        *columns, F.lit(False).alias("other"), F.explode(F.sequence(F.lit(0).cast("long"), many[0] - 1)).alias("i"),
        F.pmod(spread, many[1]).alias("j"))
    found = spill(left.unionByName(right).groupBy(*UNIT).applyInArrow(_block_pairs(percent), MEMBERS), "block-pairs")
    holding = found.filter("pairs IS NULL").drop("pairs").join(sets, "class")
    unit = [f"of_{c}" for c in UNIT]
    pairs = found.filter("pairs IS NOT NULL").select(*(F.col(c).alias(u) for c, u in zip(UNIT, unit)), "pairs")
    return holding.groupBy(*UNIT).cogroup(pairs.groupBy(*unit)).applyInArrow(_verify_block(percent), "a long, b long")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row for each row of ``df``: doc_id, n_shingles, component_id, kept.

    Texts are linked if ``100 * common >= percent * union`` on their sets of
    distinct five-word shingles (words between blanks, A-Z lower-cased); a text
    of fewer words is one shingle.  ``component_id`` is the smallest id that
    links reach, ``kept`` tells whether it is the row's own.  A text that is null
    or has no words links with nothing.  A row without an id links with nothing
    and is kept, its component_id is null.  Repeated rows all appear.  Candidates
    are found by bands: at a limit of 80 % one pair in 38,000 is missed; whatever
    is linked is verified on full sets.
    """
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    held = Held()
    marks = held.keep(docs.withColumn("s", signature("text")).select("doc_id", "s.*"))
    usable = marks.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = spill(usable.groupBy("low", "high", "n_shingles").agg(
        F.min("doc_id").alias("class"), F.first("registers").alias("registers")).withColumnRenamed("n_shingles", "n"), "classes")

    members = classes.select("class", F.posexplode("registers").alias("band", "key"))
    bucket = members.groupBy("band", "key").agg(F.min("class").alias("b"), F.count("*").alias("size")).filter("size > 1")
    bucket = spill(bucket, "pivots")
    placed = spill(members.join(bucket, ["band", "key"]).select("band", "key", "class", "b"), "members")
    pairs = placed.filter(F.col("class") != F.col("b")).select(F.col("class").alias("a"), "b").distinct()
    first = classes.select(F.col("class").alias("a"), "n", F.col("registers").alias("x"))
    second = classes.select(F.col("class").alias("b"), F.col("n").alias("m"), F.col("registers").alias("y"))
    pairs = _similar(pairs.join(first, "a").join(second, "b"), percent).select("a", "b")
    wanted = placed.select(F.col("class").alias("doc_id")).distinct()
    sets = held.keep(docs.join(wanted, "doc_id", "left_semi").select(
        F.col("doc_id").alias("class"), full_set("text").alias("members")).dropDuplicates(["class"]))
    links = spill(_verified(pairs, sets, percent), "links")
    comp = spill(components(links), "components")

    more = _apart(placed.drop("b"), comp, classes, sets, percent)
    links = comp.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)
    comp = components(links).withColumnRenamed("node", "class")

    named = classes.join(comp, "class", "left").select(
        "low", "high", F.col("n").alias("n_shingles"), F.coalesce("component", "class").alias("component"))
    own = marks.withColumn("low", F.when(F.col("doc_id").isNotNull(), F.col("low")))
    out = own.join(named, ["low", "high", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"))
    out = spill(out, "near-duplicates")
    held.release()
    for table in (classes, bucket, placed, links):
        discard(table)
    return out


def without_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` that stay: one of each group of near duplicates, with the columns they had."""
    name = unused(df, "gone")
    gone = near_duplicates(df, doc_id, text, percent).filter(~F.col("kept")).select(F.col("doc_id").alias(name))
    gone = spill(gone, "copies")  # its size is known then, so that few ids are not joined by moving all texts
    return df.join(gone, F.col(f"`{doc_id}`") == F.col(name), "left_anti")
