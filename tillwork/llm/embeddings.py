"""Embedding near-duplicates by p-stable hashing and exact cosine checks.

The normalised vectors are projected on random Gaussian directions, and the
projections are cut into steps of equal width.  ``PROJECTIONS`` steps together
with the label name the bucket of a table; ``TABLES`` tables are used.  Equal
vectors are one class.  Classes of a bucket are compared block by block with
exact cosines; a pair counts in the first table where it meets, so the blocks
of a task give link counts and a spanning forest instead of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .graph import components
from .store import spill
from .words import U64, mix

COSINE = 0.93
#: At the cosine limit (distance 0.374) a projection agrees with probability 0.702, so a table of six
#: finds a pair with 0.119; 48 tables miss one pair in 440.  Unrelated vectors agree with 0.27.
TABLES, PROJECTIONS, WIDTH = 48, 6, 1.0
SEED = 20_240_229
#: Vectors in a block.
BLOCK = 512


def directions(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The projections and offsets, the same in every process."""
    rng = np.random.default_rng(SEED + size)
    return rng.standard_normal((size, TABLES * PROJECTIONS)), rng.uniform(0, WIDTH, TABLES * PROJECTIONS)


def unit_rows(flat: np.ndarray, size: int) -> np.ndarray:
    rows = flat.astype(np.float64).reshape(-1, size)
    scale = np.abs(rows).max(axis=1, keepdims=True)
    rows = rows / np.where(scale > 0, scale, 1)
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-300)


@F.arrow_udf(T.ArrayType(T.LongType()))
def bucket_keys(vectors: pa.Array) -> pa.Array:
    """The bucket number in every table, for usable vectors of one batch."""
    out: list[np.ndarray | None] = [None] * len(vectors)
    rows = [np.asarray(v.values.to_numpy(zero_copy_only=False), float) for v in vectors]
    for size in {len(r) for r in rows}:
        at = [i for i, r in enumerate(rows) if len(r) == size]
        lines, offsets = directions(size)
        steps = np.floor((unit_rows(np.concatenate([rows[i] for i in at]), size) @ lines + offsets) / WIDTH).astype(np.int64)
        steps = steps.view(np.uint64).reshape(len(at), TABLES, PROJECTIONS)
        key = np.full((len(at), TABLES), U64(size))
        for p in range(PROJECTIONS):
            key = mix(key * U64(0x9E3779B97F4A7C15) + steps[:, :, p])
        for k, i in enumerate(at):
            out[i] = key[k].view(np.int64)
    return pa.array(out, pa.list_(pa.int64()))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number that links reach, of each of n numbers."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


UNIT = ["label", "table", "key", "i", "j"]


def _unit_starts(rows: pa.Table) -> np.ndarray:
    """Where a new block pair of a bucket begins, in rows sorted by it."""
    fresh = np.zeros(rows.num_rows, bool)
    fresh[0] = True
    for name in UNIT:
        column = rows.column(name).to_numpy()
        fresh[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(fresh)


def _sorted_links(cosine: float):
    """Link counts and spanning links of whole block pairs, which come one after another."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            if rows.num_rows:
                last = int(_unit_starts(rows)[-1])
                held = rows.slice(last)
                yield from links(rows.slice(0, last).combine_chunks())
        if held is not None:
            yield from links(held.combine_chunks())

    def links(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        vectors = rows.column("embedding").combine_chunks()
        sizes = np.diff(vectors.offsets.to_numpy())
        ids, place = np.unique(rows.column("class").to_numpy(), return_inverse=True)
        copies = rows.column("copies").to_numpy()
        unit = np.zeros(rows.num_rows, np.int64)
        unit[_unit_starts(rows)] = 1
        unit = np.cumsum(unit)
        table, second = rows.column("table").to_numpy(), rows.column("second").to_numpy(zero_copy_only=False)
        alone = rows.column("i").to_numpy() == rows.column("j").to_numpy()
        keys = rows.column("keys").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, TABLES)
        flat, found = vectors.flatten().to_numpy(zero_copy_only=False), []
        for size in np.unique(sizes):  # a bucket holds vectors of one length
            own = np.flatnonzero(sizes == size)
            unit_vectors = unit_rows(flat[np.repeat(sizes == size, sizes)], int(size))
            step = 0
            while True:
                step += 1
                b = np.flatnonzero(unit[own[step:]] == unit[own[:-step]]) + step
                if not len(b):
                    break
                a = b - step
                pair = alone[own[b]] | (second[own[a]] != second[own[b]])
                a, b = a[pair], b[pair]
                near = np.einsum("ij,ij->i", unit_vectors[a], unit_vectors[b]) >= cosine
                a, b = own[a[near]], own[b[near]]
                met = ((keys[a] == keys[b]) & (np.arange(TABLES) < table[a][:, None])).any(axis=1)
                found.append((a[~met], b[~met]))
        if not found:
            return
        a, b = map(np.concatenate, zip(*found))
        n = len(ids)
        counts = np.bincount(place[a], copies[b], n) + np.bincount(place[b], copies[a], n)
        some, roots = np.flatnonzero(counts), _roots(n, place[a], place[b])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[some]), pa.array(counts[some].astype(np.int64)), pa.array(ids[roots[some]])], ["class", "links", "root"])

    return compare


def vector_links(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 cosine: float = COSINE) -> DataFrame:
    """One row for each row of ``df``: vec_id, n_links, component_id, kept.

    Two vectors are linked if their labels are equal and not null and their
    cosine in double precision is ``cosine`` or more.  ``n_links`` counts the
    other vectors linked directly, ``component_id`` is the smallest id that links
    reach, ``kept`` tells whether it is the row's own.  Vectors that are null,
    empty, zero or hold null or non-finite components, vectors without a label
    or id, and vectors of different lengths link with nothing; a row without id
    is kept and its component_id is null.  Repeated rows count as vectors of
    their own.  Each bucket is dealt out in blocks of ``BLOCK`` vectors, so no
    bucket has to fit in a task.
    """
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("embedding"),
                     F.col(f"`{label}`").cast("string").alias("label"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
              & ~F.coalesce(bad, F.lit(True)) & F.exists("embedding", lambda x: x != 0))
    # -0.0 and 0.0 are the same component
    plain = F.transform("embedding", lambda x: x + F.lit(0.0))
    rows = rows.withColumn("embedding", plain).withColumn("ok", F.coalesce(usable, F.lit(False)))
    rows = rows.withColumn("digest", F.when(F.col("ok"), F.sha2(F.concat_ws(",", F.col("label"), F.transform("embedding", lambda x: F.hex(x.cast("string")))), 256)))
    classes = rows.filter("ok").groupBy("digest").agg(
        F.min("vec_id").alias("class"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"), F.first("label").alias("label"))
    classes = spill(classes.withColumn("keys", bucket_keys("embedding")), "vectors")

    members = classes.select("class", "label", F.posexplode("keys").alias("table", "key"))
    size = members.groupBy("label", "table", "key").agg(F.count("*").alias("size")).filter("size > 1")
    size = spill(size, "buckets")
    blocks = F.ceil(F.col("size") / BLOCK).cast("long")
    own = F.pmod(F.xxhash64("class"), F.col("blocks"))
    placed = members.join(size, ["label", "table", "key"]).withColumn("blocks", blocks).withColumn("own", own).join(
        classes.select("class", "copies", "embedding", "keys"), "class")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = placed.withColumn("other", other).select(
        "label", "table", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).alias("second"), "class", "copies", "embedding", "keys")
    dealt = dealt.repartition(*UNIT).sortWithinPartitions(*UNIT)
    found = spill(dealt.mapInArrow(_sorted_links(cosine), "class long, links long, root long"), "links")
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("class").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "class")
    named = classes.select("digest", "class", "copies").join(counts, "class", "left").join(comp, "class", "left").select(
        "digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        F.coalesce("component", "class").alias("component"))
    return rows.drop("embedding").join(named, "digest", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(True)).alias("kept"))
