"""Language-model scores by deleted interpolation of word bigrams.

Maximum-likelihood estimates of bigrams and words and a uniform share are mixed;
the weights depend on how often the context was seen and are learned by
expectation-maximisation on one fold of the training texts, with the counts of
that fold left out.

Counts travel as packed arrays.  Texts are dealt into blocks.  A block sends its
distinct words and bigrams once, cut into key ranges; the range adds up all
blocks and answers each with the totals, in the order that it sent.  So a
frequent word is one entry of each block, whatever its number of occurrences,
and all tables grow with the texts and are spread over all ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import spill
from .words import U64, mix, release, slices, words_of

START, END = U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)
#: Folds by crc32 of the id: one is held out of training, one of the others teaches the weights.
FOLDS, HELD_OUT, DELETED = 5, 1, 0
#: Contexts seen 2**(b-1) to 2**b - 1 times are bucket b; bucket 0 was not seen.
BUCKETS = 33
#: Cells of the held-out histogram: quarter powers of two of each estimate.
CELLS, STEPS = 160, 4
#: Bytes of text whose keys a worker holds at once.
PORTION = 24 << 20
ROUNDS, TOLERANCE = 500, 1e-10


def planes(values: np.ndarray) -> bytes:
    """Numbers as their first bytes, then all second bytes and so on, which compresses well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T).tobytes()


def unplanes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


def rising(keys: np.ndarray) -> bytes:
    """Sorted numbers as their differences."""
    return planes(np.diff(keys, prepend=U64(0)))


def risen(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, U64), dtype=U64)


def packed(values: np.ndarray) -> bytes:
    """Counts, compressed: four bytes each, or eight where one needs them."""
    wide = bool(len(values)) and int(values.max()) >> 32 > 0
    plain = planes(values.astype(np.uint64 if wide else np.uint32))
    return len(values).to_bytes(8, "little") + bytes([8 if wide else 4]) + pa.compress(plain, "zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    size, width = int.from_bytes(data[:8], "little"), data[8]
    return unplanes(pa.decompress(data[9:], width * size, "zstd", asbytes=True), np.uint64 if width == 8 else np.uint32)


def tokens(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and bigrams of the texts, each text closed by the end token, and where texts begin."""
    words, bigrams, sizes = [], [], []
    for chunk in texts.chunks:
        for _, part in slices(chunk):
            found = words_of(part)
            token = np.insert(found.hash, found.first[1:], END)
            before = np.empty_like(token)
            before[1:] = token[:-1]
            before[found.first[:-1] + np.arange(len(part))] = START
            words.append(token)
            bigrams.append(mix(before * U64(0x9FB21C651E98DF25) + token * U64(0xD6E8FEB86659FD93) + U64(1)))
            sizes.append(found.counts + 1)
    begins = np.cumsum(np.r_[0, *sizes]).astype(np.int64)
    empty = np.zeros(0, U64)
    return (np.concatenate(words) if words else empty), (np.concatenate(bigrams) if bigrams else empty), begins


def _ranges(n: int) -> np.ndarray:
    return (np.arange(n, dtype=U64) * U64((2**64 - 1) // n)).astype(U64)


def portions(docs: pa.Table):
    """Parts of a block with some ``PORTION`` bytes of text each, the same ones in whatever order its rows come."""
    count = -(-(pc.sum(pc.binary_length(docs.column("text"))).as_py() + 1) // PORTION)
    portion = docs.column("spread").to_numpy() % count
    for p in range(count):
        yield p, docs.filter(pa.array(portion == p))


def _requests(ranges: int):
    """The distinct keys of a block's portions with their own training counts, in key ranges."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = pa.Table.from_batches(list(batches))
        block = docs.column("block")[0].as_py()
        for portion, part in portions(docs):
            words, bigrams, begins = tokens(part.column("text"))
            fold = np.repeat(part.column("fold").to_numpy(), np.diff(begins))
            for kind, values in enumerate((words, bigrams)):
                keys, place = np.unique(values, return_inverse=True)
                train = np.bincount(place[fold != HELD_OUT], minlength=len(keys)).astype(np.uint32)
                deleted = np.bincount(place[fold == DELETED], minlength=len(keys)).astype(np.uint32)
                cuts = np.r_[np.searchsorted(keys, _ranges(ranges)), len(keys)]
                own = [slice(cuts[r], cuts[r + 1]) for r in range(ranges)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(ranges, dtype=np.int32)), *(pa.array(np.full(ranges, x, np.int32)) for x in (block, portion, kind)),
                     *(pa.array([pack(x[o]) for o in own], pa.binary()) for pack, x in
                       ((rising, keys), (packed, train), (packed, deleted)))], REQUESTED)

    return send


#: Bytes of text for each block and each range of keys.
BLOCK_BYTES = 16 << 20
REQUEST = "range int, block int, portion int, kind int, keys binary, train binary, deleted binary"
REQUESTED = [part.split()[0] for part in REQUEST.split(", ")]
ANSWER = ("block int, portion int, range int, kind int, check long, train binary, deleted binary, "
          "n_train long, n_deleted long, n_types long")


def answer(requests: pa.Table) -> pa.Table:
    """The totals of a key range, for each block in the order of its keys."""
    release()
    rows = []
    for kind in (0, 1):
        part = [r for r in requests.to_pylist() if r["kind"] == kind]
        keys = [risen(r["keys"]) for r in part]
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = [np.bincount(place, np.concatenate([unpacked(r[c]) for r in part])).astype(np.uint64)  # sums of floats, exact below 2**53
                  for c in ("train", "deleted")]
        at = np.cumsum([0, *map(len, keys)])
        figures = int(totals[0].sum()), int(totals[1].sum()), int((totals[0] > 0).sum())
        for k, row in enumerate(part):
            own = place[at[k] : at[k + 1]]
            rows.append((row["block"], row["portion"], row["range"], kind, int(np.add.reduce(keys[k]).view(np.int64)) if len(keys[k]) else 0,
                         *(packed(t[own]) for t in totals), *figures))
    return _table(rows, ANSWER)


def _table(rows: list[tuple], columns: str) -> pa.Table:
    names, kinds = zip(*(part.split() for part in columns.split(", ")))
    arrow = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.table([pa.array([r[i] for r in rows], arrow[kind]) for i, kind in enumerate(kinds)], list(names))


COUNTED = ("row long, fold int, n_tokens long, words binary, bigrams binary, deleted_words binary, deleted_bigrams binary, "
           "n_train long, n_deleted long, n_types long, n_starts long, n_deleted_starts long")


def counted(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """For each text the training counts of its words and bigrams, in order."""
    answers = answers.sort_by([("portion", "ascending"), ("kind", "ascending"), ("range", "ascending")])
    out = []
    for portion, part in portions(docs):
        if part.num_rows:
            out.extend(_counted(part, answers.filter(pc.equal(answers.column("portion"), portion)).to_pylist()))
    return _table(out, COUNTED)


def _counted(docs: pa.Table, answers: list[dict]):
    words, bigrams, begins = tokens(docs.column("text"))
    totals = []
    for kind, values in enumerate((words, bigrams)):
        keys, place = np.unique(values, return_inverse=True)
        part = [r for r in answers if r["kind"] == kind]
        sums = [[unpacked(r[c]) for r in part] for c in ("train", "deleted")]
        at = np.cumsum([0, *map(len, sums[0])])
        if at[-1] != len(keys) or any(
                len(k) and int(np.add.reduce(k).view(np.int64)) != r["check"] for k, r in zip(np.split(keys, at[1:-1]), part)):
            raise ValueError("the texts have changed between two reads; write them to a table first")
        totals.append([np.concatenate(s)[place] for s in sums])
        if kind == 0:
            end = int(np.searchsorted(keys, END))
            starts = [int(np.concatenate(s)[end]) for s in sums]
    figures = [sum(r[c] for r in answers if r["kind"] == 0) for c in ("n_train", "n_deleted", "n_types")]
    fold, row = docs.column("fold").to_pylist(), docs.column("row").to_pylist()
    for k, (first, last) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist())):
        full = [packed(t[0][first:last]) for t in totals]
        less = [packed(t[0][first:last] - t[1][first:last]) for t in totals] if fold[k] == DELETED else (None, None)
        yield row[k], fold[k], last - first, *full, *less, *figures, *starts


def estimates(words: np.ndarray, bigrams: np.ndarray, starts: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context bucket, bigram estimate and word estimate of each token of a text."""
    context = np.empty(len(words), np.int64)
    context[1:] = words[:-1]
    context[:1] = starts
    bucket = np.frexp(context.astype(float))[1]
    return bucket, bigrams / np.maximum(context, 1), words / max(n, 1)


def held_out_cells(starts: int, n: int):
    """Histogram of the deleted fold: bucket and size of both estimates."""

    def gather(batches):
        shape = (BUCKETS, CELLS, CELLS)
        for batch in batches:
            codes, logs = [], []
            for words, bigrams in zip(batch.column(0), batch.column(1)):
                bucket, two, one = estimates(*(unpacked(x.as_py()).astype(np.int64) for x in (words, bigrams)), starts, n)
                log = [np.log(np.where(f > 0, f, 1.0)) for f in (two, one)]
                cell = [np.where(f > 0, np.minimum(CELLS - 1, 1 + (-v / np.log(2) * STEPS).astype(int)), 0)
                        for f, v in zip((two, one), log)]
                codes.append(np.ravel_multi_index((bucket, *cell), shape))
                logs.append(log)
            if codes:
                code, place = np.unique(np.concatenate(codes), return_inverse=True)
                sums = [np.bincount(place, np.concatenate([v[i] for v in logs])) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code), pa.array(np.bincount(place).astype(float)), *map(pa.array, sums)], ["code", "n", "two", "one"])

    return gather


def learn_weights(cells: list[tuple[int, float, float, float]], types: int) -> np.ndarray:
    """Weights (bigram, word, uniform) of each context bucket by expectation-maximisation.

    Every share starts and ends with one pseudo-count, so none is zero.  A bucket
    without held-out tokens takes the weights of the next lower one.  A bucket
    that does not reach the tolerance is an error.
    """
    weights = np.tile([0.0, 0.9, 0.1], (BUCKETS, 1))
    if not cells:
        weights[1:] = [0.4, 0.5, 0.1]
        return weights
    code, n, two, one = (np.array(x, float) for x in zip(*cells))
    bucket, two_cell, one_cell = np.unravel_index(code.astype(np.int64), (BUCKETS, CELLS, CELLS))
    parts = np.stack([np.where(two_cell > 0, np.exp(two / n), 0), np.where(one_cell > 0, np.exp(one / n), 0),
                      np.full(len(n), 1 / (types + 1))])
    for b in range(BUCKETS):
        here = bucket == b
        if not here.any():
            weights[b] = weights[b - 1] if b > 1 else weights[b] if b == 0 else [0.4, 0.5, 0.1]
            continue
        share, used = parts[:, here], np.array([b > 0, 1, 1], float)
        now, last = used / used.sum(), -np.inf
        for _ in range(ROUNDS):
            mixed = now[:, None] * share
            total = mixed.sum(axis=0)
            now = ((mixed / total * n[here]).sum(axis=1) + 1) * used
            now /= now.sum()
            value = float((np.log(total) * n[here]).sum() / n[here].sum())
            if abs(value - last) < TOLERANCE:
                break
            last = value
        else:
            if abs(value - last) > 1e-6:
                raise RuntimeError(f"the weights of bucket {b} do not settle")
        weights[b] = now
    return weights


def _scorer(weights: np.ndarray, n: int, types: int, starts: int):
    @F.arrow_udf("n_known long, base_score double, score double")
    def score(words: pa.Array, bigrams: pa.Array) -> pa.Array:
        out = []
        for w, b in zip(words, bigrams):
            w, b = (unpacked(x.as_py()).astype(np.int64) for x in (w, b))
            bucket, two, one = estimates(w, b, starts, n)
            mixed = weights[bucket]
            model = mixed[:, 0] * two + mixed[:, 1] * one + mixed[:, 2] / (types + 1)
            base = (w + 0.5) / (n + 0.5 * (types + 1))
            out.append((int((w > 0).sum()), float(np.log10(base).sum()), float(np.log10(model).sum())))
        kinds = (pa.int64(), pa.float64(), pa.float64())
        return pa.StructArray.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                          ["n_known", "base_score", "score"])

    return score


def scores(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``df``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words between blanks, A-Z lower-cased, then one end token; a
    null text has the end token only.  Texts with ``crc32(doc_id) % 5 = 1`` are
    held out of training, a null id is not.  ``base_score`` is the log10
    probability under add-half word frequencies, ``score`` that of the
    interpolated model.  Repeated rows are texts of their own.  Without training
    texts every count is zero and only the uniform share scores.

    Blocks and key ranges are as many as ``spark.sql.shuffle.partitions``, or more: one
    for each ``BLOCK_BYTES`` of text.  A task holds the texts of one block, whose keys
    are worked out in portions, or the keys of one range.  Rows are dealt by id and
    text, so rows without id are spread.
    """
    spark = df.sparkSession
    size = df.agg(F.sum(F.octet_length(F.col(f"`{text}`")).cast("long"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES))
    key = F.coalesce(F.pmod(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")), F.lit(FOLDS)), F.lit(DELETED))
    docs = df.select(
        F.pmod(F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), F.lit(ranges)).cast("int").alias("block"), key.cast("int").alias("fold"),
        F.col(f"`{doc_id}`").cast("long").alias("row"), F.abs(F.xxhash64(F.lit(1), F.col(f"`{doc_id}`"), F.col(f"`{text}`"))).alias("spread"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    requests = docs.groupBy("block").applyInArrow(_requests(ranges), REQUEST)
    answers = requests.groupBy("range").applyInArrow(answer, ANSWER)
    known = spill(docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(counted, COUNTED), "counts")

    figures = known.select("n_train", "n_deleted", "n_types", "n_starts", "n_deleted_starts").first()
    n, deleted, types, starts, deleted_starts = figures or (0, 0, 0, 0, 0)
    held = known.filter(F.col("fold") == DELETED).select("deleted_words", "deleted_bigrams")
    cells = held.mapInArrow(held_out_cells(starts - deleted_starts, n - deleted), "code long, n double, two double, one double")
    cells = cells.groupBy("code").agg(F.sum("n"), F.sum("two"), F.sum("one")).collect()
    weights = learn_weights([tuple(c) for c in cells], types)
    return known.withColumn("s", _scorer(weights, n, types, starts)("words", "bigrams")).select(
        F.col("row").alias("doc_id"), (F.col("fold") == HELD_OUT).alias("held_out"), "n_tokens", "s.n_known",
        F.col("n_train").alias("train_tokens"), "s.base_score", "s.score")
