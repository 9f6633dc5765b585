"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of the benchmark items.  Their symbols are words;
a block is two neighbouring words.  The shift table tells for the block under
the end of the search window how far the window may move without passing an
occurrence.  Where it may not move, the suffix hash selects a bucket of
patterns, and what remains is compared byte by byte.  Many stretches of text
move on together, one numpy operation for a step of all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.session import scratch_path

from .store import unused
from .words import ALNUM, U64, Words, grams, slices, words_of

#: Words of a window.
WINDOW = 10
#: Benchmark text whose search tables are broadcast at once; a larger benchmark is searched in several passes.
BLOCK_BYTES = 32 << 20
#: Window starts that one stretch of text covers.
STRETCH = 256

RESULT = "n_words long, starts array<int>, ends array<int>, items array<string>"


class Machine:
    """Search tables for the windows of one length."""

    def __init__(self, length: int, hashes: np.ndarray, texts: list[bytes], owners: list[np.ndarray]):
        self.length, self.block = length, min(2, length)
        full = grams(hashes.reshape(-1), length)[::length] if len(hashes) else np.zeros(0, U64)
        suffix = self.block_hash(hashes, np.full(len(hashes), length - 1))
        order = np.lexsort((full, suffix))
        self.hashes, self.full, self.suffix = hashes[order], full[order], suffix[order]
        self.texts = [texts[i] for i in order]
        self.owner = np.concatenate([owners[i] for i in order]) if owners else np.zeros(0, np.int64)
        self.owner_at = np.cumsum([0, *(len(owners[i]) for i in order)])
        self.mask = U64((1 << max(10, min(24, int(8 * len(hashes)).bit_length()))) - 1)
        self.far = length - self.block + 1
        self.shift = np.full(int(self.mask) + 1, self.far, np.uint8)
        for end in range(self.block - 1, length):
            at = self.block_hash(hashes, np.full(len(hashes), end)) & self.mask
            np.minimum.at(self.shift, at.astype(np.int64), length - 1 - end)

    def block_hash(self, rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the block that ends at a column of each row."""
        rows_at = np.arange(len(rows))
        return self.blocks(rows[rows_at, ends], rows[rows_at, ends - 1] if self.block == 2 else None)

    @staticmethod
    def blocks(last: np.ndarray, before: np.ndarray | None) -> np.ndarray:
        out = last * U64(0x9FB21C651E98DF25)
        if before is not None:
            out += before * U64(0xC2B2AE3D27D4EB4F)
        return out ^ (out >> U64(29))

    def occurrences(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """First word and pattern number of every occurrence in the texts."""
        starts, length = words.first[:-1], self.length
        lasts = words.first[1:] - length + 1
        stretches = np.maximum(0, -(-(lasts - starts) // STRETCH))
        if not stretches.any() or not len(self.full):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        text = np.repeat(np.arange(len(starts)), stretches)
        part = np.arange(len(text)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        at = starts[text] + part * STRETCH
        stop = np.minimum(at + STRETCH, lasts[text])
        at, stop, found = at + length - 1, stop + length - 1, []
        h = words.hash
        while len(at):
            block = self.blocks(h[at], h[at - 1] if self.block == 2 else None)
            move = self.shift[(block & self.mask).astype(np.int64)]
            here = move == 0
            if here.any():
                found.append((at[here] - length + 1, block[here]))
            at = at + np.maximum(move, 1)
            live = at < stop
            if not live.all():
                at, stop = at[live], stop[live]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return self.confirmed(words, *map(np.concatenate, zip(*found)))

    def confirmed(self, words: Words, at: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.searchsorted(self.suffix, suffix, "left")
        high = np.searchsorted(self.suffix, suffix, "right")
        some = low < high
        at, low, high = at[some], low[some], high[some]
        total = words.hash[at].copy()
        for j in range(1, self.length):
            total *= U64(0xD6E8FEB86659FD93)
            total += words.hash[at + j]
        whole, end = grams_of(total), high.copy()
        while (open_ := low < end).any():  # the pattern's place in its bucket, which is in order of the whole hash
            middle = (low + end) // 2
            less = open_ & (self.full[np.minimum(middle, len(self.full) - 1)] < whole)
            low = np.where(less, middle + 1, low)
            end = np.where(open_ & ~less, middle, end)
        same = (low < high) & (self.full[np.minimum(low, len(self.full) - 1)] == whole)
        at, pattern = at[same], low[same]
        lower, data, s, e = ALNUM.lower, words.data, words.starts, words.ends
        equal = [lower[data[s[a] : e[a + self.length - 1]]].tobytes() == self.texts[p]
                 or joined(words, a, self.length) == joined_text(self.texts[p]) for a, p in zip(at.tolist(), pattern.tolist())]
        equal = np.array(equal, bool)
        return at[equal], pattern[equal]


def grams_of(total: np.ndarray) -> np.ndarray:
    from .words import mix

    return mix(total)


def joined(words: Words, at: int, length: int) -> bytes:
    """Lower-cased words with one blank between them."""
    return b" ".join(ALNUM.lower[words.data[words.starts[i] : words.ends[i]]].tobytes() for i in range(at, at + length))


def joined_text(raw: bytes) -> bytes:
    """The same of a stretch of text."""
    plain = words_of(pa.array([raw], pa.binary()), ALNUM)
    return joined(plain, 0, len(plain.hash))


class Patterns:
    """The windows of a block of items, by length."""

    def __init__(self, ids: list[str | None], texts: list[str | None], window: int = WINDOW):
        named = sorted({i for i in ids if i is not None})
        number = {name: k for k, name in enumerate(named)}
        self.items = pa.array(named, pa.string())
        words = words_of(pa.array([t or "" for t in texts], pa.large_string()), ALNUM)
        by: dict[int, dict[bytes, tuple[np.ndarray, bytes, set[int]]]] = {}
        for k, name in enumerate(ids):
            first, last = words.first[k], words.first[k + 1]
            length = int(min(window, last - first))
            for at in range(first, last - length + 1) if length else ():
                row = words.hash[at : at + length]
                raw = ALNUM.lower[words.data[words.starts[at] : words.ends[at + length - 1]]].tobytes()
                entry = by.setdefault(length, {}).setdefault(row.tobytes(), (row, raw, set()))
                if name is not None:
                    entry[2].add(number[name])
        self.machines = [
            Machine(length, np.array([row for row, _, _ in found.values()], U64), [raw for _, raw, _ in found.values()],
                    [np.array(sorted(owners), np.int64) for _, _, owners in found.values()])
            for length, found in sorted(by.items())]

    def search(self, texts: pa.Array, earlier: pa.StructArray | None = None) -> pa.StructArray:
        """Words, stretches of hit words and items of each text, joined with what was found ``earlier``."""
        words = words_of(texts, ALNUM)
        n, change = len(texts), np.zeros(len(words.hash) + 1, np.int64)
        pairs = [np.zeros(0, np.int64)]
        width = max(1, len(self.items))
        for machine in self.machines:
            at, pattern = machine.occurrences(words)
            np.add.at(change, at, 1)
            np.add.at(change, at + machine.length, -1)
            count = machine.owner_at[pattern + 1] - machine.owner_at[pattern]
            text = np.repeat(np.searchsorted(words.first, at, "right") - 1, count)
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            pairs.append(text * width + machine.owner[np.repeat(machine.owner_at[pattern], count) + inner])
        if earlier is not None:
            for k, row in enumerate(earlier.to_pylist()):
                np.add.at(change, words.first[k] + np.array(row["starts"], np.int64), 1)
                np.add.at(change, words.first[k] + np.array(row["ends"], np.int64), -1)
        hit = np.cumsum(change[:-1]) > 0
        if len(hit):
            begins, ends = hit.copy(), hit.copy()
            begins[1:] &= ~hit[:-1]
            ends[:-1] &= ~hit[1:]
            inner = words.first[(words.first > 0) & (words.first < len(hit))]  # a stretch ends with its text
            begins[inner] |= hit[inner]
            ends[inner - 1] |= hit[inner - 1]
            begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
        else:
            begins = ends = np.zeros(0, np.int64)
        place = np.searchsorted(begins, words.first).astype(np.int32)
        origin = np.repeat(words.first[:-1], np.diff(place))
        lists = [pa.ListArray.from_arrays(pa.array(place), pa.array((x - origin).astype(np.int32))) for x in (begins, ends + 1)]
        pair = np.unique(np.concatenate(pairs))
        of_text = np.searchsorted(pair // width, np.arange(n + 1)).astype(np.int32)
        items = self.items.take(pa.array(pair % width)) if len(self.items) else pa.array([], pa.string())
        items = pa.ListArray.from_arrays(pa.array(of_text), items)
        if earlier is not None:
            items = pa.array([sorted({*a, *b}) for a, b in zip(items.to_pylist(), earlier.field("items").to_pylist())],
                             pa.list_(pa.string()))
        return pa.StructArray.from_arrays([pa.array(words.counts.astype(np.int64)), *lists, items],
                                          ["n_words", "starts", "ends", "items"])


def _searcher(tables):
    """Search with broadcast tables, in texts or in texts and what was found in them before."""

    @F.arrow_udf(RESULT)
    def search(*columns: pa.Array) -> pa.Array:
        got = [tables.value.search(part, *(c.slice(at, len(part)) for c in columns[1:])) for at, part in slices(columns[0], 2 << 20)]
        return pa.concat_arrays(got) if got else tables.value.search(*columns)

    return search


def find_items(df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
               window: int = WINDOW, found: str = "found", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add ``found``: the words of each whole text that lie in an occurrence of a window of an item.

    ``found`` is ``struct<n_words, starts, ends, items>``: the number of words,
    the stretches ``[start, end)`` of hit words, and the ids of items with
    occurring windows, as sorted distinct strings.  A window is ``window``
    consecutive words of an item; an item with fewer words is one window, one
    without words has none.  Null texts have no words; an item with a null id
    hits words but is not listed; items that share an id count as one; repeated
    rows keep their own result; a column already named ``found`` is replaced.
    With an empty benchmark nothing is hit.

    The items come to the driver in blocks of some ``block_bytes`` of text, whose
    tables are broadcast one after another; results of a pass are written to the
    shared folder before the next.  No text is shuffled, and no group matters.
    """
    spark = df.sparkSession
    bench = items.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{item_text}`").alias("words"))
    size = bench.agg(F.sum(F.octet_length("words") + 16)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    out = df.drop(found)
    for block in range(blocks):
        part = bench.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block) if blocks > 1 else bench
        rows = part.collect()
        tables = spark.sparkContext.broadcast(Patterns([r.item for r in rows], [r.words for r in rows], window))

        columns = [F.col(f"`{text}`")] + ([F.col(f"`{found}`")] if block else [])
        out = out.withColumn(found, _searcher(tables)(*columns))
        if blocks > 1:
            path = scratch_path(spark, "contamination")
            out.write.parquet(path)
            out = spark.read.parquet(path)
    return out


def hit_words(found: str = "found"):
    """Number of hit words of a result of ``find_items``."""
    total = F.aggregate(F.arrays_zip(f"{found}.starts", f"{found}.ends"), F.lit(0).cast("long"),
                        lambda sum_, span: sum_ + (span["ends"] - span["starts"]).cast("long"))
    return total


def without_items(df: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` without any hit word, with the columns they had."""
    name = unused(df, "found")
    marked = find_items(df, items, text, found=name, **options)
    return marked.filter(F.size(f"{name}.starts") == 0).drop(name)
