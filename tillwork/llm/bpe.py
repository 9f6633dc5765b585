"""Byte-level BPE encoding and decoding with a rank queue.

Every match of the split pattern is merged on its own.  Its pairs wait in one
bucket per merge rank; a two-level bitmap says which buckets hold positions, and
find-first-set names the lowest one.  Positions form a linked list; an entry
whose pair has changed since is skipped.  A piece of n bytes costs O(n log n),
whatever its length.  The unknown pieces of a text share a queue: no pair goes
over the border of a piece, so each is merged as it would be alone.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import unused
from .words import release, text_buffer

#: Encoded pieces that a worker keeps, at least the last half of them.
KEPT_PIECES = 500_000
#: Longer texts are split piece by piece, so that not all pieces are held at once.
LONG_TEXT = 1 << 21
#: Characters of the unknown pieces that are merged in one queue.
TOGETHER = 1 << 13


class RankQueue:
    """Positions by rank; the lowest rank comes out first, its leftmost position before others."""

    __slots__ = ("buckets", "high", "low")

    def __init__(self):
        self.buckets: dict[int, list[int]] = {}
        self.low: dict[int, int] = {}
        self.high = 0

    def push(self, rank: int, at: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, at)
            return
        self.buckets[rank] = [at]
        block = rank >> 8
        bits = self.low.get(block)
        if bits:
            self.low[block] = bits | 1 << (rank & 255)
        else:
            self.low[block] = 1 << (rank & 255)
            self.high |= 1 << block

    def fill(self, ranks: list[int | None]) -> None:
        """Take a rank for each position, into an empty queue."""
        buckets, low = self.buckets, self.low
        for at, rank in enumerate(ranks):
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(at)  # rising positions are a heap
                else:
                    buckets[rank] = [at]
        for rank in buckets:
            low[rank >> 8] = low.get(rank >> 8, 0) | 1 << (rank & 255)
        for block in low:
            self.high |= 1 << block

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank and its positions, in order."""
        high = self.high
        block = (high & -high).bit_length() - 1
        bits = self.low[block]
        last = bits & -bits
        rank = block << 8 | (last.bit_length() - 1)
        if bits != last:
            self.low[block] = bits ^ last
        else:
            self.low[block] = 0
            self.high = high & (high - 1)
        return rank, self.buckets.pop(rank)


def merge(pieces: list[bytes], ranks: dict[bytes, int]) -> list[list[int]]:
    """Token ids of each of some pieces, none of them empty."""
    rank_of = ranks.get
    whole = b"".join(pieces)
    n = len(whole)
    after = list(range(1, n + 1))
    before = list(range(-1, n))  # -1 where a piece begins, also behind the last one
    pair: list[int | None] = [rank_of(whole[i : i + 2]) for i in range(n)]
    starts, at = [], 0
    for piece in pieces:
        starts.append(at)
        before[at] = -1
        at += len(piece)
        pair[at - 1] = None
    before[n] = -1
    queue = RankQueue()
    queue.fill(pair)
    push, pop = queue.push, queue.pop
    while queue.high:
        rank, bucket = pop()
        while bucket:
            i = heappop(bucket)
            if pair[i] != rank:
                continue
            gone = after[i]
            end = after[i] = after[gone]
            pair[gone] = new = None
            lower = False
            if before[end] >= 0:
                before[end] = i
                new = rank_of(whole[i : after[end]])
                if new is not None:
                    push(new, i)
                    lower = new < rank
            pair[i] = new
            left = before[i]
            if left >= 0:
                new = pair[left] = rank_of(whole[left:end])
                if new is not None:
                    push(new, left)
                    lower = lower or new < rank
            if lower and bucket:  # what waits below comes first, the rest of the bucket again later
                for i in bucket:
                    push(rank, i)
                break
    out = []
    for i in starts:
        ids = []
        while not ids or before[i] >= 0:
            ids.append(ranks[whole[i : after[i]]])
            i = after[i]
        out.append(ids)
    return out


class Pieces(dict):
    """Piece to its ids as little-endian 32-bit numbers, worked out when first asked for.

    When half of the room is used, what is held becomes the older half; a piece
    that is asked for again moves to the newer one.
    """

    def __init__(self, ranks: dict[bytes, int], kept: int | None = None):
        super().__init__()
        self.ranks = ranks
        self.kept = kept
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            out = np.array(self.merged([piece])[0], "<u4").tobytes()
        if len(piece) < 64:
            self.keep(piece, out)
        return out

    def keep(self, piece: str, ids: bytes) -> None:
        if 2 * len(self) >= (self.kept or KEPT_PIECES):
            self.older = dict(self)
            self.clear()
        self[piece] = ids

    def merged(self, some: list[str]) -> list[list[int]]:
        """Ids of some pieces; the bytes of a piece may be a token already."""
        own = [piece.encode() for piece in some]
        known = [self.ranks.get(piece) for piece in own]
        rest = iter(merge([piece for piece, rank in zip(own, known) if rank is None], self.ranks))
        return [next(rest) if rank is None else [rank] for rank in known]

    def learn(self, found: list[str]) -> None:
        """Work out the short pieces that are not held, some ``TOGETHER`` bytes of them at a time."""
        some, size = [], 0
        for piece in set(found):
            if piece in self or len(piece) >= 64:
                continue
            out = self.older.get(piece)
            if out is not None:
                self.keep(piece, out)
                continue
            some.append(piece)
            size += len(piece)
            if size >= TOGETHER:
                self.learnt(some)
                some, size = [], 0
        if some:
            self.learnt(some)

    def learnt(self, some: list[str]) -> None:
        for piece, ids in zip(some, self.merged(some)):
            self.keep(piece, pack_ids(len(ids))(*ids))


@lru_cache(256)
def pack_ids(count: int):
    """Writes so many ids as little-endian 32-bit numbers."""
    return struct.Struct(f"<{count}I").pack


@lru_cache(2)
def load(ranks_path: str, pattern: str, kept: int | None = None):
    """Ranks, vocabulary by id, compiled pattern and piece store of a worker."""
    import regex

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    vocabulary: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        vocabulary[rank] = token
    vocabulary = pa.array(vocabulary, pa.large_binary())
    return vocabulary, regex.compile(pattern), Pieces(ranks, kept)


def spelled(packed: pa.Array, vocabulary: pa.Array) -> pa.Array:
    """The bytes that packed ids stand for, all texts at once; an unknown id is an error."""
    data, at = text_buffer(packed)
    try:
        tokens = vocabulary.take(pa.array(np.frombuffer(data, "<u4")))
    except IndexError as e:
        raise ValueError(f"unknown token id: {e}") from e
    if tokens.null_count:
        raise ValueError("unknown token id")
    joined, ends = text_buffer(tokens)
    out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(packed), [None, pa.py_buffer(ends[at // 4]), pa.py_buffer(joined)]).cast(pa.binary())
    return pc.if_else(packed.is_valid(), out, None) if packed.null_count else out


def pack(text: str, splitter, pieces: Pieces) -> bytes:
    """The ids of one text, four bytes each."""
    if len(text) < LONG_TEXT:
        found = splitter.findall(text)
        pieces.learn(found)
        return b"".join(map(pieces.__getitem__, found))
    matches, out = splitter.finditer(text), []
    while part := b"".join(pieces[m.group()] for m in islice(matches, 100_000)):
        out.append(part)
    return b"".join(out)


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``: the tokens of each whole text as little-endian unsigned 32-bit numbers, packed in a binary column.

    No special tokens.  A null text counts as empty and gives no ids.  Other
    columns and repeated rows stay as they are; a column that is already named
    ``ids`` is replaced.  Work is per row, so no key or group matters, and a
    task holds one Arrow batch.
    """

    @F.arrow_udf("binary")
    def encoded(texts: pa.Array) -> pa.Array:
        _, splitter, pieces = load(ranks_path, pattern)
        return pa.array([pack(t.as_py() or "", splitter, pieces) for t in texts], pa.binary())

    # not to be worked out again where a later Python function reads it
    return df.withColumn(ids, encoded.asNondeterministic()(F.col(f"`{text}`")))


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded``: the bytes that packed ids stand for; null ids give null, an unknown id is an error."""

    @F.arrow_udf("binary")
    def joined(packed: pa.Array) -> pa.Array:
        return spelled(packed, load(ranks_path, pattern)[0])

    return df.withColumn(decoded, joined(F.col(f"`{ids}`")))


def transcode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded",
              kept: int | None = None) -> DataFrame:
    """``encode`` and ``decode`` of its ids in one pass over the texts, with ``n_tokens``; a null text gives empty values.

    ``kept`` pieces are remembered by a worker, ``KEPT_PIECES`` by default.
    """
    @F.arrow_udf("ids binary, decoded binary")
    def both(texts: pa.Array) -> pa.Array:
        vocabulary, splitter, pieces = load(ranks_path, pattern, kept)
        packed = pa.array([pack(t.as_py() or "", splitter, pieces) for t in texts], pa.binary())
        done = pa.StructArray.from_arrays([packed, spelled(packed, vocabulary)], ["ids", "decoded"])
        release()
        return done

    name = unused(df, "transcoded")
    out = df.withColumn(name, both(F.col(f"`{text}`")))
    return out.withColumns({ids: F.col(f"{name}.ids"), decoded: F.col(f"{name}.decoded"),
                            "n_tokens": (F.octet_length(f"{name}.ids") / 4).cast("long")}).drop(name)


def with_tokens(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``encode`` and ``n_tokens``, the number of ids."""
    return encode(df, ranks_path, pattern, text).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))
