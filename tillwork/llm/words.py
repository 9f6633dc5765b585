"""Words of whole texts as 64-bit numbers, for a batch of texts at once.

A word is a run of bytes that an ``Alphabet`` calls part of a word, with A-Z
lower-cased.  Separators are ASCII, so runs of UTF-8 bytes are runs of
characters.  A word's number is a chain of bijections over its bytes, eight at
a time, begun with its length; very long words are hashed by BLAKE2.  Equal words
have equal numbers; different words of up to eight bytes and equal length have
different ones, others differ but for chance (2**-64 a pair).  Numpy works on the
Arrow buffers, no Python strings are made, and memory follows the text at some
five bytes a byte.
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib

import numpy as np
import pyarrow as pa

U64 = np.uint64
FACTOR = 0x9E3779B97F4A7C15
#: Longer words, in bytes, are hashed one by one.
LONG = 64
#: Number of the missing word before the first one of a text.
NO_WORD = U64(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (public splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def numbers(count: int, seed: int) -> np.ndarray:
    """A fixed series of well spread 64-bit numbers."""
    return mix(np.arange(1, count + 1, dtype=U64) * U64(FACTOR) + U64(seed * 0x632BE59BD9B4E019 % 2**64))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted different values."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


class Alphabet:
    """Which bytes belong to words, as ranges from and to; A-Z count as a-z."""

    def __init__(self, *ranges: tuple[int, int]):
        self.ranges = ranges
        self.lower = self.lowered(np.arange(256, dtype=np.uint8))
        self.member = self.inside(self.lower)

    def lowered(self, data: np.ndarray) -> np.ndarray:
        return data + ((data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5))

    def inside(self, lower: np.ndarray) -> np.ndarray:
        """Which of some lower-cased bytes belong to words."""
        found = np.zeros(len(lower), bool)
        for low, high in self.ranges:
            found |= lower - np.uint8(low) <= np.uint8(high - low)
        return found


#: Words are what stands between blanks: ``[^\x20\x09-\x0D]+``.
SPACED = Alphabet((0x00, 0x08), (0x0E, 0x1F), (0x21, 0xFF))
#: Words are letters, digits and everything beyond ASCII: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
ALNUM = Alphabet((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: What the number of a word of each size up to ``LONG`` begins with.
_BEGIN = mix(np.arange(LONG + 1, dtype=U64) * U64(FACTOR))


def word_numbers(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of the words at ``[starts, ends)`` of lower-cased bytes."""
    size = ends - starts
    number = _BEGIN[np.minimum(size, LONG)]
    padded = np.concatenate([lower, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(lower) + 1,), "<u8", padded.data, 0, (1,))
    at = np.flatnonzero(size <= LONG)
    for step in range(0, LONG, 8):
        if step:
            at = at[size[at] > step]
        if not len(at):
            break
        rest = np.minimum(size[at] - step, 8).astype(U64)
        part = eights[starts[at] + step] & (U64(2**64 - 1) >> (U64(64) - U64(8) * rest))
        number[at] = mix(number[at] ^ part)
    for i in np.flatnonzero(size > LONG).tolist():
        number[i] = int.from_bytes(hashlib.blake2b(lower[starts[i] : ends[i]].data, digest_size=8).digest(), "little")
    return number


def text_buffer(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 places where its texts begin and end; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, at, data = texts.buffers()
    if at is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of some texts: numbers, byte places, and where each text's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet):
        self.data, self.offsets = data, offsets
        lower = alphabet.lowered(data)
        inside = alphabet.inside(lower)
        begins, ends = inside.copy(), inside.copy()
        if len(data):
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            cuts = offsets[(offsets > 0) & (offsets < len(data))]
            begins[cuts] |= inside[cuts]
            ends[cuts - 1] |= inside[cuts - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.hash = word_numbers(lower, self.starts, self.ends)

    @property
    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first)


def words_of(texts: pa.Array | pa.ChunkedArray, alphabet: Alphabet = SPACED) -> Words:
    return Words(*text_buffer(texts), alphabet)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A number for each run of ``k`` words; runs over the borders of texts are included, the caller drops them."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = hashes[:n].copy()
    for j in range(1, k):
        total *= U64(0xD6E8FEB86659FD93)
        total += hashes[j : j + n]
    return mix(total)


def release() -> None:
    """Hand freed memory back to the system: a Python worker lives on after its task and would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not on every system
        ctypes.CDLL(None).malloc_trim(0)


def slices(texts: pa.Array, limit: int = 1 << 20):
    """Consecutive parts of a string column with some ``limit`` bytes each; a longer text is a part of its own."""
    offsets = text_buffer(texts)[1]
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, texts.slice(at, to - at)
        at = to
    release()
