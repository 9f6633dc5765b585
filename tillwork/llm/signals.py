"""Counts over whole texts: words, characters, repeated lines and windows of words.

A word is a run of ``[^\\x20\\x09-\\x0D]``, case kept.  Words and lines get the
numbers of a dictionary of the batch, so equality is exact and no hash decides;
windows of words are pairs of such numbers, numbered again.  Memory follows the
batch: slices of some MiB, or one text where it is longer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import distinct, slices, text_buffer

#: Words of a window that counts as repeated.
WINDOW = 3
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
UPPER = np.isin(np.arange(256), np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8))


def byte_class(members: str) -> np.ndarray:
    """Which bytes are among these ASCII characters."""
    return np.isin(np.arange(256), np.frombuffer(members.encode("ascii"), np.uint8))


#: First bytes of characters in UTF-8.
LEADS = (np.arange(256) & 0xC0) != 0x80


def numbered(values: np.ndarray) -> np.ndarray:
    """The numbers 0, 1, ... for different values, in order of appearance."""
    return pa.array(values).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


class Pieces:
    """Pieces of some texts: the number of each piece's content, the text it stands in, and how many each text has."""

    def __init__(self, lists: pa.ListArray, use: pa.BooleanArray):
        flat = lists.flatten()
        use = use.to_numpy(zero_copy_only=False)
        encoded = flat.dictionary_encode()
        self.id = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[use]
        self.kinds = max(1, len(encoded.dictionary))
        own = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        self.own, self.texts = own[use], len(lists)
        self.count = np.bincount(self.own, minlength=len(lists))

    def different(self) -> np.ndarray:
        """Different pieces of each text."""
        both = distinct(self.own * self.kinds + self.id)
        return np.bincount(both // self.kinds, minlength=self.texts)

    def repeated(self, width: int = WINDOW) -> np.ndarray:
        """Pieces of each text inside windows of ``width`` pieces that the text holds twice or more, the first included."""
        windows = max(0, len(self.id) - width + 1)
        number = self.id[:windows]
        for step in range(1, width):
            number = numbered(number * self.kinds + self.id[step : step + windows])
        whole = np.flatnonzero(self.own[:windows] == self.own[width - 1 :]) if windows else np.zeros(0, np.int64)
        number = numbered(self.own[whole] * max(1, windows) + number[whole])
        often = whole[np.bincount(number)[number] > 1] if len(number) else whole
        inside = np.zeros(len(self.id), bool)
        for step in range(width):
            inside[often + step] = True
        return np.bincount(self.own[inside], minlength=self.texts)


def words(texts: pa.Array) -> Pieces:
    split = pc.ascii_split_whitespace(texts)
    return Pieces(split, pc.greater(pc.binary_length(split.flatten()), 0))


def lines(texts: pa.Array) -> Pieces:
    """The lines with words, between line feeds."""
    split = pc.split_pattern(texts, "\n")
    return Pieces(split, pc.greater(pc.binary_length(pc.ascii_trim_whitespace(split.flatten())), 0))


def totals(texts: pa.Array, *classes: np.ndarray) -> list[np.ndarray]:
    """Bytes of each class in each text."""
    data, offsets = text_buffer(texts)
    cuts = list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
    return [np.array([np.count_nonzero(members[data[a:b]]) for a, b in cuts], np.int64) for members in classes]


def struct_of(texts: pa.Array, measure) -> pa.StructArray:
    """``measure`` of slices of a column as one struct column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    parts = [measure(part.fill_null("")) for _, part in slices(texts)] or [measure(texts)]
    names = list(parts[0])
    return pa.StructArray.from_arrays([pa.array(np.concatenate([p[n] for p in parts])) for n in names], names)
