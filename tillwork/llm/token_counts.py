"""Token counts by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a slice of texts lie one after another in flat numpy
arrays.  In every round each sequence applies its lowest-rank pair at all its
places at once, until no pair of any sequence can merge; the surviving symbols
are counted.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import slices

NONE = np.int32(2**31 - 1)
#: Pre-tokens whose counts a worker keeps; the store is emptied when full, which costs time only.
KEPT_WORDS = 400_000
LONG_TEXT = 1 << 21


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where it is printable, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordPieces:
    """A tokenizer file of the kind: normalise, split by a pattern, merge bytes with word ends."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], spec["normalizer"]["normalizers"]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if (model["type"], [s["type"] for s in steps], split["type"], level["type"]) != (
                "BPE", ["NFC", "Replace", "Lowercase"], "Split", "ByteLevel") or split["behavior"] != "Removed":
            raise ValueError(f"{path}: not a word-end BPE tokenizer file")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens with options")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.final = np.array([vocab[letters[b] + end] for b in range(256)], np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made: dict[str, int] = {}
        for rank, (a, b) in enumerate(pairs):
            made[a + b] = max(rank, made.get(a + b, -1))
        #: All places of a pair may merge at once only if what a merge makes never merges earlier than it.
        self.together = all(made.get(part, -1) < rank for rank, pair in enumerate(pairs) for part in pair)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.product = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.pattern = regex.compile(split["pattern"]["Regex"])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.known: dict[str, int] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.ranks[at], NONE) if len(self.keys) else np.full(len(keys), NONE)

    def survivors(self, words: list[str]) -> np.ndarray:
        """Symbols left of each pre-token."""
        raw = [w.encode() for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        counts = lengths.copy()
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(lengths)
        symbols = self.inner[data]
        symbols[ends - 1] = self.final[data[ends - 1]]
        owner = np.repeat(np.arange(len(raw)), lengths)
        ranks = np.full(len(symbols), NONE, np.int32)
        if len(symbols) > 1:
            ranks[:-1] = self.rank(symbols[:-1], symbols[1:])
        ranks[ends - 1] = NONE
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(owner)])
            lowest = np.minimum.reduceat(ranks, starts)
            live = lowest < NONE
            counts[owner[starts[~live]]] = sizes[~live]
            if not live.any():
                break
            if not live.all():
                keep = np.repeat(live, sizes)
                symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
                sizes, lowest = sizes[live], lowest[live]
            at = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            if self.together:
                # of places that overlap, as in aaa, the first, third, ... merge
                run = np.r_[True, np.diff(at) != 1]
                first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - first) % 2 == 0]
            else:
                at = at[np.r_[True, owner[at[1:]] != owner[at[:-1]]]]
            symbols[at] = self.product[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
            at = place[at]
            changed = np.unique(np.r_[at, at[at > 0] - 1])
            inner = changed[changed + 1 < len(owner)]
            ranks[changed] = NONE
            inner = inner[owner[inner] == owner[inner + 1]]
            ranks[inner] = self.rank(symbols[inner], symbols[inner + 1])
        return counts

    def pre_tokens(self, text: str):
        """Lists of pre-tokens, and numbers of special strings, of one text."""
        at = 0
        for found in [*(self.special.finditer(text) if self.special else ()), None]:
            part = text[at : found.start() if found else None]
            if found:
                at = found.end()
                yield 1
            if part:
                # capital sigma has one lower-case form here, wherever it stands
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                if len(part) < LONG_TEXT:
                    yield self.pattern.findall(part)
                else:
                    matches = self.pattern.finditer(part)
                    while some := [m.group() for m in islice(matches, 200_000)]:
                        yield some

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text."""
        totals, waiting, held = [0] * len(texts), [], 0
        for i, text in enumerate(texts):
            for part in self.pre_tokens(text or ""):
                if isinstance(part, int):
                    totals[i] += part
                else:
                    waiting.append((i, part))
                    held += len(part)
                    if held > 500_000:
                        self.settle(waiting, totals)
                        waiting, held = [], 0
        self.settle(waiting, totals)
        return totals

    def settle(self, waiting: list[tuple[int, list[str]]], totals: list[int]) -> None:
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        new: set[str] = set()
        for _, words in waiting:
            new.update(words)
        new -= self.known.keys()
        if new:
            fresh = list(new)
            self.known.update(zip(fresh, self.survivors(fresh).tolist()))
        size = self.known.__getitem__
        for i, words in waiting:
            totals[i] += sum(map(size, words))


@lru_cache(2)
def load(path: str) -> WordPieces:
    return WordPieces(path)


def token_counts(df: DataFrame, tokenizer_path: str, text: str = "text", n_tokens: str = "n_tokens") -> DataFrame:
    """Add ``n_tokens``, the tokens of each whole text without begin, end or padding tokens.

    Special strings inside a text count as one token each.  A null or empty text
    has none.  Other columns and repeated rows stay; a column that is already
    named ``n_tokens`` is replaced.  Work is per row; a task holds one Arrow batch
    and the counts of at most ``KEPT_WORDS`` pre-tokens.
    """

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        tokenizer, out = load(tokenizer_path), []
        for _, part in slices(texts):
            out.extend(tokenizer.count(part.to_pylist()))
        return pa.array(out, pa.int64())

    return df.withColumn(n_tokens, counted(F.col(f"`{text}`")))
