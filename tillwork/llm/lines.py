"""Line dedup: an exact set-similarity join of lines by rare tokens.

A line is the set of its words.  Its tokens are put in one global order, rarest
first.  Two lines that are ``PERCENT`` similar share a token among their first
ones (prefix filter), and their sizes and the token's places in both must leave
enough tokens to share (length and positional filters); a 64-bit map of the
sets excludes most of the rest.  What passes is verified on the whole sets.  Of
similar lines the later ones go, by document and line number.

Postings travel as packed arrays: a group of documents sends its tokens cut
into ranges, and each range compares what it gets.  Lines with equal sets count
once in a group, so that a line that is everywhere is a few postings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .language_model import planes, unplanes
from .minhash import shared
from .store import Held, discard, spill, unused
from .words import U64, distinct, mix, release, slices, words_of

PERCENT = 80
#: Word counts are kept for this many hash classes of words, a fixed size whatever the corpus.
CLASSES, SEGMENTS = 1 << 20, 256
#: Words of the corpus for each range of tokens; a task holds one range.
RANGE = 1 << 20
#: Candidates that a line takes from a token before the first verification.
FIRST_TRY = 4
#: Postings of a token that are compared in one task; a token with more is cut into blocks.
HOT = 1 << 15
#: One document in so many is looked at to tell which tokens have that many; it decides on blocks, not on results.
SAMPLE = 16
#: Bits of the map that names the lines to verify.
MAP_BITS = 24

POSTING = "kind int, range int, key binary, doc binary, line binary, size binary, place binary, bits binary, more_bits binary"
POSTED = [p.split()[0] for p in POSTING.split(", ")]
KINDS = dict(key=np.uint64, doc=np.int64, line=np.int32, size=np.int32, place=np.int32, bits=np.uint64, more_bits=np.uint64)
FOUND = "exact boolean, doc long, line int, size int, match_doc long, match_line int, more boolean"


def word_classes(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U64(44)).astype(np.int64)


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CLASSES, np.int64)
    for batch in batches:
        for _, part in slices(batch.column(0)):
            np.add.at(counts, word_classes(words_of(part).hash), 1)
    yield _by_segment(counts)


def _by_segment(counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(SEGMENTS, dtype=np.int32)),
                                       pa.array([planes(c) for c in counts.reshape(SEGMENTS, -1)], pa.binary())], ["segment", "counts"])


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, segment = np.zeros(CLASSES // SEGMENTS, np.int64), None
    for batch in batches:
        for segment, counts in zip(batch.column(0), batch.column(1)):
            total += unplanes(counts.as_py(), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array([segment.as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["segment", "counts"])


def word_counts(docs: DataFrame) -> np.ndarray:
    """Words of each class in all texts."""
    return _summed(docs.select("text"), _class_counts)


def steps_of(counts: np.ndarray) -> np.ndarray:
    """Frequency steps, half powers of two; a byte for each class."""
    return np.minimum(63, 2 * np.log2(counts + 1.0)).astype(np.uint8)


def rarity(docs: DataFrame) -> np.ndarray:
    """Frequency step of every word class over all texts."""
    return steps_of(word_counts(docs))


def _summed(texts: DataFrame, count) -> np.ndarray:
    """``CLASSES`` counts, added over all tasks."""
    sums = texts.mapInArrow(count, "segment int, counts binary").groupBy("segment").applyInArrow(
        _add_counts, "segment int, counts binary").collect()
    counts = np.zeros((SEGMENTS, CLASSES // SEGMENTS), np.int64)
    for row in sums:
        counts[row.segment] = np.maximum(counts[row.segment], np.frombuffer(row.counts, np.int64))
    return counts.reshape(-1)


def lines_of(texts: pa.Array):
    """The words of some texts, the line of each word, and where lines start."""
    words = words_of(texts)
    starts = np.union1d(words.offsets[:-1], np.flatnonzero(words.data == 10) + 1)
    return words, np.searchsorted(starts, words.starts, "right") - 1, starts


def line_numbers(words, line: np.ndarray, starts: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text, and line within the text, of lines given by their number and their first word."""
    text = np.searchsorted(words.first, first, "right") - 1
    return text, line - np.searchsorted(starts, words.offsets[text])


def may_match(hit: np.ndarray, hashes: np.ndarray, begins: np.ndarray, percent: int) -> np.ndarray:
    """Which lines may be similar to a set of wanted words, from the words that are (``hit``).

    Similar sets share ``percent`` of either, so the different words that are not
    wanted are few against those that are.  Classes of words are counted in
    place of words: no more of the former, no fewer of the latter.
    """
    missed = np.where(hit, U64(0), U64(1) << (hashes & U64(63)))
    return percent * np.bitwise_count(np.bitwise_or.reduceat(missed, begins)).astype(np.int64) <= (100 - percent) * np.add.reduceat(hit.astype(np.int64), begins)


def word_places(hashes: np.ndarray) -> np.ndarray:
    """Places of words in a map."""
    return (hashes >> U64(64 - MAP_BITS)).astype(np.int64)


class Lines:
    """The lines with words of some texts: sets of 64-bit words, rarest first, and where they stand.

    The order of words, by frequency step and number, is the same in all texts.
    """

    def __init__(self, texts: pa.Array, steps: np.ndarray, percent: int = PERCENT, wanted: np.ndarray | None = None):
        """``wanted`` is a map of words; lines that have too few of them to be similar to a set of them are left out."""
        words, of_word, starts = lines_of(texts)
        hashes, place = words.hash, np.arange(len(of_word))
        begins = np.flatnonzero(np.r_[True, of_word[1:] != of_word[:-1]]) if len(of_word) else np.zeros(0, np.int64)
        if wanted is not None and len(place):
            few = may_match(wanted[word_places(hashes)], hashes, begins, percent)
            place = np.flatnonzero(np.repeat(few, np.diff(np.r_[begins, len(of_word)])))
            hashes, of_word = hashes[place], of_word[place]
            begins = np.flatnonzero(np.r_[True, of_word[1:] != of_word[:-1]]) if len(of_word) else np.zeros(0, np.int64)
        own = np.repeat(np.arange(len(begins)), np.diff(np.r_[begins, len(of_word)]))
        coded = pa.array(hashes).dictionary_encode()
        kinds = coded.dictionary.to_numpy(zero_copy_only=False)
        order = np.argsort(kinds)
        order = order[np.argsort(steps[word_classes(kinds[order])], kind="stable")]
        rank = np.empty(len(kinds), np.int64)
        rank[order] = np.arange(len(kinds))
        both = distinct(own << 32 | rank[coded.indices.to_numpy(zero_copy_only=False)])
        self.token, owner = kinds[order][both & (2**32 - 1)], both >> 32
        self.begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
        self.size = np.diff(np.r_[self.begin, len(owner)]).astype(np.int32)
        self.text, line = line_numbers(words, of_word[begins], starts, place[begins])
        self.line = line.astype(np.int32)

    def members(self, line: int) -> bytes:
        """The words of a line as sorted numbers."""
        return np.sort(self.token[self.begin[line] : self.begin[line] + self.size[line]]).tobytes()

    def parity(self, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of 128 classes hold an odd number of tokens: sets differ in at least as many tokens as in classes."""
        bit = U64(1) << (spread & U64(63))
        upper = (spread >> U64(6) & U64(1)).astype(bool)
        return tuple(np.bitwise_xor.reduceat(np.where(side, bit, U64(0)), self.begin) for side in (upper, ~upper))

    def prefix(self, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of each token in its line, length of each line's prefix, and which tokens are in it."""
        place = np.arange(len(self.token)) - np.repeat(self.begin, self.size)
        first = self.size - -(-percent * self.size // 100) + 1
        return place.astype(np.int32), first, place < np.repeat(first, self.size)


#: Bytes of documents whose equal lines count once.
GROUP = 8 << 20
#: Bytes of texts that are cut into lines at a time.
SLICE = 1 << 20


def needed(size_a, size_b, percent: int):
    """Tokens that sets of these sizes must share."""
    return -(-percent * (size_a + size_b) // (100 + percent))


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups of some ``GROUP`` bytes: the larger a group, the more equal lines meet in it."""
    group, size = [], 0
    for batch in batches:
        group.append(batch)
        size += batch.nbytes
        if size >= GROUP:
            yield group
            group, size = [], 0
    if group:
        yield group
    release()


def _posting_counts(steps, percent: int):
    """Postings of each class of tokens; equal lines of a group count once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES, np.int64)
        for group in gathered(batches):
            met = np.zeros(0, U64)
            for texts in (t for b in group for _, t in slices(b.column(0), SLICE)):
                lines = Lines(texts, steps.value)
                if not len(lines.size):
                    continue
                digest = np.add.reduceat(mix(lines.token), lines.begin)
                fresh = np.zeros(len(digest), bool)
                fresh[np.unique(digest, return_index=True)[1]] = True
                fresh &= ~np.isin(digest, met)
                met = np.r_[met, digest[fresh]]
                use = lines.prefix(percent)[2] & np.repeat(fresh, lines.size)
                np.add.at(counts, word_classes(mix(lines.token[use])), 1)
        yield _by_segment(counts)

    return count


def crowds(docs: DataFrame, steps, percent: int):
    """A broadcast of the blocks that each class of tokens is cut into, after the counts of a sample; None where one does for all."""
    some = docs.filter(F.pmod(F.xxhash64("doc"), F.lit(SAMPLE)) == 0).select("text")
    blocks = np.minimum(2**16 - 1, -(-SAMPLE * _summed(some, _posting_counts(steps, percent)) // HOT))
    return docs.sparkSession.sparkContext.broadcast(np.maximum(1, blocks).astype(np.uint16)) if (blocks > 1).any() else None


def _spread(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """A well spread number for each line."""
    return mix(doc.astype(np.int64).view(U64) * U64(0x9E3779B97F4A7C15) + line.astype(np.int64).view(U64))


def _units(token: np.ndarray, block: np.ndarray, many: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The pairs of blocks that a posting takes part in: which postings, the key of the pair, and whether theirs is its second block."""
    for step in range(int(many.max(initial=0))):
        at = np.flatnonzero(many > step)
        mine, other = block[at], (block[at] + step) % many[at]
        pair = (np.minimum(mine, other) << 32 | np.maximum(mine, other)).astype(U64)
        yield at, mix(token[at] ^ mix(pair + U64(1))), mine > other


def _postings(steps, ranges: int, percent: int, crowd=None):
    """Tokens of the first places, and set digests, of a group's lines, cut into ranges; lines met before in the group are found."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in gathered(batches):
            parts = []
            for ids, texts in ((b.column(0).to_numpy()[at : at + len(t)], t) for b in group for at, t in slices(b.column(1), SLICE)):
                lines = Lines(texts, steps.value)
                if not len(lines.size):
                    continue
                spread = mix(lines.token)
                low, high = (np.add.reduceat(x, lines.begin) for x in (spread, mix(spread ^ U64(0xA0761D6478BD642F))))
                bits, more = lines.parity(spread)
                place, first, lead = lines.prefix(percent)
                parts.append((low, high, bits, more, ids[lines.text], lines.line, lines.size,
                              lines.token[lead], place[lead], first))
            if not parts:
                continue
            low, high, bits, more, doc, line, size, token, place, first = map(np.concatenate, zip(*parts))
            order = np.lexsort((line, doc, high, low))
            fresh = np.r_[True, (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])]
            head = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
            kept = np.zeros(len(order), bool)
            kept[order[fresh]] = True
            repeat = ~fresh & ((doc[order] != doc[head]) | (line[order] != line[head]))  # a repeated row does not match itself
            again, head = order[repeat], head[repeat]
            yield from _packed(2, _range(_spread(doc[again], line[again]), ranges), ranges, dict(
                key=doc[head].view(U64), doc=doc[again], line=line[again], size=size[again], place=line[head],
                bits=np.zeros(len(again), U64), more_bits=np.zeros(len(again), U64)))
            yield from _packed(0, _range(low[kept], ranges), ranges, dict(
                key=low[kept], doc=doc[kept], line=line[kept], size=size[kept], place=np.zeros(kept.sum(), np.int32), bits=high[kept],
                more_bits=np.zeros(kept.sum(), U64)))
            own = np.repeat(np.arange(len(size)), first)
            use = kept[own]
            own, token, place = own[use], token[use], place[use]
            if crowd is not None:
                many = crowd.value[word_classes(mix(token))].astype(np.int64)
                hot = np.flatnonzero(many > 1)
                block = (_spread(doc[own[hot]], line[own[hot]]) >> U64(16)).astype(np.int64) % many[hot]
                for step, (at, key, second) in enumerate(_units(token[hot], block, many[hot])):
                    i, stand = own[hot[at]], place[hot[at]]
                    yield from _packed(3 if step == 0 else 4, _range(key, ranges), ranges, dict(
                        key=key, doc=doc[i], line=line[i], size=size[i], place=np.where(second, -1 - stand, stand), bits=bits[i], more_bits=more[i]))
                own, token, place = own[many == 1], token[many == 1], place[many == 1]
            yield from _packed(1, _range(mix(token), ranges), ranges, dict(
                key=token, doc=doc[own], line=line[own], size=size[own], place=place, bits=bits[own], more_bits=more[own]))

    return send


def _range(key: np.ndarray, ranges: int) -> np.ndarray:
    return ((key >> U64(32)) * U64(ranges) >> U64(32)).astype(np.int64)


def _packed(kind: int, range_: np.ndarray, ranges: int, columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    order = np.argsort(range_.astype(np.uint16) if ranges <= 1 << 16 else range_, kind="stable")
    cuts = np.r_[0, np.cumsum(np.bincount(range_, minlength=ranges))]
    some = [r for r in range(ranges) if cuts[r] < cuts[r + 1]]
    if some:
        columns = {c: v[order].astype(KINDS[c], copy=False) for c, v in columns.items()}
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(some), kind, np.int32)), pa.array(np.array(some, np.int32)),
             *(pa.array([planes(columns[c][cuts[r] : cuts[r + 1]]) for r in some], pa.binary()) for c in POSTED[2:])], POSTED)


def _unpacked(table: pa.Table) -> dict[str, np.ndarray]:
    return {c: np.concatenate([unplanes(x.as_py(), KINDS[c]) for x in table.column(c)]) for c in POSTED[2:]}


def _candidates(percent: int, tries: int):
    """Equal lines, or lines that pass all filters, of one range; a line takes ``tries`` partners from a token."""

    def compare(table: pa.Table) -> pa.Table:
        release()
        kind = table.column("kind")[0].as_py()
        rows = _unpacked(table)
        if kind == 2:
            return _found(True, rows["doc"], rows["line"], rows["size"], rows["key"].view(np.int64), rows["place"])
        if kind == 0:
            order = np.lexsort((rows["line"], rows["doc"], rows["bits"], rows["key"]))
            rows = {c: v[order] for c, v in rows.items()}
            fresh = np.r_[True, (rows["key"][1:] != rows["key"][:-1]) | (rows["bits"][1:] != rows["bits"][:-1])]
            head = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
            j = np.flatnonzero(~fresh & ((rows["doc"] != rows["doc"][head]) | (rows["line"] != rows["line"][head])))
            return _found(True, rows["doc"][j], rows["line"][j], rows["size"][j], rows["doc"][head[j]], rows["line"][head[j]])
        order = np.lexsort((rows["line"], rows["doc"], rows["key"]))
        key, doc, line, size, place, bits, more_bits = (rows[c][order] for c in POSTED[2:])
        start = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(len(key)), 0))
        # kind 3 is a block of a hot token, kind 4 two blocks of it, of which only lines of different ones meet
        second, place = place < 0, np.where(place < 0, -1 - place, place)
        limit = tries if kind == 1 else max(1, tries // 8)
        later = np.arange(len(key))
        found, taken, step = [], np.zeros(len(key), np.int16), 0
        rest = size - place
        while True:
            step += 1
            later = later[later - step >= start[later]]
            if not len(later):
                break
            i, j = later - step, later
            share = needed(size[i], size[j], percent)
            fits = (np.minimum(rest[i], rest[j]) >= share) & ((second[i] != second[j]) if kind == 4 else True)
            i, j, share = i[fits], j[fits], share[fits]
            apart = np.bitwise_count(bits[i] ^ bits[j]).astype(np.int64) + np.bitwise_count(more_bits[i] ^ more_bits[j])
            fits = apart <= size[i] + size[j] - 2 * share
            i, j = i[fits], j[fits]
            fits = (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])) & (
                (doc[i] != doc[j]) | (line[i] != line[j]))
            i, j = i[fits], j[fits]
            if len(j):
                found.append((i, j))
                alike = (bits[i] == bits[j]) & (more_bits[i] == more_bits[j]) & (size[i] == size[j])
                taken[j] += np.where(alike, limit, 1).astype(np.int16)  # an equal set most likely settles the line
                later = later[taken[later] < limit]
        if not found:
            none = np.zeros(0, np.int64)
            return _found(False, none, none, none, none, none)
        i, j = map(np.concatenate, zip(*found))
        return _found(False, doc[j], line[j], size[j], doc[i], line[i], (taken[j] >= limit) & (j - 1 > start[j]))

    return compare


def _found(exact: bool, doc, line, size, match_doc, match_line, more=None) -> pa.Table:
    return pa.table([pa.array(np.full(len(doc), exact)), pa.array(doc.astype(np.int64)), pa.array(line.astype(np.int32)),
                     pa.array(size.astype(np.int32)), pa.array(match_doc.astype(np.int64)), pa.array(match_line.astype(np.int32)),
                     pa.array(np.zeros(len(doc), bool) if more is None else more)], [p.split()[0] for p in FOUND.split(", ")])


def line_marks(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Place of a pair of integers in a map."""
    return (_spread(doc, line) >> U64(64 - MAP_BITS)).astype(np.int64)


def only_lines(texts: pa.Array, numbers: pa.Array) -> pa.Array:
    """Texts of which only the lines with these numbers are left; the others are empty."""
    chosen = (set(n.as_py() or ()) for n in numbers)
    return pa.array(["\n".join(x if k in own else "" for k, x in enumerate(t.as_py().split("\n"))) for t, own in zip(texts, chosen)], pa.string())


#: A row for each of the first tokens of a line, without its set, and a row with the set of each line, without token.
LOOSE = "token long, step int, doc long, line int, size int, place int, bits long, more_bits long, members binary"


def size_steps(size: np.ndarray, percent: int) -> np.ndarray:
    """Steps so wide that sizes of similar sets are in the same or in neighbouring ones."""
    return np.floor(np.log(size) / (np.log(100 / percent) or 1.0) + 1e-9).astype(np.int32)


def _loose_postings(steps, percent: int, wanted=None, leads=None):
    """First tokens of lines, and the set of each line once.

    Where maps are given, of lines that may match ``wanted`` words, and of tokens
    that are in ``leads`` with the step of the line's size; without, of the lines
    that a third column names.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, firsts = (None if m is None else np.unpackbits(m.value).astype(bool) for m in (wanted, leads))
        names = [c.split()[0] for c in LOOSE.split(", ")]
        for batch in batches:
            if batch.num_columns > 2:
                batch = pa.RecordBatch.from_arrays([batch.column(0), only_lines(batch.column(1), batch.column(2))], ["doc", "text"])
            for ids, texts in ((batch.column(0).to_numpy()[at : at + len(t)], t) for at, t in slices(batch.column(1), SLICE)):
                lines = Lines(texts, steps.value, percent, marks)
                if not len(lines.size):
                    continue
                place, _, use = lines.prefix(percent)
                step = size_steps(lines.size, percent)
                if marks is not None:
                    at = np.flatnonzero(use)
                    use[at[~firsts[line_marks(lines.token[at].view(np.int64), np.repeat(step, lines.size)[at])]]] = False
                own, bits = np.repeat(np.arange(len(lines.size)), lines.size)[use], lines.parity(mix(lines.token))
                of_line = lambda i, **more: [more.get(c, pa.nulls(len(i), k)) for c, k in zip(names, (
                    pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))]
                where = lambda i: dict(doc=pa.array(ids[lines.text[i]], pa.int64()), line=pa.array(lines.line[i]), size=pa.array(lines.size[i]))
                yield pa.RecordBatch.from_arrays(of_line(own, token=pa.array(lines.token[use].view(np.int64)), step=pa.array(step[own]), place=pa.array(place[use]),
                                                         bits=pa.array(bits[0][own].view(np.int64)), more_bits=pa.array(bits[1][own].view(np.int64)), **where(own)), names)
                once = distinct(own)
                yield pa.RecordBatch.from_arrays(of_line(once, members=pa.array([lines.members(i) for i in once.tolist()], pa.binary()), **where(once)), names)

    return send


def _all_partners(open_: DataFrame, docs: DataFrame, steps, percent: int, held: Held) -> DataFrame:
    """Earlier similar lines of the lines (doc, line) in ``open_``, by a join on their first tokens.

    Tokens are joined by steps of sizes.  Other lines are sent only where a first
    token of theirs is one of an open line of a neighbouring step, and sets only
    of lines in pairs that pass the filters.
    """
    asked = docs.join(open_.groupBy("doc").agg(F.collect_list("line").alias("lines")), "doc")
    asked = asked.select("doc", "text", "lines").mapInArrow(_loose_postings(steps, percent), LOOSE)
    asked = spill(asked, "open-postings")
    step = F.col("step")
    left = asked.filter("token IS NOT NULL").withColumn("step", F.explode(F.array(step - 1, step, step + 1)))
    wanted, leads = _map_of(asked.filter("token IS NULL").select("members")), _map_of(left.select("token", "step"))
    others = held.keep(docs.mapInArrow(_loose_postings(steps, percent, wanted, leads), LOOSE))
    right = others.filter("token IS NOT NULL").select("token", "step", *[F.col(c).alias(f"m_{c}") for c in ("doc", "line", "size", "place", "bits", "more_bits")])
    share = F.ceil(percent * (F.col("size") + F.col("m_size")) / (100 + percent))
    fits = ((F.struct("m_doc", "m_line") < F.struct("doc", "line"))
            & (F.least(F.col("size") - F.col("place"), F.col("m_size") - F.col("m_place")) >= share)
            & (F.bit_count(F.col("bits").bitwiseXOR(F.col("m_bits"))) + F.bit_count(F.col("more_bits").bitwiseXOR(F.col("m_more_bits")))
               <= F.col("size") + F.col("m_size") - 2 * share))
    pairs = left.join(right, ["token", "step"]).filter(fits).select(
        "doc", "line", "size", F.col("m_doc").alias("match_doc"), F.col("m_line").alias("match_line")).distinct()
    pairs = held.keep(pairs)
    sets = asked.union(others).filter("token IS NULL").select("doc", "line", "members")
    sets = sets.mapInArrow(_named(_map_of(_both(pairs))), SETS).dropDuplicates(["doc", "line"])
    return _verified(pairs, sets, percent).filter("ok").drop("ok")


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    marks = np.zeros(1 << MAP_BITS, bool)
    for batch in batches:
        if batch.num_columns == 1:
            for members in batch.column(0):
                marks[word_places(np.frombuffer(members.as_py(), U64))] = True
        else:
            marks[line_marks(*(c.to_numpy() for c in batch.columns))] = True
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(SEGMENTS, dtype=np.int32)),
                                      pa.array([m.tobytes() for m in np.packbits(marks).reshape(SEGMENTS, -1)], pa.binary())], ["segment", "marks"])


def _either(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, segment = np.zeros((1 << MAP_BITS) // 8 // SEGMENTS, np.uint8), None
    for batch in batches:
        for segment, marks in zip(batch.column(0), batch.column(1)):
            total |= np.frombuffer(marks.as_py(), np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array([segment.as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["segment", "marks"])


SETS = "doc long, line int, members binary"


def _both(pairs: DataFrame) -> DataFrame:
    """The lines (doc, line) of either side of pairs."""
    return pairs.select("doc", "line").union(pairs.select("match_doc", "match_line"))


def _named(wanted):
    """Rows of (doc, line, ...) of the lines that a map names."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.unpackbits(wanted.value).astype(bool)
        for batch in batches:
            yield batch.take(pa.array(np.flatnonzero(marks[line_marks(batch.column(0).to_numpy(), batch.column(1).to_numpy())])))

    return choose


#: The line that stands for its document in a map of lines.
WHOLE = np.int32(-1)


def _sets(wanted):
    """The word sets of lines that the map of wanted lines names, as sorted numbers; documents without any are not read."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.unpackbits(wanted.value).astype(bool)
        for batch in batches:
            batch = batch.take(pa.array(np.flatnonzero(marks[line_marks(batch.column(0).to_numpy(), WHOLE)])))
            ids = batch.column(0).to_numpy()
            for at, texts in slices(batch.column(1), SLICE):
                words, of_word, starts = lines_of(texts)
                begins = np.flatnonzero(np.r_[True, of_word[1:] != of_word[:-1]]) if len(of_word) else np.zeros(0, np.int64)
                text, line = line_numbers(words, of_word[begins], starts, begins)
                ends = np.r_[begins[1:], len(of_word)]
                use = np.flatnonzero(marks[line_marks(ids[at + text], line)])
                sets = [distinct(words.hash[a:b]).tobytes() for a, b in zip(begins[use].tolist(), ends[use].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at + text[use]], pa.int64()), pa.array(line[use].astype(np.int32)),
                                                  pa.array(sets, pa.binary())], ["doc", "line", "members"])

    return gather


def _line_sets(pairs: DataFrame, docs: DataFrame, held: Held) -> DataFrame:
    """(doc, line, members) of all lines in ``pairs`` (and a few more): a map of fixed size picks them in a scan of the texts.

    They are kept in sorted hash partitions by line, so that no later join sends them again.
    """
    wanted = _both(pairs)
    wanted = _map_of(wanted.union(wanted.select("doc", F.lit(int(WHOLE))).distinct()))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return held.keep(docs.mapInArrow(_sets(wanted), SETS).repartition(parts, "doc", "line").sortWithinPartitions("doc", "line"))


def _map_of(keys: DataFrame):
    """A broadcast map of fixed size of the words of packed sets, or of pairs of integers."""
    rows = keys.mapInArrow(_mark, "segment int, marks binary").groupBy("segment").applyInArrow(_either, "segment int, marks binary").collect()
    wanted = np.zeros((SEGMENTS, (1 << MAP_BITS) // 8 // SEGMENTS), np.uint8)
    for row in rows:
        wanted[row.segment] = np.frombuffer(row.marks, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(wanted.reshape(-1))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of lines with ``ok``: whether their whole sets are similar."""
    first = sets.withColumnRenamed("members", "s")
    second = sets.select(F.col("doc").alias("match_doc"), F.col("line").alias("match_line"), F.col("members").alias("t"))
    both = pairs.join(first, ["doc", "line"]).join(second, ["match_doc", "match_line"])
    common, total = F.col("common"), (F.octet_length("s") + F.octet_length("t")) / 8
    return both.withColumn("common", shared("s", "t")).select(
        *pairs.columns, (100 * common >= percent * (total - common)).alias("ok"))


def repeated_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row for each line to remove: doc_id, line_no, n_words, match_doc_id, match_line_no, exact.

    A line stands between line feeds; its words stand between blanks, A-Z count
    as a-z; ``n_words`` is the number of different ones.  A line goes if an earlier
    line, by document id and line number (from 0), whether it goes itself or not,
    has ``100 * common >= percent * union`` on the sets of words.  The named match
    is the earliest one that was verified.  Lines without words stay.  Rows
    without id or text take no part; rows that share an id are meant to be equal,
    count as one document and do not match each other.  No input gives no row.

    A line first takes ``FIRST_TRY`` partners a token; lines whose tries all fail
    though more partners wait are compared with all of them in a second pass.
    """
    spark = df.sparkSession
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text")).dropna()
    counts = word_counts(docs)
    ranges, steps = max(ranges, int(counts.sum()) // RANGE), spark.sparkContext.broadcast(steps_of(counts))
    posted = docs.mapInArrow(_postings(steps, ranges, percent, crowds(docs, steps, percent)), POSTING)
    held = Held()
    found = held.keep(posted.groupBy("kind", "range").applyInArrow(_candidates(percent, FIRST_TRY), FOUND))

    place = F.struct("match_doc", "match_line")
    key = ["doc", "line"]
    exact = found.filter("exact").groupBy(*key).agg(F.max("size").alias("size"), F.min(place).alias("match"))
    exact = spill(exact, "equal-lines")
    pairs = found.filter("NOT exact").groupBy(*key, "size", "match_doc", "match_line").agg(
        F.count("*").alias("votes"), F.max("more").alias("more")).join(exact.select(*key), key, "left_anti")
    pairs = spill(pairs, "line-candidates")
    sets = _line_sets(pairs, docs, held)

    # the partner that most tokens name first, then all others of lines that are still open, then those not yet taken
    likely = pairs.groupBy(*key, "size").agg(F.max(F.struct("votes", F.struct("match_doc", "match_line"))).alias("best"))
    likely = likely.select(*key, "size", "best.col2.*")
    tried = spill(_verified(likely, sets, percent), "line-tries")
    open_ = pairs.join(tried.filter("ok").select(*key), key, "left_anti").join(
        tried.select(*key, "match_doc", "match_line"), [*key, "match_doc", "match_line"], "left_anti")
    again = spill(_verified(open_.select(*tried.columns[:-1]), sets, percent), "line-tries")
    near = tried.filter("ok").union(again.filter("ok"))

    open_ = pairs.filter("more").select(*key).distinct().join(near.select(*key), key, "left_anti")
    open_ = spill(open_, "open-lines")
    if open_.limit(1).count():
        near = near.drop("ok").unionByName(_all_partners(open_, docs, steps, percent, held))
    near = near.groupBy(*key).agg(F.max("size").alias("size"), F.min(place).alias("match"))
    out = exact.withColumn("exact", F.lit(True)).union(near.withColumn("exact", F.lit(False))).select(
        F.col("doc").alias("doc_id"), F.col("line").alias("line_no"), F.col("size").alias("n_words"),
        F.col("match.match_doc").alias("match_doc_id"), F.col("match.match_line").alias("match_line_no"), "exact")
    out = spill(out, "repeated-lines")
    held.release()
    for table in (exact, pairs, tried, again, open_):
        discard(table)
    return out


@F.arrow_udf(T.StringType())
def less_lines(texts: pa.Array, numbers: pa.Array) -> pa.Array:
    """Texts without the lines with these numbers."""
    gone = (set(n.as_py() or ()) for n in numbers)
    return pa.array([t.as_py() if not own else "\n".join(x for k, x in enumerate(t.as_py().split("\n")) if k not in own) for t, own in zip(texts, gone)],
                    pa.string())


def without_repeated_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` without repeated lines, with the columns they had.

    A document that loses lines and keeps no word goes as a whole; every other
    row stays, also one without id, text or words.
    """
    doc, numbers = unused(df, "doc"), unused(df, "lines")
    gone = repeated_lines(df, doc_id, text, percent).groupBy(F.col("doc_id").alias(doc)).agg(F.collect_set("line_no").alias(numbers))
    column, lines = F.col(f"`{text}`"), F.col(numbers)
    out = df.join(gone, F.col(f"`{doc_id}`") == F.col(doc), "left").withColumn(text, less_lines(column, lines))
    return out.filter(lines.isNull() | column.rlike("[^\\x20\\x09-\\x0D]")).select(*[F.col(f"`{c}`") for c in df.columns])
