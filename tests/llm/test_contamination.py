import hashlib

import pyarrow as pa
import pytest

from tillwork.llm import contamination
from tillwork.llm.contamination import Patterns, find_items, without_items
from tillwork.llm.queries import QUERIES

from .plain import alnum, clashing, document_rows, frame


def windows(items, size=10):
    found = {}
    for name, text in items:
        w = alnum(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            found.setdefault(tuple(w[i : i + n]), set()).update([] if name is None else [str(name)])
    return found


def plain_hits(text, found):
    w, hit, items = alnum(text), set(), set()
    for n in {len(k) for k in found}:
        for i in range(len(w) - n + 1):
            own = found.get(tuple(w[i : i + n]))
            if own is not None:
                hit.update(range(i, i + n))
                items |= own
    return len(w), hit, sorted(items)


ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "one two three"), (2, "nine, ten"),
         (3, "Solo"), (4, None), (5, " .,; "), (6, "a a a a a a a a a a a a"), (None, "nameless item here"), (7, "one two three")]
TEXTS = [None, "", "...", "alpha beta gamma delta epsilon zeta eta theta iota kappa", "x one TWO\n\nthree y", "two three", "solo",
         "a " * 40, "Alpha, beta; gamma: delta-epsilon zeta eta theta iota kappa lambda mu nu one two three", "a nameless item here",
         "zeta eta theta iota kappa lambda mu", "z " * 5000 + "nine ten", "one two three one two three one two"]


def rows_of(result):
    return [(r["n_words"], {k for a, b in zip(r["starts"], r["ends"]) for k in range(a, b)}, r["items"]) for r in result.to_pylist()]


def test_search_equals_plain_windows():
    tables = Patterns([None if i is None else str(i) for i, _ in ITEMS], [t for _, t in ITEMS])
    found = windows(ITEMS)
    assert rows_of(tables.search(pa.array(TEXTS))) == [plain_hits(t, found) for t in TEXTS]
    assert [m.length for m in tables.machines] == [1, 2, 3, 10]


def test_shift_never_passes_an_occurrence():
    items = [(i, " ".join(f"w{(i * 7 + k * k) % 13}" for k in range(14))) for i in range(40)]
    texts = [" ".join(f"w{(i * 7 + (k + s) ** 2) % 13}" for k in range(600)) for i in range(40) for s in (0, 1, 5)]
    tables = Patterns([str(i) for i, _ in items], [t for _, t in items])
    found = windows(items)
    assert rows_of(tables.search(pa.array(texts))) == [plain_hits(t, found) for t in texts]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_blocks_give_the_same(spark, block_bytes):
    docs = clashing(frame(spark, [(i, t) for i, t in enumerate(TEXTS)] + [(0, "solo"), (None, "solo")]), "found", "n_words", "items")
    items = clashing(frame(spark, ITEMS, "item_id long, text string"), "item", "words")
    rows = find_items(docs, items, block_bytes=block_bytes).collect()
    found = windows(ITEMS)
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        own = {k for a, b in zip(r.found.starts, r.found.ends) for k in range(a, b)}
        assert (r.found.n_words, own, r.found["items"]) == plain_hits(r.text, found)
    kept = without_items(docs, items, block_bytes=block_bytes)
    assert kept.columns == docs.columns
    assert sorted(map(repr, (r.text for r in kept.collect()))) == sorted(
        repr(r.text) for r in docs.collect() if not plain_hits(r.text, found)[1])


def test_empty_tables(spark):
    docs, items = frame(spark, [(1, "solo")]), frame(spark, ITEMS, "item_id long, text string")
    assert find_items(docs, items.limit(0)).first().found.starts == []
    assert find_items(docs.limit(0), items).count() == 0


def test_op4_equals_plain_windows_on_whole_documents(spark, folder):
    found = windows([(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()])
    got = {r.doc_id: r for r in QUERIES["op4_decontaminate"](spark, folder).collect()}
    rows = document_rows(spark, folder)
    assert len(got) == len(rows) and any(r.contaminated for r in got.values())
    for doc, text in rows:
        n, hit, items = plain_hits(text, found)
        digest = hashlib.sha256(",".join(items).encode()).hexdigest()
        assert tuple(got[doc]) == (doc, n, len(hit), len(items), digest, bool(hit))


def test_stretches_meet_without_gap(monkeypatch):
    monkeypatch.setattr(contamination, "STRETCH", 3)
    test_search_equals_plain_windows()
