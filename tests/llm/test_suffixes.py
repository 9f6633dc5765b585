import random
from collections import defaultdict

import numpy as np
import pytest

from tillwork.llm import suffixes
from tillwork.llm.queries import QUERIES

from .plain import clashing, document_rows, frame, spaced


def plain_cover(rows, size=50):
    """Words of each document in a window of ``size`` that stands elsewhere too."""
    seen, cover = {}, defaultdict(set)
    for i, text in rows:
        w = spaced(text)
        for k in range(len(w) - size + 1):
            seen.setdefault(tuple(w[k : k + size]), []).append((i, k))
    for places in seen.values():
        for i, k in places:
            if any(j != i or abs(k - m) >= size for j, m in (places[0], places[-1])):
                cover[i].update(range(k, k + size))
    return cover


def found_cover(rows):
    cover = defaultdict(set)
    for r in rows:
        assert r.n_words == r.last_word - r.first_word >= 50
        cover[r.doc_id].update(range(r.first_word, r.last_word))
    return cover


def words(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


def test_planted_passages(spark, odd_texts, monkeypatch):
    rng = random.Random(7)
    passages = [words(rng, n) for n in (50, 51, 64, 120, 400)]
    rows, planted = [], set()
    for i in range(120):
        body = words(rng, rng.randrange(20, 300))
        if i % 3:
            at = rng.randrange(len(body))
            body[at:at] = passages[i % len(passages)]
            planted.add(i)
        rows.append((i, "  ".join(body).upper() if i % 2 else "\n".join(body)))
    rows += [(1000 + i, t) for i, t in enumerate(odd_texts)] + [(None, rows[1][1])]
    short = words(rng, 49)
    rows += [(2000, " ".join(words(rng, 30) + short)), (2001, " ".join(short + words(rng, 30)))]
    twice = words(rng, 70)
    rows.append((3000, " ".join(twice + words(rng, 20) + twice)))
    df = clashing(frame(spark, rows), "doc", "run", "places")
    got = suffixes.repeated_passages(df).collect()
    cover, wanted = found_cover(got), plain_cover([r for r in rows if r[0] is not None])
    alone = {3000, 1000 + odd_texts.index("word " * 3_000)}
    assert set(cover) == set(wanted) == planted | alone
    assert {i: c for i, c in cover.items()} == dict(wanted)
    assert all(r.match_doc_id in planted and r.match_doc_id != r.doc_id for r in got if r.doc_id not in alone)


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(f"u{i}" for i in range(80))
    assert suffixes.repeated_passages(frame(spark, [(1, text), (1, text)])).count() == 0
    assert {r.doc_id for r in suffixes.repeated_passages(frame(spark, [(1, text), (2, text)])).collect()} == {1, 2}
    assert suffixes.repeated_passages(frame(spark, [])).count() == 0
    assert suffixes.repeated_passages(frame(spark, [(1, None), (2, ""), (3, "a")])).count() == 0


def test_every_window_holds_a_minimiser_at_the_same_place_in_copies():
    rng = np.random.default_rng(3)
    runs = rng.integers(0, 2**63, 700).astype(np.uint64)
    at = minimum = suffixes.minimisers(runs)
    assert np.diff(np.r_[-1, at, len(runs)]).max() <= suffixes.SPREAD
    inner = suffixes.minimisers(runs[100:400]) + 100
    assert set(inner) <= set(minimum)
    steady = suffixes.minimisers(np.full(500, np.uint64(9)))
    assert len(steady) <= 500 // 16 + 1 and np.diff(steady).max() <= suffixes.SPREAD
    assert len(suffixes.minimisers(runs[: suffixes.SPREAD - 1])) == 0


def test_op8_covers_repeated_windows_of_whole_documents(spark, folder):
    rows = document_rows(spark, folder)
    cover, wanted = found_cover(QUERIES["op8_suffix_dedup"](spark, folder).collect()), plain_cover(rows)
    assert set(cover) == set(wanted) and wanted
    both = sum(len(cover[i] & wanted[i]) for i in wanted)
    assert both >= 0.98 * sum(map(len, wanted.values())) and both >= 0.99 * sum(map(len, cover.values()))


@pytest.mark.parametrize("partitions", [3, 200])
def test_a_frequent_run_with_passages_on_either_side(spark, partitions):
    rng = random.Random(11)
    run = words(rng, 24)
    lefts, rights = ([words(rng, 40) for _ in range(12)] for _ in range(2))
    rows = []
    for i in range(240):  # equal words before with others behind, equal words behind with others before, and both
        before = lefts[i % 12] if i % 3 != 1 else words(rng, 40)
        after = rights[i // 12 % 12] if i % 3 != 0 else words(rng, 40)
        rows.append((i, " ".join(words(rng, 10) + before + run + after + words(rng, 10))))
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = suffixes.repeated_passages(frame(spark, rows)).collect()
        cover, wanted = found_cover(got), plain_cover(rows)
        assert wanted and cover == wanted
        few = rows[:6] + [(1000 + i, t) for i, t in rows[:6]]
        assert found_cover(suffixes.repeated_passages(frame(spark, few)).collect()) == plain_cover(few)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


def test_suffixes_are_held_until_the_surroundings_are_known_and_not_written(spark, monkeypatch):
    written, kept = [], []
    monkeypatch.setattr(suffixes, "spill", lambda df, name, real=suffixes.spill: (written.append(name), real(df, name))[1])

    class Watched(suffixes.Held):
        def keep(self, df):
            kept.append(super().keep(df))
            return kept[-1]

    monkeypatch.setattr(suffixes, "Held", Watched)
    passage = " ".join(f"w{i}" for i in range(60))
    rows = suffixes.repeated_passages(frame(spark, [(1, f"a {passage}"), (2, f"b c {passage}")])).collect()
    assert sorted((r.doc_id, r.first_word, r.n_words, r.match_doc_id) for r in rows) == [(1, 1, 60, 2), (2, 2, 60, 1)]
    assert "suffixes" not in written and len(kept) == 1 and not kept[0].storageLevel.useDisk
