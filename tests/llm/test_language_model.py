import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tillwork.llm import language_model
from tillwork.llm.queries import QUERIES

from .plain import clashing, document_rows, frame, spaced

END = "\0end"


def plain_base(rows):
    tokens = [spaced(t) + [END] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    counts = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(counts.values()), len(counts)
    out = [(h, len(t), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t))
           for t, h in zip(tokens, held)]
    return out, tokens, held, counts


def plain_score(tokens, weights, bigrams, counts, starts):
    n, v, total, before = sum(counts.values()), len(counts), 0.0, None
    for w in tokens:
        context = starts if before is None else counts[before]
        a, b, c = weights[context.bit_length()]
        two = bigrams[before, w] / context if context else 0
        total += math.log10(a * two + b * counts[w] / n + c / (v + 1))
        before = w
    return total


def check_base(rows, got):
    wanted, *_ = plain_base(rows)
    key = lambda r: (repr(r[0]), r[2], r[5])
    a = sorted(((i, *w) for (i, _), w in zip(rows, wanted)), key=key)
    b = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    for x, y in zip(a, b, strict=True):
        assert x[:5] == y[:5] and x[5] == pytest.approx(y[5], rel=1e-9)


@pytest.mark.parametrize("portion", [24 << 20, 50_000])
def test_op7_counts_and_scores_on_whole_documents(spark, folder, monkeypatch, portion):
    monkeypatch.setattr(language_model, "PORTION", portion)
    learned = []
    learn = language_model.learn_weights
    monkeypatch.setattr(language_model, "learn_weights", lambda *a: learned.append(learn(*a)) or learned[-1])
    rows = document_rows(spark, folder)
    got = {r.doc_id: r for r in QUERIES["op7_lm_score"](spark, folder).collect()}
    check_base(rows, got.values())
    _, tokens, held, counts = plain_base(rows)
    bigrams = Counter((a, b) for t, h in zip(tokens, held) if not h for a, b in zip([None, *t], t))
    for (i, _), t in zip(rows, tokens):
        assert got[i].score == pytest.approx(plain_score(t, learned[0], bigrams, counts, counts[END]), rel=1e-9)
    unseen = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_weights_are_those_of_plain_expectation_maximisation():
    rng = np.random.default_rng(5)
    cells = []
    for two, one, n in zip(rng.uniform(0.01, 0.6, 30), rng.uniform(0.001, 0.05, 30), rng.integers(1, 50, 30)):
        cell = [1 + int(-math.log2(x) * language_model.STEPS) for x in (two, one)]
        code = np.ravel_multi_index((3, *cell), (language_model.BUCKETS, language_model.CELLS, language_model.CELLS))
        cells.append((code, float(n), n * math.log(two), n * math.log(one)))
    weights = language_model.learn_weights(cells, 999)
    assert np.allclose(weights.sum(axis=1), 1) and weights[0, 0] == 0 and (weights[1:] > 0).all()
    parts = np.array([[math.exp(c[2] / c[1]), math.exp(c[3] / c[1]), 1 / 1000] for c in cells])
    n = np.array([c[1] for c in cells])
    share = weights[3] * parts
    again = ((share / share.sum(axis=1, keepdims=True) * n[:, None]).sum(axis=0) + 1) / (n.sum() + 3)
    assert np.allclose(again, weights[3], atol=1e-3)
    assert (weights[4] == weights[3]).all()


def test_model_is_a_distribution(spark):
    """Probabilities of all next words add up to one, the unseen word included."""
    texts = ["a b a c", "b a b", "c c a b", "a", ""] * 3
    rows = [(i, t) for i, t in enumerate(texts)]
    _, tokens, held, counts = plain_base(rows)
    bigrams = Counter((a, b) for t, h in zip(tokens, held) if not h for a, b in zip([None, *t], t))
    weights = language_model.learn_weights([], len(counts))
    for before in "abc":
        total = sum(10 ** (plain_score([before, w], weights, bigrams, counts, counts[END]) - plain_score([before], weights, bigrams, counts, counts[END]))
                    for w in [*counts, "never"])
        assert total == pytest.approx(1)


def test_edges(spark, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "a b"), (3, "A"), (3, "A")]
    got = language_model.scores(clashing(frame(spark, rows), "row", "fold", "block", "score")).collect()
    check_base(rows, got)
    assert all(math.isfinite(r.score) for r in got)
    assert language_model.scores(frame(spark, [])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = language_model.scores(frame(spark, [(held, "only this")])).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0.0)


def test_packing():
    for values in (np.zeros(0, np.uint32), np.array([0, 1, 2**32 - 1, 70_000], np.uint32)):
        assert (language_model.unpacked(language_model.packed(values)) == values).all()
    keys = np.sort(np.random.default_rng(0).integers(0, 2**63, 50).astype(np.uint64) * np.uint64(2))
    assert (language_model.risen(language_model.rising(keys)) == keys).all()


def test_counts_beyond_32_bits():
    import pyarrow as pa

    for values in ([0, 5, 2**32 - 1], [0, 2**32, 7], [3_000_000_000, 2**50], []):
        assert language_model.unpacked(language_model.packed(np.array(values, np.uint64))).tolist() == values
    keys, counts = language_model.rising(np.array([5, 9], np.uint64)), language_model.packed(np.array([3_000_000_000, 1], np.uint32))
    rows = [{"range": 0, "block": b, "portion": 0, "kind": kind, "keys": keys, "train": counts, "deleted": counts} for b in (0, 1) for kind in (0, 1)]
    got = language_model.answer(pa.Table.from_pylist(rows)).to_pylist()
    assert all(language_model.unpacked(r["train"]).tolist() == [6_000_000_000, 2] and r["n_train"] == 6_000_000_002 for r in got)


def test_rows_without_id_are_dealt_to_many_blocks_and_scored_alike(spark, monkeypatch):
    monkeypatch.setattr(language_model, "BLOCK_BYTES", 2_000)
    rows = [(None, f"word{i % 50} and word{i % 7} again") for i in range(400)] + [(i, f"word{i} and more") for i in range(40)]
    by_text = {}
    for r, (_, text) in zip(sorted(language_model.scores(frame(spark, rows)).collect(), key=lambda r: (r.doc_id is None, r.doc_id)), rows):
        by_text.setdefault(r.doc_id, []).append(r)
    assert len(by_text[None]) == 400 and len({r.train_tokens for rs in by_text.values() for r in rs}) == 1
    monkeypatch.setattr(language_model, "BLOCK_BYTES", 1 << 30)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens, round(r.score, 9), round(r.base_score, 9))
    whole = sorted(map(key, language_model.scores(frame(spark, rows)).collect()))
    assert whole == sorted(key(r) for rs in by_text.values() for r in rs)
