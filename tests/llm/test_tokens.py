"""Operators 2 and 6 against the public libraries."""

import base64
import hashlib
from functools import lru_cache

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillwork.llm import bpe, token_counts
from tillwork.llm.queries import COUNTING, RANKS
from tillwork.llm.queries import QUERIES

from .plain import clashing, document_rows, frame


@lru_cache
def library():
    with open(P.path(RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture
def byte_level():
    return library()


@pytest.fixture(scope="module")
def word_level():
    return Tokenizer.from_file(P.path(COUNTING))


def ids(text):
    _, splitter, pieces = bpe.load(P.path(RANKS), P.PATTERN)
    return np.frombuffer(bpe.pack(text, splitter, pieces), "<u4").tolist()


def test_odd_texts(odd_texts, byte_level, word_level):
    for text in filter(None, odd_texts):
        assert ids(text) == byte_level.encode_ordinary(text)
    texts = [t or "" for t in odd_texts]
    assert token_counts.load(P.path(COUNTING)).count(odd_texts) == [
        len(e.ids) for e in word_level.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aabbceinrst'\n .1"), st.characters(codec="utf-8", max_codepoint=0x24FF)), max_size=60))
def test_any_text(text):
    assert ids(text) == library().encode_ordinary(text)


def test_rank_queue_gives_lowest_rank_with_its_places():
    queue, rng = bpe.RankQueue(), np.random.default_rng(1)
    pairs = [(int(r), int(p)) for r, p in zip(rng.integers(0, 60_000, 500) // 300 * 300, rng.permutation(500))]
    for pair in pairs:
        queue.push(*pair)
    out = []
    while queue.high:
        rank, places = queue.pop()
        out += [(rank, p) for p in sorted(places)]
    assert out == sorted(pairs)


def test_very_long_pieces(byte_level):
    text = "ab" * 30_000 + "é" * 5_000
    assert ids(text) == byte_level.encode_ordinary(text)


def test_unknown_pieces_of_a_text_share_a_queue(monkeypatch, odd_texts, byte_level):
    calls, merge = [], bpe.merge
    monkeypatch.setattr(bpe, "merge", lambda pieces, ranks: calls.append(len(pieces)) or merge(pieces, ranks))
    _, splitter, known = bpe.load(P.path(RANKS), P.PATTERN)
    text = " ".join(f"zq{i}xv aaaa{'ab' * (i % 5)}é" for i in range(300)) + " ".join(t or "" for t in odd_texts)
    for together in (1 << 13, 40):
        monkeypatch.setattr(bpe, "TOGETHER", together)
        store = bpe.Pieces(known.ranks, 100_000)
        calls.clear()
        assert np.frombuffer(bpe.pack(text, splitter, store), "<u4").tolist() == byte_level.encode_ordinary(text)
        assert max(calls) > 3 and (together < 100 or max(calls) > 200)


def test_full_stores_change_nothing(monkeypatch, byte_level, word_level):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 3)
    monkeypatch.setattr(bpe, "LONG_TEXT", 5)
    monkeypatch.setattr(token_counts, "KEPT_WORDS", 3)
    monkeypatch.setattr(token_counts, "LONG_TEXT", 5)
    text = "one two three four one two three four fifteen"
    assert ids(text) == byte_level.encode_ordinary(text)
    assert token_counts.load(P.path(COUNTING)).count([text, text]) == [len(word_level.encode(text, add_special_tokens=False).ids)] * 2


def test_merging_one_place_a_round_gives_the_same(odd_texts):
    own = token_counts.WordPieces(P.path(COUNTING))
    assert own.together
    together = own.count(odd_texts)
    slow = token_counts.WordPieces(P.path(COUNTING))
    slow.together = False
    assert slow.count(odd_texts) == together


def test_op6_matches_the_library_on_whole_documents(spark, folder, byte_level):
    got = {r.doc_id: r for r in QUERIES["op6_bpe"](spark, folder).collect()}
    rows = document_rows(spark, folder)
    assert len(got) == len(rows)
    for doc, text in rows:
        own = byte_level.encode_ordinary(text or "")
        assert got[doc].n_tokens == len(own)
        assert got[doc].ids_sha256 == hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_op2_matches_the_library_on_whole_documents(spark, folder, word_level):
    got = {r.doc_id: r for r in QUERIES["op2_token_counts"](spark, folder).collect()}
    for doc, text in document_rows(spark, folder):
        n = len(word_level.encode(text or "", add_special_tokens=False).ids)
        assert (got[doc].n_bytes, got[doc].n_tokens, got[doc].over_limit) == (len((text or "").encode()), n, n > 2048)


def test_edges_in_spark(spark, odd_texts, byte_level):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "x y"), (None, "x y")]
    df = clashing(frame(spark, rows), "ids", "n_tokens", "decoded", "pythonUDF0")
    where = P.path(RANKS), P.PATTERN
    for out in (bpe.decode(bpe.with_tokens(df, *where), *where).collect(), bpe.transcode(df, *where).collect()):
        assert len(out) == len(rows)
        assert sorted((bytes(r.decoded).decode(), r.n_tokens, r.pythonUDF0) for r in out) == sorted(
            (t or "", len(byte_level.encode_ordinary(t or "")), "extra") for _, t in rows)
        assert all(np.frombuffer(r["ids"], "<u4").tolist() == byte_level.encode_ordinary(r.text or "") for r in out)
    counts = token_counts.token_counts(df, P.path(COUNTING)).collect()
    assert len(counts) == len(rows) and all(r.n_tokens == 0 for r in counts if not r.text)
    empty = frame(spark, [])
    assert bpe.with_tokens(empty, *where).count() == 0 and token_counts.token_counts(empty, P.path(COUNTING)).count() == 0


def test_decode_null_and_unknown(spark):
    where = P.path(RANKS), P.PATTERN
    df = spark.createDataFrame([(None,), (bytearray(),)], "ids binary")
    assert sorted([r.decoded for r in bpe.decode(df, *where).collect()], key=repr) == sorted([None, bytearray()], key=repr)


def test_ids_are_spelled_for_a_whole_batch():
    import pyarrow as pa

    vocabulary = pa.array([b"a", None, b"bc", b""], pa.large_binary())
    packed = pa.array([np.array(x, "<u4").tobytes() if x is not None else None for x in ([], [2, 0], None, [3], [0, 0, 2])], pa.binary())
    assert bpe.spelled(packed, vocabulary).to_pylist() == [b"", b"bca", None, b"", b"aabc"]
    assert bpe.spelled(packed.slice(1, 3), vocabulary).to_pylist() == [b"bca", None, b""]
    for unknown in (1, 4):
        with pytest.raises(ValueError):
            bpe.spelled(pa.array([np.array([0, unknown], "<u4").tobytes()], pa.binary()), vocabulary)


def test_other_tokenizer_files_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        token_counts.WordPieces(P.path("byte_bpe_50k.json"))
