import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tillwork.llm import trie
from tillwork.llm.queries import QUERIES

from .plain import clashing

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows):
    """Nodes by their whole paths."""
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [v[2:] for v in sorted(turns)] for c, turns in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    kids, leaves, saved = {}, {}, {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    for path in sorted(members, key=len, reverse=True):
        below = kids.get(path, [])
        leaves[path] = sum(leaves[k] for k in below) or 1
        saved[path] = sum(saved[k] for k in below) + ((len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in members.items())


def check(spark, rows, *extra):
    df = clashing(spark.createDataFrame(rows, SCHEMA), *extra)
    got = sorted(tuple(r) for r in trie.prefix_trie(df).select(*COLUMNS).collect())
    assert got == plain_trie(rows)
    return got


def some_rows(conversations, longest, seed, kinds=3):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["u", None, ""]) if rng.random() < 0.1 else "u", rng.choice("xyé"[:kinds]) * rng.randrange(1, 3))
            for c in rng.sample(range(3 * conversations), conversations) for t in range(rng.randrange(1, longest))]


def test_equals_whole_paths(spark):
    got = check(spark, some_rows(300, 14, 1), "depth", "chunk", "c", "x", "said")
    assert max(r[4] for r in got) > 5 and max(r[1] for r in got) > 10


def test_edges(spark):
    rows = [(0, 1, "u", "a"), (0, None, "u", "b"), (0, None, "u", "b"), (0, None, None, "b"), (0, 1, "a", "a"), (0, 1, "a", None), (None, 1, "u", "a"),
            (7, 3, "u", "late"), (12, 0, "u", ""), (12, 0, "u", ""), (3, 0, None, None), (4, -5, "u", "x" * 100_000), (4, 2, "x" * 100_000, ""), (9, 0, "u", "a:b"), (13, 0, "u:a", "b")]
    got = check(spark, rows)
    assert any(r[1] == 0 and r[3] == 7 for r in got)


def test_empty_table_and_one_turnless_conversation(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    got = check(spark, [(alone, 0, "u", "taken away")])
    assert got == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


def test_copies_of_one_conversation_and_a_hot_parent(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 200)
    rows = [(5 * c, t, "u", f"same {t}") for c in range(400) for t in range(4)]
    rows += [(5 * c + 5_000, t, "u", "same 0" if t == 0 else f"other {c} {t}") for c in range(300) for t in range(3)]
    got = check(spark, rows)
    assert max(r[3] for r in got) == 700


@pytest.mark.parametrize("chunk", [7, 4096])
def test_deep_chains_contract_in_few_rounds(spark, monkeypatch, chunk):
    monkeypatch.setattr(trie, "CHUNK", chunk)
    rows = [(c, t, "u", f"t{t}" if t < 150 else f"t{t} {c}") for c in (0, 5, 10) for t in range(300)]
    rounds = []
    plain_spill = trie.spill
    monkeypatch.setattr(trie, "spill", lambda df, name: rounds.append(name) or plain_spill(df, name))
    check(spark, rows)
    assert rounds.count("alive") <= 18


def test_running_totals_go_over_chunks(spark):
    rows = [(k, i, i // 5) for k in (1, 2) for i in range(23)]
    df = spark.createDataFrame(rows, "conv long, i long, chunk long")
    got = trie._carried(df, ["conv"], F.col("i"), total=(F.sum, "i"), mixed=(F.bit_xor, "i")).collect()
    assert len(got) == 46
    for r in got:
        x = 0
        for i in range(r.i + 1):
            x ^= i
        assert (r.total, r.mixed) == (r.i * (r.i + 1) // 2, x)


def test_all_conversations_of_the_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op11_prefix_trie"](spark, folder).select(*COLUMNS).collect())
    assert got == plain_trie(rows)
