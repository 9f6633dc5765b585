"""Operators 1, 5 and 10 and the link graph against plain versions."""

import random

import numpy as np
import pytest

from tillwork.llm import embeddings, lines, minhash
from tillwork.llm.graph import components
from tillwork.llm.queries import QUERIES

from .plain import clashing, document_rows, frame, groups, shingles, spaced


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    links += [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2001 + i) for i in range(300)] + [(5, 5)]
    got = {r.node: r.component for r in components(frame(spark, links + [(None, 3)], "a long, b long")).collect()}
    wanted = groups({x for pair in links for x in pair}, links)
    assert got == {n: c for n, c in wanted.items() if any(n in p and p[0] != p[1] for p in links)}
    assert components(frame(spark, [], "a long, b long")).count() == 0


def copies(base, n, edits, rng, words="stone river cloud ember field quartz"):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(edits):
            w[rng.randrange(len(w))] = rng.choice(words.split()) + str(rng.randrange(10_000))
        out.append(" ".join(w))
    return out


def plain_components(rows, percent):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if x and y and 100 * len(x & y) >= percent * len(x | y)]
    return groups([i for i, _ in sets], links), links


@pytest.mark.parametrize("block, percent", [(512, 85), (4, 85), (512, 80)])
def test_near_duplicates_equal_brute_force(spark, odd_texts, monkeypatch, block, percent):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(8)
    make = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    texts = list(odd_texts)
    for n, count, edits in ((200, 30, 2), (120, 25, 3), (60, 10, 1), (7, 4, 0), (3, 3, 0)):
        base = make(n)
        texts += [base, base, base.upper()] + copies(base, count, edits, rng)
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    df = clashing(frame(spark, rows + [(None, texts[-1]), (None, None)]), "component_id", "kept", "low")
    got = minhash.near_duplicates(df, percent=percent).collect()
    wanted, links = plain_components(rows, percent)
    assert len(got) == len(rows) + 2 and len(links) > 100
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert {i: (r.component_id, r.kept) for i, r in by.items()} == {i: (c, c == i) for i, c in wanted.items()}
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert all(by[i].n_shingles == len(shingles(t)) for i, t in rows)
    kept = minhash.without_copies(df, percent=percent)
    assert kept.columns == df.columns and kept.count() == len({*wanted.values()}) + 2


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows)).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False)]
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    assert minhash.near_duplicates(frame(spark, [(1, None), (2, " ")])).filter("kept AND n_shingles = 0").count() == 2


def test_estimate_is_corrected_for_collisions():
    rng = np.random.default_rng(2)
    sets = [rng.integers(1, 2**63, n).astype(np.uint64) for n in (3, 40, 900)]
    regs = np.stack([minhash.registers(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    assert np.allclose(minhash.estimate(regs, regs, sizes, sizes), 1)
    base = rng.integers(1, 2**63, 1000).astype(np.uint64)
    pairs = [(np.concatenate([base[:800], rng.integers(1, 2**63, 100).astype(np.uint64)]), base[:900]) for _ in range(60)]
    x, y = (np.stack([minhash.registers(p[k]) for p in pairs]) for k in (0, 1))
    mean = minhash.estimate(x, y, np.full(60, 900), np.full(60, 900)).mean()
    assert abs(mean - 0.8) < 0.03
    assert (minhash.chance(np.array([10, 10_000]), np.array([12, 10_000])) < 2**-9).all()


def test_op5_equals_brute_force_on_whole_documents(spark, folder):
    rows = document_rows(spark, folder)
    wanted, links = plain_components(rows, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op5_minhash"](spark, folder).collect()}
    assert links and got == {i: (len(shingles(t)), wanted[i], wanted[i] == i) for i, t in rows}


def plain_repeats(rows, percent=80):
    """(doc, line) to whether an equal set came before."""
    seen, out = [], {}
    for place, words in sorted(((i, k), frozenset(spaced(line))) for i, t in rows if i is not None and t is not None
                               for k, line in enumerate(t.split("\n"))):
        if words:
            matches = [w for w in seen if 100 * len(w & words) >= percent * len(w | words)]
            if matches:
                out[place] = words in matches
            seen.append(words)
    return out


@pytest.mark.parametrize("tries", [4, 1])
def test_repeated_lines_equal_brute_force(spark, odd_texts, monkeypatch, tries):
    monkeypatch.setattr(lines, "FIRST_TRY", tries)
    rng = random.Random(3)
    base = [" ".join(f"w{rng.randrange(60)}" for _ in range(n)) for n in (30, 18, 25, 12, 5, 4, 9)]
    own = [t for b in base for t in [b, b.upper(), *copies(b, 14, 1, rng), *copies(b, 14, 2, rng), *copies(b, 8, 4, rng)]]
    rng.shuffle(own)
    texts = ["\n".join(own[i : i + 5]) for i in range(0, len(own), 5)] + odd_texts + ["\n\nA\n\n", base[0] + "\n" + base[0]]
    rows = list(enumerate(texts))
    df = clashing(frame(spark, rows + [(None, base[0])]), "line", "exact", "key")
    got = lines.repeated_lines(df).collect()
    wanted = plain_repeats(rows)
    assert {(r.doc_id, r.line_no): r.exact for r in got} == wanted and len(got) == len(wanted) > 100
    place = {(i, k): frozenset(spaced(x)) for i, t in rows if t is not None for k, x in enumerate(t.split("\n"))}
    for r in got:
        a, b = place[r.doc_id, r.line_no], place[r.match_doc_id, r.match_line_no]
        assert 100 * len(a & b) >= 80 * len(a | b) and (r.match_doc_id, r.match_line_no) < (r.doc_id, r.line_no) and r.n_words == len(a)


def test_lines_are_taken_out(spark):
    rows = [(1, "one two three\nfour five six\n"), (2, "One two three\nseven eight"), (3, "four five six"), (4, None), (5, ""),
            (None, "four five six"), (6, " \nnine\n\n"), (7, "nine\n  \n")]
    df = clashing(frame(spark, rows), "_x", "line_no")
    out = lines.without_repeated_lines(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(
        [(1, "one two three\nfour five six\n"), (2, "seven eight"), (4, None), (5, ""), (None, "four five six"), (6, " \nnine\n\n")], key=repr)
    assert lines.repeated_lines(frame(spark, [])).count() == 0 and lines.without_repeated_lines(frame(spark, [])).count() == 0
    assert lines.repeated_lines(frame(spark, [(1, None), (2, " \n ")])).count() == 0


@pytest.mark.parametrize("parts", [1, 8])
def test_lines_of_a_repeated_row_do_not_match_themselves(spark, parts):
    rows = [(1, "one two three\nfour five six\none two three"), (2, "seven eight"), (3, "four five six\nnine ten")]
    df = frame(spark, rows + rows).coalesce(parts)
    got = {(r.doc_id, r.line_no, r.match_doc_id, r.match_line_no, r.exact) for r in lines.repeated_lines(df).collect()}
    assert got == {(1, 2, 1, 0, True), (3, 0, 1, 1, True)}
    wanted = [(1, "one two three\nfour five six"), (2, "seven eight"), (3, "nine ten")]
    assert sorted(tuple(r) for r in lines.without_repeated_lines(df).collect()) == sorted(wanted + wanted)


class Sent:
    def __init__(self, value):
        self.value = value


@pytest.mark.parametrize("blocks", [1, 5])
def test_equal_lines_and_hot_tokens_are_spread_over_ranges(blocks):
    import pyarrow as pa

    rng = random.Random(2)
    rows = [(i, "hot " + " ".join(f"w{rng.randrange(9)}" for _ in range(4))) for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows])], ["doc", "text"])
    steps, crowd = Sent(np.zeros(lines.CLASSES, np.uint8)), Sent(np.full(lines.CLASSES, blocks, np.uint16))
    groups_ = {}
    for out in lines._postings(steps, 16, 80, crowd)(iter([batch])):
        for row in out.to_pylist():
            groups_.setdefault((row["kind"], row["range"]), []).append(row)
    assert len([1 for kind, _ in groups_ if kind == 2]) == 16
    units = [lines._unpacked(pa.Table.from_pylist(g))["key"] for (kind, _), g in groups_.items() if kind not in (0, 2)]
    largest = max(np.unique(k, return_counts=True)[1].max() for k in units)
    got, exact = set(), set()
    for g in groups_.values():
        for r in lines._candidates(80, 10_000)(pa.Table.from_pylist(g, pa.schema([("kind", pa.int32()), ("range", pa.int32()), *((c, pa.binary()) for c in lines.POSTED[2:])]))).to_pylist():
            (exact if r["exact"] else got).add(((r["doc"], 0), (r["match_doc"], 0)))
    sets = {(i, 0): frozenset(t.split()) for i, t in rows}
    kept = sorted(set(sets) - {a for a, _ in exact})
    wanted = {(a, b) for k, a in enumerate(kept) for b in kept[:k] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert {a: sets[b] for a, b in exact} == {a: sets[a] for a, _ in exact} and len(kept) == len(set(sets.values()))
    assert wanted and wanted <= got and (largest < len(kept) * 0.7 or blocks == 1)


@pytest.mark.parametrize("tries", [4, 1])
def test_lines_of_hot_tokens_equal_brute_force(spark, monkeypatch, tries):
    monkeypatch.setattr(lines, "FIRST_TRY", tries)
    monkeypatch.setattr(lines, "HOT", 20)
    monkeypatch.setattr(lines, "SAMPLE", 1)
    rng = random.Random(5)
    rows = [(i, "\n".join(" ".join(f"w{rng.randrange(14)}" for _ in range(rng.randrange(3, 9))) for _ in range(3))) for i in range(60)]
    docs = frame(spark, rows).toDF("doc", "text")
    assert lines.crowds(docs, spark.sparkContext.broadcast(lines.rarity(docs)), 80).value.max() > 2
    assert {(r.doc_id, r.line_no): r.exact for r in lines.repeated_lines(frame(spark, rows)).collect()} == plain_repeats(rows)


def test_a_text_of_more_than_a_million_lines():
    import pyarrow as pa

    n = (1 << 20) + 5
    got = lines.Lines(pa.array(["a\n" * (n - 1) + "b c b"]), np.zeros(lines.CLASSES, np.uint8))
    assert len(got.size) == len(got.line) == len(got.begin) == n and len(got.token) == n + 1
    assert got.size[-1] == 2 and (got.size[:-1] == 1).all() and got.line[-1] == n - 1


def test_op1_equals_brute_force_on_whole_documents(spark, folder):
    got = QUERIES["op1_line_dedup"](spark, folder).collect()
    assert {(r.doc_id, r.line_no): r.exact for r in got} == plain_repeats(document_rows(spark, folder))


def plain_vectors(rows, cosine):
    use = [(i, np.array(v, float), lab) for i, v, lab in rows
           if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = []
    for k, (a, x, p) in enumerate(use):
        for b, y, q in use[:k]:
            if p == q and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links.append((a, b))
    return links, groups([i for i, _, _ in rows if i is not None], links)


@pytest.mark.parametrize("block", [512, 7])
def test_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(6)
    rows, n = [], 0
    for center in rng.standard_normal((12, 24)):
        for k in range(14):
            v = center + rng.standard_normal(24) * (0.0, 0.1, 0.22)[k % 3]
            rows.append((n, [float(x) for x in v * (1 + k)], int(n % 2)))
            n += 1
    same = rows[5][1]
    rows += [(n + i, same, 1) for i in range(40)]
    n += 40
    odd = [None, [], [0.0] * 24, [None] + same[1:], [float("nan")] + same[1:], [float("inf")] + same[1:], same[:-1], [-0.0] + [1.0] * 23, [0.0] + [1.0] * 23]
    rows += [(n + i, v, 1) for i, v in enumerate(odd)] + [(n + 50, same, None)]
    df = clashing(frame(spark, rows + [(None, same, 1)], "vec_id long, embedding array<double>, label int"), "class", "key", "links")
    got = embeddings.vector_links(df).collect()
    links, comp = plain_vectors(rows, 0.93)
    count = {i: 0 for i, _, _ in rows}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    assert len(got) == len(rows) + 1
    by = {r.vec_id: r for r in got if r.vec_id is not None}
    found = sum(r.n_links for r in by.values())
    assert all(by[i].n_links <= c for i, c in count.items()) and found >= 0.99 * sum(count.values())
    if found == sum(count.values()):
        assert {i: (r.component_id, r.kept) for i, r in by.items()} == {i: (c, c == i) for i, c in comp.items()}
    assert embeddings.vector_links(df.limit(0)).count() == 0


def test_op10_recall_and_precision_on_whole_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    links, comp = plain_vectors(rows, 0.93)
    got = {r.vec_id: r for r in QUERIES["op10_embedding_dedup"](spark, folder).collect()}
    assert len(got) == len(rows) and sum(r.n_links for r in got.values()) <= 2 * len(links)
    assert sum(r.n_links for r in got.values()) >= 0.98 * 2 * len(links)


def words_alike_in_their_upper_bits():
    """Two words whose numbers agree in the upper 38 bits."""
    import pyarrow as pa

    from tillwork.llm.words import words_of

    plain = [f"w{i}" for i in range(2_000_000)]
    upper = words_of(pa.array([" ".join(plain)])).hash >> np.uint64(26)
    order = np.argsort(upper)
    at = np.flatnonzero(upper[order][1:] == upper[order][:-1])[0]
    return plain[order[at]], plain[order[at + 1]]


def test_words_that_share_bits_and_built_words_are_told_apart(spark):
    one, other = words_alike_in_their_upper_bits()
    signs = [i.bit_count() % 2 for i in range(1024)]
    a, b = "".join("ab"[s] for s in signs), "".join("ba"[s] for s in signs)
    rows = [(1, one), (2, other), (3, f"{one} {other} tail"), (4, f"{other} {one} tail"), (5, a), (6, b), (7, b)]
    got = {(r.doc_id, r.line_no): r for r in lines.repeated_lines(frame(spark, rows)).collect()}
    assert set(got) == {(4, 0), (7, 0)} and got[4, 0].n_words == 3 and got[7, 0].match_doc_id == 6
    assert {(r.doc_id, r.component_id) for r in minhash.near_duplicates(frame(spark, rows)).collect()} >= {(5, 5), (6, 6), (7, 6), (1, 1), (2, 2)}


def test_the_set_of_a_long_line_is_sent_once(spark):
    import pyarrow as pa

    steps = spark.sparkContext.broadcast(np.zeros(lines.CLASSES, np.uint8))
    text = " ".join(f"w{i}" for i in range(100_000))
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([text])], ["doc", "text"])
    sent = list(lines._loose_postings(steps, 80)(iter([batch])))
    assert sum(b.nbytes for b in sent) < 4_000_000 and sum(b.num_rows for b in sent) == 20_002


def test_open_lines_meet_all_partners_also_with_long_lines(spark, monkeypatch):
    monkeypatch.setattr(lines, "FIRST_TRY", 1)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(2_000)]
    rows = [(i, " ".join(base[: 1_600 + 10 * i] + [f"x{i}_{k}" for k in range(rng.randrange(300))])) for i in range(30)]
    rows += [(100 + i, " ".join(rng.sample(base[:40], 9))) for i in range(150)]
    got = {(r.doc_id, r.line_no): r.exact for r in lines.repeated_lines(frame(spark, rows)).collect()}
    assert got == plain_repeats(rows)


def test_open_lines_fetch_only_lines_that_share_a_first_token_of_like_size():
    import pyarrow as pa

    steps = Sent(np.zeros(lines.CLASSES, np.uint8))
    common = [f"w{i}" for i in range(30)]
    rows = [(0, " ".join(common[:10])), (1, " ".join([*common[:9], "x"])), (2, " ".join(common[:4])), (3, " ".join(common))]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows])], ["doc", "text"])

    def marked(columns):
        (out,) = lines._mark(iter([pa.RecordBatch.from_arrays(columns, [str(i) for i in range(len(columns))])]))
        return Sent(np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in out.column(1)]))

    asked = pa.Table.from_batches(lines._loose_postings(steps, 80)(iter([batch.slice(0, 1)]))).to_pylist()
    first = [(r["token"], r["step"] + k) for r in asked if r["token"] is not None for k in (-1, 0, 1)]
    wanted = marked([pa.array([r["members"] for r in asked if r["members"]], pa.binary())])
    leads = marked([pa.array([t for t, _ in first], pa.int64()), pa.array([s for _, s in first], pa.int32())])
    sent = pa.Table.from_batches(lines._loose_postings(steps, 80, wanted, leads)(iter([batch]))).to_pylist()
    assert {r["doc"] for r in sent} in ({0}, {0, 1})  # not 2 and 3, of which all words are wanted but which are too short or too long
    assert {r["doc"] for r in sent if r["members"]} == {r["doc"] for r in sent}


def test_verified_sets_are_not_shuffled_again(spark):
    from tillwork.llm.store import Held

    docs = frame(spark, [(i, f"a b c d e{i % 3}\nf g h") for i in range(40)]).toDF("doc", "text")
    pairs = spark.createDataFrame([(i, 0, 5, i - 3, 0) for i in range(3, 40)], "doc long, line int, size int, match_doc long, match_line int")
    held, limit = Held(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sets = lines._line_sets(pairs, docs, held)
        out = lines._verified(pairs, sets, 80)
        assert out.filter("ok").count() == 37
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ENSURE_REQUIREMENTS") == 2  # of the pairs, which move to either side
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        held.release()
