import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from tillwork.llm import audit

from .plain import clashing

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def plain_fails(rows):
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    out = []
    for i, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and smallest[t] < i}
        out.append((i, s or "", {k for k, v in fails.items() if v}))
    return out


def plain_audit(rows, labels):
    """Every order applied document by document."""
    good, toxic = ({r[0] for r in labels if r[k] == 1} - {None} for k in (1, 2))  # a null id is no label of a row without id
    found, shapley = {}, {}
    failed = plain_fails(rows)
    for part in {p for _, p, _ in failed}:
        own = [(i, f) for i, p, f in failed if p == part]
        for order in map("".join, permutations("ABCDE")):
            alive = list(own)
            for step, one in enumerate(order, 1):
                gone = [(i, f) for i, f in alive if one in f]
                alive = [(i, f) for i, f in alive if one not in f]
                failing = sum(one in f for _, f in own)
                found[part, order, step] = [len(alive), len(gone), failing - len(gone), sum(f == {one} for _, f in own),
                                            sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
                shapley[part, one] = shapley.get((part, one), 0) + len(gone)
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in found.items()}


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def check(spark, rows, labels, *extra):
    df = clashing(spark.createDataFrame(rows, DOCS), *extra)
    got = audit.audited(df, clashing(spark.createDataFrame(labels, LABELS), "part", "mask")).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r[c] for c in COLUMNS) for r in got}
    assert len(found) == len(got) and found == plain_audit(rows, labels)
    return found


def some_rows(n, seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        words = [rng.choice(["the", "a", f"w{rng.randrange(400)}", f"v{rng.randrange(400)}"]) for _ in range(rng.choice([3, 150, 199, 200, 260]))]
        if rng.random() < 0.3:
            words = [w.upper() if rng.random() < 0.5 else w for w in words]
        if rng.random() < 0.3:
            words.append(rng.choice("#$%&*|"))
        if rng.random() < 0.4:
            words = [w for w in words if rng.random() < 0.9][:10] * 30
        texts.append(" ".join(words))
    return [(i, rng.choice(texts) if rng.random() < 0.4 else texts[i], rng.choice(["x", "y", None, ""])) for i in range(n)]


def test_equals_every_order_applied_to_every_document(spark):
    rows = some_rows(80, 5)
    labels = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 90, 2)]
    found = check(spark, rows, labels, "mask", "digest", "part", "good", "documents")
    assert len(found) == 3 * 600 and {p for p, _, _ in found} == {"", "x", "y"}
    assert all(sum(v[-1] for (p, o, s), v in found.items() if p == "x" and o == "ABCDE") == 120 * sum(
        v[1] for (p, o, s), v in found.items() if p == "x" and o == "ABCDE") for _ in [0])  # Shapley shares add up


def test_edges(spark, odd_texts):
    rows = [(i, t, "s") for i, t in enumerate(odd_texts)]
    rows += [(None, "A", "s"), (None, "A", "s"), (3, "A", "s"), (3, "A", "t"), (500, None, None), (501, "", "t"), (502, "z" * 100_000, "t")]
    labels = [(3, 1, 0), (3, 0, 1), (3, 1, None), (None, 1, 1), (9_999, 1, 1), (0, None, None), (501, 1, 1)]
    check(spark, rows, labels)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert audit.audited(docs, labels).count() == 0
    check(spark, [(1, "a", "x")], [])


def test_all_copies_of_one_text(spark):
    rows = [(i, "same", "x" if i % 3 else "y") for i in range(2_000)]
    found = check(spark, rows, [(0, 1, 1), (1, 1, 0)])
    assert found["y", "EABCD", 1][:2] == (1, 666) and found["x", "EABCD", 1][:2] == (0, 1333)


def test_paths_through_the_lattice():
    before, after = audit.reaching(5), audit.leaving(5)
    assert before[31] == after[0] == 120 and before[0] == after[31] == 1
    assert all(before[s] * after[s] == sum(all(({*o[:k]} == {i for i in range(5) if s >> i & 1}) for k in [s.bit_count()])
                                           for o in permutations(range(5))) for s in range(32))


def test_masks_are_kept_for_each_row(spark):
    rows = some_rows(40, 9)
    got = audit.failed_filters(spark.createDataFrame(rows, DOCS)).withColumn("mask", F.col("mask")).collect()
    wanted = {(i, p, sum(1 << "ABCDE".index(x) for x in f)) for i, p, f in plain_fails(rows)}
    assert {tuple(r) for r in got} == wanted
