import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tillwork.llm import quality_rules as quality
from tillwork.llm.queries import QUERIES

from .plain import clashing
from .test_signals import plain_counts

DOCS = "doc_id long, text string, lang string, source string"


def plain_measures(text):
    text = text or ""
    n, _, repeated, lines, different = plain_counts(text)
    return (n, len(re.sub(r"[\x20\x09-\x0D]", "", text)), len(re.findall(r"[#*$%&|<>]", text)), lines - different, repeated)


def plain_bucket(v):
    """(lowest, highest) value of the bucket: exact below 128, then 64 buckets to each doubling."""
    wide = 1 << max(0, v.bit_length() - 7)
    return v // wide * wide, v // wide * wide + wide - 1


def plain_judged(rows):
    measured = [(i, g, s, plain_measures(t)) for i, t, g, s in rows]
    groups, limits = {}, {}
    for _, g, s, m in measured:
        for rule in quality.RULES if m[0] else []:
            v = rule.scale * m[quality.MEASURES.index(rule.measure)] // m[0]
            for key in ((0, g, s), (1, g, None), (2, None, None)):
                groups.setdefault((key, rule.name), []).append(plain_bucket(v)[1])
    for (key, name), values in groups.items():
        values.sort()
        q1, q3 = (values[math.ceil(k * len(values) / 4) - 1] for k in (1, 3))
        limits[key, name] = len(values), q1 - 3 * (q3 - q1), q3 + 3 * (q3 - q1)
    out = Counter()
    for i, g, s, m in measured:
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        broken = []
        for rule in quality.RULES if m[0] else []:
            v = rule.scale * m[quality.MEASURES.index(rule.measure)] // m[0]
            _, low, high = next(limits[k, rule.name] for k in ((0, g, s), (1, g, None), (2, None, None))
                                if k[0] == 2 or limits[k, rule.name][0] >= quality.FEWEST)
            if v > high + rule.slack or rule.both_sides and v < low - rule.slack:
                broken.append(rule.name)
        out[i, g, s, *m, failed, tuple(broken), not failed and not broken] += 1
    return out


def check(spark, rows, *extra):
    df = clashing(spark.createDataFrame(rows, DOCS), *extra)
    got = Counter((*r[:9], tuple(r.broken), r.kept) for r in quality.judged(df).collect())
    assert got == plain_judged(rows)
    kept = Counter((r.doc_id, r.text) for r in quality.filtered(df).collect())
    verdict = {(r[0], *r[1:3]): r[-1] for r in got}
    assert kept == Counter((i, t) for i, t, g, s in rows if verdict[i, g, s])
    assert quality.filtered(df).columns == df.columns
    return got


def some_rows(n, seed):
    rng, rows = random.Random(seed), []
    for i in range(n):
        size = 40 if i % 50 == 7 else rng.choice([4, 5, 5, 6, 9])
        words = ["".join(rng.choice("abcdefghij") for _ in range(max(1, int(rng.gauss(size, 2))))) for _ in range(60 if size == 40 else rng.choice([0, 20, 60, 90]))]
        if rng.random() < 0.15:
            words = [w + rng.choice("#$%") for w in words]
        if rng.random() < 0.15:
            words = words[:15] * 6
        text = "".join(w + rng.choice([" ", " ", " ", "\n"]) for w in words)
        text += "\nThe same line." * rng.choice([0, 0, 0, 5])
        rows.append((i, text, rng.choice(["en", "en", "de", None]), rng.choice(["big", "big", "big", None, f"s{i % 7}"])))
    return rows


def test_equals_the_plain_version_in_all_group_sizes(spark):
    got = check(spark, some_rows(700, 2), "measured", "bounds", "_bounds", "n_words", "kept", "rule")
    assert {len(r[-2]) for r in got} >= {0, 1} and any("word_length" in r[-2] for r in got) and any("symbols" in r[-2] for r in got)


def test_edges(spark, odd_texts):
    rows = [(i, t, "en", None) for i, t in enumerate(odd_texts)] + [(None, "a b", None, "x")] * 2 + [(0, None, "", "")]
    check(spark, rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert quality.judged(df).count() == 0 and quality.filtered(df).count() == 0


def test_buckets(spark):
    numbers = [*range(2_000), *(2**k + d for k in range(8, 50) for d in (-1, 0, 1))]
    df = spark.createDataFrame([(n,) for n in numbers], "n long").withColumn("b", quality.bucket(F.col("n")))
    rows = df.withColumn("top", quality.largest_in(F.col("b"))).orderBy("n").collect()
    assert all(r.top == plain_bucket(r.n)[1] for r in rows)
    assert all(a.b <= b.b for a, b in zip(rows, rows[1:]))


def test_bounds_do_not_depend_on_the_partitions(spark):
    rows = some_rows(400, 8)
    look = lambda df: {r.doc_id: r.broken for r in quality.judged(df).collect()}
    df = spark.createDataFrame(rows, DOCS)
    assert look(df.repartition(1)) == look(df.repartition(23, "text"))


def test_most_labelled_documents_are_told_right(spark, folder):
    got = QUERIES["op13_quality_rules"](spark, folder).filter("NOT base_failed").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r.quality: r.kept for r in rows}
    assert share[1] > 0.97 and share[0] < 0.2
