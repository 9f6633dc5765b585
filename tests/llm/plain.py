"""Plain versions of the operators, for comparison."""

import re

LOWER = {i: i + 32 for i in range(65, 91)}


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def alnum(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def shingles(text, k=5):
    w = spaced(text)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def groups(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def document_rows(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def clashing(df, *names):
    """``df`` with extra columns of the given names."""
    from pyspark.sql import functions as F

    for name in names:
        df = df.withColumn(name, F.lit("extra"))
    return df
