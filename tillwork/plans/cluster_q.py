"""Clustering queries on the embedding table."""

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators import cluster

from .eda_q import rounded
from .registry import query, table


@query(
    "cluster_profile",
    " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, c_mktsegment AS cluster, round(avg({f}) / o, 8) AS value, round(o, 6) AS overall,
          CASE WHEN avg({f}) / o < 0.98 THEN 'low' WHEN avg({f}) / o > 1.02 THEN 'high' ELSE '' END AS flag
        FROM customer, (SELECT avg({f}) AS o FROM customer) GROUP BY c_mktsegment, o""" for f in ("c_acctbal", "c_nationkey")),
)
def cluster_profile(spark, d):
    out = cluster.cluster_profile(table(spark, d, "customer"), "c_mktsegment", ["c_acctbal", "c_nationkey"], low=0.98, high=1.02)
    return rounded(rounded(out, 8, "value"), 6, "overall")


@query(
    "cluster_means",
    """WITH e AS (SELECT label, embedding[1]::DOUBLE AS x1, embedding[2]::DOUBLE AS x2 FROM embeddings)
    SELECT 'x1' AS feature, label AS cluster, round(avg(x1), 8) AS value, round((SELECT avg(x1) FROM e), 8) AS overall FROM e GROUP BY label
    UNION ALL SELECT 'x2', label, round(avg(x2), 8), round((SELECT avg(x2) FROM e), 8) FROM e GROUP BY label""",
)
def cluster_means(spark, d):
    rows = table(spark, d, "embeddings").select(
        "label", F.col("embedding")[0].cast("double").alias("x1"), F.col("embedding")[1].cast("double").alias("x2"))
    return rounded(cluster.cluster_profile(rows, "label", ["x1", "x2"], ratio=False).drop("flag"), 8, "value", "overall")


def vectors(spark, d):
    return cluster.as_vectors(table(spark, d, "embeddings"), "embedding")


@query("kmeans_sweep")
def kmeans_sweep(spark, d):
    return cluster.kmeans_sweep(vectors(spark, d).cache(), 2, 4)[0]


@query("kmeans_labels")
def kmeans_labels(spark, d):
    labelled = cluster.kmeans_sweep(vectors(spark, d), 3, 3)[1][3]
    return labelled.select("vec_id", "label", "cluster")


@query("pca_reduce")
def pca_reduce(spark, d):
    return cluster.pca_reduce(vectors(spark, d), 0.95)[1]


SQL_DIST = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    p AS (SELECT a.vec_id AS k, a.label AS own, b.label AS c, list_distance(a.v, b.v) AS d FROM e a JOIN e b ON a.vec_id <> b.vec_id)"""


@query(
    "silhouette_exact",
    f"""WITH {SQL_DIST}, m AS (SELECT k, own, c, avg(d) AS d, count(*) AS n FROM p GROUP BY ALL),
      s AS (SELECT k, own, max(d) FILTER (WHERE c = own) AS a, min(d) FILTER (WHERE c <> own) AS b FROM m GROUP BY ALL)
    SELECT k AS vec_id, own AS label, round(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END, 8) AS silhouette FROM s""",
)
def silhouette_exact(spark, d):
    return rounded(cluster.silhouette_exact(table(spark, d, "embeddings"), "vec_id", "embedding", "label", 256), 8, "silhouette")


@query(
    "silhouette_squared",
    f"""WITH {SQL_DIST}, m AS (SELECT k, own, c, avg(d * d) AS d FROM p GROUP BY ALL),
      s AS (SELECT k, own, max(d) FILTER (WHERE c = own) AS a, min(d) FILTER (WHERE c <> own) AS b FROM m GROUP BY ALL)
    SELECT k AS vec_id, own AS label, round(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END, 8) AS silhouette FROM s""",
)
def silhouette_squared(spark, d):
    return rounded(cluster.silhouette_squared(table(spark, d, "embeddings"), "vec_id", "embedding", "label"), 8, "silhouette")


def _dunn_sql(width):
    return f"""WITH {SQL_DIST}, w AS (SELECT own, max(d) AS far, sum(d) / 2 / (SELECT count(*) FROM e WHERE label = own) AS mean
        FROM p WHERE own = c GROUP BY 1),
      t AS (SELECT (SELECT min(d) FROM p WHERE own <> c AND d > 0) AS lo, (SELECT max({width}) FROM w) AS hi)
    SELECT round(lo, 8) AS min_distance, round(hi, 6) AS max_diameter, round(lo / hi, 8) AS dunn FROM t"""


def _dunn(spark, d, width):
    out = cluster.dunn_index(table(spark, d, "embeddings"), "vec_id", "embedding", "label", width, block_rows=256)
    return rounded(rounded(out, 8, "min_distance", "dunn"), 6, "max_diameter")


@query("dunn_index", _dunn_sql("far"))
def dunn_index(spark, d):
    return _dunn(spark, d, "farthest")


@query("dunn_mean_cluster", _dunn_sql("mean"))
def dunn_mean_cluster(spark, d):
    return _dunn(spark, d, "mean_cluster")


@query("cluster_sweep", """SELECT method, CAST(k AS INTEGER) AS k, (SELECT count(*) FROM embeddings) AS points, true AS whole, true AS inertia_is_of_labels,
    true AS no_worse_than_one_less FROM (SELECT unnest(['raw', 'scaled', 'pca']) AS method), (SELECT unnest([2, 3, 4, 5]) AS k)""")
def cluster_sweep(spark, d):
    """K-means on raw, scaled and reduced vectors: every point has a cluster of each k, and the inertia is at least that of the
    clusters' own means (equal where vectors are raw), and falls with k up to the chance of the first centres."""
    rows, out = table(spark, d, "embeddings").select("vec_id", "embedding"), None
    for method in ("raw", "scaled", "pca"):
        scores, labelled = cluster.cluster_sweep(rows, "vec_id", "embedding", 2, 5, method)
        long = labelled.select("vec_id", F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"cluster_{k}").alias("c")) for k in range(2, 6)])))
        cells = [cluster.cell_moments(labelled, f"cluster_{k}", "embedding").withColumn("k", F.lit(k)) for k in range(2, 6)]
        around = functools.reduce(DataFrame.unionByName, cells).groupBy("k").agg(F.sum((F.col("q") - F.col("m") * F.col("m")) * F.col("n")).alias("around"))
        sizes = long.groupBy("k").agg(F.count("*").alias("points"), F.every((F.col("c") >= 0) & (F.col("c") < F.col("k"))).alias("whole"))
        found = scores.join(around, "k").join(sizes, "k")
        before = found.select((F.col("k") + 1).alias("k"), F.col("inertia").alias("before"))
        fits = F.abs(F.col("inertia") - F.col("around")) <= 1e-3 * F.col("around") if method == "raw" else F.col("inertia") > 0
        found = found.join(before, "k", "left").select(
            "method", "k", "points", "whole", fits.alias("inertia_is_of_labels"),
            (F.col("before").isNull() | (F.col("inertia") <= 1.05 * F.col("before"))).alias("no_worse_than_one_less"))
        out = found if out is None else out.unionByName(found)
    return out
