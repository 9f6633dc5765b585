"""What keeps steps of a job from growing faster than their input: partitions that stay, blocks that follow the rows, no step per partition."""

import math

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators import cluster, lloyd, models, reco
from tillwork.plans import load_all, reco_q
from tillwork.plans.registry import QUERIES

ARGS = ("u", "i", "r")


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rated(spark):
    return spark.range(600).select((F.col("id") % 60).alias("u"), (F.col("id") % 7).alias("i"), (F.col("id") % 5 + 1).cast("double").alias("r"))


def test_ratings_stay_in_partitions_by_user(spark, rated, monkeypatch):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    stored = reco.ratings_by_user(rated, *ARGS)
    sums = stored.groupBy("u").agg(F.sum("r").alias("s"))
    assert "Exchange" not in plan(sums) and "Exchange" not in plan(stored.join(sums.hint("merge"), "u"))
    assert spark.conf.get("spark.sql.adaptive.enabled") == before
    monkeypatch.setattr(reco, "USER_RATINGS", 3)  # a user with more may not fill a partition
    heavy = reco.ratings_by_user(rated, *ARGS)
    assert "Exchange" in plan(heavy.groupBy("u").count())
    assert sorted(map(tuple, heavy.collect())) == sorted(map(tuple, stored.collect())) == sorted(map(tuple, rated.collect()))
    means = [{r["u"]: round(r["b_user"], 9) for r in reco.baselines(rated, *ARGS)[1].collect()}]
    monkeypatch.undo()
    means.append({r["u"]: round(r["b_user"], 9) for r in reco.baselines(rated, *ARGS)[1].collect()})
    assert means[0] == means[1]


def test_short_lists_are_not_ranked(rated):
    pairs = reco.item_similarities(rated, *ARGS)
    short, cut = (reco._fold_targets(rated, rated, pairs, *ARGS, "sim", k) for k in (7, 3))
    assert "Window" not in plan(short) and "Window" in plan(cut)
    assert {r["n"] for r in cut.collect()} == {3.0}
    whole = {(r["u"], r["i"]): round(r["s1"], 9) for r in reco._fold_targets(rated, rated, pairs, *ARGS, "sim", None).collect()}
    assert {(r["u"], r["i"]): round(r["s1"], 9) for r in short.collect()} == whole


def test_blocks_of_factors_follow_the_ratings(rated, monkeypatch):
    seen = []

    class Recorder:
        def __init__(self, **settings):
            seen.append(settings["numUserBlocks"])

        def fit(self, coded):
            return coded

    monkeypatch.setattr(reco, "ALS", Recorder)
    reco._als(rated)
    monkeypatch.setattr(reco, "BLOCK_RATINGS", 20)
    reco._als(rated)
    assert seen == [reco.BLOCKS, 30]


def test_implicit_model_reads_stored_ratings(spark, monkeypatch):
    load_all()
    given = []
    monkeypatch.setattr(reco_q.reco, "als_implicit", lambda long, *_: given.append(long) or long)
    QUERIES["als_implicit"](spark, "/root/testdata/sf0.001")
    assert "Join" not in plan(given[0]) and "parquet" not in plan(given[0])


def test_partitions_of_tree_models_are_bounded(spark):
    rows = spark.range(1000).coalesce(1)
    assert models.evened(rows, 1000).rdd.getNumPartitions() == 1
    spread = models.evened(rows, 100)
    assert max(r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()) <= 110
    assert spread.agg(F.sum("id")).first()[0] == 499500


def test_split_is_stored(spark):
    rows = spark.range(400).withColumn("x", F.col("id") * 2.0)
    train, check = models.prepare_training(rows, ["id"], 0.75)
    assert "Join" not in plan(train) and "Range" not in plan(check)
    assert (train.count(), check.count(), train.union(check).distinct().count()) == (300, 100, 400)


def test_rounds_read_all_partitions_at_once(spark, monkeypatch):
    def one_by_one(*_, **__):
        raise AssertionError("partitions are read one after another")

    monkeypatch.setattr(DataFrame, "toLocalIterator", one_by_one)
    rows = spark.range(80).select("id", F.array((F.col("id") % 2 * 10).cast("double"), (F.col("id") % 5).cast("double")).alias("v")).repartition(4)
    labelled, inertia = lloyd.kmeans(rows, "v", [2, 3])
    assert inertia[2] == pytest.approx(160.0) and inertia[3] < inertia[2]
    assert len({(r["id"] % 2, r["cluster_2"]) for r in labelled.collect()}) == 2


def test_silhouette_of_odd_vectors(spark):
    rows = [(1, "a", [0.0, 0.0]), (2, "a", [0.0, 2.0]), (3, "b", [5.0, 0.0]), (4, "b", [5.0, 1.0]), (5, "b", [None, 1.0]), (6, "b", None), (7, "c", [9.0, 9.0])]
    df = spark.createDataFrame(rows, "id long, label string, v array<double>")
    got = {r["id"]: r["silhouette"] for r in cluster.silhouette_squared(df, "id", "v", "label").collect()}
    moments = {(r["label"], r["i"]): (r["m"], r["q"], r["n"]) for r in cluster.cell_moments(df, "label", "v").collect()}
    assert moments["b", 0] == (5.0, 25.0, 3) and moments["b", 1] == (pytest.approx(2 / 3), pytest.approx(2 / 3), 3)
    assert got[5] == got[6] == got[7] == 0.0
    own, other = 2.0 * 2 / 1, 25.0 + 2 / 3  # row 1: twice the mean over its cluster with itself, mean over b
    assert math.isclose(got[1], (other - own) / other)
