"""Both paths of the order-dependent primitives agree, also with a hot group."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import values
from tillwork.functions.hashing import hash_order
from tillwork.operators import metrics, ordered


@pytest.fixture(scope="module")
def hot(spark):
    """Two thirds of the rows in group 'a', many ties, some NULLs."""
    rng = np.random.default_rng(3)
    g = np.where(rng.random(3000) < 0.66, "a", rng.choice(list("bcdef"), 3000))
    x = np.round(rng.normal(size=3000), 1)
    pdf = pd.DataFrame({"id": range(3000), "g": g, "x": x, "y": rng.random(3000) * 1000})
    pdf.loc[pdf.id % 11 == 0, "x"] = np.nan
    return spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x"))), pdf


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_match_numpy(hot, limit, by):
    df, pdf = hot
    probs = [0, 0.013, 0.25, 0.5, 0.9, 1]
    got = {tuple(r[b] for b in by) + (r["column"],): r["q"]
           for r in ordered.quantile_table(df, ["x", "y"], probs, by, limit=limit).collect()}
    groups = pdf.groupby("g") if by else [((), pdf)]
    for key, part in groups:
        for c in ("x", "y"):
            want = part[c].dropna().quantile(probs).to_numpy()
            name = (key, c) if by else (c,)
            assert np.allclose(got[name], want, atol=1e-9)


def test_narrowed_quantiles_on_many_rows(spark):
    df = spark.range(200_000).select((F.xxhash64("id") % 50_000).cast("double").alias("v"))
    want = df.toPandas()["v"].quantile([0.001, 0.3, 0.5, 0.95]).tolist()
    found = ordered._narrowed_quantiles(df, ["v"], [0.001, 0.3, 0.5, 0.95], 0)
    assert found is not None and np.allclose(found["v"], want)


def test_quantiles_of_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    for limit in (None, 0):
        rows = ordered.quantile_table(df, ["x"], [0.5], limit=limit).collect()
        assert all(r["q"] is None or r["q"][0] is None for r in rows)


@pytest.mark.parametrize("limit", [None, 0])
def test_dense_ids(spark, limit):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "k string")
    assert values(ordered.dense_ids(df, ["k"], limit=limit)) == [("a", 0), ("b", 1), ("c", 2)]


def test_running_before_paths_agree(hot):
    df, _ = hot
    counts = ordered.value_counts(df, "x", ["g"])
    small = ordered.running_before(counts, ["g"], ["x"], ["n"])
    large = ordered.running_before(counts, ["g"], ["x"], ["n"], limit=0)
    cols = ["g", "x", "n", "n_before", "n_total"]
    assert values(small, *cols) == values(large, *cols)


def test_auc_paths_agree(hot):
    df, _ = hot
    rows = df.withColumn("t", (F.col("id") % 3 == 0).cast("int"))
    a, b = (metrics.auc(rows, "t", "x", limit).first()[0] for limit in (None, 0))
    assert a == pytest.approx(b)


@pytest.mark.parametrize("digits", [1, 4])
def test_take_by_hash_is_the_exact_rank(hot, digits):
    df, _ = hot
    takes = {"few": F.floor(F.col("n") * 0.1), "more": F.floor(F.col("n") * 0.35), "none": F.lit(0), "all": F.lit(10**9)}
    got = ordered.take_by_hash(df, ["id"], 5, takes, ["g"], digits).select("id", "g", *takes).toPandas()
    order = df.select("id", hash_order(["id"], 5).alias("h")).toPandas()
    both = got.merge(order, on="id").sort_values(["h", "id"])
    both["rank"] = both.groupby("g").cumcount() + 1
    n = both.groupby("g")["id"].transform("count")
    assert len(got) == 3000 and not got["none"].any() and got["all"].all()
    assert (both["few"] == (both["rank"] <= np.floor(n * 0.1))).all()
    assert (both["more"] == (both["rank"] <= np.floor(n * 0.35))).all()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=30), st.floats(0, 1))
def test_split_sizes_are_exact(spark, groups, share):
    df = spark.createDataFrame(list(enumerate(groups)), "id long, g long")
    out = ordered.take_by_hash(df, ["id"], 1, {"t": F.floor(F.lit(share) * F.col("n"))}, ["g"])
    got = {r["g"]: r["k"] for r in out.groupBy("g").agg(F.count(F.when(F.col("t"), 1)).alias("k")).collect()}
    for g in set(groups):
        assert got[g] == int(np.floor(share * groups.count(g)))


def test_first_per_key_keeps_one_row(spark):
    df = spark.createDataFrame([(1, 2), (1, 1), (2, 5)], "k int, o int")
    assert values(ordered.first_per_key(df, ["k"], [F.col("o")])) == [(1, 1), (2, 5)]


@pytest.mark.parametrize("by", [[], ["g"]])
def test_series_in_blocks_equal_whole_series(spark, monkeypatch, by):
    from tillwork.operators import timeseries

    rng = np.random.default_rng(9)
    rows = [(g, int(t), float(rng.integers(0, 9)), None if rng.random() < 0.2 else float(rng.random())) for g in ("ab" if by else "a") for t in range(230)]
    df = spark.createDataFrame(rows, "g string, t int, x double, y double")
    df = df if by else df.drop("g")
    monkeypatch.setattr(ordered.series_blocks, "__defaults__", (0, 0, None, 25))
    runs = [
        lambda limit: timeseries.create_lag(df, "t", [1, 3, 7], by, limit=limit),
        lambda limit: timeseries.create_adstock(df, "t", [2.0, 30.0], by, columns=["x"], max_memory=5, limit=limit),
        lambda limit: timeseries.create_adstock(df, "t", [2.0, 30.0], by, columns=["x"], limit=limit),
        lambda limit: timeseries.rolling_mean(df, ["x"], "t", 6, "append", by, limit=limit),
        lambda limit: timeseries.decompose(df, "x", "t", "additive", 8, by, limit=limit),
        lambda limit: timeseries.rolling_origin_folds(df, "t", by, 3, 1, 5, 4, limit=limit)]
    for run in runs:
        whole, cut = (run(limit).toPandas() for limit in (True, False))
        keys = [*by, "t", *(["fold"] if "fold" in whole.columns else [])]
        whole, cut = (x.sort_values(keys).reset_index(drop=True) for x in (whole, cut))
        assert list(whole.columns) == list(cut.columns) and len(whole) == len(cut)
        pd.testing.assert_frame_equal(whole, cut, check_exact=False, rtol=1e-9)
    x = rng.random(200)
    last, want = 0.0, []
    for v in x:
        last = v + 0.7 * last
        want.append(last)
    assert np.allclose(timeseries.decayed_sums(x, 0.7), want)
    assert np.isnan(timeseries.decayed_sums(np.array([1.0, np.nan, 2.0]), 0.5)).tolist() == [False, True, True]
