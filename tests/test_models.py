"""Attribution, models, clusters and recommendations against direct computations."""

import datetime as dt

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tillwork.operators import attribution, bounded, cluster, factors, gram, metrics, models, neighbours, reco, search
from tillwork.plans import reco_q

D = dt.date


# ---- attribution -----------------------------------------------------------

@pytest.fixture(scope="module")
def mix(spark):
    rng = np.random.default_rng(5)
    rows = [(D(2024, 1, 1) + dt.timedelta(days=i // 2), "ab"[i % 2], *map(float, rng.random(3))) for i in range(20)]
    data = spark.createDataFrame(rows, "d date, g string, tv double, web double, price double")
    coef = spark.createDataFrame([("a", 0.5, 0.2, 0.3, 0.1), ("b", 0.4, 0.1, 0.6, 0.2)],
                                 "g string, beta_tv double, beta_web double, beta_price double, Intercept double")
    coef = coef.withColumn("e_intercept", F.exp("Intercept"))
    lin = F.col("Intercept") + F.col("beta_tv") * F.col("tv") + F.col("beta_web") * F.col("web") + F.col("beta_price") * F.col("price")
    avp = data.join(coef, "g").select("d", "g", (lin * 1.1).alias("actuals"), lin.alias("preds"))
    return data, coef, avp


def test_additive_attribution_adds_up(mix):
    data, coef, avp = mix
    out = attribution.additive_attribution(data, coef, avp, "d", ["tv", "web"], ["price"]).join(avp, ["d", "g"])
    gap = out.select(F.max(F.abs(F.col("base") + F.col("ac_tv") + F.col("ac_web") + F.col("ac_price") - F.col("actuals"))))
    assert gap.first()[0] < 1e-12 and out.count() == 20


def test_multiplicative_attribution_adds_up(mix):
    data, coef, avp = mix
    out = attribution.multiplicative_attribution(data, coef, avp, "d", ["tv", "web"], ["price"]).join(avp, ["d", "g"])
    total = F.col("base") + F.col("ac_tv") + F.col("ac_web") + F.col("ac_price")
    assert out.select(F.max(F.abs(total - F.exp("actuals")))).first()[0] < 1e-9


def test_price_attribution_adds_up(spark, mix):
    data = mix[0]
    beta = {"tv": 0.5, "web": 0.2, "price": -0.4}
    rand = spark.createDataFrame([("a", 0.1), ("b", -0.1)], "group_var string, beta double")
    out = attribution.attribution_without_baseline(data, "d", "g", beta, 0.3, ["price"])
    pieces = sum((F.col(f"`{c}`") for c in out.columns if "_contribution_" in c), F.lit(0.0))
    assert out.select(F.max(F.abs(pieces - F.col("Predicted_sales")))).first()[0] < 1e-9
    config = spark.createDataFrame([("tv", "mean"), ("web", "AS IS"), ("price", "1.5")], "Parameters string, Action string")
    out = attribution.attribution_with_baseline(data, "d", "g", beta, 0.3, config, rand)
    pieces = sum((F.col(f"`{c}`") for c in out.columns if "_contribution_" in c), F.lit(0.0))
    gap = F.col("Predicted_sales") - F.col("Predicted_baseline_sales") - pieces
    assert out.select(F.max(F.abs(gap))).first()[0] < 1e-9 and out.count() == 20
    assert not any("web" in c for c in out.columns)


def test_baseline_actions(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (9.0, 4.0)], "a double, b double")
    config = spark.createDataFrame([("a", "median"), ("b", "MODE")], "Parameters string, Action string")
    row = attribution.baseline_values(df, config, ["a", "b"]).first()
    assert (row["_base_a"], row["_base_b"]) == (2.0, 1.0)
    blank = spark.createDataFrame([("a", ""), ("b", None)], "Parameters string, Action string")
    assert tuple(attribution.baseline_values(df, blank, ["a", "b"]).first()) == (0.0, 0.0)
    with pytest.raises(ValueError):
        attribution.baseline_values(df, spark.createDataFrame([("a", "BOGUS")], "Parameters string, Action string"), ["a"])


def test_roas_rejects_bad_input(spark, mix):
    data, coef, avp = mix
    attr = attribution.additive_attribution(data, coef, avp, "d", ["tv", "web"], ["price"])
    mapping = spark.createDataFrame([("tv", "tv", "TV")], "variable_name string, variable_spend string, variable_description string")
    out = attribution.roas(data, attr, "year", mapping, "d")
    assert {r["period"] for r in out.collect()} == {"2024", "Overall"}
    with pytest.raises(ValueError):
        attribution.roas(data, attr, "week", mapping, "d")
    with pytest.raises(ValueError, match="number of rows"):
        attribution.roas(data.limit(3), attr, "year", mapping, "d")


# ---- linear models ---------------------------------------------------------

def test_ols_recovers_an_exact_plane(spark):
    rows = [(p, q, 7.5 - 1.25 * p + 0.5 * q) for p in (0.0, 4.0, 9.0) for q in (-2.0, 1.0, 6.0)]
    fit = models.ols(spark.createDataFrame(rows, "p double, q double, y double"), ["p", "q"], "y")
    assert np.allclose(fit.coefficients, [7.5, -1.25, 0.5])
    one = models.score_linear(spark.createDataFrame([(8.0, 12.0)], "p double, q double"), fit.as_dict(), fit.intercept)
    assert one.first()["yhat"] == pytest.approx(3.5)


@pytest.fixture(scope="module")
def regression(spark):
    rng = np.random.default_rng(2)
    n = 400
    x = rng.normal(size=(n, 3))
    g = rng.integers(0, 8, n)
    y = 5 + x @ [1.0, -2.0, 0.0] + g * 0.3 + rng.normal(size=n)
    pdf = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "g": g, "y": y})
    return spark.createDataFrame(pdf), pdf


def test_ols_matches_numpy(regression):
    df, pdf = regression
    fit = models.ols(df, ["a", "b", "c"], "y")
    x = np.column_stack([np.ones(len(pdf)), pdf[["a", "b", "c"]]])
    beta, *_ = np.linalg.lstsq(x, pdf["y"], rcond=None)
    s2 = ((pdf["y"] - x @ beta) ** 2).sum() / (len(pdf) - 4)
    se = np.sqrt(s2 * np.diag(np.linalg.inv(x.T @ x)))
    assert np.allclose(fit.coefficients, beta) and np.allclose(fit.std_errors, se)
    assert fit.p_values[1] < 1e-10 and 0 < fit.p_values[3] <= 1


def test_p_values_match_known_quantiles():
    # two-sided 5 % points of Student's t from the usual tables
    for freedom, t in ((1, 12.706), (5, 2.571), (30, 2.042), (1000, 1.962)):
        assert gram.t_p_value(t, freedom) == pytest.approx(0.05, abs=2e-4)


def test_spark_summary_agrees(regression):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    df, _ = regression
    fit = models.ols(df, ["a", "b", "c"], "y")
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    s = LinearRegression(labelCol="y", solver="normal").fit(rows).summary
    assert np.allclose(s.pValues[:3], fit.p_values[1:], atol=1e-8) and s.r2adj == pytest.approx(fit.r2_adj)


def test_penalised_solutions_are_optimal(regression):
    df, pdf = regression
    g = gram.collect_gram(df, ["a", "b", "c"], "y")
    ridge = gram.solve_ridge(g, 10.0)
    assert np.allclose(ridge, np.linalg.solve(g.sxx + 10.0 / g.n * np.eye(3), g.sxy))
    lasso = gram.solve_lasso(g, 0.3)
    gradient = g.sxy - g.sxx @ lasso
    assert np.all(np.abs(gradient) <= 0.3 + 1e-8) and np.allclose(gradient[lasso != 0], 0.3 * np.sign(lasso[lasso != 0]))
    assert np.all(gram.solve_ridge(g, 1.0, positive=True) >= 0)
    boxed = gram.solve_elastic_net(g, 0.5, 0.01, np.array([0.0, -1.5, 0.2]), np.array([0.5, 0.0, 1.0]))
    assert boxed[0] == 0.5 and boxed[1] == -1.5 and boxed[2] >= 0.2


def test_mixed_effects_match_a_plain_fit(regression):
    df, pdf = regression
    common, groups = models.linear_mixed_effects(df, ["a", "b"], "y", "g", ["a"])
    parts = [(np.column_stack([np.ones(len(g)), g["a"], g["b"]]), g["y"].to_numpy()) for _, g in pdf.groupby("g")]
    x, y = np.vstack([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    beta, d, s2 = np.linalg.lstsq(x, y, rcond=None)[0], np.eye(2), 1.0
    for _ in range(6000):
        u, m = [], []
        for xs, ys in parts:
            zs = xs[:, :2]
            cov = np.linalg.inv(zs.T @ zs / s2 + np.linalg.inv(d))
            m.append(cov)
            u.append(cov @ zs.T @ (ys - xs @ beta) / s2)
        rest = np.concatenate([ys - xs[:, :2] @ e for (xs, ys), e in zip(parts, u)])
        beta = np.linalg.lstsq(x, rest, rcond=None)[0]
        s2 = (((rest - x @ beta) ** 2).sum() + sum(np.trace(xs[:, :2].T @ xs[:, :2] @ c) for (xs, _), c in zip(parts, m))) / len(y)
        d = sum(np.outer(e, e) + c for e, c in zip(u, m)) / len(parts)
    assert np.allclose([common[c] for c in ("intercept", "a", "b")], beta, atol=1e-4)
    effects = {(r["g"], r["feature"]): r["effect"] for r in groups.collect()}
    assert len(effects) == 16
    assert all(abs(effects[g, c] - u[g][i]) < 1e-2 for g in range(8) for i, c in enumerate(("intercept", "a")))
    with pytest.raises(RuntimeError, match="did not settle"):
        models.linear_mixed_effects(df, ["a", "b"], "y", "g", ["a"], rounds=1)


def test_small_groups_are_fitted(spark):
    rows = [("big", float(i), 3.0 * i + 1) for i in range(20)] + [("two", 1.0, 5.0), ("two", 2.0, 9.0), ("one", 4.0, 7.0)]
    got = models.elastic_net_by_group(spark.createDataFrame(rows, "g string, x double, y double"), ["x"], "y", ["g"], 0.5, 0.1)
    fits = {(r["g"], r["feature"]): r["coefficient"] for r in got.collect()}
    assert {g for g, _ in fits} == {"big", "two", "one"}
    # half of the strength 0.1 is the absolute penalty, half the square one
    assert fits["two", "x"] == pytest.approx((4 * 0.25 - 0.05) / (0.25 + 0.05))
    assert fits["one", "x"] == 0 and fits["one", "intercept"] == 7


def test_shrinkage_lies_between_group_and_pool(regression):
    df, pdf = regression
    tight = {(r["g"], r["feature"]): r["posterior_mean"] for r in models.hierarchical_shrinkage(df, ["a"], "y", "g", 1e-4).collect()}
    pooled = models.ols(df, ["a"], "y")
    assert tight[(0, "a")] == pytest.approx(pooled.coefficients[1], abs=1e-3)
    loose = {(r["g"], r["feature"]): r["posterior_mean"] for r in models.hierarchical_shrinkage(df, ["a"], "y", "g", 1e4).collect()}
    own = models.ols(df.filter("g = 0"), ["a"], "y")
    assert loose[(0, "a")] == pytest.approx(own.coefficients[1], abs=1e-3)


def test_group_fit_scores_unknown_groups_null(spark, regression):
    df, _ = regression
    coef = models.elastic_net_by_group(df, ["a", "b"], "y", ["g"], 0.5, 0.0)
    new = spark.createDataFrame([(0.1, 0.2, 0), (0.1, 0.2, 99)], "a double, b double, g long")
    got = {r["g"]: r["yhat"] for r in models.score_by_group(new, coef, ["a", "b"], ["g"]).collect()}
    assert got[0] is not None and got[99] is None


def test_stepwise_signs(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    y = x @ [2.0, -1.5, 0.0] + rng.normal(size=300)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "good double, bad double, noise double, y double")
    assert models.stepwise(df, "y", ["bad", "noise"], ["good"], ["^bad"]).names == ["intercept", "good", "bad"]
    assert models.stepwise(df, "y", ["bad", "noise"], ["good"]).names == ["intercept", "good"]


def test_logit_matches_newton_steps(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 2))
    y = (rng.random(500) < 1 / (1 + np.exp(-(0.3 + x @ [1.0, -0.5])))).astype(int)
    df = spark.createDataFrame([(float(a), float(b), "yes" if c else "no") for (a, b), c in zip(x, y)], "a double, b double, t string")
    z, beta = np.column_stack([x, np.ones(500)]), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ beta))
        info = z.T @ (z * (p * (1 - p))[:, None])
        beta = beta + np.linalg.solve(info, z.T @ (y - p))
    got = {r["feature"]: (r["coefficient"], r["std_error"]) for r in models.logit(df, ["a", "b"], "t").collect()}
    want = dict(zip(("a", "b", "intercept"), zip(beta, np.sqrt(np.diag(np.linalg.inv(info))))))
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-4)


def test_logit_threshold(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "x double")
    assert [r["predicted"] for r in models.score_logit(df, {"x": 1.0}, 0.0).collect()] == [0, 1]  # 0.5 is not above
    with pytest.raises(ValueError, match="two classes"):
        models.logit(spark.createDataFrame([(1.0, 0), (2.0, 1), (3.0, 2)], "x double, y int"), ["x"], "y")


def test_regression_metrics_zero_actuals(spark):
    df = spark.createDataFrame([("t", 0.0, 1.0), ("t", 2.0, 1.0), ("t", None, 1.0)], "f string, y double, p double")
    r = metrics.regression_metrics(df, "y", "p", ["f"]).first()
    assert r["n"] == 2 and r["mape_finite"] == 0.5 and r["rmse"] == 1.0 and r["wmape"] == 1.0


def test_coefficient_matrix_adds_random_effects(spark):
    long = spark.createDataFrame([("Intercept", 1.0), ("x", 2.0), ("x|g[a]", 0.5), ("1|g[b]", -1.0)],
                                 "`feature names` string, `feature coefficients` double")
    groups = spark.createDataFrame([("a",), ("b",), ("b",)], "g string")
    assert values(models.coefficient_matrix(long, ["x", "w"], "Intercept", "g", groups)) == [
        ("a", 2.5, 0.0, 1.0, pytest.approx(np.e)), ("b", 2.0, 0.0, 0.0, 1.0)]


# ---- clusters --------------------------------------------------------------

def test_profile_of_uneven_clusters_and_flags_on_both_sides(spark):
    rows = [(12.0, None, "s"), (8.0, 1.0, "s"), (10.0, 2.0, "s"), (10.0, 9.0, "t"), (70.0, 3.0, None)]
    df = spark.createDataFrame(rows, "visits double, spend double, kind string")
    plain = values(cluster.cluster_profile(df, "kind", ["visits", "spend"], ratio=False), "feature", "cluster", "value", "overall")
    assert plain == [("spend", "s", 1.5, 4.0), ("spend", "t", 9.0, 4.0), ("visits", "s", 10.0, 10.0), ("visits", "t", 10.0, 10.0)]
    flags = values(cluster.cluster_profile(df, "kind", ["visits", "spend"]), "feature", "cluster", "flag")
    assert flags == [("spend", "s", "low"), ("spend", "t", "high"), ("visits", "s", ""), ("visits", "t", "")]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(7)
    centres = np.array([[0, 0], [8, 0], [0, 8], [8, 8]])
    x = np.concatenate([c + rng.normal(size=(75, 2)) for c in centres])
    labels = np.repeat(range(4), 75)
    df = spark.createDataFrame([(i, [float(a), float(b)], int(c)) for i, ((a, b), c) in enumerate(zip(x, labels))],
                               "id int, v array<double>, label int")
    return df, x, labels


def test_kmeans_peaks_at_four(blobs):
    table = cluster.kmeans_sweep(cluster.as_vectors(blobs[0], "v"), 2, 6)[0].toPandas()
    assert table.sort_values("silhouette").iloc[-1]["k"] == 4


@pytest.mark.parametrize("block", [64, 1000])
def test_silhouette_and_dunn_match_numpy(blobs, block):
    df, x, labels = blobs
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    want = []
    for i in range(len(x)):
        a = d[i, labels == labels[i]].sum() / 74
        b = min(d[i, labels == c].mean() for c in range(4) if c != labels[i])
        want.append((b - a) / max(a, b))
    got = cluster.silhouette_exact(df, "id", "v", "label", block).toPandas().sort_values("id")
    assert np.allclose(got["silhouette"], want)
    same = labels[:, None] == labels[None]
    r = cluster.dunn_index(df, "id", "v", "label", block_rows=block).first()
    assert r["dunn"] == pytest.approx(d[~same].min() / d[same].max())


def test_groups_of_points_meet_without_a_shuffle(blobs):
    pairs = cluster._block_pairs(blobs[0], "id", "v", "label", 16, lambda same, x, y: pd.DataFrame({"n": [len(x[0]) * len(y[0])]}), "n bigint")
    plan = pairs._jdf.queryExecution().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan.split("== Physical Plan ==")[1]
    rows = [r["n"] for r in pairs.collect()]
    assert len(rows) == 19 * 20 // 2 and sum(rows) > 300 * 300 / 2


def test_blocks_of_a_cell_are_sent_once(spark):
    points = spark.range(6).select(F.col("id").alias("b"), F.array(F.col("id").cast("double")).alias("points"), F.lit(1).cast("bigint").alias("n"))
    pairs = points.select(F.col("b").alias("a")).join(points.select("b")).filter("a < b")
    rows = cluster.balls._in_cells(pairs, points, 1).collect()
    assert sorted(r["a"] for r in rows if r["b"] is None) == list(range(6)) and sum(r["b"] is not None for r in rows) == 15
    for groups in (1, 2, 4):
        met = cluster.balls._in_cells(pairs, points, groups).mapInArrow(cluster.balls._meet(True), "best double")
        assert met.agg(F.max("best")).first()[0] == 5.0


def test_squares_by_a_product_are_those_of_plain_differences():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(300, 5)) + 1e3, rng.normal(size=(1100, 5)) + 1e3
    y[:40], y[40:80], x[7, 2], y[900, 0], y[901, 1] = x[:40], x[:40] + 1e-7, np.nan, np.inf, 1e200
    with np.errstate(all="ignore"):
        plain = ((x[:, None] - y[None]) ** 2).sum(-1)
    got = cluster.balls.squares(x, y)
    assert np.array_equal(np.isnan(got), np.isnan(plain)) and np.allclose(got, plain, rtol=1e-10, atol=0, equal_nan=True)
    assert all(got[i, i] == 0.0 for i in range(40) if i != 7)
    assert cluster.balls.squares(x[:0], y).shape == (0, 1100) and cluster.balls.squares(x, y[:0]).shape == (300, 0)


def test_cells_are_enough_for_all_tasks():
    assert cluster.balls._cell_groups(2_000, 2**17, 24) == 16  # by bytes
    for count, tasks in ((80, 24), (10, 2)):
        groups = cluster.balls._cell_groups(count, 2**10, tasks)
        assert tasks <= groups * (groups + 1) // 2 and groups <= count
    assert cluster.balls._cell_groups(1, 8, 24) == 1


def test_points_of_a_label_meet_in_a_product(spark, monkeypatch):
    rng = np.random.default_rng(4)
    v, lab = rng.normal(size=(400, 3)), np.array(["most"] * 380 + ["few"] * 19 + ["one"])
    df = spark.createDataFrame([(x.tolist(), c) for x, c in zip(v, lab.tolist())], "v array<double>, c string")
    monkeypatch.setattr(cluster.balls, "SUM_ROWS", 60)
    sums = cluster.balls.sums_within(cluster.balls.blocks_of(df, "v", "c", 16))
    assert "CartesianProduct" in sums._jdf.queryExecution().toString()
    got = {r["c"]: (r["total"], r["size"]) for r in sums.collect()}
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    assert got == {c: (pytest.approx(d[lab == c][:, lab == c].sum() / 2), (lab == c).sum()) for c in set(lab.tolist())}


def test_squared_silhouette_single_member(spark):
    df = spark.createDataFrame([(1, [0.0], 0), (2, [1.0], 0), (3, [9.0], 1)], "id int, v array<double>, label int")
    got = {r["id"]: r["silhouette"] for r in cluster.silhouette_squared(df, "id", "v", "label").collect()}
    assert got[3] == 0.0 and got[1] == pytest.approx((81 - 1) / 81)


def test_dunn_leaves_out_most_blocks_of_separate_clusters(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 4)) * 40
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(size=4)], i % 12) for i in range(3_000)]
    df = spark.createDataFrame(rows, "id int, v array<double>, label int")
    out, work = cluster.dunn_search(df, "id", "v", "label", block_rows=32)
    v, lab = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    d, same = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1)), lab[:, None] == lab[None]
    got = out.first()
    assert got["min_distance"] == pytest.approx(d[~same].min()) and got["max_diameter"] == pytest.approx(d[same].max())
    assert work["distance"][1] < 0.1 * work["distance"][0] and work["diameter"][1] <= work["diameter"][0]


def test_dunn_of_labels_that_share_points_one_label_and_none(spark):
    rows = [(1, [0.0, 0.0], "a"), (2, [0.0, 0.0], "b"), (3, [3.0, 4.0], "c"), (4, [3.0, 4.0], "c"), (5, None, "c"), (6, [1.0, 0.0], None)]
    df = spark.createDataFrame(rows, "id int, v array<double>, label string")
    got = cluster.dunn_index(df.dropna(), "id", "v", "label").first()
    assert (got["min_distance"], got["max_diameter"], got["dunn"]) == (5.0, 0.0, None)
    one = cluster.dunn_index(df.filter("label = 'c'"), "id", "v", "label").first()
    assert one["min_distance"] is None and one["max_diameter"] == 0.0
    assert cluster.dunn_index(df.limit(0), "id", "v", "label").first()["dunn"] is None


@pytest.mark.parametrize("method", ["raw", "scaled", "pca"])
def test_sweep_finds_planted_clusters_on_all_methods(spark, method):
    rng = np.random.default_rng(3)
    centres = np.array([[0, 0, 0], [9, 0, 0], [0, 9, 0], [0, 0, 900]])
    rows = [(i, [float(x) for x in (centres[i % 4] + rng.normal(size=3)) * [1, 1, 1]], i % 4) for i in range(400)]
    df = spark.createDataFrame([*rows, (999, None, 0)], "id int, v array<double>, truth int")
    scores, labelled = cluster.cluster_sweep(df, "id", "v", 2, 4, method, exact=True)
    got = {r["k"]: (r["inertia"], r["silhouette"]) for r in scores.collect()}
    assert got[2][0] >= got[3][0] >= got[4][0] > 0 and all(-1 <= s <= 1 for _, s in got.values())
    found = labelled.filter("v IS NOT NULL").groupBy("cluster_4", "truth").count().collect()
    assert (len(found) == 4) or method == "pca"  # one component explains nearly all variance
    assert [r["cluster_4"] for r in labelled.filter("id = 999").collect()] == [None]
    x, lab = np.array([r[1] for r in rows]), np.array([r["cluster_3"] for r in labelled.filter("v IS NOT NULL").orderBy("id").collect()])
    if method == "raw":
        assert got[3][0] == pytest.approx(sum(((x[lab == c] - x[lab == c].mean(0)) ** 2).sum() for c in range(3)), rel=1e-6)
    with pytest.raises(ValueError):
        cluster.cluster_sweep(df, "id", "v", 2, 3, "polar")


def test_pca_needs_two_components(spark):
    df = cluster.as_vectors(spark.createDataFrame([([float(i), 2.0 * i],) for i in range(10)], "v array<double>"), "v")
    with pytest.raises(ValueError):
        cluster.pca_reduce(df, 0.95)


# ---- bounds ------------------------------------------------------------------

def test_box_minimum_meets_its_conditions_and_beats_other_points():
    rng = np.random.default_rng(1)
    root = rng.normal(size=(50, 3, 3))
    a, r = root @ root.transpose(0, 2, 1) + np.eye(3) * 0.1, rng.normal(size=(50, 3)) * 3
    low, high = np.full((50, 3), -0.3), np.tile([0.4, np.inf, 0.4], (50, 1))
    u = bounded.box_minimum(a, r, low, high)
    assert bounded.violation(a, r, u, low, high).max() < 1e-9 and ((u == low) | (u == high)).any()
    cost = lambda v: 0.5 * np.einsum("gi,gij,gj->g", v, a, v) - (r * v).sum(1)
    for _ in range(200):
        assert (cost(np.clip(u + rng.normal(size=u.shape) * 0.2, low, high)) >= cost(u) - 1e-9).all()
    assert bounded.violation(a, r, u + 0.01, low, high).min() > 0


def test_box_moments_equal_those_of_draws():
    rng = np.random.default_rng(4)
    mean, cov = np.array([[0.2, -0.5]]), np.array([[[1.0, 0.6], [0.6, 2.0]]])
    draws = rng.multivariate_normal(mean[0], cov[0], 2_000_000)
    for low, high, near in (([0.5, -np.inf], [1.0, np.inf], 0.005), ([0.0, 0.0], [np.inf, 1.0], 0.03), ([-np.inf, -np.inf], [-2.0, np.inf], 0.02)):
        kept = draws[((draws >= low) & (draws <= high)).all(axis=1)]
        m, c = bounded.box_moments(mean, cov, np.array([low]), np.array([high]))
        assert np.abs(m[0] - kept.mean(0)).max() < near and np.abs(c[0] - np.cov(kept.T)).max() < 4 * near
    m, v = bounded.cut_moments(np.array([0.0, 60.0, -60.0]), np.ones(3), np.array([-np.inf, -1.0, 0.0]), np.array([np.inf, 1.0, 2.0]))
    assert m.tolist() == pytest.approx([0.0, 1.0, 0.0], abs=0.02) and v[0] == 1.0 and (v[1:] < 1e-3).all()


def test_bounded_mixed_effects_and_posteriors(spark):
    rng = np.random.default_rng(9)
    slopes = {g: 1 + 0.8 * rng.normal() for g in "abcdefgh"}
    rows = [(g, float(x), float(2 + b * x + 0.3 * rng.normal())) for g, b in slopes.items() for x in rng.normal(size=60)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    table = models.linear_mixed_effects(df, ["x"], "y", "g", ["x"], box={"x": (0.7, 1.2)})[1].collect()
    total = {r["g"]: r["coefficient"] for r in table if r["feature"] == "x"}
    assert all(0.7 - 1e-12 <= v <= 1.2 + 1e-12 for v in total.values()) and max(r["violation"] for r in table) < 1e-6
    assert {g for g, v in total.items() if abs(v - 1.2) < 1e-9} >= {g for g, b in slopes.items() if b > 1.5}
    cut = {(r["g"], r["feature"]): r for r in models.hierarchical_shrinkage(df, ["x"], "y", "g", 5.0, bounds={"x": (0.7, 1.2)}).collect()}
    assert all(0.7 <= r["posterior_mean"] <= 1.2 for (g, c), r in cut.items() if c == "x")
    free = {(r["g"], r["feature"]): r for r in models.hierarchical_shrinkage(df, ["x"], "y", "g", 5.0).collect()}
    assert all(r["posterior_sd"] <= free[k]["posterior_sd"] * (1 + 1e-9) for k, r in cut.items())


# ---- recommendation --------------------------------------------------------

@pytest.fixture(scope="module")
def tastes(spark):
    rng = np.random.default_rng(11)
    rows = []
    for u in range(300):
        if u < 100:  # a third of the users share one vector
            rows += [(u, 1, 2.0), (u, 2, 1.0)]
            continue
        for i in rng.choice(20, rng.integers(1, 8), replace=False):
            rows.append((u, int(i), float(rng.integers(1, 6))))
    return spark.createDataFrame(rows, "u int, i int, value double"), pd.DataFrame(rows, columns=["u", "i", "r"])


@pytest.mark.parametrize("pivots, cell", [(1, 4096), (16, 32), (64, 4096)])
def test_user_neighbours_are_exact(tastes, pivots, cell):
    df, pdf = tastes
    m = pdf.pivot(index="u", columns="i", values="r").fillna(0)
    x = m.to_numpy() / np.linalg.norm(m.to_numpy(), axis=1, keepdims=True)
    s = np.round(x @ x.T, 9)
    got = reco.user_neighbours(df, "u", "i", k=5, pivots=pivots, cell_rows=cell).toPandas().sort_values(["u", "rank"])
    for at, u in enumerate(m.index):
        order = sorted(range(len(m)), key=lambda j: (-s[at, j], m.index[j]))[:5]
        assert got[got.u == u]["neighbour"].tolist() == [m.index[j] for j in order]


def nearest(rows, k):
    m = pd.DataFrame(rows, columns=["u", "i", "r"]).pivot(index="u", columns="i", values="r").fillna(0).sort_index()
    x = m.to_numpy() / np.linalg.norm(m.to_numpy(), axis=1, keepdims=True)
    s = np.round(x @ x.T, 9) + 0.0
    return {u: [m.index[j] for j in sorted(range(len(m)), key=lambda j: (-s[at, j], m.index[j]))[:k]] for at, u in enumerate(m.index)}


def neighbour_lists(table):
    out = {}
    for r in table.orderBy("u", "rank").collect():
        out.setdefault(r["u"], []).append(r["neighbour"])
    return out


def test_few_pairs_are_examined_on_long_tailed_items(spark):
    rng = np.random.default_rng(3)
    rows = sorted({(int(u), int(min(5_000, rng.zipf(1.3)))) for u in range(1_500) for _ in range(12)})
    rows = [(u, i, float(rng.integers(1, 4))) for u, i in rows]
    near, work = reco.neighbour_search(spark.createDataFrame(rows, "u int, i int, value double"), "u", "i", k=3, cell_rows=256)
    assert neighbour_lists(near) == nearest(rows, 3)
    total = work.agg({"examined": "sum", "users": "sum"}).first()
    assert total["sum(users)"] == 1_500 and total["sum(examined)"] < 0.35 * 1_500**2


def test_lonely_users_get_the_smallest_ids_and_negative_values_are_exact(spark):
    rows = [(5, 1, 1.0), (6, 2, 1.0), (7, 3, 2.0), (8, 3, 1.0), (9, 4, 1.0), (10, 4, 1.0), (10, 5, 0.0), (11, 6, None)]
    near = reco.user_neighbours(spark.createDataFrame(rows, "u int, i int, value double"), "u", "i", k=3)
    assert neighbour_lists(near) == {5: [5, 6, 7], 6: [6, 5, 7], 7: [7, 8, 5], 8: [7, 8, 5], 9: [9, 10, 5], 10: [9, 10, 5]}
    rng = np.random.default_rng(8)
    mixed = [(int(u), int(i), float(rng.choice([-2, -1, 1, 2]))) for u in range(80) for i in rng.choice(30, 5, replace=False)]
    df = spark.createDataFrame(mixed, "u int, i int, value double")
    assert neighbour_lists(reco.user_neighbours(df, "u", "i", k=12, cell_rows=16)) == nearest(mixed, 12)
    assert reco.user_neighbours(df.limit(0), "u", "i").count() == 0


def test_a_vector_is_sent_once_for_a_block_and_not_for_each_of_its_lists(spark):
    classes = spark.range(4_000).selectExpr("id AS c", "transform(sequence(0, 19), j -> (id * 7 + j * 13) % 500) AS i")
    classes = classes.selectExpr("c", "array_sort(i) AS i", "array_repeat(1 / sqrt(20d), 20) AS x", "0.1d AS bound")
    met = neighbours._classes_meet(classes, "bigint", 64)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "BroadcastExchange" not in plan
    asked = met.groupBy("b").agg(F.count("*").alias("n"), F.first("sizes").alias("sizes"), F.first("names").alias("names")).collect()
    assert sorted(c for r in asked for c in r["names"]) == list(range(4_000))  # every vector stands in one block
    assert all(r["n"] == len(asked) and len(r["sizes"]) == 4 * len(r["names"]) for r in asked)


def test_blocks_are_sorted_once_and_come_once_to_a_task(spark):
    classes = spark.range(4_000).selectExpr("id AS c", "transform(sequence(0, 9), j -> id % 50 + j * 61) AS i")
    classes = classes.selectExpr("c", "i", "array_repeat(1 / sqrt(10d), 10) AS x", "0.1d AS bound")
    met = neighbours._classes_meet(classes, "bigint", 64)
    rows = met.select("b", "n_2", "names", *neighbours.FLAT).collect()
    tasks = {}
    for r in rows:
        tasks.setdefault(r["b"], []).append(r["n_2"])
    assert all(0 < sum(n == 0 for n in met_by) < len(met_by) for met_by in tasks.values())
    r = rows[0]
    given, found = (neighbours.Lists(pa.array(r["names"]), *(bytes(r[c]) for c in flat)) for flat in (neighbours.FLAT, neighbours.FLAT[:3]))
    assert len(r["items"]) == 4 * len(given.x) and (given.order == found.order).all() and (given.place[1:] >= given.place[:-1]).all()
    assert (given.items == np.unique(given.item)).all() and given.count.sum() == len(given.item)


@pytest.mark.parametrize("terms, sparse_cost", [(2**21, 40), (500, 40), (2**21, 10**9), (2**21, 0)])
def test_blocks_find_the_nearest_in_every_way(monkeypatch, terms, sparse_cost):
    monkeypatch.setattr(neighbours, "TERMS", terms)
    monkeypatch.setattr(neighbours, "SPARSE_COST", sparse_cost)
    rng = np.random.default_rng(5)
    for hot in (0, 3):  # with items that nearly all have, heads are short
        x = rng.integers(1, 4, (300, 400)) * (rng.random((300, 400)) < 0.02)
        x[:, 397:] = 5 * rng.integers(0, 2, (300, 3)) * (hot > 0)
        x[np.arange(300), rng.integers(0, 390, 300)] = 30 if hot else 2
        x = x / np.linalg.norm(x, axis=1, keepdims=True)

        def block(rows):
            r, i = np.nonzero(x[rows])
            return neighbours.Lists(pa.array(rows), np.bincount(r, minlength=len(rows)).astype(np.int32).tobytes(), i.tobytes(), x[rows][r, i].tobytes())

        parts = np.array_split(np.arange(300), 3)
        near = neighbours.Nearest(block(parts[1]), np.zeros(100), 4, 9, False)
        for p in parts:
            near.meet(block(p))
        row, s, names = near.best()
        want = np.round(x[parts[1]] @ x.T, 9)
        for u in range(100):
            order = [j for j in sorted(range(300), key=lambda j: (-want[u, j], j))[:4] if want[u, j] > 0]
            assert names.to_numpy()[row == u].tolist() == order and np.allclose(s[row == u], want[u, order], atol=2e-9)
            assert len(order) <= near.examined[u] <= 300


def test_users_meet_blocks_of_items_without_broadcasts(spark):
    people = spark.range(40).selectExpr("id AS u", "array(1.0d) AS v", "1.0d AS length", "array(1L) AS had", "0.0d AS last")
    blocks = spark.range(6).selectExpr("id AS b", "array(id) AS items")
    met = factors._meetings(people, blocks, 5, 2, 4)
    rows = met.selectExpr("size(users) AS n", "items[0] AS b").collect()
    assert len(rows) == 10 and sum(r["n"] for r in rows) == 80 and {r["b"] for r in rows} == {2, 3}
    plan = met._jdf.queryExecution().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan


def test_best_products_equal_all_pairs_and_stop_early(spark):
    rng = np.random.default_rng(5)
    people, things = rng.normal(size=(120, 6)), rng.normal(size=(900, 6)) * rng.pareto(1.5, (900, 1))
    seen = sorted({(int(u), int(i)) for u, i in zip(rng.integers(0, 120, 2_000), rng.integers(0, 900, 2_000))})
    top = np.argsort(-np.linalg.norm(things, axis=1))
    seen += [(7, int(i)) for i in top[:300] if (7, int(i)) not in seen]
    users = spark.createDataFrame([(u, v.tolist()) for u, v in enumerate(people)] + [(500, None)], "u int, v array<double>")
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(things)], "i int, v array<double>")
    for had in (None, seen):
        got, work = factors.best_products(users, items, "u", "i", "v", 5, had and spark.createDataFrame(had, "u int, i int"), item_rows=32, user_rows=50)
        lists = {}
        for r in got.orderBy("u", "rank").collect():
            lists.setdefault(r["u"], []).append(r["i"])
        s = people @ things.T
        for u, i in had or ():
            s[u, i] = -np.inf
        assert lists == {u: np.lexsort((np.arange(900), -s[u]))[:5].tolist() for u in range(120)}
        read = work.agg({"blocks": "avg", "n_blocks": "max", "u": "count"}).first()
        assert read["count(u)"] == 120 and read["avg(blocks)"] < 0.5 * read["max(n_blocks)"] == 14.5
    assert factors.best_products(users.limit(0), items, "u", "i", "v", 5)[0].count() == 0
    assert factors.best_products(users, items.limit(3), "u", "i", "v", 5)[0].count() == 360


def test_biased_factors_learn_a_planted_model(spark):
    rng = np.random.default_rng(2)
    p, q = rng.normal(size=(150, 2)), rng.normal(size=(40, 2))
    rows = [(f"u{u}", int(i), float(3 + 0.5 * p[u] @ q[i] + rng.normal() * 0.1)) for u in range(150) for i in rng.choice(40, 25, replace=False)]
    cut = [r for k, r in enumerate(rows) if k % 5], [r for k, r in enumerate(rows) if not k % 5]
    train, test = (spark.createDataFrame(c, "u string, i int, r double") for c in cut)
    model = factors.biased_factors(train, "u", "i", "r", rank=4, epochs=40, rate=0.05, reg=0.02, blocks=3)
    again = factors.biased_factors(train.repartition(5), "u", "i", "r", rank=4, epochs=2, rate=0.05, blocks=3)[1]
    other = factors.biased_factors(train.repartition(2), "u", "i", "r", rank=4, epochs=2, rate=0.05, blocks=3)[1]
    assert again.join(other, ["u", "bias"]).count() == 150
    error = lambda df: df.selectExpr("sqrt(avg((r - prediction) * (r - prediction))) AS e").first()["e"]
    assert error(factors.predict_factors(test, model, "u", "i")) < 0.5 * error(reco.predict_baseline(test, reco.baselines(train, "u", "i", "r"), "u", "i"))
    new = spark.createDataFrame([("nobody", 1, 0.0), (None, None, 0.0)], "u string, i int, r double")
    assert [r["prediction"] is not None for r in factors.predict_factors(new, model, "u", "i").collect()] == [True, True]
    with pytest.raises(ValueError):
        factors.biased_factors(train.limit(0), "u", "i", "r")


def test_factors_keep_one_turn_and_write_a_file_for_a_block(spark, monkeypatch):
    train = spark.createDataFrame([(u, i, float(u * i % 5)) for u in range(60) for i in range(8)], "u int, i int, r double")
    tables, plain = [], factors.written

    def kept(*args):
        alive = [t for t in tables if spark._jvm.java.io.File(t.inputFiles()[0].removeprefix("file:")).exists()]
        out = plain(*args)
        files = out.inputFiles()
        rows = out.count()
        assert rows == len(files) and len(alive) <= 2  # the cells and the state before
        tables.append(out)
        return out

    monkeypatch.setattr(factors, "written", kept)
    model = factors.biased_factors(train, "u", "i", "r", rank=2, epochs=2, blocks=3)
    assert len(tables) == 8 and model[1].count() == 60 and model[2].count() == 8
    assert not any(spark._jvm.java.io.File(t.inputFiles()[0].removeprefix("file:")).exists() for t in tables)


def test_estimated_size_of_factors_does_not_grow_with_the_turns(spark):
    train = spark.createDataFrame([(u, i, float(u * i % 5)) for u in range(20) for i in range(8)], "u int, i int, r double")
    sizes = []
    for epochs in (1, 4):
        users = factors.biased_factors(train, "u", "i", "r", rank=2, epochs=epochs, blocks=2)[1]
        sizes.append(int(users._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert sizes[1] < 100 * sizes[0]


@pytest.mark.parametrize("block", [7, 1024])
def test_item_pairs_of_folds_equal_those_of_each_training_part(tastes, block):
    df = tastes[0].withColumn("fold", F.pmod(F.xxhash64("u", "i"), F.lit(3)))
    rows = reco.item_pairs(df, "u", "i", "value", block, fold="fold", folds=3).collect()
    got = {(r["fold"], r["i"], r["j"]): tuple(r[c] for c in ("n", "si", "sj", "sii", "sjj", "sij")) for r in rows}
    wanted = {(k, r["i"], r["j"]): tuple(r[c] for c in ("n", "si", "sj", "sii", "sjj", "sij"))
              for k in range(3) for r in reco.item_pairs(df.filter(F.col("fold") != k), "u", "i", "value", block).collect()}
    assert len(rows) == len(got) and set(got) == set(wanted)
    assert all(got[k] == pytest.approx(wanted[k], abs=1e-9) for k in wanted)


def test_models_are_compared_on_shared_pairs(tastes, monkeypatch):
    calls = []
    plain = reco.item_pairs
    monkeypatch.setattr(reco, "item_pairs", lambda *a, **b: calls.append(1) or plain(*a, **b))
    names = ("slopeone", "knnbasic", "knnwithmeans", "baselineonly")
    shared = {r["model"]: (r["rmse"], r["mae"]) for r in reco.compare_models(tastes[0], "u", "i", "value", names, 2).collect()}
    assert len(calls) == 1
    folded = tastes[0].withColumn("_fold", F.pmod(reco.hash_prefix(reco.hash_order(["u", "i"], 42), 6), F.lit(2)))
    for name in names:
        scores = [reco.regression_metrics(reco.fit_predict(name, folded.filter(F.col("_fold") != k).drop("_fold"), folded.filter(
            F.col("_fold") == k).drop("_fold"), "u", "i", "value"), "value", "prediction").first() for k in range(2)]
        assert shared[name] == pytest.approx((sum(m["rmse"] for m in scores) / 2, sum(m["mae"] for m in scores) / 2))


def test_query_compares_all_models_over_three_folds(spark, monkeypatch):
    own = spark.createDataFrame([(u, f"b{i}", float(u * i % 5)) for u in range(40) for i in range(6)], "o_custkey int, p_brand string, rating double")
    met = []

    def constant(model, train, test, *args, **known):
        met.append((model, train.count(), test.count(), train.join(test, ["o_custkey", "p_brand"]).count()))
        return test.withColumn("prediction", F.lit(2.0))

    monkeypatch.setattr(reco_q, "all_ratings", lambda spark, d: own)
    monkeypatch.setattr(reco, "fit_predict", constant)
    assert reco_q.reco_compare(spark, None).count() == len(reco.MODELS)
    for model in reco.MODELS:
        folds = [m[1:] for m in met if m[0] == model]
        assert len(folds) == 3 and sum(test for _, test, _ in folds) == 240
        assert all(train + test == 240 and test and not shared for train, test, shared in folds)


def test_compared_models_share_ratings_in_partitions_by_user(tastes, monkeypatch):
    plans = []

    def constant(model, train, test, *args, **known):
        plans.append(train.groupBy("u").agg(F.avg("value")).join(test, "u")._jdf.queryExecution().executedPlan().toString())
        return test.withColumn("prediction", F.lit(2.0))

    monkeypatch.setattr(reco, "fit_predict", constant)
    monkeypatch.setattr(reco.F, "broadcast", lambda df: df)
    assert reco.compare_models(tastes[0], "u", "i", "value", ("svd",)).count() == 1
    assert len(plans) == 3 and not any("Exchange hashpartitioning" in p for p in plans)


def test_neighbour_scores_marks_bought(spark):
    long = spark.createDataFrame([(1, "a", 1.0), (2, "a", 1.0), (2, "b", 3.0)], "u int, i string, value double")
    near = spark.createDataFrame([(1, 1), (1, 2)], "u int, neighbour int")
    got = {r["i"]: r["score"] for r in reco.neighbour_scores(long, near, "u", "i", k=2).collect()}
    assert got == {"a": -1.0, "b": 1.5}


def test_item_pairs_match_brute_force(tastes):
    df, pdf = tastes
    got = reco.item_pairs(df, "u", "i", "value", block=7).toPandas().sort_values(["i", "j"]).reset_index(drop=True)
    both = pdf.merge(pdf, on="u")
    both = both[both.i_x != both.i_y]
    both["p"] = both.r_x * both.r_y
    want = both.groupby(["i_x", "i_y"]).agg(n=("u", "count"), si=("r_x", "sum"), sj=("r_y", "sum"), sij=("p", "sum")).reset_index()
    assert len(got) == len(want)
    assert np.allclose(got[["i", "j", "n", "si", "sj", "sij"]], want[["i_x", "i_y", "n", "si", "sj", "sij"]])


@pytest.mark.parametrize("user_based", [False, True])
@pytest.mark.parametrize("variant", ["basic", "means", "zscore"])
def test_knn_matches_a_plain_loop(tastes, variant, user_based):
    df, pdf = tastes
    train = pdf[(pdf.u + pdf.i) % 5 != 0]
    test = df.filter("(u + i) % 5 = 0").select("u", "i")
    got = reco.item_knn(df.filter("(u + i) % 5 <> 0"), test, "u", "i", "value", variant, k=3, user_based=user_based).toPandas()
    own, other = ("u", "i") if user_based else ("i", "u")
    table = train.pivot_table(index=own, columns=other, values="r")
    mean, spread = table.mean(axis=1), table.std(axis=1, ddof=0).replace(0, 1)
    for row in got.itertuples():
        a, b = (row.u, row.i) if user_based else (row.i, row.u)
        sims = []
        if a in table.index and b in table.columns:
            for n in table.index[table[b].notna()]:
                both = table.loc[[a, n]].dropna(axis=1)
                if n != a and both.shape[1]:
                    sims.append((1 / (1 + ((both.loc[a] - both.loc[n]) ** 2).mean()), n))
        sims = sorted(sims, key=lambda s: (-round(s[0], 12), s[1]))[:3]
        shift = {"basic": lambda n: 0.0}.get(variant, lambda n: mean[n])
        scale = (lambda n: spread[n]) if variant == "zscore" else (lambda n: 1.0)
        gain = sum(s * (table.loc[n, b] - shift(n)) / scale(n) for s, n in sims) / sum(s for s, _ in sims) if sims else None
        if variant == "basic":
            want = train.r.mean() if gain is None else gain
        else:
            want = (mean[a] if a in mean.index else train.r.mean()) + (0 if gain is None else gain * (scale(a) if a in mean.index else 1))
        assert row.prediction == pytest.approx(want), (row, sims)


def test_slope_one_matches_a_plain_loop(tastes):
    df, pdf = tastes
    rows = pdf[(pdf.u + pdf.i) % 4 != 0]
    train = rows.groupby(["u", "i"]).r.mean().unstack()
    got = reco.slope_one(df.filter("(u + i) % 4 <> 0"), df.filter("(u + i) % 4 = 0").select("u", "i"), "u", "i", "value").toPandas()
    for row in got.itertuples():
        if row.u not in train.index:
            assert row.prediction == pytest.approx(rows.r.mean())
            continue
        mine = train.loc[row.u].dropna()
        devs = [] if row.i not in train.columns else [
            d for j in mine.index if j != row.i and not np.isnan(d := (train[row.i] - train[j]).mean())]
        assert row.prediction == pytest.approx(mine.mean() + (np.mean(devs) if devs else 0))


def test_every_named_model_predicts(tastes):
    df = tastes[0]
    train, test = df.filter("(u + i) % 4 <> 0"), df.filter("(u + i) % 4 = 0")
    for name in reco.MODELS:
        out = reco.fit_predict(name, train, test, "u", "i", "value", (1.0, 5.0))
        bad = out.filter(F.col("prediction").isNull() | ~F.col("prediction").between(1, 5)).count()
        assert bad == 0 and out.count() == test.count(), name
    with pytest.raises(ValueError):
        reco.fit_predict("other", train, test, "u", "i", "value")


def test_implicit_skips_seen(tastes):
    df = tastes[0]
    top = reco.als_implicit(df, "u", "i", "value", 3, rank=4, max_iter=3)
    assert top.join(df, ["u", "i"], "left_semi").count() == 0
    assert top.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 3").count() == 0


def test_unseen_items_complete(tastes):
    df, pdf = tastes
    got = reco.unseen_items(df.select("u"), df, df.select("i"), "u", "i")
    assert got.count() == pdf.u.nunique() * pdf.i.nunique() - len(pdf)


def test_map_at_k(spark):
    rec = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "a", 1)], "u int, i string, rank int")
    rel = spark.createDataFrame([(1, "a"), (1, "c"), (1, "z"), (2, "q")], "u int, i string")
    r = metrics.map_at_k(rec, rel, "u", "i", "rank", 3).first()
    assert r["n_users"] == 2 and r["map_at_k"] == pytest.approx(((1 + 2 / 3) / 3 + 0) / 2)


def test_rescale_round_trip(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (9.0,)], "r double")
    out = reco.rescale_inverse(reco.rescale(df, "r", 0, 1, "s"), "s", 0, 1, "back")
    assert [(r["s"], r["back"]) for r in out.orderBy("r").collect()] == [(0.0, 1.0), (0.25, 3.0), (1.0, 9.0)]


# ---- model search --------------------------------------------------------------

def test_halving_keeps_the_better_settings_and_uses_all_rows_in_the_end(spark):
    rng = np.random.default_rng(12)
    rows = [(i, float(a) if i % 6 else None, float(b), float(3 * a - 2 * b + rng.normal() * 0.1) if i % 50 else None) for i, (a, b) in enumerate(rng.normal(size=(900, 2)) + 5)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y double")
    train, check = df.filter("id % 4 > 0"), df.filter("id % 4 = 0")
    grid = search.settings_grid(("drop", "zero", "mean"), (0.01, 1.0), (2,), (3,))
    out = search.halving_search(train, check, ["a", "b"], "y", ["id"], grid).orderBy("rank").collect()
    assert len(out) == len(grid) == 39 and [r["rank"] for r in out] == list(range(1, 40))
    assert [sum(r["round"] == k for r in out) for k in (1, 2, 3)] == [26, 9, 4]
    assert out[0]["rows"] == train.dropna(subset=["y"]).count() > 2 * out[-1]["rows"] and out[0]["round"] == 3
    assert out[0]["fill"] != "zero" and all(x["rmse"] <= y["rmse"] for x, y in zip(out, out[1:]) if x["round"] == y["round"])


def test_errors_from_moments_equal_those_of_scored_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, *map(float, rng.normal(size=2)), float(rng.normal() + i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y double")
    g, against = gram.collect_gram(df.filter("id < 200"), ["a", "b"], "y"), gram.collect_gram(df.filter("id >= 200"), ["a", "b"], "y")
    for s in search.settings_grid(("drop",), (0.05,), (), ()):
        w = search._linear(g, s)
        x = np.array([r[1:3] for r in rows[200:]])
        miss = np.array([r[3] for r in rows[200:]]) - x @ w - g.intercept(w)
        assert search._error(against, w, g.intercept(w)) == pytest.approx(float(np.sqrt((miss**2).mean())))
    assert np.allclose(search._linear(g, search.Setting("linear", "drop")), gram.solve_ols(g).coefficients[1:])
