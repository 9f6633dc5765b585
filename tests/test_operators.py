"""Fixed samples and edge cases: NULL, empty, single row, ties, zero denominators."""

import datetime as dt
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tillwork.functions import dates, numeric, text
from tillwork.operators import calendar, clean, eda, fitted, joins, prep, quality, reshape, roi, smoothing, split, timeseries
from tillwork.session import scratch_path
from tillwork.sources import catalog, files

D = dt.date


# ---- functions -------------------------------------------------------------

def test_missing_numbers(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (-float("inf"),), (1.5,), (None,)], "x double")
    assert values(clean.finite_numbers(df)) == sorted([(None,)] * 4 + [(1.5,)], key=repr)


def test_zero_denominators(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (1.0, 2.0)], "a double, b double")
    got = df.select(numeric.divide("a", "b").alias("d"), numeric.divide_or_zero("a", "b").alias("z")).collect()
    assert [tuple(r) for r in got] == [(None, 0.0), (None, 0.0), (0.5, 0.5)]


def test_clean_text(spark):
    df = spark.createDataFrame([("  a \t b\x07 ",), ("NA",), ("   ",), (None,)], "s string")
    assert [r[0] for r in df.select(text.clean_text("s")).collect()] == ["a b", None, None, None]


def test_snake_names():
    assert [text.snake_name(n) for n in ("MemorySize", "Order No", "SKU", "Ext_Color", "a--b")] == [
        "memory_size", "order_no", "sku", "ext_color", "a_b"]


def test_week_label_is_monday_first(spark):
    days = [D(2019, 1, 1) + dt.timedelta(days=i) for i in range(0, 2600)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(dates.week_label("d")).collect()]
    assert got == [d.strftime("%W") for d in days]


def test_roll_to_weekday(spark):
    df = spark.createDataFrame([(D(2024, 1, 7),), (D(2024, 1, 8),), (None,)], "d date")  # a Sunday, a Monday
    sunday = [r[0] for r in df.select(dates.roll_to_weekday("d")).collect()]
    monday = [r[0] for r in df.select(dates.roll_to_weekday("d", 0)).collect()]
    assert sunday == [D(2024, 1, 7), D(2024, 1, 14), None] and monday == [D(2024, 1, 8), D(2024, 1, 8), None]


# ---- sources ---------------------------------------------------------------

def test_catalog(spark):
    base = scratch_path(spark, "cat")
    conf = {"raw": {"part": {"format": "parquet", "uri": base + "/p_{n}.parquet"}}, "out": {"x": {"format": "csv", "uri": base + "/x.csv"}}}
    for n in (1, 2):
        catalog.save_dataset(spark.createDataFrame([(n, "v")], "a int, b string"), conf, "raw/part", n=n)
    catalog.save_dataset(spark.createDataFrame([(9,)], "z int"), conf, "raw/part", n=3)
    assert catalog.list_datasets(conf) == ["raw/part", "out/x"] and catalog.list_datasets(conf, "out") == ["out/x"]
    assert values(catalog.load_dataset(spark, conf, "raw/part", n="[12]")) == [(1, "v"), (2, "v")]
    with pytest.raises(ValueError, match="columns"):
        catalog.load_dataset(spark, conf, "raw/part", n="*")
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert catalog.load_dataset(spark, conf, "raw/part", skip=True, n="*", extra=1).count() == 2
    assert any("unused" in str(w.message) for w in seen) and any("left out" in str(w.message) for w in seen)
    with pytest.raises(ValueError, match="missing"):
        catalog.load_dataset(spark, conf, "raw/part")
    with pytest.raises(KeyError):
        catalog.load_dataset(spark, conf, "raw/none")
    with pytest.raises(NotImplementedError):
        files.load_data(spark, "x.xlsx")


def test_fingerprint_ignores_order(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    other = spark.createDataFrame([(1, ""), (2, "x")], "a int, b string")
    one = files.table_fingerprint(df).first()
    assert one == files.table_fingerprint(df.orderBy(F.desc("a"))).first()
    assert one != files.table_fingerprint(other).first()


# ---- cleaning and joins ----------------------------------------------------

def test_clean_product(spark):
    df = spark.createDataFrame([(" A1 ", "red", None, 2), ("A1", "blue", "x", 1), ("B2", "", "green", 3)],
                               "SKU string, color string, Ext_Color string, rank int")
    out = clean.clean_product_table(df, "SKU", [F.col("rank")], {"color": ["color", "Ext_Color"]})
    assert values(out, "sku", "color") == [("A1", "blue"), ("B2", "green")]


def test_change_type_and_dates(spark):
    df = spark.createDataFrame([("1", "31/12/2020"), ("x", "2020-12-31"), (None, None)], "q string, d string")
    out = clean.parse_dates(clean.change_type(df, ["q"], "bigint"), "d")
    assert [tuple(r) for r in out.collect()] == [(1, D(2020, 12, 31)), (None, None), (None, None)]


def test_dedup_with_null_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, o int")
    assert values(clean.remove_duplicates(df, ["k"], ["o"])) == sorted([(None, 1), (1, 3)], key=repr)
    assert values(clean.remove_duplicates(df, ["k"], ["o"], "last")) == sorted([(None, 2), (1, 3)], key=repr)


def test_column_filters(spark):
    df = spark.createDataFrame([(1, 0.0, 5, "a", None), (2, 0.0, 5, "a", None)], "id int, z double, c int, s string, n int")
    assert clean.drop_constant(df).columns == ["id", "s", "n"]
    assert clean.drop_constant(df, numeric=False).columns == ["id"]
    assert clean.drop_all_zero(df).columns == ["id", "c", "s", "n"]
    assert clean.find_columns(df, "S", case_sensitive=False) == ["s"]
    with pytest.warns(UserWarning):
        assert clean.log_columns(df, ["nope"]).columns == df.columns


def test_segregate_projects_numbers(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (2, None, "y")], "id int, v double, c string")
    parts = clean.segregate(df, "v", ["id"], ["c"], with_measure=False)
    assert parts["numeric"].columns == ["id", "v"] and values(parts["category"]) == [(2, "y")]


def test_residual_flags(spark):
    df = spark.createDataFrame([(100.0, 140.0), (100.0, 60.0), (100.0, 110.0), (0.0, 1.0)], "y double, p double")
    got = [(r["residual_flag"], r["residual"]) for r in clean.residual_flags(df, "y", "p", error="pe").collect()]
    assert got == [("OverPrediction", 0.4), ("UnderPrediction", 0.4), ("Others", 0.1), ("OverPrediction", None)]


def test_sets(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (None, "z")], "k int, t string")
    b = spark.createDataFrame([(2, "y"), (3, "x")], "k int, t string")
    got = {r["region"]: r["n"] for r in joins.set_analyse(a, b).collect()}
    assert got == {"A-B": 1, "B-A": 1, "A^B": 1, "AuB": 3}
    assert got["AuB"] == got["A-B"] + got["B-A"] + got["A^B"]
    assert values(joins.set_analyse(a, b, ["k"], simplify=False, exceptions_only=True), "k", "region") == [(1, "A-B"), (3, "B-A")]


def test_merge_expectations_sees_left_nulls(spark):
    a = spark.createDataFrame([(1,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (2,)], "id long")
    r = joins.merge_expectations(a, b, [("k", "id")], "left").first()
    assert r["nulls_warning"] and not r["types_match"] and r["warn_b_minus_a"] and not r["warn_a_minus_b"]


def test_dimension_join(spark):
    fact = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    dim = spark.createDataFrame([(1, "one"), (None, "none")], "k int, n string")
    assert values(joins.join_dimension(fact, dim, "k", "left"), "v", "n") == [("a", "one"), ("b", None), ("c", None)]
    assert values(joins.join_dimension(fact, dim, "k", "left", null_matches=True), "v", "n") == [("a", "one"), ("b", "none"), ("c", None)]
    with pytest.raises(ValueError, match="unique"):
        joins.join_dimension(fact, dim.union(dim), "k", validate=True)


def test_orphans_of_empty_fact(spark):
    fact = spark.createDataFrame([], "k int")
    r = joins.orphan_impact(fact, spark.createDataFrame([(1,)], "k int"), "k").first()
    assert tuple(r) == (0, 0, 0, None)


# ---- quality and statistics ------------------------------------------------

def test_rules(spark):
    df = spark.createDataFrame([(2, 3.0, 6.0), (2, 3.0, 7.0), (None, 3.0, 1.0)], "q int, c double, t double")
    rules = {"total": quality.equal_rounded(F.col("q") * F.col("c"), F.col("t"))}
    assert values(quality.check_rules(df, rules, {"q": "int", "c": "int"})) == sorted(
        [("total", 2, 1, False), ("q is int", 3, 0, True), ("c is int", 3, 3, False)], key=repr)


def test_outlier_table_counts_infinities(spark):
    df = spark.createDataFrame([(float(i),) for i in range(20)] + [(1000.0,), (float("inf"),), (None,)], "x double")
    assert tuple(quality.outlier_table(df, ["x"]).first()) == ("x", 1, 1, 1)


def test_duplicate_columns(spark):
    df = spark.createDataFrame([(1, 5, 5, 5), (2, None, None, 0)], "id int, a int, b int, c int")
    assert values(quality.duplicate_columns(df, ["id"])) == [("b", "a")]


def test_statistics_of_constant_column(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(5)], "c double, x double")
    assert eda.correlation_table(df, ["c", "x"]).first()["corr"] is None


def test_woe_skips_one_sided_levels(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("b", 1), (None, 0)], "g string, y int")
    got = {r["g"]: (r["woe"], r["iv"]) for r in eda.woe_table(df, "g", "y").collect()}
    assert got["b"] == (None, None) and got["a"][0] == pytest.approx(np.log(2))
    one = eda.information_value(df, ["g"], "y").first()["iv"]
    assert one == pytest.approx(0.5 * np.log(2))


def test_correlation_ratio_bounds(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 3.0), (None, 9.0)], "g string, y double")
    assert eda.correlation_ratio(df, "g", "y").first()[0] == pytest.approx(1.0)
    assert eda.correlation_ratio(df.filter("g = 'a'"), "g", "y").first()[0] == 0.0


def test_vif_prune_drops_the_copy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2))
    rows = [(float(a), float(b), float(a + b + e)) for (a, b), e in zip(x, rng.normal(size=200) * 0.01)]
    kept, log = eda.vif_prune(spark.createDataFrame(rows, "a double, b double, s double"), ["a", "b", "s"])
    assert len(kept) == 2 and log.filter("dropped_at = 1").count() == 1


def test_series_gaps(spark):
    rows = [(1, dt.datetime(2024, 1, 1)), (1, dt.datetime(2024, 1, 4)), (2, dt.datetime(2024, 1, 1))]
    got = eda.series_gaps(spark.createDataFrame(rows, "id int, ts timestamp"), "ts", ["id"])
    assert values(got) == [(1, dt.datetime(2024, 1, 2)), (1, dt.datetime(2024, 1, 3))]


def test_optimal_visits(spark):
    seg = spark.createDataFrame([("a", 10.0, 0.5, 1.0), ("b", 1e9, 1.0, 1.0)], "g string, coefficient double, margin double, cost double")
    got = {r["g"]: (r["step"], r["visits"]) for r in roi.optimal_visits(seg, "g", lambda n: F.ln(1.0 + n)).collect()}
    want = next(i for i in range(200) if 5 * (np.log(i + 3) - np.log(i + 2)) < 1)
    assert got["a"] == (want, want + 1) and abs(got["b"][1] - 1e9) < 1e5


# ---- reshaping -------------------------------------------------------------

def test_spend_activity_and_cost(spark):
    data = spark.createDataFrame([(D(2024, 1, 1), "n", 10.0, 4.0, 1.0), (D(2024, 1, 1), "n", 20.0, 2.0, None)],
                                 "d date, grp string, sp double, cl double, rate double")
    mapping = spark.createDataFrame(
        [("sp", "TV", "Tele", "Spend", "Sum", "sp"), ("cl", "TV", "Tele", "GRP", "Sum", "sp"), ("rate", "TV", "Tele", "Rate", "Mean", "sp")],
        "variable_name string, variable_activity_root string, variable_description string, variable_category string, aggregation_type string, variable_spend string")
    long = reshape.spend_activity(data, mapping, "d", "grp")
    assert values(long, "Spend", "activity_type", "Activity") == [(30.0, "GRP", 6.0), (30.0, "Rate", 1.0)]
    cost = reshape.cost_per_activity(long, "d", "TELE", "grp")
    assert values(cost, "cost_per_act") == [(5.0,)]


# ---- time series -----------------------------------------------------------

def series(spark, xs, g="a"):
    return spark.createDataFrame([(g, D(2024, 1, 1) + dt.timedelta(days=i), x) for i, x in enumerate(xs)], "g string, d date, x double")


def column(df, name="x"):
    return [r[name] for r in df.orderBy("d").collect()]


def test_lag_back_fills(spark):
    out = timeseries.create_lag(series(spark, [1.0, None, 3.0, 4.0]), "d", [1], ["g"], "_lag")
    assert column(out, "x_1_lag") == [1.0, 1.0, 3.0, 3.0]


def test_adstock_finite_equals_infinite_with_enough_memory(spark):
    df = series(spark, [5.0, 0.0, 2.0, 7.0, 1.0])
    finite = column(timeseries.create_adstock(df, "d", [2], ["g"], max_memory=5), "x_2")
    infinite = column(timeseries.create_adstock(df, "d", [2], ["g"]), "x_2")
    assert np.allclose(finite, infinite)


def test_rolling_modes(spark):
    df = series(spark, [1.0, 2.0, 3.0, None, 5.0])
    assert column(timeseries.rolling_mean(df, ["x"], "d", 2, "keep", ["g"])) == [None, 1.5, 2.5, None, None]
    assert column(timeseries.rolling_mean(df, ["x"], "d", 2, "drop", ["g"])) == [1.5, 2.5]
    assert column(timeseries.rolling_mean(df, ["x"], "d", 2, "append", ["g"])) == [1.0, 1.5, 2.5]
    with pytest.raises(ValueError):
        timeseries.rolling_mean(df, ["x"], "d", 2, "other")


def test_fills(spark):
    df = series(spark, [None, 1.0, None, 4.0, None])
    assert column(timeseries.fill_forward(df, ["x"], "d", ["g"])) == [None, 1.0, 1.0, 4.0, 4.0]
    assert column(timeseries.fill_backward(df, ["x"], "d", ["g"])) == [1.0, 1.0, 4.0, 4.0, None]
    assert column(timeseries.interpolate(df, ["x"], "d", ["g"])) == [1.0, 1.0, 2.5, 4.0, 4.0]
    assert column(timeseries.interpolate(series(spark, [None, None]), ["x"], "d", ["g"])) == [None, None]


def test_fills_across_chunks(spark):
    rng = np.random.default_rng(4)
    rows = [("ab"[i % 3 == 0], i, float(i) if rng.random() < 0.2 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, d int, x double").repartition(5)
    for fill in (timeseries.fill_forward, timeseries.fill_backward, timeseries.interpolate):
        for by in ([], ["g"]):
            assert values(fill(df, ["x"], "d", by)) == values(fill(df, ["x"], "d", by, limit=0))


@pytest.mark.parametrize("period", [3, 4])
def test_decomposition_is_centred(spark, period):
    rng = np.random.default_rng(1)
    xs = [float(10 + i * 0.1 + (i % period) + rng.random()) for i in range(40)]
    add = column(timeseries.decompose(series(spark, xs), "x", "d", "additive", period, ["g"]), "seasonal")
    mul = column(timeseries.decompose(series(spark, xs), "x", "d", "multiplicative", period, ["g"]), "seasonal")
    assert np.mean(add[:period]) == pytest.approx(0) and np.mean(mul[:period]) == pytest.approx(1)
    assert add[:period] == add[period:2 * period]


def test_customer_history_with_ties(spark):
    rows = [(1, D(2024, 1, 1), 10), (1, D(2024, 1, 1), 11), (1, D(2024, 1, 5), 12), (2, D(2024, 2, 1), 13), (None, D(2024, 1, 1), 14)]
    out = timeseries.customer_history(spark.createDataFrame(rows, "c int, d date, k int"), "c", "d", "k")
    got = {r["k"]: (r["first_time_customer"], r["days_since_last_purchase"]) for r in out.collect()}
    assert got == {10: (1, 0), 11: (1, 0), 12: (0, 4), 13: (1, 0), 14: (0, 0)}


def test_trend_and_season_arguments(spark):
    df = series(spark, [1.0] * 10)
    assert column(timeseries.linear_trend(df, "d", "Day"), "trend") == list(range(1, 11))
    weekly = column(timeseries.linear_trend(df, "d", "Week"), "trend")
    assert weekly[6] == 1 and weekly.count(None) == 9  # 2024-01-07 is a Sunday
    with pytest.raises(ValueError):
        timeseries.linear_trend(df, "d", "Hour")
    with pytest.raises(ValueError):
        timeseries.seasonal_index(df, "x", "d", thresholds=[1.0])


def test_folds(spark):
    out = timeseries.rolling_origin_folds(series(spark, [1.0] * 20), "d", ["g"], n_splits=2, gap=1, n_test=3, stride=2)
    got = {(r["fold"], r["role"]): r["n"] for r in out.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {(0, "test"): 3, (0, "train"): 16, (1, "test"): 3, (1, "train"): 14}


def test_smoothing_tracks_a_line(spark):
    out = timeseries.smoothing_backtest(series(spark, [float(i) for i in range(60)]), "d", "x", ["g"], ("trend",), n_splits=1, n_test=5)
    assert out.first()["rmse"] < 1e-6


def plain_smooth(x, kind, alpha, beta, gamma, period, horizon):
    level, slope, season = x[0], (x[1] - x[0] if kind != "simple" else 0.0), [0.0] * period
    if kind == "seasonal" and len(x) >= 2 * period:
        level = sum(x[:period]) / period
        slope = (sum(x[period : 2 * period]) / period - level) / period
        season = [v - level for v in x[:period]]
    for t, v in enumerate(x[1:] if kind != "seasonal" else x):
        s = season[t % period] if kind == "seasonal" else 0.0
        before, level = level, alpha * (v - s) + (1 - alpha) * (level + slope)
        if kind != "simple":
            slope = beta * (level - before) + (1 - beta) * slope
        if kind == "seasonal":
            season[t % period] = gamma * (v - level) + (1 - gamma) * s
    return [level + slope * k + (season[(len(x) + k - 1) % period] if kind == "seasonal" else 0.0) for k in range(1, horizon + 1)]


@pytest.mark.parametrize("chunk, n", [(7, 61), (100_000, 61), (10, 21)])
def test_smoothing_by_chunks_equals_the_recursion(spark, chunk, n):
    import random

    rng = random.Random(n)
    x = [rng.gauss(10, 3) + t % 5 for t in range(n)]
    settings = [(0.3, 0.1, 0.1), (0.9, 0.5, 0.2)]
    out = smoothing.backtest_grid(series(spark, [*x, None]), "d", "x", ["g"], {k: settings for k in smoothing.KINDS}, period=5, chunk=chunk,
                                  n_splits=3, gap=1, n_test=6, stride=4)
    got = {(r["model"], r["fold"], r["alpha"]): (r["rmse"], r["mae"], r["mape"]) for r in out.collect()}
    assert len(got) == sum(n - 4 * k - 7 >= 2 for k in range(3)) * 6
    for (kind, fold, alpha), found in got.items():
        cut = n - 4 * fold - 6
        test, beta, gamma = x[cut : cut + 6], *next(s[1:] for s in settings if s[0] == alpha)
        miss = [a - b for a, b in zip(test, plain_smooth(x[: cut - 1], kind, alpha, beta, gamma, 5, 7)[1:])]
        wanted = ((sum(m * m for m in miss) / 6) ** 0.5, sum(map(abs, miss)) / 6, sum(abs(m / v) for m, v in zip(miss, test)) / 6)
        assert found == pytest.approx(wanted)


def test_smoothing_search_finds_the_setting_that_made_the_series(spark):
    x, level = [], 0.0
    for t in range(80):
        level = 0.0 if t < 40 else 10.0
        x.append(level)
    best = timeseries.smoothing_search(series(spark, x), "d", "x", ["g"], ("simple", "trend"), (0.1, 0.9), n_splits=2, n_test=8).collect()
    assert {(r["model"], r["alpha"], r["gamma"]) for r in best} >= {("simple", 0.9, None)} and all(r["n_folds"] == 2 for r in best)
    assert timeseries.smoothing_search(series(spark, [1.0, 2.0]), "d", "x", ["g"]).count() == 0
    with pytest.raises(ValueError):
        smoothing.backtest_grid(series(spark, x), "d", "x", ["g"], {"cubic": [(0.1, 0.1, 0.1)]})


def test_holidays_by_week(spark):
    df = spark.createDataFrame([(D(2024, 1, 7),), (D(2024, 1, 14),)], "d date")
    hol = spark.createDataFrame([("2024-01-08",), ("2024-01-10",)], "h string")
    assert values(calendar.add_holidays(df, hol, "d", "h", "Week").orderBy("d")) == [(D(2024, 1, 14), 2), (D(2024, 1, 7), 0)]


# ---- preparation -----------------------------------------------------------

def test_iqr_fences(spark):
    # quartiles of p are 6 and 14, so its fences are -6 and 26; q has none outside
    rows = [(2, 9), (6, 8), (10, 7), (14, 6), (90, 5)]
    df = spark.createDataFrame(rows, "p int, q int")
    assert values(prep.treat_outliers(df, ["p", "q"], 0, "iqr", "remove")) == values(df.filter("p < 90"))
    assert values(prep.treat_outliers(df, ["p", "q"])) == [(90, 5)]
    capped = prep.treat_outliers(df, ["p", "q"], 0, "iqr", "cap")
    assert (26.0, 5.0) in values(capped)
    again = prep.apply_bounds(capped, prep.outlier_bounds(df, ["p", "q"]), ["p", "q"], 0, "cap")
    assert values(again) == values(capped)


def test_nulls_are_never_outliers(spark):
    df = spark.createDataFrame([(None,), (1.0,), (1.1,), (0.9,), (50.0,)], "x double")
    assert (None,) in values(prep.treat_outliers(df, ["x"], 1, "iqr", "remove"))


def test_imputation_methods(spark):
    rows = [(None, 6.0, None, "k"), (2.0, None, 5.0, None), (None, 9.0, None, "m"), (8.0, None, None, "m")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, p double, q double, r double, s string")
    column = lambda out, c: [x[c] for x in out.orderBy("i").collect()]
    assert column(prep.impute(df, ["p", "q"], "mean"), "p") == [5, 2, 5, 8]
    assert column(prep.impute(df, ["p", "q"], "mean"), "q") == [6, 7.5, 9, 7.5]
    assert column(prep.impute(df, ["r"], "ffill", date_col="i"), "r") == [None, 5, 5, 5]
    assert column(prep.impute(df, ["s"], "most_frequent"), "s") == ["k", "m", "m", "m"]
    assert column(prep.impute(df, ["p", "q"], "constant", {"p": -3.0}), "p") == [-3, 2, -3, 8]
    assert column(prep.impute(df, ["p"], "custom", date_col="i"), "p")[1:] == [2, 5, 8]
    with pytest.raises(ValueError):
        prep.impute(df, ["p"], "ffill")
    both = prep.impute_by_method(df, {"mean": ["q"], "constant": ["p", "r"], "most_frequent": ["s"]}, {"p": 1.0, "r": 0.0})
    assert values(both) == [(0, 1.0, 6.0, 0.0, "k"), (1, 2.0, 7.5, 5.0, "m"), (2, 1.0, 9.0, 0.0, "m"), (3, 8.0, 7.5, 0.0, "m")]
    with pytest.raises(ValueError, match="more than one"):
        prep.impute_by_method(df, {"mean": ["q"], "median": ["q"]})


def test_row_digests_tell_rows_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("n", "x"), (None, "x"), ("", "x"), ("1:a", ""), ("", "1:a"), ("x", None)]
    df = spark.createDataFrame(rows, "p string, q string")
    health = {r["metric"]: r["value"] for r in quality.data_health(df).collect()}
    assert health["duplicate_rows_pct"] == 0
    prints = [files.table_fingerprint(spark.createDataFrame([r], "p string, q string")).first()["fingerprint"] for r in rows]
    assert len(set(prints)) == len(rows)
    assert files.table_fingerprint(df).first() == files.table_fingerprint(spark.createDataFrame(rows[::-1], "p string, q string")).first()
    assert files.table_fingerprint(df.limit(0)).first()["n_rows"] == 0


def test_visits_are_searched_until_found(spark):
    rows = [("near", 3.0, 1.0, 1.0), ("far", 3500.0, 1.0, 1.0), ("further", 54321.0, 1.0, 1.0), ("never paid", 2.0, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "seg string, coefficient double, margin double, cost double")
    got = {r["seg"]: (r["step"], r["visits"]) for r in roi.optimal_visits(df, "seg", lambda n: F.ln(1.0 + n)).collect()}
    for seg, c in (("near", 3.0), ("far", 3500.0), ("further", 54321.0)):
        n = next(k for k in range(1, 100_000) if c * np.log((2.0 + k) / (1.0 + k)) < 1)
        assert got[seg] == (n - 1, n)
    assert got["never paid"] == (None, None)
    with pytest.raises(ValueError, match="never falls"):
        roi.optimal_visits(df.filter("seg = 'near'"), "seg", lambda n: n)


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    assert prep.mode_row(df, ["s"]).first()[0] == "a"


def test_scaling(spark):
    df = spark.createDataFrame([("train", 1.0, 7.0), ("train", 3.0, 7.0), ("test", 5.0, 7.0), ("other", 9.0, 7.0)], "f string, x double, c double")
    got = values(prep.scale_columns(df, ["x", "c"], "minmax", "f"))
    assert got == [("test", 2.0, 0.0), ("train", 0.0, 0.0), ("train", 1.0, 0.0)]
    assert np.allclose(sorted(r["x"] for r in prep.scale_columns(df, ["x"], "custom", "f").collect()), [1 / 3, 1, 5 / 3])
    assert sorted(r["x"] for r in prep.scale_columns(df, ["x"], "standard", "f").collect()) == [-1.0, 1.0, 3.0]


def test_target_encoder_prior(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 8.0)], "c string, y double")
    new = spark.createDataFrame([("a", 0.0), ("b", 0.0), ("z", 0.0), (None, 0.0)], "c string, y double")
    got = sorted(r["c"] for r in prep.TargetEncoder(["c"], "y").fit(df).transform(new).collect())
    s, prior = 1 / (1 + np.exp(-1)), 4.0
    assert np.allclose(got, [prior * (1 - s) + 2 * s, prior, prior, prior])


def test_bins_and_splits(spark):
    df = spark.createDataFrame([(i, float(i // 2)) for i in range(100)], "id int, y double")
    bins = split.quantile_bins(df, "y", 10)
    assert bins.groupBy("y").agg(F.count_distinct("bin").alias("n")).filter("n > 1").count() == 0
    with pytest.raises(ValueError, match="unique"):
        split.quantile_bins(df.withColumn("y", F.lit(1.0)), "y", 10)
    parts = split.stratified_split_numeric(df, ["id"], "y")
    assert parts.count() == 100 and parts.filter("split = 'test'").count() == 20


def test_per_user_split_rules(spark):
    rows = [(1, i) for i in range(1)] + [(2, 10 + i) for i in range(4)] + [(3, 20 + i) for i in range(12)] + [(4, 40 + i) for i in range(5)]
    out = split.split_per_user(spark.createDataFrame(rows, "u int, k int"), "u", ["k"])
    got = {(r["u"], r["split"]): r["n"] for r in out.groupBy("u", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
    # one row: left out; 4 rows: round(1.2); 12 rows: 5; exactly 5 rows: all would be test, hence left out
    assert got == {(2, "test"): 1, (2, "train"): 3, (3, "test"): 5, (3, "train"): 7}


def test_edge_split_is_a_partition(spark):
    out = split.edge_split(spark.range(105).withColumnRenamed("id", "k"), ["k"])
    got = {r["split"]: r["n"] for r in out.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"test": 10, "validation": 10, "train": 85}


@pytest.mark.parametrize("step", [
    prep.OutlierModel(["x"], "percentile", 0.1, 0.9), prep.TargetEncoder(["c", "d"], "y"), prep.FeatureTable(["c"], ["x"], "y"),
    prep.WoeEncoder(["x"], "y", 3)], ids=lambda s: type(s).__name__)
def test_fitted_steps_are_saved_and_loaded(spark, step):
    from pyspark.ml import Pipeline, PipelineModel

    rows = [(i, float(i % 17) if i % 5 else None, "ab"[i % 2], f"k{i % 3}", i % 4 == 0) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, x double, c string, d string, y0 boolean").withColumn("y", F.col("y0").cast("int"))
    new = df.filter("id > 60").withColumn("c", F.when(F.col("id") % 7 > 0, F.col("c")))
    wanted = values(type(step)(**{k: v for k, v in vars(step).items() if k not in fitted.LEARNT}).fit(df.filter("id <= 60")).transform(new))
    model, path = fitted.FitStep(step).fit(df.filter("id <= 60")), scratch_path(spark, "step")
    assert values(model.transform(new)) == wanted
    model.write().save(path)
    again = fitted.FittedStep.load(path)
    assert again.uid == model.uid and values(again.transform(new)) == wanted
    pipeline = Pipeline(stages=[fitted.FitStep(step)]).fit(df.filter("id <= 60"))
    pipeline.write().save(f"{path}-pipeline")
    assert values(PipelineModel.load(f"{path}-pipeline").transform(new)) == wanted
    with pytest.raises(ValueError):
        fitted.FitStep(object())
