"""Modelling, scoring and evaluation queries."""

from pyspark.sql import functions as F

from tillwork.operators import fitted, gram, metrics, models, prep, roi, search

from tillwork.session import attach_row, materialise, scratch_path

from .clean_q import LINE_KEY
from .eda_q import SQL_DOCS, SQL_SCORED, docs, rounded, scored_docs
from .prep_q import KEY, SQL_ENCODED, SQL_FLAGGED, _train, branded, flagged
from .registry import query, table

@query(
    "ols_simple",
    """SELECT 'l_quantity' AS feature, round(regr_slope(l_extendedprice, l_quantity), 6) AS coefficient,
      round(regr_r2(l_extendedprice, l_quantity), 9) AS r2, count(*) AS n FROM lineitem
    UNION ALL SELECT 'intercept', round(regr_intercept(l_extendedprice, l_quantity), 6),
      round(regr_r2(l_extendedprice, l_quantity), 9), count(*) FROM lineitem""",
)
def ols_simple(spark, d):
    line = table(spark, d, "lineitem")
    out = models.coefficient_table(spark, models.ols(line, ["l_quantity"], "l_extendedprice"))
    return rounded(rounded(out.select("feature", "coefficient", "r2", "n"), 6, "coefficient"), 9, "r2")


@query(
    "ols_multi",
    """WITH s AS (SELECT count(*) AS n, avg(l_quantity) AS m1, avg(l_tax) AS m2, avg(l_extendedprice) AS my,
        var_pop(l_quantity) AS s11, var_pop(l_tax) AS s22, covar_pop(l_quantity, l_tax) AS s12,
        covar_pop(l_quantity, l_extendedprice) AS s1y, covar_pop(l_tax, l_extendedprice) AS s2y,
        var_pop(l_extendedprice) AS syy FROM lineitem),
      b AS (SELECT *, s11 * s22 - s12 * s12 AS det, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
        (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM s),
      e AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0, (syy - b1 * s1y - b2 * s2y) * n / (n - 3) AS s2,
        (b1 * s1y + b2 * s2y) / syy AS r2 FROM b),
      t AS (SELECT 'intercept' AS feature, b0 AS coefficient,
          sqrt(s2 * (1 + (m1 * m1 * s22 - 2 * m1 * m2 * s12 + m2 * m2 * s11) / det) / n) AS std_error, r2, n FROM e
        UNION ALL SELECT 'l_quantity', b1, sqrt(s2 * s22 / det / n), r2, n FROM e
        UNION ALL SELECT 'l_tax', b2, sqrt(s2 * s11 / det / n), r2, n FROM e)
    SELECT feature, round(coefficient, 5) AS coefficient, round(std_error, 5) AS std_error,
      round(coefficient / std_error, 5) AS t_value, round(r2, 9) AS r2,
      round(1 - (1 - r2) * (n - 1) / (n - 3), 9) AS r2_adj, n FROM t""",
)
def ols_multi(spark, d):
    line = table(spark, d, "lineitem")
    out = models.coefficient_table(spark, models.ols(line, ["l_quantity", "l_tax"], "l_extendedprice"))
    out = rounded(out.drop("p_value", "vif"), 5, "coefficient", "std_error", "t_value")
    return rounded(out, 9, "r2", "r2_adj")


@query("logit_fit")
def logit_fit(spark, d):
    rows = docs(spark, d).withColumn("size", F.col("n_chars") / 1000)
    return models.logit(rows, ["size", "toxic"], "quality")


@query(
    "logit_accuracy",
    f"""WITH {SQL_DOCS} SELECT count(*) AS n,
      round(avg(CAST(quality = CAST(1 / (1 + exp(-(0.8 * n_chars / 1000 - 0.5 * toxic - 0.4))) > 0.5 AS INTEGER) AS INTEGER)), 9) AS accuracy
    FROM docs WHERE n_chars IS NOT NULL AND toxic IS NOT NULL AND quality IS NOT NULL""",
)
def logit_accuracy(spark, d):
    rows = docs(spark, d).withColumn("size", F.col("n_chars") / 1000)
    return rounded(models.logit_accuracy(rows, {"size": 0.8, "toxic": -0.5}, -0.4, "quality"), 9, "accuracy")


@query(
    "logit_score",
    f"""WITH {SQL_DOCS}, p AS (SELECT doc_id, 1 / (1 + exp(-(0.8 * n_chars / 1000 - 0.5 * toxic - 0.4))) AS probability FROM docs)
    SELECT doc_id, round(probability, 9) AS probability, CAST(probability > 0.5 AS INTEGER) AS predicted FROM p""",
)
def logit_score(spark, d):
    rows = docs(spark, d).withColumn("size", F.col("n_chars") / 1000)
    out = models.score_logit(rows, {"size": 0.8, "toxic": -0.5}, -0.4)
    return rounded(out.select("doc_id", "probability", "predicted"), 9, "probability")


@query(
    "linear_score",
    f"""WITH {SQL_FLAGGED} SELECT flag, {KEY}, l_extendedprice AS actuals, round(1450.0 * l_quantity + 120.0, 6) AS preds
    FROM fl WHERE flag IN ('train', 'test')""",
)
def linear_score(spark, d):
    rows = flagged(spark, d).filter(F.col("flag").isin("train", "test"))
    out = models.score_linear(rows, {"l_quantity": 1450.0}, 120.0, "preds")
    return rounded(out.select("flag", *LINE_KEY, F.col("l_extendedprice").alias("actuals"), "preds"), 6, "preds")


SQL_REVENUE = """rv AS (SELECT l_returnflag, CASE WHEN l_shipdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS flag,
    l_extendedprice AS x1, l_discount AS x2, l_extendedprice * (1 - l_discount) AS y FROM lineitem),
  st AS (SELECT count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) AS s11, var_pop(x2) AS s22,
    covar_pop(x1, x2) AS s12, covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y FROM rv WHERE flag = 'train')"""


def _trained_sql(w1, admissible):
    """Both models keep the discount at its bound of 0 where the optimality condition holds."""
    return f"""WITH {SQL_REVENUE}, w AS (SELECT *, greatest({w1}, 0) AS w1 FROM st),
      f AS (SELECT CASE WHEN {admissible} THEN w1 END AS w1, my - w1 * m1 AS w0 FROM w)
      SELECT l_returnflag, flag, round(w1, 9) AS beta_l_extendedprice, 0.0::DOUBLE AS beta_l_discount, round(w0, 4) AS "Intercept",
        count(*) AS n, round(sqrt(avg((y - w0 - w1 * x1) * (y - w0 - w1 * x1))), 5) AS rmse,
        round(1 - sum((y - w0 - w1 * x1) * (y - w0 - w1 * x1)) / (var_pop(y) * count(*)), 8) AS r2 FROM rv, f GROUP BY ALL"""


def _trained(spark, d, model_type, alpha):
    line = table(spark, d, "lineitem").withColumns({
        "revenue": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "day": F.to_date("l_shipdate"),
        "flag": F.when(F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp"), "train").otherwise("test")})
    _, matrix, scored = models.train_linear_model(
        line, ["l_extendedprice", "l_discount"], "revenue", "flag", "day", "l_returnflag", model_type, alpha)
    quality = metrics.regression_metrics(scored, "actuals", "preds", ["l_returnflag", "flag"])
    out = matrix.join(quality, "l_returnflag").select(
        "l_returnflag", "flag", "beta_l_extendedprice", "beta_l_discount", "Intercept", "n", "rmse", "r2")
    return rounded(rounded(rounded(rounded(out, 9, "beta_l_extendedprice"), 4, "Intercept"), 5, "rmse"), 8, "r2")


@query("nn_ridge", _trained_sql("s1y / (s11 + 1000.0 / n)", "s2y - s12 * w1 <= 0"))
def nn_ridge(spark, d):
    return _trained(spark, d, "ridge", 1000.0)


@query("nn_lasso", _trained_sql("(s1y - 1000.0) / s11", "s2y - s12 * w1 - 1000.0 <= 0"))
def nn_lasso(spark, d):
    return _trained(spark, d, "lasso", 1000.0)


def _logs(spark, d):
    return branded(spark, d).select(
        "p_brand", F.log1p("l_extendedprice").alias("log_price"), F.log1p("l_quantity").alias("log_qty"),
        "l_extendedprice", "l_quantity", F.month("l_shipdate").alias("month"))


def _enet_sql(low, high):
    """One feature: soft-thresholded covariance over penalised variance, kept within the bounds."""
    return f"""WITH g AS (SELECT p_brand, count(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice) AS my, var_pop(l_quantity) AS sxx,
        covar_pop(l_quantity, l_extendedprice) AS sxy FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY 1),
      w AS (SELECT *, least(greatest(sign(sxy) * greatest(abs(sxy) - 40.0 * 0.5, 0) / (sxx + 40.0 * 0.5), {low}), {high}) AS w FROM g)
    SELECT p_brand, n, 'l_quantity' AS feature, round(w, 6) AS coefficient FROM w
    UNION ALL SELECT p_brand, n, 'intercept', round(my - w * mx, 4) FROM w"""


def _enet(spark, d, box):
    out = models.elastic_net_by_group(branded(spark, d), ["l_quantity"], "l_extendedprice", ["p_brand"], 0.5, 40.0, box)
    value = F.when(F.col("feature") == "intercept", F.round("coefficient", 4)).otherwise(F.round("coefficient", 6))
    return out.withColumn("coefficient", value)


@query("enet_by_group", _enet_sql("-1e300", "1e300"))
def enet_by_group(spark, d):
    return _enet(spark, d, None)


@query("enet_box", _enet_sql("0", "25"))
def enet_box(spark, d):
    return _enet(spark, d, {"l_quantity": (0.0, 25.0)})


@query("enet_wide")
def enet_wide(spark, d):
    return models.elastic_net_by_group(
        _logs(spark, d), ["log_qty", "month"], "log_price", ["p_brand"], 0.5, 0.003, {"log_qty": (0.0, 0.9)})


@query(
    "group_slopes",
    """SELECT p_brand, round(regr_slope(l_extendedprice, l_quantity), 5) AS coefficient,
      round(regr_intercept(l_extendedprice, l_quantity), 5) AS intercept, count(*) AS n
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def group_slopes(spark, d):
    """Least squares per brand: the unpenalised limit of the per-group fit."""
    out = models.elastic_net_by_group(branded(spark, d), ["l_quantity"], "l_extendedprice", ["p_brand"], 0.5, 0.0)
    wide = out.groupBy("p_brand").agg(
        F.max(F.when(F.col("feature") == "l_quantity", F.col("coefficient"))).alias("coefficient"),
        F.max(F.when(F.col("feature") == "intercept", F.col("coefficient"))).alias("intercept"), F.max("n").alias("n"))
    return rounded(wide, 5, "coefficient", "intercept")


@query("lme_fit")
def lme_fit(spark, d):
    common, groups = models.linear_mixed_effects(
        _logs(spark, d), ["log_qty", "month"], "log_price", "p_brand", ["log_qty"])
    out = groups
    for name, value in common.items():
        out = out.withColumn(f"common_{name}", F.lit(value))
    return out


BOX = (0.95, 1.05)


@query("lme_box")
def lme_box(spark, d):
    return models.linear_mixed_effects(
        _logs(spark, d), ["log_qty"], "log_price", "p_brand", ["log_qty"], box={"log_qty": BOX})[1]


@query("lme_box_check", """SELECT DISTINCT p_brand, f AS feature, true AS inside, true AS best FROM lineitem JOIN part ON l_partkey = p_partkey,
    (SELECT unnest(['intercept', 'log_qty']) AS f)""")
def lme_box_check(spark, d):
    """Mixed effects whose slopes are bounded: they lie inside, and satisfy the conditions of the best point there."""
    groups = lme_box(spark, d)
    inside = (F.col("feature") != "log_qty") | F.col("coefficient").between(BOX[0] - 1e-12, BOX[1] + 1e-12)
    return groups.select("p_brand", "feature", inside.alias("inside"), (F.col("violation") < 1e-6).alias("best"))


@query(
    "bayes_shrink",
    """WITH b AS (SELECT p_brand, l_extendedprice / 1000 AS y, l_quantity / 10 AS x FROM lineitem
        JOIN part ON l_partkey = p_partkey),
      t AS (SELECT regr_intercept(y, x) AS m0, regr_slope(y, x) AS m1,
        (var_pop(y) - covar_pop(x, y) * covar_pop(x, y) / var_pop(x)) * count(*) / (count(*) - 2) AS s2, 4.0 AS p FROM b),
      g AS (SELECT p_brand, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy FROM b GROUP BY 1),
      a AS (SELECT p_brand, n, n / s2 + p AS a11, sx / s2 AS a12, sxx / s2 + p AS a22, sy / s2 + p * m0 AS b1, sxy / s2 + p * m1 AS b2
        FROM g, t),
      k AS (SELECT *, a11 * a22 - a12 * a12 AS det FROM a)
    SELECT p_brand, n, 'intercept' AS feature, round((a22 * b1 - a12 * b2) / det, 6) AS posterior_mean,
      round(sqrt(a22 / det), 6) AS posterior_sd FROM k
    UNION ALL SELECT p_brand, n, 'x', round((a11 * b2 - a12 * b1) / det, 6), round(sqrt(a11 / det), 6) FROM k""",
)
def bayes_shrink(spark, d):
    rows = branded(spark, d).select(
        "p_brand", (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_quantity") / 10).alias("x"))
    return rounded(models.hierarchical_shrinkage(rows, ["x"], "y", "p_brand", 0.5), 6, "posterior_mean", "posterior_sd")


@query("bayes_bounds")
def bayes_bounds(spark, d):
    return models.hierarchical_shrinkage(
        _logs(spark, d), ["log_qty", "month"], "log_price", "p_brand", 0.1, bounds={"log_qty": (0.0, 3.0)})


@query("bayes_bounds_check", """SELECT p_brand, count(*) AS n, f AS feature, true AS inside, true AS narrower FROM lineitem JOIN part ON l_partkey = p_partkey,
    (SELECT unnest(['intercept', 'log_qty', 'month']) AS f) GROUP BY 1, 3""")
def bayes_bounds_check(spark, d):
    """Posteriors cut to a range: means lie inside the bounds, and cutting makes no coefficient less certain."""
    rows = materialise(_logs(spark, d))
    args = (rows, ["log_qty", "month"], "log_price", "p_brand", 0.1)
    cut = models.hierarchical_shrinkage(*args, bounds={"log_qty": (0.9, 1.0)})
    free = models.hierarchical_shrinkage(*args).select("p_brand", "feature", F.col("posterior_sd").alias("free_sd"))
    inside = (F.col("feature") != "log_qty") | F.col("posterior_mean").between(0.9, 1.0)
    narrower = F.col("posterior_sd").between(0.0, F.col("free_sd") * (1 + 1e-9))
    return cut.join(free, ["p_brand", "feature"]).select("p_brand", "n", "feature", inside.alias("inside"), narrower.alias("narrower"))


LONG = [("Intercept", 1.5), ("sales", 0.4), ("web", -0.2), ("1|seg[BUILDING]", 0.25), ("sales|seg[BUILDING]", 0.1),
        ("web|seg[MACHINERY]", -0.05)]


@query(
    "coef_matrix",
    """WITH g AS (SELECT DISTINCT c_mktsegment AS seg FROM customer),
      b AS (SELECT seg, 0.4 + CASE WHEN seg = 'BUILDING' THEN 0.1 ELSE 0 END AS beta_sales,
        -0.2 + CASE WHEN seg = 'MACHINERY' THEN -0.05 ELSE 0 END AS beta_web, 0.0 AS beta_tv,
        1.5 + CASE WHEN seg = 'BUILDING' THEN 0.25 ELSE 0 END AS i FROM g)
    SELECT seg, round(beta_sales::DOUBLE, 9) AS beta_sales, round(beta_web::DOUBLE, 9) AS beta_web, beta_tv::DOUBLE AS beta_tv,
      round(i::DOUBLE, 9) AS "Intercept", round(exp(i), 9) AS e_intercept FROM b""",
)
def coef_matrix(spark, d):
    long = spark.createDataFrame(LONG, "`feature names` string, `feature coefficients` double")
    groups = table(spark, d, "customer").select(F.col("c_mktsegment").alias("seg"))
    out = models.coefficient_matrix(long, ["sales", "web", "tv"], "Intercept", "seg", groups)
    return rounded(out, 9, "beta_sales", "beta_web", "Intercept", "e_intercept")


def _metric_sql(y, p, src, by):
    e = f"abs({y} - {p})"
    return f"""SELECT {by}, count(*) AS n, round(avg({e} / greatest(abs({y}), 2.220446049250313e-16)), 8) AS mape,
      round(avg({e} / nullif({y}, 0)), 8) AS mape_finite, round(avg({e}) / avg({y}), 8) AS wmape, round(avg({e}), 5) AS mae,
      round(sqrt(avg({e} * {e})), 5) AS rmse, round(1 - sum({e} * {e}) / (var_pop({y}) * count(*)), 8) AS r2
      FROM {src} GROUP BY ALL"""


def _rounded_metrics(df):
    return rounded(rounded(df, 8, "mape", "mape_finite", "wmape", "r2"), 5, "mae", "rmse")


@query("reg_metrics", f"""WITH {SQL_FLAGGED}, s AS (SELECT flag, l_extendedprice AS y, 1450.0 * l_quantity + 120.0 AS p FROM fl)
    {_metric_sql('y', 'p', 's', 'flag')}""")
def reg_metrics(spark, d):
    rows = models.score_linear(flagged(spark, d), {"l_quantity": 1450.0}, 120.0)
    return _rounded_metrics(metrics.regression_metrics(rows, "l_extendedprice", "yhat", ["flag"]))


@query(
    "model_comparison",
    f"""WITH {SQL_FLAGGED}, s AS (SELECT flag, l_extendedprice AS y, unnest(['small', 'large', 'constant']) AS model,
      unnest([1400.0 * l_quantity, 1500.0 * l_quantity, 38000.0]) AS p FROM fl) {_metric_sql('y', 'p', 's', 'flag, model')}""",
)
def model_comparison(spark, d):
    q = F.col("l_quantity")
    rows = flagged(spark, d).withColumns({"small": 1400.0 * q, "large": 1500.0 * q, "constant": F.lit(38000.0)})
    return _rounded_metrics(metrics.model_comparison(rows, "l_extendedprice", ["small", "large", "constant"], ["flag"]))


@query("confusion", f"WITH {SQL_SCORED} SELECT quality, pred, count(*) AS n FROM scored GROUP BY ALL")
def confusion(spark, d):
    return metrics.confusion(scored_docs(spark, d), "quality", "pred")


@query(
    "class_report",
    f"""WITH {SQL_SCORED}, k AS (SELECT DISTINCT quality AS c FROM scored UNION SELECT DISTINCT pred FROM scored),
      m AS (SELECT c, count(*) FILTER (WHERE quality = c) AS support, count(*) FILTER (WHERE pred = c) AS called,
        count(*) FILTER (WHERE quality = c AND pred = c) AS tp FROM k, scored GROUP BY 1),
      r AS (SELECT *, coalesce(tp / nullif(called, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r FROM m)
    SELECT CAST(c AS VARCHAR) AS class, round(p, 9) AS precision, round(r, 9) AS recall,
      round(coalesce(2 * p * r / nullif(p + r, 0), 0), 9) AS f1, support,
      round((SELECT avg(CAST(quality = pred AS INTEGER)) FROM scored), 9) AS accuracy FROM r""",
)
def class_report(spark, d):
    out = metrics.classification_report(scored_docs(spark, d), "quality", "pred")
    return rounded(out, 9, "precision", "recall", "f1", "accuracy")


@query(
    "auc",
    f"""WITH {SQL_SCORED}, p AS (SELECT score FROM scored WHERE quality = 1), n AS (SELECT score FROM scored WHERE quality = 0)
    SELECT round(avg(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END), 9) AS auc FROM p, n""",
)
def auc(spark, d):
    return rounded(metrics.auc(scored_docs(spark, d), "quality", "score"), 9, "auc")


def _wide_line(spark, d):
    return table(spark, d, "lineitem").select(
        *LINE_KEY, "l_quantity", "l_discount", "l_tax", "l_extendedprice",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"), F.month("l_shipdate").alias("month"),
        (F.col("l_quantity") * 20).alias("cost"), (F.col("l_quantity") * 35).alias("margin_cost"))


@query("stepwise")
def stepwise(spark, d):
    fit = models.stepwise(_wide_line(spark, d), "revenue", ["l_discount", "l_tax", "month", "l_quantity"], ["l_extendedprice"], ["disc"])
    return models.coefficient_table(spark, fit)


@query("rtm_iteration")
def rtm_iteration(spark, d):
    return models.modelling_iteration(
        _wide_line(spark, d), ["l_extendedprice", "l_discount", "l_quantity"], "revenue", ["l_extendedprice"], "cost", "margin_cost")


@query("gbt_grid")
def gbt_grid(spark, d):
    _, scores, importance = models.boosted_grid(
        _wide_line(spark, d), ["l_extendedprice", "l_quantity", "l_discount", "month"], "revenue", (2, 3), trees=5)
    best = scores.agg(F.min("rmse").alias("best_rmse"))
    return attach_row(importance, best)


@query("rf_importance")
def rf_importance(spark, d):
    return models.forest_importance(_wide_line(spark, d), ["l_extendedprice", "l_quantity", "l_discount", "month"], "revenue", 10, 4)


@query("model_search")
def model_search(spark, d):
    train, check = models.prepare_training(_wide_line(spark, d), LINE_KEY, 0.75, ["l_quantity"])
    return models.model_search(train, check, ["l_extendedprice", "l_quantity", "l_discount", "month"], "revenue", trees=5)


@query(
    "score_batch",
    f"""WITH {SQL_ENCODED}, md AS (SELECT quantile_cont(l_quantity, 0.5) AS mq FROM tr)
    SELECT {KEY}, round(0.8 * coalesce(b.v, prior) + 0.1 * coalesce(t.v, prior) - 12.5 * coalesce(l_quantity, mq) + 40, 5) AS yhat
    FROM br LEFT JOIN e_p_brand b ON br.p_brand = b.p_brand LEFT JOIN e_p_type t ON br.p_type = t.p_type, pr, md
    WHERE NOT (l_shipdate < TIMESTAMP '2000-01-01')""",
)
def score_batch(spark, d):
    """Fit the feature table on train rows and save it; load it to score the later rows with fixed coefficients."""
    rows, path = branded(spark, d), scratch_path(spark, "feature-table")
    fitted.FitStep(prep.FeatureTable(["p_brand", "p_type"], ["l_quantity"], "price")).fit(_train(rows)).write().save(path)
    model = fitted.FittedStep.load(path)
    later = rows.filter(~(F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp")))
    scored = models.score_linear(
        model.transform(later), {"p_brand": 0.8, "p_type": 0.1, "l_quantity": -12.5}, 40.0)
    return rounded(scored.select(*LINE_KEY, "yhat"), 5, "yhat")


@query("halving_search", """WITH w AS (SELECT (SELECT count(*) FROM lineitem) AS n)
    SELECT 1 AS round, 36 AS settings, true AS part, true AS ordered FROM w UNION ALL SELECT 2, 12, true, true FROM w UNION ALL SELECT 3, 6, true, true FROM w""")
def halving_search(spark, d):
    """54 models and fillings, a third of which goes on to three times as many rows: how many each round dropped, on which part of the rows."""
    rows = _wide_line(spark, d).withColumn("l_quantity", F.when(F.col("l_linenumber") % 5 > 0, F.col("l_quantity")))
    train, check = models.prepare_training(rows, LINE_KEY, 0.75)
    grid = [s for s in search.settings_grid(("drop", "mean"), (0.01, 0.1), (3,), (5,)) if s.model != "boosted"]
    grid += search.settings_grid(("zero", "median"), (0.01, 0.1, 1.0), (3,), (5,))[: 54 - len(grid)]
    found = search.halving_search(train, check, ["l_quantity", "l_discount", "l_extendedprice", "month"], "revenue", LINE_KEY, grid)
    total = train.count()
    rounds = found.groupBy("round").agg(F.count("*").cast("int").alias("settings"), F.max("rows").alias("rows"), F.max("rank").alias("worst"), F.min("rank").alias("best"))
    share = F.element_at(F.array(*[F.lit(x) for x in (1 / 9, 1 / 3, 1.0)]), F.col("round"))
    near = F.abs(F.col("rows") - share * total) <= 4 * F.sqrt(F.lit(float(total)))
    return rounds.select("round", "settings", near.alias("part"), (F.col("worst") - F.col("best") + 1 == F.col("settings")).alias("ordered"))
