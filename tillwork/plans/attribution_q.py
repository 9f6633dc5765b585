"""Attribution queries on a daily segment panel with fixed coefficients."""

from pyspark.sql import functions as F

from tillwork.functions.text import strip_last_token
from tillwork.operators import attribution, joins

from .eda_q import rounded
from .registry import query, table

VARS = ("tv", "web", "traffic", "price", "promo")
MARKETING, CONTROL = ("tv", "web", "promo"), ("traffic", "price")
# Coefficients per segment (tv, web, traffic, price, promo), intercepts, random intercepts.
BETAS = {
    "AUTOMOBILE": (0.62, 0.35, 0.41, 0.27, 0.15), "BUILDING": (0.58, 0.31, 0.44, 0.22, 0.18),
    "FURNITURE": (0.66, 0.28, 0.39, 0.25, 0.12), "HOUSEHOLD": (0.54, 0.37, 0.46, 0.21, 0.17),
    "MACHINERY": (0.60, 0.33, 0.42, 0.24, 0.14),
}
INTERCEPT = {"AUTOMOBILE": 0.11, "BUILDING": 0.09, "FURNITURE": 0.12, "HOUSEHOLD": 0.08, "MACHINERY": 0.10}
RANDOM = {"AUTOMOBILE": 0.05, "BUILDING": -0.03, "FURNITURE": 0.02, "HOUSEHOLD": -0.04, "MACHINERY": 0.0}
FIXED = {"tv": 0.60, "web": 0.33, "traffic": 0.42, "price": 0.24, "promo": 0.15}
FIXED_INTERCEPT = 0.1
MAPPING = [("tv", "tv", "Television"), ("web", "web", "Online"), ("promo", "price", "Promotion")]
CONFIG = [("tv", "MEAN"), ("web", "MAX"), ("traffic", "AS IS"), ("price", "0.2"), ("promo", None)]

SQL_MX = """mx AS (SELECT CAST(o_orderdate AS DATE) AS day, c_mktsegment AS seg,
    round(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0 END) / 1000000, 8) AS tv,
    round(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice ELSE 0 END) / 1000000, 8) AS web,
    count(*) / 10 AS traffic, max(o_totalprice) / 1000000 AS price,
    count(*) FILTER (WHERE o_orderpriority = '5-LOW') / 10 AS promo,
    round(sum(o_totalprice) / 1000000, 8) AS actuals
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""
SQL_CM = "cm AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{s}', {', '.join(f'{x}::DOUBLE' for x in b)}, {INTERCEPT[s]}::DOUBLE, {RANDOM[s]}::DOUBLE)" for s, b in BETAS.items()
) + ") v(seg, " + ", ".join(f"b_{v}" for v in VARS) + ", b0, rnd))"
_LIN = "b0 + " + " + ".join(f"b_{v} * {v}" for v in VARS)
SQL_JOINED = f"{SQL_MX}, {SQL_CM}, j AS (SELECT mx.*, {', '.join(f'b_{v}' for v in VARS)}, b0, rnd, {_LIN} AS lin FROM mx JOIN cm ON mx.seg = cm.seg)"


def mix_panel(spark, d):
    """Daily media and sales figures by customer segment, in millions."""
    orders = table(spark, d, "orders")
    cust = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("seg"))
    rows = joins.join_dimension(orders, cust, [("o_custkey", "c_custkey")])
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    return rows.groupBy(F.to_date("o_orderdate").alias("day"), "seg").agg(
        F.round(F.sum(F.when(priority == "1-URGENT", price).otherwise(0)) / 1000000, 8).alias("tv"),
        F.round(F.sum(F.when(priority == "2-HIGH", price).otherwise(0)) / 1000000, 8).alias("web"),
        (F.count(F.lit(1)) / 10).alias("traffic"), (F.max(price) / 1000000).alias("price"),
        (F.count(F.when(priority == "5-LOW", 1)) / 10).alias("promo"),
        F.round(F.sum(price) / 1000000, 8).alias("actuals"),
    )


def coefficients(spark, log=False):
    rows = [(s, *b, INTERCEPT[s]) for s, b in BETAS.items()]
    names = "seg string, " + ", ".join(f"beta_{v} double" for v in VARS) + ", Intercept double"
    return spark.createDataFrame(rows, names).withColumn("e_intercept", F.exp("Intercept"))


def act_vs_preds(spark, panel, log=False):
    joined = panel.join(coefficients(spark), "seg")
    lin = F.col("Intercept")
    for v in VARS:
        lin = lin + F.col(f"beta_{v}") * F.col(v)
    return joined.select("day", "seg", (F.ln("actuals") if log else F.col("actuals")).alias("actuals"), lin.alias("preds"))


AC = [f"ac_{v}" for v in (*MARKETING, *CONTROL)]
SQL_ADD = f"""{SQL_JOINED}, aa AS (SELECT day, seg, b0 AS base, {', '.join(
    f'b_{v} * {v} * ((actuals - b0) / (lin - b0)) AS ac_{v}' for v in (*MARKETING, *CONTROL))}, tv, web, price FROM j)"""


@query("attr_additive", f"WITH {SQL_ADD} SELECT day, seg, base, {', '.join(f'round({c}, 8) AS {c}' for c in AC)} FROM aa")
def attr_additive(spark, d):
    return rounded(_additive(spark, mix_panel(spark, d)), 8, *AC)


def _additive(spark, panel):
    return attribution.additive_attribution(
        panel, coefficients(spark), act_vs_preds(spark, panel), "day", MARKETING, CONTROL)


def _mul_sql():
    e = {v: f"exp(b_{v} * {v})" for v in VARS}
    ctl = " * ".join(e[v] for v in CONTROL) + " * exp(b0)"
    parts = f"""p AS (SELECT *, exp(lin) AS preds, {ctl} AS yc, exp(lin) - {ctl} AS ym FROM j),
      r AS (SELECT *, {', '.join(f"{'ym' if v in MARKETING else 'yc'} * (1 - 1 / {e[v]}) AS rc_{v}" for v in VARS)} FROM p),
      s AS (SELECT *, {' + '.join(f'rc_{v}' for v in MARKETING)} AS sm, {' + '.join(f'rc_{v}' for v in CONTROL)} AS sc FROM r)"""
    out = ", ".join(
        f"round(rc_{v} * {'ym' if v in MARKETING else 'yc'} / nullif({'sm' if v in MARKETING else 'sc'}, 0) * (actuals - exp(b0)) / preds, 6) AS ac_{v}"
        for v in (*MARKETING, *CONTROL))
    return f"WITH {SQL_JOINED}, {parts} SELECT day, seg, round(exp(b0), 8) AS base, {out} FROM s"


@query("attr_multiplicative", _mul_sql())
def attr_multiplicative(spark, d):
    panel = mix_panel(spark, d)
    out = attribution.multiplicative_attribution(
        panel, coefficients(spark), act_vs_preds(spark, panel, log=True), "day", MARKETING, CONTROL)
    return rounded(rounded(out, 8, "base"), 6, *AC)


def _mapping(spark):
    return spark.createDataFrame(MAPPING, "variable_name string, variable_spend string, variable_description string")


def _roas_sql(period):
    cols = ", ".join(f'round(sum(ac_{n}) / sum({s}), 6) AS "{t}"' for n, s, t in MAPPING)
    return f"""WITH {SQL_ADD}, k AS (SELECT *, {period} AS p FROM aa)
      SELECT coalesce(p, 'Overall') AS period, {cols} FROM k GROUP BY ROLLUP (p)"""


SQL_QUARTER = "CAST(year(day) AS VARCHAR) || 'Q' || CAST(quarter(day) AS VARCHAR)"


def _per_period(spark, d, fn, period):
    panel = mix_panel(spark, d)
    out = fn(panel, _additive(spark, panel), period, _mapping(spark), "day")
    return rounded(out, 6, *[m[2] for m in MAPPING])


@query("roas_quarter", _roas_sql(SQL_QUARTER))
def roas_quarter(spark, d):
    return _per_period(spark, d, attribution.roas, "quarter")


@query("roas_year", _roas_sql("CAST(year(day) AS VARCHAR)"))
def roas_year(spark, d):
    return _per_period(spark, d, attribution.roas, "year")


_A = " + ".join(f"sum(ac_{n})" for n, _, _ in MAPPING)
_S = " + ".join(f"sum({s})" for _, s, _ in MAPPING)


@query(
    "efficiency",
    f"WITH {SQL_ADD} SELECT {SQL_QUARTER} AS period, " + ", ".join(
        f'round((sum(ac_{n}) / ({_A})) / (sum({s}) / ({_S})), 6) AS "{t}"' for n, s, t in MAPPING) + " FROM aa GROUP BY 1",
)
def efficiency(spark, d):
    return _per_period(spark, d, attribution.efficiency, "quarter")


def _config(spark):
    return spark.createDataFrame(CONFIG, "Parameters string, Action string")


def _random(spark):
    return spark.createDataFrame(list(RANDOM.items()), "group_var string, beta double")


@query(
    "baseline_values",
    f"""WITH {SQL_MX} SELECT round(avg(tv), 8) AS tv, max(web) AS web, 0.2::DOUBLE AS price, 0::DOUBLE AS promo FROM mx""",
)
def baseline_values(spark, d):
    row = attribution.baseline_values(mix_panel(spark, d), _config(spark), VARS)
    out = row.select(*[F.col(c).alias(c.removeprefix("_base_")) for c in row.columns])
    return rounded(out, 8, "tv")


@query(
    "baseline_statistics",
    f"""WITH {SQL_MX}, m AS (SELECT traffic FROM mx GROUP BY 1 ORDER BY count(*) DESC, traffic LIMIT 1)
    SELECT round(quantile_cont(tv, 0.5), 8) AS tv, min(web) AS web, (SELECT traffic FROM m) AS traffic FROM mx""",
)
def baseline_statistics(spark, d):
    config = spark.createDataFrame([("tv", "median"), ("web", "min"), ("traffic", "mode")], "Parameters string, Action string")
    row = attribution.baseline_values(mix_panel(spark, d), config, VARS)
    out = row.select(*[F.col(c).alias(c.removeprefix("_base_")) for c in row.columns])
    return rounded(out, 8, "tv")


_FIX = " + ".join(f"{v} * {b}" for v, b in FIXED.items())


@query(
    "predict_linear",
    f"""WITH {SQL_JOINED} SELECT day, seg, round(exp({_FIX} + {FIXED_INTERCEPT} + rnd), 8) AS predicted FROM j""",
)
def predict_linear(spark, d):
    out = attribution.linear_predictor(mix_panel(spark, d), FIXED, FIXED_INTERCEPT, _random(spark), "seg")
    return out.select("day", "seg", F.round(F.exp("linear_prediction"), 8).alias("predicted"))


def _no_baseline_cte():
    t = {v: f"({v} * {b})" for v, b in FIXED.items()}
    base, impact = ["traffic", "price"], ["tv", "web", "promo"]
    b = f"({FIXED_INTERCEPT} + {t['traffic']} + {t['price']})"
    i = "(" + " + ".join(t[v] for v in impact) + ")"
    raw = ", ".join(f"exp({b} + {i}) - exp({b} + {i} - {t[v]}) AS raw_{v}" for v in impact)
    size = " + ".join(f"abs(raw_{v})" for v in impact)
    rest = f"(pred - eb - ({' + '.join(f'raw_{v}' for v in impact)}))"
    acs = ", ".join(f'coalesce(raw_{v} + abs(raw_{v}) / nullif({size}, 0) * {rest}, 0) AS "{v}_contribution_impact"' for v in impact)
    c0 = FIXED_INTERCEPT
    bases = (f'exp({c0}) AS "(Intercept)_contribution_base", '
             f'exp({c0} + {t["traffic"]}) - exp({c0}) AS "traffic_contribution_base", '
             f'exp({c0} + {t["traffic"]} + {t["price"]}) - exp({c0} + {t["traffic"]}) AS "price_contribution_base"')
    return f"""{SQL_JOINED}, w AS (SELECT *, exp({b} + {i} + rnd) AS pred, exp({b}) AS eb, {raw} FROM j),
      nb AS (SELECT seg, day, pred AS "Predicted_sales", {acs}, {bases} FROM w)"""


NB = ["Predicted_sales", *[f"{v}_contribution_impact" for v in ("tv", "web", "promo")], "(Intercept)_contribution_base",
      "traffic_contribution_base", "price_contribution_base"]
SQL_NB = _no_baseline_cte()


def no_baseline(spark, d):
    return attribution.attribution_without_baseline(
        mix_panel(spark, d), "day", "seg", FIXED, FIXED_INTERCEPT, ["traffic", "price"], _random(spark))


def _round_all(df, digits, names):
    return df.select(*[c for c in df.columns if c not in names], *[F.round(F.col(f"`{c}`"), digits).alias(c) for c in names])


@query("attr_no_baseline", "WITH " + SQL_NB + " SELECT seg, day, " + ", ".join(f'round("{c}", 7) AS "{c}"' for c in NB) + " FROM nb")
def attr_no_baseline(spark, d):
    return _round_all(no_baseline(spark, d), 7, NB)


def _with_baseline_sql():
    t = {v: f"({v} * {b})" for v, b in FIXED.items()}
    base = {"tv": "btv", "web": "bweb", "price": "0.2", "promo": "0.0"}
    p = f"({' + '.join(t.values())} + {FIXED_INTERCEPT} + rnd)"
    pb = "(" + " + ".join(f"{base.get(v, v)} * {b}" for v, b in FIXED.items()) + f" + {FIXED_INTERCEPT} + rnd)"
    raw = ", ".join(f"exp({p}) - exp({p} - {t[v]} + {base[v]} * {FIXED[v]}) AS raw_{v}" for v in base)
    size = " + ".join(f"abs(raw_{v})" for v in base)
    rest = f"(pred - predb - ({' + '.join(f'raw_{v}' for v in base)}))"
    acs = ", ".join(f'round(coalesce(raw_{v} + abs(raw_{v}) / nullif({size}, 0) * {rest}, 0), 6) AS "{v}_contribution_inc_base"' for v in base)
    return f"""WITH {SQL_JOINED}, s AS (SELECT avg(tv) AS btv, max(web) AS bweb FROM mx),
      w AS (SELECT j.*, exp({p}) AS pred, exp({pb}) AS predb, {raw} FROM j, s)
      SELECT seg, day, round(pred, 7) AS "Predicted_sales", round(predb, 7) AS "Predicted_baseline_sales",
        0::DOUBLE AS "(Intercept)_contribution_inc_base", {acs} FROM w"""


@query("attr_with_baseline", _with_baseline_sql())
def attr_with_baseline(spark, d):
    out = attribution.attribution_with_baseline(
        mix_panel(spark, d), "day", "seg", FIXED, FIXED_INTERCEPT, _config(spark), _random(spark))
    out = _round_all(out, 6, [c for c in out.columns if c.endswith("_inc_base")])
    return _round_all(out, 7, ["Predicted_sales", "Predicted_baseline_sales"])


def _rollup_sql(label):
    parts = " UNION ALL ".join(
        f"""SELECT seg, {label} AS period, '{c}' AS model_coefficient_name, round(sum("{c}"), 5) AS units,
          round(sum("{c}") / sum("Predicted_sales"), 7) AS pct_units FROM nb GROUP BY 1, 2""" for c in NB)
    return f"WITH {SQL_NB} {parts}"


def _rollup(spark, d, period):
    out = attribution.contribution_rollup(no_baseline(spark, d), "day", "seg", period)
    return rounded(rounded(out, 5, "units"), 7, "pct_units")


@query("contrib_day", _rollup_sql("strftime(day, '%Y-%m-%d')"))
def contrib_day(spark, d):
    return _rollup(spark, d, "day")


@query("contrib_quarter", _rollup_sql("CAST(year(day) AS VARCHAR) || '-Q' || CAST(quarter(day) AS VARCHAR)"))
def contrib_quarter(spark, d):
    return _rollup(spark, d, "quarter")


@query("contrib_year", _rollup_sql("CAST(year(day) AS VARCHAR)"))
def contrib_year(spark, d):
    return _rollup(spark, d, "year")


@query(
    "strip_group_token",
    "SELECT p_partkey, regexp_replace(p_type || '_' || p_brand || '_' || p_name, '_[^_]*$', '') AS variable FROM part",
)
def strip_group_token(spark, d):
    part = table(spark, d, "part")
    return part.select("p_partkey", strip_last_token(F.concat_ws("_", "p_type", "p_brand", "p_name")).alias("variable"))
