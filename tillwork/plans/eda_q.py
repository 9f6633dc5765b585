"""Exploratory queries."""

import itertools

from pyspark.sql import functions as F

from tillwork.operators import clean, eda, roi

from .registry import query, table

NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SQL_DOCS = """docs AS (SELECT d.doc_id, lang, source, CAST(n_chars AS DOUBLE) AS n_chars, quality, toxic
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def docs(spark, d):
    labels = table(spark, d, "labels")
    return table(spark, d, "documents").select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars")).join(labels, "doc_id")


def rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _pairs_sql(pairs, fn, name, digits=9):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round({fn}({a}, {b}), {digits}) AS {name} FROM lineitem" for a, b in pairs)


@query("idv_dv_corr", _pairs_sql([(a, "l_extendedprice") for a in ("l_quantity", "l_discount", "l_tax")], "corr", "corr"))
def idv_dv_corr(spark, d):
    out = eda.idv_dv_correlation(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"], ["l_extendedprice"])
    return rounded(out, 9, "corr")


SQL_R = """r AS (SELECT corr(l_quantity, l_discount) AS r12, corr(l_quantity, l_tax) AS r13, corr(l_discount, l_tax) AS r23,
    corr(l_quantity, l_extendedprice) AS y1, corr(l_discount, l_extendedprice) AS y2, corr(l_tax, l_extendedprice) AS y3
    FROM lineitem)"""


@query(
    "vif",
    f"""WITH {SQL_R}, k AS (SELECT *, 1 + 2 * r12 * r13 * r23 - r12 * r12 - r13 * r13 - r23 * r23 AS det FROM r)
    SELECT 'l_quantity' AS variable, round_even((1 - r23 * r23) / det, 2) AS vif, round_even(y1, 2) AS corr_dv FROM k
    UNION ALL SELECT 'l_discount', round_even((1 - r13 * r13) / det, 2), round_even(y2, 2) FROM k
    UNION ALL SELECT 'l_tax', round_even((1 - r12 * r12) / det, 2), round_even(y3, 2) FROM k""",
)
def vif(spark, d):
    return eda.vif(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")


@query("corr_table", "SELECT *, abs(corr) AS abs_corr FROM (" + _pairs_sql(itertools.combinations(NUMS, 2), "corr", "corr") + ")")
def corr_table(spark, d):
    return rounded(eda.correlation_table(table(spark, d, "lineitem"), NUMS), 9, "corr", "abs_corr")


@query("cov_table", _pairs_sql([(a, b) for i, a in enumerate(NUMS) for b in NUMS[i:]], "covar_samp", "cov", 4))
def cov_table(spark, d):
    return rounded(eda.covariance_table(table(spark, d, "lineitem"), NUMS), 4, "cov")


SQL_CORR4 = """c AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS a, abs(corr(l_quantity, g)) AS b,
    abs(corr(l_extendedprice, g)) AS e FROM (SELECT *, l_extendedprice * (1 - l_discount) AS g FROM lineitem))"""


def _gross(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("gross"))


@query(
    "correlated_cols",
    f"""WITH {SQL_CORR4} SELECT DISTINCT "column" FROM (
      SELECT 'l_extendedprice' AS "column" FROM c WHERE a > 0.8
      UNION ALL SELECT 'gross' FROM c WHERE b > 0.8 OR e > 0.8)""",
)
def correlated_cols(spark, d):
    return eda.correlated_with_earlier(_gross(spark, d), 0.8, ["l_quantity", "l_extendedprice", "gross"])


@query(
    "decorrelate",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, round(l_extendedprice * (1 - l_discount), 4) AS gross FROM lineitem""",
)
def decorrelate(spark, d):
    """The column correlated with a later one goes."""
    out = eda.decorrelate(_gross(spark, d), 0.9, ["l_quantity", "l_extendedprice", "gross"])
    return rounded(out, 4, "gross")


@query("vif_prune")
def vif_prune(spark, d):
    line = table(spark, d, "lineitem").select(
        *NUMS, (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("gross"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("charged"))
    return eda.vif_prune(line, [*NUMS, "gross", "charged"], 15.0)[1]


@query(
    "woe_iv",
    f"""WITH {SQL_DOCS}, g AS (SELECT source, count(*) FILTER (WHERE quality = 0) AS n0,
        count(*) FILTER (WHERE quality = 1) AS n1 FROM docs GROUP BY 1),
      p AS (SELECT *, n0 / (SELECT sum(n0) FROM g) AS p0, n1 / (SELECT sum(n1) FROM g) AS p1 FROM g)
    SELECT source, n0, n1, CASE WHEN n0 > 0 AND n1 > 0 THEN round(ln(p0 / p1), 9) END AS woe,
      CASE WHEN n0 > 0 AND n1 > 0 THEN round((p0 - p1) * ln(p0 / p1), 9) END AS iv FROM p""",
)
def woe_iv(spark, d):
    return rounded(eda.woe_table(docs(spark, d), "source", "quality"), 9, "woe", "iv")


@query(
    "iv_table",
    f"""WITH {SQL_DOCS}, l AS (SELECT 'source' AS feature, source AS level, quality FROM docs
        UNION ALL SELECT 'lang', lang, quality FROM docs),
      g AS (SELECT feature, level, count(*) FILTER (WHERE quality = 0) AS n0,
        count(*) FILTER (WHERE quality = 1) AS n1 FROM l GROUP BY ALL),
      p AS (SELECT *, n0 / sum(n0) OVER (PARTITION BY feature) AS p0, n1 / sum(n1) OVER (PARTITION BY feature) AS p1 FROM g)
    SELECT feature, round(sum((p0 - p1) * ln(p0 / p1)) FILTER (WHERE n0 > 0 AND n1 > 0), 9) AS iv FROM p GROUP BY 1""",
)
def iv_table(spark, d):
    return rounded(eda.information_value(docs(spark, d), ["source", "lang"], "quality"), 9, "iv")


@query(
    "corr_ratio",
    """WITH g AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS m FROM orders GROUP BY 1),
      t AS (SELECT avg(o_totalprice) AS gm, var_pop(o_totalprice) * count(*) AS ss FROM orders)
    SELECT round(sqrt(sum(n * (m - gm) * (m - gm)) / max(ss)), 9) AS eta FROM g, t""",
)
def corr_ratio(spark, d):
    return rounded(eda.correlation_ratio(table(spark, d, "orders"), "o_orderpriority", "o_totalprice"), 9, "eta")


@query(
    "density_table",
    """WITH s AS (SELECT avg(o_totalprice) AS mean, quantile_cont(o_totalprice, 0.5) AS median,
        stddev_samp(o_totalprice) AS sd, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders)
    SELECT 'o_totalprice' AS "column", CAST(least(floor((o_totalprice - low) / (high - low) * 10) + 1, 10) AS INTEGER) AS bin,
      count(*) AS n, round(max(mean), 6) AS mean, round(max(median), 6) AS median, round(max(sd), 6) AS sd,
      max(low) AS low, max(high) AS high FROM orders, s GROUP BY ALL""",
)
def density_table(spark, d):
    return rounded(eda.density_table(table(spark, d, "orders"), ["o_totalprice"]), 6, "mean", "median", "sd")


def _percentile_sql(column, src):
    points = [("median", 0.5)] + [(f"p{p:g}", p) for p in (0.2, 0.4, 0.6, 0.8, 1.0, 99.0, 99.2, 99.4, 99.6, 99.8)]
    parts = [f"""SELECT '{column}' AS "column", '{k}' AS metric, round(CAST({e} AS DOUBLE), 6) AS value FROM {src}"""
             for k, e in [("mean", f"avg({column})"), ("sd", f"stddev_samp({column})"),
                          ("min", f"min({column})"), ("max", f"max({column})")]]
    for k, p in points:
        q = p if k == "median" else f"{p} / 100"
        parts.append(f"""SELECT '{column}', '{k}', round(quantile_cont({column}, CAST({q} AS DOUBLE)), 6) FROM {src}""")
    return " UNION ALL ".join(parts)


@query("percentile_table", _percentile_sql("o_totalprice", "orders"))
def percentile_table(spark, d):
    return rounded(eda.percentile_table(table(spark, d, "orders"), ["o_totalprice"]), 6, "value")


@query(
    "freq_top10",
    """WITH l AS (SELECT 'p_name' AS "column", p_name AS value FROM part UNION ALL SELECT 'p_brand', p_brand FROM part
        UNION ALL SELECT 'p_type', p_type FROM part),
      c AS (SELECT "column", value, count(*) AS n FROM l GROUP BY ALL)
    SELECT "column", value, n, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER
      (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM c) WHERE rank <= 10""",
)
def freq_top10(spark, d):
    return eda.frequency_top(table(spark, d, "part"))


@query(
    "bivar_cat_cat",
    """SELECT o_orderpriority, o_orderstatus, count(*) AS n,
      round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 9) AS share FROM orders GROUP BY 1, 2""",
)
def bivar_cat_cat(spark, d):
    return rounded(eda.bivariate_counts(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus"), 9, "share")


@query(
    "bivar_cat_num",
    """SELECT o_orderpriority, min(o_totalprice) AS min, round(quantile_cont(o_totalprice, 0.25), 6) AS q1,
      round(quantile_cont(o_totalprice, 0.5), 6) AS median, round(quantile_cont(o_totalprice, 0.75), 6) AS q3,
      max(o_totalprice) AS max, count(o_totalprice) AS n, round(avg(o_totalprice), 6) AS mean FROM orders GROUP BY 1""",
)
def bivar_cat_num(spark, d):
    out = eda.bivariate_box(table(spark, d, "orders"), "o_orderpriority", "o_totalprice")
    return rounded(out, 6, "q1", "median", "q3", "mean")


@query(
    "bivar_num_num",
    """WITH s AS (SELECT min(l_quantity) AS a, max(l_quantity) AS b, min(l_extendedprice) AS c, max(l_extendedprice) AS e
      FROM lineitem)
    SELECT CAST(least(floor((l_quantity - a) / (b - a) * 10) + 1, 10) AS INTEGER) AS bin_x,
      CAST(least(floor((l_extendedprice - c) / (e - c) * 10) + 1, 10) AS INTEGER) AS bin_y, count(*) AS n
    FROM lineitem, s GROUP BY ALL""",
)
def bivar_num_num(spark, d):
    return eda.bivariate_grid(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice")


@query(
    "butterfly",
    f"""WITH {SQL_DOCS}, g AS (SELECT lang, count(*) FILTER (WHERE quality = 0) AS n0,
      count(*) FILTER (WHERE quality = 1) AS n1 FROM docs GROUP BY 1)
    SELECT *, round(n0 / (SELECT sum(n0) FROM g), 9) AS share0, round(n1 / (SELECT sum(n1) FROM g), 9) AS share1 FROM g""",
)
def butterfly(spark, d):
    return rounded(eda.butterfly(docs(spark, d), "lang", "quality"), 9, "share0", "share1")


@query("target_corr", f"""WITH {SQL_DOCS} SELECT 'n_chars' AS x, 'quality' AS y, round(corr(n_chars, quality), 9) AS corr FROM docs
    UNION ALL SELECT 'toxic', 'quality', round(corr(toxic, quality), 9) FROM docs""")
def target_corr(spark, d):
    return rounded(eda.idv_dv_correlation(docs(spark, d), ["n_chars", "toxic"], ["quality"]), 9, "corr")


_EDGES = ", ".join(f"quantile_cont(n_chars, {i / 10}) AS e{i}" for i in range(1, 10))
_BIN = "1 + " + " + ".join(f"CAST(n_chars > e{i} AS INTEGER)" for i in range(1, 10))


def _h(a, b):
    return (f"(CASE WHEN {a} > 0 THEN -({a}/({a}+{b})) * ln({a}/({a}+{b})) ELSE 0 END + "
            f"CASE WHEN {b} > 0 THEN -({b}/({a}+{b})) * ln({b}/({a}+{b})) ELSE 0 END)")


@query(
    "info_gain",
    f"""WITH {SQL_DOCS}, e AS (SELECT {_EDGES} FROM docs), b AS (SELECT {_BIN} AS bin, quality FROM docs, e),
      c AS (SELECT bin, count(*) FILTER (WHERE quality = 0) AS n0, count(*) FILTER (WHERE quality = 1) AS n1 FROM b GROUP BY 1),
      t AS (SELECT sum(n0) AS t0, sum(n1) AS t1, sum((n0 + n1) * {_h('n0', 'n1')}) AS inner_h FROM c)
    SELECT 'n_chars' AS feature, round({_h('t0', 't1')} - inner_h / (t0 + t1), 9) AS info_gain FROM t""",
)
def info_gain(spark, d):
    return rounded(eda.information_gain(docs(spark, d), ["n_chars"], "quality"), 9, "info_gain")


def _normal_sql(columns):
    parts = []
    for c in columns:
        parts.append(f"""SELECT '{c}' AS "column", count(*) AS n,
          avg(pow(x, 3)) / pow(avg(x * x), 1.5) AS s, avg(pow(x, 4)) / pow(avg(x * x), 2) - 3 AS k
          FROM (SELECT {c} - (SELECT avg({c}) FROM lineitem) AS x FROM lineitem)""")
    return """SELECT "column", n, round(s, 8) AS skewness, round(k, 8) AS kurtosis,
      round(n / 6 * (s * s + k * k / 4), 4) AS jarque_bera FROM (""" + " UNION ALL ".join(parts) + ")"


@query("normality", _normal_sql(NUMS))
def normality(spark, d):
    return rounded(rounded(eda.normality(table(spark, d, "lineitem"), NUMS), 8, "skewness", "kurtosis"), 4, "jarque_bera")


@query(
    "segmented_summary",
    """SELECT o_orderpriority, 'o_totalprice' AS "column", count(o_totalprice) AS n,
      count(*) - count(o_totalprice) AS n_missing, round(avg(o_totalprice), 6) AS mean,
      round(stddev_samp(o_totalprice), 6) AS sd, round(quantile_cont(o_totalprice, 0.25), 6) AS q1,
      round(quantile_cont(o_totalprice, 0.5), 6) AS median, round(quantile_cont(o_totalprice, 0.75), 6) AS q3
    FROM orders GROUP BY 1""",
)
def segmented_summary(spark, d):
    out = eda.segmented_summary(table(spark, d, "orders"), "o_orderpriority", ["o_totalprice"])
    return rounded(out, 6, "mean", "sd", "q1", "median", "q3")


@query(
    "ts_summary",
    """SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS period, count(*) AS n, round(sum(value), 4) AS total,
      round(avg(value), 8) AS mean FROM events GROUP BY ALL""",
)
def ts_summary(spark, d):
    out = eda.series_summary(table(spark, d, "events"), "ts", "value", ["event_type"])
    return out.withColumns({"total": F.round("total", 4), "mean": F.round("mean", 8)})


@query(
    "ts_gaps",
    """WITH d AS (SELECT DISTINCT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events),
      s AS (SELECT user_id, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS gap FROM d GROUP BY 1)
    SELECT user_id, gap FROM s WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.user_id = s.user_id AND d.day = s.gap)""",
)
def ts_gaps(spark, d):
    return eda.series_gaps(table(spark, d, "events"), "ts", ["user_id"])


SQL_SCORED = f"""{SQL_DOCS}, scored AS (SELECT *, CAST(1 / (1 + exp(-(n_chars - 1000) / 500)) > 0.5 AS INTEGER) AS pred,
    1 / (1 + exp(-(n_chars - 1000) / 500)) AS score FROM docs)"""


def scored_docs(spark, d):
    score = 1 / (1 + F.exp(-(F.col("n_chars") - 1000) / 500))
    return docs(spark, d).withColumn("score", score).withColumn("pred", (F.col("score") > 0.5).cast("int"))


@query(
    "confusion_by_feature",
    f"""WITH {SQL_SCORED}, c AS (SELECT source, count(*) AS n,
        count(*) FILTER (WHERE quality = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE quality = 1 AND pred = 1) AS tp,
        count(*) FILTER (WHERE quality = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE quality = 0 AND pred = 1) AS fp
        FROM scored GROUP BY 1),
      t AS (SELECT sum(n) AS n, nullif(sum(tn), 0) AS tn, nullif(sum(tp), 0) AS tp, nullif(sum(fn), 0) AS fn,
        nullif(sum(fp), 0) AS fp FROM c)
    SELECT source, round_even(c.tn / t.tn / (c.n / t.n) * 100, 0) AS "TN", round_even(c.tp / t.tp / (c.n / t.n) * 100, 0) AS "TP",
      round_even(c.fn / t.fn / (c.n / t.n) * 100, 0) AS "FN", round_even(c.fp / t.fp / (c.n / t.n) * 100, 0) AS "FP" FROM c, t""",
)
def confusion_by_feature(spark, d):
    return eda.confusion_by_feature(scored_docs(spark, d), "quality", "pred", "source")


@query(
    "residual_by_feature",
    """WITH f AS (SELECT l_returnflag, CASE WHEN l_extendedprice > 100 AND 1500 * l_quantity > l_extendedprice * 1.3 THEN 'o'
        WHEN l_extendedprice > 100 AND 1500 * l_quantity < l_extendedprice * 0.7 THEN 'u' ELSE 'g' END AS flag FROM lineitem),
      c AS (SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE flag = 'g') AS g, count(*) FILTER (WHERE flag = 'o') AS o,
        count(*) FILTER (WHERE flag = 'u') AS u FROM f GROUP BY 1),
      t AS (SELECT sum(n) AS n, sum(g) AS g, sum(o) AS o, sum(u) AS u FROM c)
    SELECT l_returnflag, round_even(c.g / t.g / (c.n / t.n) * 100, 0) AS good,
      round_even(c.o / t.o / (c.n / t.n) * 100, 0) AS "over predict",
      round_even(c.u / t.u / (c.n / t.n) * 100, 0) AS "under predict" FROM c, t""",
)
def residual_by_feature(spark, d):
    line = table(spark, d, "lineitem").select(
        "l_returnflag", "l_extendedprice", (F.lit(1500.0) * F.col("l_quantity")).alias("yhat"))
    return eda.residual_by_feature(clean.forecast_flags(line, "l_extendedprice", "yhat"), "l_returnflag", "forecast_flag")


@query(
    "class_hist",
    f"""WITH {SQL_DOCS}, s AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM docs)
    SELECT CAST(least(floor((n_chars - lo) / (hi - lo) * 10) + 1, 10) AS INTEGER) AS bin, quality, count(*) AS n
    FROM docs, s GROUP BY ALL""",
)
def class_hist(spark, d):
    return eda.class_histogram(docs(spark, d), "n_chars", "quality")


COEF = {"l_quantity": 1400.0, "l_discount": -900.0, "l_tax": 350.0}


@query(
    "contribution",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(sum({c}) * {b} / sum(l_extendedprice), 9) AS contribution FROM lineitem"
        for c, b in COEF.items()),
)
def contribution(spark, d):
    return rounded(roi.contribution(table(spark, d, "lineitem"), "l_extendedprice", COEF), 9, "contribution")


@query(
    "roi",
    """SELECT round((sum(l_quantity) * 1400.0 + sum(l_tax) * 350.0) / sum(l_extendedprice * l_discount), 8) AS roi
    FROM lineitem""",
)
def roi_query(spark, d):
    line = table(spark, d, "lineitem").withColumn("cost", F.col("l_extendedprice") * F.col("l_discount"))
    return rounded(roi.roi(line, "l_extendedprice", COEF, ["l_quantity", "l_tax"], "cost"), 8, "roi")


SQL_SEGMENTS = """seg AS (SELECT l_suppkey, avg(l_extendedprice) / 1000 AS coefficient, 0.35 AS margin,
    avg(l_quantity) / 20 AS cost FROM lineitem GROUP BY 1)"""


def _segments(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        (F.avg("l_extendedprice") / 1000).alias("coefficient"), F.lit(0.35).alias("margin"),
        (F.avg("l_quantity") / 20).alias("cost"))


@query(
    "optimal_visits",
    f"""WITH {SQL_SEGMENTS}, s AS (SELECT seg.*, unnest(range(1, 20000)) AS n FROM seg),
      i AS (SELECT l_suppkey, n, (ln(1.0 + n + 1) - ln(1.0 + n)) * coefficient * margin / cost AS inc FROM s)
    SELECT l_suppkey, min(n) FILTER (WHERE inc < 1) - 1 AS step, min(n) FILTER (WHERE inc < 1) AS visits FROM i GROUP BY 1""",
)
def optimal_visits(spark, d):
    return roi.optimal_visits(_segments(spark, d), "l_suppkey", lambda n: F.ln(1.0 + n))


@query(
    "visit_curve",
    f"""WITH {SQL_SEGMENTS}, s AS (SELECT seg.*, CAST(unnest(range(1, 13)) AS INTEGER) AS visits FROM seg),
      c AS (SELECT *, ln(1.0 + visits) * coefficient AS c FROM s)
    SELECT l_suppkey, visits, round(c, 8) AS contribution, round(c * margin / (cost * visits), 8) AS roi,
      round((c - lag(c) OVER (PARTITION BY l_suppkey ORDER BY visits)) * margin / cost, 8) AS incremental_roi FROM c""",
)
def visit_curve(spark, d):
    out = roi.visit_curve(_segments(spark, d), "l_suppkey", lambda n: F.ln(1.0 + n))
    return rounded(out, 8, "contribution", "roi", "incremental_roi")
