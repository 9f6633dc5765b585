"""Outlier, imputation, scaling, encoding and response-curve queries."""

from pyspark.sql import functions as F

from tillwork.operators import prep

from .clean_q import LINE_KEY
from .eda_q import SQL_DOCS, docs, rounded
from .registry import query, table
from .series_q import SQL_PANEL, daily

KEY = ", ".join(LINE_KEY)
# unit price inside lineitem gives both tails some weight
SQL_MARGIN = "lm AS (SELECT " + KEY + ", l_extendedprice * l_discount AS margin, l_tax FROM lineitem)"
SQL_IQR = f"""{SQL_MARGIN}, q AS (SELECT quantile_cont(margin, 0.25) AS q1, quantile_cont(margin, 0.75) AS q3 FROM lm),
    b AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)"""
SQL_Z = f"{SQL_MARGIN}, b AS (SELECT avg(margin) - 3 * stddev_samp(margin) AS lo, avg(margin) + 3 * stddev_samp(margin) AS hi FROM lm)"
SQL_PCT = f"{SQL_MARGIN}, b AS (SELECT quantile_cont(margin, 0.01) AS lo, quantile_cont(margin, 0.99) AS hi FROM lm)"
CAPPED = "round(CASE WHEN margin < lo THEN lo WHEN margin > hi THEN hi ELSE margin END, 5) AS margin"


def margins(spark, d):
    return table(spark, d, "lineitem").select(
        *LINE_KEY, (F.col("l_extendedprice") * F.col("l_discount")).alias("margin"), "l_tax")


def _outliers(spark, d, method, treatment, direction=0):
    return rounded(prep.treat_outliers(margins(spark, d), ["margin"], direction, method, treatment), 5, "margin")


@query("outlier_iqr_detect", f"WITH {SQL_IQR} SELECT {KEY}, round(margin, 5) AS margin, l_tax FROM lm, b WHERE margin < lo OR margin > hi")
def outlier_iqr_detect(spark, d):
    return _outliers(spark, d, "iqr", None)


@query("outlier_iqr_remove", f"WITH {SQL_IQR} SELECT {KEY}, round(margin, 5) AS margin, l_tax FROM lm, b WHERE NOT (margin < lo OR margin > hi)")
def outlier_iqr_remove(spark, d):
    return _outliers(spark, d, "iqr", "remove")


@query("outlier_iqr_cap", f"WITH {SQL_IQR} SELECT {KEY}, {CAPPED}, l_tax FROM lm, b")
def outlier_iqr_cap(spark, d):
    return _outliers(spark, d, "iqr", "cap")


@query("outlier_z_detect", f"WITH {SQL_Z} SELECT {KEY}, round(margin, 5) AS margin, l_tax FROM lm, b WHERE margin > hi")
def outlier_z_detect(spark, d):
    return _outliers(spark, d, "zscore", None, 1)


@query("outlier_z_remove", f"WITH {SQL_Z} SELECT {KEY}, round(margin, 5) AS margin, l_tax FROM lm, b WHERE NOT margin < lo")
def outlier_z_remove(spark, d):
    return _outliers(spark, d, "zscore", "remove", -1)


@query("outlier_z_cap", f"WITH {SQL_Z} SELECT {KEY}, {CAPPED}, l_tax FROM lm, b")
def outlier_z_cap(spark, d):
    return _outliers(spark, d, "zscore", "cap")


@query(
    "outlier_fit_apply",
    f"""WITH {SQL_MARGIN}, tr AS (SELECT margin FROM lm WHERE l_tax < 0.05),
      b AS (SELECT quantile_cont(margin, 0.01) AS lo, quantile_cont(margin, 0.99) AS hi FROM tr)
    SELECT {KEY}, {CAPPED}, l_tax FROM lm, b""",
)
def outlier_fit_apply(spark, d):
    rows = margins(spark, d)
    model = prep.OutlierModel(["margin"], "percentile").fit(rows.filter("l_tax < 0.05"))
    return rounded(model.transform(rows), 5, "margin")


@query(
    "trim_top5",
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice < (SELECT quantile_cont(o_totalprice, 0.95) FROM orders)""",
)
def trim_top5(spark, d):
    return prep.trim_top(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice")


SQL_HOLES = f"""hl AS (SELECT {KEY}, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
    CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag FROM lineitem)"""


def with_holes(spark, d):
    """Line items with missing quantities and flags."""
    return table(spark, d, "lineitem").select(
        *LINE_KEY, F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_returnflag")).alias("l_returnflag"))


@query("impute_mean", f"WITH {SQL_HOLES} SELECT {KEY}, round(coalesce(l_quantity, (SELECT avg(l_quantity) FROM hl)), 8) AS l_quantity, l_returnflag FROM hl")
def impute_mean(spark, d):
    return rounded(prep.impute(with_holes(spark, d), ["l_quantity"], "mean"), 8, "l_quantity")


@query("impute_median", f"WITH {SQL_HOLES} SELECT {KEY}, coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM hl)) AS l_quantity, l_returnflag FROM hl")
def impute_median(spark, d):
    return prep.impute(with_holes(spark, d), ["l_quantity"], "median")


@query(
    "impute_mode",
    f"""WITH {SQL_HOLES}, a AS (SELECT l_returnflag AS f FROM hl WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
      q AS (SELECT l_quantity AS v FROM hl WHERE l_quantity IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT {KEY}, coalesce(l_quantity, v) AS l_quantity, coalesce(l_returnflag, f) AS l_returnflag FROM hl, a, q""",
)
def impute_mode(spark, d):
    return prep.impute(with_holes(spark, d), ["l_quantity", "l_returnflag"], "most_frequent")


@query("impute_const", f"WITH {SQL_HOLES} SELECT {KEY}, coalesce(l_quantity, -1.0) AS l_quantity, coalesce(l_returnflag, '?') AS l_returnflag FROM hl")
def impute_const(spark, d):
    return prep.impute(with_holes(spark, d), ["l_quantity", "l_returnflag"], "constant", {"l_quantity": -1.0, "l_returnflag": "?"})


@query(
    "impute_threshold",
    f"""WITH {SQL_HOLES} SELECT {KEY}, round(coalesce(l_quantity, (SELECT avg(l_quantity) FROM hl)), 8) AS l_quantity FROM hl""",
)
def impute_threshold(spark, d):
    """A fifth of the flags is missing: that column goes, the quantity is filled."""
    return rounded(prep.impute_with_threshold(with_holes(spark, d), 0.18), 8, "l_quantity")


SQL_FLAGGED = f"""fl AS (SELECT {KEY}, l_quantity, l_extendedprice,
    CASE WHEN l_shipdate < TIMESTAMP '2000-01-01' THEN 'train' WHEN l_shipdate < TIMESTAMP '2001-06-01' THEN 'test'
      ELSE 'later' END AS flag FROM lineitem)"""


def flagged(spark, d):
    ship = F.col("l_shipdate")
    flag = F.when(ship < F.lit("2000-01-01").cast("timestamp"), "train").when(
        ship < F.lit("2001-06-01").cast("timestamp"), "test").otherwise("later")
    return table(spark, d, "lineitem").select(*LINE_KEY, "l_quantity", "l_extendedprice", flag.alias("flag"))


def _scale_sql(expr, digits=8):
    return f"""WITH {SQL_FLAGGED}, s AS (SELECT {', '.join(f'max({c}) AS hi_{c}, min({c}) AS lo_{c}, avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in ('l_quantity', 'l_extendedprice'))}
      FROM fl WHERE flag = 'train') SELECT {KEY}, {', '.join(f"round({expr.format(c=c)}, {digits}) AS {c}" for c in ('l_quantity', 'l_extendedprice'))}, flag
      FROM fl, s WHERE flag IN ('train', 'test')"""


def _scaled(spark, d, strategy, digits=8):
    out = prep.scale_columns(flagged(spark, d), ["l_quantity", "l_extendedprice"], strategy, "flag")
    return rounded(out, digits, "l_quantity", "l_extendedprice")


@query("scale_max", _scale_sql("{c} / hi_{c}"))
def scale_max(spark, d):
    return _scaled(spark, d, "custom")


@query("scale_minmax", _scale_sql("({c} - lo_{c}) / (hi_{c} - lo_{c})"))
def scale_minmax(spark, d):
    return _scaled(spark, d, "minmax")


@query("scale_standard", _scale_sql("({c} - m_{c}) / s_{c}", 6))
def scale_standard(spark, d):
    return _scaled(spark, d, "standard", 6)


@query(
    "impute_map",
    """WITH j AS (SELECT d.doc_id, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT doc_id, source, coalesce(quality, (SELECT avg(quality) FROM j)) AS quality, coalesce(toxic, -1)::DOUBLE AS toxic FROM j""",
)
def impute_map(spark, d):
    """Missing labels: the mean for one column, a constant for the other."""
    labels = table(spark, d, "labels").withColumns({c: F.col(c).cast("double") for c in ("quality", "toxic")})
    rows = table(spark, d, "documents").select("doc_id", "source").join(labels, "doc_id", "left")
    return prep.impute_by_method(rows, {"mean": ["quality"], "constant": ["toxic"]}, {"toxic": -1.0})


SQL_BRANDED = """br AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, p_brand, p_type,
    l_quantity, l_extendedprice, l_shipdate,
    l_extendedprice / l_quantity AS price FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def branded(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    line = table(spark, d, "lineitem")
    return line.join(part, line.l_partkey == part.p_partkey).select(
        *LINE_KEY, "p_brand", "p_type", "l_quantity", "l_extendedprice", "l_shipdate", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))


def _encode_sql(c):
    return f"""e_{c} AS (SELECT {c}, CASE WHEN n <= 1 THEN prior ELSE prior * (1 - 1 / (1 + exp(-(n - 1.0)))) + m / (1 + exp(-(n - 1.0))) END AS v
      FROM (SELECT {c}, count(price) AS n, avg(price) AS m FROM tr GROUP BY 1), pr)"""


SQL_ENCODED = f"""{SQL_BRANDED}, tr AS (SELECT * FROM br WHERE l_shipdate < TIMESTAMP '2000-01-01'),
    pr AS (SELECT avg(price) AS prior FROM tr), {_encode_sql('p_brand')}, {_encode_sql('p_type')}"""


def _train(rows):
    """The earlier lines."""
    return rows.filter(F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp"))


@query(
    "target_encode",
    f"""WITH {SQL_ENCODED} SELECT {KEY}, round(coalesce(b.v, prior), 6) AS p_brand, price
    FROM br LEFT JOIN e_p_brand b ON br.p_brand = b.p_brand, pr""",
)
def target_encode(spark, d):
    """Encoding learned from the earlier lines, applied to all."""
    rows = branded(spark, d).select(*LINE_KEY, "p_brand", "l_shipdate", "price")
    out = prep.TargetEncoder(["p_brand"], "price").fit(_train(rows)).transform(rows)
    return rounded(out.drop("l_shipdate"), 6, "p_brand")


@query(
    "feature_table",
    f"""WITH {SQL_ENCODED}, md AS (SELECT quantile_cont(l_quantity, 0.5) AS mq FROM tr)
    SELECT {KEY}, round(coalesce(b.v, prior), 6) AS p_brand, round(coalesce(t.v, prior), 6) AS p_type,
      coalesce(l_quantity, mq) AS l_quantity
    FROM br LEFT JOIN e_p_brand b ON br.p_brand = b.p_brand LEFT JOIN e_p_type t ON br.p_type = t.p_type, pr, md""",
)
def feature_table(spark, d):
    rows = branded(spark, d)
    model = prep.FeatureTable(["p_brand", "p_type"], ["l_quantity"], "price").fit(_train(rows))
    out = model.transform(rows).select(*LINE_KEY, "p_brand", "p_type", "l_quantity")
    return rounded(out, 6, "p_brand", "p_type")


@query(
    "one_hot",
    """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS "o_orderstatus_F", CAST(o_orderstatus = 'O' AS INTEGER)
      AS "o_orderstatus_O", CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P" FROM orders""",
)
def one_hot(spark, d):
    out = prep.one_hot(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O", "P"])
    return out.drop("o_orderstatus")


@query(
    "woe_encode",
    f"""WITH {SQL_DOCS}, e AS (SELECT quantile_cont(n_chars, 0.2) AS e1, quantile_cont(n_chars, 0.4) AS e2,
        quantile_cont(n_chars, 0.6) AS e3, quantile_cont(n_chars, 0.8) AS e4 FROM docs),
      b AS (SELECT *, 1 + CAST(n_chars > e1 AS INTEGER) + CAST(n_chars > e2 AS INTEGER) + CAST(n_chars > e3 AS INTEGER)
        + CAST(n_chars > e4 AS INTEGER) AS bin FROM docs, e),
      g AS (SELECT bin, count(*) FILTER (WHERE quality = 0) AS n0, count(*) FILTER (WHERE quality = 1) AS n1 FROM b GROUP BY 1),
      w AS (SELECT bin, CASE WHEN n0 > 0 AND n1 > 0 THEN ln((n0 / (SELECT sum(n0) FROM g)) / (n1 / (SELECT sum(n1) FROM g)))
        ELSE 0 END AS woe FROM g)
    SELECT doc_id, n_chars, round(woe, 9) AS n_chars_woe FROM b JOIN w ON b.bin = w.bin""",
)
def woe_encode(spark, d):
    rows = docs(spark, d).select("doc_id", "n_chars", "quality")
    out = prep.WoeEncoder(["n_chars"], "quality").fit(rows).transform(rows)
    return rounded(out.drop("quality"), 9, "n_chars_woe")


@query(
    "feature_select",
    """WITH c AS (SELECT l_extendedprice AS x1, l_quantity AS x2, l_discount AS x3, l_tax AS x4, l_extendedprice * (1 - l_discount) AS y
        FROM lineitem),
      k AS (SELECT 'l_extendedprice' AS feature, abs(corr(x1, y)) AS r FROM c UNION ALL SELECT 'l_quantity', abs(corr(x2, y)) FROM c
        UNION ALL SELECT 'l_discount', abs(corr(x3, y)) FROM c UNION ALL SELECT 'l_tax', abs(corr(x4, y)) FROM c)
    SELECT feature FROM k ORDER BY r DESC LIMIT 2""",
)
def feature_select(spark, d):
    """The two features with the strongest univariate test, which orders them as their correlation does."""
    line = table(spark, d, "lineitem").withColumn("revenue", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    names = prep.select_features(line, ["l_extendedprice", "l_quantity", "l_discount", "l_tax"], "revenue", 2)
    return spark.createDataFrame([(n,) for n in names], "feature string")


ALPHAS, BETAS = (1.0, 2.5), (1e-6, 5e-6)


@query(
    "scurve",
    f"WITH {SQL_PANEL} SELECT seg, day, " + ", ".join(
        f"round({a} * (1.0 - exp(-{b!r}::DOUBLE * {c})), 9) AS {c}_alpha{i}_beta{j}"
        for i, a in enumerate(ALPHAS) for j, b in enumerate(BETAS) for c in ("sales", "n_orders")) + " FROM panel",
)
def scurve(spark, d):
    out = prep.s_curves(daily(spark, d), "day", ALPHAS, BETAS, ["seg"])
    return rounded(out, 9, *[c for c in out.columns if c not in ("seg", "day")])


@query(
    "scurve_map",
    f"WITH {SQL_PANEL} SELECT * FROM (" + " UNION ALL ".join(
        [f"SELECT 'alpha{i}' AS \"Name\", {a}::DOUBLE AS \"Value\", round(max({a} * (1.0 - exp(-{BETAS[0]!r}::DOUBLE * sales))), 9) AS top FROM panel"
         for i, a in enumerate(ALPHAS)]
        + [f"SELECT 'beta{j}', {b!r}::DOUBLE, round(max({ALPHAS[0]} * (1.0 - exp(-{b!r}::DOUBLE * sales))), 9) FROM panel"
           for j, b in enumerate(BETAS)]) + ")",
)
def scurve_map(spark, d):
    """Curve parameters, each with the highest response it gives on the daily sales."""
    curves = prep.s_curves(daily(spark, d).drop("n_orders"), "day", ALPHAS, BETAS, ["seg"])
    tops = curves.agg(*[F.max(c).alias(c) for c in curves.columns if c not in ("seg", "day")])
    pairs = [F.struct(F.lit(f"alpha{i}").alias("Name"), F.col(f"sales_alpha{i}_beta0").alias("top")) for i in range(len(ALPHAS))]
    pairs += [F.struct(F.lit(f"beta{j}").alias("Name"), F.col(f"sales_alpha0_beta{j}").alias("top")) for j in range(len(BETAS))]
    tops = tops.select(F.inline(F.array(*pairs)))
    return rounded(prep.s_curve_map(spark, ALPHAS, BETAS).join(tops, "Name"), 9, "top")
