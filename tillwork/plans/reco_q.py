"""Recommendation queries: customers as users, product brands as items."""

from pyspark.sql import functions as F

from tillwork.functions.hashing import hash_order
from tillwork.operators import factors, metrics, reco
from tillwork.session import attach_row, materialise

from .eda_q import rounded
from .registry import query, table

BRANDS = [f"Brand#{i}" for i in range(1, 26)]
SQL_BOUGHT = """bt AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, p_brand, l_quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""
SQL_RATINGS = f"""{SQL_BOUGHT}, rt AS (SELECT o_custkey, p_brand, avg(1 + l_quantity % 5) AS rating,
    substr(md5(concat_ws('|', CAST(o_custkey AS VARCHAR), p_brand, '7')), 1, 1) IN ('0', '1', '2') AS held FROM bt GROUP BY 1, 2),
  tr AS (SELECT o_custkey, p_brand, rating FROM rt WHERE NOT held), te AS (SELECT o_custkey, p_brand, rating FROM rt WHERE held)"""


def bought(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    line = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    rows = line.join(orders, line.l_orderkey == orders.o_orderkey).join(part, line.l_partkey == part.p_partkey)
    return rows.select("o_orderkey", "o_custkey", "day", "p_brand", "l_quantity")


def ratings(spark, d):
    """Train and test ratings of customers for brands, split by hash of the pair."""
    rows = bought(spark, d).groupBy("o_custkey", "p_brand").agg(F.avg(1 + F.col("l_quantity") % 5).alias("rating"))
    rows = materialise(rows)  # the models read their ratings several times
    held = F.substring(hash_order(["o_custkey", "p_brand"], 7), 1, 1).isin("0", "1", "2")
    return rows.filter(~held), rows.filter(held)


def all_ratings(spark, d):
    """Every rating, for models that hold none back."""
    train, held = ratings(spark, d)
    return train.unionByName(held)


SQL_RATED = f"""{SQL_BOUGHT}, tr AS (SELECT o_custkey, p_brand, avg(1 + l_quantity % 5) AS rating FROM bt GROUP BY 1, 2)"""
ARGS = ("o_custkey", "p_brand", "rating")


@query("util_long", f"WITH {SQL_BOUGHT} SELECT o_custkey, p_brand, CAST(count(*) AS DOUBLE) AS value FROM bt GROUP BY 1, 2")
def util_long(spark, d):
    return reco.utility(bought(spark, d), "o_custkey", "p_brand")


def _pivot_sql(src):
    cols = ", ".join(f"""CAST(count(*) FILTER (WHERE p_brand = '{b}') AS DOUBLE) AS "p_brand_{b}" """ for b in BRANDS)
    return f"SELECT o_custkey, {cols} FROM {src} GROUP BY 1"


@query("util_pivot", f"WITH {SQL_BOUGHT} {_pivot_sql('bt')}")
def util_pivot(spark, d):
    return reco.utility_matrix(bought(spark, d), "o_custkey", {"p_brand": BRANDS})


@query("util_aligned", f"""WITH {SQL_BOUGHT} SELECT 'train' AS side, * FROM ({_pivot_sql("bt WHERE day < DATE '2000-01-01'")})
    UNION ALL SELECT 'test', * FROM ({_pivot_sql("bt WHERE day >= DATE '2000-01-01'")})""")
def util_aligned(spark, d):
    rows, cut = bought(spark, d), F.lit("2000-01-01").cast("date")
    train, test = reco.aligned_utility(rows.filter(F.col("day") < cut), rows.filter(F.col("day") >= cut), "o_custkey", "p_brand", BRANDS)
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


SQL_KNN = f"""{SQL_BOUGHT}, u AS (SELECT o_custkey, p_brand, CAST(count(*) AS DOUBLE) AS value FROM bt GROUP BY 1, 2),
  nm AS (SELECT o_custkey, sqrt(sum(value * value)) AS n FROM u GROUP BY 1),
  dt AS (SELECT a.o_custkey AS k, b.o_custkey AS nb, sum(a.value * b.value) AS dot FROM u a JOIN u b ON a.p_brand = b.p_brand GROUP BY 1, 2),
  sm AS (SELECT k, nb, round(dot / (x.n * y.n), 9) AS similarity FROM dt JOIN nm x ON k = x.o_custkey JOIN nm y ON nb = y.o_custkey),
  kn AS (SELECT k, nb, similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY similarity DESC, nb) AS rank FROM sm)
    WHERE rank <= 10)"""


def neighbours(spark, d):
    long = reco.utility(bought(spark, d), "o_custkey", "p_brand")
    return long, reco.user_neighbours(long, "o_custkey", "p_brand")


SQL_KNN_PARTS = """u AS (SELECT o_custkey, l_partkey, sum(l_quantity) AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
  nm AS (SELECT o_custkey, sqrt(sum(value * value)) AS n FROM u GROUP BY 1),
  dt AS (SELECT a.o_custkey AS k, b.o_custkey AS nb, sum(a.value * b.value) AS dot FROM u a JOIN u b ON a.l_partkey = b.l_partkey GROUP BY 1, 2),
  sm AS (SELECT k, nb, round(dot / (x.n * y.n), 9) AS similarity FROM dt JOIN nm x ON k = x.o_custkey JOIN nm y ON nb = y.o_custkey)"""


def part_units(spark, d):
    """Units of each part that a customer bought: many items, few of them shared."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    line = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return reco.utility(line.join(orders, line.l_orderkey == orders.o_orderkey), "o_custkey", "l_partkey", "l_quantity", "sum")


@query(
    "user_knn_parts",
    f"""WITH {SQL_KNN_PARTS} SELECT o_custkey, neighbour, similarity, CAST(rank AS INTEGER) AS rank FROM (
      SELECT k AS o_custkey, nb AS neighbour, similarity, row_number() OVER (PARTITION BY k ORDER BY similarity DESC, nb) AS rank FROM sm) WHERE rank <= 5""",
)
def user_knn_parts(spark, d):
    """Nearest customers by the parts they bought."""
    return reco.user_neighbours(part_units(spark, d), "o_custkey", "l_partkey", k=5)


@query("user_knn_work", f"""WITH {SQL_KNN_PARTS} SELECT count(DISTINCT k) AS users, true AS enough, true AS no_more_than_share FROM sm""")
def user_knn_work(spark, d):
    """Pairs that the index left for that search: as many as are returned at least, and no pair more often than it shares items."""
    long = materialise(part_units(spark, d))
    work = reco.neighbour_search(long, "o_custkey", "l_partkey", k=5)[1]
    often = long.groupBy("l_partkey").agg(F.count("*").alias("n")).agg(F.sum(F.col("n") * F.col("n")).alias("terms"))
    found = work.agg(F.sum("users").alias("users"), F.sum("examined").alias("examined"))
    return attach_row(found, often).select("users", (F.col("examined") >= F.col("users")).alias("enough"),
                                           (F.col("examined") <= F.col("terms")).alias("no_more_than_share"))


@query("user_knn", f"WITH {SQL_KNN} SELECT k AS o_custkey, nb AS neighbour, similarity, CAST(rank AS INTEGER) AS rank FROM kn")
def user_knn(spark, d):
    return neighbours(spark, d)[1]


@query(
    "knn_recommend",
    f"""WITH {SQL_KNN}, m AS (SELECT k, p_brand, sum(value) / 10 AS mean, max(CASE WHEN nb = k THEN value END) AS own
        FROM kn JOIN u ON u.o_custkey = nb GROUP BY 1, 2),
      s AS (SELECT k, p_brand, CASE WHEN own IS NOT NULL AND own <> 0 THEN own WHEN mean > 0 THEN mean ELSE 0 END AS score FROM m),
      f AS (SELECT k, p_brand, CASE WHEN score = 1 THEN -1 ELSE score END AS score FROM s)
    SELECT k AS o_custkey, p_brand, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, p_brand) AS rank FROM f) WHERE rank <= 5""",
)
def knn_recommend(spark, d):
    long, near = neighbours(spark, d)
    return rounded(reco.recommend_from_neighbours(long, near, "o_custkey", "p_brand", 5), 6, "score")


@query(
    "topn_per_user",
    f"""WITH {SQL_BOUGHT}, s AS (SELECT o_custkey, p_brand, sum(l_quantity) AS units FROM bt GROUP BY 1, 2)
    SELECT o_custkey, p_brand, units, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER
      (PARTITION BY o_custkey ORDER BY units DESC, p_brand) AS rank FROM s) WHERE rank <= 3""",
)
def topn_per_user(spark, d):
    units = bought(spark, d).groupBy("o_custkey", "p_brand").agg(F.sum("l_quantity").alias("units"))
    return reco.top_items(units, "o_custkey", "p_brand", "units", 3)


@query(
    "reco_lists",
    f"""WITH {SQL_BOUGHT}, s AS (SELECT o_custkey, p_brand, sum(l_quantity) AS units FROM bt GROUP BY 1, 2),
      t AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY units DESC, p_brand) AS rank FROM s)
    SELECT o_custkey, string_agg(p_brand, ',' ORDER BY rank) AS items, sum(units) AS units FROM t WHERE rank <= 3 GROUP BY 1""",
)
def reco_lists(spark, d):
    """Best items per user as an ordered array, flattened for comparison."""
    lists = reco.as_lists(topn_per_user(spark, d), "o_custkey", "p_brand", "units")
    r = F.col("recommendations")
    return lists.select(
        "o_custkey", F.array_join(F.transform(r, lambda s: s["item"]), ",").alias("items"),
        F.aggregate(r, F.lit(0.0), lambda acc, s: acc + s["score"]).alias("units"))


@query("als_implicit")
def als_implicit(spark, d):
    long = materialise(reco.utility(bought(spark, d), "o_custkey", "p_brand"))  # the model reads it several times
    return reco.als_implicit(long, "o_custkey", "p_brand", "value", 5)


def _scored_sql(body, value, digits=6):
    return f"WITH {SQL_RATINGS}, {body} SELECT te.o_custkey, te.p_brand, te.rating, round({value}, {digits}) AS prediction FROM te"


@query(
    "slope_one",
    _scored_sql(
        """dv AS (SELECT a.p_brand AS i, b.p_brand AS j, avg(a.rating - b.rating) AS dev FROM tr a JOIN tr b
          ON a.o_custkey = b.o_custkey AND a.p_brand <> b.p_brand GROUP BY 1, 2),
        x AS (SELECT t.o_custkey, t.p_brand, avg(dev) AS dev FROM te t JOIN tr r ON t.o_custkey = r.o_custkey
          JOIN dv ON i = t.p_brand AND j = r.p_brand GROUP BY 1, 2),
        mu AS (SELECT o_custkey, avg(rating) AS mu FROM tr GROUP BY 1), al AS (SELECT avg(rating) AS a FROM tr)""",
        "coalesce(mu, a) + coalesce(dev, 0)")
    + " LEFT JOIN mu ON mu.o_custkey = te.o_custkey LEFT JOIN x ON x.o_custkey = te.o_custkey AND x.p_brand = te.p_brand, al",
)
def slope_one(spark, d):
    train, test = ratings(spark, d)
    return rounded(reco.slope_one(train, test, *ARGS), 6, "prediction")


def _baseline_sql(epochs):
    parts = ["mn AS (SELECT avg(rating) AS m FROM tr)", "u0 AS (SELECT DISTINCT o_custkey, 0.0::DOUBLE AS bu FROM tr)"]
    for e in range(1, epochs + 1):
        parts.append(f"i{e} AS (SELECT p_brand, sum(rating - m - bu) / (10 + count(*)) AS bi FROM tr JOIN u{e - 1} USING (o_custkey), mn GROUP BY 1)")
        parts.append(f"u{e} AS (SELECT o_custkey, sum(rating - m - bi) / (15 + count(*)) AS bu FROM tr JOIN i{e} USING (p_brand), mn GROUP BY 1)")
    return ", ".join(parts)


SQL_BASELINE = _baseline_sql(3)
SQL_BASE_JOIN = " LEFT JOIN u3 ON u3.o_custkey = te.o_custkey LEFT JOIN i3 ON i3.p_brand = te.p_brand, mn"


@query("baseline_only", _scored_sql(SQL_BASELINE, "m + coalesce(bu, 0) + coalesce(bi, 0)") + SQL_BASE_JOIN)
def baseline_only(spark, d):
    train, test = ratings(spark, d)
    return rounded(reco.fit_predict("baselineonly", train, test, *ARGS, epochs=3), 6, "prediction")


def _knn_sql(centre, scale="1"):
    return f"""sm AS (SELECT a.p_brand AS i, b.p_brand AS j, 1 / (1 + avg((a.rating - b.rating) * (a.rating - b.rating))) AS sim
        FROM tr a JOIN tr b ON a.o_custkey = b.o_custkey AND a.p_brand <> b.p_brand GROUP BY 1, 2),
      st AS (SELECT p_brand, avg(rating) AS im, CASE WHEN stddev_pop(rating) > 0 THEN stddev_pop(rating) ELSE 1 END AS isd FROM tr GROUP BY 1),
      c AS (SELECT tr.o_custkey, tr.p_brand, (rating - {centre}) / {scale} AS c FROM tr JOIN st ON st.p_brand = tr.p_brand),
      x AS (SELECT t.o_custkey, t.p_brand, sum(sim * c) / sum(sim) AS gain FROM te t JOIN c ON t.o_custkey = c.o_custkey
        JOIN sm ON i = t.p_brand AND j = c.p_brand GROUP BY 1, 2), al AS (SELECT avg(rating) AS a FROM tr)"""


SQL_KNN_JOIN = " LEFT JOIN st ON st.p_brand = te.p_brand LEFT JOIN x ON x.o_custkey = te.o_custkey AND x.p_brand = te.p_brand, al"


@query("knn_means", _scored_sql(_knn_sql("im"), "coalesce(im, a) + coalesce(gain, 0)") + SQL_KNN_JOIN)
def knn_means(spark, d):
    """At most 24 rated brands per customer, fewer than the 40 neighbours that count."""
    train, test = ratings(spark, d)
    return rounded(reco.fit_predict("knnwithmeans", train, test, *ARGS), 6, "prediction")


@query("knn_zscore", _scored_sql(_knn_sql("im", "isd"), "coalesce(im, a) + coalesce(isd, 1) * coalesce(gain, 0)") + SQL_KNN_JOIN)
def knn_zscore(spark, d):
    train, test = ratings(spark, d)
    return rounded(reco.fit_predict("knnwithzscore", train, test, *ARGS), 6, "prediction")


@query("knn_basic", _scored_sql(_knn_sql("0"), "coalesce(gain, a)") + SQL_KNN_JOIN)
def knn_basic(spark, d):
    train, test = ratings(spark, d)
    return rounded(reco.fit_predict("knnbasic", train, test, *ARGS), 6, "prediction")


@query(
    "knn_baseline",
    _scored_sql(
        f"""{_baseline_sql(10)}, sm AS (SELECT a.p_brand AS i, b.p_brand AS j, 1 / (1 + avg((a.rating - b.rating) * (a.rating - b.rating))) AS sim
          FROM tr a JOIN tr b ON a.o_custkey = b.o_custkey AND a.p_brand <> b.p_brand GROUP BY 1, 2),
        c AS (SELECT tr.o_custkey, tr.p_brand, rating - m - bu - bi AS c FROM tr JOIN u10 ON u10.o_custkey = tr.o_custkey
          JOIN i10 ON i10.p_brand = tr.p_brand, mn),
        x AS (SELECT t.o_custkey, t.p_brand, sum(sim * c) / sum(sim) AS gain FROM te t JOIN c ON t.o_custkey = c.o_custkey
          JOIN sm ON i = t.p_brand AND j = c.p_brand GROUP BY 1, 2)""",
        "m + coalesce(bu, 0) + coalesce(bi, 0) + coalesce(gain, 0)")
    + " LEFT JOIN u10 ON u10.o_custkey = te.o_custkey LEFT JOIN i10 ON i10.p_brand = te.p_brand"
    + " LEFT JOIN x ON x.o_custkey = te.o_custkey AND x.p_brand = te.p_brand, mn",
)
def knn_baseline(spark, d):
    train, test = ratings(spark, d)
    return rounded(reco.fit_predict("knnbaseline", train, test, *ARGS), 6, "prediction")


@query("co_clustering")
def co_clustering(spark, d):
    train, test = ratings(spark, d)
    return reco.fit_predict("coclustering", train, test, *ARGS, epochs=3)


def _uniform_sql(tag):
    return (f"(('0x' || substr(md5(concat_ws('|', CAST(te.o_custkey AS VARCHAR), te.p_brand, '42{tag}')), 1, 7))::BIGINT + 0.5)"
            " / 268435456.0")


@query(
    "normal_predictor",
    _scored_sql("st AS (SELECT avg(rating) AS m, stddev_pop(rating) AS s FROM tr)",
                f"m + s * sqrt(-2 * ln({_uniform_sql('a')})) * cos(2 * pi() * {_uniform_sql('b')})") + ", st",
)
def normal_predictor(spark, d):
    train, test = ratings(spark, d)
    return rounded(reco.fit_predict("normalpredictor", train, test, *ARGS), 6, "prediction")


@query("als_explicit")
def als_explicit(spark, d):
    train, test = ratings(spark, d)
    return reco.fit_predict("svd", train, test, *ARGS, scale=(1.0, 5.0))


@query("als_nonnegative")
def als_nonnegative(spark, d):
    train, test = ratings(spark, d)
    return reco.fit_predict("nmf", train, test, *ARGS, scale=(1.0, 5.0))


@query(
    "rank_unseen",
    f"""WITH {SQL_RATED}, {SQL_BASELINE}, br AS (SELECT DISTINCT p_brand FROM tr),
      c AS (SELECT u.o_custkey, b.p_brand, round(m + coalesce(bu, 0) + coalesce(bi, 0), 9) AS p FROM u3 u CROSS JOIN br b
        LEFT JOIN i3 ON i3.p_brand = b.p_brand, mn
        WHERE NOT EXISTS (SELECT 1 FROM tr WHERE tr.o_custkey = u.o_custkey AND tr.p_brand = b.p_brand))
    SELECT o_custkey, p_brand, round(p, 6) AS prediction, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER
      (PARTITION BY o_custkey ORDER BY p DESC, p_brand) AS rank FROM c) WHERE rank <= 3""",
)
def rank_unseen(spark, d):
    """Best three unseen brands per customer by the baseline model."""
    train = all_ratings(spark, d)
    users, brands = train.select("o_custkey").distinct(), train.select("p_brand").distinct()
    targets = reco.unseen_items(users, train, brands, "o_custkey", "p_brand")
    scored = reco.fit_predict("baselineonly", train, targets, *ARGS, epochs=3)
    return rounded(reco.top_items(rounded(scored, 9, "prediction"), "o_custkey", "p_brand", "prediction", 3), 6, "prediction")


@query(
    "rank_given",
    f"""WITH {SQL_RATED}, {SQL_BASELINE}, br AS (SELECT DISTINCT p_brand FROM tr),
      c AS (SELECT u.o_custkey, b.p_brand, round(m + coalesce(bu, 0) + coalesce(bi, 0), 9) AS p FROM u3 u CROSS JOIN br b
        LEFT JOIN i3 ON i3.p_brand = b.p_brand, mn)
    SELECT o_custkey, count(*) AS n_ranked, round(max(p), 6) AS best, round(min(p), 6) AS worst FROM c GROUP BY 1""",
)
def rank_given(spark, d):
    """All brands ranked for every customer, those rated before too."""
    train = all_ratings(spark, d)
    users, brands = train.select("o_custkey").distinct(), train.select("p_brand").distinct()
    ranked = reco.rank_items("baselineonly", train, users, brands, *ARGS, epochs=3)
    best = rounded(ranked, 9, "prediction").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_ranked"), F.max("prediction").alias("best"), F.min("prediction").alias("worst"))
    return rounded(best, 6, "best", "worst")


@query("reco_compare")
def reco_compare(spark, d):
    """All models over three folds, as the surveyed flow compares them."""
    return reco.compare_models(all_ratings(spark, d), *ARGS)


@query(
    "reco_scores",
    f"""WITH {SQL_RATINGS}, {SQL_BASELINE}, a AS (SELECT 'train' AS side, * FROM tr UNION ALL SELECT 'test', * FROM te),
      p AS (SELECT side, rating, m + coalesce(bu, 0) + coalesce(bi, 0) AS p FROM a LEFT JOIN u3 ON u3.o_custkey = a.o_custkey
        LEFT JOIN i3 ON i3.p_brand = a.p_brand, mn)
    SELECT side, count(*) AS n, round(sqrt(avg((rating - p) * (rating - p))), 8) AS rmse, round(avg(abs(rating - p)), 8) AS mae
    FROM p GROUP BY 1""",
)
def reco_scores(spark, d):
    train, test = ratings(spark, d)
    model = reco.baselines(train, *ARGS, epochs=3)
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    scored = reco.predict_baseline(both, model, "o_custkey", "p_brand")
    out = metrics.regression_metrics(scored, "rating", "prediction", ["side"]).select("side", "n", "rmse", "mae")
    return rounded(out, 8, "rmse", "mae")


SQL_POPULAR = f"""{SQL_BOUGHT}, tr AS (SELECT * FROM bt WHERE day < DATE '2000-01-01'),
    te AS (SELECT DISTINCT o_custkey, p_brand FROM bt WHERE day >= DATE '2000-01-01'),
    pp AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS rank FROM tr GROUP BY 1),
    hits AS (SELECT o_custkey, rank, row_number() OVER (PARTITION BY o_custkey ORDER BY rank) AS hit FROM te
      JOIN pp ON te.p_brand = pp.p_brand WHERE rank <= 10),
    ap AS (SELECT t.o_custkey, t.n AS n_relevant, coalesce(g, 0) / t.n AS avg_precision FROM
      (SELECT o_custkey, count(*) AS n FROM te GROUP BY 1) t LEFT JOIN
      (SELECT o_custkey, sum(hit / rank) AS g FROM hits GROUP BY 1) h ON h.o_custkey = t.o_custkey)"""


def _popular(spark, d):
    """The ten most popular brands of the training period, recommended to every later customer."""
    rows, cut = bought(spark, d), F.lit("2000-01-01").cast("date")
    best = rows.filter(F.col("day") < cut).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    best = best.orderBy(F.desc("n"), "p_brand").limit(10)
    listed = best.agg(F.transform(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "p_brand"))), lambda s: s["p_brand"]).alias("brands"))
    test = rows.filter(F.col("day") >= cut).select("o_custkey", "p_brand")
    users = test.select("o_custkey").distinct()
    shown = attach_row(users, listed).select("o_custkey", F.posexplode("brands").alias("rank", "p_brand"))
    return shown.withColumn("rank", F.col("rank") + 1), test


@query("avg_precision", f"WITH {SQL_POPULAR} SELECT o_custkey, n_relevant, round(avg_precision, 9) AS avg_precision FROM ap")
def avg_precision(spark, d):
    shown, test = _popular(spark, d)
    return rounded(metrics.precision_at_k(shown, test, "o_custkey", "p_brand", "rank", 10), 9, "avg_precision")


@query("map_at_k", f"WITH {SQL_POPULAR} SELECT count(*) AS n_users, round(avg(avg_precision), 9) AS map_at_k FROM ap")
def map_at_k(spark, d):
    shown, test = _popular(spark, d)
    return rounded(metrics.map_at_k(shown, test, "o_custkey", "p_brand", "rank", 10), 9, "map_at_k")


@query(
    "rating_rescale",
    """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, min(l_quantity) OVER () AS lo, max(l_quantity) OVER () AS hi
      FROM lineitem), s AS (SELECT *, (l_quantity - lo) / (hi - lo) * 4 + 1 AS scaled FROM r)
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, round(scaled, 9) AS scaled, round((scaled - 1) / 4 * (hi - lo) + lo, 9) AS restored,
      greatest(2.0, least(4.0, round(scaled, 9))) AS clamped FROM s""",
)
def rating_rescale(spark, d):
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    out = reco.rescale_inverse(reco.rescale(line, "l_quantity", 1.0, 5.0, "scaled"), "scaled", 1.0, 5.0, "restored")
    out = rounded(out.drop("_from", "_to"), 9, "scaled", "restored")
    return out.withColumn("clamped", reco.clamp(F.col("scaled"), 2.0, 4.0))


@query(
    "neighbour_mean",
    f"""WITH {SQL_BOUGHT}, e AS (SELECT DISTINCT o_custkey, p_brand FROM bt),
      a AS (SELECT p_brand, avg(c_acctbal) AS f FROM e JOIN customer ON c_custkey = o_custkey GROUP BY 1)
    SELECT o_custkey, round(avg(f), 6) AS c_acctbal FROM e JOIN a ON e.p_brand = a.p_brand GROUP BY 1""",
)
def neighbour_mean(spark, d):
    features = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    return rounded(reco.two_hop_mean(bought(spark, d), "o_custkey", "p_brand", features, ["c_acctbal"]), 6, "c_acctbal")


@query(
    "top_inner_products",
    """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL)
    SELECT a.vec_id AS query_id, b.vec_id AS vec_id, round(list_inner_product(a.v, b.v), 8) AS score,
      CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY list_inner_product(a.v, b.v) DESC, b.vec_id) AS INTEGER) AS rank
    FROM e a, e b WHERE a.vec_id % 20 = 0 QUALIFY rank <= 10""",
)
def top_inner_products(spark, d):
    """The vectors with the largest inner products for every twentieth one."""
    rows = table(spark, d, "embeddings").select("vec_id", "embedding")
    asked = rows.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    return rounded(factors.best_products(asked, rows, "query_id", "vec_id", "embedding", 10)[0], 8, "score")


@query("als_map_at_k", f"WITH {SQL_RATINGS} SELECT count(DISTINCT o_custkey) AS n_users, true AS a_share, true AS whole_lists, true AS unseen FROM te")
def als_map_at_k(spark, d):
    """Mean average precision at 10 of the fitted implicit model on the held-out part: a share, from whole lists of unseen brands."""
    train, test = (materialise(t) for t in ratings(spark, d))
    shown = materialise(reco.als_implicit(train, "o_custkey", "p_brand", "rating", 10))
    score = metrics.map_at_k(shown, test, "o_custkey", "p_brand", "rank", 10)
    sizes = train.groupBy("o_custkey").agg(F.least(F.lit(25) - F.count("*"), F.lit(10)).alias("wanted"))
    lists = sizes.join(shown.groupBy("o_custkey").agg(F.count("*").alias("n")), "o_custkey", "left")
    whole = lists.agg(F.every(F.coalesce("n", F.lit(0)) == F.col("wanted")).alias("whole_lists"))
    again = shown.join(train, ["o_custkey", "p_brand"], "left_semi").agg((F.count("*") == 0).alias("unseen"))
    return attach_row(attach_row(score, whole), again).select(
        "n_users", F.col("map_at_k").between(0.0, 1.0).alias("a_share"), "whole_lists", "unseen")


@query("svd_quality", f"WITH {SQL_RATINGS} SELECT count(*) AS n, true AS learns, true AS generalises FROM te")
def svd_quality(spark, d):
    """Biased factors against the biases alone: nearer to the ratings they learn from, and hardly farther from held-out ones."""
    train, test = (materialise(t) for t in ratings(spark, d))
    models = [factors.biased_factors(train, *ARGS), reco.baselines(train, *ARGS)]
    errors = []
    for rows in (train, test):
        by_factors = factors.predict_factors(rows, models[0], *ARGS[:2], name="by_factors")
        both = reco.predict_baseline(by_factors, models[1], *ARGS[:2], name="by_biases")
        errors.append(both.agg(F.count("*").alias("n"), *[F.sqrt(F.avg((F.col(c) - F.col("rating")) ** 2)).alias(c) for c in ("by_factors", "by_biases")]))
    seen, held = errors[0].select(F.col("by_factors").alias("f"), F.col("by_biases").alias("b")), errors[1]
    return attach_row(held, seen).select("n", (F.col("f") < F.col("b")).alias("learns"), (F.col("by_factors") < 1.02 * F.col("by_biases")).alias("generalises"))
