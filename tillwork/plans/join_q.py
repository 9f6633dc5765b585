"""Join, key-set and data-quality queries."""

from pyspark.sql import functions as F

from tillwork.operators import joins, quality, reco

from .registry import query, table


@query(
    "sales_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p_brand, p_type, p_size
    FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def sales_join(spark, d):
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return joins.join_dimension(line, part, [("l_partkey", "p_partkey")], validate=True)


@query(
    "left_join_nulls",
    """SELECT o_orderkey, o_orderpriority, r.urgency FROM orders LEFT JOIN
      (SELECT '1-URGENT' AS k, 1 AS urgency UNION ALL SELECT '2-HIGH', 2 UNION ALL SELECT NULL, 0) r
      ON nullif(o_orderpriority, '5-LOW') IS NOT DISTINCT FROM r.k""",
)
def left_join_nulls(spark, d):
    """Left lookup join in which NULL keys match each other."""
    rank = spark.createDataFrame([("1-URGENT", 1), ("2-HIGH", 2), (None, 0)], "k string, urgency int")
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("key"))
    return joins.join_dimension(orders, rank, [("key", "k")], "left", null_matches=True).drop("key")


@query(
    "orphan_keys",
    "SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def orphan_keys(spark, d):
    """Documents without a label."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return joins.keep_missing(docs, table(spark, d, "labels"), [("doc_id", "doc_id")])


@query(
    "matching_keys",
    "SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def matching_keys(spark, d):
    """Documents with a label."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return joins.keep_matching(docs, table(spark, d, "labels"), [("doc_id", "doc_id")])


@query(
    "set_analyse",
    """WITH a AS (SELECT DISTINCT c_custkey AS k FROM customer),
      b AS (SELECT DISTINCT o_custkey AS k FROM orders)
    SELECT 'A-B' AS region, count(*) AS n FROM (SELECT k FROM a EXCEPT SELECT k FROM b)
    UNION ALL SELECT 'B-A', count(*) FROM (SELECT k FROM b EXCEPT SELECT k FROM a)
    UNION ALL SELECT 'A^B', count(*) FROM (SELECT k FROM a INTERSECT SELECT k FROM b)
    UNION ALL SELECT 'AuB', count(*) FROM (SELECT k FROM a UNION SELECT k FROM b)""",
)
def set_analyse(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    b = table(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    return joins.set_analyse(a, b)


@query(
    "set_analyse_df",
    """WITH a AS (SELECT DISTINCT o_orderkey AS orderkey, CAST(o_orderdate AS DATE) AS day FROM orders),
      b AS (SELECT DISTINCT l_orderkey AS orderkey, CAST(l_shipdate AS DATE) - 30 AS day FROM lineitem),
      f AS (SELECT a.orderkey AS ak, b.orderkey AS bk FROM a FULL OUTER JOIN b USING (orderkey, day))
    SELECT 'A-B' AS region, count(*) FILTER (WHERE bk IS NULL) AS n FROM f
    UNION ALL SELECT 'B-A', count(*) FILTER (WHERE ak IS NULL) FROM f
    UNION ALL SELECT 'A^B', count(*) FILTER (WHERE ak IS NOT NULL AND bk IS NOT NULL) FROM f
    UNION ALL SELECT 'AuB', count(*) FROM f""",
)
def set_analyse_df(spark, d):
    """Two-column keys: orders against line items shipped 30 days after the order."""
    a = table(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey"), F.to_date("o_orderdate").alias("day"))
    b = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.date_sub(F.to_date("l_shipdate"), 30).alias("day"))
    return joins.set_analyse(a, b)


@query(
    "set_members",
    """SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'A-B' ELSE 'B-A' END AS region
    FROM (SELECT DISTINCT doc_id AS k FROM documents) a FULL OUTER JOIN (SELECT DISTINCT doc_id AS k FROM labels) b ON a.k = b.k
    WHERE a.k IS NULL OR b.k IS NULL""",
)
def set_members(spark, d):
    """Ids of documents that are not labelled, and of labels without a document."""
    a, b = (table(spark, d, name).select(F.col("doc_id").alias("k")) for name in ("documents", "labels"))
    return joins.set_analyse(a, b, simplify=False, exceptions_only=True)


@query(
    "merge_expectations",
    """WITH a AS (SELECT c_custkey AS k FROM customer),
      b AS (SELECT o_custkey AS k FROM orders),
      f AS (SELECT a.k AS ak, b.k AS bk FROM (SELECT DISTINCT k FROM a WHERE k IS NOT NULL) a
            FULL OUTER JOIN (SELECT DISTINCT k FROM b WHERE k IS NOT NULL) b ON a.k = b.k)
    SELECT count(*) FILTER (WHERE bk IS NULL) AS a_minus_b, count(*) FILTER (WHERE ak IS NULL) AS b_minus_a,
      count(*) FILTER (WHERE ak IS NOT NULL AND bk IS NOT NULL) AS a_and_b, count(*) AS a_or_b,
      (SELECT bool_or(k IS NULL) FROM a) AS a_nulls, (SELECT bool_or(k IS NULL) FROM b) AS b_nulls,
      true AS types_match,
      (SELECT bool_or(k IS NULL) FROM a) OR (SELECT bool_or(k IS NULL) FROM b) AS nulls_warning,
      count(*) FILTER (WHERE ak IS NULL) <> 0 AS warn_b_minus_a,
      count(*) FILTER (WHERE bk IS NULL) <> 0 AS warn_a_minus_b FROM f""",
)
def merge_expectations(spark, d):
    return joins.merge_expectations(
        table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").select("o_custkey"),
        [("k", "o_custkey")])


@query(
    "merge_info",
    """SELECT 'left_df' AS frame, 6 AS n_cols, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'right_df', 5, count(*) FROM customer
    UNION ALL SELECT 'merged_df', 10, count(*) FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def merge_info(spark, d):
    orders, cust = table(spark, d, "orders"), table(spark, d, "customer")
    merged = joins.join_dimension(orders, cust, [("o_custkey", "c_custkey")])
    return joins.merge_info(orders, cust, merged)


@query(
    "orphan_impact",
    """SELECT count(DISTINCT d.doc_id) FILTER (WHERE l.doc_id IS NULL) AS orphan_keys,
      count(*) FILTER (WHERE l.doc_id IS NULL) AS orphan_rows, count(*) AS total_rows,
      round_even(100.0 * count(*) FILTER (WHERE l.doc_id IS NULL) / count(*), 2) AS orphan_pct
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def orphan_impact(spark, d):
    """Documents that have no label."""
    return joins.orphan_impact(table(spark, d, "documents"), table(spark, d, "labels"), [("doc_id", "doc_id")])


@query(
    "dup_keys",
    "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1",
)
def dup_keys(spark, d):
    return joins.duplicate_keys(table(spark, d, "events"), ["user_id", "event_type"])


@query(
    "dq_rules",
    """WITH r AS (
      SELECT 'price per unit times units' AS rule, count(ok) AS checked,
        count(*) FILTER (WHERE NOT ok) AS violations FROM (
          SELECT round_even(l_extendedprice / l_quantity * l_quantity, 2) = round_even(l_extendedprice, 2) AS ok
          FROM lineitem)
      UNION ALL SELECT 'discount below 8 percent', count(l_discount), count(*) FILTER (WHERE NOT l_discount < 0.08)
        FROM lineitem
      UNION ALL SELECT 'l_quantity is double', count(*), 0 FROM lineitem
      UNION ALL SELECT 'l_linenumber is bigint', count(*), count(*) FROM lineitem)
    SELECT *, violations = 0 AS success FROM r""",
)
def dq_rules(spark, d):
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return quality.check_rules(
        table(spark, d, "lineitem"),
        {"price per unit times units": quality.equal_rounded(unit * F.col("l_quantity"), F.col("l_extendedprice")),
         "discount below 8 percent": F.col("l_discount") < 0.08},
        {"l_quantity": "double", "l_linenumber": "bigint"},
    )


@query(
    "common_groups",
    """WITH tr AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01'),
      te AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01')
    SELECT 'train' AS side, l_partkey, count(*) AS n FROM tr
      WHERE l_partkey IN (SELECT l_partkey FROM te) GROUP BY ALL
    UNION ALL SELECT 'test', l_partkey, count(*) FROM te
      WHERE l_partkey IN (SELECT l_partkey FROM tr) GROUP BY ALL""",
)
def common_groups(spark, d):
    line = table(spark, d, "lineitem").select("l_partkey", "l_shipdate")
    cut = F.lit("2000-01-01").cast("timestamp")
    train, test = joins.common_groups(
        line.filter(F.col("l_shipdate") < cut), line.filter(F.col("l_shipdate") >= cut), "l_partkey")
    train, test = (
        df.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(s))
        for s, df in (("train", train), ("test", test)))
    return train.unionByName(test)


@query(
    "missing_prop",
    """WITH u AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS bought, max(o_orderstatus) AS st FROM orders GROUP BY 1),
      j AS (SELECT c_custkey, c_acctbal, bought, st FROM customer LEFT JOIN u ON o_custkey = c_custkey)
    SELECT 'c_custkey' AS "column", count(*) AS n_rows, count(*) - count(c_custkey) AS n_missing,
      round((count(*) - count(c_custkey)) / count(*), 9) AS missing_share FROM j
    UNION ALL SELECT 'c_acctbal', count(*), count(*) - count(c_acctbal),
      round((count(*) - count(c_acctbal)) / count(*), 9) FROM j
    UNION ALL SELECT 'bought', count(*), count(*) - count(bought),
      round((count(*) - count(bought)) / count(*), 9) FROM j
    UNION ALL SELECT 'st', count(*), count(*) - count(st), round((count(*) - count(st)) / count(*), 9) FROM j""",
)
def missing_prop(spark, d):
    joined = with_orders(spark, d)
    return quality.missing_proportions(joined).withColumn("missing_share", F.round("missing_share", 9))


def with_orders(spark, d):
    """Customers with the total and status of their orders, missing for those without."""
    bought = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.round(F.sum("o_totalprice"), 2).alias("bought"), F.max("o_orderstatus").alias("st"))
    cust = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return joins.join_dimension(cust, bought, [("c_custkey", "o_custkey")], "left")


@query(
    "missing_summary",
    """WITH u AS (SELECT o_custkey, max(o_orderstatus) AS st FROM orders GROUP BY 1)
    SELECT c_mktsegment, 'st' AS "column", count(*) AS n_rows, count(*) - count(st) AS n_missing
    FROM customer LEFT JOIN u ON o_custkey = c_custkey GROUP BY 1""",
)
def missing_summary(spark, d):
    """Missing counts per segment."""
    bought = table(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderstatus").alias("st"))
    cust = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    joined = joins.join_dimension(cust, bought, [("c_custkey", "o_custkey")], "left")
    return quality.missing_proportions(joined, ["st"], by=["c_mktsegment"]).drop("missing_share")


def _summary_sql(columns):
    parts = []
    for c, dtype in columns:
        parts.append(
            f"""SELECT '{c}' AS "column", '{dtype}' AS dtype, count(*) AS n_unique,
              string_agg(v, ', ' ORDER BY v) FILTER (WHERE rn <= 3) AS samples
            FROM (SELECT v, row_number() OVER (ORDER BY v) AS rn FROM
              (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM orders WHERE {c} IS NOT NULL))""")
    return " UNION ALL ".join(parts)


@query("variable_summary", _summary_sql([
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]))
def variable_summary(spark, d):
    return quality.variable_summary(table(spark, d, "orders"))


@query(
    "data_health",
    """WITH p AS (SELECT text, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
      t AS (SELECT count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM p)) AS u,
            sum(CASE WHEN quality IS NULL THEN 1 ELSE 0 END + CASE WHEN toxic IS NULL THEN 1 ELSE 0 END) AS m FROM p)
    SELECT 'rows' AS metric, CAST(n AS DOUBLE) AS value FROM t UNION ALL SELECT 'columns', 6 FROM t
    UNION ALL SELECT 'numeric_columns', 3 FROM t UNION ALL SELECT 'other_columns', 3 FROM t
    UNION ALL SELECT 'text_columns', 3 FROM t
    UNION ALL SELECT 'missing_pct', round_even(100.0 * m / (6 * n), 4) FROM t
    UNION ALL SELECT 'duplicate_rows_pct', round_even(100.0 * (n - u) / n, 4) FROM t""",
)
def data_health(spark, d):
    """Documents with their labels, many of which are missing; copies are duplicate rows."""
    labelled = joins.join_dimension(table(spark, d, "documents"), table(spark, d, "labels"), [("doc_id", "doc_id")], "left")
    return quality.data_health(labelled.drop("doc_id"))


@query(
    "duplicate_cols",
    """SELECT 'size_copy' AS "column", 'p_size' AS duplicate_of FROM part
    HAVING bool_and(p_size = p_size)
    UNION ALL SELECT 'brand_copy', 'p_brand' FROM part HAVING bool_and(p_brand = p_brand)""",
)
def duplicate_cols(spark, d):
    part = table(spark, d, "part").withColumns({"size_copy": F.col("p_size"), "brand_copy": F.col("p_brand"),
                                                "size_next": F.col("p_size") + 1})
    return quality.duplicate_columns(part, ["p_partkey"])


def _outlier_sql(columns):
    parts = []
    for c in columns:
        parts.append(
            f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE x < m - 3 * s OR x > m + 3 * s) AS n_sd,
              count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_iqr,
              count(*) FILTER (WHERE isinf(v)) AS n_inf
            FROM (SELECT {c} AS v, CASE WHEN isfinite({c}) THEN {c} END AS x FROM src),
              (SELECT avg({c}) AS m, stddev_samp({c}) AS s, quantile_cont({c}, 0.25) AS q1,
                quantile_cont({c}, 0.75) AS q3 FROM src WHERE isfinite({c}))""")
    return """WITH src AS (SELECT l_extendedprice, l_quantity, value_density FROM (SELECT *,
        CASE WHEN l_discount = 0 THEN 'inf'::DOUBLE ELSE l_extendedprice / l_discount END AS value_density
        FROM lineitem)) """ + " UNION ALL ".join(parts)


@query("outlier_table", _outlier_sql(["l_extendedprice", "l_quantity", "value_density"]))
def outlier_table(spark, d):
    density = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(
        F.col("l_extendedprice") / F.col("l_discount"))
    line = table(spark, d, "lineitem").select("l_extendedprice", "l_quantity", density.alias("value_density"))
    return quality.outlier_table(line, ["l_extendedprice", "l_quantity", "value_density"])


@query(
    "unseen_candidates",
    """WITH brands AS (SELECT DISTINCT p_brand FROM part),
      seen AS (SELECT DISTINCT o_custkey, p_brand FROM orders JOIN lineitem ON l_orderkey = o_orderkey
               JOIN part ON p_partkey = l_partkey)
    SELECT c_custkey, b.p_brand FROM customer CROSS JOIN brands b
    WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.o_custkey = c_custkey AND s.p_brand = b.p_brand)""",
)
def unseen_candidates(spark, d):
    """Brands a customer has not bought yet."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    line = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    bought = line.join(orders, line.l_orderkey == orders.o_orderkey).join(part, line.l_partkey == part.p_partkey)
    seen = bought.select(F.col("o_custkey").alias("c_custkey"), "p_brand")
    return reco.unseen_items(table(spark, d, "customer").select("c_custkey"), seen, part, "c_custkey", "p_brand")
