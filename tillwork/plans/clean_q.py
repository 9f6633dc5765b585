"""Cleaning queries."""

from pyspark.sql import functions as F

from tillwork.operators import clean

from .registry import query, table

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
SQL_CLEAN = (
    "nullif(nullif(trim(regexp_replace(regexp_replace({c}, '[\\x00-\\x08\\x0E-\\x1F\\x7F]', '', 'g'),"
    " '[ \\t\\n\\x0B\\x0C\\r]+', ' ', 'g'), ' '), ''), 'NA')"
)


def sql_clean(c):
    return SQL_CLEAN.replace("{c}", c)


@query(
    "clean_product",
    f"""WITH c AS (
      SELECT p_partkey, {sql_clean('p_name')} AS p_name, {sql_clean("p_brand")} AS p_brand,
        {sql_clean('p_type')} AS p_type, p_size, p_retailprice FROM part)
    SELECT p_partkey, p_name AS product_name, coalesce(p_brand, p_type) AS label, p_size AS memory_size
    FROM (SELECT *, row_number() OVER (PARTITION BY p_name, p_brand
            ORDER BY p_size, p_partkey) AS rn FROM c) WHERE rn = 1""",
)
def clean_product(spark, d):
    """One product per name and brand after cleaning and merging columns."""
    part = table(spark, d, "part").select(
        "p_partkey", F.col("p_name").alias("ProductName"), "p_brand", "p_type",
        F.col("p_size").alias("MemorySize"),
    )
    part = part.withColumn("sku", F.concat_ws("|", "ProductName", "p_brand"))
    out = clean.clean_product_table(
        part, "sku", [F.col("MemorySize"), F.col("p_partkey")], {"label": ["p_brand", "p_type"]}
    )
    return out.select("p_partkey", "product_name", "label", "memory_size")


@query(
    "clean_orders",
    f"""SELECT o_orderkey AS order_no, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS ledger_date,
      {sql_clean('o_orderpriority')} AS order_priority, o_totalprice AS selling_price FROM orders""",
)
def clean_orders(spark, d):
    raw = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("Orderno"),
        F.col("o_custkey").cast("string").alias("Customer ID"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("LedgerDate"),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit("\t ")).alias("OrderPriority"),
        F.col("o_totalprice").alias("SellingPrice"),
    )
    return clean.clean_order_table(raw, ["Orderno", "Customer ID"], "LedgerDate", {"orderno": "order_no"})


@query(
    "string_clean",
    f"""SELECT doc_id, {sql_clean("'  ' || lang || chr(9) || ' ' || source || ' '")} AS label,
      md5({sql_clean('text')}) AS text_digest, length({sql_clean('text')}) AS n_clean FROM documents""",
)
def string_clean(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", "text", F.concat(F.lit("  "), "lang", F.lit("\t "), "source", F.lit(" ")).alias("label")
    )
    docs = clean.clean_strings(docs)
    return docs.select("doc_id", "label", F.md5("text").alias("text_digest"),
                       F.length("text").cast("bigint").alias("n_clean"))


@query(
    "coalesce_cols",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
      ELSE o_orderpriority END, c_mktsegment) AS label
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def coalesce_cols(spark, d):
    orders = table(spark, d, "orders").withColumn(
        "o_orderpriority", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")))
    cust = table(spark, d, "customer")
    joined = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
    joined = joined.select("o_orderkey", "o_orderpriority", "c_mktsegment")
    return clean.coalesce_columns(joined, ["o_orderpriority", "c_mktsegment"], "label")


@query(
    "parse_dates",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS ledger_date
    FROM orders""",
)
def parse_dates(spark, d):
    """Text dates of pending orders use another pattern and become NULL."""
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy"))
    raw = table(spark, d, "orders").select("o_orderkey", text.alias("ledger_date"))
    return clean.parse_dates(raw, "ledger_date")


@query(
    "dedup_first",
    """SELECT user_id, event_type, event_id, ts, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)
    WHERE rn = 1""",
)
def dedup_first(spark, d):
    ev = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return clean.remove_duplicates(ev, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "dedup_last",
    """SELECT user_id, event_type, event_id, ts, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1""",
)
def dedup_last(spark, d):
    ev = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return clean.remove_duplicates(ev, ["user_id", "event_type"], ["ts", "event_id"], keep="last")


@query(
    "derive_date_part",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(month(o_orderdate) AS INTEGER) END AS month
    FROM orders""",
)
def derive_date_part(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("shipped"))
    return clean.derive_where_present(orders, "shipped", "month", F.month).drop("shipped")


@query(
    "features_target",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax,
      l_extendedprice AS target FROM lineitem""",
)
def features_target(spark, d):
    line = table(spark, d, "lineitem").select(*LINE_KEY, "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    _, target = clean.features_and_target(line, [*LINE_KEY, "l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return target.withColumnRenamed("l_extendedprice", "target")


@query(
    "drop_cols_like",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
      l_returnflag, l_linestatus FROM lineitem""",
)
def drop_cols_like(spark, d):
    return clean.drop_columns_like(table(spark, d, "lineitem"), "SHIP", case_sensitive=False)


@query(
    "numeric_cols",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
    FROM lineitem""",
)
def numeric_cols(spark, d):
    line = table(spark, d, "lineitem")
    return line.select(*clean.columns_of_type(line, "number"))


@query(
    "segregate",
    """WITH u AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS urgent FROM orders
        WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
    SELECT 'with' AS part, c_custkey, c_acctbal, u.urgent, CAST(c_mktsegment AS VARCHAR) AS c_mktsegment
      FROM customer JOIN u ON o_custkey = c_custkey
    UNION ALL
    SELECT 'without', c_custkey, c_acctbal, NULL, c_mktsegment
      FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM u)""",
)
def segregate(spark, d):
    """Customers with and without urgent orders, numeric and category parts joined back."""
    urgent = (
        table(spark, d, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
        .groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("urgent"))
    )
    cust = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    joined = cust.join(urgent, cust.c_custkey == urgent.o_custkey, "left").drop("o_custkey")
    parts = []
    for label, present in (("with", True), ("without", False)):
        split = clean.segregate(joined, "urgent", ["c_custkey"], ["c_mktsegment"], present)
        both = split["numeric"].join(split["category"], "c_custkey")
        parts.append(both.withColumn("part", F.lit(label)))
    return parts[0].unionByName(parts[1])


@query(
    "drop_constant",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
)
def drop_constant(spark, d):
    line = table(spark, d, "lineitem").select(*LINE_KEY, "l_quantity", "l_returnflag")
    line = line.withColumns({"const_number": F.lit(3.5), "const_text": F.lit("x"),
                             "all_null": F.lit(None).cast("string")})
    return clean.drop_constant(clean.drop_constant(line, numeric=True), numeric=False)


@query("drop_all_zero", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_discount FROM lineitem")
def drop_all_zero(spark, d):
    line = table(spark, d, "lineitem").select(*LINE_KEY, "l_discount")
    return clean.drop_all_zero(line.withColumns({"z_int": F.lit(0), "z_double": F.col("l_discount") * 0}))


@query(
    "log1p_cols",
    "SELECT o_orderkey, round(ln(1 + o_totalprice), 9) AS o_totalprice FROM orders",
)
def log1p_cols(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return clean.log_columns(orders, ["o_totalprice"]).withColumn("o_totalprice", F.round("o_totalprice", 9))


@query("negate_cols", "SELECT o_orderkey, -o_totalprice AS o_totalprice FROM orders")
def negate_cols(spark, d):
    return clean.negate_columns(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"])


SQL_LINE_HASH = (
    "md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),"
    " CAST(l_linenumber AS VARCHAR), '42'))"
)


@query(
    "sample_frac",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM (
      SELECT *, row_number() OVER (ORDER BY {SQL_LINE_HASH}, l_orderkey, l_partkey, l_suppkey, l_linenumber) AS rn,
        count(*) OVER () AS n FROM lineitem) WHERE rn <= round_even(0.1 * n, 0)""",
)
def sample_frac(spark, d):
    line = table(spark, d, "lineitem").select(*LINE_KEY, "l_quantity")
    return clean.sample_fraction(line, LINE_KEY, 0.1, 42)


@query(
    "sample_approx",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
    WHERE substr({SQL_LINE_HASH}, 1, 8) < '19999999'""",
)
def sample_approx(spark, d):
    line = table(spark, d, "lineitem").select(*LINE_KEY)
    return clean.sample_approximate(line, LINE_KEY, 0.1, 42)


@query(
    "filter_positive",
    """SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount > 0 AND l_tax > 0""",
)
def filter_positive(spark, d):
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return clean.filter_positive(line, ["l_discount", "l_tax"])


SQL_PRED = "(1500.0 * l_quantity)"


@query(
    "residual_flags",
    f"""WITH f AS (SELECT l_returnflag,
        abs({SQL_PRED} - l_extendedprice) / nullif(l_extendedprice, 0) AS residual,
        CASE WHEN {SQL_PRED} > l_extendedprice * 1.3 THEN 'OverPrediction'
             WHEN {SQL_PRED} < l_extendedprice * 0.7 THEN 'UnderPrediction' ELSE 'Others' END AS residual_flag,
        CASE WHEN l_extendedprice > 100 AND {SQL_PRED} > l_extendedprice * 1.3 THEN 'over predict'
             WHEN l_extendedprice > 100 AND {SQL_PRED} < l_extendedprice * 0.7 THEN 'under predict'
             ELSE 'good' END AS forecast_flag FROM lineitem)
    SELECT l_returnflag, residual_flag, forecast_flag, count(*) AS n, round(avg(residual), 8) AS mean_residual
    FROM f GROUP BY ALL""",
)
def residual_flags(spark, d):
    line = table(spark, d, "lineitem").select(
        "l_returnflag", "l_extendedprice", (F.lit(1500.0) * F.col("l_quantity")).alias("yhat"))
    line = clean.residual_flags(line, "l_extendedprice", "yhat", error="pe")
    line = clean.forecast_flags(line, "l_extendedprice", "yhat")
    return line.groupBy("l_returnflag", "residual_flag", "forecast_flag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("residual"), 8).alias("mean_residual"))
