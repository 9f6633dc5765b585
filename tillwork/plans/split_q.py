"""Split queries and the flagship sales flow."""

from pyspark.sql import functions as F

from tillwork.operators import clean, joins, ordered, split, timeseries

from .clean_q import LINE_KEY, SQL_LINE_HASH
from .registry import query, table

SQL_UNIT = "l_extendedprice / l_quantity"
_EDGES = ", ".join(f"quantile_cont(price, {i / 10}) AS e{i}" for i in range(1, 10))
_BIN = "1 + " + " + ".join(f"CAST(price > e{i} AS INTEGER)" for i in range(1, 10))
_TIES = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


def unit_price(spark, d):
    return table(spark, d, "lineitem").select(
        *LINE_KEY, "l_shipdate", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))


@query(
    "decile_bins",
    f"""WITH p AS (SELECT {_TIES}, {SQL_UNIT} AS price FROM lineitem), e AS (SELECT {_EDGES} FROM p)
    SELECT {_TIES}, price, CAST({_BIN} AS INTEGER) AS bin FROM p, e""",
)
def decile_bins(spark, d):
    return split.quantile_bins(unit_price(spark, d).drop("l_shipdate"), "price", 10)


SQL_SPLIT = f"""p AS (SELECT {_TIES}, {SQL_UNIT} AS price FROM lineitem), e AS (SELECT {_EDGES} FROM p),
    b AS (SELECT {_TIES}, price, CAST({_BIN} AS INTEGER) AS bin FROM p, e),
    s AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY bin ORDER BY {SQL_LINE_HASH}, {_TIES})
      <= round_even(0.2 * count(*) OVER (PARTITION BY bin), 0) THEN 'test' ELSE 'train' END AS split FROM b)"""


@query("stratified_split", f"WITH {SQL_SPLIT} SELECT {_TIES}, price, split FROM s")
def stratified_split(spark, d):
    return split.stratified_split_numeric(unit_price(spark, d).drop("l_shipdate"), LINE_KEY, "price")


@query(
    "split_per_user",
    """WITH r AS (SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS n,
        row_number() OVER (PARTITION BY o_custkey ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '7')), o_orderkey) AS rn
        FROM orders),
      w AS (SELECT *, CASE WHEN n = 1 THEN 0 WHEN n < 5 THEN round_even(0.3 * n, 0) ELSE 5 END AS want FROM r)
    SELECT o_orderkey, o_custkey, CASE WHEN rn <= want THEN 'test' ELSE 'train' END AS split FROM w
    WHERE want > 0 AND want < n""",
)
def split_per_user(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return split.split_per_user(orders, "o_custkey", ["o_orderkey"])


@query(
    "split_by_date",
    """WITH r AS (SELECT o_orderkey, o_custkey, o_orderdate > TIMESTAMP '2000-06-30' AS late FROM orders),
      k AS (SELECT o_custkey FROM r GROUP BY 1 HAVING bool_or(late) AND NOT bool_and(late))
    SELECT o_orderkey, o_custkey, CASE WHEN late THEN 'test' ELSE 'train' END AS split FROM r
    WHERE o_custkey IN (SELECT o_custkey FROM k)""",
)
def split_by_date(spark, d):
    import datetime as dt

    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return split.split_by_date(orders, "o_custkey", "o_orderdate", dt.datetime(2000, 6, 30)).drop("o_orderdate")


@query(
    "edge_split",
    f"""WITH r AS (SELECT {_TIES}, row_number() OVER (ORDER BY {SQL_LINE_HASH}, {_TIES}) AS rn, count(*) OVER () AS n FROM lineitem)
    SELECT {_TIES}, CASE WHEN rn <= floor(0.1 * n) THEN 'test' WHEN rn <= floor(0.1 * n) + floor(0.1 * n) THEN 'validation'
      ELSE 'train' END AS split FROM r""",
)
def edge_split(spark, d):
    return split.edge_split(table(spark, d, "lineitem").select(*LINE_KEY), LINE_KEY)


@query(
    "dense_ids",
    """SELECT k, dense_rank() OVER (ORDER BY k) - 1 AS id FROM
      (SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer)""",
)
def dense_ids(spark, d):
    """Customer ids over the union of two tables."""
    orders, customers = table(spark, d, "orders").select("o_custkey"), table(spark, d, "customer").select("c_custkey")
    return ordered.dense_ids(orders.union(customers).toDF("k"), ["k"])


@query(
    "sales_flow",
    f"""WITH h AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ledger_date, c_mktsegment,
        CAST(o_orderdate = min(o_orderdate) OVER (PARTITION BY o_custkey) AS INTEGER) AS first_time_customer,
        CAST(coalesce(date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
          o_orderdate), 0) AS INTEGER) AS days_since_last_purchase
        FROM orders JOIN customer ON o_custkey = c_custkey),
      {SQL_SPLIT}
    SELECT {_TIES}, ledger_date, c_mktsegment, first_time_customer, days_since_last_purchase, p_brand, price, split
    FROM s JOIN h ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
)
def sales_flow(spark, d):
    """Clean orders, join customer and product, customer history, stratified split of unit prices."""
    raw = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("OrderNo"), F.col("o_custkey").cast("string").alias("CustNo"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("LedgerDate"))
    orders = clean.clean_order_table(raw, ["OrderNo", "CustNo"], "LedgerDate")
    cust = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    orders = joins.join_dimension(orders, cust, [("cust_no", "c_custkey")])
    orders = timeseries.customer_history(orders, "cust_no", "ledger_date", "order_no")
    lines = split.stratified_split_numeric(unit_price(spark, d).drop("l_shipdate"), LINE_KEY, "price")
    sales = joins.join_dimension(lines, orders, [("l_orderkey", "order_no")])
    return joins.join_dimension(sales, part, [("l_partkey", "p_partkey")]).drop("cust_no")
