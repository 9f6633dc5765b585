"""Scans, sinks, catalog and fingerprints."""

from pyspark.sql import functions as F

from tillwork.session import scratch_path
from tillwork.sources import catalog, files

from .registry import query, table


@query("scan_csv", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_csv(spark, d):
    path = scratch_path(spark, "nation") + ".csv"
    nation = table(spark, d, "nation")
    files.save_data(nation, path)
    return files.load_csv(spark, path, nation.schema)


@query(
    "scan_parquet",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders""",
)
def scan_parquet(spark, d):
    return files.load_data(spark, f"{d}/orders.parquet")


@query(
    "scan_pruned",
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice > 300000 AND o_orderstatus = 'F'""",
)
def scan_pruned(spark, d):
    """Filter and projection reach the parquet reader."""
    orders = files.load_parquet(spark, f"{d}/orders.parquet")
    return orders.filter("o_totalprice > 300000 AND o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


@query(
    "catalog_load",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
)
def catalog_load(spark, d):
    """Write orders as one dataset per status, then load them through a glob template."""
    base = scratch_path(spark, "catalog")
    conf = {"raw": {
        "orders_part": {"format": "parquet", "uri": base + "/orders_{status}.parquet"},
        "orders": {"format": "parquet", "uri": base + "/orders_{pattern}.parquet"},
    }}
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    for status in sorted(r[0] for r in orders.select("o_orderstatus").distinct().collect()):
        catalog.save_dataset(orders.filter(F.col("o_orderstatus") == status), conf, "raw/orders_part", status=status)
    return catalog.load_dataset(spark, conf, "raw/orders", pattern="*")


@query("sink_roundtrip", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def sink_roundtrip(spark, d):
    path = scratch_path(spark, "part") + ".parquet"
    files.save_data(table(spark, d, "part"), path)
    return files.load_data(spark, path)


@query("save_table", 'SELECT r_regionkey AS region_key, r_name AS region_name FROM region')
def save_table(spark, d):
    path = scratch_path(spark, "tables")
    region = table(spark, d, "region").toDF("region key", "region name")
    return files.save_table(region, "region_" + path.rsplit("-", 1)[-1], path=path)


@query(
    "table_fingerprint",
    f"""WITH r AS (SELECT md5(concat({', '.join(
        f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, 'n')" for c in ("doc_id", "text", "lang", "source", "n_chars"))})) AS h
      FROM documents)
    SELECT count(*) AS n_rows, concat_ws('-', {', '.join(
        f"CAST(sum(('0x' || substr(h, {1 + 8 * i}, 8))::BIGINT) AS VARCHAR)" for i in range(4))}) AS fingerprint FROM r""",
)
def table_fingerprint(spark, d):
    """Free text, which holds any separator."""
    return files.table_fingerprint(table(spark, d, "documents"))


@query(
    "sql_scan",
    """SELECT n.n_nationkey, n.n_name, r.r_name, count(*) AS customers
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY ALL""",
)
def sql_scan(spark, d):
    """A SQL scan over registered views that stays distributed."""
    for name in ("nation", "region", "customer"):
        table(spark, d, name).createOrReplaceTempView(f"scan_{name}")
    return spark.sql(
        """SELECT n.n_nationkey, n.n_name, r.r_name, count(*) AS customers
        FROM scan_customer c JOIN scan_nation n ON c.c_nationkey = n.n_nationkey
        JOIN scan_region r ON n.n_regionkey = r.r_regionkey
        GROUP BY n.n_nationkey, n.n_name, r.r_name"""
    )
