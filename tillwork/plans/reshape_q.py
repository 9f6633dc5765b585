"""Spend, activity and reshaping queries."""

from pyspark.sql import functions as F

from tillwork.operators import reshape

from .registry import query, table

MAPPING_COLUMNS = ("variable_name string, variable_activity_root string, variable_description string, "
                   "variable_category string, aggregation_type string, variable_spend string")
# The variable mapping used by the spend queries.
MAPPING = [
    ("tv_spend", "TV", "Television", "Spend", "Sum", "tv_spend"),
    ("tv_grp", "TV", "Television", "GRP", "Sum", "tv_spend"),
    ("promo_spend", "PROMO", "Promotion", "Spend", "Sum", "promo_spend"),
    ("promo_rate", "PROMO", "Promotion", "Rate", "Mean", "promo_spend"),
]
SQL_MEDIA = """media AS (SELECT CAST(l_shipdate AS DATE) AS day, l_returnflag AS grp, l_extendedprice AS tv_spend,
    l_quantity AS tv_grp, l_extendedprice * l_discount AS promo_spend, l_discount AS promo_rate,
    CAST(year(l_shipdate) AS INTEGER) AS yr, CAST(quarter(l_shipdate) AS INTEGER) AS qtr FROM lineitem)"""
SQL_DAILY = """daily AS (SELECT day, grp, round(sum(tv_spend), 4) AS tv_spend, round(sum(tv_grp), 4) AS tv_grp,
    round(sum(promo_spend), 4) AS promo_spend, round(avg(promo_rate), 8) AS promo_rate FROM media GROUP BY ALL)"""
SQL_ACTIVITY = """act AS (
    SELECT day, grp, 'TV' AS variable_activity_root, 'Television' AS variable_description, tv_spend AS "Spend",
      'GRP' AS activity_type, tv_grp AS "Activity" FROM daily
    UNION ALL SELECT day, grp, 'TV', 'Television', tv_spend, 'Rate', NULL FROM daily
    UNION ALL SELECT day, grp, 'PROMO', 'Promotion', promo_spend, 'GRP', NULL FROM daily
    UNION ALL SELECT day, grp, 'PROMO', 'Promotion', promo_spend, 'Rate', promo_rate FROM daily)"""


def media(spark, d):
    """Line items read as media rows: two channels, each with spend and activity."""
    return table(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("day"), F.col("l_returnflag").alias("grp"),
        F.col("l_extendedprice").alias("tv_spend"), F.col("l_quantity").alias("tv_grp"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("promo_spend"), F.col("l_discount").alias("promo_rate"),
        F.year("l_shipdate").alias("yr"), F.quarter("l_shipdate").alias("qtr"),
    )


def mapping(spark):
    return spark.createDataFrame(MAPPING, MAPPING_COLUMNS)


@query("mapped_agg", f"WITH {SQL_MEDIA}, {SQL_DAILY} SELECT * FROM daily")
def mapped_agg(spark, d):
    out = reshape.mapped_aggregate(media(spark, d), mapping(spark), ["day", "grp"])
    return out.select("day", "grp", *[F.round(c, 8 if c == "promo_rate" else 4).alias(c)
                                      for c in ("tv_spend", "tv_grp", "promo_spend", "promo_rate")])


@query(
    "melt",
    """SELECT l_orderkey, l_linenumber, l_partkey, 'l_quantity' AS variable, l_quantity AS value FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_tax', l_tax FROM lineitem""",
)
def melt(spark, d):
    return reshape.melt(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], ["l_quantity", "l_tax"])


@query(
    "pivot",
    """SELECT o_orderpriority, round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 6) AS "F",
      round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 6) AS "O",
      round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 6) AS "P" FROM orders GROUP BY 1""",
)
def pivot(spark, d):
    out = reshape.pivot(table(spark, d, "orders"), ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"], "o_totalprice")
    return out.select("o_orderpriority", *[F.round(c, 6).alias(c) for c in ("F", "O", "P")])


@query("spend_activity", f"WITH {SQL_MEDIA}, {SQL_DAILY}, {SQL_ACTIVITY} SELECT * FROM act")
def spend_activity(spark, d):
    out = reshape.spend_activity(media(spark, d), mapping(spark), "day", "grp")
    digits = F.when(F.col("activity_type") == "Rate", F.round("Activity", 8)).otherwise(F.round("Activity", 4))
    return out.withColumns({"Spend": F.round("Spend", 4), "Activity": digits})


@query(
    "cost_per_activity",
    f"""WITH {SQL_MEDIA}, {SQL_DAILY}, {SQL_ACTIVITY},
      s AS (SELECT day, variable_description, activity_type, coalesce(sum("Spend"), 0) AS sp,
        coalesce(sum("Activity"), 0) AS ac FROM act
        WHERE lower(variable_description) = 'promotion' AND day >= DATE '1996-01-01' AND day <= DATE '1999-12-31'
        GROUP BY ALL)
    SELECT day, variable_description, activity_type, round(sp, 4) AS "Spend", round(ac, 8) AS "Activity",
      round(CASE WHEN ac = 0 THEN 0 ELSE sp / ac END, 4) AS cost_per_act FROM s""",
)
def cost_per_activity(spark, d):
    import datetime as dt

    act = spend_activity(spark, d)
    out = reshape.cost_per_activity(
        act, "day", "PROMOTION", start=dt.date(1996, 1, 1), end=dt.date(1999, 12, 31))
    return out.withColumns({"Spend": F.round("Spend", 4), "Activity": F.round("Activity", 8),
                            "cost_per_act": F.round("cost_per_act", 4)})


@query(
    "quarterly_spend",
    f"""WITH {SQL_MEDIA}, q AS (SELECT CAST(yr AS VARCHAR) || CAST(qtr AS VARCHAR) AS YEAR_QTR, grp,
        sum(tv_spend) AS tv_spend, sum(tv_grp) AS tv_grp, sum(promo_spend) AS promo_spend,
        avg(promo_rate) AS promo_rate FROM media GROUP BY ALL)
    SELECT YEAR_QTR AS "YEAR_QTR", grp, 'tv_spend' AS variable_name, 'Television' AS variable_description,
      round(tv_spend, 4) AS value FROM q
    UNION ALL SELECT YEAR_QTR, grp, 'tv_grp', 'Television', round(tv_grp, 4) FROM q
    UNION ALL SELECT YEAR_QTR, grp, 'promo_spend', 'Promotion', round(promo_spend, 4) FROM q
    UNION ALL SELECT YEAR_QTR, grp, 'promo_rate', 'Promotion', round(promo_rate, 8) FROM q""",
)
def quarterly_spend(spark, d):
    out = reshape.quarterly_spend(media(spark, d), mapping(spark), "yr", "qtr", "grp")
    value = F.when(F.col("variable_name") == "promo_rate", F.round("value", 8)).otherwise(F.round("value", 4))
    return out.withColumn("value", value)


@query(
    "quarterly_series",
    f"""WITH {SQL_MEDIA} SELECT CAST(yr AS VARCHAR) || CAST(qtr AS VARCHAR) AS "YEAR_QTR",
      round(sum(tv_spend) + sum(tv_grp), 2) AS value FROM media WHERE grp = 'R' GROUP BY 1""",
)
def quarterly_series(spark, d):
    spend = reshape.quarterly_spend(media(spark, d), mapping(spark), "yr", "qtr", "grp")
    out = reshape.quarterly_series(spend, "Television", ("grp", "R"))
    return out.withColumn("value", F.round("value", 2))


@query(
    "act_vs_pred",
    """SELECT CAST(l_shipdate AS DATE) AS day, round(sum(l_extendedprice), 2) AS actuals,
      round(sum(1500 * l_quantity), 2) AS preds FROM lineitem GROUP BY 1""",
)
def act_vs_pred(spark, d):
    line = table(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("day"), F.col("l_returnflag").alias("grp"),
        F.col("l_extendedprice").alias("actuals"), (F.lit(1500.0) * F.col("l_quantity")).alias("preds"))
    out = reshape.actual_vs_predicted(line, "day")
    return out.withColumns({c: F.round(c, 2) for c in ("actuals", "preds")})
