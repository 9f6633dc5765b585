"""Time-series and calendar queries."""

from pyspark.sql import functions as F

from tillwork.operators import calendar, joins, timeseries

from tillwork.session import materialise

from .eda_q import rounded
from .registry import query, table

SQL_PANEL = """base AS (SELECT CAST(o_orderdate AS DATE) AS day, c_mktsegment AS seg, round(sum(o_totalprice), 2) AS sales,
    count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
  spine AS (SELECT seg, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day
    FROM (SELECT DISTINCT seg FROM base), (SELECT min(day) AS lo, max(day) AS hi FROM base)),
  gaps AS (SELECT s.seg, s.day, b.sales, b.n_orders FROM spine s LEFT JOIN base b ON s.seg = b.seg AND s.day = b.day),
  panel AS (SELECT seg, day, coalesce(sales, 0) AS sales, coalesce(n_orders, 0) AS n_orders FROM gaps)"""
W = "(PARTITION BY seg ORDER BY day)"


def daily_gaps(spark, d):
    """Daily sales by customer segment on a dense calendar; days without orders are NULL."""
    orders = table(spark, d, "orders").select("o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    cust = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("seg"))
    joined = joins.join_dimension(orders, cust, [("o_custkey", "c_custkey")])
    return timeseries.panel(joined, "day", ["seg"], {
        "sales": F.round(F.sum("o_totalprice"), 2), "n_orders": F.count(F.lit(1))})


def daily(spark, d):
    return daily_gaps(spark, d).fillna(0, ["sales", "n_orders"])


@query("daily_panel", f"WITH {SQL_PANEL} SELECT * FROM gaps")
def daily_panel(spark, d):
    return daily_gaps(spark, d)


@query(
    "first_time_customer",
    """SELECT o_orderkey, o_custkey, CAST(o_orderdate = min(o_orderdate) OVER (PARTITION BY o_custkey) AS INTEGER)
      AS first_time_customer FROM orders""",
)
def first_time_customer(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    out = timeseries.customer_history(orders, "o_custkey", "day", "o_orderkey")
    return out.select("o_orderkey", "o_custkey", "first_time_customer")


@query(
    "days_since_last",
    """SELECT o_orderkey, o_custkey, CAST(coalesce(date_diff('day', lag(o_orderdate) OVER
      (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate), 0) AS INTEGER) AS days_since_last_purchase
    FROM orders""",
)
def days_since_last(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    out = timeseries.customer_history(orders, "o_custkey", "day", "o_orderkey")
    return out.select("o_orderkey", "o_custkey", "days_since_last_purchase")


def _lag_sql(c, n):
    return f"first_value({c}_{n}_lag IGNORE NULLS) OVER (PARTITION BY seg ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {c}_{n}_lag"


@query(
    "create_lag",
    f"""WITH {SQL_PANEL}, l AS (SELECT seg, day, lag(sales, 1) OVER {W} AS sales_1_lag, lag(n_orders, 1) OVER {W} AS n_orders_1_lag,
      lag(sales, 7) OVER {W} AS sales_7_lag, lag(n_orders, 7) OVER {W} AS n_orders_7_lag FROM gaps)
    SELECT seg, day, {', '.join(_lag_sql(c, n) for n in (1, 7) for c in ('sales', 'n_orders'))} FROM l""",
)
def create_lag(spark, d):
    return timeseries.create_lag(daily_gaps(spark, d), "day", [1, 7], ["seg"], "_lag")


def _adstock_sql(c, n, memory):
    terms = [f"coalesce(lag({c}, {j}) OVER {W}, 0) * {(0.5 ** (1 / n)) ** j!r}::DOUBLE" for j in range(memory)]
    return f"round({' + '.join(terms)}, 3) AS {c}_{n}"


@query(
    "adstock_finite",
    f"""WITH {SQL_PANEL} SELECT seg, day, {', '.join(_adstock_sql(c, n, 8) for n in (2, 4) for c in ('sales', 'n_orders'))}
    FROM panel""",
)
def adstock_finite(spark, d):
    out = timeseries.create_adstock(daily(spark, d), "day", [2, 4], ["seg"], max_memory=8)
    return rounded(out, 3, *[c for c in out.columns if c not in ("seg", "day")])


@query(
    "adstock_infinite",
    f"""WITH {SQL_PANEL}, x AS (SELECT a.seg, a.day,
        round(sum(b.sales * {0.5 ** (1 / 3)!r}::DOUBLE ** date_diff('day', b.day, a.day)), 3) AS sales_3,
        round(sum(b.n_orders * {0.5 ** (1 / 3)!r}::DOUBLE ** date_diff('day', b.day, a.day)), 3) AS n_orders_3
      FROM panel a JOIN panel b ON a.seg = b.seg AND b.day <= a.day GROUP BY ALL)
    SELECT * FROM x""",
)
def adstock_infinite(spark, d):
    out = timeseries.create_adstock(daily(spark, d), "day", [3], ["seg"])
    return rounded(out, 3, "sales_3", "n_orders_3")


SQL_ROLL = f"""{SQL_PANEL}, roll AS (SELECT seg, day, sales, row_number() OVER {W} AS pos,
    CASE WHEN count(sales) OVER w = 3 THEN round(avg(sales) OVER w, 5) END AS m FROM gaps
    WINDOW w AS (PARTITION BY seg ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"""


def _rolling(spark, d, mode):
    return rounded(timeseries.rolling_mean(daily_gaps(spark, d), ["sales"], "day", 3, mode, ["seg"]), 5, "sales")


@query("rolling_keep", f"WITH {SQL_ROLL} SELECT seg, day, m AS sales FROM roll")
def rolling_keep(spark, d):
    return _rolling(spark, d, "keep")


@query("rolling_drop", f"WITH {SQL_ROLL} SELECT seg, day, m AS sales FROM roll WHERE m IS NOT NULL")
def rolling_drop(spark, d):
    return _rolling(spark, d, "drop")


@query(
    "rolling_append",
    f"WITH {SQL_ROLL} SELECT seg, day, CASE WHEN pos < 3 THEN sales ELSE m END AS sales FROM roll WHERE pos < 3 OR m IS NOT NULL",
)
def rolling_append(spark, d):
    return _rolling(spark, d, "append")


@query(
    "ffill",
    f"""WITH {SQL_PANEL} SELECT seg, day, last_value(sales IGNORE NULLS) OVER
      (PARTITION BY seg ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sales FROM gaps""",
)
def ffill(spark, d):
    return timeseries.fill_forward(daily_gaps(spark, d).drop("n_orders"), ["sales"], "day", ["seg"])


@query(
    "bfill",
    f"""WITH {SQL_PANEL} SELECT seg, day, first_value(sales IGNORE NULLS) OVER
      (PARTITION BY seg ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sales FROM gaps""",
)
def bfill(spark, d):
    return timeseries.fill_backward(daily_gaps(spark, d).drop("n_orders"), ["sales"], "day", ["seg"])


@query(
    "interpolate",
    f"""WITH {SQL_PANEL}, p AS (SELECT seg, day, sales, row_number() OVER {W} AS pos FROM gaps),
      k AS (SELECT *, last_value(sales IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN sales IS NOT NULL THEN pos END IGNORE NULLS)
          OVER b AS p0, first_value(sales IGNORE NULLS) OVER f AS v1,
          first_value(CASE WHEN sales IS NOT NULL THEN pos END IGNORE NULLS) OVER f AS p1 FROM p
        WINDOW b AS (PARTITION BY seg ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
          f AS (PARTITION BY seg ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT seg, day, round(coalesce(sales, v0 + (v1 - v0) * (pos - p0) / nullif(p1 - p0, 0), v0, v1), 8) AS sales FROM k""",
)
def interpolate(spark, d):
    out = timeseries.interpolate(daily_gaps(spark, d).drop("n_orders"), ["sales"], "day", ["seg"])
    return rounded(out, 8, "sales")


def _season_sql(part, name):
    return f"""WITH {SQL_PANEL}, s AS (SELECT {part}(day) AS p, avg(sales) / (SELECT avg(sales) FROM panel) AS i
      FROM panel GROUP BY 1) SELECT seg, day, sales, round(i, 8) AS {name} FROM panel JOIN s ON {part}(day) = p"""


@query("season_index", _season_sql("weekofyear", "s_index_weekly"))
def season_index(spark, d):
    out = timeseries.seasonal_index(daily(spark, d).drop("n_orders"), "sales", "day", "week")
    return rounded(out, 8, "s_index_weekly")


@query("season_index_month", _season_sql("month", "s_index_monthly"))
def season_index_month(spark, d):
    out = timeseries.seasonal_index(daily(spark, d).drop("n_orders"), "sales", "day", "month")
    return rounded(out, 8, "s_index_monthly")


@query(
    "season_class",
    f"""WITH x AS ({_season_sql('weekofyear', 's')}) SELECT seg, day, sales,
      CASE WHEN s > 1.05 THEN 1 WHEN s < 0.95 THEN -1 ELSE 0 END AS s_index_weekly FROM x""",
)
def season_class(spark, d):
    return timeseries.seasonal_index(
        daily(spark, d).drop("n_orders"), "sales", "day", "week", thresholds=[0.95, 1.05])


def _decompose_sql(period, additive):
    h = period // 2
    if period % 2:
        trend = f"sum(sales) OVER (PARTITION BY seg ORDER BY day ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) / {period}"
    else:
        trend = (f"(sum(sales) OVER (PARTITION BY seg ORDER BY day ROWS BETWEEN {h - 1} PRECEDING AND {h - 1} FOLLOWING)"
                 f" + 0.5 * (lag(sales, {h}) OVER {W} + lead(sales, {h}) OVER {W})) / {period}")
    det, centre = ("sales - trend", "-") if additive else ("sales / trend", "/")
    return f"""WITH {SQL_PANEL}, p1 AS (SELECT seg, day, sales + 1000 AS sales FROM panel),
      t AS (SELECT seg, day, sales, (row_number() OVER {W} - 1) % {period} AS phase,
        CASE WHEN count(sales) OVER (PARTITION BY seg ORDER BY day ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) = {2 * h + 1}
          THEN {trend} END AS trend FROM p1),
      p AS (SELECT seg, phase, avg({det}) AS m FROM t GROUP BY ALL),
      s AS (SELECT seg, phase, m {centre} avg(m) OVER (PARTITION BY seg) AS seasonal FROM p)
    SELECT t.seg, t.day, t.sales, round(seasonal, 4) AS seasonal FROM t JOIN s ON t.seg = s.seg AND t.phase = s.phase"""


def _decomposed(spark, d, method, period):
    rows = daily(spark, d).select("seg", "day", (F.col("sales") + 1000).alias("sales"))
    return rounded(timeseries.decompose(rows, "sales", "day", method, period, ["seg"]), 4, "seasonal")


@query("decompose_add", _decompose_sql(7, True))
def decompose_add(spark, d):
    return _decomposed(spark, d, "additive", 7)


@query("decompose_mul", _decompose_sql(12, False))
def decompose_mul(spark, d):
    return _decomposed(spark, d, "multiplicative", 12)


SQL_ODAY = "o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders)"
SQL_SUNDAY = "CAST({c} + CAST(7 - isodow({c}) AS INTEGER) AS DATE)"


def order_days(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))


@query(
    "trend_day",
    f"WITH {SQL_ODAY} SELECT o_orderkey, day, CAST(date_diff('day', (SELECT min(day) FROM o), day) + 1 AS INTEGER) AS trend FROM o",
)
def trend_day(spark, d):
    return timeseries.linear_trend(order_days(spark, d), "day", "Day")


SQL_SPINE = f"""{SQL_ODAY}, w AS (SELECT s, row_number() OVER (ORDER BY s) AS n FROM (
    SELECT CAST(unnest(generate_series((SELECT min(day) FROM o), (SELECT max(day) FROM o), INTERVAL 1 DAY)) AS DATE) AS s)
    WHERE isodow(s) = 7)"""


@query("trend_week", f"WITH {SQL_SPINE} SELECT o_orderkey, day, CAST(n AS INTEGER) AS trend FROM o LEFT JOIN w ON day = s")
def trend_week(spark, d):
    return timeseries.linear_trend(order_days(spark, d), "day", "Week")


@query(
    "trend_month",
    f"""WITH {SQL_SPINE} SELECT o_orderkey, day, CAST(year(s) - (SELECT min(year(s)) FROM w) + month(s) AS INTEGER) AS trend
    FROM o LEFT JOIN w ON day = s""",
)
def trend_month(spark, d):
    return timeseries.linear_trend(order_days(spark, d), "day", "Month")


@query(
    "rolling_origin_folds",
    f"""WITH {SQL_PANEL}, r AS (SELECT seg, day, sales, row_number() OVER (PARTITION BY seg ORDER BY day DESC) AS back FROM panel),
      f AS (SELECT *, CAST(unnest(range(0, 6)) AS INTEGER) AS fold FROM r)
    SELECT seg, fold, CASE WHEN back - fold * 4 <= 24 THEN 'test' ELSE 'train' END AS role, count(*) AS n,
      min(day) AS first_day, max(day) AS last_day FROM f WHERE back - fold * 4 >= 1 GROUP BY ALL""",
)
def rolling_origin_folds(spark, d):
    out = timeseries.rolling_origin_folds(daily(spark, d), "day", ["seg"])
    return out.groupBy("seg", "fold", "role").agg(
        F.count(F.lit(1)).alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@query("group_id", f"WITH {SQL_PANEL} SELECT seg, day, sales, dense_rank() OVER (ORDER BY seg) - 1 AS id FROM panel")
def group_id(spark, d):
    return timeseries.group_ids(daily(spark, d).drop("n_orders"), ["seg"])


@query(
    "ses_simple",
    f"""WITH {SQL_PANEL}, r AS (SELECT seg, sales, row_number() OVER (PARTITION BY seg ORDER BY day) AS pos,
        count(*) OVER (PARTITION BY seg) AS n FROM panel),
      f AS (SELECT *, CAST(unnest(range(0, 6)) AS INTEGER) AS fold FROM r),
      c AS (SELECT *, n - fold * 4 AS last, n - fold * 4 - 24 AS cut FROM f),
      l AS (SELECT seg, fold, sum(CASE WHEN pos = 1 THEN 0.7::DOUBLE ** (cut - 1) ELSE 0.3 * 0.7::DOUBLE ** (cut - pos) END * sales) AS level
        FROM c WHERE pos <= cut GROUP BY ALL),
      e AS (SELECT c.seg, c.fold, sales - level AS miss, sales FROM c JOIN l ON c.seg = l.seg AND c.fold = l.fold
        WHERE pos > cut AND pos <= last)
    SELECT seg, 'simple' AS model, fold, round(sqrt(avg(miss * miss)), 3) AS rmse,
      round(avg(abs(miss / sales)) FILTER (WHERE sales <> 0), 7) AS mape, round(avg(abs(miss)), 3) AS mae FROM e GROUP BY ALL""",
)
def ses_simple(spark, d):
    out = timeseries.smoothing_backtest(daily(spark, d), "day", "sales", ["seg"], ("simple",))
    return rounded(rounded(out, 3, "rmse", "mae"), 7, "mape")


SQL_TRAIN = f"""{SQL_PANEL}, x AS (SELECT seg, list(sales::DOUBLE ORDER BY day) AS x FROM panel GROUP BY 1),
  f AS (SELECT seg, CAST(fold AS INTEGER) AS fold, x[1:len(x) - fold * 4 - 24] AS tr, x[len(x) - fold * 4 - 23:len(x) - fold * 4] AS te
    FROM x, (SELECT unnest(range(0, 6)) AS fold))"""


def _sql_smooth(kind, start, first, season):
    """Level, slope and season of a fold, value by value, in a list fold; ``season`` is the season of the value's day."""
    level = f"(0.3 * (b.v - {season}) + 0.7 * (a.l + a.s))"
    slope = f"0.1 * ({level} - a.l) + 0.9 * a.s" if kind != "simple" else "0.0::DOUBLE"
    q = f"list_transform(a.q, lambda z, k: CASE WHEN k = b.t % 7 + 1 THEN 0.1 * (b.v - {level}) + 0.9 * z ELSE z END)" if kind == "seasonal" else "a.q"
    ahead = "h.l + h.s * i" + (" + h.q[(n + i - 1) % 7 + 1]" if kind == "seasonal" else "")
    return f"""SELECT seg, '{kind}' AS model, fold, te, list_transform(range(1, 25), lambda i: {ahead}) AS ahead FROM (
      SELECT seg, fold, te, len(tr) AS n, list_reduce(list_prepend({start}, list_transform(tr[{first}:], lambda y, i: {{'v': y, 't': i - 1, 'l': 0.0::DOUBLE,
        's': 0.0::DOUBLE, 'q': []::DOUBLE[]}})), lambda a, b: {{'v': b.v, 't': b.t, 'l': {level}, 's': {slope}, 'q': {q}}}) AS h FROM f)"""


SQL_BACKTEST = f"""WITH {SQL_TRAIN}, w AS (
  {_sql_smooth('simple', "{'v': 0.0::DOUBLE, 't': 0::BIGINT, 'l': tr[1], 's': 0.0::DOUBLE, 'q': []::DOUBLE[]}", 2, '0')} UNION ALL
  {_sql_smooth('trend', "{'v': 0.0::DOUBLE, 't': 0::BIGINT, 'l': tr[1], 's': tr[2] - tr[1], 'q': []::DOUBLE[]}", 2, '0')} UNION ALL
  {_sql_smooth('seasonal', "{'v': 0.0::DOUBLE, 't': 0::BIGINT, 'l': list_avg(tr[1:7]), 's': (list_avg(tr[8:14]) - list_avg(tr[1:7])) / 7, "
               "'q': list_transform(tr[1:7], lambda y: y - list_avg(tr[1:7]))}", 1, 'a.q[b.t % 7 + 1]')}),
  e AS (SELECT seg, model, fold, unnest(te) AS x, unnest(te) - unnest(ahead) AS miss FROM w)
SELECT seg, model, fold, round(sqrt(avg(miss * miss)), 3) AS rmse, round(avg(abs(miss / x)) FILTER (WHERE x <> 0), 6) AS mape, round(avg(abs(miss)), 3) AS mae
FROM e GROUP BY ALL"""


@query("ses_backtest", SQL_BACKTEST)
def ses_backtest(spark, d):
    out = timeseries.smoothing_backtest(daily(spark, d), "day", "sales", ["seg"])
    return rounded(rounded(out, 3, "rmse", "mae"), 6, "mape")


@query(
    "ses_search",
    f"""WITH {SQL_TRAIN}, a AS (SELECT unnest([0.05, 0.1, 0.3, 0.5, 0.7, 0.9])::DOUBLE AS alpha),
      l AS (SELECT seg, fold, alpha, te, list_sum(list_transform(tr, lambda x, i: x * CASE WHEN i = 1 THEN (1 - alpha) ** (len(tr) - 1)
        ELSE alpha * (1 - alpha) ** (len(tr) - i) END)) AS level FROM f, a),
      e AS (SELECT seg, fold, alpha, sqrt(list_avg(list_transform(te, lambda x: (x - level) ** 2))) AS rmse FROM l),
      m AS (SELECT seg, alpha, avg(rmse) AS rmse, count(*) AS n_folds FROM e GROUP BY 1, 2)
    SELECT seg, 'simple' AS model, alpha, NULL::DOUBLE AS beta, NULL::DOUBLE AS gamma, round(rmse, 3) AS rmse, n_folds FROM m
    QUALIFY row_number() OVER (PARTITION BY seg ORDER BY rmse, alpha) = 1""",
)
def ses_search(spark, d):
    """The best smoothing of every segment's daily sales."""
    return rounded(timeseries.smoothing_search(daily(spark, d), "day", "sales", ["seg"], ("simple",)), 3, "rmse")


@query("ses_search_all", "SELECT seg, model, true AS no_worse, 6::BIGINT AS n_folds FROM (SELECT DISTINCT c_mktsegment AS seg FROM customer JOIN orders "
       "ON c_custkey = o_custkey), (SELECT unnest(['simple', 'trend', 'seasonal']) AS model)")
def ses_search_all(spark, d):
    """Every kind over its whole grid: the best setting is no worse than the one of ``ses_backtest``, which is on the grid."""
    panel = materialise(daily(spark, d))
    best = timeseries.smoothing_search(panel, "day", "sales", ["seg"], grid=(0.1, 0.3, 0.6))
    usual = timeseries.smoothing_backtest(panel, "day", "sales", ["seg"]).groupBy("seg", "model").agg(F.avg("rmse").alias("usual"))
    return best.join(usual, ["seg", "model"]).select("seg", "model", (F.col("rmse") <= F.col("usual") * (1 + 1e-9)).alias("no_worse"), "n_folds")


@query(
    "fiscal_attrs",
    f"""WITH {SQL_ODAY} SELECT o_orderkey, day, CAST(year(day) AS VARCHAR) AS "Year", monthname(day) AS "Month",
      strftime(day, '%W') AS "Week", CAST(year(day) AS VARCHAR) || 'Q' || CAST(quarter(day) AS VARCHAR) AS "Quarter" FROM o""",
)
def fiscal_attrs(spark, d):
    return calendar.add_fiscal_calendar(order_days(spark, d), "day")


@query(
    "fiscal_join",
    f"""WITH {SQL_ODAY} SELECT o_orderkey, day, CAST(year(day) + CASE WHEN month(day) >= 4 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
      CAST((month(day) + 8) % 12 + 1 AS INTEGER) AS fiscal_period FROM o""",
)
def fiscal_join(spark, d):
    """Fiscal calendar starting in April, one row per day of the order range."""
    orders = order_days(spark, d)
    days = orders.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).select(
        F.explode(F.sequence("lo", "hi")).alias("fiscal_day"))
    fiscal = days.select(
        "fiscal_day", (F.year("fiscal_day") + F.when(F.month("fiscal_day") >= 4, 1).otherwise(0)).alias("fiscal_year"),
        ((F.month("fiscal_day") + 8) % 12 + 1).alias("fiscal_period"))
    return calendar.add_fiscal_calendar(orders, "day", fiscal, "fiscal_day")


@query("roll_weekday", f"WITH {SQL_ODAY} SELECT o_orderkey, {SQL_SUNDAY.format(c='day')} AS day FROM o")
def roll_weekday(spark, d):
    return calendar.move_to_weekday(order_days(spark, d), "day")


@query("roll_month_end", f"WITH {SQL_ODAY} SELECT o_orderkey, last_day(day) AS day FROM o")
def roll_month_end(spark, d):
    return calendar.move_to_month_end(order_days(spark, d), "day")


# Public holidays used by the holiday queries.
HOLIDAYS = ("1996-01-01", "1996-05-27", "1996-07-04", "1996-12-25", "1997-01-01", "1997-05-26", "1997-07-04",
            "1997-12-25", "1998-01-01", "1998-12-25", "1998-12-25", "1999-07-04")
SQL_HOLIDAYS = "h AS (SELECT CAST(h AS DATE) AS h FROM (VALUES " + ", ".join(f"('{x}')" for x in HOLIDAYS) + ") v(h))"


def _holidays(spark):
    return spark.createDataFrame([(x,) for x in HOLIDAYS], "holiday string")


@query(
    "holidays_day",
    f"""WITH {SQL_ODAY}, {SQL_HOLIDAYS}, c AS (SELECT h, count(*) AS n FROM h GROUP BY 1)
    SELECT o_orderkey, day, coalesce(n, 0) AS "Is_Holiday" FROM o LEFT JOIN c ON day = h""",
)
def holidays_day(spark, d):
    return calendar.add_holidays(order_days(spark, d), _holidays(spark), "day", "holiday", "Day")


@query(
    "holidays_week",
    f"""WITH {SQL_ODAY}, {SQL_HOLIDAYS}, c AS (SELECT {SQL_SUNDAY.format(c='h')} AS w, count(*) AS n FROM h GROUP BY 1)
    SELECT o_orderkey, {SQL_SUNDAY.format(c='day')} AS day, coalesce(n, 0) AS "Is_Holiday"
    FROM o LEFT JOIN c ON {SQL_SUNDAY.format(c='day')} = w""",
)
def holidays_week(spark, d):
    weeks = calendar.move_to_weekday(order_days(spark, d), "day")
    return calendar.add_holidays(weeks, _holidays(spark), "day", "holiday", "Week")


@query(
    "holidays_month",
    f"""WITH {SQL_ODAY}, {SQL_HOLIDAYS}, c AS (SELECT last_day(h) AS w, count(*) AS n FROM h GROUP BY 1)
    SELECT o_orderkey, last_day(day) AS day, coalesce(n, 0) AS "Is_Holiday" FROM o LEFT JOIN c ON last_day(day) = w""",
)
def holidays_month(spark, d):
    months = calendar.move_to_month_end(order_days(spark, d), "day")
    return calendar.add_holidays(months, _holidays(spark), "day", "holiday", "Month")
