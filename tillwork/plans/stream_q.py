"""Streaming queries on the event table, run over all files there are."""

from pyspark.sql import functions as F

from tillwork.streaming import history

from .eda_q import rounded
from .registry import query


def events(spark, d):
    return history.read_files(spark, f"{d}/events*.parquet").select("event_id", "ts", "user_id", "event_type", "value")


@query(
    "stream_days_since",
    """SELECT event_id, user_id, CAST(coalesce(date_diff('day', lag(CAST(ts AS DATE)) OVER w, CAST(ts AS DATE)), 0) AS INTEGER) AS days_since
    FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def stream_days_since(spark, d):
    stream = events(spark, d).filter(F.col("user_id").isNotNull())
    return history.run_available(history.days_since_previous(stream, ["user_id"], "ts", "event_id"), "days").select("event_id", "user_id", "days_since")


@query(
    "stream_carry_over",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events)
    SELECT a.event_id, round(sum(coalesce(b.value, 0) * 0.5::DOUBLE ** ((a.n - b.n) / 3.0)), 6) AS adstock
    FROM r a JOIN r b ON a.user_id = b.user_id AND a.event_type = b.event_type AND b.n <= a.n GROUP BY a.event_id""",
)
def stream_carry_over(spark, d):
    stream = history.carry_over(events(spark, d), ["user_id", "event_type"], "ts", "event_id", "value", 3.0)
    return rounded(history.run_available(stream, "adstock").select("event_id", "adstock"), 6, "adstock")


@query("stream_first", "SELECT DISTINCT user_id, event_type FROM events")
def stream_first(spark, d):
    stream = history.first_within(events(spark, d), ["user_id", "event_type"], "ts", "3650 days")
    return history.run_available(stream, "first").select("user_id", "event_type")
