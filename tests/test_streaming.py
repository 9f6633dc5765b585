import datetime as dt
import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import values
from tillwork.session import scratch_path
from tillwork.streaming import history


def in_files(spark, rows, schema, parts):
    """The rows in files that are read one after another."""
    path, size = scratch_path(spark, "stream"), -(-len(rows) // parts)
    for k in range(parts):
        spark.createDataFrame(rows[k * size : (k + 1) * size], schema).coalesce(1).write.mode("append").parquet(path)
    return path


def some_rows(n):
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    return [(i, start + dt.timedelta(hours=9 * i), rng.choice("abc"), float(rng.randrange(9)) if i % 11 else None) for i in range(n)]


SCHEMA = "id long, at timestamp, g string, x double"


def test_days_and_carry_over_of_many_batches_equal_one_batch(spark):
    rows = some_rows(90)
    path = in_files(spark, rows, SCHEMA, 5)
    one = spark.createDataFrame(rows, SCHEMA)
    by = Window.partitionBy("g").orderBy("at", "id")
    days = one.select("id", F.coalesce(F.date_diff(F.to_date("at"), F.lag(F.to_date("at")).over(by)), F.lit(0)))
    got = history.run_available(history.days_since_previous(history.read_files(spark, path, 1), ["g"], "at", "id"), "days")
    assert values(got.select("id", "days_since")) == values(days)
    wanted, last = {}, {}
    for i, _, g, x in rows:
        last[g] = wanted[i] = (x or 0.0) + 0.5 ** 0.5 * last.get(g, 0.0)
    got = history.run_available(history.carry_over(history.read_files(spark, path, 2), ["g"], "at", "id", "x", 2.0), "carry")
    assert {r["id"]: round(r["adstock"], 9) for r in got.collect()} == {i: round(v, 9) for i, v in wanted.items()}


def test_groups_share_calls(spark):
    """Many groups, with keys and numbers that are null or beyond the integers of a float, in far fewer calls than groups."""
    big, day = 2**60, dt.datetime(2024, 1, 1)
    keys = [*range(300), None, big, big + 1]
    rows = [(big + 400 * t + i if i else None, day + dt.timedelta(days=t), g, h, 1.0) for t in range(4) for i, g in enumerate(keys) for h in ("x", None)]
    schema = "id long, at timestamp, g long, h string, x double"
    path, calls = in_files(spark, rows, schema, 4), spark.sparkContext.accumulator(0)

    def step(part, first, carried):
        calls.add(1)
        group = np.cumsum(first) - 1
        count = np.arange(len(part)) - np.flatnonzero(first)[group] + np.array([c or 0 for c in carried])[group]
        return count, (count + 1)[np.r_[first[1:], True]].tolist()

    stream = history._stateful(history.read_files(spark, path, 1), ["g", "h"], "at", "id", step, "n", "long", parts=4)
    got = history.run_available(stream, "shared").collect()
    assert calls.value <= 4 * 4 * 4
    assert sorted(((r["id"] or 0), str(r["g"]), str(r["h"]), r["n"]) for r in got) == sorted(
        ((i or 0), str(g), str(h), (at - day).days) for i, at, g, h, _ in rows)


def test_first_rows_within_a_time(spark):
    path = in_files(spark, some_rows(60), SCHEMA, 3)
    got = history.run_available(history.first_within(history.read_files(spark, path, 1), ["g"], "at", "400 days"), "first")
    assert sorted(r["g"] for r in got.collect()) == ["a", "b", "c"]
