"""Queries of this subpackage, by name, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwork.session import tune

#: Bytes of a batch that a Python worker gets at once, so that very long texts come in few rows.
BATCH_BYTES = 4 << 20

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tuned(spark: SparkSession) -> SparkSession:
    """The session with the settings of the library, and batches of bounded size."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return tune(spark)


def query(name: str, sql: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(tuned(spark), folder)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
