"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tillwork.session import scratch_path


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def spill(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and not lost with an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._spilled_to = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a spilled table that nothing reads any more."""
    spark, path = df.sparkSession, getattr(df, "_spilled_to", None)
    if path:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Held:
    """Tables that are computed once and kept on the executors' disks until ``release``.

    A part that is lost with its executor is computed again from its lineage.  For
    tables between a few reads; where lineage must be cut, ``spill`` them.
    """

    def __init__(self):
        self.tables: list[DataFrame] = []

    def keep(self, df: DataFrame) -> DataFrame:
        self.tables.append(df.persist(StorageLevel.DISK_ONLY))
        return self.tables[-1]

    def release(self) -> None:
        for table in reversed(self.tables):
            table.unpersist()
        self.tables.clear()
