"""File sources and sinks, on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillwork.functions.hashing import digest_sum, row_digest
from pyspark.sql import functions as F


def load_csv(spark: SparkSession, path, schema: StructType | str | None = None, **options) -> DataFrame:
    """CSV scan; pass a schema for large files, since inference reads them twice."""
    reader = spark.read.options(**{"header": True, **options})
    return reader.schema(schema).csv(path) if schema else reader.csv(path, inferSchema=True)


def load_parquet(spark: SparkSession, path, **options) -> DataFrame:
    """Parquet scan; a stray ``index`` column written by other tools is dropped."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.options(**options).parquet(*paths).drop("index")


def file_format(path: str) -> str:
    ending = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if ending not in ("csv", "parquet"):
        raise NotImplementedError(f"no reader or writer for {path!r}")
    return ending


def load_data(spark: SparkSession, path: str, **options) -> DataFrame:
    """Load by file extension."""
    return {"csv": load_csv, "parquet": load_parquet}[file_format(path)](spark, path, **options)


def save_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    df.write.mode(mode).options(**{"header": True, **options}).csv(path)


def save_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=(), **options) -> None:
    df.write.mode(mode).options(**options).partitionBy(*partition_by).parquet(path)


def save_data(df: DataFrame, path: str, **options) -> None:
    """Save by file extension, to whichever file system the path names."""
    {"csv": save_csv, "parquet": save_parquet}[file_format(path)](df, path, **options)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None) -> DataFrame:
    """Register a table (managed, or at ``path``); blanks in column names become underscores."""
    renamed = df.withColumnsRenamed({c: c.replace(" ", "_") for c in df.columns if " " in c})
    writer = renamed.write.mode(mode).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def sql_scan(spark: SparkSession, name: str, columns=("*",)) -> DataFrame:
    """Scan a table by name; the result stays distributed."""
    return spark.table(name).select(*columns)


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive content fingerprint: row count and the sums of the four parts of row digests."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), digest_sum(row_digest(df.columns)).alias("fingerprint"))
