"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Inputs of more rows are too large for operators that hold one group in a
#: single task (see ``operators.ordered``).
SINGLE_TASK_ROWS = 500_000


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the operators rely on; cluster sizing is left alone."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", app: str = "tillwork") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    A single-machine session without the setting gets a folder of its own; a
    cluster without it is refused, since a machine-local path would be lost
    with its executor.
    """
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)
        return spark.sparkContext.getCheckpointDir() or folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillwork-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of a partition of a table that stays in hash partitions, where the shuffle setting gives fewer partitions.
DEALT_ROWS = 2_000_000


def dealt(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """A stored table of so many rows as a checkpoint in sorted hash partitions of ``keys``; later joins and groups on the keys shuffle nothing.

    Adaptive plans hide their partitions from a checkpoint, so they are off
    while it is made: ``df`` should not have joins of its own.
    """
    spark, name = df.sparkSession, "spark.sql.adaptive.enabled"
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // DEALT_ROWS))
    adaptive = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        return materialise(df.repartition(parts, *keys).sortWithinPartitions(*keys))
    finally:
        spark.conf.set(name, adaptive)


def written(df: DataFrame, name: str, rows_a_file: int = 0, by: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, whose size the planner reads from its files.

    For state that is joined with itself round after round: a checkpoint keeps the
    size estimated for its plan, and a join multiplies estimates, so that their
    digits double with each round and fill the driver.  With a column ``by``, a
    reader of one of its values opens the files of that value only.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("maxRecordsPerFile", rows_a_file)
    (writer.partitionBy(by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(table: DataFrame) -> None:
    """Delete the files of a table of ``written`` that no plan reads any more, without what other tables have."""
    spark = table.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fits_single_task(df: DataFrame, limit: int | bool | None = None) -> bool:
    """True only where ``df`` was counted to hold at most ``limit`` rows; a truth value is an answer known before.

    The rows are counted, not estimated: estimates are far off in both
    directions after an explode or a join.  Only the count reaches the driver.
    """
    if isinstance(limit, bool) or limit == 0:
        return bool(limit)
    return df.count() <= (SINGLE_TASK_ROWS if limit is None else limit)


#: Row limit of tables that are fetched and broadcast.
LOCAL_ROWS = 100_000


def small_side(df: DataFrame, rows: int = LOCAL_ROWS) -> DataFrame:
    """Broadcast a lookup table whose size has been checked; leave a larger one to Spark.

    The table is computed once here and kept as rows, so joining it costs the
    other side no shuffle.  A larger table is returned unchanged and joins as
    Spark decides, with its hot keys split at run time.
    """
    found = df.limit(rows + 1).collect()
    if len(found) > rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(found, df.schema))


def attach_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame (a global aggregate) to every row.

    ``row`` must come from an aggregate without grouping keys: exactly one
    row, so the broadcast has a fixed size whatever the data volume.
    """
    return df.crossJoin(F.broadcast(row))
