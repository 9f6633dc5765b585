from pyspark.sql import functions as F

from tillwork.session import fits_single_task, shared_folder, small_side


def test_size_is_counted_not_estimated(spark, folder):
    df = spark.read.parquet(f"{folder}/lineitem.parquet")
    assert fits_single_task(df) and not fits_single_task(df, 0)
    exploded = df.limit(1000).select(F.explode(F.sequence(F.lit(1), F.lit(1000))))
    assert not fits_single_task(exploded)
    assert fits_single_task(df.alias("a").join(df.alias("b"), ["l_orderkey", "l_linenumber"], "left_semi"))


def test_small_side_is_broadcast_without_a_shuffle(spark, folder):
    fact = spark.read.parquet(f"{folder}/lineitem.parquet")
    dim = spark.createDataFrame([("A", 1), ("R", 2)], "l_returnflag string, k int")
    plan = fact.join(small_side(dim), "l_returnflag")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert small_side(dim, rows=1) is dim


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.sparkContext.getCheckpointDir()
