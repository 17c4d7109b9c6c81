"""Splits that move no rows, and costly rows dealt to all tasks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabularis.functions.keys import seeded_md5
from tabularis.operators import splits as X


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stratified_take_compares_with_the_cut(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("y"))
    quotas = {0: 0, 1: 417, 2: 5000}
    got = X.stratified_take(df, "k", "y", quotas)
    assert "Exchange" not in _plan(got)  # no row is sorted or moved
    order = Window.partitionBy("y").orderBy(seeded_md5(42, F.col("k").cast("string")))
    quota = F.when(F.col("y") == 1, 417).when(F.col("y") == 2, 5000).otherwise(0)
    want = df.withColumn("picked", (F.row_number().over(order) <= quota).cast("int"))
    assert sorted(map(tuple, got.select("k", "y", "picked").collect())) == sorted(map(tuple, want.collect()))


def test_stratified_take_cuts_through_rows_of_one_key(spark):
    df = spark.range(900).select(F.when(F.col("id") % 2 == 0, F.col("id") % 6).alias("k"), F.lit("a").alias("y"), "id")
    for quota in (1, 449, 451, 899):
        got = X.stratified_take(df, "k", "y", {"a": quota})
        assert got.count() == 900 and got.where("picked = 1").count() == quota
        assert got.select("id").distinct().count() == 900


def test_requests_are_made_by_all_tasks(spark, tmp_path):
    from tabularis.plans import scoring

    keys = spark.range(400).coalesce(1).selectExpr("id AS l_orderkey", "1 AS l_linenumber", "id % 5 AS l_partkey", "1L AS l_suppkey", "DATE'2020-01-01' AS l_shipdate")
    keys.selectExpr("*", "3.0D AS l_quantity", "0.1D AS l_discount", "0.1D AS l_tax", "'A' AS l_returnflag").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(5).selectExpr("id AS p_partkey", "7 AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    made = scoring.v_req(spark, str(tmp_path)).withColumn("p", F.spark_partition_id())
    assert made.count() == 400
    assert made.select("p").distinct().count() >= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_class_weights_move_no_row(spark):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("y"))
    weights = spark.range(2).select(F.col("id").alias("y"), F.lit(2.0).alias("weight"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in _plan(X.with_weight(df, "y", weights))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_kmeans_blocks_of_one_partition_are_dealt_to_tasks(spark):
    from tabularis.operators import kmeans

    points = spark.range(2000).coalesce(1).select("id", F.array(F.col("id").cast("double")).alias("coords"))
    most = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        blocks = kmeans.packed(points)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
    assert blocks.select(F.input_file_name()).distinct().count() >= 4
    assert blocks.agg(F.sum("n")).first()[0] == 2000
