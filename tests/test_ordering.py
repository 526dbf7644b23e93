"""positions(): equal to row_number over the key, without a key-partitioned window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from curata.operators import dedup, payments
from curata.operators.ordering import positions


def _skewed(spark, n=6000):
    # key 7 holds a third of the rows; some keys are null; ts repeats so the tie column decides
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 101 == 1, F.lit(None))
        .otherwise(F.col("id") % 97).alias("k"),
        F.when(F.col("id") % 13 == 0, F.lit(None)).otherwise(F.col("id") * 7919 % 50).alias("ts"),
        F.col("id").alias("tie"))


def test_positions_match_row_number(spark):
    df = _skewed(spark)
    order = [F.col("ts").asc_nulls_last(), F.col("tie").asc()]
    got = positions(df, "k", order, "pos", partitions=8)
    exp = df.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("long"))
    assert got.count() == df.count()
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_positions_plan_has_no_key_window_over_rows(spark):
    df = _skewed(spark)
    plan = positions(df, "k", [F.col("tie").asc()], "pos")._jdf.queryExecution().executedPlan().toString()
    # the only window runs over the (key, partition) segments, never over the rows
    assert "row_number" not in plan


def test_surplus_flag_on_hot_key(spark):
    df = _skewed(spark).withColumnRenamed("k", "order_id")
    flags = dedup.flag_surplus(df, "order_id", ["ts"], tie=["tie"])
    per_key = flags.groupBy("order_id").agg(F.count_if(~F.col("is_surplus")).alias("firsts"))
    assert per_key.where(F.col("firsts") != 1).count() == 0
    assert flags.where("is_surplus").count() == df.count() - df.select("order_id").distinct().count()


def test_attempt_numbers_and_reference(spark):
    rows = [("o1", 1, "FAILED", 10.0), ("o1", 2, "CAPTURED", 10.0), ("o1", 3, "CAPTURED", 10.0),
            ("o2", 4, "FAILED", 5.0), ("o3", None, "CAPTURED", 7.0), ("o3", 5, "CAPTURED", 7.0)]
    df = spark.createDataFrame(rows, "order_id string, ts long, status string, amount double")
    df = df.withColumn("pid", F.monotonically_increasing_id())
    ref, att = payments.reference_payment(df, ["order_id"], "status", "ts", "pid")
    got = {(r.order_id, r.ts, r.attempt_no) for r in ref.collect()}
    # null time sorts last among attempts and counts as the newest capture
    assert got == {("o1", 3, 3), ("o3", None, 2)}
    assert sorted(r.attempt_no for r in att.where("order_id = 'o1'").collect()) == [1, 2, 3]


def test_positions_with_aqe_coalesced_ranges(spark):
    # many range partitions on small data: AQE merges neighbouring ranges, ids must stay in sort order
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = _skewed(spark, 3000)
        order = [F.col("ts").desc_nulls_first(), F.col("tie").desc()]
        got = positions(df, "k", order, "pos")
        exp = df.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("long"))
        assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
