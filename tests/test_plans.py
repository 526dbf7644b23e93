"""Plan shapes the scale design relies on (checked on the physical plan, not on timings)."""

from pyspark.sql import functions as F

from curata.operators import dedup, integrity
from curata.plans.retail import Star

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_row_is_limited_before_the_exchange(spark):
    li = Star(spark, SF).t("lineitem")
    plan = _plan(dedup.latest(li, ["l_orderkey", "l_linenumber"], "l_shipdate"))
    # partial WindowGroupLimit below the exchange, final one above: a hot key leaves each map task as one row
    assert plan.count("WindowGroupLimit") >= 2
    deepest_limit, exchange = plan.rfind("WindowGroupLimit"), plan.rfind("Exchange hashpartitioning")
    assert exchange < deepest_limit   # printed top-down: the deepest WindowGroupLimit sits under the exchange


def test_foreign_key_child_is_pre_aggregated(spark):
    s = Star(spark, SF)
    plan = _plan(integrity.fk_check(s.t("lineitem"), "l_partkey", s.t("part"), "p_partkey", "fk"))
    assert "partial_count" in plan


def test_filters_and_columns_reach_the_scan(spark):
    s = Star(spark, SF)
    df = s.active_parts().select("p_partkey").join(s.t("lineitem").select("l_partkey", "l_quantity"),
                                                   F.col("p_partkey") == F.col("l_partkey"))
    plan = _plan(df)
    assert "GreaterThan(p_size,5)" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan


def test_payment_facts_group_the_events_once(spark):
    from curata.plans.catalog import payment_facts
    plan = _plan(payment_facts(Star(spark, SF)))
    assert plan.count("Scan parquet") == 1 and "Join" not in plan


def test_frequencies_of_several_columns_scan_once(spark):
    from curata.operators import reshape
    plan = _plan(reshape.frequencies(Star(spark, SF).t("orders"), ["o_orderstatus", "o_orderpriority"]))
    assert plan.count("Scan parquet") == 1


def test_hot_keys_are_split(spark):
    """Half of the rows on one key: AQE must split the join's hot partition, also against an aggregated or ranked parent."""
    from curata.operators import identity
    from curata.operators.joins import join_on_keys
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        child = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).cast("long").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"), "id")
        parent = spark.range(0, 40_000, 1, 8).select(F.col("id").alias("p"), F.rand(1).alias("x"))
        ranked = dedup.latest(parent, "p", "x")
        frames = {"flag_orphans": integrity.flag_orphans(child, "k", parent, "p"), "orphans": integrity.orphans(child, "k", parent.where("p <> 7"), "p"),
                  "master_id": identity.master_id(child, "k", "id"), "ranked parent": join_on_keys(child, ranked, [("k", "p")], "left")}
        for name, df in frames.items():
            df.collect()
            assert "skew=true" in _plan(df), name
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
