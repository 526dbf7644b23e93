"""One daily run over a table set: quarantine, curate, monitor (§3.3, S6, S7, S9, S10, T1, T21).

``run_daily`` is a plain function; scheduling stays outside. Every output is
either an idempotent upsert (curated zone) or the folder of a ``run_id``,
replaced as a whole (re-running a day replaces that day only, also when it
has no rows any more).
The tagged lines and orders are written once to the intermediate zone and read
back, so the quarantine and the curated upsert do not recompute them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.operators.treat import split_zones
from curata.plans import catalog
from curata.plans.retail import LINE_KEY, Star
from curata.sources.io import zone_path
from curata.sources.upsert import upsert


def _write_run(df: DataFrame, path: str, run_id: str) -> None:
    df.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def run_daily(spark: SparkSession, input_dir: str, base_dir: str, run_id: str) -> dict:
    s = Star(spark, input_dir)

    # lines: tag once, keep the tagged table, split into curated / quarantine
    staged = zone_path(base_dir, "intermediate", "lineitem_tagged")
    _write_run(catalog.line_quarantine(s), staged, run_id)
    tagged = spark.read.parquet(f"{staged}/run_id={run_id}")
    lines_ok, lines_bad = split_zones(tagged)
    _write_run(lines_bad, zone_path(base_dir, "quarantine", "lineitem"), run_id)
    upsert(spark, lines_ok.drop("zone", "reasons"), zone_path(base_dir, "curated", "lineitem"), list(LINE_KEY), "l_shipdate")

    # orders: quarantine those without lines or with a wrong total, curate the rest
    staged = zone_path(base_dir, "intermediate", "orders_tagged")
    _write_run(catalog.q_order_quarantine(spark, input_dir), staged, run_id)
    oq = spark.read.parquet(f"{staged}/run_id={run_id}")
    _write_run(oq.where(F.col("zone") == "quarantine"), zone_path(base_dir, "quarantine", "orders"), run_id)
    orders_ok = s.orders_u().join(oq.where(F.col("zone") == "curated").select("o_orderkey"), "o_orderkey", "left_semi")
    upsert(spark, orders_ok, zone_path(base_dir, "curated", "orders"), "o_orderkey", "o_orderdate")

    # monitoring exports
    _write_run(catalog.anomaly_register(s), zone_path(base_dir, "monitoring", "anomaly_register"), run_id)
    _write_run(catalog.validity(s), zone_path(base_dir, "monitoring", "validity"), run_id)
    _write_run(catalog.q_scorecard(spark, input_dir), zone_path(base_dir, "monitoring", "scorecard"), run_id)

    counts = tagged.groupBy("zone").count().collect()   # at most two rows
    return {"run_id": run_id, **{f"lines_{r['zone']}": r["count"] for r in counts}}
