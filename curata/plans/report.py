"""The profiling report as tables (§3.2): every registered query written once per run.

The notebook computes its sections in order and keeps the intermediate
frames alive; here every section is a query of ``catalog.QUERIES`` and the
report is the set of tables they produce. Quality outputs go to the
``monitoring`` zone, business marts to ``marts``; each replaces the folder of
its ``run_id`` (re-running a day replaces that day only). Queries that
measure sizes or quantiles run Spark jobs while they are built.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from curata.plans.catalog import QUERIES, q_pii_rehash
from curata.sources.io import zone_path

# The business marts (M1-M28, C2/C3 matrices); every other query is a quality output.
MARTS = {
    "orders_by_month", "value_index", "monthly_volume", "weekday_hour", "weekday_hour_range", "status_channel_freq",
    "mix_by_country", "headline_shares", "value_by_currency", "value_box_stats", "basket", "basket_frequency",
    "units_by_category", "category_mix", "seller_concentration", "brand_stats", "payment_mix", "failure_rate",
    "carrier_scorecard", "delay_by_priority", "balance_histogram", "customer_base", "orders_per_customer",
    "segment_activity", "bias_table", "crosstab_row_pct", "status_matrix_lines", "status_matrix_returns", "rfm", "rfm_master",
    "payment_status_by_method", "tier_activity", "fx_value", "delay_treated", "size_values", "customer_base_views",
}


def zone_of(name: str) -> str:
    return "marts" if name in MARTS else "monitoring"


def run_profiling(spark: SparkSession, input_dir: str, base_dir: str, run_id: str,
                  names: Iterable[str] | None = None, salt: str | None = None) -> dict[str, str]:
    """Write each registered query (or the named ones) under its zone; returns name -> path.

    Salted hashes of personal data (T16) are written only with a ``salt``,
    which is used and not stored.
    """
    chosen = list(names) if names is not None else [n for n in QUERIES if salt or n != "pii_rehash"]
    if "pii_rehash" in chosen and not salt:
        raise ValueError("pii_rehash needs a salt")
    unknown = [n for n in chosen if n not in QUERIES]
    if unknown:
        raise KeyError(f"unknown report tables: {unknown}")
    written = {}
    for name in chosen:
        path = zone_path(base_dir, zone_of(name), name)
        made = q_pii_rehash(spark, input_dir, salt) if name == "pii_rehash" else QUERIES[name](spark, input_dir)
        made.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")
        written[name] = path
    return written
