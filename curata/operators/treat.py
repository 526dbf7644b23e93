"""Treatments: quarantine, alerts, product flags.

A quarantine never deletes: every input row comes out exactly once, tagged
``zone`` = curated | quarantine with the list of reasons, so
curated ∪ quarantine = input by construction.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_reasons(df: DataFrame, reasons: Mapping[str, Column], sep: str = ",") -> DataFrame:
    """Add ``reasons`` (names of the true predicates, in the given order) and ``zone``."""
    names = [F.when(F.coalesce(pred, F.lit(False)), F.lit(name)) for name, pred in reasons.items()]
    r = F.concat_ws(sep, *names)
    return df.withColumn("reasons", r).withColumn(
        "zone", F.when(F.col("reasons") == "", F.lit("curated")).otherwise(F.lit("quarantine")))


def split_zones(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(curated rows, quarantined rows) of a tagged frame."""
    return tagged.where(F.col("zone") == "curated"), tagged.where(F.col("zone") == "quarantine")


def reason_rates(tagged: DataFrame, reasons: list[str], threshold_pct: float = 1.0) -> DataFrame:
    """Rows and rate per reason, with an alert when the rate exceeds the threshold."""
    total = F.count(F.lit(1))
    aggs = [F.count_if(F.array_contains(F.split("reasons", ","), r)).alias(f"_r{i}") for i, r in enumerate(reasons)]
    wide = tagged.agg(total.alias("_n"), *aggs)
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(r).alias("reason"), F.col(f"_r{i}").cast("long").alias("rows"), F.col("_n").cast("long").alias("population"))
        for i, r in enumerate(reasons)])))
    rate = F.when(F.col("population") > 0, F.lit(100.0) * F.col("rows") / F.col("population"))
    return long.withColumn("rate_pct", rate).withColumn("alert", F.coalesce(F.col("rate_pct") > threshold_pct, F.lit(False)))
