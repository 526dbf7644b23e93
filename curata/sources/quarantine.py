"""Quarantine with release (T2, T21): rows held for a missing parent move to the curated zone once it arrives.

A run's folder of the quarantine zone holds every row that is held after the
run; the curated zone gets one folder of new rows per run. So after each run
the curated folders so far and the last quarantine folder are the input so
far, every row once. Held orphans are compared with the parents that arrived
since the last run only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.operators.joins import join_on_keys
from curata.sources.io import zone_path


def release(held: DataFrame, arrived: DataFrame, fk: str, pk: str, reason: str = "orphan", sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """``(released, still_held)``: rows of ``held`` lose ``reason`` if their parent is among ``arrived``; those without another one are released."""
    reasons = F.split("reasons", sep)
    has = F.array_contains(reasons, reason)
    parents = arrived.where(F.col(pk).isNotNull()).select(F.col(pk).alias("_parent")).distinct().withColumn("_came", F.lit(True))
    j = join_on_keys(held, parents, [(fk, "_parent")], "left")
    left: Column = F.when(has & F.col("_came").isNotNull(), F.array_join(F.array_remove(reasons, reason), sep)).otherwise(F.col("reasons"))
    after = j.withColumn("reasons", left).drop("_parent", "_came").withColumn("zone", F.when(F.col("reasons") == "", "curated").otherwise("quarantine"))
    return after.where("zone = 'curated'"), after.where("zone = 'quarantine'")


def settle(spark: SparkSession, tagged: DataFrame, parents: DataFrame, fk: str, pk: str, base: str, table: str, run_id: str, previous: str | None = None) -> dict[str, int]:
    """One run over new rows ``tagged`` with zone and reasons; ``parents`` are the run's rows of the parent table.

    Writes the parents known so far (intermediate), the curated rows of the
    run and the quarantine after it, each under its ``run_id``; returns row
    counts. Rows of ``tagged`` are expected to be orphans only if none of the
    parents known so far has their key.
    """
    known, held_at = (f"{zone_path(base, zone, name)}/run_id=" for zone, name in (("intermediate", f"{table}_parents"), ("quarantine", table)))
    now = parents.select(F.col(pk).alias("key")).where("key is not null").distinct()
    ok, bad = tagged.where("zone = 'curated'"), tagged.where("zone = 'quarantine'")
    ok, bad = ok.withColumn("released", F.lit(False)), bad.withColumn("held_since", F.lit(run_id))
    if previous:
        before = spark.read.parquet(known + previous)
        arrived = now.join(before, "key", "left_anti")
        now = before.unionByName(arrived)
        out, still = release(spark.read.parquet(held_at + previous), arrived, fk, "key")
        ok = ok.unionByName(out.drop("held_since").withColumn("released", F.lit(True)))
        bad = bad.unionByName(still)
    paths = {"curated": f"{zone_path(base, 'curated', table)}/run_id={run_id}", "quarantine": held_at + run_id, "parents": known + run_id}
    now.write.mode("overwrite").parquet(paths["parents"])
    bad.write.mode("overwrite").parquet(paths["quarantine"])
    ok.drop("zone", "reasons").write.mode("overwrite").parquet(paths["curated"])
    counts = spark.read.parquet(paths["curated"]).agg(F.count(F.lit(1)), F.count_if("released")).first()
    return {"curated": counts[0], "released": counts[1], "held": spark.read.parquet(paths["quarantine"]).count()}


def known_parents(spark: SparkSession, base: str, table: str, run_id: str | None) -> DataFrame | None:
    """The parent keys known after a run, as column ``key``."""
    return spark.read.parquet(f"{zone_path(base, 'intermediate', f'{table}_parents')}/run_id={run_id}") if run_id else None
