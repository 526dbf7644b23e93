"""The snapshots zone (S10): a table's versions with their validity intervals, one step per run.

``<base>/snapshots/<table>/open/run_id=...`` holds the versions valid after a
run, ``.../closed/run_id=...`` those that ended with it, ``.../changes/...``
what changed. A run replaces its own folders only; the open folder of the run
before is its input, so repeating a run gives the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curata.operators.history import advance, changes
from curata.sources.io import zone_path


def _folder(base: str, table: str, kind: str, run_id: str | None = None) -> str:
    path = f"{zone_path(base, 'snapshots', table)}/{kind}"
    return f"{path}/run_id={run_id}" if run_id else path


def take_snapshot(spark: SparkSession, state: DataFrame, key, base: str, table: str, run_id: str, at: str, previous: str | None = None) -> DataFrame:
    """Write one run's step after run ``previous`` (None: the first); returns the run's changes."""
    before = spark.read.parquet(_folder(base, table, "open", previous)) if previous else None
    opened, closed = advance(before, state, key, at)
    opened.write.mode("overwrite").parquet(_folder(base, table, "open", run_id))
    closed.write.mode("overwrite").parquet(_folder(base, table, "closed", run_id))
    opened, closed = (spark.read.parquet(_folder(base, table, kind, run_id)) for kind in ("open", "closed"))
    changes(opened, closed, key, at).write.mode("overwrite").parquet(_folder(base, table, "changes", run_id))
    return spark.read.parquet(_folder(base, table, "changes", run_id))


def history(spark: SparkSession, base: str, table: str, run_ids: list[str]) -> DataFrame:
    """All versions up to the last of ``run_ids`` (every run so far, in order)."""
    out = spark.read.parquet(_folder(base, table, "open", run_ids[-1]))
    for run_id in run_ids:
        out = out.unionByName(spark.read.parquet(_folder(base, table, "closed", run_id)))
    return out


def as_of(versions: DataFrame, moment: str) -> DataFrame:
    """The table's rows as they were at ``moment``."""
    return versions.where(f"valid_from <= timestamp'{moment}' and (valid_to is null or valid_to > timestamp'{moment}')").drop("row_hash", "valid_from", "valid_to")
