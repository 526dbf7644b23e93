"""Late-data-safe upsert.

Semantics of the curated MERGE:
* the batch is first reduced to its latest row per key (null time = oldest);
* a key present in the target is replaced only if ``s.ts >= t.ts``; ties
  take the batch; a null time on either side keeps the target;
* a key absent from the target is inserted; null keys never match, so rows
  with a null key are inserted on every run.

``merge_latest`` is that rule as one full outer join. ``upsert`` uses Delta
Lake's MERGE where it is on the classpath. Elsewhere every commit writes the
merged table as one Parquet snapshot folder (``snapshot=<n>``), which counts
once Spark has marked it complete; readers take the highest, and the last
``keep`` stay. That rewrites the table per commit: take Delta for tables that
are large against their batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.operators.dedup import latest
from curata.sources import fs
from curata.specs import as_tuple

SNAPSHOT = "snapshot"
EPOCHS = "epochs"          # per snapshot: the last applied batch of every stream


def merge_latest(target: DataFrame, source: DataFrame, key, ts: str = "updated_at",
                 dedup_source: bool = True) -> DataFrame:
    """Result of MERGE source INTO target with the guarded update rule."""
    keys = list(as_tuple(key))
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns: {missing}")
    s = latest(source, keys, ts, nulls="oldest") if dedup_source else source
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("_in_t"))
    s = s.select(*[F.col(c).alias(f"s_{c}") for c in target.columns], F.lit(True).alias("_in_s"))
    cond = [F.col(f"t_{k}") == F.col(f"s_{k}") for k in keys]
    j = t.join(s, cond, "full_outer")
    take_s = F.col("_in_t").isNull() | (
        F.col("_in_s").isNotNull() & F.coalesce(F.col(f"s_{ts}") >= F.col(f"t_{ts}"), F.lit(False)))
    return j.select(*[F.when(take_s, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in target.columns])


def _delta_available(spark: SparkSession) -> bool:
    try:
        import delta  # noqa: F401
    except Exception:
        return False
    return "Delta" in (spark.conf.get("spark.sql.extensions", "") or "")


def _numbers(spark: SparkSession, path: str, complete: bool = True) -> list[int]:
    """The numbers of the snapshot folders, ascending; only those that Spark has completed unless told otherwise."""
    names = [d for d in fs.list_dirs(spark, path) if d.startswith(f"{SNAPSHOT}=")]
    return sorted(int(d.split("=")[1]) for d in names if not complete or fs.exists(spark, f"{path}/{d}/_SUCCESS"))


def table_exists(spark: SparkSession, path: str) -> bool:
    """The path holds a curated table (a complete snapshot or a Delta log)."""
    return bool(_numbers(spark, path)) or fs.exists(spark, f"{path}/_delta_log")


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its last commit."""
    if fs.exists(spark, f"{path}/_delta_log"):
        return spark.read.format("delta").load(path)
    done = _numbers(spark, path)
    if not done:
        raise FileNotFoundError(f"no curated table at {path}")
    return spark.read.parquet(f"{path}/{SNAPSHOT}={done[-1]}")


def upsert(spark: SparkSession, df: DataFrame, path: str, key, ts: str = "updated_at", keep: int = 3,
           batch_key: str | None = None, batch_id: int | None = None) -> dict:
    """Apply one batch; returns {"version"} (and "skipped" for a replay).

    The first call writes the deduplicated batch (fails if the path already
    holds other data, like the default write mode). With ``batch_key`` and
    ``batch_id`` (a stream and its epoch) the snapshot knows the last applied
    id per key, so a replayed batch is skipped: exactly-once even for rows
    with a null key. Of two writers that start from one version, the second
    fails because its folder exists; a folder that a lost writer left
    incomplete is never read, and the next commit takes a new number.
    """
    keys = list(as_tuple(key))
    if _delta_available(spark):  # pragma: no cover - Delta not in this image
        from delta.tables import DeltaTable

        batch = latest(df, keys, ts, nulls="oldest")
        if not DeltaTable.isDeltaTable(spark, path):
            batch.write.format("delta").save(path)
            return {"version": 0}
        cond = " AND ".join(f"t.{k} = s.{k}" for k in keys)
        (DeltaTable.forPath(spark, path).alias("t").merge(batch.alias("s"), cond)
         .whenMatchedUpdateAll(condition=f"s.{ts} >= t.{ts}").whenNotMatchedInsertAll().execute())
        return {"version": None}

    foreign = [d for d in fs.list_dirs(spark, path) if not d.startswith(f"{SNAPSHOT}=") and d != EPOCHS]
    if foreign:
        raise FileExistsError(f"{path} holds data that is not a curated table: {foreign}")
    done, version = _numbers(spark, path), max(_numbers(spark, path, complete=False), default=-1) + 1
    applied: dict[str, int] = {}
    if done and fs.exists(spark, f"{path}/{EPOCHS}/{SNAPSHOT}={done[-1]}"):
        applied = {r.stream: r.epoch for r in spark.read.parquet(f"{path}/{EPOCHS}/{SNAPSHOT}={done[-1]}").collect()}     # one row per stream
    if batch_key is not None and batch_id is not None:
        if batch_id <= applied.get(batch_key, -1):
            return {"version": done[-1], "skipped": True}
        applied[batch_key] = batch_id
    out = latest(df, keys, ts, nulls="oldest")
    if done:
        out = merge_latest(read_current(spark, path).select(*df.columns), out, keys, ts, dedup_source=False)
    if applied:                     # before the snapshot, without which it means nothing
        # not createDataFrame, which would make a stream's own session the active one everywhere
        rows = F.array(*[F.struct(F.lit(k).alias("stream"), F.lit(v).cast("long").alias("epoch")) for k, v in applied.items()])
        spark.range(1).select(F.inline(rows)).coalesce(1).write.mode("overwrite").parquet(f"{path}/{EPOCHS}/{SNAPSHOT}={version}")
    out.write.mode("errorifexists").parquet(f"{path}/{SNAPSHOT}={version}")
    for old in (done + [version])[:-keep]:
        for folder in (f"{path}/{SNAPSHOT}={old}", f"{path}/{EPOCHS}/{SNAPSHOT}={old}"):
            fs.delete(spark, folder)
    return {"version": version}
