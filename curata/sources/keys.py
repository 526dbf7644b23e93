"""A persistent table of surrogate keys (T15): allocated once, never changed; colliding ids are held and alerted.

Rows ``(id, identity, key, collides, first_run)``. ``identity`` is a hash of
what makes an entity one (its e-mail, say). A batch adds the (id, identity)
pairs that the table lacks and numbers them after its largest key; an id that
stands for more than one identity is a collision, and all its rows are marked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.operators.history import row_hash
from curata.operators.joins import join_on_keys
from curata.operators.ordering import positions


def allocate(spark: SparkSession, batch: DataFrame, id_column: str, identity: Sequence[str], folder: str, run_id: str, previous: str | None = None) -> dict[str, int]:
    """Write the key table after this batch to ``folder/run_id=<run_id>`` and return counts; rows without an id are left out.

    New keys follow the order of (id, identity), so a repeated run gives the
    same ones; numbering gathers nothing in one task (``positions``).
    """
    pairs = batch.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("id"), row_hash(identity).alias("identity")).distinct()
    base, old = 0, None
    if previous:
        old = spark.read.parquet(f"{folder}/run_id={previous}").select("id", "identity", "key", "first_run")
        base = old.agg(F.coalesce(F.max("key"), F.lit(0))).first()[0]
        pairs = pairs.join(old, ["id", "identity"], "left_anti")
    new = positions(pairs.withColumn("all", F.lit(1)), "all", [F.col("id").asc(), F.col("identity").asc()], "n").select(
        "id", "identity", (F.col("n") + base).alias("key"), F.lit(run_id).alias("first_run"))
    every = new if old is None else old.unionByName(new)
    several = every.groupBy(F.col("id").alias("i")).agg((F.count(F.lit(1)) > 1).alias("collides"))
    out = join_on_keys(every, several, [("id", "i")], "inner").select("id", "identity", "key", "collides", "first_run")
    out.write.mode("overwrite").parquet(f"{folder}/run_id={run_id}")
    c = spark.read.parquet(f"{folder}/run_id={run_id}").agg(
        F.count(F.lit(1)), F.count_if(F.col("first_run") == run_id), F.count_if("collides"), F.count_if(F.col("collides") & (F.col("first_run") == run_id))).first()
    return {"keys": c[0], "new_keys": c[1], "colliding_keys": c[2], "new_colliding_keys": c[3]}


def with_keys(batch: DataFrame, keys: DataFrame, id_column: str, identity: Sequence[str], name: str = "key") -> tuple[DataFrame, DataFrame]:
    """``(rows, held)``: rows of ``batch`` with their key, and rows whose id collides (also with their key) for the quarantine."""
    cols = batch.columns
    k = keys.select(F.col("id").alias("_id"), F.col("identity").alias("_identity"), F.col("key").alias(name), "collides")
    j = join_on_keys(batch.withColumn("_hash", row_hash(identity)), k, [(id_column, "_id"), ("_hash", "_identity")], "inner")
    return j.where("not collides").select(*cols, name), j.where("collides").select(*cols, name)
