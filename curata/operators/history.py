"""Validity intervals from successive states of a table, and what changed between two."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.specs import as_tuple

PERIOD = ("row_hash", "valid_from", "valid_to")


def row_hash(columns: Sequence[str]) -> "F.Column":
    """SHA-256 of the values, each with its length, so that null, "" and shifted values differ."""
    part = lambda c: F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)
    return F.sha2(F.concat(*[F.coalesce(part(F.col(c).cast("string")), F.lit("-")) for c in columns]), 256)


def advance(open_rows: DataFrame | None, state: DataFrame, key, at: str) -> tuple[DataFrame, DataFrame]:
    """``(open, closed)``: the versions valid after this state, and those that ended with it.

    ``open_rows`` are the versions valid before (the columns of ``state`` and
    ``row_hash``, ``valid_from``, ``valid_to``; None at first). A key whose
    row hash is unchanged keeps its version; a changed, missing or new key
    closes and opens versions at ``at``; a key that returns opens a new one.
    Keys match null-safely; of rows with one key the smallest hash counts.
    """
    keys, columns = list(as_tuple(key)), state.columns
    when = F.lit(at).cast("timestamp")
    one = state.select(*keys, row_hash(columns).alias("row_hash"), F.struct(*columns).alias("row")).groupBy(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).agg(
        F.min_by("row", "row_hash").alias("row"), F.min("row_hash").alias("row_hash"))
    if open_rows is None:
        new = one.select("row.*", "row_hash", when.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
        return new, new.limit(0)
    old = open_rows.select(F.struct(*columns).alias("old_row"), *[F.col(k).alias(f"o{i}") for i, k in enumerate(keys)], F.col("row_hash").alias("old_hash"), F.col("valid_from").alias("old_from"))
    same = [F.col(f"k{i}").eqNullSafe(F.col(f"o{i}")) for i in range(len(keys))]
    j = one.join(old, same, "full_outer")
    kept = F.col("row_hash") == F.col("old_hash")
    opened = j.where("row_hash is not null").select("row.*", "row_hash", F.when(kept, F.col("old_from")).otherwise(when).alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    closed = j.where(F.col("old_hash").isNotNull() & ~F.coalesce(kept, F.lit(False))).select("old_row.*", F.col("old_hash").alias("row_hash"), F.col("old_from").alias("valid_from"), when.alias("valid_to"))
    return opened, closed


def changes(opened: DataFrame, closed: DataFrame, key, at: str) -> DataFrame:
    """``(key, change)`` of one run, from what ``advance`` returned: insert, update or delete."""
    keys = list(as_tuple(key))
    when = F.lit(at).cast("timestamp")
    new = opened.where(F.col("valid_from") == when).select(*keys, F.lit(True).alias("begins"), F.lit(False).alias("ends"))
    gone = closed.where(F.col("valid_to") == when).select(*keys, F.lit(False).alias("begins"), F.lit(True).alias("ends"))
    g = new.unionByName(gone).groupBy(*keys).agg(F.max("begins").alias("begins"), F.max("ends").alias("ends"))
    return g.select(*keys, F.when(F.col("begins") & F.col("ends"), "update").when(F.col("begins"), "insert").otherwise("delete").alias("change"))
