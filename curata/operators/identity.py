"""Duplicate identities and master records.

"Identical profile" uses min/max/count per column instead of one distinct
count per column: a column has at most one value in a group iff its min
equals its max. That keeps the aggregation partial (map-side combined) and
avoids the Expand that several DISTINCT aggregates would need. Distinct
members are counted in two grouped levels, (identity, member) and then
identity, both map-side combined: a DISTINCT aggregate would shuffle on the
identity alone and send every member of a hot identity to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.operators.joins import join_on_keys


def identity_groups(df: DataFrame, identity: str, member_id: str, profile_cols: Sequence[str],
                    keep_null: bool = False) -> DataFrame:
    """Per identity value: rows, distinct members, identical-profile flag (null dropped unless asked, N7)."""
    src = df if keep_null else df.where(F.col(identity).isNotNull())
    inner = [F.count(F.lit(1)).alias("_r")]
    outer = [F.sum("_r").cast("long").alias("rows"), F.count_if(F.col(member_id).isNotNull()).cast("long").alias("n_ids")]
    for c in profile_cols:
        inner += [F.min(c).alias(f"_mn_{c}"), F.max(c).alias(f"_mx_{c}"), F.count(c).alias(f"_n_{c}")]
        outer += [F.min(f"_mn_{c}").alias(f"_mn_{c}"), F.max(f"_mx_{c}").alias(f"_mx_{c}"),
                  F.sum(f"_n_{c}").alias(f"_n_{c}")]
    g = src.groupBy(identity, member_id).agg(*inner).groupBy(identity).agg(*outer)
    at_most_one = F.lit(True)
    some_one = F.lit(False)
    for c in profile_cols:
        single = (F.col(f"_n_{c}") == 0) | (F.col(f"_mn_{c}") == F.col(f"_mx_{c}"))
        at_most_one = at_most_one & single
        some_one = some_one | ((F.col(f"_n_{c}") > 0) & (F.col(f"_mn_{c}") == F.col(f"_mx_{c}")))
    return g.select(identity, "rows", "n_ids", (at_most_one & some_one).alias("identical_profile"))


def duplicate_identity_summary(df: DataFrame, identity: str, member_id: str, profile_cols: Sequence[str]) -> DataFrame:
    """A7a in one row: rows, surplus rows (nulls count as equal, N8), duplicate groups, identical groups."""
    g = identity_groups(df, identity, member_id, profile_cols, keep_null=True)
    dup = F.col(identity).isNotNull() & (F.col("rows") > 1)
    return g.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).cast("long").alias("surplus_rows"),
        F.count_if(dup).cast("long").alias("dup_groups"),
        F.coalesce(F.sum(F.when(dup, F.col("rows"))), F.lit(0)).cast("long").alias("rows_in_dup_groups"),
        F.count_if(dup & F.col("identical_profile")).cast("long").alias("identical_profile_groups"))


def group_sizes(df: DataFrame, identity: str, member_id: str) -> DataFrame:
    """Distribution of the number of distinct members per duplicated identity."""
    per_member = df.where(F.col(identity).isNotNull()).groupBy(identity, member_id).agg(F.count(F.lit(1)).alias("_r"))
    g = (per_member.groupBy(identity)
         .agg(F.sum("_r").alias("_rows"), F.count_if(F.col(member_id).isNotNull()).cast("long").alias("group_size"))
         .where(F.col("_rows") > 1))
    return g.groupBy("group_size").agg(F.count(F.lit(1)).cast("long").alias("n_groups"))


def master_id(df: DataFrame, identity: str, member_id: str, name: str = "master_id") -> DataFrame:
    """Every row gets the smallest member id sharing its identity; null identity keeps its own id.

    The (identity -> smallest id) map is a map-side-combined aggregate joined
    back on the identity with ``join_on_keys``, so that a hot identity is split.
    """
    m = df.where(F.col(identity).isNotNull()).groupBy(F.col(identity).alias("_identity")).agg(F.min(member_id).alias("_m"))
    j = join_on_keys(df, m, [(identity, "_identity")], "left")
    return j.select(df["*"], F.coalesce(F.col("_m"), F.col(member_id)).alias(name))


def surrogate_key(*cols) -> "F.Column":
    """Deterministic surrogate key from the natural columns.

    Every part is written with its length, so no two different rows of values
    give the same text: ("a|b", "c") and ("a", "b|c") differ, as do null and "".
    """
    part = lambda c: F.concat(F.length(c).cast("string"), F.lit(":"), c)
    return F.sha2(F.concat(*[F.coalesce(part(F.col(c).cast("string")), F.lit("-")) for c in cols]), 256)
