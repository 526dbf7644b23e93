"""Key, foreign-key and coverage reports (PR4-PR6, J14-J19).

The child side is always reduced to (key, rows) with map-side combine before
it meets the parent keys, so a key holding a third of the child rows costs
one row per map task in the shuffle, not a third of the data in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.operators.dedup import duplicate_summary
from curata.operators.joins import join_on_keys
from curata.specs import as_tuple


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def pk_report(tables: Mapping[str, tuple[DataFrame, object]]) -> DataFrame:
    """PR4: one row per table: rows, distinct/null keys, repeated and surplus rows, identical rows."""
    return _union(duplicate_summary(df, key, table=name) for name, (df, key) in tables.items()).drop("conflicting_rows")


def _key_counts(df: DataFrame, cols: tuple[str, ...], alias: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).cast("long").alias(alias))


def fk_check(child: DataFrame, fk, parent: DataFrame, pk, label: str) -> DataFrame:
    """PR5 for one foreign key: orphan_rows, orphan_pct, orphan_distinct_keys.

    A null foreign key is an orphan (N1): it never equals a parent key.
    """
    fk, pk = as_tuple(fk), as_tuple(pk)
    ck = _key_counts(child, fk, "_rows")
    pk_df = parent.select(*[F.col(p).alias(f"_pk{i}") for i, p in enumerate(pk)]).where(
        F.lit(True) if not pk else F.col("_pk0").isNotNull()).distinct().withColumn("_hit", F.lit(True))
    cond = [ck[f] == pk_df[f"_pk{i}"] for i, f in enumerate(fk)]
    j = ck.join(pk_df, cond, "left")
    any_null = F.lit(False)
    for f in fk:
        any_null = any_null | F.col(f).isNull()
    orphan = F.col("_hit").isNull()
    return j.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum(F.when(orphan, F.col("_rows"))), F.lit(0)).cast("long").alias("orphan_rows"),
        F.count_if(orphan & ~any_null).cast("long").alias("orphan_distinct_keys"),
    ).select(F.lit(label).alias("fk"), "rows", "orphan_rows",
             F.when(F.col("rows") > 0, F.lit(100.0) * F.col("orphan_rows") / F.col("rows")).alias("orphan_pct"),
             "orphan_distinct_keys")


def fk_report(checks: Iterable[tuple[DataFrame, object, DataFrame, object, str]]) -> DataFrame:
    """PR5: union of ``fk_check`` over (child, fk, parent, pk, label) tuples."""
    return _union(fk_check(*c) for c in checks)


def coverage_check(parent: DataFrame, pk, child: DataFrame, fk, label: str) -> DataFrame:
    """PR6/J16: distinct parent keys with no child row, and their share.

    Matching is null-safe (a null parent key is covered by a null child key),
    as ``isin`` does.
    """
    pk, fk = as_tuple(pk), as_tuple(fk)
    pkeys = parent.select(*pk).distinct()
    ckeys = child.select(*[F.col(f).alias(f"_c{i}") for i, f in enumerate(fk)]).distinct().withColumn("_hit", F.lit(True))
    cond = [pkeys[p].eqNullSafe(ckeys[f"_c{i}"]) for i, p in enumerate(pk)]
    j = pkeys.join(ckeys, cond, "left")
    return j.agg(F.count(F.lit(1)).cast("long").alias("parents"),
                 F.count_if(F.col("_hit").isNull()).cast("long").alias("parents_without_child")).select(
        F.lit(label).alias("relation"), "parents", "parents_without_child",
        F.when(F.col("parents") > 0, F.lit(100.0) * F.col("parents_without_child") / F.col("parents")).alias("pct_of_parents"))


def coverage_report(checks: Iterable[tuple[DataFrame, object, DataFrame, object, str]]) -> DataFrame:
    return _union(coverage_check(*c) for c in checks)


def orphans(child: DataFrame, fk, parent: DataFrame, pk, null_safe: bool = False) -> DataFrame:
    """Child rows whose key has no parent (``left_anti``).

    ``null_safe=False``: a null key is an orphan (N1); ``True``: null matches a
    null parent key (N2).
    """
    fk, pk = as_tuple(fk), as_tuple(pk)
    # the parent as it is: repeated keys don't matter to an anti join, and AQE can split a hot child key
    pkeys = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(pk)])
    cond = [(child[f].eqNullSafe(pkeys[f"_p{i}"]) if null_safe else child[f] == pkeys[f"_p{i}"]) for i, f in enumerate(fk)]
    return child.join(pkeys, cond, "left_anti")


def flag_orphans(child: DataFrame, fk, parent: DataFrame, pk, name: str = "is_orphan", null_safe: bool = False) -> DataFrame:
    """J15 as a flag column (keeps every child row); a hot child key is split (``join_on_keys``)."""
    fk, pk = as_tuple(fk), as_tuple(pk)
    pkeys = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(pk)]).distinct().withColumn("_hit", F.lit(True))
    j = join_on_keys(child, pkeys, [(f, f"_p{i}") for i, f in enumerate(fk)], "left", null_safe)
    return j.select(child["*"], F.col("_hit").isNull().alias(name))
