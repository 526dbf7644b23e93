"""Validity-rule engine.

All rules of one table run in ONE aggregate (one scan, partial aggregation)
and come back as long-form rows:
``check, table, violations, population, violations_pct, note``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curata.functions.nulls import not_in_domain
from curata.specs import Rule


def run_rules(df: DataFrame, rules: Sequence[Rule], digits: int = 3, weight: str | None = None) -> DataFrame:
    """Evaluate every rule of one frame in one pass.

    ``weight`` names a count column when each row stands for several rows
    (a pre-aggregated fan-out); violations and population then sum it.
    """
    def tally(pred):
        if weight is None:
            return F.count_if(pred)
        return F.coalesce(F.sum(F.when(pred, F.col(weight))), F.lit(0))

    aggs = []
    for i, r in enumerate(rules):
        pop = r.population if r.population is not None else F.lit(True)
        viol = F.coalesce(r.predicate, F.lit(False)) & F.coalesce(pop, F.lit(False))
        aggs.append(tally(viol).cast("long").alias(f"v{i}"))
        aggs.append(tally(F.coalesce(pop, F.lit(False))).cast("long").alias(f"p{i}"))
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(r.name).alias("check"), F.lit(r.table).alias("table"),
                        F.col(f"v{i}").alias("violations"), F.col(f"p{i}").alias("population"),
                        F.lit(r.note).alias("note")) for i, r in enumerate(rules)]
    long = wide.select(F.inline(F.array(*structs)))
    return long.select("check", "table", "violations", "population",
                       F.when(F.col("population") > 0,
                              F.round(F.lit(100.0) * F.col("violations") / F.col("population"), digits)).alias("violations_pct"),
                       "note")


def run_rule_sets(sets: Iterable[tuple[DataFrame, Sequence[Rule]]], digits: int = 3) -> DataFrame:
    out = None
    for df, rules in sets:
        part = run_rules(df, rules, digits)
        out = part if out is None else out.unionByName(part)
    return out


def domain_rules(table: str, domains: Mapping[str, Iterable]) -> list[Rule]:
    """V1: one ``in domain`` rule per column (null ignored, N6)."""
    return [Rule(f"{c} outside allowed domain", table, not_in_domain(c, list(vals))) for c, vals in domains.items()]


def unexpected_values(df: DataFrame, table: str, domains: Mapping[str, Iterable], width: int = 80) -> DataFrame:
    """Per (table, column) the sorted unexpected distinct values, as a list text cut to ``width``.

    Columns are unpivoted, so every column's distinct values are found with
    one grouped shuffle; only the (usually few) unexpected ones are gathered.
    """
    cols = list(domains)
    allowed = F.create_map(*[x for c in cols for x in (F.lit(c), F.array(*[F.lit(str(v)) for v in domains[c]]))])
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    bad = (long.where(F.col("value").isNotNull()).distinct()
           .where(~F.array_contains(allowed[F.col("column")], F.col("value"))))
    # Only the smallest values can reach the first ``width`` characters (each
    # listed value takes at least 3), so at most ``width`` values per column
    # are gathered; the row_number filter becomes a map-side group limit.
    w = Window.partitionBy("column").orderBy("value")
    head = bad.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= width)
    listed = head.groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("vals"))
    counts = bad.groupBy("column").agg(F.count(F.lit(1)).cast("long").alias("n_unexpected"))
    text = F.concat(F.lit("["), F.array_join(F.transform("vals", lambda v: F.concat(F.lit("'"), v, F.lit("'"))), ", "), F.lit("]"))
    return listed.join(counts, "column").select(F.lit(table).alias("table"), "column", "n_unexpected",
                                                F.substring(text, 1, width).alias("unexpected"))


def rows_of_ambiguous_groups(df: DataFrame, group: str, attr: str) -> DataFrame:
    """W8/V4.8: rows whose ``group`` value maps to more than one distinct ``attr``.

    Returns one row: violations (rows of such groups) and population (all
    rows). Grouping is two-level (group, attr) then group, both with map-side
    combine; no window over the group.
    """
    pairs = df.groupBy(group, attr).agg(F.count(F.lit(1)).alias("_n"))
    per_group = pairs.groupBy(group).agg(F.sum("_n").alias("_rows"), F.count(attr).alias("_n_attr"))
    return per_group.agg(
        F.coalesce(F.sum(F.when(F.col(group).isNotNull() & (F.col("_n_attr") > 1), F.col("_rows"))), F.lit(0)).cast("long").alias("violations"),
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("population"))
