"""Frequencies, crosstabs, shares, summaries, histograms.

Results are long form (one row per cell) unless a pivot is asked for with
known column values, so that their schema does not depend on the data.
Windows used for shares run on already-aggregated frames and are partitioned
by the row label, never over the raw rows; a share of the grand total
divides by a scalar subquery (``DataFrame.scalar``), so the cells are never
gathered in one partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.functions.scalars import hist_bin
from curata.operators.joins import small_side
from curata.operators.quantiles import exact_quantiles, quantiles_of_counts, value_counts

ALL = "All"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def frequency(df: DataFrame, col: str, dropna: bool = False, name: str = "n", pct: str | None = "pct") -> DataFrame:
    """``value_counts`` (with or without nulls) and share of the counted rows."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    out = src.groupBy(col).agg(F.count(F.lit(1)).cast("long").alias(name))
    if pct:
        out = grand_share(out, name, pct)
    return out


def frequencies(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), dropna: bool = True,
                name: str = "n", pct: str = "pct") -> DataFrame:
    """G11/W11 for several columns in ONE pass: (by..., dimension, value, n, pct).

    The columns are unpivoted to (dimension, value as text) and counted
    together; ``pct`` is the share of the value within its (by..., dimension)
    rows, so each dimension reads like its own ``value_counts(normalize=True)``.
    Rows with a null ``by`` label are dropped, as in a crosstab.
    """
    by = list(by)
    src = df
    for b in by:
        src = src.where(F.col(b).isNotNull())
    long = src.select(*by, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(by, list(cols), "dimension", "value")
    if dropna:
        long = long.where(F.col("value").isNotNull())
    counts = long.groupBy(*by, "dimension", "value").agg(F.count(F.lit(1)).cast("long").alias(name))
    return row_share(counts, [*by, "dimension"], name, pct)


def crosstab(df: DataFrame, row: str, col: str, value: str | None = None, agg: str = "count",
             name: str = "n") -> DataFrame:
    """Long-form crosstab; rows with a null label are dropped like pandas."""
    src = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    if value is None:
        return src.groupBy(row, col).agg(F.count(F.lit(1)).cast("long").alias(name))
    fn = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max}[agg]
    return src.groupBy(row, col).agg(fn(value).alias(name))


def crosstab_margins(df: DataFrame, row: str, col: str, name: str = "n", all_label: str = ALL) -> DataFrame:
    """Counts with row, column and grand totals (``margins=True``): cells counted first, then a CUBE over the cells."""
    cells = df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).select(
        F.col(row).cast("string").alias(row), F.col(col).cast("string").alias(col)).groupBy(row, col).agg(F.count(F.lit(1)).alias("_cell"))
    g = cells.cube(row, col).agg(F.sum("_cell").cast("long").alias(name),
                                F.grouping(row).alias("_gr"), F.grouping(col).alias("_gc"))
    return g.select(
        F.when(F.col("_gr") == 1, F.lit(all_label)).otherwise(F.col(row)).alias(row),
        F.when(F.col("_gc") == 1, F.lit(all_label)).otherwise(F.col(col)).alias(col),
        name)


def row_share(counts: DataFrame, row: Sequence[str] | str, value: str = "n", name: str = "pct") -> DataFrame:
    """``normalize='index'`` -> 100 x cell / row total (on an aggregate)."""
    rows = [row] if isinstance(row, str) else list(row)
    return counts.withColumn(name, F.lit(100.0) * F.col(value) / F.sum(value).over(Window.partitionBy(*rows)))


def grand_share(counts: DataFrame, value: str = "n", name: str = "pct") -> DataFrame:
    """100 x cell / grand total; the total is a scalar subquery over the same cells."""
    total = counts.select(F.sum(value)).scalar()
    return counts.withColumn(name, F.lit(100.0) * F.col(value) / total)



def describe(df: DataFrame, col: str, percentiles: Sequence[float] = (0.25, 0.5, 0.75),
             group: Sequence[str] | str | None = None, approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Count, mean, std (sample), min, percentiles, max over non-null values; optionally per (non-null, N7) group.

    Percentiles are exact and interpolate linearly (as pandas), computed by
    ``exact_quantiles`` so that no group's values are gathered in one task.
    ``approx=True`` uses the bounded-memory sketch alone.
    """
    groups = [] if group is None else ([group] if isinstance(group, str) else list(group))
    src = df.dropna(subset=[col, *groups])
    x = F.col(col).cast("double")
    extra = {"count": F.count(x).cast("long"), "mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x),
             "max": F.max(x)}
    pnames = [_pname(p) for p in percentiles]
    if approx:
        pc = F.percentile_approx(x, list(percentiles), accuracy)
        aggs = [e.alias(n) for n, e in extra.items()] + [pc.alias("_p")]
        out = src.groupBy(*groups).agg(*aggs) if groups else src.agg(*aggs)
        out = out.select("*", *[F.col("_p")[i].alias(n) for i, n in enumerate(pnames)])
    else:
        out = exact_quantiles(src, col, percentiles, groups or None, names=pnames, extra=extra, inputs=[])
    return out.select(*groups, "count", "mean", "std", "min", *pnames, "max")


def _pname(p: float) -> str:
    s = f"{100 * p:.10g}".replace(".", "_")
    return f"p{s}"



def histograms(df: DataFrame, col: str, specs: dict[str, tuple[float, float]], width: float = 1.0,
               name: str = "n") -> DataFrame:
    """M22 for several bin ranges in ONE pass: label -> (lo, hi); rows (histogram, bin_lo, n)."""
    pairs = F.array(*[F.struct(F.lit(label).alias("histogram"), hist_bin(col, lo, hi, width).alias("bin_lo"))
                      for label, (lo, hi) in specs.items()])
    return (df.select(F.inline(pairs)).where(F.col("bin_lo").isNotNull())
            .groupBy("histogram", "bin_lo").agg(F.count(F.lit(1)).cast("long").alias(name)))


def box_stats(df: DataFrame, col: str, group: Sequence[str] | str, max_groups: int = 100_000) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (most extreme points inside) and outlier count.

    All of it comes from the counts per (group, value), so the input is read
    once; the quartiles are joined to those counts and broadcast only when
    their checked row count is within ``max_groups``. Rows without a group
    (N7) or a value are left out.
    """
    groups = [group] if isinstance(group, str) else list(group)
    counts = value_counts(df.dropna(subset=groups), col, groups)
    q = quantiles_of_counts(counts, (0.25, 0.5, 0.75), groups, ["q1", "median", "q3"], max_groups=max_groups)
    q = small_side(q.withColumn("iqr", F.col("q3") - F.col("q1")), max_groups)
    j = counts.join(q, groups)
    lo = F.col("q1") - 1.5 * F.col("iqr")
    hi = F.col("q3") + 1.5 * F.col("iqr")
    return j.groupBy(*groups, "q1", "median", "q3", "iqr").agg(
        F.sum("_c").cast("long").alias("count"),
        F.min(F.when(F.col("_x") >= lo, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(F.col("_x") <= hi, F.col("_x"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when((F.col("_x") < lo) | (F.col("_x") > hi), F.col("_c"))), F.lit(0)).cast("long").alias("n_outliers"),
    )
