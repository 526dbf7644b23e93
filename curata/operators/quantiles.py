"""Exact quantiles without gathering a group's values in one place.

Spark's ``percentile`` keeps a map of every distinct value of a group in the
final aggregation buffer: fine for day counts, fatal for a money column over
billions of rows. Here every group, of whatever size, takes the same path, a
distributed selection by histogram:

1. the rows are reduced to (group, value) -> count, map-side combined, and
   checkpointed once;
2. a group's values are binned between its smallest and largest (on a log
   scale if they span orders of magnitude, so that heavy tails spread);
   running
   sums over the ``BINS`` bin counts tell which bins hold a wanted rank.
   Only those bins' values go on;
3. a bin that holds more than ``WINDOW_VALUES`` different values becomes a
   range of its own and step 2 repeats on it. The smallest and largest value
   of a range always fall into different bins, so this ends;
4. the values left per (group, bin) are ranked with a running sum, the order
   statistics read off, and interpolated like ``percentile`` (``linear``) or
   taken as ``percentile_disc`` (``disc``).

No step collects values, holds more than ``BINS`` or ``WINDOW_VALUES`` rows of
a group in a window, or can fail for a distribution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.operators.joins import small_side
from curata.session import checkpoint_dir

BINS = 4096
WINDOW_VALUES = 100_000
_ALL = "_all"


def value_counts(df: DataFrame, col: str, groups: Sequence[str]) -> DataFrame:
    """``(groups, _x, _c)``, materialised: how often each value occurs in its group; nulls and NaN are left out."""
    checkpoint_dir(df.sparkSession)
    x = F.col(col).cast("double")
    return (df.select(*groups, x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
            .groupBy(*groups, "_x").agg(F.count(F.lit(1)).alias("_c")).checkpoint())


def _same(a: str, b: str, cols: Sequence[str]) -> list[Column]:
    return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols]


def _bin(bins: int) -> Column:
    """Bin of ``_x`` between ``_lo`` and ``_hi``: monotone, 0 at the smallest and ``bins`` - 1 at the largest value."""
    def share(t):
        return (t("_x") - t("_lo")) / F.nullif(t("_hi") - t("_lo"), F.lit(0.0))

    a, b = F.abs("_lo"), F.abs("_hi")
    wide = (F.greatest(a, b) > 16 * F.least(a, b)) & (F.greatest(a, b) > 16)
    share = F.when(wide, share(lambda c: F.signum(c) * F.log1p(F.abs(c)))).otherwise(share(lambda c: F.col(c) / 2))
    inside = F.floor(F.coalesce(F.nanvl(share, F.lit(0.5)), F.lit(0.5)) * bins)
    return (F.when(F.col("_x") == F.col("_lo"), 0).when(F.col("_x") == F.col("_hi"), bins - 1)
            .otherwise(F.greatest(F.lit(0), F.least(F.lit(bins - 1), inside))).cast("int"))


def quantiles_of_counts(counts: DataFrame, probs: Sequence[float], groups: Sequence[str], names: Sequence[str],
                        interpolation: str = "linear", bins: int = BINS, window_values: int = WINDOW_VALUES,
                        max_groups: int = 1_000_000) -> DataFrame:
    """Per group of ``value_counts``: one column per probability. ``groups`` names one column at least."""
    if interpolation not in ("linear", "disc"):
        raise ValueError("interpolation must be 'linear' or 'disc'")
    groups = list(groups)
    n = F.col("_n")
    position = [F.lit(float(p)) * (n - 1) if interpolation == "linear" else F.greatest(F.ceil(F.lit(float(p)) * n) - 1, F.lit(0)).cast("double")
                for p in probs]
    low, high = [F.floor(p) for p in position], [F.ceil(p) for p in position]
    wanted = F.array(*low, *high)

    whole = counts.groupBy(*groups).agg(F.sum("_c").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    ranges = small_side(whole.withColumn("_below", F.lit(0).cast("long")), max_groups)
    rows = counts.alias("c").join(ranges.alias("r"), _same("c", "r", groups))
    rows = rows.select(*[F.col(f"c.{g}") for g in groups], "_x", "_c", "_n", "_lo", "_hi", "_below")
    while True:
        binned = rows.withColumn("_b", _bin(bins))
        # _lo names a range: ranges of a group don't overlap
        hist = binned.groupBy(*groups, "_lo", "_b").agg(
            F.sum("_c").alias("_bc"), F.count(F.lit(1)).alias("_values"), F.min("_x").alias("_min"), F.max("_x").alias("_max"),
            F.first("_n").alias("_n"), F.first("_below").alias("_below"))
        before = Window.partitionBy(*groups, "_lo").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("_below", F.col("_below") + F.coalesce(F.sum("_bc").over(before), F.lit(0)))
        hit = F.exists(wanted, lambda r: (r >= F.col("_below")) & (r < F.col("_below") + F.col("_bc")))
        needed = hist.where(hit).checkpoint()
        most = needed.agg(F.max("_values")).first()[0] or 0
        keys = [*groups, "_lo", "_b"]
        rows = binned.alias("v").join(small_side(needed, max_groups).alias("h"), _same("v", "h", keys)).select(
            *[F.col(f"v.{g}") for g in groups], "v._x", "v._c", "v._n", F.col("h._min").alias("_lo"), F.col("h._max").alias("_hi"), "h._below")
        if most <= window_values:
            break
        rows = rows.checkpoint()
    rank = Window.partitionBy(*groups, "_lo").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("_below", F.col("_below") + F.coalesce(F.sum("_c").over(rank), F.lit(0)))
    at = lambda r: F.max(F.when((r >= F.col("_below")) & (r < F.col("_below") + F.col("_c")), F.col("_x")))
    k = range(len(names))
    found = ranked.groupBy(*groups).agg(F.max("_n").alias("_n"), *[at(low[i]).alias(f"_l{i}") for i in k], *[at(high[i]).alias(f"_h{i}") for i in k])
    value = [F.when(low[i] == high[i], F.col(f"_l{i}")).otherwise(
        (high[i] - position[i]) * F.col(f"_l{i}") + (position[i] - low[i]) * F.col(f"_h{i}")).alias(names[i]) for i in k]
    return found.select(*groups, *value)


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], group: Sequence[str] | str | None = None,
                    names: Sequence[str] | None = None, extra: dict[str, Column] | None = None, interpolation: str = "linear",
                    inputs: Sequence[str] | None = None, max_groups: int = 1_000_000, bins: int = BINS,
                    window_values: int = WINDOW_VALUES) -> DataFrame:
    """Per group: ``extra`` aggregates (name -> Column, over all rows of the group) and exact quantiles of ``col``.

    Null and NaN values of ``col`` are ignored by the quantiles. Returns the
    group columns, the ``extra`` aliases and one column per probability
    (null for a group without values; without groups, one row, or none if
    ``df`` is empty). ``inputs``
    names the columns besides ``col`` that ``extra`` reads (default: all): the
    input, often a join, is materialised once, with these columns only.
    """
    groups = [] if group is None else ([group] if isinstance(group, str) else list(group))
    names = list(names or [f"p{100 * p:.10g}".replace(".", "_") for p in probs])
    extra = dict(extra or {})
    clash = [n for n in extra if n.startswith("_") or n in names]
    if clash:
        raise ValueError(f"extra aggregate names clash with quantile columns: {clash}")
    checkpoint_dir(df.sparkSession)
    narrow = df if inputs is None and extra else df.select(*dict.fromkeys([*groups, col, *(inputs or [])]))
    keys = groups or [_ALL]
    narrow = (narrow if groups else narrow.withColumn(_ALL, F.lit(0))).checkpoint()
    aggregates = [c.alias(n) for n, c in extra.items()] or [F.count(F.lit(1)).alias("_rows")]
    stats = narrow.groupBy(*keys).agg(*aggregates)
    q = quantiles_of_counts(value_counts(narrow, col, keys), probs, keys, names, interpolation, bins, window_values, max_groups)
    out = stats.alias("s").join(q.alias("q"), _same("s", "q", keys), "left")
    return out.select(*[F.col(f"s.{g}").alias(g) for g in groups], *[F.col(f"s.{e}").alias(e) for e in extra],
                      *[F.col(f"q.{n}").alias(n) for n in names])


def median_of(df: DataFrame, col: str, group: Sequence[str] | str | None = None, name: str = "median",
              extra: dict[str, Column] | None = None, inputs: Sequence[str] | None = None) -> DataFrame:
    """``exact_quantiles`` for the median; rows without a group are left out."""
    if group is not None:
        df = df.dropna(subset=[group] if isinstance(group, str) else list(group))
    return exact_quantiles(df, col, [0.5], group, names=[name], extra=extra, inputs=inputs)
