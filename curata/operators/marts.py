"""Business marts and treatments that need more than one aggregate.

Every money aggregate is grouped by currency; amounts of different
currencies are never added (T18 converts through a rate table only).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curata.operators.joins import small_side


def value_index(df: DataFrame, period: str, group: str, value: str, name: str = "index") -> DataFrame:
    """Per (period, group) total and index = 100 x total / total of the global first period.

    The base is the first period over all groups, so a group absent then gets
    a null index. Rows without a period or group are left out (N7). Runs on
    the (period, group) aggregate only.
    """
    agg = df.dropna(subset=[period, group]).groupBy(period, group).agg(F.sum(value).alias("value"))
    first_period = F.min(period).over(Window.partitionBy())
    base = F.max(F.when(F.col(period) == F.col("_p0"), F.col("value"))).over(Window.partitionBy(group))
    return (agg.withColumn("_p0", first_period).withColumn("_base", base)
            .select(period, group, "value", (F.lit(100.0) * F.col("value") / F.col("_base")).alias(name)))


def period_extremes(df: DataFrame, period: str) -> DataFrame:
    """Mean rows per period, and the quietest and busiest periods (earliest on ties); rows without a period are left out."""
    per = df.where(F.col(period).isNotNull()).groupBy(period).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.avg("n").alias("mean_per_period"),
        F.min_by(period, F.struct(F.col("n"), F.col(period))).alias("min_period"),
        F.min("n").cast("long").alias("min_count"),
        F.min_by(period, F.struct(-F.col("n"), F.col(period))).alias("max_period"),
        F.max("n").cast("long").alias("max_count"))


def top_share(df: DataFrame, key: str, fraction: float = 0.1) -> DataFrame:
    """Share of rows held by the top ``fraction`` of keys (at least one key).

    No global sort of the keys: per-key counts are turned into a histogram of
    counts (how many keys have each count), which is small; the k largest
    counts are summed from that histogram, ties at the cut included exactly.
    """
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    hist = per_key.groupBy("c").agg(F.count(F.lit(1)).alias("m"))
    w_desc = Window.partitionBy().orderBy(F.col("c").desc()).rowsBetween(Window.unboundedPreceding, -1)
    keys_total = F.sum("m").over(Window.partitionBy())
    h = (hist.withColumn("above", F.coalesce(F.sum("m").over(w_desc), F.lit(0)))
         .withColumn("keys", keys_total)
         .withColumn("rows_all", F.sum(F.col("c") * F.col("m")).over(Window.partitionBy()))
         .withColumn("k", F.greatest(F.lit(1), F.floor(F.lit(fraction) * F.col("keys")).cast("long"))))
    take = F.greatest(F.lit(0), F.least(F.col("m"), F.col("k") - F.col("above")))
    out = h.agg(F.max("keys").cast("long").alias("keys"), F.max("k").cast("long").alias("top_keys"),
                F.max("rows_all").cast("long").alias("rows"), F.sum(take * F.col("c")).cast("long").alias("top_rows"))
    return out.withColumn("top_share_pct", F.lit(100.0) * F.col("top_rows") / F.col("rows"))


def equal_width_histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """``bins`` equal bins between the column's min and max (last bin closed).

    The two bounds are one tiny aggregate read back to the driver; the
    binning itself is a plain distributed group-by.
    """
    lo, hi = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_lo double, n long")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (df.where(F.col(col).isNotNull()).groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).cast("long").alias("n"))
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"), "n"))


def quantile_scores(df: DataFrame, group: str, cols: dict[str, bool], cuts: Sequence[float] = (0.2, 0.4, 0.6, 0.8),
                    max_groups: int = 100_000) -> DataFrame:
    """Score 1..len(cuts)+1 per column from exact per-group discrete quantile cut points.

    ``cols`` maps a column to ``True`` when larger is better. A value scores
    1 + the number of cut points it beats (strictly). Cut points are
    ``percentile_disc`` values (actual data values), so comparisons are exact;
    unlike ``ntile``, ties always get the same score and no global sort is
    needed. The cut points (one row per group) are broadcast behind a checked
    size.
    """
    from curata.operators.quantiles import exact_quantiles
    from curata.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)          # the input is read 3 times below; cut its lineage once
    names = list(cols)
    long = df.select(group, *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        group, names, "_col", "_val")
    q = exact_quantiles(long, "_val", cuts, [group, "_col"], names=[f"_q{i}" for i in range(len(cuts))],
                        interpolation="disc", max_groups=max_groups)
    arr = F.array(*[F.col(f"_q{i}") for i in range(len(cuts))])
    cp = q.groupBy(group).agg(*[F.max(F.when(F.col("_col") == c, arr)).alias(f"_cut_{c}") for c in names])
    cp = small_side(cp, max_groups)
    j = df.join(cp, df[group].eqNullSafe(cp[group])).drop(cp[group])
    for c, higher_better in cols.items():
        beats = [F.when((F.col(c) > F.col(f"_cut_{c}")[i]) if higher_better else (F.col(c) < F.col(f"_cut_{c}")[i]), 1)
                 .otherwise(0) for i in range(len(cuts))]
        j = j.withColumn(f"{c}_score", (F.lit(1) + sum(beats[1:], beats[0])).cast("int"))
    return j.drop(*[f"_cut_{c}" for c in cols])


def fx_convert(df: DataFrame, rates: DataFrame, amount: str, currency: str, day: str,
               rate_cols: tuple[str, str, str] = ("currency", "day", "rate"), name: str = "amount_converted",
               max_rates: int = 1_000_000) -> DataFrame:
    """Convert through a rate table on (currency, day); a missing rate gives null, never 1.

    The rate table is first reduced to one rate per (currency, day): repeated
    rows that agree keep their rate, conflicting ones give null (no guess),
    so the join never multiplies amounts. The reduced table is broadcast
    behind a checked size; otherwise the join stays a shuffle join.
    """
    rc, rd, rr = rate_cols
    r = rates.where(F.col(rc).isNotNull() & F.col(rd).isNotNull()).groupBy(
        F.col(rc).alias("_rc"), F.col(rd).alias("_rd")).agg(
        F.when(F.min(rr) == F.max(rr), F.min(rr)).alias("_rate"))
    r = small_side(r, max_rates)
    j = df.join(r, (df[currency] == F.col("_rc")) & (df[day] == F.col("_rd")), "left")
    return j.withColumn(name, F.col(amount) * F.col("_rate")).drop("_rc", "_rd", "_rate")
