"""Column profiles day by day (PR1, PR2, PR9): a mergeable state per partition, so that a run reads its new rows only.

The state of a column is one row: exact counts, sums and bounds, an HLL
sketch of its distinct values, a KLL sketch of its quantiles (numbers) and a
table of its frequent values. States of several days merge into the state of
all their rows: counts and bounds exactly, sketches within their bounds
(``DISTINCT_ERROR``, ``RANK_ERROR``), frequent values as Misra-Gries counts,
which fall short of the true ones by ``rows / TOP`` at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_K = 12                      # HLL buckets: 2**12
DISTINCT_ERROR = 0.05           # three standard errors of the sketch
KLL_K = 200
RANK_ERROR = 0.0165             # of a KLL sketch with k = 200, at 99 %
TOP = 64                        # frequent values that a state keeps a column
QUANTILES = (0.01, 0.05, 0.5, 0.95, 0.99)
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")
_EXACT = ("rows", "nulls", "n_numbers")


def profile_state(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, rows, nulls, low, high, n_numbers, total, squares, distinct_sketch, quantile_sketch, top)``, one row per column.

    ``low`` and ``high`` are the bounds of numbers (else null); ``top`` are
    (value, count) pairs of the text of values. One pass for all but ``top``,
    which counts values by (column, hash of value), combined before the shuffle.
    """
    names = list(columns or df.columns)
    number = {f.name: f.dataType.simpleString() in _NUMBERS for f in df.schema.fields}
    aggs = []
    for k, c in enumerate(names):
        x = F.col(f"`{c}`")
        d = x.cast("double") if number[c] else F.lit(None).cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.count_if(x.isNull()).alias("nulls"), F.min(d).alias("low"), F.max(d).alias("high"),
            F.count(d).alias("n_numbers"), F.sum(d).alias("total"), F.sum(d * d).alias("squares"),
            F.hll_sketch_agg(x.cast("string"), F.lit(LOG_K)).alias("distinct_sketch"),
            (F.kll_sketch_agg_double(d, F.lit(KLL_K)) if number[c] else F.lit(None).cast("binary")).alias("quantile_sketch")).alias(f"c{k}"))
    wide = df.agg(*aggs).select(F.inline(F.array(*[F.col(f"c{k}") for k in range(len(names))])))
    values = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in names]))).where("value is not null")
    return wide.join(_top(values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))), "column", "left")


def _top(counts: DataFrame) -> DataFrame:
    """Per column the ``TOP`` largest counts less the next one: a Misra-Gries summary, so that summaries add up."""
    # only counts that may be among the largest reach the last step: one row per (column, count) says how many values have it
    sizes = counts.groupBy("column", "n").agg(F.count(F.lit(1)).alias("m"))
    from pyspark.sql import Window

    above = F.sum("m").over(Window.partitionBy("column").orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, 0))
    cut = sizes.withColumn("upto", above).where(F.col("upto") > TOP).groupBy("column").agg(F.max("n").alias("cut"))
    over = counts.join(cut.withColumnRenamed("column", "k"), F.col("column") == F.col("k"), "left").withColumn("n", F.col("n") - F.coalesce("cut", F.lit(0))).where("n > 0")
    return over.groupBy("column").agg(F.array_sort(F.collect_list(F.struct("value", "n"))).alias("top"))


def merge_states(states: DataFrame) -> DataFrame:
    """The state of all rows from the states of disjoint sets of rows (any number of days, or of already merged states)."""
    merged = states.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n_numbers").alias("n_numbers"),
        F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))
    values = states.select("column", F.inline("top")).groupBy("column", "value").agg(F.sum("n").alias("n"))
    return merged.join(_top(values), "column", "left")


def report(state: DataFrame) -> DataFrame:
    """The profile that a state stands for: exact counts, mean, std and bounds; estimated distinct values, quantiles and the most frequent value."""
    n, mean = F.col("n_numbers"), F.col("total") / F.nullif(F.col("n_numbers"), F.lit(0))
    variance = F.when(n > 1, F.greatest(F.lit(0.0), (F.col("squares") - n * mean * mean) / (n - 1)))
    quantile = lambda p: F.when(n > 0, F.kll_sketch_get_quantile_double(F.col("quantile_sketch"), F.lit(p)))
    best = F.try_element_at(F.array_sort("top", lambda a, b: F.when(a["n"] != b["n"], F.when(a["n"] > b["n"], -1).otherwise(1)).when(a["value"] < b["value"], -1).otherwise(1)), F.lit(1))
    return state.select("column", "rows", "nulls", F.when(F.col("rows") > 0, F.lit(100.0) * F.col("nulls") / F.col("rows")).alias("null_pct"),
                        F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"), "low", "high", mean.alias("mean"), F.sqrt(variance).alias("std"),
                        *[quantile(p).alias(f"p{round(100 * p):02d}") for p in QUANTILES], best["value"].alias("top_value"), best["n"].alias("top_at_least"))
