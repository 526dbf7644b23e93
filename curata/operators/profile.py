"""Column profiling (PR1-PR3, PR9, G16).

``profile_columns`` unpivots every column to (column, typed value), counts
(column, value) pairs with map-side combine, and derives nulls, distinct and
the dominant value per column from that frame: two shuffles for the whole
table instead of one distinct-count per column. The value is a struct with
one field per type family (text, integral, floating, date, timestamp) of
which only the column's own is set, so no value is formatted as text before
grouping; text is rendered per distinct value only, for the dominant value.
Min/max come from one typed aggregate over numeric and time columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType, StringType, TimestampNTZType, TimestampType, ByteType)

from curata.operators.joins import static_broadcast

_NUMERIC = (IntegerType, LongType, ShortType, ByteType, DoubleType, FloatType, DecimalType)
_TIME = (TimestampType, TimestampNTZType, DateType)


def _as_text(df: DataFrame, c: str):
    t = df.schema[c].dataType
    col = F.col(c)
    if isinstance(t, (DoubleType, FloatType)):
        col = col + F.lit(0.0)  # -0.0 and 0.0 are one value, as in pandas
    return col.cast("string")


def value_counts_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, value, n) for every column; value is text, null kept."""
    cols = list(cols or [f.name for f in df.schema.fields if f.dataType.typeName() not in ("array", "map", "struct")])
    txt = df.select(*[_as_text(df, c).alias(c) for c in cols])
    long = txt.unpivot([], cols, "column", "value")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).cast("long").alias("n"))


_INTEGRAL = (IntegerType, LongType, ShortType, ByteType)
_FAMILY_TYPE = {"s": "string", "l": "bigint", "d": "double", "dt": "date", "tn": "timestamp_ntz", "tz": "timestamp"}


def _family(t) -> str:
    if isinstance(t, _INTEGRAL):
        return "l"
    if isinstance(t, (DoubleType, FloatType)):
        return "d"
    if isinstance(t, DateType):
        return "dt"
    if isinstance(t, TimestampNTZType):
        return "tn"
    if isinstance(t, TimestampType):
        return "tz"
    return "s"   # text, booleans, decimals: grouped by their text


def typed_value_counts(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """(column, value, n) with ``value`` a struct holding the typed value (null value -> null struct).

    Returns the frame and the struct's field names; ``value_text`` renders a value.
    """
    fams = {c: _family(df.schema[c].dataType) for c in cols}
    used = sorted(set(fams.values()))

    def typed(c: str):
        x = F.col(c)
        f = fams[c]
        if f == "d":
            x = x.cast("double") + F.lit(0.0)   # -0.0 and 0.0 are one value, as in pandas
        elif f != "tn" and f != "tz" and f != "dt":
            x = x.cast(_FAMILY_TYPE[f])
        fields = [(x if u == f else F.lit(None).cast(_FAMILY_TYPE[u])).alias(u) for u in used]
        return F.when(F.col(c).isNotNull(), F.struct(*fields))

    long = df.select(*[typed(c).alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).cast("long").alias("n")), used


def value_text(used: Sequence[str], value: str = "value"):
    """Text of a typed value, equal to casting the original column to string."""
    return F.coalesce(*[F.col(value)[u].cast("string") for u in used])


def profile_columns(df: DataFrame, table: str | None = None) -> DataFrame:
    """PR1: per column dtype, nulls, null_pct, distinct, distinct_pct, min, max, top_value, top_freq_pct.

    The dominant value is the most frequent non-null value; ties go to the
    smallest value as text. min/max are set for numeric and time columns only.
    """
    fields = [f for f in df.schema.fields if f.dataType.typeName() not in ("array", "map", "struct")]
    cols = [f.name for f in fields]
    vc, used = typed_value_counts(df, cols)
    vc = vc.withColumn("_text", value_text(used))
    per_col = vc.groupBy("column").agg(
        F.sum("n").cast("long").alias("_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("nulls"),
        F.count("value").cast("long").alias("distinct"),
        F.min_by(F.col("_text"), F.when(F.col("value").isNotNull(), F.struct(-F.col("n"), F.col("_text")))).alias("top_value"),
        F.max(F.when(F.col("value").isNotNull(), F.col("n"))).alias("_top_n"),
    )
    typed = [f for f in fields if isinstance(f.dataType, _NUMERIC + _TIME) and not isinstance(f.dataType, BooleanType)]
    spark = df.sparkSession
    meta = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in fields], "column string, dtype string")
    if typed:
        mm = df.agg(*[F.min(f.name).cast("string").alias(f"min__{f.name}") for f in typed],
                    *[F.max(f.name).cast("string").alias(f"max__{f.name}") for f in typed])
        mm = mm.select(F.inline(F.array(*[
            F.struct(F.lit(f.name).alias("column"), F.col(f"min__{f.name}").alias("min"), F.col(f"max__{f.name}").alias("max"))
            for f in typed])))
        meta = meta.join(static_broadcast(mm), "column", "left")
    else:
        meta = meta.withColumn("min", F.lit(None).cast("string")).withColumn("max", F.lit(None).cast("string"))
    out = per_col.join(static_broadcast(meta), "column").select(
        *([F.lit(table).alias("table")] if table else []),
        "column", "dtype", "nulls",
        (F.lit(100.0) * F.col("nulls") / F.col("_rows")).alias("null_pct"),
        "distinct",
        (F.lit(100.0) * F.col("distinct") / F.col("_rows")).alias("distinct_pct"),
        "min", "max", "top_value",
        (F.lit(100.0) * F.col("_top_n") / F.greatest(F.col("_rows") - F.col("nulls"), F.lit(1))).alias("top_freq_pct"),
    )
    return out


def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None,
                    percentiles: Sequence[float] = (0.01, 0.05, 0.5, 0.95, 0.99),
                    approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """PR2: ``describe(percentiles)`` for every numeric column.

    Count, mean, deviation and bounds of all columns are one aggregate of the
    table as it is. For the quantiles only (column, value) pairs are counted,
    combined before the shuffle; they are exact unless ``approx``.
    """
    from curata.operators.quantiles import quantiles_of_counts, value_counts
    from curata.operators.reshape import _pname, describe
    cols = list(cols or [f.name for f in df.schema.fields
                         if isinstance(f.dataType, _NUMERIC) and not isinstance(f.dataType, BooleanType)])
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    long = wide.unpivot([], cols, "column", "value")
    if approx:
        return describe(long, "value", percentiles, group="column", approx=True, accuracy=accuracy)
    names = [_pname(p) for p in percentiles]
    parts = {"count": lambda c: F.count(c).cast("long"), "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    one = wide.agg(*[f(F.col(c)).alias(f"{n}__{i}") for i, c in enumerate(cols) for n, f in parts.items()])
    stats = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{n}__{i}").alias(n) for n in parts])
                                          for i, c in enumerate(cols)]))).where("count > 0")
    q = quantiles_of_counts(value_counts(long, "value", ["column"]), percentiles, ["column"], names)
    return q.join(static_broadcast(stats), "column").select("column", "count", "mean", "std", "min", *names, "max")


def categorical_profile(df: DataFrame, max_distinct: int = 12, cols: Sequence[str] | None = None) -> DataFrame:
    """PR3: counts and % of rows (null included) for text/bool columns with few values."""
    cols = list(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, (StringType, BooleanType))])
    # columns with far more values are told apart by one sketch each, so their values aren't shuffled; the rest is counted exactly
    roughly = df.agg(*[F.approx_count_distinct(c).alias(f"_{i}") for i, c in enumerate(cols)]).first() if cols else []
    cols = [c for c, n in zip(cols, roughly) if n <= 2 * max_distinct + 10] or cols[:1]
    vc = value_counts_long(df, cols)
    card = vc.groupBy("column").agg(F.count("value").alias("_distinct"), F.sum("n").alias("_rows"))
    # one row per profiled column: bounded by the schema width
    keep = static_broadcast(card.where(F.col("_distinct") <= max_distinct))
    return vc.join(keep, "column").select(
        "column", "value", "n", (F.lit(100.0) * F.col("n") / F.col("_rows")).alias("pct"))


def completeness(df: DataFrame, table: str) -> DataFrame:
    """Share of non-null cells over the table."""
    cols = df.columns
    null_cells = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0))
    return df.agg(F.count(F.lit(1)).cast("long").alias("rows"), null_cells.cast("long").alias("null_cells")).select(
        F.lit(table).alias("table"), "rows", F.lit(len(cols)).cast("long").alias("columns"), "null_cells",
        F.when(F.col("rows") > 0, F.lit(100.0) * (F.lit(1.0) - F.col("null_cells") / (F.col("rows") * F.lit(len(cols)))))
        .alias("completeness_pct"))


def overview(df: DataFrame, table: str, role: str = "", period_col: str | None = None) -> DataFrame:
    """PR9: role, rows, columns, empty-cell %, first and last calendar date — one aggregate."""
    cols = df.columns
    null_cells = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0))
    aggs = [F.count(F.lit(1)).cast("long").alias("rows"), null_cells.cast("long").alias("_nulls")]
    if period_col:
        aggs += [F.min(period_col).alias("_mn"), F.max(period_col).alias("_mx")]
    out = df.agg(*aggs)
    day = (lambda c: F.date_format(F.to_date(F.col(c)), "yyyy-MM-dd")) if period_col else (lambda c: F.lit(None).cast("string"))
    return out.select(
        F.lit(table).alias("table"), F.lit(role).alias("role"), "rows", F.lit(len(cols)).cast("long").alias("columns"),
        F.when(F.col("rows") > 0, F.lit(100.0) * F.col("_nulls") / (F.col("rows") * F.lit(len(cols)))).alias("empty_pct"),
        day("_mn").alias("period_from"), day("_mx").alias("period_to"))
