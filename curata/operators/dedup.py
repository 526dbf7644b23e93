"""Deduplication.

Spark has no file order, so every "keep one row" rule takes an explicit
order; ties are broken by the remaining columns so results are repeatable.
"latest"/"first" use ``row_number() = 1``, which Catalyst turns into a
partial WindowGroupLimit before the shuffle: a hot key is cut to one row per
map task before it is exchanged. Counting uses group-by with map-side
partial aggregation, never a window over the whole group. Flags of one row
per key (surplus, audit split) compare counted rows with the key's best row;
only with an explicit tie order or columns that can't be ordered do they
rank every row (``ordering.positions``, which spreads a hot key over many
tasks).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.operators.joins import join_on_keys
from curata.operators.ordering import positions
from curata.specs import as_tuple

_RN = "_rn"


def _tie_cols(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    ex = set(exclude)
    # Complex types (arrays, maps) cannot be ordered; they never decide ties.
    return [f.name for f in df.schema.fields if f.name not in ex and f.dataType.typeName() not in ("array", "map", "struct")]


def _ordered(df: DataFrame, key, order: Sequence[Column], order_cols: Sequence[str],
             tie: Sequence[str] | None, desc_tie: bool) -> list[Column]:
    tie_cols = list(tie) if tie is not None else _tie_cols(df, list(as_tuple(key)) + list(order_cols))
    ties = [F.col(c).desc_nulls_last() if desc_tie else F.col(c).asc_nulls_first() for c in tie_cols]
    return list(order) + ties


def keep_one(df: DataFrame, key, order: Sequence[Column], order_cols: Sequence[str] = (),
             tie: Sequence[str] | None = None, desc_tie: bool = True) -> DataFrame:
    """Keep the first row per key under ``order`` (then the tie columns).

    ``order_cols`` names the columns used in ``order``; every other column
    (unless ``tie`` is given) breaks ties, so the kept row is repeatable.
    """
    w = Window.partitionBy(*as_tuple(key)).orderBy(*_ordered(df, key, order, order_cols, tie, desc_tie))
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def latest(df: DataFrame, key, ts: str = "updated_at", nulls: str = "oldest", tie: Sequence[str] | None = None) -> DataFrame:
    """The most recent row per key.

    ``nulls="oldest"`` is the curated rule (a null timestamp loses, N13);
    ``nulls="newest"`` is the notebook rule (a null timestamp wins, N12).
    """
    o = F.col(ts).desc_nulls_last() if nulls == "oldest" else F.col(ts).desc_nulls_first()
    return keep_one(df, key, [o], [ts], tie=tie, desc_tie=True)


def first(df: DataFrame, key, order_cols: Sequence[str] = (), tie: Sequence[str] | None = None) -> DataFrame:
    """The first row per key by ascending ``order_cols`` (nulls first), then ties."""
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    return keep_one(df, key, order, order_cols, tie=tie, desc_tie=False)


def _flag_best(df: DataFrame, key, rank: Sequence[Column], last: bool, name: str) -> DataFrame:
    """``df`` with ``name`` true on one row per key: the one whose ``rank`` values are largest (``last``) or smallest.

    Whole rows are counted first and each key's best rank is one aggregate,
    both combined before the shuffle; of the best row's copies one is
    flagged. No key is gathered or sorted in one task, and nothing is ranked
    that isn't asked for. ``rank`` must tell different rows of a key apart.
    """
    keys = list(as_tuple(key))
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_rank", F.struct(*rank))
    best = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg((F.max if last else F.min)(F.struct(*rank)).alias("_best"))
    j = join_on_keys(rows, best, [(k, f"_k{i}") for i, k in enumerate(keys)], "inner", null_safe=True)
    return j.select(*[rows[c] for c in df.columns], F.col("_rank").eqNullSafe(F.col("_best")).alias("_is"),
                    F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")).select(
        *df.columns, (F.col("_is") & (F.col("_copy") == 1)).alias(name))


def _rest(df: DataFrame, key, first_cols: Sequence[str]) -> list[Column] | None:
    """The other columns, which break ties; None if one of them can't be ordered."""
    rest = [f for f in df.schema.fields if f.name not in {*as_tuple(key), *first_cols}]
    if any(f.dataType.typeName() in ("array", "map", "struct", "variant") for f in df.schema.fields):
        return None
    return [F.col(f.name) for f in rest]


def flag_surplus(df: DataFrame, key, order_cols: Sequence[str] = (), tie: Sequence[str] | None = None,
                 name: str = "is_surplus") -> DataFrame:
    """``duplicated(keep='first')`` -> True on every row after the first (ascending order, nulls first)."""
    rest = _rest(df, key, order_cols)
    if tie is None and rest is not None:
        return _flag_best(df, key, [*map(F.col, order_cols), *rest] or [F.lit(0)], False, name).withColumn(name, ~F.col(name))
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    ranked = positions(df, key, _ordered(df, key, order, order_cols, tie, False), _RN)
    return ranked.withColumn(name, F.col(_RN) > 1).drop(_RN)


def flag_latest(df: DataFrame, key, ts: str = "updated_at", nulls: str = "oldest", tie: Sequence[str] | None = None,
                name: str = "is_latest") -> DataFrame:
    """``df`` with ``name`` true on the row that ``latest`` would keep of each key."""
    rest = _rest(df, key, [ts])
    if tie is None and rest is not None:
        newest = [F.col(ts).isNull()] if nulls == "newest" else []
        return _flag_best(df, key, [*newest, F.col(ts), *rest], True, name)
    o = F.col(ts).desc_nulls_last() if nulls == "oldest" else F.col(ts).desc_nulls_first()
    ranked = positions(df, key, _ordered(df, key, [o], [ts], tie, True), _RN)
    return ranked.withColumn(name, F.col(_RN) == 1).drop(_RN)


def flag_repeated(df: DataFrame, key, name: str = "is_repeated") -> DataFrame:
    """``duplicated(keep=False)`` -> True on every row whose key repeats.

    Key counts are pre-aggregated (map-side combine) and joined back; a hot
    key makes a skewed join side, which AQE splits.
    """
    keys = list(as_tuple(key))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    cond = [df[k].eqNullSafe(counts[k]) for k in keys]
    out = df.join(counts, cond, "left").select(df["*"], (F.col("_n") > 1).alias(name))
    return out


_SHORT = 64


def compact_text(df: DataFrame) -> DataFrame:
    """Replace every text value longer than 64 characters by its SHA-256 digest.

    For grouping whole rows: values up to 64 characters are kept (tagged
    ``=``), longer ones become ``#`` + digest, so equal rows stay equal and
    a shuffle never carries a whole document. Nulls stay null.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.dataType.typeName() in ("string", "binary"):
            txt = c if f.dataType.typeName() == "string" else F.hex(c)
            c = F.when(F.length(txt) <= _SHORT, F.concat(F.lit("="), txt)).otherwise(
                F.concat(F.lit("#"), F.sha2(c, 256)))
        out.append(c.alias(f.name))
    return df.select(*out)


def duplicate_summary(df: DataFrame, key, table: str | None = None) -> DataFrame:
    """PR4 + A1 in one chain of aggregations (no join).

    Whole rows are grouped first (map-side combine removes identical copies
    early), then rows per key, then one global row:
    rows, distinct_keys, null_keys, rows_with_repeated_key, surplus_rows,
    fully_identical_rows (surplus identical copies) and conflicting_rows
    (surplus by key but not an identical copy). Long texts are grouped by
    their digest (``compact_text``).
    """
    keys = list(as_tuple(key))
    cols = [c for c in df.columns if df.schema[c].dataType.typeName() not in ("map",)]
    full = compact_text(df.select(*cols)).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    per_key = full.groupBy(*keys).agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_variants"))
    out = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("rows"),
        F.count_if(~null_key).cast("long").alias("distinct_keys"),
        F.coalesce(F.sum(F.when(null_key, F.col("_rows"))), F.lit(0)).cast("long").alias("null_keys"),
        F.coalesce(F.sum(F.when(F.col("_rows") > 1, F.col("_rows"))), F.lit(0)).cast("long").alias("rows_with_repeated_key"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).cast("long").alias("surplus_rows"),
        F.coalesce(F.sum(F.col("_rows") - F.col("_variants")), F.lit(0)).cast("long").alias("fully_identical_rows"),
        F.coalesce(F.sum(F.col("_variants") - 1), F.lit(0)).cast("long").alias("conflicting_rows"),
    )
    if table is not None:
        out = out.select(F.lit(table).alias("table"), F.lit(",".join(keys)).alias("pk"), "*")
    return out


def full_row_duplicates(df: DataFrame, name: str = "n_copies") -> DataFrame:
    """Every distinct row that occurs more than once, with its count."""
    cols = df.columns
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def conflicting_duplicates(df: DataFrame, key) -> DataFrame:
    """A1 detail: keys whose copies disagree on at least one column."""
    keys = list(as_tuple(key))
    full = compact_text(df).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return (full.groupBy(*keys)
            .agg(F.sum("_n").cast("long").alias("n_rows"), F.count(F.lit(1)).cast("long").alias("n_variants"))
            .where(F.col("n_variants") > 1))


def split_latest(df: DataFrame, key, ts: str = "updated_at", nulls: str = "newest",
                 tie: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept latest rows, dropped rows for the audit table)."""
    flagged = flag_latest(df, key, ts, nulls, tie, "_latest")
    return flagged.where(F.col("_latest")).drop("_latest"), flagged.where(~F.col("_latest")).drop("_latest")
