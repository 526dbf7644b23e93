"""Join helpers: broadcast only behind a checked size; joins whose hot keys AQE can split.

``small_side`` materialises a (usually aggregated) frame once into the shared
checkpoint folder, counts its rows and measures its bytes in one job, and
marks it for broadcast only when both are within the bounds; above them the
join stays a shuffle join, where AQE can still split skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

from curata.session import checkpoint_dir

DEFAULT_MAX_ROWS = 1_000_000
DEFAULT_MAX_BYTES = 256 << 20


def row_bytes(c: Column, t: DataType) -> Column:
    """Bytes a value takes in a row, counted from the value itself: 16 for its slot and offset plus its variable part."""
    if isinstance(t, (StringType, BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(t, ArrayType):
        return F.lit(16) + F.coalesce(F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + row_bytes(x, t.elementType)), F.lit(0))
    if isinstance(t, MapType):
        return row_bytes(F.map_keys(c), ArrayType(t.keyType)) + row_bytes(F.map_values(c), ArrayType(t.valueType))
    if isinstance(t, StructType):
        return sum((row_bytes(c[f.name], f.dataType) for f in t.fields), F.lit(16))
    return F.lit(16)


def small_side(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """``df`` checkpointed; broadcast-marked only if its counted rows and measured bytes are within the bounds."""
    checkpoint_dir(df.sparkSession)
    frozen = df.checkpoint(eager=True)
    width = sum((row_bytes(F.col(f"`{f.name}`"), f.dataType) for f in frozen.schema.fields), F.lit(16)).cast("long")
    n, size = frozen.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(frozen) if n <= max_rows and size <= max_bytes else frozen


def join_on_keys(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str, null_safe: bool = False) -> DataFrame:
    """Join whose large partitions AQE can split even if ``right`` was aggregated or ranked on the same key.

    AQE splits a skewed side only if both sides' shuffles stand right below
    the join. A right side that was already shuffled by the key for its
    aggregation would be joined without a shuffle of its own; the hash of the
    key as one more join key makes Spark shuffle it (one row per key) once
    more. ``on`` pairs a column of ``left`` with one of ``right``.
    """
    equal = [left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b] for a, b in on]
    same_type = [right[b].cast(left.schema[a].dataType) for a, b in on]
    hashes = F.xxhash64(*[left[a] for a, _ in on]) == F.xxhash64(*same_type)
    return left.join(right, [*equal, hashes], how)


def static_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a frame whose size is fixed by code (literal maps, schema width)."""
    return F.broadcast(df)
