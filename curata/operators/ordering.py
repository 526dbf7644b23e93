"""Position of every row within its key, with no key gathered in one task.

``row_number().over(Window.partitionBy(key).orderBy(...))`` sends all rows of
a key to one task: a key that holds a third of the table is then processed
by one core. ``positions`` computes the same numbers this way:

1. range-partition the rows on (key, order) and sort within partitions:
   Spark samples the boundaries, so a hot key spans many balanced
   partitions (their number is the session's, AQE may merge neighbours);
   ``monotonically_increasing_id`` then holds (partition id, index in the
   partition) for every row;
2. the ranged frame is checkpointed once into the session's shared
   checkpoint folder, so that the ids are data: re-evaluating the plan (or
   losing an executor) cannot change them. Spark gives the same advice for
   ``zipWithIndex`` -- sort or save before numbering;
3. per (key, partition) segment: first id and row count (at most one row
   per key plus one per partition); the rows of a key in earlier
   partitions give the segment's offset, a window over the segments of
   one key (a hot key has at most one segment per partition);
4. position = offset + (id - first id of the segment) + 1, joined back on
   (key, partition): both sides are hash-partitioned on that pair, so a hot
   key is spread over as many tasks as it has segments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.session import checkpoint_dir
from curata.specs import as_tuple

_ID, _PID, _FIRST, _OFF = "_pos_id", "_pos_pid", "_pos_first", "_pos_off"


def positions(df: DataFrame, key, order: Sequence[Column], name: str = "pos", partitions: int | None = None) -> DataFrame:
    """``df`` with ``name`` = 1-based position of the row in its key under ``order``.

    Equal to ``row_number().over(Window.partitionBy(key).orderBy(*order))``;
    ``order`` should be total (end it with a unique column) when the numbers
    must be repeatable. Null keys form one key, as in a window.
    """
    keys = list(as_tuple(key))
    sort = [F.col(k).asc_nulls_first() for k in keys] + list(order)
    # Without an explicit count the session decides (AQE's initial partition number, then coalescing of
    # contiguous ranges), so partition ids stay in sort order whatever the data size.
    ranged = df.repartitionByRange(int(partitions), *sort) if partitions else df.repartitionByRange(*sort)
    ranged = ranged.sortWithinPartitions(*sort).withColumn(_ID, F.monotonically_increasing_id())
    checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint(eager=True).withColumn(_PID, F.shiftright(F.col(_ID), 33))

    seg = ranged.groupBy(*keys, _PID).agg(F.min(_ID).alias(_FIRST), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.select(*[F.col(k).alias(f"_seg_{k}") for k in keys], F.col(_PID).alias("_seg_pid"), _FIRST,
                     F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(_OFF))
    # both sides on (key, partition): the join never funnels a hot key into one task
    seg = seg.repartition(*[F.col(f"_seg_{k}") for k in keys], F.col("_seg_pid"))
    cond = [ranged[k].eqNullSafe(seg[f"_seg_{k}"]) for k in keys] + [ranged[_PID] == seg["_seg_pid"]]
    out = ranged.join(seg, cond)
    pos = F.col(_OFF) + (F.col(_ID) - F.col(_FIRST)) + F.lit(1)
    return out.select(*[ranged[c] for c in df.columns], pos.cast("long").alias(name))
