"""Mixing sources to target weights (operator 5).

Every document gets a hash-random key; within its source the documents are
ordered by that key, a prefix sum of their sizes says how many words come
before each one, and each source is cut at its exact budget; a budget above
the source's size repeats whole epochs first.

The keys are uniform, so ranges of equal width hold equal shares of a source:
a range is the leading bits of the key, and prefix sums run inside
(source, range) with the sums of the earlier ranges added. A source that
holds a third of all rows is spread over its ranges, and the result does not
depend on how many there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curata.llm.words import n_words
from curata.operators.joins import small_side

SEED = "mix-1"
RANGE_ROWS = 10_000        # aimed at: rows of a source in one range of keys
WEIGHTS = (3, 1, 2)        # of the sources in code-point order, repeating
SHARE = 1.5                # all targets together, in sizes of all sources
MAX_EPOCHS = 2


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source (null is a source, sorted last).

    ``share`` of all sizes is dealt out by weight; a target stops at
    ``max_epochs`` times its source's size and the excess goes to the others
    by weight until none is above. The end of that process is: sources in the
    order of size per weight are capped as long as the even share of what is
    left exceeds their cap.
    """
    if share > max_epochs:
        raise ValueError("the sources can't fill the mix: share exceeds max_epochs")
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.get(F.array(*[F.lit(x) for x in weights]), F.pmod(n, F.lit(len(weights)))).cast("double")
    d = sizes.select("source", "source_size", w.alias("_w"), (max_epochs * F.col("source_size")).cast("double").alias("_cap"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    d = d.withColumns({
        "_money": share * F.sum(F.col("source_size").cast("double")).over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
        "_open": F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))})
    fits = F.col("_money") * F.col("_w") <= F.col("_cap") * F.col("_open")
    # the first source that isn't capped fixes the rate for itself and all after it
    rate = F.first(F.when(fits, F.struct("_money", "_open")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("_rate", rate)
    target = F.when(F.col("_rate").isNull(), F.col("_cap")).otherwise(F.col("_rate._money") * F.col("_w") / F.col("_rate._open"))
    return d.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: str = SEED,
        range_rows: int = RANGE_ROWS, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken``: the words that the mix takes of the row, repeats counted.

    ``taken`` is ``floor(target / source_size)`` whole epochs, plus the part
    of one more epoch that comes before the budget's end; the row at the end
    is cut there, so the sources' taken words sum to ``floor(target)``. Rows
    are ordered by (key, id, size); the key hashes the seed, the id and the
    text, so rows of one id, or of none, spread over the ranges, and rows that
    agree in both are interchangeable. A null text has size 0 and a null
    source is a source of its own. Columns named like the four are replaced,
    others pass through whatever their names; an empty table gives none.
    """
    own = ("size", "source_size", "target", "taken")
    keep = [c for c in docs.columns if c.lower() not in own]
    n_ranges = 1
    while n_ranges * range_rows < docs.count() and n_ranges < 1 << 24:
        n_ranges *= 2
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(body)))
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), n_words(body).alias("size"), key.alias("key"), F.col(source).alias("of"), F.col(doc_id).alias("id"))
    d = d.withColumn("range", F.floor(F.conv(F.substring("key", 1, 6), 16, 10).cast("long") * n_ranges / (1 << 24)).cast("int"))
    ranges = d.groupBy("of", "range").agg(F.sum("size").alias("total")).checkpoint()
    before = Window.partitionBy("of").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    goals = targets(ranges.groupBy(F.col("of").alias("source")).agg(F.sum("total").alias("source_size")), weights, share, max_epochs)
    sums = ranges.withColumn("offset", F.coalesce(F.sum("total").over(before), F.lit(0)))
    sums = small_side(sums.join(goals, F.col("of").eqNullSafe(F.col("source"))).select(
        F.col("of").alias("s"), F.col("range").alias("r"), "offset", "source_size", "target"))
    inside = Window.partitionBy("of", "range").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = d.join(sums, F.col("of").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size") - F.col("before") - F.col("offset")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return d.select(*[F.col("row").getField(c).alias(c) for c in keep], "size", "source_size", "target", taken.cast("long").alias("taken"))
