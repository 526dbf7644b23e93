"""One source of truth per attribute (T19): the value of the highest-ranked source that has one, with its provenance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def survivors(df: DataFrame, key: str, source: str, updated: str, precedence: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per key: every attribute's surviving value, ``<attribute>_source`` and ``<attribute>_at``.

    ``precedence`` lists an attribute's sources, the most trusted first;
    sources that aren't listed never give it. Of one source the latest row
    counts (a null time is the oldest), of equal times the largest value. Null
    values and null keys give nothing. One grouped pass whatever the number of
    attributes; the maxima are combined before the shuffle.
    """
    best = []
    for attribute, sources in precedence.items():
        rank = F.coalesce(*[F.when(F.col(source) == s, F.lit(-k)) for k, s in enumerate(sources)])
        usable = F.col(attribute).isNotNull() & rank.isNotNull()
        best.append(F.max(F.when(usable, F.struct(rank.alias("rank"), F.col(updated).alias("at"), F.col(attribute).alias("value"), F.col(source).alias("source")))).alias(f"_{attribute}"))
    g = df.where(F.col(key).isNotNull()).groupBy(key).agg(*best)
    return g.select(key, *[F.col(f"_{a}.{part}").alias(f"{a}{suffix}") for a in precedence for part, suffix in (("value", ""), ("source", "_source"), ("at", "_at"))])
