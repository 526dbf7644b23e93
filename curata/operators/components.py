"""One identity over several identifiers (A7a, T14): components of the member-identifier graph.

Two members are one person if they share the value of any identifier, or are
linked through others who do. Labels start as the members' own ids. In a
round, every identifier value takes the smallest label of its members and
every member the smallest label of its identifier values, then labels jump
to their own labels' labels, so chains shrink by halves. Minima are combined
before the shuffle, and the joins split a hot identifier (``join_on_keys``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.operators.joins import join_on_keys
from curata.session import checkpoint_dir


def identity_components(df: DataFrame, member: str, identifiers: Sequence[str], name: str = "master_id") -> DataFrame:
    """``(member, name)``: every distinct member and the smallest member of its component.

    A null identifier links nobody; a null member is left out; a member that
    shares nothing is its own component. Rounds are cut with ``checkpoint``.
    """
    checkpoint_dir(df.sparkSession)
    rows = df.where(F.col(member).isNotNull())
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, c in enumerate(identifiers)])
    edges = rows.select(F.col(member).alias("member"), F.inline(kinds)).where("value is not null").distinct()
    # identifiers that only one member has link nobody
    shared = edges.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("kind").alias("k"), F.col("value").alias("v"))
    edges = join_on_keys(edges, shared, [("kind", "k"), ("value", "v")], "left_semi").checkpoint()
    labels = edges.select("member").distinct().select("member", F.col("member").alias("label")).checkpoint()
    while True:
        held = join_on_keys(edges, labels.select(F.col("member").alias("m"), "label"), [("member", "m")], "inner").drop("m")
        least = held.groupBy(F.col("kind").alias("k"), F.col("value").alias("v")).agg(F.min("label").alias("low"))
        low = join_on_keys(held, least, [("kind", "k"), ("value", "v")], "inner").groupBy("member").agg(F.min("low").alias("low"), F.min("label").alias("old")).checkpoint()
        # jump: a label is a member itself, and its own new label is at least as small
        up = low.select(F.col("member").alias("m"), F.col("low").alias("up"))
        new = join_on_keys(low, up, [("low", "m")], "left").select("member", F.least("low", F.coalesce("up", "low")).alias("label"), "old").checkpoint()
        labels = new.select("member", "label")
        if new.where("label <> old").isEmpty():
            break
    alone = rows.select(F.col(member).alias("member")).distinct().join(labels.select("member"), "member", "left_anti").select("member", F.col("member").alias("label"))
    return labels.unionByName(alone).select(F.col("member").alias(member), F.col("label").alias(name))
