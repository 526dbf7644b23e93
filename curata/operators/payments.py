"""Payment checks (A4a-A4c, A4n, A4s, T7, T8, T9).

Per-order payment facts are built with ONE grouped aggregate (conditional
counts and sums, map-side combined) and joined to the orders once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.functions.nulls import safe_ratio
from curata.operators.dedup import keep_one
from curata.operators.joins import static_broadcast
from curata.operators.ordering import positions


SEGMENT = 10_000       # steps of a path that one task turns into text


def per_order(payments: DataFrame, key: Sequence[str], status: str, amount: str,
              captured: str = "CAPTURED", failed: str = "FAILED") -> DataFrame:
    """n_payments, n_failed, n_captured and captured_amount per order (null keys dropped, N7)."""
    key = list(key)
    src = payments
    for k in key:
        src = src.where(F.col(k).isNotNull())
    st = F.col(status)
    return src.groupBy(*key).agg(
        F.count(F.lit(1)).cast("long").alias("n_payments"),
        F.count_if(st == failed).cast("long").alias("n_failed"),
        F.count_if(st == captured).cast("long").alias("n_captured"),
        F.coalesce(F.sum(F.when(st == captured, F.col(amount))), F.lit(0.0)).alias("captured_amount"),
    )


def payment_check(orders: DataFrame, payments: DataFrame, key: Sequence[str], total: str, status: str,
                  amount: str, captured: str = "CAPTURED", failed: str = "FAILED", tol: float = 0.001) -> DataFrame:
    """Orders left-joined to their payment facts with the A4 flags.

    ratio = captured / total when total > 0 (N15); retry = at least one
    failure and one capture; partial/over-capture use the +-``tol`` band.
    """
    key = list(key)
    po = per_order(payments, key, status, amount, captured, failed)
    j = orders.select(*key, total).join(po, key, "left")
    j = j.select(*key, total,
                 *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_payments", "n_failed", "n_captured")],
                 F.coalesce(F.col("captured_amount"), F.lit(0.0)).alias("captured_amount"))
    return payment_flags(j, total, tol)


def payment_flags(facts: DataFrame, total: str, tol: float = 0.001) -> DataFrame:
    """The A4 flags on a per-order frame holding ``total``, n_payments, n_failed, n_captured, captured_amount.

    Lets a caller whose orders and payments come from one table build the
    facts in one grouped pass and still share the flag rules.
    """
    j = facts
    ratio = safe_ratio("captured_amount", total)
    has = F.col("n_captured") > 0
    return j.withColumn("ratio", ratio).select(
        "*", has.alias("has_capture"),
        ((F.col("n_failed") > 0) & has).alias("is_retry"),
        (has & F.coalesce(F.col("ratio") < 1 - tol, F.lit(False))).alias("is_partial"),
        (has & F.coalesce(F.col("ratio") > 1 + tol, F.lit(False))).alias("is_overcapture"),
        (F.col("n_captured") > 1).alias("is_multi_capture"),
    )


def payment_summary(check: DataFrame) -> DataFrame:
    """A4/A4n counts in one row."""
    return check.agg(
        F.count(F.lit(1)).cast("long").alias("orders"),
        F.count_if(F.col("n_payments") > 0).cast("long").alias("with_payment"),
        F.count_if(F.col("n_payments") > 1).cast("long").alias("with_2_payments"),
        F.count_if("has_capture").cast("long").alias("with_capture"),
        F.count_if("is_retry").cast("long").alias("retry"),
        F.count_if("is_partial").cast("long").alias("partial"),
        F.count_if("is_overcapture").cast("long").alias("overcapture"),
        F.count_if("is_multi_capture").cast("long").alias("multi_capture"),
    )


def ratio_top_k(check: DataFrame, k: int = 10, tol: float = 0.001) -> DataFrame:
    """The k most frequent captured/total ratios (rounded to 2) that are not 1."""
    r = check.where(F.col("has_capture") & F.coalesce(F.abs(F.col("ratio") - 1) > tol, F.lit(False)))
    vc = r.groupBy(F.round("ratio", 2).alias("ratio")).agg(F.count(F.lit(1)).cast("long").alias("orders"))
    return vc.orderBy(F.col("orders").desc(), F.col("ratio").asc()).limit(k)


def status_sequences(payments: DataFrame, key: Sequence[str], status: str, ts: str, tie: str,
                     k: int = 8, sep: str = " → ", min_steps: int = 2, segment: int = SEGMENT) -> DataFrame:
    """A4s/G13: the k most frequent chronological status paths (>= ``min_steps`` steps).

    No group is gathered whole: each payment gets its position in its order
    from ``ordering.positions`` (a hot order is spread over many tasks), and
    a path is identified by its length plus two exact DECIMAL sums of 64-bit
    hashes of (position, status), which are map-side combinable. Only the k
    reported paths are turned into text, each from the steps of one order
    (its smallest order key), segment by segment (``path_text``). Ties in
    frequency go to the path first seen at the smallest order key. Rows with
    a null key are left out (N7).
    """
    key = list(key)
    order = [F.col(ts).asc_nulls_last(), F.col(tie).asc()]
    pos = positions(payments.dropna(subset=key).select(*key, status, ts, tie), key, order, "_pos").select(*key, status, "_pos")
    h1 = F.xxhash64(F.col("_pos"), F.col(status)).cast("decimal(20,0)")
    h2 = F.xxhash64(F.col(status), F.col("_pos"), F.lit("~")).cast("decimal(20,0)")
    fp = pos.groupBy(*key).agg(F.count(F.lit(1)).alias("_len"), F.sum(h1).alias("_h1"), F.sum(h2).alias("_h2"))
    fp = fp.where(F.col("_len") >= min_steps)
    per_path = fp.groupBy("_len", "_h1", "_h2").agg(
        F.count(F.lit(1)).cast("long").alias("orders"), F.min(F.struct(*key)).alias("_rep"))
    top = per_path.orderBy(F.col("orders").desc(), F.col("_rep").asc()).limit(k).select("orders", "_rep.*")
    # k rows: bounded by the report size, so broadcasting it is safe.
    return path_text(pos.join(static_broadcast(top), key), [*key, "orders"], status, "_pos", sep, segment).select("sequence", "orders")


def path_text(steps: DataFrame, key: Sequence[str], status: str, pos: str, sep: str, segment: int = SEGMENT, name: str = "sequence") -> DataFrame:
    """The steps of every key as one text in the order of ``pos`` (from 1, without gaps).

    Texts are put together per segment of ``segment`` steps first, so a long
    path is spread over tasks and its last step joins a few segment texts.
    """
    part = F.floor((F.col(pos) - 1) / segment).alias("_seg")
    texts = steps.groupBy(*key, part).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(pos), F.col(status)))), lambda x: x[status]), sep).alias("_t"))
    return texts.groupBy(*key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_seg", "_t"))), lambda x: x["_t"]), sep).alias(name))


def reference_payment(payments: DataFrame, key: Sequence[str], status: str, ts: str, tie: str,
                      captured: str = "CAPTURED", attempt: str = "attempt_no") -> tuple[DataFrame, DataFrame]:
    """(one reference payment per order = last captured, all attempts numbered); rows with a null key are left out.

    Attempts are numbered chronologically by ``ordering.positions``; the
    reference is the top-1 captured attempt (partial group limit before the
    shuffle), so neither step gathers an order in one task.
    """
    key = list(key)
    attempts = positions(payments.dropna(subset=key), key, [F.col(ts).asc_nulls_last(), F.col(tie).asc()], attempt)
    cap = attempts.where(F.col(status) == captured)
    ref = keep_one(cap, key, [F.col(ts).desc_nulls_first(), F.col(tie).desc()], [ts, tie])
    return ref, attempts


def partial_due(check: DataFrame, total: str) -> DataFrame:
    """is_partial_payment flag and the amount still due (never negative)."""
    return check.withColumn("is_partial_payment", F.col("is_partial")).withColumn(
        "amount_due", F.when(F.col("has_capture"), F.greatest(F.col(total) - F.col("captured_amount"), F.lit(0.0))))
