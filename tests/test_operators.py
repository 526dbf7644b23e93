"""Operators against brute force on small frames and on the sf0.001 tables."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from curata.operators import identity, payments, reshape, treat
from curata.operators.marts import quantile_scores, top_share
from curata.plans.retail import Star

SF = "/root/testdata/sf0.001"
T = dt.datetime


def test_payment_flags(spark):
    orders = spark.createDataFrame([("o1", 100.0), ("o2", 100.0), ("o3", 100.0), ("o4", 0.0), ("o5", 50.0)],
                                   "order_id string, total double")
    pays = spark.createDataFrame([
        ("o1", "FAILED", 100.0), ("o1", "CAPTURED", 100.0),      # retry, exact
        ("o2", "CAPTURED", 40.0),                                # partial
        ("o3", "CAPTURED", 100.0), ("o3", "CAPTURED", 100.0),    # double capture
        ("o4", "CAPTURED", 10.0),                                # zero total -> null ratio
    ], "order_id string, status string, amount double")
    c = {r.order_id: r for r in payments.payment_check(orders, pays, ["order_id"], "total", "status", "amount").collect()}
    assert c["o1"].is_retry and not c["o1"].is_partial and not c["o1"].is_overcapture
    assert c["o2"].is_partial and c["o3"].is_overcapture and c["o3"].is_multi_capture
    assert c["o4"].ratio is None and not c["o4"].is_partial and not c["o4"].is_overcapture
    assert c["o5"].n_payments == 0 and not c["o5"].has_capture
    due = {r.order_id: r.amount_due for r in payments.partial_due(
        payments.payment_check(orders, pays, ["order_id"], "total", "status", "amount"), "total").collect()}
    assert due["o2"] == 60.0 and due["o3"] == 0.0 and due["o5"] is None


def test_status_sequences_match_brute_force(spark):
    ev = Star(spark, SF).payments()
    got = {r.sequence: r.orders for r in
           payments.status_sequences(ev, ["user_id", "day"], "event_type", "ts", "event_id", k=1000).collect()}
    pdf = ev.toPandas().sort_values(["user_id", "day", "ts", "event_id"])
    seq = pdf.groupby(["user_id", "day"])["event_type"].apply(lambda s: " → ".join(s))
    want = seq[seq.str.contains("→")].value_counts().to_dict()
    assert got == want


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (6.99,), (7.0,), (23.0,), (-1.0,), (None,), (22.5,)], "d double")
    got = {r.bin_lo: r.n for r in reshape.histograms(df, "d", {"days": (0, 23)}).collect()}
    assert got == {0.0: 1, 6.0: 1, 7.0: 1, 22.0: 2}      # last bin closed, outside and null dropped


def test_box_stats_vs_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(10, 2, 200), [40.0, -20.0]])
    df = spark.createDataFrame([(float(v), "g") for v in vals], "x double, g string")
    r = reshape.box_stats(df, "x", "g").first()
    q1, q3 = np.percentile(vals, [25, 75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert math.isclose(r.q1, q1) and math.isclose(r.q3, q3)
    assert math.isclose(r.whisker_low, vals[vals >= lo].min()) and math.isclose(r.whisker_high, vals[vals <= hi].max())
    assert r.n_outliers == int(((vals < lo) | (vals > hi)).sum())


def test_top_share_vs_sort(spark):
    li = Star(spark, SF).t("lineitem")
    r = top_share(li, "l_suppkey", 0.1).first()
    counts = li.groupBy("l_suppkey").count().toPandas()["count"].sort_values(ascending=False).to_numpy()
    k = max(1, int(0.1 * len(counts)))
    assert r.top_keys == k and r.top_rows == counts[:k].sum() and r.rows == counts.sum()


def test_quantile_scores_vs_pandas(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 300), "x": rng.integers(0, 10, 300).astype(float)})
    out = quantile_scores(spark.createDataFrame(pdf), "g", {"x": True}).toPandas()
    for g, part in pdf.groupby("g"):
        s = np.sort(part["x"].to_numpy())
        cuts = [s[max(0, math.ceil(q * len(s)) - 1)] for q in (0.2, 0.4, 0.6, 0.8)]   # discrete percentile
        for _, row in out[out.g == g].iterrows():
            assert row.x_score == 1 + sum(row.x > c for c in cuts)


def test_quarantine_keeps_every_row(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, amount double")
    t = treat.tag_reasons(df, {"negative": F.col("amount") < 0, "missing": F.col("amount").isNull()})
    cur, q = treat.split_zones(t)
    assert cur.count() + q.count() == df.count()
    assert {r.id: r.reasons for r in q.collect()} == {2: "negative", 3: "missing"}
    rates = {r.reason: (r.rows, r.alert) for r in treat.reason_rates(t, ["negative", "missing"], 50.0).collect()}
    assert rates == {"negative": (1, False), "missing": (1, False)}


def test_identity_and_master(spark):
    df = spark.createDataFrame([
        (1, "e1", "Ann", 1990), (2, "e1", "Ann", 1990),          # identical profile
        (3, "e2", "Bob", 1980), (4, "e2", "Rob", 1980),          # different profile
        (5, None, "X", 2000), (6, None, "Y", 2001), (7, "e3", "Z", 1999)],
        "cid int, email string, name string, year int")
    r = identity.duplicate_identity_summary(df, "email", "cid", ["name", "year"]).first()
    assert (r.rows, r.surplus_rows, r.dup_groups, r.identical_profile_groups) == (7, 3, 2, 1)
    m = {x.cid: x.master_id for x in identity.master_id(df, "email", "cid").collect()}
    assert m == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7}
    sizes = {x.group_size: x.n_groups for x in identity.group_sizes(df, "email", "cid").collect()}
    assert sizes == {2: 2}


def test_crosstab_margins(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), (None, "x")], "r string, c string")
    got = {(x.r, x.c): x.n for x in reshape.crosstab_margins(df, "r", "c").collect()}
    assert got[("All", "All")] == 3 and got[("a", "All")] == 2 and got[("All", "x")] == 2


@pytest.mark.parametrize("bins,window", [(4096, 100_000), (64, 40)])
def test_exact_quantiles_match_percentile(spark, bins, window):
    """Groups of 1, 10, 10**4 and heavy-tailed values; small bins and windows force many rounds of the same path."""
    from curata.operators.quantiles import exact_quantiles
    rng = np.random.default_rng(5)
    parts = {"one": [3.5], "ten": rng.normal(0, 1, 10), "many": np.round(rng.normal(50, 20, 10_000), 1),
             "tail": np.concatenate([rng.lognormal(0, 8, 800), -rng.lognormal(0, 8, 200), [1e300, -1e300, 0.0, 5e-324, float("inf")]]), "none": [None] * 3}
    rows = [(g, None if x is None else float(x)) for g, v in parts.items() for x in v] + [("many", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {r.g: r for r in exact_quantiles(df, "x", probs, "g", extra={"n": F.count("x")}, bins=bins, window_values=window).collect()}
    ref = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("x", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()}
    assert set(got) == set(parts) | {None} and got["many"].n == 10_000
    for g, want in ref.items():
        for i, p in enumerate(probs):
            x = got[g][f"p{100 * p:.10g}".replace(".", "_")]
            assert (x is None and want is None) or x == want[i] or math.isclose(x, want[i], rel_tol=1e-12) or math.isnan(want[i])
    disc = exact_quantiles(df, "x", [0.2, 0.8], None, interpolation="disc", bins=bins, window_values=window).first()
    df.createOrReplaceTempView("qt")
    want = spark.sql("SELECT percentile_disc(0.2) WITHIN GROUP (ORDER BY x), "
                     "percentile_disc(0.8) WITHIN GROUP (ORDER BY x) FROM qt").first()
    assert tuple(disc) == tuple(want)


def test_exact_quantiles_of_a_million_values(spark):
    from curata.operators.quantiles import exact_quantiles
    df = spark.range(1_000_000).select((F.col("id") * F.lit(7919) % F.lit(1_000_000)).cast("double").alias("x"))
    got = exact_quantiles(df, "x", [0.25, 0.5], names=["a", "b"]).first()
    assert tuple(got) == (249999.75, 499999.5)


def test_broadcast_is_bounded_by_measured_bytes(spark):
    from curata.operators.joins import small_side
    long_labels = spark.range(100).select(F.repeat(F.lit("x"), 10_000).alias("label"), F.array(F.repeat(F.lit("y"), 100)).alias("more"))
    hint = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hint(small_side(long_labels, max_bytes=2 << 20)) and not hint(small_side(long_labels, max_bytes=900_000))
