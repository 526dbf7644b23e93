"""Rows without a group label are left out, as a pandas groupby does."""

import datetime as dt

from curata.operators import marts, payments, reshape

T = dt.datetime


def test_value_index_and_extremes(spark):
    df = spark.createDataFrame([("2025-01", "a", 10.0), ("2025-02", "a", 20.0), (None, "a", 150.0), (None, "a", 1.0), ("2025-01", None, 5.0)],
                               "month string, cur string, v double")
    got = {(r.month, r.cur): r["index"] for r in marts.value_index(df, "month", "cur", "v").collect()}
    assert got == {("2025-01", "a"): 100.0, ("2025-02", "a"): 200.0}
    e = marts.period_extremes(df, "month").first()
    assert (e.min_period, e.max_period, e.mean_per_period) == ("2025-02", "2025-01", 1.5)


def test_describe_and_box(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 100.0)], "g string, x double")
    assert [(r.g, r.p50) for r in reshape.describe(df, "x", (0.5,), "g").collect()] == [("a", 2.0)]
    assert [(r.g, r.median) for r in reshape.box_stats(df, "x", "g").collect()] == [("a", 2.0)]


def test_status_paths_and_reference(spark):
    rows = [(k, d, s, T(2025, 1, d or 1, h), 10 * (d or 9) + h) for k, d in ((1, 1), (1, 2), (1, 3), (1, 4), (None, 5), (2, None))
            for h, s in ((1, "a"), (2, "b"))] + [(3, 1, "c", T(2025, 1, 1, 1), 901), (3, 1, "d", T(2025, 1, 1, 2), 902)]
    df = spark.createDataFrame(rows, "u long, day int, s string, ts timestamp, id long")
    got = {r["sequence"]: r.orders for r in payments.status_sequences(df, ["u", "day"], "s", "ts", "id").collect()}
    assert got == {"a → b": 4, "c → d": 1}
    ref, attempts = payments.reference_payment(df, ["u", "day"], "s", "ts", "id", captured="b")
    assert ref.count() == 4 and attempts.count() == 10
