"""Latest / first / surplus rules (W1-W7, N12, N13, A1) on hand-made orders."""

import datetime as dt

from curata.operators import dedup

T = dt.datetime
ROWS = [
    ("o1", T(2025, 1, 1), "A", 10.0),
    ("o1", T(2025, 1, 3), "B", 10.0),     # newest
    ("o1", None, "C", 10.0),              # null time
    ("o2", T(2025, 1, 2), "A", 5.0),
    ("o2", T(2025, 1, 2), "A", 5.0),      # identical copy
    ("o3", T(2025, 1, 5), "A", 1.0),
    ("o3", T(2025, 1, 5), "Z", 1.0),      # tie on time, conflicting
    (None, T(2025, 1, 1), "A", 0.0),
    (None, T(2025, 1, 2), "B", 0.0),
]
SCHEMA = "order_id string, updated_at timestamp, status string, total double"


def _df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_latest_null_is_oldest_curated_rule(spark):
    got = {r.order_id: r.status for r in dedup.latest(_df(spark), "order_id").collect()}
    assert got["o1"] == "B"            # N13: null time loses
    assert got["o3"] == "Z"            # tie broken by remaining columns, descending
    assert got[None] == "B"            # null keys group together


def test_latest_null_is_newest_notebook_rule(spark):
    got = {r.order_id: r.status for r in dedup.latest(_df(spark), "order_id", nulls="newest").collect()}
    assert got["o1"] == "C"            # N12: null time wins


def test_first_and_surplus(spark):
    got = {r.order_id: r.status for r in dedup.first(_df(spark), "order_id", ["updated_at"]).collect()}
    assert got["o1"] == "C" and got["o3"] == "A"   # ascending, nulls first
    flags = dedup.flag_surplus(_df(spark), "order_id", ["updated_at"]).where("is_surplus").count()
    assert flags == len(ROWS) - 4
    rep = dedup.flag_repeated(_df(spark), "order_id").where("is_repeated").count()
    assert rep == len(ROWS)            # every key repeats, the null key included (N8)


def test_duplicate_summary(spark):
    r = dedup.duplicate_summary(_df(spark), "order_id").first().asDict()
    assert r == {"rows": 9, "distinct_keys": 3, "null_keys": 2, "rows_with_repeated_key": 9,
                 "surplus_rows": 5, "fully_identical_rows": 1, "conflicting_rows": 4}
    dups = dedup.full_row_duplicates(_df(spark)).collect()
    assert len(dups) == 1 and dups[0]["n_copies"] == 2


def test_split_latest_keeps_every_row(spark):
    kept, dropped = dedup.split_latest(_df(spark), "order_id")
    assert kept.count() + dropped.count() == len(ROWS)
