"""Guarded MERGE (J20) and its snapshot folders."""

import datetime as dt
import os

from curata.sources.upsert import merge_latest, read_current, table_exists, upsert

T = dt.datetime
SCHEMA = "id string, updated_at timestamp, v string"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple("" if x is None else str(x) for x in r))


def test_merge_rules(spark):
    target = spark.createDataFrame([
        ("upd", T(2025, 1, 1), "t"), ("old", T(2025, 1, 5), "t"), ("tie", T(2025, 1, 2), "t"),
        ("tnull", None, "t"), ("snull", T(2025, 1, 1), "t"), ("keep", T(2025, 1, 1), "t"), (None, T(2025, 1, 1), "t")],
        SCHEMA)
    source = spark.createDataFrame([
        ("upd", T(2025, 1, 2), "s"), ("old", T(2025, 1, 4), "s"), ("tie", T(2025, 1, 2), "s"),
        ("tnull", T(2025, 1, 9), "s"), ("snull", None, "s"), ("new", T(2025, 1, 1), "s"),
        ("rep", T(2025, 1, 1), "s1"), ("rep", T(2025, 1, 3), "s3"), (None, T(2025, 1, 1), "s")], SCHEMA)
    got = {(r.id, r.v) for r in merge_latest(target, source, "id").collect()}
    assert ("upd", "s") in got                       # newer source wins
    assert ("old", "t") in got                       # older source ignored
    assert ("tie", "s") in got                       # tie takes the source
    assert ("tnull", "t") in got and ("snull", "t") in got   # null time on either side keeps target
    assert ("keep", "t") in got and ("new", "s") in got
    assert ("rep", "s3") in got and ("rep", "s1") not in got  # source deduplicated to its latest
    assert (None, "t") in got and (None, "s") in got  # null keys never match: both kept


def test_upsert_equals_merge_and_is_idempotent(spark, scratch):
    path = f"{scratch}/curated/t"
    b1 = spark.createDataFrame([(f"k{i}", T(2025, 1, 1), "a") for i in range(200)], SCHEMA)
    b2 = spark.createDataFrame([(f"k{i}", T(2025, 1, 2), "b") for i in range(0, 10)]
                               + [("new", T(2025, 1, 2), "n")], SCHEMA)
    assert not table_exists(spark, path)
    upsert(spark, b1, path, "id")
    assert table_exists(spark, path)
    assert upsert(spark, b2, path, "id") == {"version": 1}
    expected = _rows(merge_latest(b1, b2, "id"))
    assert _rows(read_current(spark, path)) == expected
    for _ in range(4):
        upsert(spark, b2, path, "id")                  # replaying a batch changes nothing
    assert _rows(read_current(spark, path)) == expected
    assert sorted(d for d in os.listdir(path)) == ["snapshot=3", "snapshot=4", "snapshot=5"]       # older ones are gone


def test_incomplete_snapshots_are_never_read(spark, scratch):
    path = f"{scratch}/t"
    upsert(spark, spark.createDataFrame([("a", T(2025, 1, 1), "1")], SCHEMA), path, "id")
    os.makedirs(f"{path}/snapshot=1")                  # what a lost writer leaves
    assert upsert(spark, spark.createDataFrame([("b", T(2025, 1, 1), "2")], SCHEMA), path, "id") == {"version": 2}
    assert [r[0] for r in _rows(read_current(spark, path))] == ["a", "b"]


def test_batch_order_does_not_matter(spark, scratch):
    b1 = spark.createDataFrame([("a", T(2025, 1, 1), "1"), ("b", T(2025, 1, 3), "1")], SCHEMA)
    b2 = spark.createDataFrame([("a", T(2025, 1, 2), "2"), ("b", T(2025, 1, 2), "2")], SCHEMA)
    p1, p2 = f"{scratch}/x", f"{scratch}/y"
    upsert(spark, b1, p1, "id")
    upsert(spark, b2, p1, "id")
    upsert(spark, b2, p2, "id")
    upsert(spark, b1, p2, "id")
    assert _rows(read_current(spark, p1)) == _rows(read_current(spark, p2))


def test_replayed_epoch_is_skipped(spark, scratch):
    import os

    path = os.path.join(scratch, "t_epochs")
    schema = "id string, updated_at timestamp, v string"
    b0 = spark.createDataFrame([("a", dt.datetime(2025, 1, 1), "1"), (None, dt.datetime(2025, 1, 1), "n")], schema)
    upsert(spark, b0, path, "id", "updated_at", batch_key="stream-1", batch_id=0)
    b1 = spark.createDataFrame([("b", dt.datetime(2025, 1, 2), "2"), (None, dt.datetime(2025, 1, 2), "m")], schema)
    upsert(spark, b1, path, "id", "updated_at", batch_key="stream-1", batch_id=1)
    out = upsert(spark, b1, path, "id", "updated_at", batch_key="stream-1", batch_id=1)   # replay after a failure
    assert out.get("skipped") is True
    assert read_current(spark, path).count() == 4          # a, b and the two null-key rows, once each
    # another stream keeps its own epochs
    upsert(spark, b1, path, "id", "updated_at", batch_key="stream-2", batch_id=0)
    assert read_current(spark, path).count() == 5          # its null-key row is new to the table


def test_stale_writer_fails_and_loses_nothing(spark, scratch, monkeypatch):
    """Two writers start from one version: the first commit stays readable, the second fails."""
    import pytest
    from pyspark.errors import AnalysisException

    from curata.sources import upsert as store

    path = f"{scratch}/stale"
    upsert(spark, spark.createDataFrame([(f"k{i}", T(2025, 1, 1), "0") for i in range(20)], SCHEMA), path, "id")
    first = spark.createDataFrame([("k0", T(2025, 1, 2), "first"), ("n", T(2025, 1, 2), "first")], SCHEMA)
    second = spark.createDataFrame([("k0", T(2025, 1, 3), "second"), ("k1", T(2025, 1, 3), "second")], SCHEMA)
    upsert(spark, first, path, "id")
    committed = _rows(read_current(spark, path))
    monkeypatch.setattr(store, "_numbers", lambda *a, **k: [0])     # the second writer read the table before the first commit
    with pytest.raises(AnalysisException, match="already exists"):
        upsert(spark, second, path, "id")
    monkeypatch.undo()
    assert _rows(read_current(spark, path)) == committed and ("k0", "first") in {(r[0], r[2]) for r in committed}
    upsert(spark, second, path, "id")                    # a retry from the new version works
    got = {r.id: r.v for r in read_current(spark, path).collect()}
    assert len(got) == 21 and got["k0"] == got["k1"] == "second" and got["n"] == "first"


def test_null_times_stay_in_the_target(spark):
    """The registered merge splits lines by time; lines without one belong to the target."""
    from curata.plans import catalog

    li = spark.createDataFrame([(1, 1, None), (1, 2, T(1998, 6, 1))], "l_orderkey long, l_linenumber int, l_shipdate timestamp")
    star = type("S", (), {"t": lambda self, n: li})()
    catalog_star, catalog.Star = catalog.Star, lambda *a: star
    try:
        assert catalog.q_upsert_merge(spark, "").count() == 2
    finally:
        catalog.Star = catalog_star
