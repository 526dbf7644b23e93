"""What is kept between runs: quarantine with release, snapshots, surrogate keys, profile states; identity over two keys, survivorship."""

import random

import pytest
from pyspark.sql import functions as F

from curata.operators.components import identity_components
from curata.operators.profile_state import DISTINCT_ERROR, QUANTILES, RANK_ERROR, TOP, merge_states, profile_state, report
from curata.operators.survivorship import survivors
from curata.operators.treat import tag_reasons
from curata.sources import keys, quarantine, snapshots


def components(rows):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for m, *values in rows:
        if m is not None:
            top(("m", m))
            for k, v in enumerate(values):
                if v is not None:
                    root[top((k, v))] = top(("m", m))
    groups = {}
    for m in {r[0] for r in rows if r[0] is not None}:
        groups.setdefault(top(("m", m)), []).append(m)
    return sorted((m, min(g)) for g in groups.values() for m in g)


@pytest.mark.parametrize("seed", range(3))
def test_identity_over_two_keys(spark, seed):
    r = random.Random(seed)
    rows = [(k if r.random() < 0.95 else None, f"e{r.randrange(60)}" if r.random() < 0.6 else None, f"p{r.randrange(60)}" if r.random() < 0.6 else None) for k in range(90)]
    rows += [(1000 + k, f"chain{k // 2}", f"link{(k + 1) // 2}") for k in range(60)]         # one long chain
    rows += [(2000 + k, "hot", None) for k in range(300)] + [(2000, "hot", "p1"), (5, None, None)]
    df = spark.createDataFrame(rows, "member long, email string, phone string")
    got = sorted(tuple(x) for x in identity_components(df, "member", ["email", "phone"]).collect())
    assert got == components(rows)


def test_identity_of_nothing(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, None)], "member long, email string, phone string")
    assert sorted(tuple(x) for x in identity_components(df, "member", ["email", "phone"]).collect()) == [(1, 1), (2, 2)]
    assert identity_components(df.limit(0), "member", ["email", "phone"]).count() == 0


def test_survivors(spark):
    rows = [("a", "crm", "2025-01-01", "Dakar", None), ("a", "shop", "2025-06-01", "Accra", "x"), ("a", "web", "2025-07-01", "Lagos", "y"), ("a", "crm", None, "Old", "z"),
            ("b", "shop", "2025-01-01", "one", None), ("b", "shop", "2025-01-01", "two", None), ("b", "other", "2025-09-01", "no", "no"), (None, "crm", "2025-01-01", "q", "q"), ("c", "web", None, None, None)]
    df = spark.createDataFrame(rows, "id string, source string, at string, city string, phone string")
    got = {r.id: tuple(r)[1:] for r in survivors(df, "id", "source", "at", {"city": ["crm", "shop", "web"], "phone": ["web", "crm"]}).collect()}
    assert got == {"a": ("Dakar", "crm", "2025-01-01", "y", "web", "2025-07-01"), "b": ("two", "shop", "2025-01-01", None, None, None), "c": (None,) * 6}


def test_quarantine_releases_rows_whose_parent_arrived(spark, scratch):
    def run(lines, parents, run_id, previous):
        p = spark.createDataFrame([(x,) for x in parents], "pid string")
        known = quarantine.known_parents(spark, scratch, "lines", previous)
        every = p.select(F.col("pid").alias("key")) if known is None else known.unionByName(p.select(F.col("pid").alias("key")))
        ok = {r.key for r in every.collect()}
        t = spark.createDataFrame(lines, "lid string, pid string, bad boolean")
        tagged = tag_reasons(t, {"orphan": F.coalesce(~F.col("pid").isin(list(ok)), F.lit(True)), "formula": F.col("bad")})
        return quarantine.settle(spark, tagged, p, "pid", "pid", scratch, "lines", run_id, previous)

    def zones(run_id, runs):
        cur = [r.lid for x in runs for r in spark.read.parquet(f"{scratch}/curated/lines/run_id={x}").collect()]
        held = {r.lid: (r.reasons, r.held_since) for r in spark.read.parquet(f"{scratch}/quarantine/lines/run_id={run_id}").collect()}
        return sorted(cur), held

    first = [("l1", "p1", False), ("l2", "p2", False), ("l3", "p2", True), ("l4", None, False), ("l5", "p3", False)]
    assert run(first, ["p1"], "r1", None) == {"curated": 1, "released": 0, "held": 4}
    assert zones("r1", ["r1"]) == (["l1"], {"l2": ("orphan", "r1"), "l3": ("orphan,formula", "r1"), "l4": ("orphan", "r1"), "l5": ("orphan", "r1")})
    second = [("l6", "p2", False), ("l7", "p9", False)]
    assert run(second, ["p1", "p2", None], "r2", "r1") == {"curated": 2, "released": 1, "held": 4}
    cur, held = zones("r2", ["r1", "r2"])
    assert cur == ["l1", "l2", "l6"] and held == {"l3": ("formula", "r1"), "l4": ("orphan", "r1"), "l5": ("orphan", "r1"), "l7": ("orphan", "r2")}
    assert sorted(cur + list(held)) == sorted(x[0] for x in first + second)
    assert run(second, ["p1", "p2", None], "r2", "r1") == {"curated": 2, "released": 1, "held": 4}      # a repeated run


def test_snapshots_over_four_runs(spark, scratch):
    def run(rows, run_id, previous):
        state = spark.createDataFrame(rows, "id string, v string")
        return {r.id: r.change for r in snapshots.take_snapshot(spark, state, "id", scratch, "t", run_id, f"2025-01-{run_id}", previous).collect()}

    assert run([("a", "1"), ("b", "1"), (None, None)], "01", None) == {"a": "insert", "b": "insert", None: "insert"}
    assert run([("a", "2"), ("b", "1"), ("c", None), (None, None)], "02", "01") == {"a": "update", "c": "insert"}
    assert run([("a", "2"), ("c", ""), (None, None)], "03", "02") == {"b": "delete", "c": "update"}
    assert run([("a", "2"), ("b", "1"), ("c", ""), ("c", ""), (None, "x")], "04", "03") == {None: "update", "b": "insert"}
    versions = snapshots.history(spark, scratch, "t", ["01", "02", "03", "04"])
    day = lambda t: t and t.strftime("%d")
    got = sorted(((r.id, r.v, day(r.valid_from), day(r.valid_to)) for r in versions.collect()), key=str)
    assert got == sorted([("a", "1", "01", "02"), ("a", "2", "02", None), ("b", "1", "01", "03"), ("b", "1", "04", None), ("c", None, "02", "03"), ("c", "", "03", None),
                          (None, None, "01", "04"), (None, "x", "04", None)], key=str)
    assert sorted(tuple(r) for r in snapshots.as_of(versions, "2025-01-02 12:00:00").where("id is not null").collect()) == [("a", "2"), ("b", "1"), ("c", None)]


def test_keys_are_stable_and_collisions_are_held(spark, scratch):
    first = spark.createDataFrame([("c1", "e1"), ("c2", "e2"), ("c2", "e2"), (None, "e0"), ("c4", None)], "id string, email string")
    assert keys.allocate(spark, first, "id", ["email"], f"{scratch}/k", "r1") == {"keys": 3, "new_keys": 3, "colliding_keys": 0, "new_colliding_keys": 0}
    one = {(r.id, r.identity): r.key for r in spark.read.parquet(f"{scratch}/k/run_id=r1").collect()}
    assert sorted(one.values()) == [1, 2, 3]
    second = spark.createDataFrame([("c0", "e9"), ("c2", "other"), ("c1", "e1")], "id string, email string")
    for _ in range(2):                                                   # a repeated run allocates the same
        assert keys.allocate(spark, second, "id", ["email"], f"{scratch}/k", "r2", "r1") == {"keys": 5, "new_keys": 2, "colliding_keys": 2, "new_colliding_keys": 1}
        table = spark.read.parquet(f"{scratch}/k/run_id=r2")
        two = {(r.id, r.identity): r.key for r in table.collect()}
        assert {k: v for k, v in two.items() if k in one} == one and sorted(two.values()) == [1, 2, 3, 4, 5]
    rows, held = keys.with_keys(second, table, "id", ["email"])
    assert sorted((r.id, r.key) for r in rows.collect()) == [("c0", 4), ("c1", 1)] and [(r.id, r.key) for r in held.collect()] == [("c2", 5)]


def test_merged_profile_states(spark):
    r = random.Random(1)
    rows = [(k, r.gauss(50, 10) if k % 11 else None, r.choice("abc") if k % 3 else f"v{k}", k % 5) for k in range(6000)]
    df = spark.createDataFrame(rows, "id long, x double, s string, day int")
    days = [profile_state(df.where(F.col("day") == d).drop("day")) for d in range(5)]
    merged = days[0]
    for d in days[1:]:
        merged = merged.unionByName(d)
    merged = merge_states(merge_states(merged.where("column <> 'never'")))
    whole = {x.column: x for x in report(profile_state(df.drop("day"))).collect()}
    for x in report(merged).collect():
        y = whole[x.column]
        assert (x.rows, x.nulls, x.low, x.high) == (y.rows, y.nulls, y.low, y.high)
        assert x.mean == pytest.approx(y.mean) if y.mean is not None else x.mean is None
        assert x.std == pytest.approx(y.std) if y.std is not None else x.std is None
        true = sorted(v for v in (row[{"id": 0, "x": 1, "s": 2}[x.column]] for row in rows) if v is not None)
        assert abs(x.distinct_estimate - len(set(true))) <= DISTINCT_ERROR * len(set(true))
        if x.column != "s":
            for p in QUANTILES:
                value = x[f"p{round(100 * p):02d}"]
                rank = sum(v <= value for v in true) / len(true)
                assert abs(rank - p) <= 2 * RANK_ERROR + 1 / len(true)
        else:
            most = max(set(true), key=lambda v: (true.count(v), v))
            assert x.top_value in "abc" and true.count(x.top_value) - 6000 / TOP * 5 <= x.top_at_least <= true.count(x.top_value) and most in "abc"
