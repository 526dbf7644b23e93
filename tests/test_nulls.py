"""Null traps N1-N6, N11, N15, N21 on hand-made frames."""

from pyspark.sql import functions as F

from curata.functions import nulls as N
from curata.operators import integrity


def test_differs_outside_truthy(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (1, None), (None, None)], "a int, b int")
    got = [r[0] for r in df.select(N.differs("a", "b")).collect()]
    assert got == [False, True, True, True, True]          # N3: null on either side differs
    got = [r[0] for r in df.select(N.outside("a", 0, 1)).collect()]
    assert got == [False, False, True, False, True]        # N4: null is out of range
    got = [r[0] for r in df.select(N.truthy(F.col("a") < F.col("b"))).collect()]
    assert got == [False, True, False, False, False]       # N5: null comparison is no violation


def test_domain_blank_fullmatch(spark):
    df = spark.createDataFrame([("A",), ("Z",), (None,), ("  ",), ("ab12",)], "s string")
    assert [r[0] for r in df.select(N.not_in_domain("s", ["A"])).collect()] == [False, True, False, True, True]
    assert [r[0] for r in df.select(N.blank("s")).collect()] == [False, False, True, True, False]
    got = [r[0] for r in df.select(N.not_full_match("s", "[0-9a-f]+")).collect()]
    assert got == [True, True, True, True, False]           # N21: null counts as violation


def test_share_keeps_nulls_in_denominator(spark):
    df = spark.createDataFrame([("X",), ("Y",), (None,)], "s string")
    assert abs(df.select(N.share(F.col("s") == "X")).first()[0] - 1 / 3) < 1e-12   # N11


def test_safe_ratio_never_divides_by_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(N.safe_ratio("a", "b")).collect()] == [None, 0.5, None]


def test_orphans_null_rules(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "k int")
    # Null foreign key is an orphan
    assert sorted(r[0] is None for r in integrity.orphans(child, "k", parent, "k").collect()) == [False, True]
    # Null matches null
    assert [r[0] for r in integrity.orphans(child, "k", parent, "k", null_safe=True).collect()] == [2]
    rep = integrity.fk_check(child, "k", parent, "k", "c->p").first()
    assert (rep["rows"], rep["orphan_rows"], rep["orphan_distinct_keys"]) == (3, 2, 1)
