"""Operators rewritten so that a hot key or a long text never lands whole in one task."""

from pyspark.sql import functions as F

from curata.operators import dedup, identity, reshape, rules
from curata.specs import Rule


def test_duplicate_summary_digests_long_texts(spark):
    long_a = "x" * 500 + "a"
    long_b = "x" * 500 + "b"          # equal to long_a on the first 500 characters
    rows = [(1, long_a), (1, long_a), (2, long_a), (2, long_b), (3, None), (3, None), (4, "short")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = dedup.duplicate_summary(df, "id").collect()[0]
    assert (got.rows, got.distinct_keys, got.surplus_rows) == (7, 4, 3)
    # identical copies: id 1 (long text) and id 3 (null text); id 2 conflicts
    assert got.fully_identical_rows == 2 and got.conflicting_rows == 1


def test_compact_text_keeps_short_values_and_nulls_apart(spark):
    df = spark.createDataFrame([("=abc",), ("abc",), (None,), ("y" * 65,)], "t string")
    out = [r.t for r in dedup.compact_text(df).collect()]
    assert out[0] == "==abc" and out[1] == "=abc" and out[2] is None and out[3].startswith("#")
    assert len(set(out)) == 4


def test_identity_groups_hot_identity(spark):
    # one identity holds a third of the rows, spread over many members
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("email"),
        (F.col("id") % 700).alias("member"), F.lit("x").alias("city"))
    got = {r.email: (r.rows, r.n_ids) for r in identity.identity_groups(df, "email", "member", ["city"]).collect()}
    exp = {r.email: (r.rows, r.n_ids) for r in df.groupBy("email").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("member").alias("n_ids")).collect()}
    assert got == exp
    sizes = {r.group_size: r.n_groups for r in identity.group_sizes(df, "email", "member").collect()}
    assert sum(sizes.values()) == len([e for e, (r, _) in exp.items() if r > 1])


def test_weighted_rules_equal_fanned_out_rows(spark):
    fan = spark.createDataFrame([("F", "R"), ("F", "R"), ("F", "N"), ("O", "R")], "status string, flag string")
    weighted = fan.groupBy("status", "flag").agg(F.count(F.lit(1)).alias("n"))
    rule = [Rule("F with R", "t", (F.col("status") == "F") & (F.col("flag") == "R"))]
    a = rules.run_rules(fan, rule).collect()[0]
    b = rules.run_rules(weighted, rule, weight="n").collect()[0]
    assert (a.violations, a.population) == (b.violations, b.population) == (2, 4)


def test_frequency_share_uses_grand_total(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    got = {r.v: (r.n, round(r.pct, 6)) for r in reshape.frequency(df, "v").collect()}
    assert got == {"a": (2, 50.0), "b": (1, 25.0), None: (1, 25.0)}


def test_profile_columns_typed_values_match_text(spark):
    import datetime as dt
    from decimal import Decimal

    from curata.operators import profile
    rows = [(1, 0.0, "a", True, dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 5), Decimal("1.50")),
            (1, -0.0, "a", False, dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 5), Decimal("1.50")),
            (2, 2.5, None, None, None, None, None),
            (None, 2.5, "b", True, dt.date(2024, 2, 1), dt.datetime(2024, 2, 1, 6), Decimal("2.00"))]
    df = spark.createDataFrame(rows, "i long, d double, s string, b boolean, day date, ts timestamp, m decimal(10,2)")
    got = {r.column: (r.nulls, r.distinct, r.top_value) for r in profile.profile_columns(df).collect()}
    # reference: every value as text (-0.0 folded into 0.0), ties to the smallest text
    exp = {}
    for c in df.columns:
        col = F.col(c) + F.lit(0.0) if c == "d" else F.col(c)
        vc = df.select(col.cast("string").alias("v")).groupBy("v").count().collect()
        nn = [(r["count"], r.v) for r in vc if r.v is not None]
        top = min(nn, key=lambda t: (-t[0], t[1]))[1]
        exp[c] = (sum(r["count"] for r in vc if r.v is None), len(nn), top)
    assert got == exp


def test_fx_convert_rate_table(spark):
    import datetime as dt

    from curata.operators.marts import fx_convert
    d1, d2 = dt.date(2025, 5, 1), dt.date(2025, 5, 2)
    sales = spark.createDataFrame([(1, 100.0, "XOF", d1), (2, 50.0, "NGN", d1), (3, 10.0, "XOF", d2),
                                   (4, 20.0, "KES", d1)], "id int, amount double, currency string, day date")
    rates = spark.createDataFrame([("XOF", d1, 0.0016), ("XOF", d1, 0.0016),   # repeated, agreeing
                                   ("NGN", d1, 0.0006), ("NGN", d1, 0.0007),   # conflicting
                                   ("XOF", d2, 0.0015)], "currency string, day date, rate double")
    out = {r.id: r.amount_converted for r in fx_convert(sales, rates, "amount", "currency", "day").collect()}
    assert out[1] == 100.0 * 0.0016 and out[3] == 10.0 * 0.0015
    assert out[2] is None and out[4] is None          # conflicting rate, missing rate: null, never 1
    assert len(out) == 4


def test_a_path_of_a_million_steps_is_put_together_by_segments(spark):
    from pyspark.sql import functions as F

    from curata.operators.payments import path_text

    steps = spark.range(1_000_000, numPartitions=8).select(F.lit("hot").alias("k"), (F.col("id") + 1).alias("pos"), (F.col("id") % 7).cast("string").alias("s"))
    steps = steps.unionByName(spark.createDataFrame([("small", 2, "b"), ("small", 1, "a")], "k string, pos long, s string"))
    made = path_text(steps, ["k"], "s", "pos", ">")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "_seg" in plan and plan.count("hashpartitioning(k") == 2          # by (key, segment), then by key
    segments = steps.groupBy("k", F.floor((F.col("pos") - 1) / 10_000)).count().agg(F.max("count"), F.count("*")).first()
    assert tuple(segments) == (10_000, 101)
    got = {r.k: r for r in made.select("k", F.length("sequence").alias("n"), F.sha2("sequence", 256).alias("h")).collect()}
    import hashlib
    text = ">".join(str(i % 7) for i in range(1_000_000))
    assert (got["hot"].n, got["hot"].h) == (len(text), hashlib.sha256(text.encode()).hexdigest()) and got["small"].h == hashlib.sha256(b"a>b").hexdigest()
