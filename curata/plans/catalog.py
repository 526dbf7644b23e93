"""Registered queries over the driver's tables: name -> fn(spark, sf_dir) -> DataFrame.

Each query runs over whole tables. Doubles are rounded in the output (money
to 2 places, ratios and shares to 4) so that the DuckDB oracle in
``duckdb_sql`` compares exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.functions.nulls import differs, outside, truthy
from curata.operators import dedup, identity, integrity, payments, profile, reshape
from curata.operators.joins import join_on_keys
from curata.plans import marts
from curata.plans.retail import ACTIVE_PART_MIN_SIZE as ACTIVE_MIN
from curata.plans.retail import CAPTURED, FAILED, LATE_DAYS, LINE_KEY, SIGNUP, TOL, VIEW, Star
from curata.plans.roles import Retail, bind
from curata.sources.upsert import merge_latest

R4 = 4
UPSERT_TARGET_BEFORE = "1999-01-01"
UPSERT_SOURCE_FROM = "1998-01-01"
STAR_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "labels", "conversations", "pages", "benchmark", "embeddings"]


def _r(c, d=R4):
    return F.round(F.col(c), d).alias(c)


def _round_doubles(df: DataFrame, d: int = R4) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), d).alias(f.name) if f.dataType.typeName() in ("double", "float")
                       else F.col(f.name) for f in df.schema.fields])


# --- dedup and upsert ---------------------------------------------------------

def q_dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.latest(Star(spark, sf).t("lineitem"), LINE_KEY, "l_shipdate", nulls="oldest")


def q_dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.first(Star(spark, sf).t("lineitem"), LINE_KEY, ["l_shipdate"])


def q_dup_summary(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.duplicate_summary(Star(spark, sf).t("lineitem"), LINE_KEY, table="lineitem")


def q_dup_full_rows(spark: SparkSession, sf: str) -> DataFrame:
    """W7 on documents: copies of the same (text, lang, source).

    Texts are grouped by their SHA-256 plus length, so the shuffle carries
    32-byte digests instead of whole texts.
    """
    d = Star(spark, sf).t("documents")
    g = d.groupBy(F.sha2("text", 256).alias("_h"), F.length("text").alias("_len"), "lang", "source").agg(
        F.count(F.lit(1)).cast("long").alias("n_copies"), F.min("doc_id").alias("first_doc_id"))
    return g.where(F.col("n_copies") > 1).select("first_doc_id", "lang", "source", "n_copies")


def q_upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    li = Star(spark, sf).t("lineitem")
    before = F.coalesce(F.col("l_shipdate") < F.lit(UPSERT_TARGET_BEFORE).cast("timestamp"), F.lit(True))   # a null time stays in the target
    target = dedup.latest(li.where(before),
                          LINE_KEY, "l_shipdate", nulls="oldest")
    source = li.where(F.col("l_shipdate") >= F.lit(UPSERT_SOURCE_FROM).cast("timestamp"))
    return merge_latest(target, source, LINE_KEY, "l_shipdate")


# --- profiling ----------------------------------------------------------------

def q_profile_columns(spark: SparkSession, sf: str) -> DataFrame:
    s = Star(spark, sf)
    out = profile.profile_columns(s.t("orders"), "orders").unionByName(profile.profile_columns(s.t("lineitem"), "lineitem"))
    return _round_doubles(out)


def q_profile_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return _round_doubles(profile.numeric_profile(Star(spark, sf).t("lineitem")))


def q_profile_categorical(spark: SparkSession, sf: str) -> DataFrame:
    return _round_doubles(profile.categorical_profile(Star(spark, sf).t("orders"), 12))


def q_completeness(spark: SparkSession, sf: str) -> DataFrame:
    s = Star(spark, sf)
    out = None
    for t in STAR_TABLES:
        part = profile.completeness(s.t(t), t)
        out = part if out is None else out.unionByName(part)
    return _round_doubles(out)


# --- keys ---------------------------------------------------------------------

PK = {"region": ("r_regionkey",), "nation": ("n_nationkey",), "customer": ("c_custkey",),
      "supplier": ("s_suppkey",), "part": ("p_partkey",), "orders": ("o_orderkey",),
      "lineitem": LINE_KEY, "events": ("event_id",), "documents": ("doc_id",)}


def q_pk_report(spark: SparkSession, sf: str) -> DataFrame:
    s = Star(spark, sf)
    return integrity.pk_report({t: (s.t(t), k) for t, k in PK.items()})


def _fks(s: Star):
    return [
        (s.t("lineitem"), "l_orderkey", s.t("orders"), "o_orderkey", "lineitem.l_orderkey -> orders"),
        (s.t("lineitem"), "l_partkey", s.t("part"), "p_partkey", "lineitem.l_partkey -> part"),
        (s.t("lineitem"), "l_partkey", s.active_parts(), "p_partkey", "lineitem.l_partkey -> active part"),
        (s.t("lineitem"), "l_suppkey", s.t("supplier"), "s_suppkey", "lineitem.l_suppkey -> supplier"),
        (s.t("orders"), "o_custkey", s.t("customer"), "c_custkey", "orders.o_custkey -> customer"),
        (s.t("events"), "user_id", s.t("customer"), "c_custkey", "events.user_id -> customer"),
        (s.t("customer"), "c_nationkey", s.t("nation"), "n_nationkey", "customer.c_nationkey -> nation"),
        (s.t("supplier"), "s_nationkey", s.t("nation"), "n_nationkey", "supplier.s_nationkey -> nation"),
        (s.t("labels"), "doc_id", s.t("documents"), "doc_id", "labels.doc_id -> documents"),
    ]


def q_fk_report(spark: SparkSession, sf: str) -> DataFrame:
    return _round_doubles(integrity.fk_report(_fks(Star(spark, sf))))


def q_coverage_report(spark: SparkSession, sf: str) -> DataFrame:
    s = Star(spark, sf)
    checks = [
        (s.orders_u(), "o_orderkey", s.t("lineitem"), "l_orderkey", "orders -> lineitem"),
        (s.t("customer"), "c_custkey", s.t("orders"), "o_custkey", "customer -> orders"),
        (s.t("customer"), "c_custkey", s.t("events"), "user_id", "customer -> events"),
        (s.t("part"), "p_partkey", s.t("lineitem"), "l_partkey", "part -> lineitem"),
        (s.t("supplier"), "s_suppkey", s.t("lineitem"), "l_suppkey", "supplier -> lineitem"),
        (s.t("documents"), "doc_id", s.t("labels"), "doc_id", "documents -> labels"),
    ]
    return _round_doubles(integrity.coverage_report(checks))


# --- reconciliation (flagship) -------------------------------------------------

def line_facts(s: Star, lines: DataFrame | None = None) -> DataFrame:
    """Lines with what their part says about them, from ONE join: ``is_orphan`` (A2: not in the active catalogue),
    ``formula_mismatch`` (A2b), ``p_retailprice`` and ``signature`` (X8: first word of the part type).

    Parts are reduced to one row per key first, so the join adds no rows.
    """
    lines = s.t("lineitem") if lines is None else lines
    parts = s.t("part").where(F.col("p_partkey").isNotNull()).groupBy(F.col("p_partkey").alias("_pk")).agg(
        F.max(F.col("p_size") > ACTIVE_MIN).alias("_active"), F.min("p_retailprice").alias("p_retailprice"),
        F.min(F.substring_index("p_type", " ", 1)).alias("signature"))
    j = join_on_keys(lines, parts, [("l_partkey", "_pk")], "left")
    return j.select(lines["*"], "p_retailprice", "signature", (~F.coalesce(F.col("_active"), F.lit(False))).alias("is_orphan"),
                    truthy(F.abs(F.col("l_quantity") * F.col("p_retailprice") - F.col("l_extendedprice")) > TOL).alias("formula_mismatch"))


def order_line_facts(s: Star) -> DataFrame:
    """Per order: n_lines, sum_lines, sum_valid_lines, n_orphan_lines (one grouped pass)."""
    lines = line_facts(s)
    lt = s.line_total()
    return lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("long").alias("n_lines"),
        F.sum(lt).alias("sum_lines"),
        F.sum(F.when(~F.col("is_orphan"), lt)).alias("sum_valid_lines"),
        F.count_if("is_orphan").cast("long").alias("n_orphan_lines"))


def order_reconciliation(s: Star) -> DataFrame:
    facts = order_line_facts(s)
    o = s.orders_u().select("o_orderkey", "o_totalprice")
    j = o.join(facts, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    has = F.col("n_lines").isNotNull()
    return j.select(
        "o_orderkey", "o_totalprice", "n_lines", "sum_lines", "sum_valid_lines",
        F.coalesce(F.col("n_orphan_lines"), F.lit(0)).cast("long").alias("n_orphan_lines"),
        (F.col("o_totalprice") - F.col("sum_lines")).alias("gap"),
        (~has).alias("no_lines"),
        (has & truthy(F.abs(F.col("o_totalprice") - F.col("sum_lines")) > TOL)).alias("subtotal_mismatch"),
        (has & truthy(F.abs(F.col("o_totalprice") - F.coalesce(F.col("sum_valid_lines"), F.lit(0.0))) > TOL))
        .alias("subtotal_valid_mismatch"))


def q_order_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    return _round_doubles(order_reconciliation(Star(spark, sf)), 2)


# --- crosstabs ----------------------------------------------------------------

# The reconciliation checks of the A3 summary, in order (label, flag column).
RECON_CHECKS = [("order without any line", "no_lines"),
                ("total differs from the sum of all lines", "subtotal_mismatch"),
                ("total differs from the sum of valid lines", "subtotal_valid_mismatch")]


def q_reconciliation_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A3: orders per reconciliation check and their share of the deduplicated orders (one aggregate)."""
    rec = order_reconciliation(Star(spark, sf))
    c = _counts(rec, **{label: (F.count_if(flag), F.count(F.lit(1))) for label, flag in RECON_CHECKS})
    return _round_doubles(c.select(
        F.col("code").alias("check"), F.col("observed").alias("orders"),
        F.when(F.col("base") > 0, F.lit(100.0) * F.col("observed") / F.col("base")).alias("pct_orders")))


def q_reconciliation_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    """A3 x A3b with margins (G17): total mismatch against order without lines."""
    return reshape.crosstab_margins(order_reconciliation(Star(spark, sf)), "subtotal_mismatch", "no_lines")


def q_gap_ratio_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A3 size of the gap (G10): billed total / recomputed total over the mismatched orders."""
    rec = order_reconciliation(Star(spark, sf)).where(F.col("subtotal_mismatch"))
    ratio = rec.select(F.try_divide(F.col("o_totalprice"), F.col("sum_lines")).alias("ratio"))
    return _round_doubles(reshape.describe(ratio, "ratio", (0.25, 0.5, 0.75)))


def q_crosstab_margins(spark: SparkSession, sf: str) -> DataFrame:
    return reshape.crosstab_margins(Star(spark, sf).orders_u(), "o_orderstatus", "o_orderpriority")


def q_crosstab_row_pct(spark: SparkSession, sf: str) -> DataFrame:
    g = Star(spark, sf).geo()
    return _round_doubles(reshape.row_share(reshape.crosstab(g, "country", "c_mktsegment"), "country"))


# --- payments (events as payments of (user, day) orders) ------------------------

def payment_orders(s: Star) -> DataFrame:
    """The paid 'orders': one per (user_id, day); total = value of its 'view' events."""
    p = s.payments().where(F.col("user_id").isNotNull())
    return p.groupBy("user_id", "day").agg(
        F.coalesce(F.sum(F.when(F.col("event_type") == VIEW, F.col("value"))), F.lit(0.0)).alias("total"))


def payment_facts(s: Star) -> DataFrame:
    """Per paid 'order' (user_id, day): total and payment facts in ONE grouped pass over the events.

    Orders and payments are one table here, so the order totals and the
    payment facts share the grouping instead of two aggregations and a join.
    Facts count only rows with a day, as the join on (user_id, day) would.
    """
    p = s.payments().where(F.col("user_id").isNotNull())
    has_day, st = F.col("day").isNotNull(), F.col("event_type")
    g = p.groupBy("user_id", "day").agg(
        F.coalesce(F.sum(F.when(st == VIEW, F.col("value"))), F.lit(0.0)).alias("total"),
        F.count_if(has_day).cast("long").alias("n_payments"),
        F.count_if(has_day & (st == FAILED)).cast("long").alias("n_failed"),
        F.count_if(has_day & (st == CAPTURED)).cast("long").alias("n_captured"),
        F.coalesce(F.sum(F.when(has_day & (st == CAPTURED), F.col("value"))), F.lit(0.0)).alias("captured_amount"))
    return payments.payment_flags(g, "total")


def q_payment_summary(spark: SparkSession, sf: str) -> DataFrame:
    return payments.payment_summary(payment_facts(Star(spark, sf)))


def q_payment_ratio_topk(spark: SparkSession, sf: str) -> DataFrame:
    return payments.ratio_top_k(payment_facts(Star(spark, sf)), 10)


def q_status_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return payments.status_sequences(Star(spark, sf).payments(), ["user_id", "day"], "event_type", "ts", "event_id", k=8)


# --- deliveries (line ship date against its order date) --------------------------

def q_delivery_delays(spark: SparkSession, sf: str) -> DataFrame:
    """A5/A5b summary: delay quantiles plus late and negative counts."""
    from curata.operators.quantiles import exact_quantiles
    d = Star(spark, sf).deliveries()
    x = F.col("delay_days")
    extra = {"delivered": F.count(x).cast("long"), "late": F.count_if(x >= LATE_DAYS).cast("long"),
             "before_order": F.count_if(x < 0).cast("long"), "mean": F.avg(x), "std": F.stddev_samp(x),
             "min": F.min(x), "max": F.max(x)}
    out = exact_quantiles(d, "delay_days", (0.5, 0.9, 0.95, 0.99), names=["p50", "p90", "p95", "p99"], extra=extra, inputs=[])
    return _round_doubles(out.select("delivered", "late", "before_order", "mean", "std", "min",
                                     "p50", "p90", "p95", "p99", "max"))


def q_delay_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """M22."""
    return marts.delay_histogram(Star(spark, sf).roles("deliveries"))


def q_delay_box_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Per order priority."""
    return _round_doubles(marts.delay_box_stats(Star(spark, sf).roles("deliveries")).withColumnRenamed("area", "o_orderpriority"))


# --- product values ----------------------------------------------------------------

def part_costs(s: Star) -> DataFrame:
    """part with unit_cost = mean net unit price realised on its lines (null if never sold)."""
    li = s.t("lineitem").where(F.col("l_quantity") > 0)
    c = li.groupBy("l_partkey").agg(
        F.avg(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")) / F.col("l_quantity")).alias("unit_cost"))
    return s.t("part").join(c, F.col("p_partkey") == F.col("l_partkey"), "left").drop("l_partkey")


def q_value_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    p = part_costs(Star(spark, sf))
    price, cost = F.col("p_retailprice"), F.col("unit_cost")
    return p.agg(
        F.count(F.lit(1)).cast("long").alias("products"),
        F.count_if(truthy(price == 0)).cast("long").alias("zero_price"),
        F.count_if(truthy(cost > price)).cast("long").alias("cost_above_price"),
        F.count_if(truthy(cost > price) & ~truthy(price == 0)).cast("long").alias("negative_margin"),
        F.count_if(truthy(cost == 0)).cast("long").alias("zero_cost"))


def bad_products(s: Star) -> DataFrame:
    p = part_costs(s)
    return p.where(truthy(F.col("p_retailprice") == 0) | truthy(F.col("unit_cost") > F.col("p_retailprice")))


def q_lines_on_bad_products(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that use a zero-price or negative-margin product, and their share."""
    s = Star(spark, sf)
    flagged = integrity.flag_orphans(s.t("lineitem"), "l_partkey", bad_products(s), "p_partkey", name="_ok")
    out = flagged.agg(F.count_if(~F.col("_ok")).cast("long").alias("lines_on_bad_products"),
                      F.count(F.lit(1)).cast("long").alias("lines"))
    return _round_doubles(out.withColumn("pct", F.lit(100.0) * F.col("lines_on_bad_products") / F.col("lines")))


def q_bad_products_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    return reshape.crosstab_margins(bad_products(Star(spark, sf)), "p_type", "p_size")


# --- duplicate identities (part names shared by several part keys) -----------------

PART_PROFILE = ["p_brand", "p_type", "p_size", "p_retailprice"]


def q_duplicate_identity(spark: SparkSession, sf: str) -> DataFrame:
    return identity.duplicate_identity_summary(Star(spark, sf).t("part"), "p_name", "p_partkey", PART_PROFILE)


def q_identity_profiles(spark: SparkSession, sf: str) -> DataFrame:
    g = identity.identity_groups(Star(spark, sf).t("part"), "p_name", "p_partkey", PART_PROFILE)
    return g.where(F.col("rows") > 1)


def q_group_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return identity.group_sizes(Star(spark, sf).t("part"), "p_name", "p_partkey")


def q_document_copies(spark: SparkSession, sf: str) -> DataFrame:
    """A7-style duplicate summary on documents: same text under several ids."""
    d = Star(spark, sf).t("documents").withColumn("text_sha", F.sha2("text", 256))
    return identity.duplicate_identity_summary(d, "text_sha", "doc_id", ["lang", "source"])


# --- validity rules (V1-V4) ----------------------------------------------------------

# Allowed domains of the driver's tables (TPC-H specification values).
DOMAINS = {
    "orders": {"o_orderstatus": ["F", "O", "P"],
               "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]},
    "lineitem": {"l_returnflag": ["A", "N", "R"], "l_linestatus": ["F", "O"]},
    "customer": {"c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]},
    # brands are Brand#MN with M and N in 1..5 (built from that rule)
    "part": {"p_brand": [f"Brand#{m}{n}" for m in range(1, 6) for n in range(1, 6)],
             "p_type": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]},
    "events": {"event_type": ["click", "error", "purchase", "signup", "view"]},
}
ORDER_WINDOW = ("1992-01-01 00:00:00", "1998-08-02 23:59:59")


def _ts(v: str):
    return F.lit(v).cast("timestamp_ntz")


def first_order_vs_signup(s: Star) -> DataFrame:
    """V3.9/J11: per customer who ordered, the first order date and the first sign-up event (left join).

    Both sides are reduced to one row per customer first (min, map-side
    combined); null customer keys are dropped as in a pandas groupby (N7).
    """
    fo = (s.orders_u().where(F.col("o_custkey").isNotNull()).groupBy("o_custkey")
          .agg(F.min("o_orderdate").alias("first_order")))
    reg = (s.t("events").where((F.col("event_type") == SIGNUP) & F.col("user_id").isNotNull()).groupBy("user_id")
           .agg(F.min("ts").alias("signup")))
    return fo.join(reg, F.col("o_custkey") == F.col("user_id"), "left")


def validity_rules(s: Star) -> list:
    from curata.operators.rules import domain_rules
    from curata.functions.nulls import any_of, blank, not_full_match
    from curata.specs import Rule
    c = F.col
    return [
        (s.t("orders"), domain_rules("orders", DOMAINS["orders"]) + [
            Rule("o_totalprice <= 0", "orders", truthy(c("o_totalprice") <= 0)),
            Rule("o_orderdate outside announced window", "orders",
                 outside("o_orderdate", _ts(ORDER_WINDOW[0]), _ts(ORDER_WINDOW[1]))),
        ]),
        (s.t("lineitem"), domain_rules("lineitem", DOMAINS["lineitem"]) + [
            Rule("l_quantity <= 0", "lineitem", truthy(c("l_quantity") <= 0)),
            Rule("l_extendedprice <= 0", "lineitem", truthy(c("l_extendedprice") <= 0)),
            Rule("l_discount outside [0, 0.10]", "lineitem", outside("l_discount", 0.0, 0.10)),
            Rule("l_tax outside [0, 0.08]", "lineitem", outside("l_tax", 0.0, 0.08)),
            Rule("any of quantity, price, discount, tax < 0", "lineitem",
                 any_of(["l_quantity", "l_extendedprice", "l_discount", "l_tax"], lambda x: x < 0)),
            Rule("returned line not finished", "lineitem",
                 truthy(c("l_returnflag").isin("R", "A")) & differs(c("l_linestatus"), F.lit("F"))),
        ]),
        (first_order_vs_signup(s), [Rule("first order before sign-up", "orders x events",
                                         truthy(c("first_order") < c("signup")))]),
        (s.deliveries(), [Rule("l_shipdate < o_orderdate", "lineitem x orders", truthy(c("l_shipdate") < c("o_orderdate")))]),
        (s.t("customer"), domain_rules("customer", DOMAINS["customer"]) + [
            Rule("c_acctbal < 0", "customer", truthy(c("c_acctbal") < 0), note="informational"),
            Rule("c_name null or blank", "customer", blank("c_name")),
            Rule("c_name length != 18", "customer", differs(F.length("c_name"), F.lit(18))),
            Rule("c_name not Customer#digits", "customer", not_full_match("c_name", "Customer#[0-9]+")),
        ]),
        (s.t("part"), domain_rules("part", DOMAINS["part"]) + [
            Rule("p_size outside [1, 50]", "part", outside("p_size", 1, 50)),
            Rule("p_retailprice <= 0", "part", truthy(c("p_retailprice") <= 0)),
        ]),
        (s.t("events"), domain_rules("events", DOMAINS["events"]) + [
            Rule("value <= 0", "events", truthy(c("value") <= 0)),
            Rule("props not a JSON object", "events", not_full_match("props", r"\{.*\}")),
        ]),
        (s.t("supplier"), [Rule("s_acctbal < 0", "supplier", truthy(c("s_acctbal") < 0), note="informational")]),
    ]


def validity(s: Star) -> DataFrame:
    from curata.operators.rules import rows_of_ambiguous_groups, run_rule_sets
    base = run_rule_sets(validity_rules(s))
    amb = rows_of_ambiguous_groups(s.t("lineitem"), "l_returnflag", "l_linestatus").select(
        F.lit("l_returnflag with more than one l_linestatus").alias("check"), F.lit("lineitem").alias("table"),
        "violations", "population",
        F.when(F.col("population") > 0, F.round(F.lit(100.0) * F.col("violations") / F.col("population"), 3))
        .alias("violations_pct"), F.lit("").alias("note"))
    return base.unionByName(amb)


def q_validity_checks(spark: SparkSession, sf: str) -> DataFrame:
    return validity(Star(spark, sf))


def q_enum_unexpected(spark: SparkSession, sf: str) -> DataFrame:
    from curata.operators.rules import unexpected_values
    s = Star(spark, sf)
    out = None
    for t, doms in DOMAINS.items():
        part = unexpected_values(s.t(t), t, doms)
        out = part if out is None else out.unionByName(part)
    return out


# --- status coherence (C1-C3, V5) ---------------------------------------------------

NONE_PAY, NONE_DELIV = "(no line)", "(no line)"


def status_frame(s: Star) -> DataFrame:
    """Orders ⟕ status of the last-shipped line ⟕ return flags of their lines.

    The fan-out over lines is pre-aggregated: one row per (order, return
    flag) with ``n`` = the number of such lines (1 for an order without
    lines), so a hot order adds at most one row per flag to the join.
    Counting rows of the fan-out = summing ``n``.
    """
    li = s.t("lineitem")
    last = dedup.latest(li.select("l_orderkey", "l_shipdate", "l_linenumber", "l_linestatus"), "l_orderkey",
                        "l_shipdate", nulls="newest").select(F.col("l_orderkey").alias("_k1"), F.col("l_linestatus").alias("last_status"))
    flags = li.groupBy(F.col("l_orderkey").alias("_k2"), F.col("l_returnflag").alias("return_flag")).agg(
        F.count(F.lit(1)).alias("_n"))
    o = s.orders_u().select("o_orderkey", "o_orderstatus")
    j = (o.join(last, F.col("o_orderkey") == F.col("_k1"), "left")
         .join(flags, F.col("o_orderkey") == F.col("_k2"), "left"))
    return j.select("o_orderkey", "o_orderstatus",
                    F.coalesce("last_status", F.lit(NONE_PAY)).alias("last_status"),
                    F.coalesce("return_flag", F.lit(NONE_DELIV)).alias("return_flag"),
                    F.coalesce(F.col("_n"), F.lit(1)).cast("long").alias("n"))


def q_status_matrix_lines(spark: SparkSession, sf: str) -> DataFrame:
    st = status_frame(Star(spark, sf))
    return _round_doubles(reshape.row_share(reshape.crosstab(st, "o_orderstatus", "last_status", "n", "sum"),
                                            "o_orderstatus"))


def q_status_matrix_returns(spark: SparkSession, sf: str) -> DataFrame:
    st = status_frame(Star(spark, sf))
    return _round_doubles(reshape.row_share(reshape.crosstab(st, "o_orderstatus", "return_flag", "n", "sum"),
                                            "o_orderstatus"))


def coherence(s: Star) -> DataFrame:
    from curata.operators.rules import run_rules
    from curata.specs import Rule
    st = status_frame(s)
    c = F.col
    rules = [
        Rule("order F with last line still O", "orders x lineitem",
             truthy((c("o_orderstatus") == "F") & (c("last_status") == "O"))),
        Rule("order F without any line", "orders x lineitem",
             truthy((c("o_orderstatus") == "F") & (c("return_flag") == NONE_DELIV))),
        Rule("order O with a returned line", "orders x lineitem",
             truthy((c("o_orderstatus") == "O") & (c("return_flag") == "R"))),
    ]
    return run_rules(st, rules, weight="n")


def q_coherence_checks(spark: SparkSession, sf: str) -> DataFrame:
    return coherence(Star(spark, sf))


# --- anomaly register, scorecard, usable share (A*, AS, PR7, PR8) --------------------

def _counts(df: DataFrame, **codes) -> DataFrame:
    """One aggregate over ``df`` -> long rows (code, observed, base); codes map to (observed, base) Columns."""
    aggs = []
    for i, (obs, base) in enumerate(codes.values()):
        aggs += [obs.cast("long").alias(f"_o{i}"), base.cast("long").alias(f"_b{i}")]
    wide = df.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(code).alias("code"), F.col(f"_o{i}").alias("observed"), F.col(f"_b{i}").alias("base"))
        for i, code in enumerate(codes)])))


def anomaly_counts(s: Star) -> DataFrame:
    """(code, observed, base) of every registered anomaly: one aggregate per source frame."""
    rows = F.count(F.lit(1))
    dup = dedup.duplicate_summary(s.t("lineitem"), LINE_KEY).select(
        F.lit("A1").alias("code"), F.col("surplus_rows").alias("observed"), F.col("rows").alias("base"))
    lines = _counts(line_checks(s), A2=(F.count_if("is_orphan"), rows), A2b=(F.count_if("formula_mismatch"), rows))
    rec = _counts(order_reconciliation(s), A3b=(F.count_if("no_lines"), rows), A3c=(F.count_if("subtotal_mismatch"), rows))
    cap = F.count_if("has_capture")
    pay = _counts(payment_facts(s), A4a=(F.count_if("is_retry"), cap), A4b=(F.count_if("is_partial"), cap),
                  A4c=(F.count_if("is_overcapture"), cap))
    delay = F.col("delay_days")
    deliv = _counts(s.deliveries(), A5=(F.count_if(delay >= LATE_DAYS), F.count(delay)),
                    A5b=(F.count_if(delay < 0), F.count(delay)))
    zero = truthy(F.col("p_retailprice") == 0)
    parts = _counts(part_costs(s), A6a=(F.count_if(zero), rows),
                    A6b=(F.count_if(truthy(F.col("unit_cost") > F.col("p_retailprice")) & ~zero), rows))
    names = identity.duplicate_identity_summary(s.t("part"), "p_name", "p_partkey", PART_PROFILE).select(
        F.lit("A7a").alias("code"), F.col("surplus_rows").alias("observed"), F.col("rows").alias("base"))
    ids = dedup.duplicate_summary(s.t("customer"), "c_custkey").select(
        F.lit("A7b").alias("code"), F.col("surplus_rows").alias("observed"), F.col("rows").alias("base"))
    out = dup
    for f in (lines, rec, pay, deliv, parts, names, ids):
        out = out.unionByName(f)
    return out.select("code", F.col("observed").cast("long"), F.col("base").cast("long"))


# The register per anomaly: code, table, what is counted, severity, what the pipeline does about it (codes and severities are fixed values).
REGISTER_TEXT = [
    ("A1", "lineitem", "line keys that occur again", "High", "dedup_latest keeps the newest line; dedup_audit lists the others"),
    ("A2", "lineitem", "lines whose part is not active", "High", "line_quarantine, reason orphan; quarantine_alerts watches the rate"),
    ("A2b", "lineitem", "price is not quantity times list price", "High", "line_quarantine, reason formula"),
    ("A3b", "orders", "orders that own no line", "High", "order_quarantine, reason no_lines"),
    ("A3c", "orders", "total is not the sum of the lines", "Medium", "order_quarantine, reason total_mismatch; recomputed_total there"),
    ("A4a", "events", "orders with an error and a purchase", "Medium", "payment_reference picks the last purchase and numbers the attempts"),
    ("A4b", "events", "purchases under the viewed value", "Medium", "partial_due gives the amount open"),
    ("A4c", "events", "purchases over the viewed value", "High", "overcapture_dedup counts a reference once"),
    ("A5", "lineitem", "seven days or more to shipping", "Info", "kept; late lines enter through upsert_merge"),
    ("A5b", "lineitem", "shipping precedes the order", "Medium", "delay_treated leaves the delay empty"),
    ("A6a", "part", "parts listed at zero", "Medium", "product_flags, zone quarantine"),
    ("A6b", "part", "parts that cost more than they list", "Medium", "product_flags, zone flagged"),
    ("A7a", "part", "part names with several keys", "High", "customer_master gives one key per name"),
    ("A7b", "customer", "customer keys with several rows", "High", "surrogate_keys; line_key_collisions shows the form"),
]


def _lookup(code: Column, pairs) -> Column:
    """Literal map lookup (a fixed, code-sized table: no join)."""
    return F.create_map(*[F.lit(x) for kv in pairs for x in kv])[code]


def anomaly_register(s: Star) -> DataFrame:
    c = anomaly_counts(s)
    code = F.col("code")
    return c.select(
        "code", _lookup(code, [(r[0], r[1]) for r in REGISTER_TEXT]).alias("table"),
        _lookup(code, [(r[0], r[2]) for r in REGISTER_TEXT]).alias("description"), "observed", "base",
        F.when(F.col("base") > 0, F.round(F.lit(100.0) * F.col("observed") / F.col("base"), 2)).alias("observed_pct"),
        _lookup(code, [(r[0], r[3]) for r in REGISTER_TEXT]).alias("severity"),
        _lookup(code, [(r[0], r[4]) for r in REGISTER_TEXT]).alias("treatment"))


def q_anomaly_register(spark: SparkSession, sf: str) -> DataFrame:
    from curata.functions.scalars import severity_rank
    reg = anomaly_register(Star(spark, sf))
    return reg.orderBy(severity_rank("severity"), "code")


# The problem report for readers outside the team: code, headline, table, severity, one sentence, next step
# (codes, their order and the severities are fixed values).
PROBLEMS = [
    ("A1", "Lines stored twice", "lineitem", "High", "A line number is used again within its order.", "Use the newest copy."),
    ("A2", "Parts nobody sells", "lineitem", "High", "Some lines name a part outside the active list.", "Hold those lines back."),
    ("A3c", "Totals that don't add up", "orders", "High", "Adding up the lines gives another amount than the order states.", "Hold the order back."),
    ("A4c", "Paid too much", "events", "High", "Purchases exceed what was viewed that day.", "Ask the provider before summing."),
    ("A7a", "One part, many keys", "part", "High", "Several keys carry one part name.", "Work with the master key."),
    ("A7b", "One key, many customers", "customer", "High", "A customer key stands on several rows.", "Use the surrogate key."),
    ("A4b", "Paid too little", "events", "Medium", "Purchases stay under what was viewed that day.", "Show the open amount."),
    ("A4a", "Second try worked", "events", "Medium", "An error was followed by a purchase.", "Count the purchase only."),
    ("A5b", "Shipped too early", "lineitem", "Medium", "Some lines left before they were ordered.", "Leave the delay empty."),
    ("A6a", "Free parts", "part", "Medium", "The list shows a price of zero.", "Ask the owner of the list."),
    ("A6b", "Parts under cost", "part", "Medium", "The price stays under what the part costs.", "Tell the buyers."),
    ("A5", "Slow lines", "lineitem", "To know", "A week or more passed before shipping.", "Nothing to repair; watch it."),
]


def q_problem_report(spark: SparkSession, sf: str) -> DataFrame:
    """AR: the twelve-row plain-language problem report with the share of its file."""
    counts = anomaly_counts(Star(spark, sf)).where(F.col("code").isin([p[0] for p in PROBLEMS]))
    code = F.col("code")

    def pick(i: int) -> Column:
        return _lookup(code, [(p[0], p[i]) for p in PROBLEMS])

    out = counts.select(
        _lookup(code, [(p[0], r) for r, p in enumerate(PROBLEMS, start=1)]).alias("rank"),
        pick(1).alias("problem"), pick(2).alias("table"), "observed", "base",
        F.when(F.col("base") > 0, F.lit(100.0) * F.col("observed") / F.col("base")).alias("share_pct"),
        pick(3).alias("severity"), pick(4).alias("plain_text"), pick(5).alias("action"))
    return _round_doubles(out)


def line_checks(s: Star) -> DataFrame:
    """Lines with the A2 orphan flag, the A2b formula flag and the X8 signature."""
    return line_facts(s).select("l_orderkey", "l_partkey", "is_orphan", "signature", "formula_mismatch")


def q_orphan_lines_detail(spark: SparkSession, sf: str) -> DataFrame:
    """A2: orphan lines, their share, the orders they touch, and how they overlap the A2b formula check."""
    lc = line_checks(Star(spark, sf))
    out = lc.agg(
        F.count(F.lit(1)).cast("long").alias("lines"),
        F.count_if("is_orphan").cast("long").alias("orphan_lines"),
        F.count_distinct(F.when(F.col("is_orphan"), F.col("l_orderkey"))).cast("long").alias("orders_touched"),
        F.count_if("formula_mismatch").cast("long").alias("formula_mismatch"),
        F.count_if(F.col("is_orphan") & F.col("formula_mismatch")).cast("long").alias("orphan_and_mismatch"))
    return _round_doubles(out.withColumn(
        "orphan_pct", F.when(F.col("lines") > 0, F.lit(100.0) * F.col("orphan_lines") / F.col("lines"))))


def q_orphan_formula_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    """A2 x A2b with margins."""
    return reshape.crosstab_margins(line_checks(Star(spark, sf)), "is_orphan", "formula_mismatch")


def q_orphan_signature(spark: SparkSession, sf: str) -> DataFrame:
    """A2 signature (X8) side by side (U8): lines and orphan lines per first word of the part type."""
    return line_checks(Star(spark, sf)).groupBy("signature").agg(
        F.count(F.lit(1)).cast("long").alias("lines"), F.count_if("is_orphan").cast("long").alias("orphan_lines"))


def q_identity_history(spark: SparkSession, sf: str) -> DataFrame:
    """A7a impact (G14, J18): duplicate-name groups whose history is split over >= 2 sold parts; unsold parts."""
    s = Star(spark, sf)
    p = integrity.flag_orphans(s.t("part"), "p_partkey", s.t("lineitem"), "l_partkey", name="_unsold", null_safe=True)
    groups = p.where(F.col("p_name").isNotNull()).groupBy("p_name").agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(~F.col("_unsold")).alias("_sold"))
    g = groups.agg(F.count_if(F.col("_rows") > 1).cast("long").alias("dup_groups"),
                   F.count_if((F.col("_rows") > 1) & (F.col("_sold") >= 2)).cast("long").alias("split_history_groups"))
    u = p.agg(F.count(F.lit(1)).cast("long").alias("parts"), F.count_if("_unsold").cast("long").alias("parts_without_sales"))
    # two one-row aggregates side by side, without a join
    out = g.unionByName(u, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("dup_groups", "split_history_groups", "parts", "parts_without_sales")])
    return _round_doubles(out.withColumn(
        "parts_without_sales_pct", F.when(F.col("parts") > 0, F.lit(100.0) * F.col("parts_without_sales") / F.col("parts"))))


def identity_keys(s: Star) -> DataFrame:
    """Customers with the two keys that stand for e-mail and phone: one balance to the hundred in a nation and segment, and one balance to the unit."""
    return s.t("customer").select("c_custkey", F.concat_ws("|", "c_nationkey", "c_mktsegment", F.floor(F.col("c_acctbal") / 100).cast("string")).alias("first_key"),
                                  F.floor("c_acctbal").cast("long").alias("second_key"))


def q_identity_components(spark: SparkSession, sf: str) -> DataFrame:
    """A7a/T14 over two keys: customers who share either, directly or through others, are one person."""
    from curata.operators.components import identity_components
    return identity_components(identity_keys(Star(spark, sf)), "c_custkey", ["first_key", "second_key"])


# The sources of each attribute, the most trusted first.
ATTRIBUTE_SOURCES = {"contact": ("orders", "events"), "amount": ("customer", "orders", "events"), "state": ("events", "orders")}


def q_attribute_survivors(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer, each attribute from its most trusted source that has it, latest first, with source and time."""
    from curata.operators.survivorship import survivors
    s = Star(spark, sf)
    text, money, when = (F.lit(None).cast(t) for t in ("string", "double", "timestamp_ntz"))
    crm = s.t("customer").select(F.col("c_custkey").alias("customer"), F.lit("customer").alias("source"), when.alias("at"), text.alias("contact"),
                                 F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("amount"), text.alias("state"))
    orders = s.t("orders").select(F.col("o_custkey").alias("customer"), F.lit("orders").alias("source"), F.col("o_orderdate").alias("at"),
                                  F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("contact"), F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("state"))
    events = s.t("events").select(F.col("user_id").alias("customer"), F.lit("events").alias("source"), F.col("ts").alias("at"), F.col("event_type").alias("contact"),
                                  F.col("value").alias("amount"), F.when(F.col("event_type") == FAILED, F.col("event_type")).alias("state"))
    out = survivors(crm.unionByName(orders).unionByName(events), "customer", "source", "at", ATTRIBUTE_SOURCES)
    return out.withColumn("amount", F.round("amount", 2))


def q_id_prefix_signature(spark: SparkSession, sf: str) -> DataFrame:
    """A7a signature (X9, U8): per 11-character prefix of the part type, all parts and surplus parts by name."""
    part = Star(spark, sf).t("part")
    flagged = dedup.flag_surplus(part, "p_name", ["p_partkey"])
    return flagged.groupBy(F.substring("p_type", 1, 11).alias("prefix")).agg(
        F.count(F.lit(1)).cast("long").alias("rows"), F.count_if("is_surplus").cast("long").alias("surplus_rows"))


def q_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    """PR7: rows, completeness, failing checks (validity, cross-table and status checks) and registered anomalies per table."""
    s = Star(spark, sf)
    tables = ["orders", "lineitem", "customer", "part", "events", "supplier"]
    comp = None
    for t in tables:
        part = profile.completeness(s.t(t), t)
        comp = part if comp is None else comp.unionByName(part)
    # every check counts once, under the table that its label names first ("orders x events" under orders)
    checks = validity(s).select("table", "violations").unionByName(coherence(s).select("table", "violations"))
    v = checks.groupBy(F.substring_index("table", " x ", 1).alias("table")).agg(F.count_if(F.col("violations") > 0).cast("long").alias("failing_checks"))
    # every anomaly is registered whatever it observes: the count per table is fixed by the register
    per_table: dict[str, int] = {}
    for r in REGISTER_TEXT:
        per_table[r[1]] = per_table.get(r[1], 0) + 1
    registered = F.coalesce(_lookup(F.col("table"), list(per_table.items())), F.lit(0)).cast("long")
    out = (comp.join(v, "table", "left")
           .select("table", "rows", F.round("completeness_pct", 4).alias("completeness_pct"),
                   F.coalesce("failing_checks", F.lit(0)).cast("long").alias("failing_checks"),
                   registered.alias("registered_anomalies")))
    return out


def q_usable_share(spark: SparkSession, sf: str) -> DataFrame:
    """PR8: lines neither orphan nor off-formula (v2: not orphan); orders with lines and a matching total."""
    s = Star(spark, sf)
    li = line_facts(s)
    bad_formula = F.col("formula_mismatch")
    # v1: neither orphan nor off-formula; v2 (plain notebook): not orphan only -- one aggregate for both
    lines = _counts(li, lineitem=(F.count_if(~(F.col("is_orphan") | bad_formula)), F.count(F.lit(1))),
                    lineitem_not_orphan=(F.count_if(~F.col("is_orphan")), F.count(F.lit(1)))).select(
        F.col("code").alias("entity"), F.col("observed").alias("usable"), F.col("base").alias("total"))
    rec = order_reconciliation(s)
    orders = rec.agg(F.count_if(~F.col("no_lines") & ~F.col("subtotal_mismatch")).cast("long").alias("usable"),
                     F.count(F.lit(1)).cast("long").alias("total")).withColumn("entity", F.lit("orders"))
    out = lines.unionByName(orders)
    return out.select("entity", "usable", "total",
                      F.round(F.lit(100.0) * F.col("usable") / F.col("total"), 4).alias("usable_pct"))


# --- business marts (M1-M28) ----------------------------------------------------------


def q_orders_by_month(spark: SparkSession, sf: str) -> DataFrame:
    """M1."""
    return marts.orders_by_month(Star(spark, sf).roles("orders"))


def q_value_index(spark: SparkSession, sf: str) -> DataFrame:
    """M2."""
    out = marts.value_index(Star(spark, sf).roles("orders"))
    return out.select("month", "currency", F.round("value", 2).alias("value"), F.round("index", 4).alias("index"))


def q_monthly_volume(spark: SparkSession, sf: str) -> DataFrame:
    """M3."""
    return _round_doubles(marts.monthly_volume(Star(spark, sf).roles("orders")))


def q_weekday_hour(spark: SparkSession, sf: str) -> DataFrame:
    """M4: payment events per weekday and hour."""
    return marts.weekday_hour(Star(spark, sf).roles("visits"))


def q_weekday_hour_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """The weekday x hour table as a pivot over the 24 known hours, empty slots 0."""
    from curata.functions.scalars import weekday_name, weekday_rank
    e = Star(spark, sf).t("events").where(F.col("ts").isNotNull()).select(
        weekday_rank("ts").alias("dow_rank"), weekday_name("ts").alias("dow"), F.hour("ts").alias("hour"))
    return (e.groupBy("dow_rank", "dow").pivot("hour", list(range(24))).count()
            .fillna(0, subset=[str(h) for h in range(24)]))


def q_weekday_hour_range(spark: SparkSession, sf: str) -> DataFrame:
    """M5."""
    return marts.weekday_hour_range(Star(spark, sf).roles("visits"))


def q_status_channel_freq(spark: SparkSession, sf: str) -> DataFrame:
    """Frequency and share of order status, channel and line return flag."""
    s = Star(spark, sf)
    orders = reshape.frequencies(s.orders_u(), ["o_orderstatus", "o_orderpriority"])   # one pass over the orders
    lines = reshape.frequencies(s.t("lineitem"), ["l_returnflag"])
    return _round_doubles(orders.unionByName(lines))


def q_mix_by_country(spark: SparkSession, sf: str) -> DataFrame:
    """M7: channel and status mix per country, % of the country's orders."""
    mix = marts.mix_by_country(Star(spark, sf).roles("orders"))
    return _round_doubles(mix.withColumn("dimension", _lookup(F.col("dimension"), [("channel", "o_orderpriority"), ("status", "o_orderstatus")])))


def q_headline_shares(spark: SparkSession, sf: str) -> DataFrame:
    """M8."""
    return _round_doubles(marts.headline_shares(Star(spark, sf).roles("orders")))


def q_value_by_currency(spark: SparkSession, sf: str) -> DataFrame:
    """M9."""
    return _round_doubles(marts.value_by_currency(Star(spark, sf).roles("orders")))


def q_value_box_stats(spark: SparkSession, sf: str) -> DataFrame:
    """M10."""
    return _round_doubles(marts.value_box_stats(Star(spark, sf).roles("orders")))


def q_basket(spark: SparkSession, sf: str) -> DataFrame:
    """M11."""
    return _round_doubles(marts.basket(Star(spark, sf).roles("lines")))


def q_basket_frequency(spark: SparkSession, sf: str) -> DataFrame:
    """M12."""
    return marts.basket_frequency(Star(spark, sf).roles("lines"))


def q_units_by_category(spark: SparkSession, sf: str) -> DataFrame:
    """M13."""
    out = marts.units_by_category(Star(spark, sf).roles("orders", "lines", "catalogue"))
    return _round_doubles(out.withColumnRenamed("category", "p_type"))


def q_category_mix(spark: SparkSession, sf: str) -> DataFrame:
    """M14."""
    out = marts.category_mix(Star(spark, sf).roles("orders", "lines", "catalogue"))
    return _round_doubles(out.withColumnRenamed("category", "p_type"))


def q_seller_concentration(spark: SparkSession, sf: str) -> DataFrame:
    """M15."""
    return _round_doubles(marts.seller_concentration(Star(spark, sf).roles("lines")))


def q_brand_stats(spark: SparkSession, sf: str) -> DataFrame:
    """M16."""
    s = Star(spark, sf)
    return _round_doubles(marts.brand_stats(Retail({"products": _products(s, s.t("part").withColumn("unit_cost", F.lit(None).cast("double"))), **s.roles("lines").frames})))


def _products(s: Star, parts: DataFrame) -> DataFrame:
    return bind(parts, {"product": "p_partkey", "brand": "p_brand", "price": "p_retailprice", "cost": "unit_cost"}, "products")


def q_payment_mix(spark: SparkSession, sf: str) -> DataFrame:
    """Event types per country."""
    return _round_doubles(marts.payment_mix(Star(spark, sf).roles("payments"), "status").withColumnRenamed("status", "event_type"))


def q_payment_status_by_method(spark: SparkSession, sf: str) -> DataFrame:
    """Event types per method; the method is props' k modulo 6."""
    return _round_doubles(marts.payment_status_by_method(Star(spark, sf).roles("payments")).withColumnRenamed("status", "event_type"))


def q_failure_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Per country."""
    return _round_doubles(marts.failure_rate(Star(spark, sf).roles("payments"), "country"))


def q_carrier_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as carriers; the accepted share stands for the failed one, value and quantity for cost and attempts."""
    out = marts.carrier_scorecard(Star(spark, sf).roles("deliveries"))
    return _round_doubles(out.withColumnsRenamed({"failed_pct": "accepted_pct", "mean_cost": "mean_value", "mean_attempts": "mean_quantity"}))


def q_delay_treated(spark: SparkSession, sf: str) -> DataFrame:
    """Per order priority."""
    return _round_doubles(marts.delay_treated(Star(spark, sf).roles("deliveries")).withColumnsRenamed({"area": "o_orderpriority", "deliveries": "lines"}))


def q_delay_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    """Per order priority."""
    return _round_doubles(marts.delay_by_area(Star(spark, sf).roles("deliveries")).withColumnRenamed("area", "o_orderpriority"))


def q_balance_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """Account balance in 30 equal bins between min and max."""
    from curata.operators.marts import equal_width_histogram
    h = equal_width_histogram(Star(spark, sf).t("customer"), "c_acctbal", 30)
    return h.select("bin", F.round("bin_lo", 4).alias("bin_lo"), "n")


def q_size_values(spark: SparkSession, sf: str) -> DataFrame:
    """M23, second view: one bin per value, here of the part's size."""
    return marts.measure_values(Retail({"customers": Star(spark, sf).t("part").select(F.col("p_partkey").alias("customer"), F.lit(None).cast("string").alias("segment"),
                                                                                       F.lit(None).cast("long").alias("tier"), F.col("p_size").alias("measure"))}))


def q_customer_base_views(spark: SparkSession, sf: str) -> DataFrame:
    """M25, further views: customers per tier and nation (as account status), in one pass."""
    s = Star(spark, sf)
    c = bind(s.roles("customers")["customers"].join(s.t("customer").select(F.col("c_custkey").alias("_k"), F.col("c_nationkey").cast("string").alias("nation")), F.col("customer") == F.col("_k")),
             {"customer": "customer", "segment": "segment", "tier": "tier", "account_status": "nation"}, "customers")
    out = marts.value_frequencies(Retail({"customers": c.withColumn("tier", F.col("tier").cast("string"))}), "customers", ["tier", "account_status"])
    return _round_doubles(out)


def customers_u(s: Star) -> DataFrame:
    """One row per customer name, the smallest key kept."""
    return dedup.first(s.t("customer"), "c_name", ["c_custkey"])


def q_customer_base(spark: SparkSession, sf: str) -> DataFrame:
    """Segment frequency and customers per quarter of their first order."""
    from curata.functions.scalars import quarter_label
    s = Star(spark, sf)
    c = customers_u(s)
    seg = reshape.frequency(c, "c_mktsegment", dropna=True, pct=None).select(
        F.lit("segment").alias("dimension"), F.col("c_mktsegment").alias("value"), "n")
    first = s.orders_u().groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    q = (c.join(first, F.col("c_custkey") == F.col("o_custkey"), "inner")
         .groupBy(quarter_label("first_order").alias("value")).agg(F.count(F.lit(1)).cast("long").alias("n"))
         .select(F.lit("first_order_quarter").alias("dimension"), "value", "n"))
    return seg.unionByName(q)


# The caps of the orders-per-customer distribution (full notebook, plain notebook).
ORDER_CAPS = (8, 6)


def q_orders_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Both notebooks' caps from one pass."""
    return marts.capped_orders_per_customer(Star(spark, sf).roles("orders", "customers"), ORDER_CAPS)


def q_segment_activity(spark: SparkSession, sf: str) -> DataFrame:
    """M27."""
    return _round_doubles(marts.activity(Star(spark, sf).roles("orders", "customers"), "segment").withColumnRenamed("segment", "c_mktsegment"))


def q_tier_activity(spark: SparkSession, sf: str) -> DataFrame:
    """M27, second view: tiers are steps of 2,500 of the account balance."""
    return _round_doubles(marts.activity(Star(spark, sf).roles("orders", "customers"), "tier"))


def q_fx_value(spark: SparkSession, sf: str) -> DataFrame:
    """Order value per currency, as billed and through a rate table.

    The rate table is derived from the orders: one rate per currency and day
    of even number (1 plus the day's mean total in millions); other days have
    no rate, so their orders stay unconverted.
    """
    r = Star(spark, sf).roles("orders")
    o = r["orders"].where(F.col("currency").isNotNull()).select("currency", F.to_date("ordered_at").alias("day"), "total")
    rates = o.where(F.dayofmonth("day") % 2 == 0).groupBy("currency", "day").agg((F.lit(1.0) + F.round(F.avg("total"), 0) / 1_000_000).alias("rate"))
    return _round_doubles(marts.fx_value(r, rates), 2)


def q_bias_table(spark: SparkSession, sf: str) -> DataFrame:
    """M28."""
    return _round_doubles(marts.bias_table(Star(spark, sf).roles("orders")))


# --- treatments (T1-T17) -----------------------------------------------------------

LINE_REASONS = ["duplicate", "orphan", "formula"]
ALERT_PCT = 1.0
RFM_AS_OF = "2002-01-01 00:00:00"


def q_dup_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """A1 detail: line keys whose copies disagree on at least one column (rows and distinct versions)."""
    return dedup.conflicting_duplicates(Star(spark, sf).t("lineitem"), LINE_KEY)


def q_orphan_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The orphan lines themselves (left anti join on the active catalogue; a null key is an orphan)."""
    s = Star(spark, sf)
    return integrity.orphans(s.t("lineitem"), "l_partkey", s.active_parts(), "p_partkey")


def q_line_key_collisions(spark: SparkSession, sf: str) -> DataFrame:
    """W6/A7b listing: every row whose key repeats (``duplicated(keep=False)``), here the line key."""
    li = Star(spark, sf).t("lineitem")
    return dedup.flag_repeated(li, LINE_KEY).where(F.col("is_repeated")).drop("is_repeated")


def q_dedup_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The rows dropped by the latest-row dedup of lineitem (the audit table)."""
    _, dropped = dedup.split_latest(Star(spark, sf).t("lineitem"), LINE_KEY, "l_shipdate", nulls="oldest")
    return dropped


def line_quarantine(s: Star) -> DataFrame:
    """Every line tagged curated/quarantine with its reasons."""
    li = dedup.flag_latest(s.t("lineitem"), LINE_KEY, "l_shipdate", nulls="oldest", name="_latest")
    flags = line_facts(s, li).withColumn("is_duplicate", ~F.col("_latest")).drop("_latest", "p_retailprice", "signature")
    return marts.line_quarantine(Retail({"line_flags": flags}))


def q_line_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return line_quarantine(Star(spark, sf))


def q_quarantine_alerts(spark: SparkSession, sf: str) -> DataFrame:
    from curata.operators.treat import reason_rates
    return _round_doubles(reason_rates(line_quarantine(Star(spark, sf)), LINE_REASONS, ALERT_PCT))


def q_order_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Orders tagged with no_lines / total_mismatch; total recomputed from valid lines when lines exist."""
    checks = order_reconciliation(Star(spark, sf)).withColumnsRenamed({"o_orderkey": "order", "subtotal_mismatch": "total_mismatch"})
    out = marts.order_quarantine(Retail({"order_checks": checks}))
    return out.select(F.col("order").alias("o_orderkey"), "zone", "reasons", F.round("recomputed_total", 2).alias("recomputed_total"))


def q_payment_reference(spark: SparkSession, sf: str) -> DataFrame:
    """T7."""
    ref = marts.payment_reference(Star(spark, sf).roles("payments"))
    return ref.select("user_id", "day", F.col("payment").alias("event_id"), F.col("paid_at").alias("ts"), F.round("amount", 2).alias("value"), "attempt_no")


def q_partial_due(spark: SparkSession, sf: str) -> DataFrame:
    """Partial-payment flag and amount still due per order."""
    r = Retail({"payment_facts": payment_facts(Star(spark, sf))}, ("user_id", "day"))
    return _round_doubles(marts.partial_due(r), 2)


def q_overcapture_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """A payment reference is the event's props."""
    s = Star(spark, sf)
    r = s.roles("payments")
    r.frames.update(payment_facts=payment_facts(s), paid_orders=payment_orders(s))
    return marts.overcapture_dedup(r)


def q_product_flags(spark: SparkSession, sf: str) -> DataFrame:
    """T12/T13."""
    s = Star(spark, sf)
    return marts.product_flags(Retail({"products": _products(s, part_costs(s)), **s.roles("lines").frames})).withColumnRenamed("product", "p_partkey")


def q_customer_master(spark: SparkSession, sf: str) -> DataFrame:
    """Master id per part name (smallest part key sharing the name)."""
    return identity.master_id(Star(spark, sf).t("part").select("p_partkey", "p_name"), "p_name", "p_partkey")


def q_surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Deterministic surrogate key of the customer dimension."""
    c = Star(spark, sf).t("customer")
    return c.select("c_custkey", identity.surrogate_key("c_custkey", "c_name").alias("surrogate_key"))


def q_pii_rehash(spark: SparkSession, sf: str, salt: str = "") -> DataFrame:
    """Salted SHA-256 of personal text (the name). The caller passes the salt; the registered query has none, so that SQL can follow it."""
    from curata.functions.scalars import salted_sha256
    c = Star(spark, sf).t("customer")
    return c.select("c_custkey", salted_sha256("c_name", salt).alias("name_hash"))


def q_rfm(spark: SparkSession, sf: str) -> DataFrame:
    """Recency, frequency, monetary per customer and currency, scored 1-5 within the currency."""
    return marts.rfm(Star(spark, sf).roles("orders"), _ts(RFM_AS_OF)).withColumnRenamed("customer", "o_custkey")


def q_rfm_master(spark: SparkSession, sf: str) -> DataFrame:
    """T14 + T17: the same per master customer: customers of one nation and segment with one balance to the hundred are one person."""
    s = Star(spark, sf)
    person = F.concat_ws("|", "c_nationkey", "c_mktsegment", F.floor(F.col("c_acctbal") / 100).cast("string"))
    masters = marts.customer_masters(s.t("customer").select(F.col("c_custkey").alias("customer"), person.alias("person")), "person", "customer")
    return marts.rfm_master(s.roles("orders"), _ts(RFM_AS_OF), masters)


# --- inventory, overview, price drift (S4, PR9, A2p) ----------------------------------

OVERVIEW = [("orders", "orders", "o_orderdate"), ("lineitem", "order lines", "l_shipdate"),
            ("customer", "customers", None), ("part", "products", None), ("events", "payments", "ts"),
            ("supplier", "sellers", None)]


def q_table_inventory(spark: SparkSession, sf: str) -> DataFrame:
    from curata.sources.io import inventory
    s = Star(spark, sf)
    return inventory({t: s.t(t) for t, _, _ in OVERVIEW})


def q_table_overview(spark: SparkSession, sf: str) -> DataFrame:
    s = Star(spark, sf)
    out = None
    for t, role, period in OVERVIEW:
        part = profile.overview(s.t(t), t, role, period)
        out = part if out is None else out.unionByName(part)
    return _round_doubles(out)


def q_price_drift(spark: SparkSession, sf: str) -> DataFrame:
    """A2p."""
    return _round_doubles(marts.price_drift(Star(spark, sf).roles("lines", "catalogue")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dedup_latest": q_dedup_latest,
    "dedup_first": q_dedup_first,
    "dup_summary": q_dup_summary,
    "dup_full_rows": q_dup_full_rows,
    "upsert_merge": q_upsert_merge,
    "profile_columns": q_profile_columns,
    "profile_numeric": q_profile_numeric,
    "profile_categorical": q_profile_categorical,
    "completeness": q_completeness,
    "pk_report": q_pk_report,
    "fk_report": q_fk_report,
    "coverage_report": q_coverage_report,
    "order_reconciliation": q_order_reconciliation,
    "crosstab_margins": q_crosstab_margins,
    "crosstab_row_pct": q_crosstab_row_pct,
    "payment_summary": q_payment_summary,
    "payment_ratio_topk": q_payment_ratio_topk,
    "status_sequences": q_status_sequences,
    "delivery_delays": q_delivery_delays,
    "delay_histogram": q_delay_histogram,
    "delay_box_stats": q_delay_box_stats,
    "value_anomalies": q_value_anomalies,
    "lines_on_bad_products": q_lines_on_bad_products,
    "bad_products_crosstab": q_bad_products_crosstab,
    "duplicate_identity": q_duplicate_identity,
    "identity_profiles": q_identity_profiles,
    "group_sizes": q_group_sizes,
    "document_copies": q_document_copies,
    "validity_checks": q_validity_checks,
    "enum_unexpected": q_enum_unexpected,
    "status_matrix_lines": q_status_matrix_lines,
    "status_matrix_returns": q_status_matrix_returns,
    "coherence_checks": q_coherence_checks,
    "anomaly_register": q_anomaly_register,
    "line_key_collisions": q_line_key_collisions,
    "dup_conflicts": q_dup_conflicts,
    "orphan_lines": q_orphan_lines,
    "weekday_hour_pivot": q_weekday_hour_pivot,
    "reconciliation_summary": q_reconciliation_summary,
    "reconciliation_crosstab": q_reconciliation_crosstab,
    "gap_ratio_summary": q_gap_ratio_summary,
    "problem_report": q_problem_report,
    "orphan_lines_detail": q_orphan_lines_detail,
    "orphan_formula_crosstab": q_orphan_formula_crosstab,
    "orphan_signature": q_orphan_signature,
    "identity_history": q_identity_history,
    "id_prefix_signature": q_id_prefix_signature,
    "identity_components": q_identity_components,
    "attribute_survivors": q_attribute_survivors,
    "size_values": q_size_values,
    "customer_base_views": q_customer_base_views,
    "scorecard": q_scorecard,
    "usable_share": q_usable_share,
    "orders_by_month": q_orders_by_month,
    "value_index": q_value_index,
    "monthly_volume": q_monthly_volume,
    "weekday_hour": q_weekday_hour,
    "weekday_hour_range": q_weekday_hour_range,
    "status_channel_freq": q_status_channel_freq,
    "mix_by_country": q_mix_by_country,
    "headline_shares": q_headline_shares,
    "value_by_currency": q_value_by_currency,
    "value_box_stats": q_value_box_stats,
    "basket": q_basket,
    "basket_frequency": q_basket_frequency,
    "units_by_category": q_units_by_category,
    "category_mix": q_category_mix,
    "seller_concentration": q_seller_concentration,
    "brand_stats": q_brand_stats,
    "payment_mix": q_payment_mix,
    "failure_rate": q_failure_rate,
    "carrier_scorecard": q_carrier_scorecard,
    "delay_by_priority": q_delay_by_priority,
    "balance_histogram": q_balance_histogram,
    "customer_base": q_customer_base,
    "orders_per_customer": q_orders_per_customer,
    "segment_activity": q_segment_activity,
    "bias_table": q_bias_table,
    "dedup_audit": q_dedup_audit,
    "line_quarantine": q_line_quarantine,
    "quarantine_alerts": q_quarantine_alerts,
    "order_quarantine": q_order_quarantine,
    "payment_reference": q_payment_reference,
    "partial_due": q_partial_due,
    "overcapture_dedup": q_overcapture_dedup,
    "product_flags": q_product_flags,
    "customer_master": q_customer_master,
    "surrogate_keys": q_surrogate_keys,
    "pii_rehash": q_pii_rehash,
    "rfm": q_rfm,
    "rfm_master": q_rfm_master,
    "delay_treated": q_delay_treated,
    "payment_status_by_method": q_payment_status_by_method,
    "tier_activity": q_tier_activity,
    "fx_value": q_fx_value,
    "table_inventory": q_table_inventory,
    "table_overview": q_table_overview,
    "price_drift": q_price_drift,
}
