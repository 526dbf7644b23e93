"""Business marts and treatments over column roles (M1-M28, T2-T9, T11-T14, T17, T18): one plan for every table set.

Each function takes a ``Retail`` and returns a frame whose columns are roles;
table sets rename them where their reports use other names. Doubles are not
rounded here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.nulls import differs, null_if_negative, pct_of, safe_ratio, truthy
from curata.functions.scalars import clip_upper, days_between, month_label, quarter_label, weekday_name, weekday_rank
from curata.operators import dedup, identity, integrity, payments, reshape
from curata.operators.joins import join_on_keys
from curata.operators.marts import equal_width_histogram, fx_convert, period_extremes, quantile_scores, top_share
from curata.operators.marts import value_index as indexed
from curata.operators.quantiles import median_of
from curata.operators.treat import tag_reasons
from curata.plans.roles import Retail

_c = F.col


def by_month(r: Retail) -> DataFrame:
    return r["orders"].withColumn("month", month_label("ordered_at"))


def orders_by_month(r: Retail) -> DataFrame:
    """M1: orders per month and country (long form; empty cells are absent)."""
    return reshape.crosstab(by_month(r), "month", "country")


def value_index(r: Retail) -> DataFrame:
    """M2: value of the orders that aren't cancelled per month and currency, index 100 = the first month overall."""
    return indexed(by_month(r).where(differs(_c("status"), F.lit(r.cancelled))), "month", "currency", "total")


def monthly_volume(r: Retail) -> DataFrame:
    """M3: mean orders per month, quietest and busiest month."""
    return period_extremes(by_month(r), "month")


def weekday_hour(r: Retail) -> DataFrame:
    """M4: visits per weekday and hour (Monday first)."""
    v = r["visits"].where(_c("at").isNotNull())
    return v.groupBy(weekday_rank("at").alias("dow_rank"), weekday_name("at").alias("dow"), F.hour("at").alias("hour")).agg(F.count(F.lit(1)).cast("long").alias("n"))


def weekday_hour_range(r: Retail) -> DataFrame:
    """M5: busiest and quietest filled (weekday, hour) slot and the hour range."""
    return weekday_hour(r).agg(F.min("n").alias("min_slot"), F.max("n").alias("max_slot"), F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"))


def mix_by_country(r: Retail, roles: Sequence[str] = ("channel", "status")) -> DataFrame:
    """M7: mix of the given roles per country, % of the country's orders; one pass for all."""
    return reshape.frequencies(r["orders"], list(roles), by=["country"]).select("dimension", "country", "value", "n", "pct")


def headline_shares(r: Retail) -> DataFrame:
    """M8: shares of the named values over all orders."""
    return r["orders"].agg(*[pct_of(_c(role) == value).alias(name) for name, (role, value) in r.shares.items()])


def value_by_currency(r: Retail) -> DataFrame:
    """M9: order value distribution per currency."""
    return reshape.describe(r["orders"].where(_c("currency").isNotNull()), "total", (0.05, 0.25, 0.5, 0.75, 0.95, 0.99), group="currency")


def value_box_stats(r: Retail) -> DataFrame:
    """Box statistics of the order value per currency."""
    return reshape.box_stats(r["orders"].where(_c("currency").isNotNull()), "total", "currency")


def delay_box_stats(r: Retail) -> DataFrame:
    """Box statistics of the delay per area."""
    return reshape.box_stats(r["deliveries"], "delay_days", "area")


def basket_per_order(r: Retail) -> DataFrame:
    return r["lines"].where(_c("order").isNotNull()).groupBy("order").agg(F.count(F.lit(1)).cast("long").alias("n_lines"), F.sum("quantity").alias("units"))


def basket(r: Retail) -> DataFrame:
    """Lines and units per order: count, mean, std, min, p50, p90, p99, max; both in one pass."""
    long = basket_per_order(r).select(*[_c(x).cast("double").alias(x) for x in ("n_lines", "units")]).unpivot([], ["n_lines", "units"], "metric", "value")
    return reshape.describe(long, "value", (0.5, 0.9, 0.99), group="metric")


def basket_frequency(r: Retail) -> DataFrame:
    """How many orders have each line count, how many lines have each quantity."""
    a = reshape.frequency(basket_per_order(r), "n_lines", pct=None).select(F.lit("lines_per_order").alias("metric"), _c("n_lines").cast("double").alias("value"), "n")
    b = reshape.frequency(r["lines"], "quantity", dropna=True, pct=None).select(F.lit("quantity_per_line").alias("metric"), _c("quantity").cast("double").alias("value"), "n")
    return a.unionByName(b)


def valid_lines(r: Retail) -> DataFrame:
    """Lines of catalogue products, with category and buyer country."""
    cat = r["catalogue"].select(_c("product").alias("_p"), "category")
    o = r["orders"].select(_c("order").alias("_o"), "country", "currency")
    li = r["lines"].join(cat, _c("product") == _c("_p"), "inner")
    return li.join(o, _c("order") == _c("_o"), "left").drop("_p", "_o")


def units_by_category(r: Retail) -> DataFrame:
    """Units sold per category (lines of catalogue products)."""
    return valid_lines(r).where(_c("category").isNotNull()).groupBy("category").agg(F.sum("quantity").alias("units"))


def category_mix(r: Retail) -> DataFrame:
    """Category mix per country, % of the country's units."""
    return reshape.row_share(reshape.crosstab(valid_lines(r), "country", "category", value="quantity", agg="sum", name="units"), "country", value="units")


def seller_concentration(r: Retail) -> DataFrame:
    """Share of lines held by the top 10 % of sellers."""
    return top_share(r["lines"], "seller", 0.1)


def brand_stats(r: Retail) -> DataFrame:
    """Distinct brands, missing-brand share, never-ordered products (anti join)."""
    p = integrity.flag_orphans(r["products"], "product", r["lines"], "product", name="never")
    return p.agg(F.countDistinct("brand").cast("long").alias("brands"), pct_of(_c("brand").isNull()).alias("missing_brand_pct"),
                 F.count_if("never").cast("long").alias("never_ordered"), pct_of(_c("never")).alias("never_ordered_pct"))


def payments_geo(r: Retail) -> DataFrame:
    """Payments with their buyer's or order's country."""
    geo = r["orders"] if "country" not in r["payments"].columns else None
    if geo is None:
        return r["payments"]
    o = geo.select(_c("order").alias("_o"), "country")
    return join_on_keys(r["payments"], o, [("order", "_o")], "left").drop("_o")


def payment_mix(r: Retail, of: str = "method") -> DataFrame:
    """Mix of payment methods (or another role) per country, % of the country's payments."""
    return reshape.row_share(reshape.crosstab(payments_geo(r), "country", of), "country")


def payment_status_by_method(r: Retail) -> DataFrame:
    """Payment status per method, % of the method's payments."""
    return reshape.row_share(reshape.crosstab(r["payments"], "method", "status"), "method")


def failure_rate(r: Retail, by: str = "provider") -> DataFrame:
    """Failed and captured share per provider (or country); payments without one are left out."""
    p = (payments_geo(r) if by == "country" else r["payments"]).where(_c(by).isNotNull())
    return p.groupBy(by).agg(pct_of(_c("status") == r.failed).alias("failed_pct"), pct_of(_c("status") == r.captured).alias("captured_pct"))


def carrier_scorecard(r: Retail) -> DataFrame:
    """Per carrier: deliveries, failed %, returned %, mean cost, mean attempts, median delay, late %."""
    x = _c("delay_days")
    extra = {"deliveries": F.count(F.lit(1)).cast("long"), "returned_pct": pct_of(_c("status") == r.delivery_returned),
             "failed_pct": pct_of(_c("status") == r.delivery_failed), "mean_cost": F.avg("cost"), "mean_attempts": F.avg("attempts"),
             "late_pct": F.when(F.count(x) > 0, F.lit(100.0) * F.count_if(x >= r.late_days) / F.count(x))}
    return median_of(r["deliveries"], "delay_days", "carrier", "median_delay", extra=extra, inputs=["status", "cost", "attempts"])


def delay_by_area(r: Retail) -> DataFrame:
    """Delay summary per area."""
    return reshape.describe(r["deliveries"], "delay_days", (0.5, 0.95), group="area")


def delay_histogram(r: Retail) -> DataFrame:
    """Delays in days, edges 0 to 23 and -2 to 21."""
    return reshape.histograms(r["deliveries"], "delay_days", {"days_0_23": (0, 23), "days_m2_21": (-2, 21)})


def measure_histogram(r: Retail, bins: int = 30) -> DataFrame:
    """The customers' measure (age, balance) in equal bins between its smallest and largest value."""
    return equal_width_histogram(r["customers"], "measure", bins)


def measure_values(r: Retail) -> DataFrame:
    """M23, second view: one bin per value."""
    return r["customers"].where(_c("measure").isNotNull()).groupBy("measure").agg(F.count(F.lit(1)).cast("long").alias("n"))


def value_frequencies(r: Retail, frame: str, roles: Sequence[str]) -> DataFrame:
    """Frequencies and shares of roles of one frame in one pass."""
    return reshape.frequencies(r[frame], list(roles))


def registrations(r: Retail) -> DataFrame:
    """Customers per quarter of registration."""
    c = r["customers"].where(_c("registered_at").isNotNull())
    return c.groupBy(quarter_label("registered_at").alias("quarter")).agg(F.count(F.lit(1)).cast("long").alias("n"))


def orders_per_customer(r: Retail) -> DataFrame:
    n = r["orders"].groupBy(_c("customer").alias("_b")).agg(F.count(F.lit(1)).cast("long").alias("_n"))
    j = r["customers"].join(n, _c("customer") == _c("_b"), "left")
    return j.select("customer", "segment", "tier", F.coalesce("_n", F.lit(0)).cast("long").alias("n_orders"))


def capped_orders_per_customer(r: Retail, caps: Sequence[int] = (8, 6)) -> DataFrame:
    """Customers by number of orders, capped (cap = c or more); 0 = never ordered. All caps from one pass."""
    capped = F.array(*[F.struct(F.lit(x).alias("cap"), clip_upper("n_orders", x).cast("long").alias("n_orders")) for x in caps])
    return orders_per_customer(r).select(F.inline(capped)).groupBy("cap", "n_orders").agg(F.count(F.lit(1)).cast("long").alias("customers"))


def activity(r: Retail, by: str = "segment") -> DataFrame:
    """Orders per customer by segment or tier: count, median, mean, max."""
    extra = {"customers": F.count(F.lit(1)).cast("long"), "mean": F.avg("n_orders"), "max": F.max("n_orders")}
    return median_of(orders_per_customer(r), "n_orders", by, "median", extra=extra, inputs=[])


def bias_table(r: Retail) -> DataFrame:
    """Per country: share of orders, shares of the named values, median value, currency."""
    extra = {"n_orders": F.count(F.lit(1)), **{name: pct_of(_c(role) == value) for name, (role, value) in r.bias.items()}, "currency": F.min("currency")}
    roles = list(dict.fromkeys(role for role, _ in r.bias.values()))
    g = median_of(r["orders"], "total", "country", "median_value", extra=extra, inputs=[*roles, "currency"])
    return reshape.grand_share(g, "n_orders", "orders_pct").drop("n_orders")


def line_quarantine(r: Retail) -> DataFrame:
    """Every line tagged curated or quarantine with its reasons."""
    t = tag_reasons(r["line_flags"], {"duplicate": _c("is_duplicate"), "orphan": _c("is_orphan"), "formula": _c("formula_mismatch")})
    return t.drop("is_duplicate", "is_orphan", "formula_mismatch")


def order_quarantine(r: Retail) -> DataFrame:
    """Orders tagged no_lines, total_mismatch; total recomputed from valid lines when lines exist."""
    reasons = {"no_lines": _c("no_lines"), "total_mismatch": _c("total_mismatch")}
    if "total_formula" in r["order_checks"].columns:
        reasons["total_formula"] = _c("total_formula")
    t = tag_reasons(r["order_checks"], reasons)
    return t.select("order", "zone", "reasons", F.when(_c("n_lines") > 0, F.coalesce("sum_valid_lines", F.lit(0.0))).alias("recomputed_total"))


def payment_reference(r: Retail) -> DataFrame:
    """One reference payment per order (the last captured), with its attempt number; only the columns it needs are numbered."""
    p = r["payments"].select(*r.pay_key, "payment", "paid_at", "status", "amount")
    ref, _ = payments.reference_payment(p, list(r.pay_key), "status", "paid_at", "payment", captured=r.captured)
    return ref.select(*r.pay_key, "payment", "paid_at", "amount", _c("attempt_no").cast("int").alias("attempt_no"))


def partial_due(r: Retail) -> DataFrame:
    """Partial-payment flag and amount still due per order."""
    due = payments.partial_due(r["payment_facts"], "total")
    return due.select(*r.pay_key, "total", "captured_amount", "is_partial_payment", "amount_due")


def overcapture_dedup(r: Retail) -> DataFrame:
    """Over-captures before and after removing repeated captures of one payment reference."""
    once = dedup.first(r["payments"].select(*r.pay_key, "payment", "paid_at", "status", "amount", "reference"), [*r.pay_key, "status", "reference"], ["paid_at", "payment"])
    after = payments.payment_check(r["paid_orders"], once, list(r.pay_key), "total", "status", "amount", captured=r.captured, failed=r.failed)
    count = lambda df, when: df.agg(F.count_if("is_overcapture").cast("long").alias(f"overcapture_{when}"), F.count_if("is_multi_capture").cast("long").alias(f"multi_capture_{when}"))
    both = count(r["payment_facts"], "before").unionByName(count(after, "after"), allowMissingColumns=True)
    return both.agg(*[F.max(x).alias(x) for x in ("overcapture_before", "multi_capture_before", "overcapture_after", "multi_capture_after")])


def delay_treated(r: Retail) -> DataFrame:
    """Per area, delays that precede the order set to null: deliveries, nulled ones, and the mean of the rest."""
    d = r["deliveries"].where(_c("area").isNotNull()).withColumn("clean", null_if_negative("delay_days"))
    return d.groupBy("area").agg(F.count(F.lit(1)).cast("long").alias("deliveries"),
                                 F.count_if(_c("delay_days").isNotNull() & _c("clean").isNull()).cast("long").alias("nulled"), F.avg("clean").alias("mean_delay"))


def product_flags(r: Retail) -> DataFrame:
    """Per product: zero price (quarantine), negative margin (flag), really sold."""
    sold = integrity.flag_orphans(r["products"], "product", r["lines"], "product", name="unsold")
    zero = truthy(_c("price") == 0)
    negative = truthy(_c("cost") > _c("price")) & ~zero
    return sold.select("product", zero.alias("zero_price"), negative.alias("negative_margin"), (~_c("unsold")).alias("is_sold"),
                       F.when(zero, "quarantine").when(negative, "flagged").otherwise("curated").alias("zone"))


def rfm(r: Retail, as_of: Column, who: str = "customer", orders: DataFrame | None = None) -> DataFrame:
    """Recency, frequency, monetary per customer (or master customer) and currency, scored 1-5 within the currency."""
    o = (r["orders"] if orders is None else orders).where(_c(who).isNotNull() & _c("currency").isNotNull())
    base = o.groupBy(who, "currency").agg(
        F.round(days_between(as_of, F.max("ordered_at")), 4).alias("recency_days"), F.count(F.lit(1)).cast("long").alias("frequency"), F.round(F.sum("total"), 2).alias("monetary"))
    return quantile_scores(base, "currency", {"recency_days": False, "frequency": True, "monetary": True})


def rfm_master(r: Retail, as_of: Column, masters: DataFrame) -> DataFrame:
    """The same per master customer; ``masters`` has (customer, master_id)."""
    m = masters.select(_c("customer").alias("_k"), "master_id")
    return rfm(r, as_of, "master_id", r["orders"].join(m, _c("customer") == _c("_k")).drop("_k"))


def customer_masters(customers: DataFrame, identity_column: str, member: str) -> DataFrame:
    """The master of every customer: the smallest id that shares the identity."""
    return identity.master_id(customers.select(member, identity_column), identity_column, member)


def fx_value(r: Retail, rates: DataFrame) -> DataFrame:
    """Order value per currency, as billed and through a rate table ``(currency, day, rate)``."""
    o = r["orders"].where(_c("currency").isNotNull()).select("currency", F.to_date("ordered_at").alias("day"), "total")
    conv = fx_convert(o, rates, "total", "currency", "day")
    return conv.groupBy("currency").agg(F.count(F.lit(1)).cast("long").alias("orders"), F.count("amount_converted").cast("long").alias("converted"),
                                        F.sum("total").alias("value"), F.sum("amount_converted").alias("value_converted"))


def price_drift(r: Retail) -> DataFrame:
    """A2p: the lines' unit price against the catalogue's, on lines of catalogue products; lines whose SKU isn't the catalogue's, if both have one."""
    cat = r["catalogue"].select(_c("product").alias("_p"), _c("price").alias("_price"), *([_c("sku").alias("_sku")] if "sku" in r["catalogue"].columns else []))
    li = r["lines"].join(cat, _c("product") == _c("_p"), "inner").withColumn("_ratio", _c("unit_price") / F.nullif(_c("_price"), F.lit(0.0)))
    extra = {"lines": F.count(F.lit(1)).cast("long"), "min_ratio": F.min("_ratio"), "max_ratio": F.max("_ratio"),
             "exact_price_lines": F.count_if(truthy(F.abs(_c("unit_price") - _c("_price")) <= 0.01)).cast("long")}
    inputs = ["unit_price", "_price"]
    if "sku" in li.columns and "_sku" in li.columns:
        extra["other_sku_lines"] = F.count_if(differs("sku", "_sku")).cast("long")
        inputs += ["sku", "_sku"]
    return median_of(li, "_ratio", None, "median_ratio", extra=extra, inputs=inputs)


def unit_price(amount: str, quantity: str) -> Column:
    return safe_ratio(amount, quantity)
