"""The checks on a shop's own six tables: orders, order_lines, customers, products, payments, deliveries.

Names, keys and domains are data (``TABLES``, ``KEYS``, ``DOMAINS``); the
rules are ``Rule`` objects that run in one aggregate per frame. ``load`` reads
the tables from CSV or Parquet, ``register`` counts the fifteen anomalies,
``validity`` runs the fifty checks, ``roles`` binds the tables for the plans of
``marts``, and ``run_shop`` makes one run: landing with rejected records,
reports, marts, quarantine with release, surrogate keys, snapshots and alerts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curata.functions.nulls import any_of, blank, differs, not_full_match, outside, truthy
from curata.functions.scalars import days_between
from curata.operators import dedup, identity, integrity, payments, profile, reshape
from curata.operators.components import identity_components
from curata.operators.joins import join_on_keys
from curata.operators.rules import domain_rules, rows_of_ambiguous_groups, run_rules
from curata.operators.survivorship import survivors
from curata.operators.treat import reason_rates
from curata.plans import marts
from curata.plans.roles import Retail, bind
from curata.sources import keys, quarantine, snapshots
from curata.sources.io import inventory, land_csv, load_tables, zone_path
from curata.specs import ForeignKey, Rule, TableSpec

TOL = 0.05
LATE_DAYS = 7


def _table(name: str, key: str, columns: str, *timestamps: str) -> TableSpec:
    schema = StructType()
    for column in columns.split(", "):
        field, kind = column.split(" ")
        schema.add(field, "integer" if kind == "int" else kind)
    return TableSpec(name, (key,), timestamps, schema)


#: Tables, keys and columns.
TABLES = [
    _table("orders", "order_id", "order_id string, customer_id string, order_date timestamp, created_at timestamp, updated_at timestamp, order_status string, "
           "channel string, country_code string, delivery_address_zone string, currency string, subtotal_amount double, shipping_amount double, "
           "discount_amount double, total_amount double, promo_code string", "order_date", "created_at", "updated_at"),
    _table("order_lines", "order_line_id", "order_line_id string, order_id string, product_id string, product_sku string, quantity int, unit_price double, "
           "line_discount double, line_total double, seller_id string"),
    _table("customers", "customer_id", "customer_id string, email_hash string, phone_hash string, first_name string, last_name string, city string, "
           "birth_year int, registration_date timestamp, country_code string, gender string, customer_segment string, loyalty_tier string, account_status string",
           "registration_date"),
    _table("products", "product_id", "product_id string, sku string, unit_price double, unit_cost double, category_name string, subcategory_name string, "
           "brand string, is_perishable boolean, product_status string, weight_grams int, created_at timestamp, updated_at timestamp", "created_at", "updated_at"),
    _table("payments", "payment_id", "payment_id string, order_id string, payment_date timestamp, payment_amount double, payment_status string, "
           "payment_method string, payment_provider string, currency string, transaction_reference string", "payment_date"),
    _table("deliveries", "delivery_id", "delivery_id string, order_id string, shipped_at timestamp, delivered_at timestamp, delivery_status string, "
           "carrier string, delivery_cost double, delivery_attempts int", "shipped_at", "delivered_at"),
]
FOREIGN_KEYS = [
    ForeignKey("order_lines", ("order_id",), "orders", ("order_id",)),
    ForeignKey("order_lines", ("product_id",), "products", ("product_id",)),
    ForeignKey("orders", ("customer_id",), "customers", ("customer_id",)),
    ForeignKey("payments", ("order_id",), "orders", ("order_id",)),
    ForeignKey("deliveries", ("order_id",), "orders", ("order_id",)),
]
#: Allowed domains.
DOMAINS = {
    "orders": {
        "order_status": ["PENDING", "CONFIRMED", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED"],
        "channel": ["WEB", "MOBILE_APP", "WHATSAPP_BOT", "CALL_CENTER", "AGENT_BIZ"],
        "country_code": ["SEN", "GHA", "NGA", "CIV"],
        "delivery_address_zone": ["URBAN", "PERI_URBAN", "RURAL"],
        "currency": ["XOF", "GHS", "NGN"]},
    "customers": {
        "gender": ["M", "F", "OTHER", "NOT_DECLARED"],
        "customer_segment": ["VIP", "REGULAR", "NEW", "DORMANT"],
        "loyalty_tier": ["BRONZE", "SILVER", "GOLD", "PLATINUM"],
        "account_status": ["ACTIVE", "SUSPENDED", "CLOSED"],
        "country_code": ["SEN", "GHA", "NGA", "CIV"]},
    "products": {
        "product_status": ["ACTIVE", "OUT_OF_STOCK", "DISCONTINUED"],
        "category_name": ["Mode", "Électronique", "Maison", "Beauté", "Alimentation", "Bébé & Enfant", "Sport", "Téléphonie"]},
    "payments": {
        "payment_method": ["OM_MOBILE_MONEY", "WAVE", "MTN_MOMO", "CARD", "COD", "BANK_TRANSFER"],
        "payment_status": ["PENDING", "AUTHORIZED", "CAPTURED", "FAILED", "REFUNDED"],
        "currency": ["XOF", "GHS", "NGN"]},
    "deliveries": {
        "delivery_status": ["PREPARING", "IN_TRANSIT", "OUT_FOR_DELIVERY", "DELIVERED", "FAILED", "RETURNED_TO_WAREHOUSE"]},
}
CURRENCY_OF = {"SEN": "XOF", "CIV": "XOF", "GHA": "GHS", "NGA": "NGN"}
ORDER_WINDOW = ("2025-05-01 00:00:00", "2026-04-30 23:59:59")
FIRST_BIRTH_YEAR = 1930
ADULT = 18
HASH_LENGTH = 64
PROFILE = ["phone_hash", "first_name", "last_name", "birth_year", "registration_date", "country_code", "city"]

_c = F.col


@dataclass
class Shop:
    """The six tables, and the frames that several reports share."""

    t: dict[str, DataFrame]

    def orders_u(self) -> DataFrame:
        """The latest row of every order (a null time is the newest)."""
        return dedup.latest(self.t["orders"], "order_id", "updated_at", nulls="newest")

    def lines(self, known_products: DataFrame | None = None) -> DataFrame:
        """Order lines with ``is_orphan`` (no such product) and ``formula_mismatch`` (total is not quantity x price - discount).

        ``known_products`` adds product ids, in column ``key``, that earlier runs have seen.
        """
        products = self.t["products"].select("product_id")
        if known_products is not None:
            products = products.unionByName(known_products.select(_c("key").alias("product_id")))
        flagged = integrity.flag_orphans(self.t["order_lines"], "product_id", products, "product_id")
        gap = _c("quantity") * _c("unit_price") - _c("line_discount") - _c("line_total")
        return flagged.withColumn("formula_mismatch", truthy(F.abs(gap) > TOL))

    def order_checks(self) -> DataFrame:
        """Latest orders with the sums of their lines and the flags of the total's parts (A3)."""
        facts = self.lines().groupBy(_c("order_id").alias("_order")).agg(
            F.count("order_line_id").alias("n_lines"), F.sum("line_total").alias("sum_lines"),
            F.sum(F.when(~_c("is_orphan"), _c("line_total"))).alias("sum_valid_lines"))
        j = join_on_keys(self.orders_u(), facts, [("order_id", "_order")], "left")
        has = _c("n_lines").isNotNull()
        parts = _c("subtotal_amount") + _c("shipping_amount") - _c("discount_amount")
        return j.select(
            "order_id", "n_lines", "sum_valid_lines", truthy(F.abs(_c("total_amount") - parts) > TOL).alias("total_mismatch"), (~has).alias("no_lines"),
            (has & truthy(F.abs(_c("subtotal_amount") - _c("sum_lines")) > TOL)).alias("subtotal_mismatch"),
            (has & truthy(F.abs(_c("subtotal_amount") - F.coalesce("sum_valid_lines", F.lit(0.0))) > TOL)).alias("subtotal_valid_mismatch"))

    def payment_checks(self) -> DataFrame:
        return payments.payment_check(self.orders_u(), self.t["payments"], ["order_id"], "total_amount", "payment_status", "payment_amount")

    def deliveries(self) -> DataFrame:
        """Deliveries with their order's date and the days from order to delivery and in transit."""
        o = self.orders_u().select(_c("order_id").alias("_order"), "order_date", "order_status", "delivery_address_zone")
        j = join_on_keys(self.t["deliveries"], o, [("order_id", "_order")], "left").drop("_order")
        return j.withColumn("days_to_delivery", days_between("delivered_at", "order_date")).withColumn(
            "days_in_transit", days_between("delivered_at", "shipped_at"))

    def statuses(self) -> DataFrame:
        """Latest orders with their last payment's status and one row per delivery; null where there is none."""
        last = dedup.latest(self.t["payments"].where(_c("order_id").isNotNull()), "order_id", "payment_date", nulls="newest").select(
            _c("order_id").alias("_paid"), "payment_status")
        d = self.t["deliveries"].where(_c("order_id").isNotNull()).select(
            _c("order_id").alias("_sent"), F.coalesce("delivery_status", F.lit("")).alias("delivery_status"))
        o = join_on_keys(self.orders_u().select("order_id", "order_status"), last, [("order_id", "_paid")], "left")
        return o.join(d, _c("order_id") == _c("_sent"), "left").drop("_paid", "_sent")


def load(spark: SparkSession, folder: str, fmt: str = "csv") -> Shop:
    return Shop(load_tables(spark, folder, [t.name for t in TABLES], fmt, {t.name: t.schema for t in TABLES}))


def key_reports(shop: Shop) -> dict[str, DataFrame]:
    keys = [(shop.t[k.child], k.fk, shop.t[k.parent], k.pk, k.name) for k in FOREIGN_KEYS]
    return {"primary_keys": integrity.pk_report({t.name: (shop.t[t.name], t.key) for t in TABLES}),
            "foreign_keys": integrity.fk_report(keys),
            "coverage": integrity.coverage_report([(parent, pk, child, fk, name) for child, fk, parent, pk, name in keys])}


def rules(shop: Shop, current_year: int) -> list[tuple[DataFrame, list[Rule]]]:
    """Every check that is a predicate on the rows of one frame."""
    rule = lambda table, name, bad, note="": Rule(name, table, bad, note=note)
    money = ["subtotal_amount", "shipping_amount", "discount_amount", "total_amount"]
    country = F.create_map(*[F.lit(x) for kv in CURRENCY_OF.items() for x in kv])
    gross = _c("quantity") * _c("unit_price")
    o = shop.orders_u().select(_c("order_id").alias("_order"), _c("currency").alias("order_currency"))
    paid = join_on_keys(shop.t["payments"], o, [("order_id", "_order")], "left")
    first = shop.orders_u().where(_c("customer_id").isNotNull()).groupBy(_c("customer_id").alias("_buyer")).agg(F.min("order_date").alias("first_order"))
    joined = dedup.first(shop.t["customers"].where(_c("customer_id").isNotNull()), "customer_id", ["registration_date"]).select("customer_id", "registration_date")
    return [
        (shop.t["orders"], domain_rules("orders", DOMAINS["orders"]) + [
            rule("orders", "a negative amount", any_of(money, lambda x: x < 0)),
            rule("orders", "total_amount <= 0", truthy(_c("total_amount") <= 0)),
            rule("orders", "discount above the subtotal", truthy(_c("discount_amount") > _c("subtotal_amount"))),
            rule("orders", "discount without a promo code", truthy(_c("discount_amount") > 0) & _c("promo_code").isNull(), "may be a discount given by hand"),
            rule("orders", "promo code without a discount", _c("promo_code").isNotNull() & truthy(_c("discount_amount") == 0)),
            rule("orders", "updated before created", truthy(_c("updated_at") < _c("created_at"))),
            rule("orders", "created at another time than ordered", differs("created_at", "order_date"), "informational"),
            rule("orders", "ordered outside the announced window", outside("order_date", *[F.lit(x).cast("timestamp") for x in ORDER_WINDOW])),
            rule("orders", "currency is not the country's", differs(_c("currency"), country[_c("country_code")])),
        ]),
        (shop.t["order_lines"], [
            rule("order_lines", "quantity <= 0", truthy(_c("quantity") <= 0)),
            rule("order_lines", "unit_price <= 0", truthy(_c("unit_price") <= 0)),
            rule("order_lines", "discount negative or above the gross amount", truthy(_c("line_discount") < 0) | truthy(_c("line_discount") > gross + TOL)),
        ]),
        (shop.t["customers"], domain_rules("customers", DOMAINS["customers"]) + [
            rule("customers", "younger than 18 at registration", truthy(F.year("registration_date") - _c("birth_year") < ADULT)),
            rule("customers", "birth year out of range", outside("birth_year", FIRST_BIRTH_YEAR, current_year)),
            rule("customers", "email_hash is not 64 long", differs(F.length("email_hash"), F.lit(HASH_LENGTH)), "hash again with a salt"),
            rule("customers", "phone_hash is not 64 long", differs(F.length("phone_hash"), F.lit(HASH_LENGTH))),
            rule("customers", "email_hash is not hexadecimal", not_full_match("email_hash", "[0-9a-f]+")),
            rule("customers", "a name is missing or blank", blank("first_name") | blank("last_name")),
        ]),
        (join_on_keys(first, joined, [("_buyer", "customer_id")], "left"), [
            rule("customers", "ordered before registration", truthy(_c("first_order") < _c("registration_date")), "of customers with orders")]),
        (shop.t["products"], domain_rules("products", DOMAINS["products"]) + [
            rule("products", "weight_grams <= 0", truthy(_c("weight_grams") <= 0)),
            rule("products", "updated before created", truthy(_c("updated_at") < _c("created_at"))),
        ]),
        (paid, domain_rules("payments", DOMAINS["payments"]) + [
            rule("payments", "payment_amount <= 0", truthy(_c("payment_amount") <= 0)),
            rule("payments", "currency is not the order's", differs("currency", "order_currency")),
            rule("payments", "cash on delivery through an outside provider", truthy(_c("payment_method") == "COD") & differs(_c("payment_provider"), F.lit("Internal"))),
        ]),
        (shop.deliveries(), domain_rules("deliveries", DOMAINS["deliveries"]) + [
            rule("deliveries", "delivery_cost < 0", truthy(_c("delivery_cost") < 0)),
            rule("deliveries", "attempts outside 1 to 5", outside("delivery_attempts", 1, 5)),
            rule("deliveries", "shipped before ordered", truthy(_c("shipped_at") < _c("order_date"))),
            rule("deliveries", "delivered before shipped", truthy(_c("delivered_at") < _c("shipped_at"))),
            rule("deliveries", "DELIVERED without a time", truthy(_c("delivery_status") == "DELIVERED") & _c("delivered_at").isNull()),
            rule("deliveries", "delivery time with another status", differs(_c("delivery_status"), F.lit("DELIVERED")) & _c("delivered_at").isNotNull()),
        ]),
        (shop.statuses(), [
            rule("orders x payments", "CANCELLED, last payment CAPTURED", truthy((_c("order_status") == "CANCELLED") & (_c("payment_status") == "CAPTURED"))),
            rule("orders x deliveries", "DELIVERED without a delivery", truthy(_c("order_status") == "DELIVERED") & _c("delivery_status").isNull()),
            rule("orders x deliveries", "CANCELLED with a delivery", truthy(_c("order_status") == "CANCELLED") & _c("delivery_status").isNotNull()),
        ]),
    ]


def validity(shop: Shop, current_year: int) -> DataFrame:
    """check, table, violations, population, violations_pct, note: one row for each of the fifty checks."""
    out = None
    for frame, checks in rules(shop, current_year):
        part = run_rules(frame, checks)
        out = part if out is None else out.unionByName(part)
    many = rows_of_ambiguous_groups(shop.t["payments"], "payment_method", "payment_provider")
    return out.unionByName(many.select(
        F.lit("method with several providers").alias("check"), F.lit("payments").alias("table"), "violations", "population",
        F.when(_c("population") > 0, F.round(F.lit(100.0) * _c("violations") / _c("population"), 3)).alias("violations_pct"), F.lit("").alias("note")))


#: Code, table and severity of the register's rows (fixed values).
REGISTER = [("A1", "orders", "High"), ("A2", "order_lines", "High"), ("A2b", "order_lines", "High"), ("A3", "orders", "High"), ("A3b", "orders", "High"),
            ("A3c", "orders", "Medium"), ("A4a", "payments", "Medium"), ("A4b", "payments", "Medium"), ("A4c", "payments", "High"), ("A5", "deliveries", "Info"),
            ("A5b", "deliveries", "Medium"), ("A6a", "products", "Medium"), ("A6b", "products", "Medium"), ("A7a", "customers", "High"), ("A7b", "customers", "High")]


def register(shop: Shop) -> DataFrame:
    """code, table, severity, observed, base, observed_pct of the fifteen anomalies; one aggregate per frame."""
    rows = F.count(F.lit(1))
    zero = truthy(_c("unit_price") == 0)

    def counted(df: DataFrame, **codes) -> DataFrame:
        wide = df.agg(*[x.cast("long").alias(f"{c}_{k}") for c, pair in codes.items() for k, x in zip("ob", pair)])
        return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("code"), _c(f"{c}_o").alias("observed"), _c(f"{c}_b").alias("base")) for c in codes])))

    surplus = lambda df, code: df.select(F.lit(code).alias("code"), _c("surplus_rows").alias("observed"), _c("rows").alias("base"))
    cap, late, transit = F.count_if("has_capture"), _c("days_to_delivery"), _c("days_in_transit")
    parts = [
        surplus(dedup.duplicate_summary(shop.t["orders"], "order_id"), "A1"),
        counted(shop.lines(), A2=(F.count_if("is_orphan"), rows), A2b=(F.count_if("formula_mismatch"), rows)),
        counted(shop.order_checks(), A3=(F.count_if("total_mismatch"), rows), A3b=(F.count_if("no_lines"), rows), A3c=(F.count_if("subtotal_mismatch"), rows)),
        counted(shop.payment_checks(), A4a=(F.count_if("is_retry"), cap), A4b=(F.count_if("is_partial"), cap), A4c=(F.count_if("is_overcapture"), cap)),
        counted(shop.deliveries(), A5=(F.count_if(late >= LATE_DAYS), F.count(late)), A5b=(F.count_if(transit < 0), F.count(late))),
        counted(shop.t["products"], A6a=(F.count_if(zero), rows), A6b=(F.count_if(truthy(_c("unit_cost") > _c("unit_price")) & ~zero), rows)),
        surplus(identity.duplicate_identity_summary(shop.t["customers"], "email_hash", "customer_id", PROFILE), "A7a"),
        surplus(dedup.duplicate_summary(shop.t["customers"], "customer_id"), "A7b"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    lookup = lambda i: F.create_map(*[F.lit(x) for r in REGISTER for x in (r[0], r[i])])[_c("code")]
    return out.select("code", lookup(1).alias("table"), lookup(2).alias("severity"), "observed", "base",
                      F.when(_c("base") > 0, F.round(F.lit(100.0) * _c("observed") / _c("base"), 2)).alias("observed_pct"))


def status_matrices(shop: Shop) -> dict[str, DataFrame]:
    s = shop.statuses().fillna("(none)", subset=["payment_status", "delivery_status"])
    return {f"status_by_{c}": reshape.row_share(reshape.crosstab(s, "order_status", c), "order_status") for c in ("payment_status", "delivery_status")}


#: Which column of the six tables plays which role.
SHOP_ROLES = {
    "orders": {"order": "order_id", "customer": "customer_id", "ordered_at": "order_date", "status": "order_status", "channel": "channel",
               "zone": "delivery_address_zone", "country": "country_code", "currency": "currency", "total": "total_amount"},
    "lines": {"order": "order_id", "product": "product_id", "seller": "seller_id", "quantity": "quantity", "unit_price": "unit_price", "sku": "product_sku"},
    "catalogue": {"product": "product_id", "category": "category_name", "price": "unit_price", "sku": "sku"},
    "products": {"product": "product_id", "brand": "brand", "price": "unit_price", "cost": "unit_cost"},
    "customers": {"customer": "customer_id", "segment": "customer_segment", "tier": "loyalty_tier", "account_status": "account_status", "registered_at": "registration_date",
                  "birth_year": "birth_year"},
    "payments": {"order": "order_id", "payment": "payment_id", "paid_at": "payment_date", "status": "payment_status", "amount": "payment_amount",
                 "method": "payment_method", "provider": "payment_provider", "reference": "transaction_reference"},
}
DELIVERY_ROLES = {"order": "order_id", "carrier": "carrier", "status": "delivery_status", "cost": "delivery_cost", "attempts": "delivery_attempts",
                  "delay_days": "days_to_delivery", "transit_days": "days_in_transit", "area": "delivery_address_zone"}
#: Headline shares and the shares of the bias table, by order role and value.
SHARES = {"delivered_pct": ("status", "DELIVERED"), "cancelled_pct": ("status", "CANCELLED"), "returned_pct": ("status", "RETURNED"), "app_pct": ("channel", "MOBILE_APP"),
          "web_pct": ("channel", "WEB"), "urban_pct": ("zone", "URBAN"), "rural_pct": ("zone", "RURAL")}
BIAS = {"urban_pct": ("zone", "URBAN"), "rural_pct": ("zone", "RURAL"), "app_pct": ("channel", "MOBILE_APP")}
#: Rows announced per table.
EXPECTED_ROWS = {"orders": 52_000, "order_lines": 107_517, "customers": 81_200, "products": 12_000, "payments": 46_141, "deliveries": 41_218}
ALERT_PCT = 1.0
#: The sources that may give an attribute, the most trusted first (T19): the CRM's record, then what orders say.
ATTRIBUTE_SOURCES = {"country": ("crm", "orders"), "zone": ("orders",), "currency": ("orders",), "segment": ("crm",), "tier": ("crm",)}


def roles(shop: Shop, current_year: int, known_products: DataFrame | None = None) -> Retail:
    """The six tables bound to the roles of the plans; the customers' measure is their age."""
    spec = {t.name: t for t in TABLES}
    table = {"orders": "orders", "lines": "order_lines", "catalogue": "products", "products": "products", "customers": "customers", "payments": "payments"}
    source = {**{frame: shop.t[name] for frame, name in table.items()}, "orders": shop.orders_u(), "customers": dedup.first(shop.t["customers"], "email_hash", ["customer_id"])}
    frames = {frame: bind(source[frame], SHOP_ROLES[frame], frame, spec[name]) for frame, name in table.items()}
    frames["customers"] = frames["customers"].withColumn("measure", F.lit(current_year) - _c("birth_year"))
    frames["visits"] = frames["orders"].select(_c("ordered_at").alias("at"))
    frames["deliveries"] = bind(shop.deliveries(), DELIVERY_ROLES, "deliveries")
    frames["paid_orders"] = frames["orders"].select("order", "total")
    facts = shop.payment_checks()
    frames["payment_facts"] = facts.withColumnsRenamed({"order_id": "order", "total_amount": "total"})
    frames["order_checks"] = shop.order_checks().withColumnsRenamed({"order_id": "order", "total_mismatch": "total_formula"}).withColumnRenamed("subtotal_mismatch", "total_mismatch")
    frames["line_flags"] = dedup.flag_surplus(shop.lines(known_products), "order_line_id", name="is_duplicate")
    return Retail(frames, shares=SHARES, bias=BIAS, late_days=LATE_DAYS)


def masters(shop: Shop) -> DataFrame:
    """(customer, master_id): customers who share an e-mail or a phone hash, directly or through others, are one person."""
    return identity_components(shop.t["customers"], "customer_id", ["email_hash", "phone_hash"]).withColumnRenamed("customer_id", "customer")


def customer_attributes(shop: Shop) -> DataFrame:
    """Per customer, every attribute from its most trusted source that has it, with source and time."""
    none = F.lit(None).cast("string")
    crm = shop.t["customers"].select("customer_id", F.lit("crm").alias("source"), _c("registration_date").alias("at"), _c("country_code").alias("country"), none.alias("zone"),
                                     none.alias("currency"), _c("customer_segment").alias("segment"), _c("loyalty_tier").alias("tier"))
    orders = shop.orders_u().select("customer_id", F.lit("orders").alias("source"), _c("order_date").alias("at"), _c("country_code").alias("country"),
                                    _c("delivery_address_zone").alias("zone"), "currency", none.alias("segment"), none.alias("tier"))
    return survivors(crm.unionByName(orders), "customer_id", "source", "at", ATTRIBUTE_SOURCES)


def business(shop: Shop, current_year: int, as_of: str) -> dict[str, DataFrame]:
    """Every mart and treatment of the plans over the six tables, by name."""
    r = roles(shop, current_year)
    when = F.lit(as_of).cast("timestamp")
    return {
        "orders_by_month": marts.orders_by_month(r), "value_index": marts.value_index(r), "monthly_volume": marts.monthly_volume(r), "weekday_hour": marts.weekday_hour(r),
        "weekday_hour_range": marts.weekday_hour_range(r), "status_channel_freq": marts.value_frequencies(r, "orders", ["status", "channel"]),
        "mix_by_country": marts.mix_by_country(r, ["zone", "channel"]), "headline_shares": marts.headline_shares(r), "value_by_currency": marts.value_by_currency(r),
        "value_box_stats": marts.value_box_stats(r), "delay_box_stats": marts.delay_box_stats(r), "basket": marts.basket(r), "basket_frequency": marts.basket_frequency(r),
        "units_by_category": marts.units_by_category(r), "category_mix": marts.category_mix(r), "seller_concentration": marts.seller_concentration(r),
        "brand_stats": marts.brand_stats(r), "payment_mix": marts.payment_mix(r), "payment_status_by_method": marts.payment_status_by_method(r),
        "failure_rate": marts.failure_rate(r), "carrier_scorecard": marts.carrier_scorecard(r), "delay_by_area": marts.delay_by_area(r), "delay_histogram": marts.delay_histogram(r),
        "age_histogram": marts.measure_histogram(r), "age_values": marts.measure_values(r), "delivery_status_freq": marts.value_frequencies(r, "deliveries", ["status"]),
        "customer_base": marts.value_frequencies(r, "customers", ["segment", "tier", "account_status"]), "registrations": marts.registrations(r),
        "orders_per_customer": marts.capped_orders_per_customer(r), "segment_activity": marts.activity(r, "segment"), "tier_activity": marts.activity(r, "tier"),
        "bias_table": marts.bias_table(r), "order_quarantine": marts.order_quarantine(r), "payment_reference": marts.payment_reference(r), "partial_due": marts.partial_due(r),
        "overcapture_dedup": marts.overcapture_dedup(r), "delay_treated": marts.delay_treated(r), "product_flags": marts.product_flags(r), "price_drift": marts.price_drift(r),
        "rfm": marts.rfm(r, when), "rfm_master": marts.rfm_master(r, when, masters(shop)), "customer_masters": masters(shop), "customer_attributes": customer_attributes(shop),
        "phone_duplicates": identity.duplicate_identity_summary(shop.t["customers"], "phone_hash", "customer_id", PROFILE),
    }


def scorecard(shop: Shop, current_year: int) -> DataFrame:
    """PR7: rows, completeness, failing checks and registered anomalies per table."""
    comp = None
    for t in TABLES:
        part = profile.completeness(shop.t[t.name], t.name)
        comp = part if comp is None else comp.unionByName(part)
    failing = validity(shop, current_year).groupBy(F.substring_index("table", " x ", 1).alias("table")).agg(F.count_if(_c("violations") > 0).alias("failing_checks"))
    n = {t.name: sum(r[1] == t.name for r in REGISTER) for t in TABLES}
    count = F.create_map(*[F.lit(x) for kv in n.items() for x in kv])[_c("table")]
    return comp.join(failing, "table", "left").select("table", "rows", F.round("completeness_pct", 4).alias("completeness_pct"),
                                                      F.coalesce("failing_checks", F.lit(0)).cast("long").alias("failing_checks"), count.cast("long").alias("registered_anomalies"))


def alerts(spark: SparkSession, run_id: str, found: list[tuple[str, str, int, int]], limit_pct: float = ALERT_PCT) -> DataFrame:
    """One row per (table, measure, observed, base) of a run: the rate, and whether it is above the limit."""
    rows = [(run_id, t, m, int(n), int(base), 100.0 * n / base if base else None, limit_pct, bool(base) and 100.0 * n / base > limit_pct) for t, m, n, base in found]
    return spark.createDataFrame(rows, "run_id string, table string, measure string, observed long, base long, rate_pct double, limit_pct double, alert boolean")


def run_shop(spark: SparkSession, input_dir: str, base_dir: str, run_id: str, current_year: int, fmt: str = "csv", previous: str | None = None,
             at: str | None = None, with_marts: bool = True) -> dict[str, str]:
    """One run over the tables of a folder; returns the path of every table written, by name.

    Landing counts rejected records and bad cells while it writes. Reports go
    to the monitoring zone, marts to the marts zone. Lines are settled in the
    curated and quarantine zones: an orphan of run ``previous`` is released
    once its product has arrived. Customers get persistent keys and, like
    products, a snapshot step at time ``at`` (default: the run id, a date).
    Everything lies under ``run_id``, so a repeated run replaces itself only.
    """
    at = at or run_id
    found: list[tuple[str, str, int, int]] = []
    if fmt == "csv":
        tables = {}
        for t in TABLES:
            tables[t.name], n = land_csv(spark, f"{input_dir.rstrip('/')}/{t.name}.csv", t.schema, base_dir, t.name, run_id)
            found += [(t.name, m.replace("_", " "), k, n["rows_read"]) for m, k in n.items() if m != "rows_read"]
        shop = Shop(tables)
    else:
        shop = load(spark, input_dir, fmt)

    # lines: tagged against all products known so far, settled, and counted by reason from what was written
    known = quarantine.known_parents(spark, base_dir, "order_lines", previous)
    tagged = marts.line_quarantine(roles(shop, current_year, known))
    staged = f"{zone_path(base_dir, 'intermediate', 'order_lines_tagged')}/run_id={run_id}"
    tagged.write.mode("overwrite").parquet(staged)
    tagged = spark.read.parquet(staged)
    quarantine.settle(spark, tagged, shop.t["products"], "product_id", "product_id", base_dir, "order_lines", run_id, previous)
    found += [("order_lines", r.reason, r.rows, r.population) for r in reason_rates(tagged, ["duplicate", "orphan", "formula"], ALERT_PCT).collect()]

    folder = zone_path(base_dir, "curated", "customer_keys")
    n = keys.allocate(spark, shop.t["customers"], "customer_id", ["email_hash"], folder, run_id, previous)
    found.append(("customers", "colliding ids", n["colliding_keys"], n["keys"]))
    _, held = keys.with_keys(shop.t["customers"], spark.read.parquet(f"{folder}/run_id={run_id}"), "customer_id", ["email_hash"])
    for t in TABLES:
        if t.name in ("customers", "products"):
            snapshots.take_snapshot(spark, shop.t[t.name], t.key, base_dir, t.name, run_id, at, previous)

    quality = {**key_reports(shop), "register": register(shop), "validity": validity(shop, current_year), **status_matrices(shop),
               "inventory": inventory(shop.t, EXPECTED_ROWS), "scorecard": scorecard(shop, current_year),
               **{f"profile_{t.name}": profile.profile_columns(shop.t[t.name], t.name) for t in TABLES}, "alerts": alerts(spark, run_id, found)}
    made = [("monitoring", name, df) for name, df in quality.items()]
    made += [("marts", name, df) for name, df in business(shop, current_year, at).items()] if with_marts else []
    made.append(("quarantine", "customers_colliding", held))
    paths = {name: f"{zone_path(base_dir, zone, name)}/run_id={run_id}" for zone, name, _ in made}
    for _, name, df in made:
        df.write.mode("overwrite").parquet(paths[name])
    return {**paths, "order_lines_curated": f"{zone_path(base_dir, 'curated', 'order_lines')}/run_id={run_id}",
            "order_lines_quarantine": f"{zone_path(base_dir, 'quarantine', 'order_lines')}/run_id={run_id}", "customer_keys": f"{folder}/run_id={run_id}"}
