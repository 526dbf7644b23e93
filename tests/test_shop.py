"""The shop's six tables as CSV, each anomaly planted once; all counts by hand."""

import csv
import os

import pytest

from curata.plans import shop as S

H = {x: x * 64 for x in "abcdef"}
FILES = {
    "orders": """order_id,customer_id,order_date,created_at,updated_at,order_status,channel,country_code,delivery_address_zone,currency,subtotal_amount,shipping_amount,discount_amount,total_amount,promo_code
o1,c1,2025-05-01T10:00:00+00:00,2025-05-01T10:00:00+00:00,2025-06-01T00:00:00+00:00,PENDING,WEB,SEN,URBAN,XOF,20,2,0,22,
o1,c1,2025-05-01T10:00:00+00:00,2025-05-01T10:00:00+00:00,2025-06-02T00:00:00+00:00,DELIVERED,WEB,SEN,URBAN,XOF,20,2,0,22,
o2,c2,2025-05-01T10:00:00+00:00,2025-05-01T10:00:00+00:00,2025-06-01T00:00:00+00:00,DELIVERED,WEB,GHA,URBAN,XOF,10,0,1,12,NA
o3,c3,2025-05-02T10:00:00+00:00,2025-05-02T10:00:00+00:00,2025-06-01T00:00:00+00:00,CANCELLED,WEB,SEN,URBAN,XOF,5,0,0,5,
o4,c1,2025-05-03T10:00:00+00:00,2025-05-03T10:00:00+00:00,2025-06-01T00:00:00+00:00,DELIVERED,WEB,SEN,RURAL,XOF,30,0,0,30,
""",
    # columns in another order, a whole number as float, a quoted text with a comma
    "order_lines": """order_id,order_line_id,quantity,product_id,product_sku,unit_price,line_discount,line_total,seller_id
o1,l1,2.0,p1,A-1,10,0,20,"s,1"
o2,l2,1,p1,A-1,10,0,10,s1
o4,l3,1,p9,X-9,30,0,25,s1
""",
    "customers": f"""customer_id,email_hash,phone_hash,first_name,last_name,city,birth_year,registration_date,country_code,gender,customer_segment,loyalty_tier,account_status
c1,{H['a']},{H['b']},Awa,Diop,Dakar,1990,2025-01-01,SEN,F,VIP,GOLD,ACTIVE
c2,{H['a']},{H['c']}," ",Mensah,Accra,1985,2025-01-01,GHA,X,NEW,BRONZE,ACTIVE
c3,{H['d']},{H['e']},Koffi,Kone,Abidjan,1980,2025-01-01,CIV,M,REGULAR,SILVER,CLOSED
c3,{H['e']},{H['f']},Ada,Obi,Lagos,2012,2025-02-01,NGA,F,DORMANT,PLATINUM,SUSPENDED
""",
    "products": """product_id,sku,unit_price,unit_cost,category_name,subcategory_name,brand,is_perishable,product_status,weight_grams,created_at,updated_at
p1,A-1,10,5,Mode,x,b,False,ACTIVE,100,2025-01-01,2025-01-02
p2,A-2,0,0,Beauté,x,,True,ACTIVE,100,2025-01-01,2025-01-02
p3,A-3,5,9,Téléphonie,x,b,False,DISCONTINUED,100,2025-01-01,2025-01-02
""",
    "payments": """payment_id,order_id,payment_date,payment_amount,payment_status,payment_method,payment_provider,currency,transaction_reference
y1,o1,2025-05-01,22,FAILED,WAVE,W,XOF,r1
y2,o1,2025-05-02,22,CAPTURED,WAVE,W,XOF,r2
y3,o2,2025-05-02,6,CAPTURED,COD,X,XOF,r3
y4,o3,2025-05-02,5,CAPTURED,WAVE,W,GHS,r4
y5,o3,2025-05-03,5,CAPTURED,WAVE,W,XOF,r4
""",
    "deliveries": """delivery_id,order_id,shipped_at,delivered_at,delivery_status,carrier,delivery_cost,delivery_attempts
d1,o1,2025-05-02,2025-05-20,DELIVERED,k,3,1
d2,o2,2025-05-05,2025-05-03,DELIVERED,k,3,1
""",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("shop")
    for name, text in FILES.items():
        (path / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(path)


def test_register(spark, folder):
    got = {r.code: (r.observed, r.base) for r in S.register(S.load(spark, folder)).collect()}
    assert got == {"A1": (1, 5), "A2": (1, 3), "A2b": (1, 3), "A3": (1, 4), "A3b": (1, 4), "A3c": (1, 4), "A4a": (1, 3), "A4b": (1, 3), "A4c": (1, 3),
                   "A5": (1, 2), "A5b": (1, 2), "A6a": (1, 3), "A6b": (1, 3), "A7a": (1, 4), "A7b": (1, 4)}


def test_fifty_checks(spark, folder):
    rows = S.validity(S.load(spark, folder), 2026).collect()
    assert len(rows) == 50
    bad = {(r.table, r.check): r.violations for r in rows if r.violations}
    assert bad == {("customers", "gender outside allowed domain"): 1, ("orders", "discount without a promo code"): 1,
                   ("orders", "currency is not the country's"): 1, ("payments", "currency is not the order's"): 1,
                   ("payments", "cash on delivery through an outside provider"): 1, ("deliveries", "delivered before shipped"): 1,
                   ("customers", "younger than 18 at registration"): 1, ("customers", "a name is missing or blank"): 1,
                   ("orders x payments", "CANCELLED, last payment CAPTURED"): 1, ("orders x deliveries", "DELIVERED without a delivery"): 1}


VALID = {
    "orders": dict(order_id="", customer_id="c1", order_date="2025-06-01T10:00:00+00:00", created_at="2025-06-01T10:00:00+00:00", updated_at="2025-06-02T10:00:00+00:00",
                   order_status="CONFIRMED", channel="WEB", country_code="SEN", delivery_address_zone="URBAN", currency="XOF", subtotal_amount="10", shipping_amount="0",
                   discount_amount="0", total_amount="10", promo_code=""),
    "order_lines": dict(order_line_id="", order_id="v", product_id="p", product_sku="S", quantity="1", unit_price="10", line_discount="0", line_total="10", seller_id="s"),
    "customers": dict(customer_id="", email_hash=H["a"], phone_hash=H["b"], first_name="A", last_name="B", city="D", birth_year="1990", registration_date="2025-01-01",
                      country_code="SEN", gender="F", customer_segment="VIP", loyalty_tier="GOLD", account_status="ACTIVE"),
    "products": dict(product_id="", sku="S", unit_price="10", unit_cost="5", category_name="Mode", subcategory_name="x", brand="b", is_perishable="False",
                     product_status="ACTIVE", weight_grams="100", created_at="2025-01-01", updated_at="2025-01-02"),
    "payments": dict(payment_id="", order_id="v", payment_date="2025-06-01", payment_amount="10", payment_status="CAPTURED", payment_method="WAVE", payment_provider="W",
                     currency="XOF", transaction_reference="r"),
    "deliveries": dict(delivery_id="", order_id="v", shipped_at="2025-06-02", delivered_at="2025-06-03", delivery_status="DELIVERED", carrier="k", delivery_cost="3",
                       delivery_attempts="1"),
}
#: One row per entry: the valid row with these cells.
PLANTED = {
    "orders": [dict(order_id="v"), dict(order_status="X"), dict(channel="X"), dict(country_code="X"), dict(delivery_address_zone="X"), dict(currency="X"), dict(shipping_amount="-1"),
               dict(total_amount="0"), dict(discount_amount="11", promo_code="P"), dict(discount_amount="1"), dict(promo_code="P"), dict(updated_at="2025-05-31T10:00:00+00:00"),
               dict(created_at="2025-06-01T11:00:00+00:00"), dict(order_date="2024-06-01T10:00:00+00:00", created_at="2024-06-01T10:00:00+00:00"), dict(currency="GHS"),
               dict(customer_id="early"), dict(order_id="cancelled", order_status="CANCELLED"), dict(order_id="bare", order_status="DELIVERED")],
    "order_lines": [dict(quantity="0"), dict(unit_price="0", line_total="0"), dict(line_discount="-1"), {}],
    "customers": [dict(customer_id="c1"), dict(customer_id="early", registration_date="2025-07-01"), dict(gender="X"), dict(customer_segment="X"), dict(loyalty_tier="X"),
                  dict(account_status="X"), dict(country_code="X"), dict(birth_year="2010"), dict(birth_year="1900"), dict(email_hash="a" * 63), dict(phone_hash="b" * 65),
                  dict(email_hash="G" * 64), dict(last_name=" ")],
    "products": [dict(product_id="p"), dict(product_status="X"), dict(category_name="X"), dict(weight_grams="0"), dict(updated_at="2024-12-31")],
    "payments": [{}, dict(payment_method="X"), dict(payment_status="X"), dict(currency="X"), dict(payment_amount="0"), dict(currency="GHS"), dict(payment_method="COD"),
                 dict(payment_provider="W2"), dict(order_id="cancelled")],
    "deliveries": [{}, dict(delivery_status="X", delivered_at=""), dict(delivery_cost="-1"), dict(delivery_attempts="6"), dict(shipped_at="2025-05-31"), dict(delivered_at="2025-06-01T12:00:00+00:00"),
                   dict(delivered_at=""), dict(delivery_status="FAILED"), dict(order_id="cancelled", delivery_status="FAILED", delivered_at="")],
}


def test_every_check_fires(spark, tmp_path):
    for name, base in VALID.items():
        key = next(iter(base))
        with open(tmp_path / f"{name}.csv", "w", encoding="utf-8", newline="") as f:
            out = csv.DictWriter(f, base)
            out.writeheader()
            for k, row in enumerate(PLANTED[name]):
                out.writerow({**base, key: f"{name[0]}{k}", **row})
    got = {(r.table, r.check): r.violations for r in S.validity(S.load(spark, str(tmp_path)), 2026).collect()}
    assert len(got) == 50 and min(got.values()) >= 1
    # one planted row each, but for rows that break a second rule as well (by hand)
    more = {("orders", "currency is not the country's"): 3,             # X as currency, X as country (it has none), GHS in SEN
            ("customers", "ordered before registration"): 2,            # the order outside the window also comes before c1's registration
            ("payments", "currency is not the order's"): 2,             # X and GHS
            ("payments", "method with several providers"): 7}           # every WAVE payment: W and W2
    assert {k: v for k, v in got.items() if v != 1} == more


def test_marts_over_roles(spark, folder):
    shop = S.load(spark, folder)
    got = {name: [r.asDict() for r in df.collect()] for name, df in S.business(shop, 2026, "2025-06-01").items()}
    pick = lambda name, *cols: sorted((tuple(r[c] for c in cols) for r in got[name]), key=str)
    one = lambda name: got[name][0]
    assert pick("orders_by_month", "month", "country", "n") == [("2025-05", "GHA", 1), ("2025-05", "SEN", 3)]
    assert pick("value_index", "month", "currency", "value", "index") == [("2025-05", "XOF", 64.0, 100.0)]
    assert one("headline_shares") == {"delivered_pct": 75.0, "cancelled_pct": 25.0, "returned_pct": 0.0, "app_pct": 0.0, "web_pct": 100.0, "urban_pct": 75.0, "rural_pct": 25.0}
    assert pick("units_by_category", "category", "units") == [("Mode", 3)]
    b = one("brand_stats")
    assert (b["brands"], b["never_ordered"]) == (1, 2) and b["missing_brand_pct"] == pytest.approx(100 / 3)
    c = one("carrier_scorecard")
    assert (c["carrier"], c["deliveries"], c["failed_pct"], c["returned_pct"], c["mean_cost"], c["mean_attempts"], c["late_pct"]) == ("k", 2, 0.0, 0.0, 3.0, 1.0, 50.0)
    assert c["median_delay"] == pytest.approx((18 + 14 / 24 + 1 + 14 / 24) / 2)
    assert pick("orders_per_customer", "cap", "n_orders", "customers") == [(6, 1, 2), (6, 2, 1), (8, 1, 2), (8, 2, 1)]
    assert pick("age_values", "measure", "n") == [(14, 1), (36, 1), (46, 1)] and pick("registrations", "quarter", "n") == [("2025Q1", 3)]
    assert pick("failure_rate", "provider", "failed_pct", "captured_pct") == [("W", 25.0, 75.0), ("X", 0.0, 100.0)]
    assert pick("payment_reference", "order", "payment", "attempt_no") == [("o1", "y2", 2), ("o2", "y3", 1), ("o3", "y5", 2)]
    assert pick("partial_due", "order", "is_partial_payment", "amount_due") == [("o1", False, 0.0), ("o2", True, 6.0), ("o3", False, 0.0), ("o4", False, None)]
    assert one("overcapture_dedup") == {"overcapture_before": 1, "multi_capture_before": 1, "overcapture_after": 0, "multi_capture_after": 0}
    assert pick("order_quarantine", "order", "reasons", "recomputed_total") == [
        ("o1", "", 20.0), ("o2", "total_formula", 10.0), ("o3", "no_lines", None), ("o4", "total_mismatch", 0.0)]
    assert pick("product_flags", "product", "zone", "is_sold") == [("p1", "curated", True), ("p2", "quarantine", False), ("p3", "flagged", False)]
    assert (one("price_drift")["lines"], one("price_drift")["exact_price_lines"], one("price_drift")["other_sku_lines"]) == (2, 2, 0)
    assert pick("rfm", "customer", "frequency", "monetary") == [("c1", 2, 52.0), ("c2", 1, 12.0), ("c3", 1, 5.0)]
    assert pick("rfm_master", "master_id", "frequency", "monetary") == [("c1", 3, 64.0), ("c3", 1, 5.0)]
    assert pick("customer_masters", "customer", "master_id") == [("c1", "c1"), ("c2", "c1"), ("c3", "c3")]
    assert pick("customer_attributes", "customer_id", "country", "country_source", "zone", "zone_source")[0] == ("c1", "SEN", "crm", "RURAL", "orders")
    assert one("phone_duplicates")["dup_groups"] == 0
    d = one("delay_treated")
    assert (d["area"], d["deliveries"], d["nulled"]) == ("URBAN", 2, 0)


def test_an_empty_or_unbound_role_is_named(spark):
    from curata.plans.roles import bind
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError, match="order_key"):
        bind(df, {"order": "order_key"}, "orders")
    with pytest.raises(ValueError, match="customer"):
        bind(df, {"order": "x"}, "orders")


def test_two_runs(spark, folder, tmp_path):
    """Run 1 holds two orphan lines and rejects a short payment; in run 2 the products of both arrive, one line is released."""
    for run, lines, products in (("2026-01-01", FILES["order_lines"] + "o1,l4,1,p8,Z-8,5,0,5,s1\n", FILES["products"]),
                                 ("2026-01-02", FILES["order_lines"].split("\n")[0] + "\no2,l5,1,p1,A-1,10,0,10,s1\n",
                                  FILES["products"].replace("p1,A-1,10,5", "p1,A-1,10,6").split("p3,")[0] + "p8,Z-8,5,1,Mode,x,b,False,ACTIVE,1,2025-01-01,2025-01-02\n"
                                  "p9,X-9,30,1,Mode,x,b,False,ACTIVE,1,2025-01-01,2025-01-02\n")):
        os.makedirs(tmp_path / run)
        for name, text in FILES.items():
            text = {"order_lines": lines, "products": products, "payments": FILES["payments"] + "y9,o1\n"}.get(name, text)
            (tmp_path / run / f"{name}.csv").write_text(text, encoding="utf-8")
    base = str(tmp_path / "out")
    paths = S.run_shop(spark, str(tmp_path / "2026-01-01"), base, "2026-01-01", 2026)
    assert len(paths) > 60 and "rfm_master" in paths and all(os.path.isdir(p) for p in paths.values())
    read = lambda p: spark.read.parquet(p)
    fk = {r.fk: r.orphan_rows for r in read(paths["foreign_keys"]).collect()}
    assert fk["order_lines.product_id -> products.product_id"] == 2 and sum(fk.values()) == 2
    pk = {r.table: r.surplus_rows for r in read(paths["primary_keys"]).collect()}
    assert pk == {"orders": 1, "order_lines": 0, "customers": 1, "products": 0, "payments": 0, "deliveries": 0}
    found = {(r.table, r.measure): (r.observed, r.base, r.alert) for r in read(paths["alerts"]).collect()}
    assert found["payments", "rows rejected"] == (1, 6, True) and found["orders", "rows rejected"] == (0, 5, False)
    assert found["order_lines", "orphan"] == (2, 4, True) and found["customers", "colliding ids"] == (2, 4, True)
    inv = {r.table: (r.rows, r.delta_vs_expected) for r in read(paths["inventory"]).collect()}
    assert inv["payments"] == (5, 5 - 46_141)
    held = {r.order_line_id: r.reasons for r in read(paths["order_lines_quarantine"]).collect()}
    assert held == {"l3": "orphan,formula", "l4": "orphan"} and sorted(r.order_line_id for r in read(paths["order_lines_curated"]).collect()) == ["l1", "l2"]
    card = {r.table: r.registered_anomalies for r in read(paths["scorecard"]).collect()}
    assert card == {"orders": 4, "order_lines": 2, "customers": 2, "products": 2, "payments": 3, "deliveries": 2}
    assert sorted(r.customer_id for r in read(paths["customers_colliding"]).collect()) == ["c3", "c3"]

    second = S.run_shop(spark, str(tmp_path / "2026-01-02"), base, "2026-01-02", 2026, previous="2026-01-01", with_marts=False)
    cur = {r.order_line_id: r.released for r in read(second["order_lines_curated"]).collect()}
    assert cur == {"l4": True, "l5": False} and {r.order_line_id: r.reasons for r in read(second["order_lines_quarantine"]).collect()} == {"l3": "formula"}
    changed = {r.product_id: r.change for r in read(f"{base}/snapshots/products/changes/run_id=2026-01-02").collect()}
    assert changed == {"p1": "update", "p3": "delete", "p8": "insert", "p9": "insert"}
    a, b = (sorted(tuple(r)[:3] for r in read(p["customer_keys"]).collect()) for p in (paths, second))
    assert a == b
