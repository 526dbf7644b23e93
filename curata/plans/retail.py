"""Role mapping of the driver's star tables onto the retail data model.

orders -> ``orders`` (key ``o_orderkey``); order lines -> ``lineitem`` (key
``l_orderkey, l_linenumber``); customers -> ``customer``; products -> ``part``;
sellers -> ``l_suppkey``; country -> customer's ``nation``; currency -> that
nation's ``region``; channel -> ``o_orderpriority``; category -> ``p_type``;
payments -> ``events`` grouped by ``(user_id, day)`` with ``purchase`` =
captured and ``error`` = failed; delivery -> ``l_shipdate`` against
``o_orderdate``.

Every frame here is lazy; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.functions.scalars import days_between
from curata.functions.nulls import safe_ratio
from curata.operators import dedup
from curata.operators.joins import join_on_keys
from curata.plans.roles import Retail, bind

# Fixed values of the mapping.
LINE_KEY = ("l_orderkey", "l_linenumber")
ACTIVE_PART_MIN_SIZE = 5          # "active catalogue" = parts with p_size > 5
CAPTURED, FAILED, VIEW = "purchase", "error", "view"   # VIEW events price the order
CANCELLED = "P"                   # order status that plays the cancelled one
SIGNUP = "signup"                 # a customer's registration = its first sign-up event
LATE_DAYS = 7
TOL = 0.05


# The explicit schemas of the driver's tables (as the parquet
# files declare them). Reading with a schema skips the footer inference job.
TABLE_SCHEMAS = {
    "region": "r_regionkey INT,r_name STRING",
    "nation": "n_nationkey INT,n_name STRING,n_regionkey INT",
    "customer": "c_custkey BIGINT,c_name STRING,c_nationkey INT,c_acctbal DOUBLE,c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT,s_name STRING,s_nationkey INT,s_acctbal DOUBLE",
    "part": "p_partkey BIGINT,p_name STRING,p_brand STRING,p_type STRING,p_size INT,p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT,o_custkey BIGINT,o_orderstatus STRING,o_totalprice DOUBLE,o_orderdate TIMESTAMP_NTZ,"
              "o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT,l_partkey BIGINT,l_suppkey BIGINT,l_linenumber INT,l_quantity DOUBLE,"
                "l_extendedprice DOUBLE,l_discount DOUBLE,l_tax DOUBLE,l_returnflag STRING,l_linestatus STRING,"
                "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT,ts TIMESTAMP_NTZ,user_id BIGINT,event_type STRING,value DOUBLE,props STRING",
    "documents": "doc_id BIGINT,text STRING,lang STRING,source STRING,n_chars BIGINT",
    "labels": "doc_id BIGINT,quality INT,toxic INT",
    "conversations": "conv_id BIGINT,turn BIGINT,role STRING,text STRING",
    "pages": "page_id BIGINT,url STRING,html STRING",
    "benchmark": "item_id BIGINT,text STRING",
    "embeddings": "vec_id BIGINT,embedding ARRAY<FLOAT>,label INT",
}


@dataclass
class Star:
    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def t(self, name: str) -> DataFrame:
        if name not in self._cache:
            reader = self.spark.read
            if name in TABLE_SCHEMAS:
                reader = reader.schema(TABLE_SCHEMAS[name])
            self._cache[name] = reader.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
        return self._cache[name]

    # --- roles ---------------------------------------------------------
    def orders_u(self) -> DataFrame:
        """Deduplicated orders: latest row per order (null date counts newest)."""
        return dedup.latest(self.t("orders"), "o_orderkey", "o_orderdate", nulls="newest")

    def geo(self) -> DataFrame:
        """customer -> country (nation name) and currency (region name)."""
        n = self.t("nation").select("n_nationkey", F.col("n_name").alias("country"), "n_regionkey")
        r = self.t("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("currency"))
        return (self.t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
                .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
                .join(r, "n_regionkey", "left")
                .select("c_custkey", "c_mktsegment", "country", "currency"))

    def orders_geo(self) -> DataFrame:
        """orders_u with country and currency of the buyer."""
        return self.orders_u().join(self.geo(), F.col("o_custkey") == F.col("c_custkey"), "left").drop("c_custkey")

    def active_parts(self) -> DataFrame:
        return self.t("part").where(F.col("p_size") > ACTIVE_PART_MIN_SIZE)

    def line_total(self):
        return F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")) * (F.lit(1.0) + F.col("l_tax"))

    def deliveries(self) -> DataFrame:
        """lineitem with its order's date: delay = ship date - order date, in days."""
        o = self.orders_u().select(F.col("o_orderkey"), "o_orderdate", "o_orderpriority", "o_orderstatus")
        return (join_on_keys(self.t("lineitem"), o, [("l_orderkey", "o_orderkey")], "left")
                .withColumn("delay_days", days_between("l_shipdate", "o_orderdate")))

    def payments(self) -> DataFrame:
        """events as payments; the paid 'order' is (user_id, day)."""
        return self.t("events").withColumn("day", F.to_date("ts"))

    def roles(self, *names: str) -> Retail:
        """The frames that the role-bound plans use, bound; only the named ones, which must be among ``STAR_ROLES``."""
        k = F.get_json_object("props", "$.k").cast("long")
        events = lambda: self.payments().withColumn("method", F.pmod(k, F.lit(6)))
        build = {
            "orders": self.orders_geo, "visits": lambda: self.t("events"),
            "lines": lambda: self.t("lineitem").withColumn("unit_price", safe_ratio("l_extendedprice", "l_quantity")), "catalogue": self.active_parts,
            "payments": lambda: events().join(self.geo().select("c_custkey", "country"), F.col("user_id") == F.col("c_custkey"), "left"),
            "deliveries": self.deliveries,
            "customers": lambda: dedup.first(self.t("customer"), "c_name", ["c_custkey"]).withColumn("tier", F.floor(F.col("c_acctbal") / 2500).cast("long")),
        }
        return Retail({n: bind(build[n](), STAR_ROLES[n], n) for n in names}, ("user_id", "day"), CANCELLED, CAPTURED, FAILED, "A", "R", LATE_DAYS,
                      {"fulfilled_pct": ("status", "F"), "open_pct": ("status", "O"), "partial_pct": ("status", "P"), "urgent_pct": ("channel", "1-URGENT"),
                       "low_pct": ("channel", "5-LOW")}, {"fulfilled_pct": ("status", "F"), "urgent_pct": ("channel", "1-URGENT")})


#: Which column of the star plays which role.
STAR_ROLES = {
    "orders": {"order": "o_orderkey", "customer": "o_custkey", "ordered_at": "o_orderdate", "status": "o_orderstatus", "channel": "o_orderpriority",
               "country": "country", "currency": "currency", "total": "o_totalprice"},
    "visits": {"at": "ts"},
    "lines": {"order": "l_orderkey", "product": "l_partkey", "seller": "l_suppkey", "quantity": "l_quantity", "unit_price": "unit_price"},
    "catalogue": {"product": "p_partkey", "category": "p_type", "price": "p_retailprice"},
    "payments": {"user_id": "user_id", "day": "day", "payment": "event_id", "paid_at": "ts", "status": "event_type", "amount": "value", "method": "method",
                 "reference": "props", "country": "country"},
    "deliveries": {"carrier": "l_suppkey", "status": "l_returnflag", "cost": "l_extendedprice", "attempts": "l_quantity", "delay_days": "delay_days",
                   "area": "o_orderpriority"},
    "customers": {"customer": "c_custkey", "segment": "c_mktsegment", "tier": "tier", "measure": "c_acctbal"},
}
