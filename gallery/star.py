"""Dimensions and facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gallery.base import Tables, example
from gallery.oracle import with_ctes
from sparkmart.operators import merge
from sparkmart.operators.skew import hot_values
from sparkmart.plans import mart
from sparkmart.plans.lookups import order_status_dim, payment_type_dim

NOW = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
LATER = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)


class Star:
    """The star schema over the cleansed stand-ins, each dimension loaded once.

    Loads take the cleansed rows as they come and write them nowhere; heavy keys are looked for in the rows before, by a scan. The facts'
    orders, payments and reviews have their keys counted first, so that only keys with several rows are ranked; items are ranked where
    they then meet their orders.
    """

    def __init__(self, t: Tables):
        self.t = t

    def load(self, dimension: mart.Dimension, source: DataFrame) -> DataFrame:
        start = dimension.empty(self.t.spark, NOW)
        return merge.merge_dimension(start, source, dimension.natural, dimension.surrogate, F.lit(NOW)).drop("_action")

    def load_customers(self) -> DataFrame:
        entity = self.t.cleansed
        zips = hot_values(self.t.clean("customers"), ["customer_zip_code_prefix"])["customer_zip_code_prefix"]
        return self.load(mart.DIM_CUSTOMER, mart.customer_source(entity("customers"), entity("geolocation"), zips))

    def load_sellers(self) -> DataFrame:
        entity = self.t.cleansed
        zips = hot_values(self.t.clean("sellers"), ["seller_zip_code_prefix"])["seller_zip_code_prefix"]
        return self.load(mart.DIM_SELLER, mart.seller_source(entity("sellers"), entity("geolocation"), zips))

    def load_products(self) -> DataFrame:
        entity = self.t.cleansed
        kinds = hot_values(self.t.clean("products"), ["product_category_name"])["product_category_name"]
        return self.load(
            mart.DIM_PRODUCT,
            mart.product_source(entity("products"), entity("product_category_name_translation"), kinds),
        )

    def build_dates(self) -> DataFrame:
        return mart.covering_date_dim(self.t.table("orders"), "o_orderdate")

    def build_sales(self) -> DataFrame:
        counted, clean, packed = self.t.counted, self.t.clean, ("order_id",)
        hot = {**hot_values(clean("order_items"), ["order_id", "seller_id", "product_id"]), **hot_values(clean("orders"), ["customer_id"])}
        items = self.t.dealt("order_items", "order_id", hot["order_id"], ("product_id", "seller_id"))
        return mart.fact_sales(
            items, counted("orders", packed), counted("order_reviews"), self.dates(), self.customers(), self.sellers(), self.products(),
            order_status_dim(self.t.spark), hot,
        )

    def build_payments(self) -> DataFrame:
        counted, clean, packed = self.t.counted, self.t.clean, ("order_id",)
        payments, orders = counted("order_payments", packed), counted("orders", packed)
        hot = {**hot_values(clean("order_payments"), ["order_id"]), **hot_values(clean("orders"), ["customer_id"])}
        return mart.fact_payments(
            payments, orders, self.dates(), self.customers(), payment_type_dim(self.t.spark), hot,
        )

    def customers(self) -> DataFrame:
        return self.t.published("dim_customer", self.load_customers)

    def sellers(self) -> DataFrame:
        return self.t.published("dim_seller", self.load_sellers)

    def products(self) -> DataFrame:
        return self.t.published("dim_product", self.load_products)

    def dates(self) -> DataFrame:
        return self.t.published("dim_date", self.build_dates)

    def sales(self) -> DataFrame:
        return self.t.published("fact_sales", self.build_sales)

    def payments(self) -> DataFrame:
        return self.t.published("fact_payments", self.build_payments)


_PLACE = "{p}_zip_code, {p}_city, {p}_state, {p}_state_name, cast({p}_lat AS string) AS {p}_lat, cast({p}_lng AS string) AS {p}_lng"


def _place_columns(prefix: str) -> list[str]:
    return [f"{prefix}_{c}" for c in ("zip_code", "city", "state", "state_name")] + [
        f"cast({prefix}_{c} AS string) AS {prefix}_{c}" for c in ("lat", "lng")]


@example("M-03, M-04, M-05, M-06, J-06, F-13", with_ctes(f"""
SELECT customer_key, customer_id, customer_unique_id, {_PLACE.format(p='customer')}, row_hash FROM dim_customer"""))
def dim_customer(t: Tables):
    """Customer dimension with spots, state names and surrogates."""
    return Star(t).load_customers().selectExpr(
        "customer_key", "customer_id", "customer_unique_id", *_place_columns("customer"), "lower(hex(row_hash)) AS row_hash")


@example("M-03, M-04, M-05, M-07", with_ctes(f"""
SELECT seller_key, seller_id, {_PLACE.format(p='seller')}, row_hash FROM dim_seller"""))
def dim_seller(t: Tables):
    """Seller dimension."""
    return Star(t).load_sellers().selectExpr(
        "seller_key", "seller_id", *_place_columns("seller"), "lower(hex(row_hash)) AS row_hash")


_PRODUCT = ["product_key", "product_id", "product_category_name", "product_category_name_english", *[
    f"cast(product_{c} AS string) AS product_{c}" for c in (
        "name_length", "description_length", "photos_qty", "weight_g", "length_cm", "height_cm", "width_cm")]]


@example("M-03, M-04, M-05, M-08, F-14", with_ctes(f"SELECT {', '.join(_PRODUCT)}, row_hash FROM dim_product"))
def dim_product(t: Tables):
    """Product dimension with display labels."""
    return Star(t).load_products().selectExpr(*_PRODUCT, "lower(hex(row_hash)) AS row_hash")


_DATE = [
    "date_key", "cast(full_date AS string) AS full_date", "year", "iso_year", "quarter", "month", "month_name",
    "year_month_key", "year_month", "month_year_short", "week_of_year", "day_of_month", "day_of_week", "day_name",
    "is_weekend",
]


@example("M-05, M-09, S-11, J-11, W-06, F-15..F-20", with_ctes(f"SELECT {', '.join(_DATE)} FROM dim_date"))
def dim_date(t: Tables):
    """Every day between the first and the last purchase, with calendar labels."""
    return Star(t).build_dates().selectExpr(*_DATE)


@example("M-10, S-10, J-10", with_ctes("""
SELECT order_status_key, status_name, status_category, sort_order, count(o.order_id) AS orders
FROM dim_order_status LEFT JOIN live_orders o ON o.order_status = source_value GROUP BY ALL"""))
def order_status_use(t: Tables):
    """Status lookup, seeded twice without effect, with the orders of each status."""
    statuses = order_status_dim(t.spark)
    statuses = merge.insert_missing(statuses, order_status_dim(t.spark), "order_status_key")
    used = t.published_entity("orders").groupBy(F.col("order_status").alias("source_value")).agg(F.count("*").alias("orders"))
    return statuses.join(used, "source_value", "left").select(
        "order_status_key", "status_name", "status_category", "sort_order",
        F.coalesce("orders", F.lit(0)).alias("orders"))


@example("M-11, S-10, J-10", with_ctes("""
SELECT payment_type_key, payment_type_name, count(p.order_id) AS payments
FROM dim_payment_type LEFT JOIN live_order_payments p ON p.payment_type = source_value GROUP BY ALL"""))
def payment_type_use(t: Tables):
    """Payment-type lookup with the payments of each type."""
    types = merge.insert_missing(payment_type_dim(t.spark), payment_type_dim(t.spark), "payment_type_key")
    used = t.published_entity("order_payments").groupBy(F.col("payment_type").alias("source_value")).agg(
        F.count("*").alias("payments"))
    return types.join(used, "source_value", "left").select(
        "payment_type_key", "payment_type_name", F.coalesce("payments", F.lit(0)).alias("payments"))


# Day 1: parts of brands other than Brand#1. Day 2: promo parts are relabelled, small parts are gone.
_PARTS_1 = "SELECT p_partkey, p_type, p_name FROM part WHERE p_brand <> 'Brand#1'"


def _parts(t: Tables, day: int) -> DataFrame:
    parts = t.table("part")
    if day == 1:
        parts = parts.where("p_brand <> 'Brand#1'")
    else:
        parts = parts.where("p_type <> 'SMALL'").withColumn(
            "p_type", F.when(F.col("p_type") == "PROMO", "OFFER").otherwise(F.col("p_type")))
    return parts.selectExpr(
        "cast(p_partkey AS string) AS part_id", "p_type", "p_name",
        "unhex(sha2(concat(p_type, '|', p_name), 256)) AS row_hash")


_PART_DIM = mart.Dimension(
    "dim_part", "part_key", "part_id", "part_id string, p_type string, p_name string",
    {"part_id": "UNKNOWN", "p_type": "UNKNOWN", "p_name": "UNKNOWN"},
)


@example("M-03, M-04, M-05", f"""
WITH d1 AS (SELECT cast(p_partkey AS varchar) AS part_id, p_type, p_name FROM ({_PARTS_1})),
k1 AS (SELECT *, row_number() OVER (ORDER BY md5(part_id), part_id) AS part_key FROM d1),
d2 AS (SELECT cast(p_partkey AS varchar) AS part_id, CASE p_type WHEN 'PROMO' THEN 'OFFER' ELSE p_type END AS p_type, p_name
       FROM part WHERE p_type <> 'SMALL'),
k2 AS (SELECT part_id, (SELECT count(*) FROM d1) + row_number() OVER (ORDER BY md5(part_id), part_id) AS part_key
       FROM d2 WHERE part_id NOT IN (SELECT part_id FROM d1))
SELECT coalesce(k1.part_key, k2.part_key) AS part_key, coalesce(d2.part_id, k1.part_id) AS part_id,
       coalesce(d2.p_type, k1.p_type) AS p_type, d2.part_id IS NULL AS is_deleted,
       CASE WHEN k1.part_id IS NULL THEN 'INSERT' WHEN d2.part_id IS NULL THEN 'SOFT_DELETE'
            WHEN d2.p_type <> k1.p_type THEN 'UPDATE' ELSE 'NOOP' END AS action
FROM k1 FULL JOIN d2 ON d2.part_id = k1.part_id LEFT JOIN k2 ON k2.part_id = d2.part_id
UNION ALL SELECT -1, 'UNKNOWN', 'UNKNOWN', false, 'NOOP'""")
def dimension_reload(t: Tables):
    """A type 1 dimension after two loads: stable surrogates, new ones numbered on, the unknown member safe."""

    def first_load() -> DataFrame:
        empty = _PART_DIM.empty(t.spark, NOW)
        return merge.merge_dimension(empty, _parts(t, 1), "part_id", "part_key", F.lit(NOW)).drop("_action")

    seeded = _PART_DIM.with_unknown(t.published("dim_part", first_load), NOW)
    second = merge.merge_dimension(seeded, _parts(t, 2), "part_id", "part_key", F.lit(LATER))
    return second.select("part_key", "part_id", "p_type", "is_deleted", F.col("_action").alias("action"))


_SALES = [
    "purchase_date_key", "estimated_delivery_date_key", "carrier_handoff_date_key", "actual_delivery_date_key",
    "customer_key", "seller_key", "product_key", "order_status_key", "order_id", "order_item_id",
    "cast(price AS string) AS price", "cast(freight_value AS string) AS freight_value",
    "cast(total_value AS string) AS total_value", "purchase_to_delivery_days", "delivery_vs_estimate_days",
    "purchase_to_approval_hours", "carrier_to_delivery_days", "review_score",
]


@example("M-12, J-01..J-07, F-21, F-22, F-27, F-28", with_ctes(f"SELECT {', '.join(_SALES)} FROM fact_sales"))
def fact_sales(t: Tables):
    """Sales fact."""
    return Star(t).build_sales().selectExpr(*_SALES)


_PAYMENTS = [
    "purchase_date_key", "customer_key", "payment_type_key", "order_id", "payment_sequential", "payment_installments",
    "cast(payment_value AS string) AS payment_value",
]


@example("M-13, J-01, J-02, J-03", with_ctes(f"SELECT {', '.join(_PAYMENTS)} FROM fact_payments"))
def fact_payments(t: Tables):
    """Payments fact."""
    return Star(t).build_payments().selectExpr(*_PAYMENTS)
