"""Star schema: date and lookup dimensions, type 1 dimension sources, and the two facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions import dates, hashing, text
from sparkmart.operators import quality
from sparkmart.operators.skew import lookup_join, salted_join
from sparkmart.plans.lookups import CATEGORY_LABELS, STATE_NAMES

_DATE_COLUMNS = (
    ("date_key", "int"), ("full_date", "date"), ("year", "short"), ("iso_year", "short"), ("quarter", "short"),
    ("month", "short"), ("month_name", "string"), ("year_month_key", "int"), ("year_month", "string"),
    ("month_year_short", "string"), ("week_of_year", "short"), ("day_of_month", "short"),
    ("day_of_week", "short"), ("day_name", "string"), ("is_weekend", "boolean"),
)

UNKNOWN_DATE = (
    0, dt.date(1900, 1, 1), 1900, 1900, 1, 1, "UNKNOWN", 0, "UNKNOWN", "UNKNOWN", 1, 1, 0, "UNKNOWN", False,
)


def describe_dates(days: DataFrame, d: Column) -> DataFrame:
    """Calendar columns for every date of ``days``."""
    values = {
        "date_key": dates.date_key(d),
        "full_date": d,
        "year": F.year(d),
        "iso_year": dates.iso_year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": dates.month_name(d),
        "year_month_key": dates.month_key(d),
        "year_month": dates.year_month(d),
        "month_year_short": F.concat(dates.month_name(d), F.lit(" "), F.year(d).cast("string")),
        "week_of_year": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d),
        "day_name": dates.weekday_name(d),
        "is_weekend": F.dayofweek(d).isin(1, 7),
    }
    return days.select(*[values[name].cast(kind).alias(name) for name, kind in _DATE_COLUMNS])


def unknown_date(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([UNKNOWN_DATE], ", ".join(f"{n} {k}" for n, k in _DATE_COLUMNS))


def date_dim(
    spark: SparkSession, start: dt.date = dt.date(2016, 1, 1), end: dt.date = dt.date(2018, 12, 31)
) -> DataFrame:
    """One row per day from start to end, plus the unknown date 0."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("d"))
    return describe_dates(days, F.col("d")).unionByName(unknown_date(spark))


def covering_date_dim(stamps: DataFrame, column: str) -> DataFrame:
    """The date dimension from the first to the last date found in a column."""
    span = stamps.agg(F.min(F.col(column).cast("date")).alias("a"), F.max(F.col(column).cast("date")).alias("z"))
    days = span.where("a IS NOT NULL").select(F.explode(F.sequence("a", "z")).alias("d"))
    described = describe_dates(days, F.col("d"))
    return described.unionByName(unknown_date(stamps.sparkSession))


def live(df: DataFrame) -> DataFrame:
    """Rows that are not soft deleted; a frame without that column is all live."""
    return df.where(~F.col("is_deleted")) if "is_deleted" in df.columns else df


def _place_source(
    df: DataFrame, geo: DataFrame, prefix: str, natural: Sequence[str], hot_zips: Sequence
) -> DataFrame:
    """Customer or seller members with state name and the spot of their zip code."""
    spots = live(geo).select(
        F.col("geolocation_zip_code_prefix").alias(f"{prefix}_zip_code"),
        F.col("geolocation_lat").alias(f"{prefix}_lat"),
        F.col("geolocation_lng").alias(f"{prefix}_lng"),
    )
    members = live(df).select(
        *natural,
        F.col(f"{prefix}_zip_code_prefix").alias(f"{prefix}_zip_code"),
        f"{prefix}_city",
        f"{prefix}_state",
        text.label_of(F.col(f"{prefix}_state"), STATE_NAMES).alias(f"{prefix}_state_name"),
    )
    columns = [
        *natural, f"{prefix}_zip_code", f"{prefix}_city", f"{prefix}_state", f"{prefix}_state_name",
        f"{prefix}_lat", f"{prefix}_lng",
    ]
    placed = salted_join(members, spots, f"{prefix}_zip_code", "left", hot_zips, natural).select(*columns)
    return placed.withColumn("row_hash", hashing.row_hash([F.col(c) for c in columns[1:]]))


def customer_source(customers: DataFrame, geo: DataFrame, hot_zips: Sequence = ()) -> DataFrame:
    return _place_source(customers, geo, "customer", ("customer_id", "customer_unique_id"), hot_zips)


def seller_source(sellers: DataFrame, geo: DataFrame, hot_zips: Sequence = ()) -> DataFrame:
    return _place_source(sellers, geo, "seller", ("seller_id",), hot_zips)


def product_source(products: DataFrame, translation: DataFrame, hot_categories: Sequence = ()) -> DataFrame:
    """Products with their source category and an English display label."""
    english = live(translation).select("product_category_name", "product_category_name_english")
    both = F.coalesce("product_category_name_english", "product_category_name")
    label = F.coalesce(text.label_of(both, CATEGORY_LABELS), F.lit("UNKNOWN"))
    joined = salted_join(
        live(products), english, "product_category_name", "left", hot_categories, ["product_id"]
    )
    result = joined.select(
        "product_id",
        F.coalesce("product_category_name", F.lit("UNKNOWN")).alias("product_category_name"),
        label.alias("product_category_name_english"),
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    )
    return result.withColumn("row_hash", hashing.row_hash([F.col(c) for c in result.columns[1:]]))


@dataclass(frozen=True)
class Dimension:
    """A type 1 dimension: surrogate, natural key, and what its unknown member holds."""

    name: str
    surrogate: str
    natural: str
    schema: str
    unknown: Mapping[str, object]

    def empty(self, spark: SparkSession, now: dt.datetime) -> DataFrame:
        """The dimension before its first load: only the unknown member."""
        ddl = (
            f"{self.surrogate} long, {self.schema}, row_hash binary, is_deleted boolean, updated_at timestamp"
        )
        names = [part.split()[0] for part in ddl.replace("decimal(10,7)", "decimal").split(", ")]
        row = {**self.unknown, self.surrogate: -1, "is_deleted": False, "updated_at": now}
        return spark.createDataFrame([tuple(row.get(n) for n in names)], ddl)

    def with_unknown(self, dim: DataFrame, now: dt.datetime) -> DataFrame:
        """Seed the unknown member where it is missing."""
        member = self.empty(dim.sparkSession, now).select(*dim.columns)
        absent = member.join(dim.where(F.col(self.surrogate) == -1).select(self.surrogate), self.surrogate, "left_anti")
        return dim.unionByName(absent)


DIM_CUSTOMER = Dimension(
    "dim_customer", "customer_key", "customer_id",
    "customer_id string, customer_unique_id string, customer_zip_code string, customer_city string, "
    "customer_state string, customer_state_name string, customer_lat decimal(10,7), customer_lng decimal(10,7)",
    {
        "customer_id": "UNKNOWN", "customer_unique_id": "UNKNOWN", "customer_zip_code": "00000",
        "customer_city": "UNKNOWN", "customer_state": "XX", "customer_state_name": "UNKNOWN",
    },
)

DIM_SELLER = Dimension(
    "dim_seller", "seller_key", "seller_id",
    "seller_id string, seller_zip_code string, seller_city string, seller_state string, "
    "seller_state_name string, seller_lat decimal(10,7), seller_lng decimal(10,7)",
    {
        "seller_id": "UNKNOWN", "seller_zip_code": "00000", "seller_city": "UNKNOWN",
        "seller_state": "XX", "seller_state_name": "UNKNOWN",
    },
)

DIM_PRODUCT = Dimension(
    "dim_product", "product_key", "product_id",
    "product_id string, product_category_name string, product_category_name_english string, "
    "product_name_length int, product_description_length int, product_photos_qty int, product_weight_g int, "
    "product_length_cm int, product_height_cm int, product_width_cm int",
    {"product_id": "UNKNOWN", "product_category_name": "UNKNOWN", "product_category_name_english": "UNKNOWN"},
)


def latest_review(reviews: DataFrame) -> DataFrame:
    """Score of the newest live review per order; the review id settles ties."""
    newest_first = ["review_creation_date", "review_answer_timestamp", "review_id"]
    rows = live(reviews).select("order_id", *newest_first, "review_score")
    return quality.pick_last(rows, ["order_id"], newest_first).select("order_id", "review_score")


def _date_role(df: DataFrame, dim_date: DataFrame, stamp: str, role: str, default: int | None) -> DataFrame:
    """Resolve one date role; a date outside the dimension gets the default. Spark sees the dimension's size and chooses the join."""
    keys = dim_date.select(F.col("date_key").alias(role))
    computed = df.withColumn(f"_{role}", dates.date_key(F.col(stamp)))
    joined = computed.join(keys, F.col(f"_{role}") == F.col(role), "left").drop(f"_{role}")
    return joined if default is None else joined.withColumn(role, F.coalesce(F.col(role), F.lit(default)))


def order_facts(
    orders: DataFrame,
    reviews: DataFrame,
    dim_date: DataFrame,
    dim_customer: DataFrame,
    dim_order_status: DataFrame,
    hot: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Everything the sales fact takes from the order, once per live order.

    Dates, status, customer, lead times and review are resolved here, at order grain, so the much
    larger item side meets the orders in a single join.
    """
    bought, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    handed, arrived = F.col("order_delivered_carrier_date"), F.col("order_delivered_customer_date")
    promised = F.col("order_estimated_delivery_date")

    rows = _numbered(live(orders), dim_customer, "customer_id", "customer_key", hot or {}, ["order_id"])
    # the customers come first: the rows then stay with their order id, by which the review and the items meet them
    rows = rows.join(latest_review(reviews), "order_id", "left")
    rows = _date_role(rows, dim_date, "order_purchase_timestamp", "purchase_date_key", 0)
    rows = _date_role(rows, dim_date, "order_estimated_delivery_date", "estimated_delivery_date_key", 0)
    rows = _date_role(rows, dim_date, "order_delivered_carrier_date", "carrier_handoff_date_key", None)
    rows = _date_role(rows, dim_date, "order_delivered_customer_date", "actual_delivery_date_key", None)
    statuses = dim_order_status.select("order_status_key", F.col("source_value").alias("order_status"))
    rows = rows.join(F.broadcast(statuses), "order_status", "left")
    return rows.select(
        "order_id",
        "purchase_date_key",
        "estimated_delivery_date_key",
        "carrier_handoff_date_key",
        "actual_delivery_date_key",
        F.coalesce("customer_key", F.lit(-1)).alias("customer_key"),
        F.coalesce("order_status_key", F.lit(-1)).alias("order_status_key"),
        dates.days_between(bought, arrived).alias("purchase_to_delivery_days"),
        dates.days_between(promised, arrived).alias("delivery_vs_estimate_days"),
        dates.hours_between(bought, approved).alias("purchase_to_approval_hours"),
        dates.days_between(handed, arrived).alias("carrier_to_delivery_days"),
        "review_score",
    )


def _numbered(rows: DataFrame, dim: DataFrame, natural: str, surrogate: str, hot: Mapping[str, Sequence], spread: Sequence[str]) -> DataFrame:
    """Rows with the surrogate of the member they name instead of its id, which is moved packed; NULL where there is none."""
    members = text.packed(dim.select(natural, surrogate), natural)
    return lookup_join(text.packed(rows, natural), members, natural, "left", text.packed_keys(hot.get(natural, ())), spread).drop(natural)


def fact_sales(
    items: DataFrame,
    orders: DataFrame,
    reviews: DataFrame,
    dim_date: DataFrame,
    dim_customer: DataFrame,
    dim_seller: DataFrame,
    dim_product: DataFrame,
    dim_order_status: DataFrame,
    hot: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """One row per live order item of a live order.

    ``hot`` names heavy values of order_id, seller_id, product_id and customer_id, as found by
    :func:`sparkmart.operators.skew.hot_values`; those keys are spread over many tasks. The orders come last, so that what they add
    is moved once and the rows of an order leave together. Ids are moved packed.
    """
    heavy = hot or {}
    line = ["order_id", "order_item_id"]
    number = F.col("order_item_id").try_cast("int").alias("order_item_id")
    per_order = order_facts(text.packed(orders, "order_id"), text.packed(reviews, "order_id"), dim_date, dim_customer, dim_order_status, heavy)
    rows = text.packed(live(items), "order_id").select("order_id", number, "product_id", "seller_id", "price", "freight_value")
    rows = _numbered(rows, dim_seller, "seller_id", "seller_key", heavy, line)
    rows = _numbered(rows, dim_product, "product_id", "product_key", heavy, line)
    rows = salted_join(rows, per_order, "order_id", "inner", text.packed_keys(heavy.get("order_id", ())), ["order_item_id"])
    return rows.select(
        "purchase_date_key",
        "estimated_delivery_date_key",
        "carrier_handoff_date_key",
        "actual_delivery_date_key",
        "customer_key",
        F.coalesce("seller_key", F.lit(-1)).alias("seller_key"),
        F.coalesce("product_key", F.lit(-1)).alias("product_key"),
        "order_status_key",
        text.unpacked_id(F.col("order_id")).alias("order_id"),
        "order_item_id",
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).cast("decimal(10,2)").alias("total_value"),
        "purchase_to_delivery_days",
        "delivery_vs_estimate_days",
        "purchase_to_approval_hours",
        "carrier_to_delivery_days",
        "review_score",
    )


def fact_payments(
    payments: DataFrame,
    orders: DataFrame,
    dim_date: DataFrame,
    dim_customer: DataFrame,
    dim_payment_type: DataFrame,
    hot: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """One row per live payment of a live order."""
    heavy = hot or {}
    rows = text.packed(live(orders), "order_id").select("order_id", "customer_id", "order_purchase_timestamp")
    rows = _date_role(rows, dim_date, "order_purchase_timestamp", "purchase_date_key", 0)
    rows = _numbered(rows, dim_customer, "customer_id", "customer_key", heavy, ["order_id"])
    per_order = rows.select("order_id", "purchase_date_key", F.coalesce("customer_key", F.lit(-1)).alias("customer_key"))
    types = dim_payment_type.select("payment_type_key", F.col("source_value").alias("payment_type"))
    paid = text.packed(live(payments), "order_id").select(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"
    )
    joined = salted_join(paid, per_order, "order_id", "inner", text.packed_keys(heavy.get("order_id", ())), ["payment_sequential"])
    return joined.join(F.broadcast(types), "payment_type", "left").select(
        "purchase_date_key",
        "customer_key",
        F.coalesce("payment_type_key", F.lit(-1)).alias("payment_type_key"),
        text.unpacked_id(F.col("order_id")).alias("order_id"),
        "payment_sequential",
        "payment_installments",
        "payment_value",
    )
