"""The nine source entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.functions import text
from sparkmart.operators.quality import (
    ISSUES,
    digits_only, hex_id, is_digits, is_filled, is_hex_id, is_present, is_state_code, is_zip_code, not_empty,
    not_null, one_of, out_of_range, parses, state_code, zip_code,
)
from sparkmart.plans import spec as s
from sparkmart.plans.lookups import ORDER_STATUSES, PAYMENT_TYPES

FIRST, LAST = "first", "last"


def _customers_rules():
    names = ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]
    return [
        *[not_null(c) for c in names],
        *[not_empty(c) for c in names],
        hex_id("customer_id"),
        hex_id("customer_unique_id"),
        zip_code("customer_zip_code_prefix"),
        state_code("customer_state"),
    ]


CUSTOMERS = s.EntitySpec(
    name="customers",
    separator="|",
    quoted_source=True,
    fields=(
        s.stripped("customer_id"),
        s.stripped("customer_unique_id"),
        s.stripped("customer_zip_code_prefix"),
        s.normalised("customer_city"),
        s.normalised("customer_state"),
    ),
    keys=("customer_id",),
    hashed=(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
    ),
    order=(("customer_unique_id", FIRST), ("customer_zip_code_prefix", FIRST)),
    rules=_customers_rules,
    admits=lambda: [is_hex_id("customer_id"), is_hex_id("customer_unique_id"), is_zip_code("customer_zip_code_prefix"),
                    is_filled("customer_city"), is_state_code("customer_state")],
)


def _orders_rules():
    ids = ["order_id", "customer_id"]
    needed = ["order_purchase_timestamp", "order_estimated_delivery_date"]
    optional = ["order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"]
    return [
        *[not_null(c) for c in [*ids, "order_status"]],
        *[not_null(c, parsed=True) for c in needed],
        *[not_empty(c) for c in [*ids, "order_status"]],
        *[hex_id(c) for c in ids],
        one_of("order_status", ORDER_STATUSES, "order status"),
        *[parses(c, "datetime") for c in needed],
        *[parses(c, "datetime", rejects=False) for c in optional],
        s.Rule(
            "order_delivered_customer_date",
            "Delivered before purchase",
            F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp"),
            rejects=False,
        ),
    ]


ORDERS = s.EntitySpec(
    name="orders",
    separator=",",
    fields=(
        s.stripped("order_id"),
        s.stripped("customer_id"),
        s.trimmed("order_status"),
        s.timestamp("order_purchase_timestamp"),
        s.timestamp("order_approved_at"),
        s.timestamp("order_delivered_carrier_date"),
        s.timestamp("order_delivered_customer_date"),
        s.timestamp("order_estimated_delivery_date"),
    ),
    keys=("order_id",),
    hashed=(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    ),
    order=(("order_purchase_timestamp", LAST), ("customer_id", FIRST)),
    rules=_orders_rules,
    key_tests=1,
    admits=lambda: [is_hex_id("order_id"), is_hex_id("customer_id"), is_filled("order_status"),
                    is_present("order_purchase_timestamp"), is_present("order_estimated_delivery_date")],
)


def _order_items_rules():
    ids = ["order_id", "product_id", "seller_id"]
    texts = ["order_id", "order_item_id", "product_id", "seller_id"]
    money = ["price", "freight_value"]
    return [
        *[not_null(c) for c in texts],
        *[not_null(c, parsed=True) for c in ["shipping_limit_date", *money]],
        *[not_empty(c) for c in texts],
        *[hex_id(c) for c in ids],
        digits_only("order_item_id"),
        parses("shipping_limit_date", "datetime"),
        *[parses(c, "decimal") for c in money],
        out_of_range("price", "> 0", F.col("price") <= 0),
    ]


ORDER_ITEMS = s.EntitySpec(
    name="order_items",
    separator=",",
    fields=(
        s.stripped("order_id"),
        s.trimmed("order_item_id"),
        s.stripped("product_id"),
        s.stripped("seller_id"),
        s.timestamp("shipping_limit_date"),
        s.decimal("price"),
        s.decimal("freight_value"),
    ),
    keys=("order_id", "order_item_id"),
    hashed=(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
    ),
    order=(("product_id", FIRST), ("seller_id", FIRST)),
    rules=_order_items_rules,
    key_tests=2,
    admits=lambda: [is_hex_id("order_id"), is_digits("order_item_id"), is_hex_id("product_id"), is_hex_id("seller_id"),
                    is_present("shipping_limit_date"), is_present("price"), is_present("freight_value")],
)


def _order_payments_rules():
    numbers = ["payment_sequential", "payment_installments"]
    return [
        *[not_null(c) for c in ["order_id", "payment_type"]],
        *[not_null(c, parsed=True) for c in [*numbers, "payment_value"]],
        *[not_empty(c) for c in ["order_id", "payment_type"]],
        hex_id("order_id"),
        *[parses(c, "numeric") for c in numbers],
        parses("payment_value", "decimal"),
        one_of("payment_type", PAYMENT_TYPES, "payment type"),
        *[out_of_range(c, ">= 1", F.col(c) < 1) for c in numbers],
        out_of_range("payment_value", "> 0", (F.col("payment_value") <= 0) & (F.col("payment_type") != "voucher")),
    ]


ORDER_PAYMENTS = s.EntitySpec(
    name="order_payments",
    separator=",",
    fields=(
        s.stripped("order_id"),
        s.integer("payment_sequential"),
        s.stripped("payment_type"),
        s.integer("payment_installments"),
        s.decimal("payment_value"),
    ),
    keys=("order_id", "payment_sequential"),
    hashed=("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
    order=(("payment_type", FIRST),),
    rules=_order_payments_rules,
    key_tests=2,
    admits=lambda: [is_hex_id("order_id"), is_present("payment_sequential"), is_filled("payment_type"),
                    is_present("payment_installments"), is_present("payment_value")],
)


def _order_reviews_rules():
    ids = ["review_id", "order_id"]
    dates = ["review_creation_date", "review_answer_timestamp"]
    return [
        *[not_null(c) for c in ids],
        *[not_null(c, parsed=True) for c in ["review_score", *dates]],
        *[not_empty(c) for c in ids],
        *[hex_id(c) for c in ids],
        parses("review_score", "numeric"),
        out_of_range("review_score", "1-5", ~F.col("review_score").between(1, 5)),
        *[parses(c, "datetime") for c in dates],
    ]


# The order id is not hashed: the same review on two orders counts as an exact copy.
ORDER_REVIEWS = s.EntitySpec(
    name="order_reviews",
    separator="|",
    quoted_source=True,
    fields=(
        s.stripped("review_id"),
        s.stripped("order_id"),
        s.tinyint("review_score"),
        s.stripped("review_comment_title", store=text.empty_to_null),
        s.stripped("review_comment_message", store=text.empty_to_null),
        s.any_timestamp("review_creation_date"),
        s.any_timestamp("review_answer_timestamp"),
    ),
    keys=("review_id",),
    hashed=(
        "review_id", "review_score", "review_comment_title", "review_comment_message",
        "review_creation_date", "review_answer_timestamp",
    ),
    order=(("review_creation_date", LAST), ("review_answer_timestamp", LAST), ("order_id", FIRST)),
    rules=_order_reviews_rules,
    key_tests=1,
    admits=lambda: [is_hex_id("review_id"), is_hex_id("order_id"), is_present("review_score"),
                    is_present("review_creation_date"), is_present("review_answer_timestamp")],
)


def _products_rules():
    sizes = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    lengths = ["product_name_lenght", "product_description_lenght", "product_photos_qty"]
    return [
        not_null("product_id"),
        not_empty("product_id"),
        hex_id("product_id"),
        *[parses(c, "numeric", rejects=False) for c in lengths],
        *[parses(c, "numeric", rejects=False, parsed=f"{c}__parsed") for c in sizes],
        *[out_of_range(c, "> 0; stored as NULL", F.col(f"{c}__parsed") <= 0) for c in sizes],
    ]


PRODUCTS = s.EntitySpec(
    name="products",
    separator=",",
    fields=(
        s.stripped("product_id"),
        s.Field("product_category_name", lambda c: F.coalesce(text.empty_to_null(text.strip_quotes(c)), F.lit("")),
                store=text.empty_to_null),
        s.integer("product_name_lenght"),
        s.integer("product_description_lenght"),
        s.integer("product_photos_qty"),
        s.positive_integer("product_weight_g"),
        s.positive_integer("product_length_cm"),
        s.positive_integer("product_height_cm"),
        s.positive_integer("product_width_cm"),
    ),
    keys=("product_id",),
    hashed=(
        "product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    ),
    order=(("product_category_name", FIRST),),
    rules=_products_rules,
    admits=lambda: [is_hex_id("product_id")],
)


def _sellers_rules():
    names = ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]
    return [
        *[not_null(c) for c in names],
        *[not_empty(c) for c in names],
        hex_id("seller_id"),
        zip_code("seller_zip_code_prefix"),
        state_code("seller_state"),
    ]


SELLERS = s.EntitySpec(
    name="sellers",
    separator="|",
    quoted_source=True,
    fields=(
        s.stripped("seller_id"),
        s.stripped("seller_zip_code_prefix"),
        s.normalised("seller_city"),
        s.normalised("seller_state"),
    ),
    keys=("seller_id",),
    hashed=("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    order=(("seller_zip_code_prefix", FIRST), ("seller_city", FIRST)),
    rules=_sellers_rules,
    admits=lambda: [is_hex_id("seller_id"), is_zip_code("seller_zip_code_prefix"), is_filled("seller_city"),
                    is_state_code("seller_state")],
)


def _geolocation_rules():
    texts = ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"]
    spots = ["geolocation_lat", "geolocation_lng"]
    return [
        *[not_null(c) for c in texts],
        *[not_null(c, parsed=True) for c in spots],
        *[not_empty(c) for c in texts],
        zip_code("geolocation_zip_code_prefix"),
        state_code("geolocation_state"),
        *[parses(c, "decimal") for c in spots],
    ]


def geolocation(strict_order: bool = False) -> s.EntitySpec:
    """One spot per zip. NULL coordinates sort last, so a bad row cannot cost a zip its good one;
    ``strict_order`` sorts them first, as a plain ascending sort would."""
    nulls = FIRST if strict_order else LAST
    return s.EntitySpec(
        name="geolocation",
        separator="|",
        quoted_source=True,
        fields=(
            s.stripped("geolocation_zip_code_prefix"),
            s.decimal("geolocation_lat", 10, 7, quoted=True),
            s.decimal("geolocation_lng", 10, 7, quoted=True),
            s.unquoted_normalised("geolocation_city"),
            s.unquoted_normalised("geolocation_state"),
        ),
        keys=("geolocation_zip_code_prefix",),
        hashed=(
            "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
            "geolocation_city", "geolocation_state",
        ),
        order=(("geolocation_lat", nulls), ("geolocation_lng", nulls), ("geolocation_city", FIRST)),
        rules=_geolocation_rules,
        admits=lambda: [is_zip_code("geolocation_zip_code_prefix"), is_present("geolocation_lat"),
                        is_present("geolocation_lng"), is_filled("geolocation_city"),
                        is_state_code("geolocation_state")],
        surplus_issue=ISSUES["surplus_zip"],
    )


GEOLOCATION = geolocation()


def _translation_rules():
    names = ["product_category_name", "product_category_name_english"]
    return [*[not_null(c) for c in names], *[not_empty(c) for c in names]]


TRANSLATION = s.EntitySpec(
    name="product_category_name_translation",
    separator="|",
    quoted_source=True,
    fields=(s.stripped("product_category_name"), s.stripped("product_category_name_english")),
    keys=("product_category_name",),
    hashed=("product_category_name", "product_category_name_english"),
    order=(("product_category_name_english", FIRST),),
    rules=_translation_rules,
    admits=lambda: [is_filled("product_category_name"), is_filled("product_category_name_english")],
)

ENTITIES = {
    e.name: e
    for e in (
        CUSTOMERS, ORDERS, ORDER_ITEMS, ORDER_PAYMENTS, ORDER_REVIEWS, PRODUCTS, SELLERS, GEOLOCATION, TRANSLATION,
    )
}
