"""Measures over the two facts, grouped by any dimension columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions import text
from sparkmart.functions.numbers import ratio

CREDIT_CARD_KEY = 1


@dataclass(frozen=True)
class Part:
    """One ingredient of a measure.

    With ``combine`` ``sum``, ``rows`` aggregates the fact rows of a group. With ``orders``, ``rows`` is a test and the orders with a row
    that passes it are counted. With ``distinct``, ``rows`` aggregates the rows of one order and different values are counted.
    """

    rows: Column
    combine: str = "sum"


def _days(column: str) -> dict[str, Part]:
    return {f"sum_{column}": Part(F.sum(column)), f"n_{column}": Part(F.count(column))}


def _mean(column: str) -> Column:
    return ratio(F.col(f"sum_{column}"), F.col(f"n_{column}"))


def sales_parts() -> dict[str, Part]:
    variance = F.col("delivery_vs_estimate_days")
    return {
        "revenue": Part(F.sum("total_value")),
        "price": Part(F.sum("price")),
        "freight": Part(F.sum("freight_value")),
        "n_price": Part(F.count("price")),
        "n_freight": Part(F.count("freight_value")),
        "items": Part(F.count("*")),
        "orders": Part(F.lit(True), "orders"),
        # an order belongs to one customer, so one value per order is enough
        "customers": Part(F.max("customer_key"), "distinct"),
        "on_time_rows": Part(F.count_if(variance <= 0)),
        "very_early": Part(variance < -7, "orders"),
        "on_time": Part(variance.between(-7, 0), "orders"),
        "slightly_late": Part(variance.between(1, 7), "orders"),
        "very_late": Part(variance > 7, "orders"),
        "scored": Part(F.col("review_score").isNotNull(), "orders"),
        **_days("purchase_to_delivery_days"),
        **_days("delivery_vs_estimate_days"),
        **_days("purchase_to_approval_hours"),
        **_days("carrier_to_delivery_days"),
        **_days("review_score"),
    }


def payment_parts() -> dict[str, Part]:
    card = F.col("payment_type_key") == CREDIT_CARD_KEY
    return {
        "paid": Part(F.sum("payment_value")),
        "card_paid": Part(F.sum(F.when(card, F.col("payment_value")))),
        "card_installments": Part(F.sum(F.when(card, F.col("payment_installments")))),
        "n_installments": Part(F.count(F.when(card, F.col("payment_installments")))),
    }


@dataclass(frozen=True)
class Measure:
    name: str
    uses: Sequence[str]
    value: Column


def sales_measures() -> list[Measure]:
    c = F.col
    return [
        Measure("total_revenue", ["revenue"], c("revenue")),
        Measure("total_orders", ["orders"], c("orders")),
        Measure("avg_order_value", ["revenue", "orders"], ratio(c("revenue"), c("orders"))),
        Measure("total_items_sold", ["items"], c("items")),
        Measure("avg_item_price", ["price", "n_price"], ratio(c("price"), c("n_price"))),
        Measure("avg_freight_value", ["freight", "n_freight"], ratio(c("freight"), c("n_freight"))),
        Measure("freight_share", ["freight", "revenue"], ratio(c("freight"), c("revenue"))),
        Measure(
            "on_time_delivery_rate",
            ["on_time_rows", "n_delivery_vs_estimate_days"],
            ratio(c("on_time_rows"), c("n_delivery_vs_estimate_days")),
        ),
        Measure("avg_delivery_days", list(_days("purchase_to_delivery_days")), _mean("purchase_to_delivery_days")),
        Measure("avg_sla_variance_days", list(_days("delivery_vs_estimate_days")), _mean("delivery_vs_estimate_days")),
        Measure("avg_approval_hours", list(_days("purchase_to_approval_hours")), _mean("purchase_to_approval_hours")),
        Measure("avg_last_mile_days", list(_days("carrier_to_delivery_days")), _mean("carrier_to_delivery_days")),
        Measure("orders_very_early", ["very_early"], c("very_early")),
        Measure("orders_on_time", ["on_time"], c("on_time")),
        Measure("orders_slightly_late", ["slightly_late"], c("slightly_late")),
        Measure("orders_very_late", ["very_late"], c("very_late")),
        Measure("avg_review_score", list(_days("review_score")), _mean("review_score")),
        Measure("unique_customers", ["customers"], c("customers")),
        Measure("review_submission_rate", ["scored", "orders"], ratio(c("scored"), c("orders"))),
    ]


def payment_measures() -> list[Measure]:
    c = F.col
    return [
        Measure("total_transaction_value", ["paid"], c("paid")),
        Measure(
            "avg_credit_card_installments",
            ["card_installments", "n_installments"],
            ratio(c("card_installments"), c("n_installments")),
        ),
        Measure("credit_card_share", ["card_paid", "paid"], ratio(c("card_paid"), c("paid"))),
    ]


def _evaluate(
    fact: DataFrame,
    measures: Sequence[Measure],
    parts: Mapping[str, Part],
    names: Sequence[str],
    by: Sequence[str],
    order_key: str = "order_id",
) -> DataFrame:
    known = {m.name: m for m in measures}
    chosen = [known[n] for n in names]
    used = {p: parts[p] for m in chosen for p in m.uses}
    sums = {n: p.rows for n, p in used.items() if p.combine == "sum"}
    tests = {n: p.rows for n, p in used.items() if p.combine == "orders"}
    values = {n: p.rows for n, p in used.items() if p.combine == "distinct"}
    if tests or values:
        grouped = _of_orders(fact, tests, values, by, order_key)
        if sums:
            # Sums shrink inside the tasks to a row a group, so they stay out of the rows that are moved for each order. A group
            # has a row on either side; without fact rows there is none of sums.
            whole = fact.groupBy(*by, F.lit(0).alias("_group")).agg(*[rows.alias(n) for n, rows in sums.items()]).drop("_group")
            both = grouped.unionByName(whole, allowMissingColumns=True)
            grouped = both.groupBy(*by).agg(*[F.max(n).alias(n) for n in used])
    else:
        grouped = fact.groupBy(*by).agg(*[rows.alias(n) for n, rows in sums.items()])
    return grouped.select(*by, *[m.value.alias(m.name) for m in chosen])


def _of_orders(
    fact: DataFrame, tests: Mapping[str, Column], values: Mapping[str, Column], by: Sequence[str], order_key: str
) -> DataFrame:
    """Per group the orders that pass each test and the different values of orders.

    Grouped by order first: distinct orders become rows to count, and no row is copied once per distinct column. A row that is moved
    has the order's id, packed if it is text, a bit for each test, and the values.
    """
    named = F.col(order_key)
    order = text.packed_id(named).alias(order_key) if fact.schema[order_key].dataType == T.StringType() else named
    bits = {n: 1 << i for i, n in enumerate(tests)}
    passed = [F.when(test, F.lit(bits[n])).otherwise(F.lit(0)) for n, test in tests.items()]
    mask = [F.bit_or(reduce(Column.bitwiseOR, passed)).alias("_passed")] if passed else []
    per_order = fact.groupBy(*by, order).agg(*mask, *[rows.alias(n) for n, rows in values.items()])
    counts = [F.count_if(F.col("_passed").bitwiseAND(F.lit(b)) > 0).alias(n) for n, b in bits.items()]
    return per_order.groupBy(*by).agg(*counts, *[F.count_distinct(F.col(n)).alias(n) for n in values])


def measure(fact: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sales measures, one row per group of ``by`` (columns of the fact or joined dimensions)."""
    return _evaluate(fact, sales_measures(), sales_parts(), names, by)


def payment_measure(fact: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Payment measures, one row per group of ``by``."""
    return _evaluate(fact, payment_measures(), payment_parts(), names, by)


def true_customers(fact: DataFrame, dim_customer: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct people rather than distinct order-level customer ids."""
    people = dim_customer.select("customer_key", "customer_unique_id")
    # reduce to distinct customers per group first, then look up who they are
    seen = fact.select(*by, "customer_key").distinct()
    return seen.join(people, "customer_key", "left").groupBy(*by).agg(
        F.count_distinct("customer_unique_id").alias("true_customers")
    )


def share_of_total(
    fact: DataFrame, over: str, by: Sequence[str] = (), name: str = "order_share"
) -> DataFrame:
    """Distinct orders per (by, over) divided by the distinct orders of the same ``by`` whatever ``over``."""
    per_value = measure(fact, ["total_orders"], [*by, over])
    total = measure(fact, ["total_orders"], by).withColumnRenamed("total_orders", "_all")
    if by:
        joined = per_value.join(total, list(by))
    else:
        joined = per_value.withColumn("_all", total.scalar())
    return joined.withColumn(name, ratio(F.col("total_orders"), F.col("_all"))).drop("_all")


def top_values(grouped: DataFrame, label: str, value: str, k: int = 5) -> DataFrame:
    """The k largest groups; the label settles ties."""
    return grouped.orderBy(F.desc(value), F.asc(label)).limit(k)


def axis_maxima(grouped: DataFrame, axes: Mapping[str, str], headroom: float = 1.15) -> DataFrame:
    """Largest group value with headroom, one row per axis; ``axes`` maps measure to axis name."""
    tops = grouped.agg(*[(F.max(F.col(m).cast("double")) * headroom).alias(m) for m in axes])
    lines = [F.struct(F.lit(axis).alias("axis"), F.col(m).alias("axis_max")) for m, axis in axes.items()]
    return tops.select(F.inline(F.array(*lines)))


def in_window(fact: DataFrame, dim_date: DataFrame, first: int = 201701, last: int = 201808) -> DataFrame:
    """Fact rows whose purchase month lies in the report window, with the month columns."""
    months = dim_date.where(F.col("year_month_key").between(first, last)).select(
        F.col("date_key").alias("purchase_date_key"), "year_month_key", "month_year_short"
    )
    return fact.join(F.broadcast(months), "purchase_date_key")
