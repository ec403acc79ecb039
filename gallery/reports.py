"""Measures, KPI cards and report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gallery.base import Tables, example
from gallery.oracle import with_ctes
from gallery.star import Star
from sparkmart.functions import dates, text
from sparkmart.functions.numbers import ratio
from sparkmart.operators.skew import hot_values, salted_join
from sparkmart.plans import kpi, measures
from sparkmart.plans.lookups import order_status_dim, payment_type_dim

# The same measures over the sales fact, written for the checking engine.
_SALES_SQL = {
    "total_revenue": "sum(total_value)",
    "total_orders": "count(DISTINCT order_id)",
    "avg_order_value": "cast(sum(total_value) AS double) / count(DISTINCT order_id)",
    "total_items_sold": "count(*)",
    "avg_item_price": "cast(sum(price) AS double) / count(price)",
    "avg_freight_value": "cast(sum(freight_value) AS double) / count(freight_value)",
    "freight_share": "cast(sum(freight_value) AS double) / cast(nullif(sum(total_value), 0) AS double)",
    "on_time_delivery_rate": "cast(count(*) FILTER (WHERE delivery_vs_estimate_days <= 0) AS double) "
                             "/ nullif(count(delivery_vs_estimate_days), 0)",
    **{name: f"cast(sum({c}) AS double) / nullif(count({c}), 0)" for name, c in {
        "avg_delivery_days": "purchase_to_delivery_days", "avg_sla_variance_days": "delivery_vs_estimate_days",
        "avg_approval_hours": "purchase_to_approval_hours", "avg_last_mile_days": "carrier_to_delivery_days",
        "avg_review_score": "review_score"}.items()},
    "orders_very_early": "count(DISTINCT CASE WHEN delivery_vs_estimate_days < -7 THEN order_id END)",
    "orders_on_time": "count(DISTINCT CASE WHEN delivery_vs_estimate_days BETWEEN -7 AND 0 THEN order_id END)",
    "orders_slightly_late": "count(DISTINCT CASE WHEN delivery_vs_estimate_days BETWEEN 1 AND 7 THEN order_id END)",
    "orders_very_late": "count(DISTINCT CASE WHEN delivery_vs_estimate_days > 7 THEN order_id END)",
    "unique_customers": "count(DISTINCT customer_key)",
    "review_submission_rate": "cast(count(DISTINCT CASE WHEN review_score IS NOT NULL THEN order_id END) AS double) "
                              "/ count(DISTINCT order_id)",
}
_PAYMENT_SQL = {
    "total_transaction_value": "sum(payment_value)",
    "avg_credit_card_installments": "cast(sum(payment_installments) FILTER (WHERE payment_type_key = 1) AS double) "
                                    "/ nullif(count(*) FILTER (WHERE payment_type_key = 1), 0)",
    "credit_card_share": "cast(sum(payment_value) FILTER (WHERE payment_type_key = 1) AS double) "
                         "/ cast(nullif(sum(payment_value), 0) AS double)",
}
_MONEY = ("total_revenue", "total_transaction_value")


def _select(sql: dict[str, str], names: Sequence[str]) -> str:
    return ", ".join(
        f"cast({sql[n]} AS double) AS {n}" if n in _MONEY else f"{sql[n]} AS {n}" for n in names
    )


def _money_as_double(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in _MONEY else F.col(c) for c in df.columns])


_MONTHS = "JOIN dim_date ON date_key = purchase_date_key"


@example("K-01, K-02, K-03, A-10, E-18, F-32, J-01", """
SELECT year(o_orderdate) * 100 + month(o_orderdate) AS year_month_key,
       cast(sum(cast(l_extendedprice AS decimal(12,2))) AS double) AS total_revenue,
       count(DISTINCT l_orderkey) AS total_orders,
       cast(sum(cast(l_extendedprice AS decimal(12,2))) AS double) / count(DISTINCT l_orderkey) AS avg_order_value
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def monthly_revenue(t: Tables):
    """Revenue, orders and average order value per month, straight from orders and lines.

    Lines are reduced to one row per order before they meet the orders, so the join moves orders
    instead of lines and distinct orders become plain rows.
    """
    lines = t.table("lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("revenue"))
    orders = t.table("orders").select("o_orderkey", dates.month_key(F.col("o_orderdate")).alias("year_month_key"))
    per_month = lines.join(orders, lines.l_orderkey == orders.o_orderkey).groupBy("year_month_key").agg(
        F.sum("revenue").cast("double").alias("total_revenue"), F.count("*").alias("total_orders"))
    return per_month.withColumn("avg_order_value", ratio(F.col("total_revenue"), F.col("total_orders")))


@example("K-01..K-12, K-14..K-20, A-05, A-07, F-32", with_ctes(f"""
SELECT year_month_key, {_select(_SALES_SQL, list(_SALES_SQL))} FROM fact_sales {_MONTHS} GROUP BY 1"""))
def sales_measures_by_month(t: Tables):
    """All sales measures per purchase month."""
    star = Star(t)
    months = star.dates().select(F.col("date_key").alias("purchase_date_key"), "year_month_key")
    fact = star.sales().join(F.broadcast(months), "purchase_date_key")
    return _money_as_double(measures.measure(fact, list(_SALES_SQL), ["year_month_key"]))


@example("K-01..K-12, K-14..K-20", with_ctes(f"SELECT {_select(_SALES_SQL, list(_SALES_SQL))} FROM fact_sales"))
def sales_measures_total(t: Tables):
    """All sales measures over the whole fact."""
    return _money_as_double(measures.measure(Star(t).sales(), list(_SALES_SQL)))


def _described(fact: DataFrame, dimension: DataFrame, key: str, label: str) -> DataFrame:
    """Fact rows, their order ids packed, with one label of a dimension; members with many rows, like the unknown one, are spread over tasks."""
    hot = hot_values(fact, [key])[key]
    packed = fact.withColumn("order_id", text.packed_id(F.col("order_id")))
    return salted_join(packed, dimension.select(key, label), key, "inner", hot, ["order_id", "order_item_id"])


_CATEGORY = ["total_revenue", "total_items_sold", "avg_item_price", "freight_share", "total_orders"]


@example("K-01, K-04, K-05, K-07, O-05", with_ctes(f"""
SELECT product_category_name_english, {_select(_SALES_SQL, _CATEGORY)} FROM fact_sales JOIN dim_product USING (product_key)
GROUP BY 1 ORDER BY total_revenue DESC, 1 LIMIT 5"""))
def top_categories(t: Tables):
    """The five categories with most revenue."""
    star = Star(t)
    fact = _described(star.sales(), star.products(), "product_key", "product_category_name_english")
    grouped = measures.measure(fact, _CATEGORY, ["product_category_name_english"])
    return _money_as_double(measures.top_values(grouped, "product_category_name_english", "total_revenue"))


@example("K-09, K-19, O-05", with_ctes(f"""
SELECT customer_state_name, {_select(_SALES_SQL, ['unique_customers', 'avg_delivery_days', 'total_orders'])}
FROM fact_sales JOIN dim_customer USING (customer_key) GROUP BY 1 ORDER BY unique_customers DESC, 1 LIMIT 5"""))
def top_states(t: Tables):
    """The five states with most customers."""
    star = Star(t)
    fact = _described(star.sales(), star.customers(), "customer_key", "customer_state_name")
    grouped = measures.measure(fact, ["unique_customers", "avg_delivery_days", "total_orders"], ["customer_state_name"])
    return measures.top_values(grouped, "customer_state_name", "unique_customers")


@example("K-13, A-17", with_ctes("""
SELECT status_name, count(DISTINCT order_id) AS total_orders,
       cast(count(DISTINCT order_id) AS double) / (SELECT count(DISTINCT order_id) FROM fact_sales) AS order_share
FROM fact_sales JOIN dim_order_status USING (order_status_key) GROUP BY 1"""))
def status_share(t: Tables):
    """Orders per status and their share of all orders."""
    names = order_status_dim(t.spark).select("order_status_key", "status_name")
    fact = Star(t).sales().join(F.broadcast(names), "order_status_key")
    return measures.share_of_total(fact, "status_name")


@example("K-13, A-17", with_ctes(f"""
SELECT a.*, cast(total_orders AS double) / everything AS order_share FROM (
    SELECT year_month_key, status_name, count(DISTINCT order_id) AS total_orders
    FROM fact_sales JOIN dim_order_status USING (order_status_key) {_MONTHS} GROUP BY 1, 2) a
JOIN (SELECT year_month_key, count(DISTINCT order_id) AS everything FROM fact_sales {_MONTHS} GROUP BY 1) USING (year_month_key)"""))
def status_share_by_month(t: Tables):
    """Share of each status within its month."""
    star = Star(t)
    names = order_status_dim(t.spark).select("order_status_key", "status_name")
    months = star.dates().select(F.col("date_key").alias("purchase_date_key"), "year_month_key")
    fact = star.sales().join(F.broadcast(names), "order_status_key").join(F.broadcast(months), "purchase_date_key")
    return measures.share_of_total(fact, "status_name", ["year_month_key"])


@example("K-21..K-23, A-18", with_ctes(f"""
SELECT payment_type_name, {_select(_PAYMENT_SQL, list(_PAYMENT_SQL))} FROM fact_payments JOIN dim_payment_type USING (payment_type_key)
GROUP BY 1"""))
def payment_measures_by_type(t: Tables):
    """Payment measures per payment type."""
    names = payment_type_dim(t.spark).select("payment_type_key", "payment_type_name")
    fact = Star(t).payments().join(F.broadcast(names), "payment_type_key")
    return _money_as_double(measures.payment_measure(fact, list(_PAYMENT_SQL), ["payment_type_name"]))


@example("K-21..K-23", with_ctes(f"""
SELECT year_month_key, {_select(_PAYMENT_SQL, list(_PAYMENT_SQL))} FROM fact_payments {_MONTHS} GROUP BY 1"""))
def payment_measures_by_month(t: Tables):
    """Payment measures per purchase month."""
    star = Star(t)
    months = star.dates().select(F.col("date_key").alias("purchase_date_key"), "year_month_key")
    fact = star.payments().join(F.broadcast(months), "purchase_date_key")
    return _money_as_double(measures.payment_measure(fact, list(_PAYMENT_SQL), ["year_month_key"]))


@example("K-19, A-02", with_ctes(f"""
SELECT year_month_key, count(DISTINCT customer_unique_id) AS true_customers
FROM fact_sales {_MONTHS} LEFT JOIN dim_customer USING (customer_key) GROUP BY 1"""))
def true_customers_by_month(t: Tables):
    """People rather than customer ids per month."""
    star = Star(t)
    months = star.dates().select(F.col("date_key").alias("purchase_date_key"), "year_month_key")
    fact = star.sales().join(F.broadcast(months), "purchase_date_key")
    return measures.true_customers(fact, star.customers(), ["year_month_key"])


def _tops(rows: list[tuple[str, str, str]]) -> str:
    return with_ctes(" UNION ALL ".join(
        f"SELECT '{axis}' AS axis, max(cast(v AS double)) * 1.15 AS axis_max FROM (SELECT {value} AS v FROM {source} GROUP BY {label})"
        for axis, value, (source, label) in ((a, v, s.split("|")) for a, v, s in rows)))


_BY_PRODUCT = "fact_sales JOIN dim_product USING (product_key)|product_category_name_english"
_BY_STATE = "fact_sales JOIN dim_customer USING (customer_key)|customer_state_name"


@example("K-26, A-16", _tops([
    ("categories_revenue", _SALES_SQL["total_revenue"], _BY_PRODUCT),
    ("items_sold", _SALES_SQL["total_items_sold"], _BY_PRODUCT),
    ("freight_share", _SALES_SQL["freight_share"], _BY_PRODUCT),
    ("avg_item_price", _SALES_SQL["avg_item_price"], _BY_PRODUCT),
    ("avg_delivery_days", _SALES_SQL["avg_delivery_days"], _BY_STATE),
    ("states_by_customers", _SALES_SQL["unique_customers"], _BY_STATE),
    ("orders_by_status", _SALES_SQL["total_orders"], "fact_sales JOIN dim_order_status USING (order_status_key)|status_name"),
    ("payment_type", _PAYMENT_SQL["total_transaction_value"],
     "fact_payments JOIN dim_payment_type USING (payment_type_key)|payment_type_name"),
]))
def axis_maxima(t: Tables):
    """Upper ends for the eight chart axes."""
    star, spark = Star(t), t.spark
    sales = star.sales()
    products = _described(sales, star.products(), "product_key", "product_category_name_english")
    states = _described(sales, star.customers(), "customer_key", "customer_state_name")
    statuses = sales.join(F.broadcast(order_status_dim(spark).select("order_status_key", "status_name")), "order_status_key")
    types = star.payments().join(
        F.broadcast(payment_type_dim(spark).select("payment_type_key", "payment_type_name")), "payment_type_key")

    by_product = measures.measure(
        products, ["total_revenue", "total_items_sold", "freight_share", "avg_item_price"], ["product_category_name_english"])
    by_state = measures.measure(states, ["avg_delivery_days", "unique_customers"], ["customer_state_name"])
    by_status = measures.measure(statuses, ["total_orders"], ["status_name"])
    by_type = measures.payment_measure(types, ["total_transaction_value"], ["payment_type_name"])
    axes = (
        (by_product, {"total_revenue": "categories_revenue", "total_items_sold": "items_sold",
                      "freight_share": "freight_share", "avg_item_price": "avg_item_price"}),
        (by_state, {"avg_delivery_days": "avg_delivery_days", "unique_customers": "states_by_customers"}),
        (by_status, {"total_orders": "orders_by_status"}),
        (by_type, {"total_transaction_value": "payment_type"}),
    )
    parts = [measures.axis_maxima(grouped, names) for grouped, names in axes]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


_WINDOW = (199601, 199912)


def _compact(c: str, prefix: str, digits: int) -> str:
    small = f"format('{{:,.{digits}f}}', round({c}, {digits}))"
    return (
        f"'{prefix}' || CASE WHEN {c} >= 1000000 THEN printf('%.1f', round({c} / 1000000, 1)) || 'M' "
        f"WHEN {c} >= 1000 THEN printf('%.1f', round({c} / 1000, 1)) || 'K' ELSE {small} END"
    )


_LABEL = {
    "money0": lambda c: _compact(c, "R$ ", 0), "money1": lambda c: _compact(c, "R$ ", 1),
    "count": lambda c: _compact(c, "", 0), "percent": lambda c: f"printf('%.1f', round({c} * 100, 1)) || '%'",
    "one": lambda c: f"printf('%.1f', round({c}, 1))", "two": lambda c: f"printf('%.2f', round({c}, 2))",
}


def _card_sql(card: kpi.Card, value: str, source: str) -> str:
    keep = "value > 0" if card.eligible == "positive" else "value IS NOT NULL"
    cm, pm = "cm.value", "coalesce(pm.value, 0)"
    rounded = f"(round({cm}, 3) - round({pm}, 3))"
    diff = rounded if card.change == "points" else f"({cm} - {pm})"
    delta = {
        "percent": f"({cm} - {pm}) / nullif(pm.value, 0)", "percent_abs": f"({cm} - {pm}) / nullif(abs(pm.value), 0)",
        "points": rounded, "score": f"({cm} - {pm})",
    }[card.change]
    size = {
        "points": f"printf('%.1f', round(abs({delta}) * 100, 1)) || ' pp'",
        "score": f"printf('%.2f', round(abs({delta}), 2)) || ' pt'",
    }.get(card.change, f"printf('%.1f', round(abs({delta}) * 100, 1)) || '%'")
    better, worse = ("good", "bad") if card.good == "up" else ("bad", "good")
    feeling = "'neutral'" if card.good == "neutral" else (
        f"CASE WHEN {cm} > {pm} THEN '{better}' WHEN {cm} < {pm} THEN '{worse}' ELSE 'neutral' END")
    monthly = (
        f"(SELECT *, row_number() OVER (ORDER BY year_month_key DESC) AS place FROM (SELECT year_month_key, "
        f"month_year_short, cast({value} AS double) AS value FROM {source} {_MONTHS} "
        f"WHERE year_month_key BETWEEN {_WINDOW[0]} AND {_WINDOW[1]} GROUP BY 1, 2) WHERE {keep})"
    )
    return (
        f"SELECT '{card.name}' AS kpi, cm.month_year_short AS cm_month, cm.value AS cm_value, pm.month_year_short AS pm_month, "
        f"pm.value AS pm_value, {delta} AS delta, CASE WHEN {diff} > 0 THEN 'up' ELSE 'down' END AS direction, "
        f"{feeling} AS sentiment, cm.month_year_short || ' · ' || {_LABEL[card.label](cm)} AS cm_label, "
        f"pm.month_year_short || ' · ' || {_LABEL[card.label]('pm.value')} AS pm_label, "
        f"CASE WHEN {diff} > 0 THEN '▲ ' ELSE '▼ ' END || coalesce({size}, '') AS badge "
        f"FROM {monthly} cm LEFT JOIN {monthly} pm ON pm.place = 2 WHERE cm.place = 1"
    )


@example("K-25, K-27, W-07, F-33, F-34", with_ctes(" UNION ALL ".join(
    [_card_sql(c, _SALES_SQL[c.name], "fact_sales") for c in kpi.SALES_CARDS]
    + [_card_sql(c, _PAYMENT_SQL[c.name], "fact_payments") for c in kpi.PAYMENT_CARDS])))
def kpi_cards(t: Tables):
    """Last month against the one before for seventeen KPIs, inside a report window."""
    star = Star(t)
    return kpi.kpi_cards(star.sales(), star.payments(), star.dates(), _WINDOW)


_HEADLINES = ["total_revenue", "total_orders", "avg_order_value", "avg_item_price", "avg_freight_value", "total_items_sold",
              "unique_customers"]


@example("K-24, F-33", with_ctes("SELECT year_month_key, " + ", ".join(
    f"{_LABEL['money1' if n.startswith('avg') or n == 'total_revenue' else 'count'](f'cast({n} AS double)')} AS {n}_formatted"
    for n in _HEADLINES) + f" FROM (SELECT year_month_key, {_select(_SALES_SQL, _HEADLINES)} FROM fact_sales {_MONTHS} GROUP BY 1)"))
def formatted_measures(t: Tables):
    """Text forms of the headline measures per month."""
    star = Star(t)
    months = star.dates().select(F.col("date_key").alias("purchase_date_key"), "year_month_key")
    fact = star.sales().join(F.broadcast(months), "purchase_date_key")
    return kpi.formatted_measures(measures.measure(fact, _HEADLINES, ["year_month_key"]))


@example("F-21, F-22, F-31, P-10", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       date_diff('day', o_orderdate + INTERVAL 659 MINUTE, l_shipdate + INTERVAL 661 MINUTE) AS days,
       date_diff('hour', o_orderdate + INTERVAL 659 MINUTE, l_shipdate + INTERVAL 661 MINUTE) AS hours,
       left(o_orderpriority, length(o_orderpriority) - 3) AS head,
       starts_with(o_orderpriority, '1-') OR ends_with(o_orderpriority, 'LOW') AS extreme
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def boundary_differences(t: Tables):
    """Days and hours by boundaries crossed, 10:59 to 11:01, and text cuts."""
    start = F.col("o_orderdate") + F.expr("INTERVAL '659' MINUTE")
    end = F.col("l_shipdate") + F.expr("INTERVAL '661' MINUTE")
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    orders = t.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority")
    priority = F.col("o_orderpriority")
    hot = hot_values(lines, ["l_orderkey"])["l_orderkey"]
    return salted_join(lines, orders, "l_orderkey", "inner", hot, ["l_linenumber", "l_partkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        dates.days_between(start, end).alias("days"), dates.hours_between(start, end).alias("hours"),
        F.left(priority, F.length(priority) - 3).alias("head"),
        (priority.startswith("1-") | priority.endswith("LOW")).alias("extreme"),
    )


