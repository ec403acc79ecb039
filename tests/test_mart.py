import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparkmart.plans import kpi, mart, measures
from sparkmart.plans.lookups import order_status_dim, payment_type_dim

T = dt.datetime


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def star(spark):
    orders = frame(spark, [
        ("o1", "c1", "delivered", T(2018, 1, 1, 23, 59), T(2018, 1, 2, 0, 1), T(2018, 1, 3), T(2018, 1, 5), T(2018, 1, 9), False),
        ("o2", "c9", "on_hold", T(2019, 5, 1), None, None, None, T(2019, 6, 1), False),
        ("o3", "c1", "shipped", T(2018, 2, 1), None, T(2018, 2, 2), None, T(2018, 2, 9), True),
        ("o4", "c2", "delivered", T(2018, 2, 1), T(2018, 2, 1, 1), T(2018, 2, 2), T(2018, 2, 20), T(2018, 2, 9), False),
    ], "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
       "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
       "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz, is_deleted boolean")
    items = frame(spark, [
        ("o1", "1", "p1", "s1", Decimal("10.00"), Decimal("1.50"), False),
        ("o1", "02", "p9", "s1", Decimal("20.00"), Decimal("2.50"), False),
        ("o1", "3", "p1", "s1", Decimal("5.00"), Decimal("0.00"), True),
        ("o2", "1", "p1", "s9", Decimal("7.00"), Decimal("1.00"), False),
        ("o3", "1", "p1", "s1", Decimal("7.00"), Decimal("1.00"), False),
        ("o4", "1", "p1", "s1", Decimal("30.00"), Decimal("3.00"), False),
        ("o8", "1", "p1", "s1", Decimal("7.00"), Decimal("1.00"), False),
    ], "order_id string, order_item_id string, product_id string, seller_id string, price decimal(10,2), "
       "freight_value decimal(10,2), is_deleted boolean")
    reviews = frame(spark, [
        ("r1", "o1", 5, T(2018, 1, 6), T(2018, 1, 7), False), ("r2", "o1", 1, T(2018, 1, 8), T(2018, 1, 9), False),
        ("r3", "o1", 3, T(2018, 1, 9), T(2018, 1, 9), True),
    ], "review_id string, order_id string, review_score short, review_creation_date timestamp_ntz, "
       "review_answer_timestamp timestamp_ntz, is_deleted boolean")
    payments = frame(spark, [
        ("o1", 1, "credit_card", 4, Decimal("30.00"), False), ("o1", 2, "voucher", 1, Decimal("4.00"), False),
        ("o4", 1, "pix", 1, Decimal("33.00"), False), ("o3", 1, "boleto", 1, Decimal("8.00"), False),
        ("o4", 2, "credit_card", 2, Decimal("1.00"), True),
    ], "order_id string, payment_sequential int, payment_type string, payment_installments int, "
       "payment_value decimal(10,2), is_deleted boolean")
    dates = mart.date_dim(spark, dt.date(2018, 1, 1), dt.date(2018, 12, 31))
    customers = frame(spark, [(1, "c1", "u1", True), (2, "c2", "u1", False)],
                      "customer_key long, customer_id string, customer_unique_id string, is_deleted boolean")
    sellers = frame(spark, [(1, "s1")], "seller_key long, seller_id string")
    products = frame(spark, [(1, "p1")], "product_key long, product_id string")
    sales = mart.fact_sales(items, orders, reviews, dates, customers, sellers, products, order_status_dim(spark),
                            {"order_id": ["o1"], "seller_id": ["s1"]})
    paid = mart.fact_payments(payments, orders, dates, customers, payment_type_dim(spark))
    return {"sales": sales.cache(), "paid": paid.cache(), "dates": dates, "customers": customers}


def test_fact_grain_and_unknown_members(star):
    rows = {(r["order_id"], r["order_item_id"]): r for r in star["sales"].collect()}
    assert set(rows) == {("o1", 1), ("o1", 2), ("o2", 1), ("o4", 1)}
    known, lost = rows[("o1", 2)], rows[("o2", 1)]
    assert (known["product_key"], known["seller_key"], known["customer_key"]) == (-1, 1, 1)
    assert (lost["seller_key"], lost["customer_key"], lost["order_status_key"]) == (-1, -1, -1)
    assert known["total_value"] == Decimal("22.50")


def test_dates_outside_the_dimension(star):
    lost = star["sales"].where("order_id = 'o2'").first()
    assert (lost["purchase_date_key"], lost["estimated_delivery_date_key"]) == (0, 0)
    assert lost["carrier_handoff_date_key"] is None and lost["actual_delivery_date_key"] is None


def test_lead_times_and_latest_live_review(star):
    row = star["sales"].where("order_id = 'o1'").first()
    assert row["purchase_to_approval_hours"] == 1
    assert (row["purchase_to_delivery_days"], row["delivery_vs_estimate_days"], row["carrier_to_delivery_days"]) == (4, -4, 2)
    assert row["review_score"] == 1


def test_payments_follow_live_orders(star):
    rows = {(r["order_id"], r["payment_sequential"]): r["payment_type_key"] for r in star["paid"].collect()}
    assert rows == {("o1", 1): 1, ("o1", 2): 3, ("o4", 1): -1}


def test_sums_are_kept(star):
    assert measures.measure(star["sales"], ["total_revenue"]).first()[0] == Decimal("75.00")


def test_measures(star):
    names = ["total_orders", "total_items_sold", "avg_order_value", "on_time_delivery_rate", "orders_very_late",
             "orders_on_time", "unique_customers", "review_submission_rate", "avg_review_score"]
    row = measures.measure(star["sales"], names).first()
    assert tuple(row) == (3, 4, 25.0, 2 / 3, 1, 1, 3, 1 / 3, 1.0)
    card = measures.payment_measure(star["paid"], ["total_transaction_value", "avg_credit_card_installments", "credit_card_share"])
    assert tuple(card.first()) == (Decimal("67.00"), 4.0, 30 / 67)
    assert measures.true_customers(star["sales"], star["customers"]).first()[0] == 1


def test_no_sales_means_blank_ratios(star):
    row = measures.measure(star["sales"].where("false"), ["avg_order_value", "total_orders", "freight_share"]).first()
    assert tuple(row) == (None, 0, None)


def test_distinct_orders_do_not_copy_rows(star):
    plan = measures.measure(star["sales"], ["total_orders", "orders_on_time", "unique_customers"], ["order_status_key"])
    assert "Expand" not in plan._jdf.queryExecution().executedPlan().toString()


def test_small_published_dimensions_are_broadcast(spark, star, tmp_path):
    for name in ("dates", "customers"):
        star[name].write.parquet(str(tmp_path / name))
    dates, customers = (spark.read.parquet(str(tmp_path / name)) for name in ("dates", "customers"))
    orders = spark.createDataFrame([("o", "c", "x", T(2018, 1, 1), None, None, None, None)],
                                   "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
                                   "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
                                   "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
    reviews = spark.createDataFrame([], "review_id string, order_id string, review_score short, "
                                        "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz")
    facts = mart.order_facts(orders, reviews, dates, customers, order_status_dim(spark))
    executed = facts._jdf.queryExecution().executedPlan().toString()
    assert executed.count("BroadcastHashJoin") >= 5


def test_date_dim_has_its_range_and_the_unknown_day(spark):
    days = mart.date_dim(spark)
    assert days.count() == 1097
    assert days.where("date_key = 0").first()["month_name"] == "UNKNOWN"
    first = days.where("date_key = 20160101").first()
    assert (first["iso_year"], first["week_of_year"], first["day_of_week"], first["is_weekend"]) == (2015, 53, 6, False)


def test_one_stray_year_does_not_stop_the_date_dimension(spark):
    stamps = spark.createDataFrame([(dt.date(2018, 1, 1),), (dt.date(9999, 12, 31),), (None,)], "d date")
    days = mart.covering_date_dim(stamps, "d")
    assert days.count() == (dt.date(9999, 12, 31) - dt.date(2018, 1, 1)).days + 2
    assert days.where("date_key = 99991231").count() == 1


def test_product_labels(spark):
    products = spark.createDataFrame(
        [("a", "cama_mesa_banho"), ("b", "pc_gamer"), ("c", None), ("d", "nova")], "product_id string, product_category_name string")
    for c in ("name_lenght", "description_lenght", "photos_qty", "weight_g", "length_cm", "height_cm", "width_cm"):
        products = products.withColumn(f"product_{c}", F.lit(1))
    translation = spark.createDataFrame(
        [("cama_mesa_banho", "bed_bath_table", False), ("nova", "new", True)],
        "product_category_name string, product_category_name_english string, is_deleted boolean")
    got = mart.product_source(products, translation).collect()
    assert {r["product_id"]: r["product_category_name_english"] for r in got} == {
        "a": "Bed, Bath & Table", "b": "PC Gaming", "c": "UNKNOWN", "d": "nova"}


def cards(spark, rows, card):
    monthly = spark.createDataFrame(rows, f"year_month_key int, month_year_short string, {card.name} double")
    return kpi.compare_months(kpi.monthly_values(monthly, [card]), [card]).collect()


def test_card_skips_months_that_are_not_eligible(spark):
    card = kpi.Card("total_revenue", "positive", "percent", "up", "money0")
    rows = [(201801, "Jan 2018", 1000.0), (201802, "Feb 2018", 0.0), (201803, "Mar 2018", 1500.0), (201804, "Apr 2018", None)]
    [row] = cards(spark, rows, card)
    assert (row["cm_month"], row["pm_month"], row["badge"], row["sentiment"]) == ("Mar 2018", "Jan 2018", "▲ 50.0%", "good")
    assert (row["cm_label"], row["pm_label"]) == ("Mar 2018 · R$ 1.5K", "Jan 2018 · R$ 1.0K")


def test_no_change_points_down_and_is_neutral(spark):
    card = kpi.Card("total_orders", "positive", "percent", "up", "count")
    [row] = cards(spark, [(201801, "Jan 2018", 5.0), (201802, "Feb 2018", 5.0)], card)
    assert (row["badge"], row["direction"], row["sentiment"]) == ("▼ 0.0%", "down", "neutral")


def test_percent_badge_has_no_sign_and_lower_can_be_better(spark):
    card = kpi.Card("avg_delivery_days", "positive", "percent", "down", "one")
    [row] = cards(spark, [(201801, "Jan 2018", 10.0), (201802, "Feb 2018", 8.0)], card)
    assert (row["badge"], row["sentiment"], row["delta"]) == ("▼ 20.0%", "good", -0.2)


def test_negative_previous_value_uses_its_size(spark):
    card = kpi.Card("avg_sla_variance_days", "any", "percent_abs", "down", "one")
    [row] = cards(spark, [(201801, "Jan 2018", -10.0), (201802, "Feb 2018", -5.0)], card)
    assert (row["badge"], row["sentiment"], row["cm_label"]) == ("▲ 50.0%", "bad", "Feb 2018 · -5.0")


def test_points_and_scores(spark):
    points = kpi.Card("freight_share", "any", "points", "down", "percent")
    [row] = cards(spark, [(201801, "Jan 2018", 0.1504), (201802, "Feb 2018", 0.1496)], points)
    assert (row["badge"], row["sentiment"]) == ("▼ 0.0 pp", "good")
    score = kpi.Card("avg_review_score", "any", "score", "up", "two")
    [row] = cards(spark, [(201801, "Jan 2018", 4.0), (201802, "Feb 2018", 4.126)], score)
    assert (row["badge"], row["cm_label"]) == ("▲ 0.13 pt", "Feb 2018 · 4.13")


def test_first_month_has_no_percentage(spark):
    card = kpi.Card("total_orders", "positive", "percent", "up", "count")
    [row] = cards(spark, [(201801, "Jan 2018", 5.0)], card)
    assert (row["badge"], row["pm_label"], row["pm_value"]) == ("▲ ", None, None)
