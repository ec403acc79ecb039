from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gallery.base import Tables
from gallery.standins import RAW
from sparkmart.operators import integrity, quality, stats
from sparkmart.plans import entities, spec

A, B, C, D = ("a" * 32, "b" * 32, "c" * 32, "d" * 32)
GOOD = ("delivered", "2018-01-01 10:00:00", "2018-01-01 11:00:00", "2018-01-02 00:00:00", "2018-01-05 00:00:00",
        "2018-01-09 00:00:00")


def orders(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in entities.ORDERS.columns))


def found(spark, rows):
    clean = spec.normalise(orders(spark, rows), entities.ORDERS)
    return {(r["column_name"], r["issue"]): r["affected_row_count"] for r in spec.issues(clean, entities.ORDERS).collect()}


def kept(spark, rows):
    return spec.cleansed(orders(spark, rows), entities.ORDERS).collect()


def test_valid_rows_raise_nothing(spark):
    rows = [(A, B, *GOOD), (f' "{C}" ', B, *GOOD)]
    assert found(spark, rows) == {}
    assert sorted(r["order_id"] for r in kept(spark, rows)) == [A, C]


def test_each_bad_key_is_named_and_rejected(spark):
    rows = [(None, B, *GOOD), ("  ", B, *GOOD), ("A" * 32, B, *GOOD), ("a" * 31, B, *GOOD)]
    issues = found(spark, rows)
    assert issues[("order_id", "NULL value")] == 1
    assert issues[("order_id", "Empty string after cleansing")] == 1
    assert issues[("order_id", "Invalid length or format: expected 32-char lowercase hex")] == 2
    assert kept(spark, rows) == []


def test_warnings_are_counted_but_kept(spark):
    row = (A, B, "on_hold", GOOD[1], "soon", GOOD[3], "2017-12-31 00:00:00", GOOD[5])
    issues = found(spark, [row])
    assert issues == {
        ("order_status", "Invalid value: not a recognized order status"): 1,
        ("order_approved_at", "Invalid datetime format"): 1,
        ("order_delivered_customer_date", "Delivered before purchase"): 1,
    }
    stored = kept(spark, [row])[0]
    assert stored["order_approved_at"] is None and stored["order_status"] == "on_hold"


def test_two_null_keys_count_as_conflict(spark):
    issues = found(spark, [(None, B, *GOOD), (None, B, *GOOD)])
    assert issues[("order_id", "Duplicate order_id: conflicting content — investigate before reload")] == 1


def test_exact_copy_and_conflict_are_told_apart(spark):
    other = ("shipped", *GOOD[1:])
    issues = found(spark, [(A, B, *GOOD), (A, B, *GOOD), (C, B, *GOOD), (C, D, *other)])
    assert issues[("order_id", "Duplicate order_id: identical content, deduplicated silently")] == 1
    assert issues[("order_id", "Duplicate order_id: conflicting content — investigate before reload")] == 1


def test_unparsed_purchase_never_becomes_the_first_row(spark):
    bad = (A, B, "delivered", "yesterday", *GOOD[2:])
    assert kept(spark, [bad, (A, C, *GOOD)])[0]["customer_id"] == C


def test_same_review_on_two_orders_is_an_exact_copy(spark):
    review = entities.ORDER_REVIEWS
    row = (A, C, "5", '""', "fine", "2018-01-01", "2018-01-02 00:00:00")
    df = spark.createDataFrame([row, (A, B, *row[2:])], ", ".join(f"{c} string" for c in review.columns))
    clean = spec.normalise(df, review)
    assert [tuple(r) for r in spec.issues(clean, review).collect()] == [
        ("review_id", "Duplicate review_id: identical content, deduplicated silently", 1)]
    stored = spec.admit(clean, review).collect()
    assert [(r["order_id"], r["review_comment_title"]) for r in stored] == [(B, None)]


def test_zip_keeps_its_good_coordinate(spark):
    schema = ", ".join(f"{c} string" for c in entities.GEOLOCATION.columns)
    df = spark.createDataFrame(
        [("01000", "n/a", "-46.6", "São Paulo", "SP"), ("01000", "-23.5", "-46.6", "sao paulo", "sp")], schema)
    assert [str(r["geolocation_lat"]) for r in spec.cleansed(df, entities.GEOLOCATION).collect()] == ["-23.5000000"]
    assert spec.cleansed(df, entities.geolocation(strict_order=True)).count() == 0


def test_product_sizes_of_zero_are_stored_as_null(spark):
    product = entities.PRODUCTS
    df = spark.createDataFrame(
        [(A, "  ", "10", "x", None, "0", "-3", "7", "1O")], ", ".join(f"{c} string" for c in product.columns))
    clean = spec.normalise(df, product)
    issues = {(r["column_name"], r["issue"]) for r in spec.issues(clean, product).collect()}
    assert issues == {
        ("product_description_lenght", "Invalid numeric format"), ("product_width_cm", "Invalid numeric format"),
        ("product_weight_g", "Invalid range: must be > 0; stored as NULL"),
        ("product_length_cm", "Invalid range: must be > 0; stored as NULL"),
    }
    row = spec.admit(clean, product).first()
    assert (row["product_category_name"], row["product_weight_g"], row["product_height_cm"]) == (None, None, 7)


@pytest.mark.parametrize("entity", list(RAW))
def test_admission_is_the_absence_of_rejecting_findings(spark, entity):
    e = entities.ENTITIES[entity]
    clean = Tables(spark, "/root/testdata/sf0.001").clean(entity)
    short = F.lit(True)
    for test in e.admits():
        short = short & F.coalesce(test, F.lit(False))
    assert clean.where(short != quality.passes(e.rules())).count() == 0


def skewed(spark):
    """A third of the rows carry one key, half of those are copies of one content."""
    third = F.col("id") % 3 == 0
    return spark.range(30000).select(
        F.when(third, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string")).alias("k"),
        F.when(third & (F.col("id") % 2 == 0), F.lit(0)).otherwise(F.col("id") % 7).alias("v"),
    ).withColumn("row_hash", F.md5(F.concat_ws("|", "k", F.col("v").cast("string"))))


def test_duplicate_classes_against_brute_force(spark):
    df = skewed(spark)
    groups = defaultdict(list)
    for r in df.collect():
        groups[r["k"]].append((r["v"], r["row_hash"]))
    want = {}
    for key, members in groups.items():
        if len(members) > 1:
            first = min(members)[1]
            same = sum(h == first for _, h in members)
            want[key] = (len(members), same - 1, len(members) - same)
    order = [("v", "first")]
    for covers in (True, False):
        got = quality.duplicate_classes(df, ["k"], order, hash_has_order=covers)
        assert {r["k"]: (r["row_count"], r["type_a"], r["type_b"]) for r in got.collect()} == want


def test_first_row_is_reduced_before_the_shuffle(spark):
    df = skewed(spark)
    picked = quality.pick_first(df, ["k"], [("v", "last")])
    want = {}
    for r in df.collect():
        want[r["k"]] = min(want.get(r["k"], (99, "")) or (99, ""), (r["v"], r["row_hash"]))
    assert {r["k"]: (r["v"], r["row_hash"]) for r in picked.collect()} == want
    plan = picked._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("Exchange hashpartitioning(k") < partial, "the partial limit must sit below the exchange"


def test_rules_take_one_scan(spark):
    df = Tables(spark, "/root/testdata/sf0.001").clean("order_items")
    plan = quality.run_rules(df, entities.ORDER_ITEMS.rules())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_bad_keys_are_dropped_before_the_shuffle(spark):
    plan = spec.admit(
        spec.normalise(orders(spark, [(A, B, *GOOD)]).repartition(2), entities.ORDERS), entities.ORDERS
    )._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.rindex("RLIKE"), "the key test must sit below the window"


def test_exact_median_even_and_odd(spark):
    for values, want in (([1, 2, 3, 4], 2.5), ([5, 1, 9], 5.0), ([2000000, 1], 1000000.5), ([7], 7.0), ([3] * 9, 3.0)):
        df = spark.createDataFrame([(v,) for v in values], "v int").select(F.col("v").cast("decimal(10,2)").alias("v"))
        assert stats.median_of(df, "v").first()["median"] == want
    assert stats.median_of(df.limit(0), "v").first()["median"] is None


def test_orphans_count_null_keys(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("b",), ("b",)], "p string")
    assert integrity.orphan_rows(child, parent, "k", "p", "n").first()["n"] == 3


def test_repeated_values_are_written_out(spark):
    df = spark.createDataFrame(
        [("o", "x"), ("o", "y"), ("o", "x"), ("o", None), ("p", "x"), ("p", "x"), (None, "x"), (None, "y")], "order_id string, payment_type string")
    got = stats.repeated_values(df, "order_id", "payment_type").collect()
    assert [tuple(r) for r in got] == [("o", 2, "x x2, y x1", 4)]


def test_max_length_rule(spark):
    df = spark.createDataFrame([("x" * 101,), ("x" * 100 + "  ",)], "city string")
    assert quality.run_rules(df, [quality.max_length("city", 100)]).first()["affected_row_count"] == 1
