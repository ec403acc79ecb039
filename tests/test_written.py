"""What queries write and move besides their result."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gallery import refresh, runs, star
from gallery.base import Tables
from gallery.refresh import _TwoLoads
from sparkmart.functions import text
from sparkmart.operators import quality, skew
from sparkmart.plans import entities, mart, measures, spec
from sparkmart.plans.lookups import order_status_dim
from sparkmart.sources.tables import freed


@pytest.fixture
def tables(spark, tmp_path):
    lines = [(i // 3, i % 3 + 1, i % 7, i % 5, float(i % 50 + 1), 1000.0 + i, 0.04, 0.02, "N", "F", dt.datetime(1997, 1, 1 + i % 28)) for i in range(60)]
    schema = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
              "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(i, i % 4, "F", 9000.0 + i, dt.datetime(1997, 1, 1 + i % 28), "2-HIGH") for i in range(20)]
    spark.createDataFrame(
        orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    docs = [(i, f'text "{i}",\nsecond line', "en") for i in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    return Tables(spark, str(tmp_path))


def test_raw_rows_are_read_without_being_written(tables):
    assert tables.raw("order_items").count() == 60
    assert not os.path.exists(tables.place("table_raw_order_items"))


def test_marks_and_hashes_are_not_ranked(tables):
    clean = tables.clean("order_items")
    admitted = spec.admit(clean, entities.ORDER_ITEMS)
    plan = admitted._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window ["):]
    assert "sha2" in plan and "sha2" not in below and "__given" not in below
    both = admitted.join(clean.select("order_id", "order_item_id", "row_hash"), ["order_id", "order_item_id", "row_hash"])
    assert both.count() == admitted.count() == 60


def test_more_documents_make_more_files(tables, monkeypatch):
    monkeypatch.setattr(runs, "_FILE_ROWS", 15)
    for name, files in (("read_quoted_files", None), ("read_quoted_splits", 2)):
        path = runs._notes(tables, f"{name}_test", files)
        counts = [tables.spark.read.options(header=True, multiLine=True, escape='"').csv(f"{path}/{f}").count() for f in os.listdir(path) if f.endswith(".csv")]
        assert sum(counts) == 40 and max(counts) <= 15
    read = runs._hashed(runs.delimited.read_quoted(tables.spark, path, runs._NOTES))
    assert read.where("note_length = length(concat('text \"', doc_id, '\", second line'))").count() == 40


def test_a_refresh_publishes_only_what_its_fact_reads(tables):
    loads = _TwoLoads(tables, ("orders",))
    assert [*loads.before] == [*loads.after] == ["orders"]
    assert not os.path.exists(tables.place("table_cleansed_order_items"))


def _shuffles(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


def test_keys_with_one_row_are_neither_ranked_nor_shuffled(tables, monkeypatch):
    clean = tables.clean("orders")
    rows = tables.counted("orders")
    assert not _shuffles(rows) and "Window" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(rows.collect()) == sorted(spec.admit(clean, entities.ORDERS).collect()) and rows.count() == 20
    assert not _shuffles(tables.counted("order_payments"))


def test_repeated_keys_are_still_ranked(spark):
    order = [("a", "last"), ("b", "first")]
    rows = spark.createDataFrame(
        [("x", 2, "p"), ("x", 1, "q"), ("x", 1, None), ("y", None, "r"), (None, 5, "s"), (None, 4, "t"), ("z", 3, "u"), ("z", 3, "u")], "k string, a int, b string")
    found = quality.repeated_keys(rows, ["k"])
    assert len(found) == 3 and quality.repeated_keys(rows, ["k"], limit=2) is None
    kept = sorted(map(repr, quality.pick_first(rows, ["k"], order).collect()))
    assert len(kept) == 4
    for given in (found, [r[0] for r in rows.selectExpr("xxhash64(k)").collect()]):
        assert sorted(map(repr, quality.pick_first(rows, ["k"], order, given).collect())) == kept
    assert sorted(map(repr, quality.pick_first(rows, ["k"], order, within=["k"]).collect())) == kept


def test_items_are_moved_once_to_be_ranked_and_to_meet_their_orders(tables):
    small = [tables.table("orders").limit(0)]  # dimensions hold the unknown member alone
    items = tables.dealt("order_items", "order_id", {})
    names = {d.name: d.empty(tables.spark, star.NOW) for d in (mart.DIM_CUSTOMER, mart.DIM_SELLER, mart.DIM_PRODUCT)}
    dates = mart.covering_date_dim(small[0], "o_orderdate")
    tables.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert len(_shuffles(items.join(tables.counted("orders", ("order_id",)), "order_id"))) == 2
    finally:
        tables.spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sales = mart.fact_sales(items, tables.counted("orders", ("order_id",)), tables.counted("order_reviews"), dates, *names.values(), order_status_dim(tables.spark))
    plain = mart.fact_sales(*[tables.cleansed(e) for e in ("order_items", "orders", "order_reviews")], dates, *names.values(), order_status_dim(tables.spark))
    assert sorted(map(repr, sales.collect())) == sorted(map(repr, plain.collect())) and sales.count() == 60
    # an order with many items leaves its items to be dealt by their whole key
    assert "hashpartitioning(order_id#" in _shuffles(items)[0] and "order_item_id" not in _shuffles(items)[0]
    assert "order_item_id" in _shuffles(tables.dealt("order_items", "order_id", {"a": 3}))[0]


def test_ids_are_packed_without_loss(spark):
    values = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "", " ", "a" * 16, "a" * 31, "a" * 33, "São Paulo", "\0" * 17, "\0" * 16, None]
    rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", text.packed_id(F.col("v")).alias("p"))
    found = rows.select("v", "p", text.unpacked_id(F.col("p")).alias("u")).collect()
    assert all(r["u"] == r["v"] for r in found) and len({r["p"] and bytes(r["p"]) for r in found}) == len(values)
    assert all(r["p"] is None or bytes(r["p"]) == text.packed_value(r["v"]) for r in found)
    assert len(found[0]["p"]) == 16


def test_distinct_orders_are_grouped_by_packed_ids(spark):
    fact = spark.createDataFrame([("0" * 32, "a"), ("0" * 32, "a"), ("o1", "a"), (None, "a"), ("o1", "b")], "order_id string, kind string")
    plan = measures.measure(fact, ["total_orders"], ["kind"])
    assert "unhex" in plan._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, plan.collect())) == [("a", 3), ("b", 1)]


def test_sums_are_not_moved_for_each_order(spark):
    schema = ("kind string, order_id string, customer_key long, price decimal(10,2), freight_value decimal(10,2), total_value decimal(10,2), "
              "delivery_vs_estimate_days int, review_score byte")
    lines = [("a", "o1", 1, 10, 1, 11, -9, 5), ("a", "o1", 1, 20, 2, 22, 8, None), ("a", "o2", 1, 5, 0, 5, 0, None), ("a", None, 2, None, 1, None, None, 2),
             (None, "o1", 1, 7, 1, 8, 3, None), ("b", "o3", None, 1, 1, 2, None, None)]
    fact = spark.createDataFrame([tuple(Decimal(v) if 2 < i < 6 and v is not None else v for i, v in enumerate(r)) for r in lines], schema)
    names = ["total_revenue", "total_orders", "total_items_sold", "avg_item_price", "on_time_delivery_rate", "orders_very_early", "orders_on_time",
             "orders_slightly_late", "orders_very_late", "unique_customers", "review_submission_rate"]
    found = measures.measure(fact, names, ["kind"])
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    per_order = [line for line in plan if "bit_or(" in line]
    assert len(per_order) == 1 and "sum(" not in per_order[0] and "count(" not in per_order[0]
    want = {
        "a": (38, 3, 4, 35 / 3, 2 / 3, 1, 1, 0, 1, 2, 2 / 3),
        "b": (2, 1, 1, 1.0, None, 0, 0, 0, 0, 0, 0.0),
        None: (8, 1, 1, 7.0, 0.0, 0, 0, 1, 0, 1, 0.0),
    }
    for r in found.collect():
        assert [None if v is None else pytest.approx(float(v)) for v in r[1:]] == [v if v is None else float(v) for v in want[r["kind"]]]
    assert found.count() == 3
    assert tuple(measures.measure(fact, ["total_orders", "total_items_sold", "unique_customers"]).first()) == (4, 6, 2)
    assert tuple(measures.measure(fact.limit(0), ["total_orders", "total_revenue", "unique_customers"]).first()) == (0, None, 0)
    assert measures.measure(fact.limit(0), names, ["kind"]).count() == 0


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_a_published_table_leaves_no_shuffled_rows(tables):
    spark, key = tables.spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = _shuffle_files(spark)
    table = tables.published("dealt", lambda: tables.cleansed("order_items").repartition(5, "seller_id"))
    assert not _shuffle_files(spark) - before
    assert table.count() == 60 and spark.conf.get(key, None) is None
    spark.conf.set(key, "false")
    with freed(spark), freed(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == "false"
    spark.conf.unset(key)


def test_items_are_moved_with_packed_ids_and_ranked_by_text(spark, tables):
    raw = [("0" * 32, "1", p, "f" * 32, "1997-01-01 00:00:00", price, "1.00")
           for p, price in (("b" * 32, "3.00"), ("B" * 32, "2.00"), ("b" * 31, "4.00"))] + [("1" * 32, "1", "a" * 32, s, "1997-01-01 00:00:00", "5.00", "1.00") for s in ("2" * 32, "1" * 32)]
    names = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]
    clean = spec.normalise(spark.createDataFrame(raw, names), entities.ORDER_ITEMS)
    plain = spec.admit(clean, entities.ORDER_ITEMS)
    ids = ("order_id", "product_id", "seller_id")
    moved = spec.admit(clean, entities.ORDER_ITEMS, within=("order_id",), packed=ids)
    shown = moved.withColumns({c: text.unpacked_id(F.col(c)) for c in ids})
    assert sorted(map(repr, shown.collect())) == sorted(map(repr, plain.collect())) and shown.first()["seller_id"] == "1" * 32
    dealt = tables.dealt("order_items", "order_id", {}, ids[1:])
    below = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert below[below.index("RepartitionByExpression"):].count("unhex") >= 3
    assert tables.dealt("order_items", "order_id", {"a": 3}, ids[1:]).schema["product_id"].dataType.typeName() == "string"


def test_few_members_go_to_the_tasks(spark, monkeypatch, rows):
    left = spark.createDataFrame([("a" * 32, 1), ("b", 2), (None, 3), ("c", 4)], "k string, v int")
    right = spark.createDataFrame([("a" * 32, 7), ("b", 8), (None, 9)], "k string, n int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("left", "inner"):
            sent = skew.lookup_join(left, right, "k", how, (), ["v"])
            assert not _shuffles(sent)
            with monkeypatch.context() as m:
                m.setattr(skew, "SENT", 2)
                dealt = skew.lookup_join(left, right, "k", how, (), ["v"])
            assert _shuffles(dealt) and rows(sent, "k", "v", "n") == rows(dealt, "k", "v", "n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_refresh_looks_for_heavy_values_in_written_tables_only(tables, monkeypatch, rows):
    asked = []

    def recorded(df, columns, *more):
        asked.append(df._jdf.queryExecution().optimizedPlan().toString())
        return skew.hot_values(df, columns, *more)

    monkeypatch.setattr(refresh, "hot_values", recorded)

    def build(own, dims, hot):
        assert set(hot) == {"order_id", "customer_id"}
        day = F.date_format("order_purchase_timestamp", "yyyyMMdd").cast("int").alias("purchase_date_key")
        orders = text.packed(mart.live(own["orders"]), "order_id").select("order_id", day)
        lines = text.packed(mart.live(own["order_items"]), "order_id").select("order_id", "order_item_id", "price")
        return lines.join(orders, "order_id").withColumn("order_id", text.unpacked_id(F.col("order_id")))

    columns = {"order_items": ["order_id"], "orders": ["customer_id"]}
    found = refresh._refreshed(tables, "fact_small", build, [], ("orders", "order_items"), "order_item_id", False, columns)
    assert asked and not any("Join" in plan for plan in asked)
    assert found.count() == 60
