import datetime as dt
from decimal import Decimal

from sparkmart.plans import facts, mart
from sparkmart.plans.entities import ENTITIES
from sparkmart.plans.load import Warehouse
from sparkmart.plans.lookups import order_status_dim
from sparkmart.sources import buckets, tables

SALES = ["order_id", "order_item_id", "purchase_date_key", "customer_key", "seller_key", "product_key", "order_status_key", "price", "review_score"]
DAYS = {n: dt.datetime(2024, 1, n, tzinfo=dt.timezone.utc) for n in (1, 2)}
TABLES = {
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, order_approved_at timestamp, "
    "order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp",
    "order_items": "order_id string, order_item_id string, product_id string, seller_id string, price decimal(10,2), freight_value decimal(10,2)",
    "order_reviews": "review_id string, order_id string, review_score byte, review_creation_date timestamp, review_answer_timestamp timestamp",
}


def _order(name, month, status="delivered"):
    return (name, "c1", status, *[dt.datetime(2017, month, d, tzinfo=dt.timezone.utc) for d in (1, 1, 2, 5, 9)])


def _line(order, product="p1", price="10.00"):
    return (order, "1", product, "s1", Decimal(price), Decimal("1.00"))


def _review(name, order, score):
    return (name, order, score, DAYS[1], DAYS[1])


#: Rows as (row, deleted, day of the load that touched them). On day 2 o2 moves from March to April, o3 is undone, o4 comes, o5's line has
#: another price, review r1 goes from o1 to o4, and product p9, of o6, becomes known; o7 stays.
CLEANSED = {
    1: {
        "orders": [(_order(f"o{i}", 3 if i == 2 else i), False, 1) for i in (1, 2, 3, 5, 6, 7)],
        "order_items": [(_line(f"o{i}", "p9" if i == 6 else "p1"), False, 1) for i in (1, 2, 3, 4, 5, 6, 7)],
        "order_reviews": [(_review("r1", "o1", 5), False, 1), (_review("r2", "o7", 3), False, 1)],
    },
    2: {
        "orders": [*[(_order(f"o{i}", i), i == 3, 1 if i > 4 or i == 1 else 2) for i in (1, 3, 4, 5, 6, 7)], (_order("o2", 4), False, 2)],
        "order_items": [*[(_line(f"o{i}", "p9" if i == 6 else "p1"), False, 1) for i in (1, 2, 3, 4, 6, 7)], (_line("o5", price="11.00"), False, 2)],
        "order_reviews": [(_review("r1", "o4", 4), False, 2), (_review("r2", "o7", 3), False, 1)],
    },
}


def test_a_load_refreshes_the_months_it_changes(spark, tmp_path, rows):
    w = Warehouse(spark, str(tmp_path / "house"), monthly_facts=True)
    dates = mart.date_dim(spark, dt.date(2017, 1, 1), dt.date(2017, 12, 31))
    statuses = order_status_dim(spark)
    customers = spark.createDataFrame([("c1", 1)], "customer_id string, customer_key long")
    sellers = spark.createDataFrame([("s1", 1)], "seller_id string, seller_key long")
    products = spark.createDataFrame([("p1", 1), ("p9", 2)], "product_id string, product_key long")
    manifests = {}
    for day, state in CLEANSED.items():
        sources = {}
        for name, content in state.items():
            frame = spark.createDataFrame([(*r, deleted, DAYS[d]) for r, deleted, d in content], f"{TABLES[name]}, is_deleted boolean, updated_at timestamp")
            w._run("CLEANSED", name, None, lambda f=frame, n=name: {"rows_processed": 0, "version": tables.write_version(f, w.root, f"cleansed/{n}")})
            sources[name] = w.cleansed(name)
        known = products.where("product_key <= " + str(day))

        def build(own, known=known):
            return mart.fact_sales(own["order_items"], own["orders"], own["order_reviews"], dates, customers, sellers, known, statuses)

        members = [(mart.DIM_CUSTOMER, customers, "orders"), (mart.DIM_SELLER, sellers, "order_items"), (mart.DIM_PRODUCT, known, "order_items")]
        w._load_monthly("fact_sales", sources, members, build, ["order_item_id"], None, {"dim_date": dates}, {"order_reviews": "review_id"})
        assert rows(w.mart("fact_sales"), *SALES) == rows(build(sources), *SALES)
        version = tables.current_version(spark, w.root, "mart/fact_sales")
        manifests[version] = buckets.manifest(spark, w.root, "mart/fact_sales", version)
    first, second = manifests
    assert set(manifests[first]) == {"m201701", "m201703", "m201705", "m201706", "m201707"}
    assert {b for b, v in manifests[second].items() if v == second} == {"m201701", "m201704", "m201705", "m201706"}
    assert {b for b, v in manifests[second].items() if v == first} == {"m201707"}
    seen = facts.recall(spark, w.root, "mart/fact_sales", second)
    now, moves = dict(seen[0]), {"order_reviews": "review_id"}
    assert w._can_refresh(seen, now, members, {"dim_date": dates}, moves)
    assert not w._can_refresh(seen, now | {"dim_date": now["dim_date"] + 1}, members, {"dim_date": dates}, moves)
    assert not w._can_refresh(seen, now | {"dim_product": 0}, members, {"dim_date": dates}, moves)
    assert not w._can_refresh((seen[0], {"order_reviews": "gone"}), now, members, {"dim_date": dates}, moves)


FACT = "order_id string, line int, purchase_date_key int, v string"


def _ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "order_id string")


def test_only_months_of_changed_orders_are_written(spark, tmp_path, rows):
    root = str(tmp_path)
    first = [(f"o{i}", k, 20170101 + 100 * (i % 12), "a") for i in range(240) for k in range(2)] + [("hot", k, 20170305, "a") for k in range(400)]
    v1 = facts.build(spark, root, "f", spark.createDataFrame(first, FACT))["version"]
    # o0 goes from January to December, o2 (March, as the hot order) is gone, o999 is new in a month of its own, without a date o998.
    fresh = [("o0", 0, 20171224, "b"), ("o999", 0, 20200101, "b"), ("o998", 0, 0, "b")]
    done = facts.refresh(
        spark, root, "f", v1, _ids(spark, "o0", "o2", "o998", "o999"),
        lambda ids: spark.createDataFrame(fresh, FACT).join(ids, "order_id", "left_semi"), ["line"])
    now = buckets.manifest(spark, root, "f", done["version"])
    assert {b for b, v in now.items() if v == done["version"]} == {"m201701", "m201703", "m201712", "m202001", "m0"}
    assert done["rows_processed"] == 3
    want = [r for r in first if r[0] not in ("o0", "o2")] + fresh
    columns = ["order_id", "line", "purchase_date_key", "v"]
    assert rows(buckets.read(spark, root, "f", done["version"]), *columns) == sorted(want, key=repr)
    assert buckets.read(spark, root, "f", v1).count() == len(first)


def test_months_and_facts_may_vanish_and_come_back(spark, tmp_path, rows):
    root, columns = str(tmp_path), ["order_id", "line", "purchase_date_key", "v"]
    v1 = facts.build(spark, root, "f", spark.createDataFrame([("a", 1, 20170101, "x"), ("b", 1, 20170201, "x")], FACT))["version"]
    none = spark.createDataFrame([], FACT)
    v2 = facts.refresh(spark, root, "f", v1, _ids(spark, "a"), lambda ids: none, ["line"])["version"]
    assert set(buckets.manifest(spark, root, "f", v2)) == {"m201702"}
    v3 = facts.refresh(spark, root, "f", v2, _ids(spark, "b"), lambda ids: none, ["line"])["version"]
    assert buckets.manifest(spark, root, "f", v3) == {} and buckets.read(spark, root, "f", v3) is None
    same = facts.refresh(spark, root, "f", v2, _ids(spark), lambda ids: none, ["line"])
    assert same["buckets_written"] == 0 and buckets.manifest(spark, root, "f", same["version"]) == buckets.manifest(spark, root, "f", v2)
    v4 = facts.refresh(spark, root, "f", v3, _ids(spark, "c"), lambda ids: spark.createDataFrame([("c", 1, 20170301, "y")], FACT), ["line"])["version"]
    assert rows(buckets.read(spark, root, "f", v4), *columns) == [("c", 1, 20170301, "y")]


def test_rows_past_their_mark_name_the_orders(spark):
    day = lambda n: dt.datetime(2024, 1, n, tzinfo=dt.timezone.utc)
    orders = spark.createDataFrame([("o1", "c1", day(1)), ("o2", "c2", day(2)), ("o3", "c3", day(1)), (None, "c3", day(2))], "order_id string, customer_id string, updated_at timestamp")
    reviews = spark.createDataFrame([("r1", "o4", day(2)), ("r2", "o5", day(1))], "review_id string, order_id string, updated_at timestamp")
    former = spark.createDataFrame([("r1", "o6"), ("r2", "o7")], "review_id string, order_id string")
    people = spark.createDataFrame([("c1", 1), ("c3", 2), ("UNKNOWN", -1)], "customer_id string, customer_key long")
    mark = int(day(1).timestamp() * 1e6)
    marks = {"orders": mark, "order_reviews": mark, "dim_customer": 1}
    details = {"orders": orders, "order_reviews": reviews}
    found = facts.changed_orders(details, marks, [(mart.DIM_CUSTOMER, people, "orders")], {"order_reviews": ("review_id", former)})
    assert sorted(r.order_id for r in found.collect()) == ["o2", "o3", "o4", "o6"]
    assert facts.newest_update(orders) == int(day(2).timestamp() * 1e6) and facts.newest_update(orders.limit(0)) == 0
    assert facts.changed_orders({"orders": orders}, {}).count() == 3
    assert set(ENTITIES["order_reviews"].keys) == {"review_id"}
