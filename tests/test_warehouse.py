import datetime as dt
import hashlib
import os

import pytest

from sparkmart.plans import ledger
from sparkmart.plans.entities import ENTITIES
from sparkmart.plans.load import ConflictingDuplicates, NoSourceBatch, Warehouse
from sparkmart.sources import tables


def h(text):
    return hashlib.md5(text.encode()).hexdigest()


def order(n, customer="c1", status="delivered", bought="2017-02-01 10:59:00"):
    return [h(f"o{n}"), h(customer), status, bought, "2017-02-01 11:01:00", "2017-02-02 00:00:00", "2017-02-05 00:00:00",
            "2017-02-09 00:00:00"]


def base():
    return {
        "customers": [[h("c1"), h("u1"), "01000", "São Paulo", "sp"], [h("c2"), h("u1"), "02000", "Rio", "RJ"]],
        "orders": [order(1), order(2, "c2", "shipped", "2017-03-01 10:00:00"), order(3, "c7")],
        "order_items": [
            [h("o1"), "1", h("p1"), h("s1"), "2017-02-03 00:00:00", "10.00", "1.50"],
            [h("o1"), "2", h("p9"), h("s1"), "2017-02-03 00:00:00", "20.00", "2.50"],
            [h("o2"), "1", h("p1"), h("s1"), "2017-02-03 00:00:00", "5.00", "0.50"],
            [h("o8"), "1", h("p1"), h("s1"), "2017-02-03 00:00:00", "5.00", "0.50"],
        ],
        "order_payments": [[h("o1"), "1", "credit_card", "3", "34.00"], [h("o2"), "1", "voucher", "1", "5.50"]],
        "order_reviews": [
            [h("r1"), h("o1"), "5", "a title", 'said "good",\nthen | left', "2017-02-06 00:00:00", "2017-02-07 00:00:00"],
            [h("r2"), h("o1"), "2", "", "", "2017-02-08 00:00:00", "2017-02-09 00:00:00"],
        ],
        "products": [[h("p1"), "perfumaria", "10", "20", "1", "100", "10", "0", "10"]],
        "sellers": [[h("s1"), "01000", "sao paulo", "SP"]],
        "geolocation": [["01000", "-23.5", "-46.6", "sao paulo", "SP"], ["01000", "-23.4", "-46.6", "São Paulo", "SP"]],
        "product_category_name_translation": [["perfumaria", "perfumery"]],
    }


def write(folder, data):
    """Every entity as a comma file, quoted where the entity's source is."""
    files = {}
    folder.mkdir(exist_ok=True)
    for name, rows in data.items():
        e = ENTITIES[name]

        def cell(value, quoted=e.quoted_source):
            return '"' + value.replace('"', '""') + '"' if quoted else value

        lines = [",".join(e.columns)] + [",".join(cell(v) for v in row) for row in rows]
        path = folder / f"{name}.csv"
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        files[name] = str(path)
    return files


SPAN = {"start": dt.date(2017, 1, 1), "end": dt.date(2018, 12, 31)}


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("house")
    w = Warehouse(spark, str(folder / "root"))
    w.run_full(write(folder / "day1", base()), **SPAN)
    return w, folder


def test_full_run_builds_the_star(house):
    w, _ = house
    sales = {(r["order_id"], r["order_item_id"]): r for r in w.mart("fact_sales").collect()}
    assert set(sales) == {(h("o1"), 1), (h("o1"), 2), (h("o2"), 1)}
    assert sales[(h("o1"), 2)]["product_key"] == -1
    assert sales[(h("o1"), 1)]["review_score"] == 2
    assert sales[(h("o1"), 1)]["purchase_to_approval_hours"] == 1
    assert w.mart("fact_payments").count() == 2
    customers = {r["customer_id"]: r for r in w.mart("dim_customer").collect()}
    assert customers[h("c1")]["customer_state_name"] == "São Paulo"
    assert str(customers[h("c1")]["customer_lat"]) == "-23.5000000"
    assert customers[h("c2")]["customer_lat"] is None and customers["UNKNOWN"]["customer_key"] == -1
    assert w.mart("dim_product").where("product_key > 0").first()["product_category_name_english"] == "Perfumery"


def test_quoted_review_is_one_clean_row(house):
    w, _ = house
    review = w.cleansed("order_reviews").where(f"review_id = '{h('r1')}'").first()
    assert review["review_comment_message"] == "said good, then   left"


def test_ledger_tells_the_run(house):
    w, _ = house
    job = ledger.latest_state(w.log("job_log").withColumnRenamed("start_ts", "load_ts"), "job_run_id", "load_ts").first()
    assert (job["status"], job["pipelines_failed"], job["pipeline_count"]) == ("SUCCESS", 0, 9 + 9 + 8)
    done = ledger.rows_of_newest_job(w.log("load_log"), w.log("job_log")).where("status = 'SUCCESS'")
    assert done.count() == 26
    found = {(r["table_name"], r["issue"]) for r in w.log("dq_log").collect()}
    assert ("products", "Invalid range: must be > 0; stored as NULL") in found
    assert ("geolocation", "Duplicate zip_code_prefix: kept smallest (lat, lng) occurrence") in found


def test_later_days_update_delete_and_bring_back(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "root"))
    e = ENTITIES["orders"]

    def day(number, orders):
        files = write(tmp_path / f"day{number}", {"orders": orders})
        w.load_raw(e, files["orders"])
        return w.load_cleansed(e)

    assert day(1, [order(1), order(2)])["rows_inserted"] == 2
    second = day(2, [order(1, status="shipped"), order(3)])
    assert (second["rows_inserted"], second["rows_updated"], second["rows_deleted"]) == (1, 2, 0)
    assert day(3, [order(1, status="shipped"), order(2), order(3)])["rows_updated"] == 1
    again = day(4, [order(1, status="shipped"), order(2), order(3)])
    assert (again["rows_inserted"], again["rows_updated"]) == (0, 0)
    assert w.cleansed("orders").where("is_deleted").count() == 0


def test_conflict_aborts_and_keeps_the_old_table(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "root"))
    e = ENTITIES["orders"]
    w.load_raw(e, write(tmp_path / "d1", {"orders": [order(1)]})["orders"])
    w.load_cleansed(e)
    w.load_raw(e, write(tmp_path / "d2", {"orders": [order(1), order(1, status="shipped")]})["orders"])
    with pytest.raises(ConflictingDuplicates):
        w.load_cleansed(e)
    assert w.cleansed("orders").count() == 1
    assert w.log("error_log").count() == 1
    assert w.log("dq_log").where("issue LIKE '%conflicting%'").first()["affected_row_count"] == 1
    assert w.log("load_log").where("layer = 'CLEANSED' AND status = 'FAILED'").count() == 1
    # a corrected delivery loads again
    w.load_raw(e, write(tmp_path / "d3", {"orders": [order(1, status="shipped")]})["orders"])
    assert w.load_cleansed(e)["rows_updated"] == 1


def test_missing_source_batch_is_logged(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "root"))
    with pytest.raises(NoSourceBatch):
        w.load_cleansed(ENTITIES["sellers"])
    assert w.log("load_log").where("status = 'FAILED'").count() == 1


def test_failed_job_is_partial(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "root"))
    files = write(tmp_path / "d", {"sellers": base()["sellers"], "orders": [order(1), order(1, status="shipped")]})
    with pytest.raises(ConflictingDuplicates):
        w.run_full(files)
    job = w.log("job_log").where("status <> 'RUNNING'").first()
    assert (job["status"], job["pipelines_failed"]) == ("PARTIAL", 1)


def test_dimensions_survive_a_second_load(house):
    w, folder = house
    before = {r["customer_id"]: r["customer_key"] for r in w.mart("dim_customer").collect()}
    data = base()
    data["customers"] = [[h("c1"), h("u1"), "01000", "Campinas", "SP"], [h("c3"), h("u3"), "01000", "Rio", "RJ"]]
    w.run_full(write(folder / "day2", data), **SPAN)
    after = {r["customer_id"]: r for r in w.mart("dim_customer").collect()}
    assert {k: after[k]["customer_key"] for k in before} == before
    assert after[h("c3")]["customer_key"] == max(before.values()) + 1
    assert after[h("c2")]["is_deleted"] and not after["UNKNOWN"]["is_deleted"]
    assert after[h("c1")]["customer_city"] == "CAMPINAS"


def test_unchanged_files_are_skipped(spark, tmp_path, monkeypatch):
    w = Warehouse(spark, str(tmp_path / "root"))
    monkeypatch.setattr(Warehouse, "load_mart", lambda self, job=None, **options: None)
    data = {"sellers": base()["sellers"], "product_category_name_translation": base()["product_category_name_translation"]}
    files = write(tmp_path / "d", data)
    w.run_full(files)
    job = w.run_full(files)
    mine = {(r["pipeline"], r["status"]) for r in w.log("load_log").where(f"job_run_id = '{job}'").collect()}
    assert mine == {("raw.sellers", "SKIPPED"), ("raw.product_category_name_translation", "SKIPPED")}
    assert w.changed({"sellers": files["sellers"]}) == {}
    os.utime(files["sellers"], (4e9, 4e9))
    assert list(w.changed(files)) == ["sellers"]


def test_rows_name_their_file_and_messages_stay_whole(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "root"))
    for part in ("a", "b"):
        write(tmp_path / part, {"sellers": base()["sellers"]})
    (tmp_path / "b" / "sellers.csv").rename(tmp_path / "a" / "more.csv")
    batch = w.load_raw(ENTITIES["sellers"], str(tmp_path / "a"))
    rows = spark.read.parquet(str(tmp_path / "root" / "raw" / "sellers")).where(f"batch_id = '{batch}'")
    assert {r["file_name"] for r in rows.collect()} == {"sellers.csv", "more.csv"}

    def fail():
        raise ValueError("x" * 10_000)

    with pytest.raises(ValueError):
        w._run("RAW", "sellers", None, fail)
    assert w.log("error_log").first()["error_message"] == "x" * 10_000


def test_missing_sources_of_the_mart_are_logged(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "root"))
    with pytest.raises(NoSourceBatch):
        w.load_mart("job")
    assert w.log("error_log").where("pipeline = 'mart.sources'").count() == 1


def test_old_versions_are_removed_on_request(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "root"))
    e = ENTITIES["sellers"]
    for day in range(3):
        w.load_raw(e, write(tmp_path / f"d{day}", {"sellers": base()["sellers"]})["sellers"])
        w.load_cleansed(e)
    gone = tables.remove_old_versions(spark, w.root, "cleansed/sellers", keep=1)
    assert len(gone) == 1 and w.cleansed("sellers").count() == 1
    left = [p.name for p in (tmp_path / "root" / "cleansed" / "sellers").iterdir()]
    assert len(left) == 2 and f"version={gone[0]}" not in left


def test_bucketed_tables_move_only_what_changed(spark, tmp_path):
    data = base()
    plain, dealt = Warehouse(spark, str(tmp_path / "plain")), Warehouse(spark, str(tmp_path / "dealt"), bucket_digits=1)
    orders = ENTITIES["orders"]

    def load(w, name, rows):
        files = write(tmp_path / name, {"orders": rows})
        w.load_raw(orders, files["orders"])
        return w.load_cleansed(orders)

    first = [order(n) for n in range(1, 60)]
    later = [order(n, status="shipped" if n == 7 else "delivered") for n in range(2, 60)]
    for day, rows in enumerate((data["orders"] + first[3:], later, later), 1):
        for w in (plain, dealt):
            load(w, f"day{day}", rows)
        columns = ["order_id", "order_status", "is_deleted"]
        assert sorted(map(tuple, dealt.cleansed("orders").select(columns).collect())) == sorted(map(tuple, plain.cleansed("orders").select(columns).collect()))
    assert len(list((tmp_path / "dealt/cleansed/orders").glob("version=*"))) == 2  # nothing changed on the third day
    tables.remove_old_versions(spark, dealt.root, "cleansed/orders", keep=0)
    assert dealt.cleansed("orders").count() == plain.cleansed("orders").count()
    # A table that was published whole is dealt to buckets by its next load.
    plain.bucket_digits = 1
    load(plain, "day4", first)
    assert plain.cleansed("orders").where("NOT is_deleted").count() == 59 == len({r.order_id for r in plain.cleansed("orders").collect()} & {h(f"o{n}") for n in range(1, 60)})
