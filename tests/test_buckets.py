import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import merge
from sparkmart.sources import buckets


def _delivery(spark, rows):
    return spark.createDataFrame([(k, v, v.encode()) for k, v in rows.items()], "k string, v string, row_hash binary")


def _now(day):
    return F.lit(dt.datetime(2024, 1, day))


def _files(root):
    return {str(p) for p in root.rglob("*.parquet") if f"{buckets.BUCKET}=" in str(p)}


@pytest.mark.parametrize("digits", [1, 2])
def test_loads_equal_the_whole_merge(spark, tmp_path, rows, digits):
    days = [
        {f"k{i}": "a" for i in range(300)},
        {f"k{i}": "a" if i % 40 else "b" for i in range(10, 305)},  # ten gone, five new, eight changed
        {f"k{i}": "a" if i % 40 else "b" for i in range(10, 305)},  # the same again
        {f"k{i}": "a" for i in range(300)},  # gone ones come back, new ones go
        {},
    ]
    state = _delivery(spark, days[0]).limit(0).selectExpr("*", "false AS is_deleted", "CAST(NULL AS timestamp) AS deleted_at", "CAST(NULL AS timestamp) AS updated_at")
    version = None
    for number, day in enumerate(days, 1):
        source = _delivery(spark, day) if day else _delivery(spark, days[0]).limit(0)
        merged = merge.merge_upsert(state, source, ["k"], _now(number))
        done = buckets.load(spark, str(tmp_path), "t", version, source, ["k"], _now(number), digits)
        assert {k: done[k] for k in ("rows_inserted", "rows_updated", "rows_deleted")} == merge.action_counts(merged).first().asDict()
        version = done["version"]
        columns = ["k", "v", "is_deleted", "deleted_at", "updated_at"]
        assert rows(buckets.read(spark, str(tmp_path), "t", version), *columns) == rows(merged, *columns)
        if number == 3:
            assert done["buckets_written"] == 0 and done["rows_processed"] == 0
        state = spark.createDataFrame(merged.drop("_action").collect(), merged.drop("_action").schema)


def test_a_small_change_writes_few_bytes(spark, tmp_path):
    first = {f"k{i}": f"v{i}" for i in range(20_000)}
    v1 = buckets.load(spark, str(tmp_path), "t", None, _delivery(spark, first), ["k"], _now(1))["version"]
    before = _files(tmp_path)
    size = sum(len(open(f, "rb").read()) for f in before)
    done = buckets.load(spark, str(tmp_path), "t", v1, _delivery(spark, first | {"k7": "new", "k8": "new"}), ["k"], _now(2))
    new = _files(tmp_path) - before
    assert done["buckets_written"] <= 2 and done["rows_updated"] == 2
    assert sum(len(open(f, "rb").read()) for f in new) < 0.02 * size
    assert buckets.read(spark, str(tmp_path), "t", v1).where("v = 'new'").count() == 0  # the old version is as it was
    assert buckets.read(spark, str(tmp_path), "t", done["version"]).where("v = 'new'").count() == 2
    unused = buckets.unused_buckets(spark, str(tmp_path), "t", [v1], [done["version"]])
    assert len(unused) == done["buckets_written"]


def test_protected_rows_stay(spark, tmp_path):
    protect = F.col("k") == "unknown"
    v1 = buckets.load(spark, str(tmp_path), "t", None, _delivery(spark, {"unknown": "x", "a": "y"}), ["k"], _now(1))["version"]
    done = buckets.load(spark, str(tmp_path), "t", v1, _delivery(spark, {"b": "z"}), ["k"], _now(2), protect=protect)
    got = {r.k: r.is_deleted for r in buckets.read(spark, str(tmp_path), "t", done["version"]).collect()}
    assert got == {"unknown": False, "a": True, "b": False}
