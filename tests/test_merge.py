import datetime as dt

from pyspark.sql import functions as F

from sparkmart.operators import merge
from sparkmart.operators.skew import hot_values, salted_join
from sparkmart.plans import mart

def moment():
    return F.lit(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))


def source(spark, rows):
    df = spark.createDataFrame(rows, "k string, v string")
    return df.withColumn("row_hash", F.unhex(F.sha2(F.concat_ws("|", "k", "v"), 256)))


def empty(spark):
    return source(spark, [("x", "x")]).limit(0).selectExpr(
        "*", "false AS is_deleted", "cast(NULL AS timestamp) AS deleted_at", "cast(NULL AS timestamp) AS updated_at")


def load(state, rows):
    return merge.merge_upsert(state, rows, ["k"], moment())


def actions(df):
    return {r["k"]: r["_action"] for r in df.collect()}


def test_lifecycle_of_a_key(spark):
    first = load(empty(spark), source(spark, [("a", "1"), ("b", "1")]))
    assert actions(first) == {"a": "INSERT", "b": "INSERT"}
    second = load(first.drop("_action"), source(spark, [("a", "2"), ("c", "1")]))
    assert actions(second) == {"a": "UPDATE", "b": "SOFT_DELETE", "c": "INSERT"}
    gone = {r["k"]: r for r in second.collect()}["b"]
    assert gone["is_deleted"] and gone["deleted_at"] is not None and gone["v"] == "1"
    third = load(second.drop("_action"), source(spark, [("a", "2"), ("b", "1"), ("c", "1")]))
    assert actions(third) == {"a": "NOOP", "b": "UPDATE", "c": "NOOP"}
    back = {r["k"]: r for r in third.collect()}["b"]
    assert not back["is_deleted"] and back["deleted_at"] is None


def test_same_load_twice_does_nothing(spark):
    rows = source(spark, [("a", "1"), ("b", None)])
    first = load(empty(spark), rows)
    again = load(first.drop("_action"), rows)
    assert merge.action_counts(again).first().asDict() == {"rows_inserted": 0, "rows_updated": 0, "rows_deleted": 0}


def test_deleted_rows_are_not_touched_again(spark):
    state = load(load(empty(spark), source(spark, [("a", "1")])).drop("_action"), source(spark, [("b", "1")]))
    again = load(state.drop("_action"), source(spark, [("b", "1")]))
    assert actions(again) == {"a": "NOOP", "b": "NOOP"}


def test_keys_are_dense_unique_and_repeatable(spark):
    rows = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    first = {r["k"]: r["s"] for r in merge.assign_keys(rows, "k", F.lit(10), "s").collect()}
    assert sorted(first.values()) == list(range(11, 5011))
    again = merge.assign_keys(rows.repartition(5), "k", F.lit(10), "s").collect()
    assert {r["k"]: r["s"] for r in again} == first


DIM = mart.Dimension("d", "d_key", "k", "k string, v string", {"k": "UNKNOWN", "v": "UNKNOWN"})


def test_dimension_keeps_surrogates_and_unknown_member(spark):
    now = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    first = merge.merge_dimension(DIM.empty(spark, now), source(spark, [("a", "1"), ("b", "1")]), "k", "d_key", moment())
    keys = {r["k"]: r["d_key"] for r in first.collect()}
    assert keys["UNKNOWN"] == -1 and sorted(keys[k] for k in "ab") == [1, 2]
    second = merge.merge_dimension(first.drop("_action"), source(spark, [("b", "2"), ("c", "1")]), "k", "d_key", moment())
    after = {r["k"]: (r["d_key"], r["_action"]) for r in second.collect()}
    assert after == {
        "UNKNOWN": (-1, "NOOP"), "a": (keys["a"], "SOFT_DELETE"), "b": (keys["b"], "UPDATE"), "c": (3, "INSERT")}
    assert DIM.with_unknown(second.drop("_action"), now).count() == second.count()
    assert DIM.with_unknown(second.drop("_action").where("d_key > 0"), now).where("d_key = -1").count() == 1


def test_insert_missing_is_idempotent(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string")
    once = merge.insert_missing(a, b, "k")
    assert sorted(tuple(r) for r in merge.insert_missing(once, b, "k").collect()) == [(1, "x"), (2, "z")]


def skewed(spark):
    return spark.range(20000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
        .otherwise((F.col("id") % 997).cast("string")).alias("k"))


def test_hot_values_finds_the_heavy_key(spark):
    assert hot_values(skewed(spark), ["k"])["k"] == {"hot": 5}  # a third of the rows over eight partitions


def test_a_small_share_is_hot_among_many_partitions(spark):
    # 0.2 % of the rows is four times the fair share of one among 2,000 partitions
    rows = spark.range(200_000).select("id", F.when(F.col("id") % 500 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    assert hot_values(rows, ["k"], 2_000)["k"] == {"hot": 8}
    assert hot_values(rows, ["k"], 100)["k"] == {}


def test_slices_follow_the_partitions():
    assert [merge.slice_digits(n) for n in (1, 8, 200, 2_000, 100_000)] == [1, 2, 3, 4, 5]


def test_salted_join_equals_plain_join(spark, rows):
    left = skewed(spark)
    right = spark.range(500).select(F.col("id").cast("string").alias("k"), F.col("id").alias("s")).unionByName(
        spark.createDataFrame([("hot", -5)], "k string, s long"))
    for how in ("left", "inner"):
        want = rows(left.join(right, "k", how), "id", "k", "s")
        for hot in ([], ["hot"], ["hot", "2", "missing"], {"hot": 3, "5": 2, None: 4, "7": 1}):
            assert rows(salted_join(left, right, "k", how, hot, ["id"]), "id", "k", "s") == want


def test_salted_join_spreads_the_heavy_key(spark):
    right = spark.createDataFrame([("hot", 1)], "k string, s long")
    off = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(off)
    spark.conf.set(off, "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = salted_join(skewed(spark), right, "k", "inner", ["hot"], ["id"])
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set(off, before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 6667 and max(sizes) < 0.6 * 6667
