"""Normalising, rules, duplicates, admission and merging."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gallery.base import Tables, example
from gallery.oracle import _SPECS, findings_sql, key_counts, norm, strip, with_ctes
from gallery.standins import RAW
from sparkmart.functions import hashing, text
from sparkmart.operators import merge, quality
from sparkmart.plans import entities, mart, spec
from sparkmart.sources import buckets

FIRST_LOAD, SECOND_LOAD, THIRD_LOAD = (dt.datetime(2024, 1, d) for d in (1, 2, 3))


@example("F-01, F-02, F-03", f"""
SELECT doc_id, sha256({norm('text')}) AS normalised_hash, length({norm('text')}) AS normalised_length,
       length({strip('text')}) AS stripped_length FROM documents""")
def normalised_documents(t: Tables):
    """The text normaliser and the quote stripper over whole documents."""
    upper = text.normalise_text(F.col("text"))
    return t.table("documents").select(
        "doc_id", F.sha2(upper, 256).alias("normalised_hash"), F.length(upper).alias("normalised_length"),
        F.length(text.strip_quotes(F.col("text"))).alias("stripped_length"),
    )


@example("F-11, F-12, F-29", with_ctes("SELECT order_id, order_item_id, row_hash FROM clean_order_items"))
def item_hashes(t: Tables):
    """Row hash of every item row."""
    return t.clean("order_items").select("order_id", "order_item_id", F.lower(F.hex("row_hash")).alias("row_hash"))


@example("F-11, F-12", """
SELECT l_orderkey, l_linenumber,
       sha256(concat(l_returnflag, '|', l_linestatus, '|', CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_shipdate END)) AS row_hash
FROM lineitem""")
def hash_with_nulls(t: Tables):
    """A NULL column hashes as empty text but keeps its separator."""
    parts = ["l_returnflag", "l_linestatus"]
    shipped = F.when(F.col("l_returnflag") != "N", F.col("l_shipdate"))
    digest = hashing.row_hash([*[F.col(c) for c in parts], shipped])
    return t.table("lineitem").select("l_orderkey", "l_linenumber", F.lower(F.hex(digest)).alias("row_hash"))


def _register_entities() -> None:
    for name in RAW:
        example("D-01, D-02, D-06, P-01, P-03, P-05..P-09", findings_sql(name), f"issues_{name}")(
            lambda t, n=name: spec.issues(t.clean(n), entities.ENTITIES[n]))

        columns = list(_SPECS[name][0])
        shown = ", ".join(
            f"cast({c} AS string) AS {c}" if _is_typed(c) else c for c in columns
        )
        example("D-04, D-05, D-06, F-08, F-09, W-01, W-02, J-09", with_ctes(f"SELECT {shown}, row_hash FROM live_{name}"),
                f"cleansed_{name}")(lambda t, n=name: _shown(t.cleansed(n)))


def _is_typed(column: str) -> bool:
    return column.endswith(("_date", "_at", "_timestamp", "_lat", "_lng", "price", "_value", "_installments", "_score",
                            "_sequential", "_lenght", "_qty", "_g", "_cm"))


def _shown(df: DataFrame) -> DataFrame:
    """Typed values as text, the hash as hex."""
    return df.select(
        *[F.col(c).cast("string").alias(c) if _is_typed(c) else F.col(c) for c in df.columns if c != "row_hash"],
        F.lower(F.hex("row_hash")).alias("row_hash"),
    )


_register_entities()

_LINE_KEYS = ["l_orderkey", "l_linenumber"]
_LINE_HASH = "sha256(concat(l_orderkey, '|', l_linenumber, '|', l_partkey, '|', l_suppkey))"


def _lines(t: Tables) -> DataFrame:
    lines = t.table("lineitem").select(*_LINE_KEYS, "l_partkey", "l_suppkey")
    return lines.withColumn("row_hash", hashing.row_hash([F.col(c) for c in lines.columns]))


@example("D-02, J-09", f"""
WITH lines AS (SELECT *, {_LINE_HASH} AS row_hash FROM lineitem),
ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS rn FROM lines)
SELECT a.l_orderkey, a.l_linenumber, count(*) AS row_count,
       count(*) FILTER (WHERE a.rn > 1 AND a.row_hash = f.row_hash) AS type_a,
       count(*) FILTER (WHERE a.rn > 1 AND a.row_hash <> f.row_hash) AS type_b
FROM ranked a JOIN ranked f ON f.l_orderkey = a.l_orderkey AND f.l_linenumber = a.l_linenumber AND f.rn = 1
GROUP BY 1, 2 HAVING count(*) > 1""")
def line_duplicates(t: Tables):
    """Repeated order lines and their duplicate classes."""
    order = [("l_partkey", "first"), ("l_suppkey", "first")]
    return quality.duplicate_classes(_lines(t), _LINE_KEYS, order)


_TWICE = (
    "(SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_purchase_timestamp NULLS LAST, customer_id NULLS FIRST, row_hash) "
    "AS rn FROM (SELECT * FROM clean_orders UNION ALL SELECT * FROM clean_orders))"
)


@example("D-02, D-03", with_ctes(f"""
SELECT 'order_id' AS column_name, 'Duplicate order_id: ' || ending AS issue, affected_row_count FROM (
    SELECT unnest(['identical content, deduplicated silently', 'conflicting content — investigate before reload']) AS ending,
           unnest([CAST(sum(n_kept - 1) AS BIGINT), CAST(sum(n_rows - n_kept) AS BIGINT)]) AS affected_row_count
    FROM {key_counts(_TWICE, ['order_id'])})
WHERE affected_row_count > 0"""))
def reload_duplicates(t: Tables):
    """The whole batch delivered twice: exact copies everywhere, conflicts only under bad keys."""
    clean = t.clean("orders")
    classes = quality.duplicate_classes(clean.unionByName(clean), ["order_id"], entities.ORDERS.order)
    return quality.duplicate_issues(classes, "order_id", "order_id")


@example("M-14, W-03", with_ctes("SELECT order_id, review_score FROM latest_review"))
def latest_reviews(t: Tables):
    """Score of the newest review per order."""
    return mart.latest_review(t.cleansed("order_reviews"))


@example("W-01, W-03, J-07", """
SELECT l_orderkey, l_linenumber, l_partkey FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC,
                                 l_suppkey DESC) AS place FROM lineitem) WHERE place = 1""")
def latest_line_per_order(t: Tables):
    """The line shipped last in every order."""
    lines = t.table("lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")
    newest = quality.pick_last(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"])
    return newest.select("l_orderkey", "l_linenumber", "l_partkey")


# Three daily deliveries of the orders table. Day 1 lacks the orders of 2001, which had not been
# placed; day 2 has a new status for urgent orders and lacks finished orders of 1995; day 3 has
# everything again.
_CONTENT = ["o_custkey", "o_orderstatus", "o_totalprice"]


def _delivery(t: Tables, day: int) -> DataFrame:
    orders = t.table("orders").select("o_orderkey", *_CONTENT, "o_orderdate", "o_orderpriority")
    if day == 1:
        orders = orders.where("o_orderdate < TIMESTAMP_NTZ '2001-01-01'")
    else:
        orders = orders.withColumn(
            "o_orderstatus", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("X")).otherwise(F.col("o_orderstatus"))
        )
    if day == 2:
        orders = orders.where("NOT (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP_NTZ '1996-01-01')")
    hashed = hashing.row_hash([F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_totalprice")])
    return orders.select("o_orderkey", *_CONTENT, hashed.alias("row_hash"))


def _after(t: Tables, days: int) -> DataFrame:
    """Table state with actions after the given number of daily loads."""
    first = _delivery(t, 1)
    state = first.limit(0).selectExpr(
        "*", "false AS is_deleted", "cast(NULL AS timestamp) AS deleted_at", "cast(NULL AS timestamp) AS updated_at"
    )
    merged = None
    for day, now in list(enumerate((FIRST_LOAD, SECOND_LOAD, THIRD_LOAD), 1))[:days]:
        moment = F.lit(now.replace(tzinfo=dt.timezone.utc))
        merged = merge.merge_upsert(state, _delivery(t, day), ["o_orderkey"], moment)
        state = merged.drop("_action")
    return merged


def _state(merged: DataFrame) -> DataFrame:
    return merged.select(
        "o_orderkey", *_CONTENT, "is_deleted", F.coalesce(F.unix_seconds("deleted_at"), F.lit(0)).alias("deleted_at"),
        F.unix_seconds("updated_at").alias("updated_at"), F.col("_action").alias("action"),
    )


def _seconds(moment: dt.datetime) -> int:
    return int(moment.replace(tzinfo=dt.timezone.utc).timestamp())


_D1, _D2, _D3 = _seconds(FIRST_LOAD), _seconds(SECOND_LOAD), _seconds(THIRD_LOAD)
_STATE_2 = f"""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, gone AS is_deleted, CASE WHEN gone THEN {_D2} ELSE 0 END AS deleted_at,
       CASE WHEN gone OR late OR o_orderpriority = '1-URGENT' THEN {_D2} ELSE {_D1} END AS updated_at,
       CASE WHEN late THEN 'INSERT' WHEN gone THEN 'SOFT_DELETE' WHEN o_orderpriority = '1-URGENT' THEN 'UPDATE'
            ELSE 'NOOP' END AS action
FROM (SELECT *, o_orderdate >= TIMESTAMP '2001-01-01' AS late,
             o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' AND o_orderdate < TIMESTAMP '1996-01-01' AS gone
      FROM orders)"""


@example("M-01, J-13, S-12", _STATE_2)
def merge_second_load(t: Tables):
    """Inserts, updates, soft deletes and untouched rows of a second delivery."""
    return _state(_after(t, 2))


def _bucketed(t: Tables, name: str, *deliveries: DataFrame) -> tuple[str, list[dict]]:
    """The folder of a bucketed table after these loads, and what each load did."""
    done: list[dict] = []

    def write(root: str) -> None:
        for delivery, now in zip(deliveries, (FIRST_LOAD, SECOND_LOAD, THIRD_LOAD)):
            before = done[-1]["version"] if done else None
            moment = F.lit(now.replace(tzinfo=dt.timezone.utc))
            done.append(buckets.load(t.spark, root, "orders", before, delivery, ["o_orderkey"], moment))
        t.spark.createDataFrame(done).coalesce(1).write.parquet(f"{root}/loads")

    root = t.once(name, write)
    loads = [r.asDict() for r in t.spark.read.parquet(f"{root}/loads").collect()]  # one row a load
    return root, loads


@example("M-01, J-13, S-13", f"SELECT * EXCLUDE (action) FROM ({_STATE_2})")
def merge_bucketed_load(t: Tables):
    """The second delivery merged bucket by bucket."""
    root, loads = _bucketed(t, "bucketed_orders", _delivery(t, 1), _delivery(t, 2))
    newest = next(x["version"] for x in loads if x["rows_updated"])
    return _state(buckets.read(t.spark, root, "orders", newest).withColumn("_action", F.lit(""))).drop("action")


@example("M-01, M-02, S-13", """
SELECT count(DISTINCT substr(md5(o_orderkey::VARCHAR), 1, 2)) AS buckets,
       count(DISTINCT substr(md5(o_orderkey::VARCHAR), 1, 2)) FILTER (WHERE late) AS buckets_written,
       count(*) FILTER (WHERE late) AS rows_inserted
FROM (SELECT *, o_orderdate::DATE = (SELECT max(o_orderdate::DATE) FROM orders) AS late FROM orders)""")
def merge_buckets_written(t: Tables):
    """How many buckets a delivery writes that brings the orders of one more day."""
    orders = t.table("orders")
    newest = orders.agg(F.max(F.to_date("o_orderdate")).alias("d"))
    hashed = hashing.row_hash([F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_totalprice")])
    rows = orders.select("o_orderkey", *_CONTENT, hashed.alias("row_hash"), F.to_date("o_orderdate").alias("d"))
    whole, earlier = rows.drop("d"), rows.where(F.col("d") < newest.scalar()).drop("d")
    _, loads = _bucketed(t, "bucketed_days", earlier, whole)
    last = min(loads, key=lambda x: x["rows_inserted"])
    return t.spark.createDataFrame([(last["buckets"], last["buckets_written"], last["rows_inserted"])], "buckets long, buckets_written long, rows_inserted long")


@example("M-02, A-04", f"""
SELECT count(*) FILTER (WHERE action = 'INSERT') AS rows_inserted,
       count(*) FILTER (WHERE action IN ('UPDATE', 'SOFT_DELETE')) AS rows_updated, 0 AS rows_deleted FROM ({_STATE_2})""")
def merge_actions(t: Tables):
    """Counts of a second delivery."""
    return merge.action_counts(_after(t, 2))


@example("M-01", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, false AS is_deleted, 0 AS deleted_at,
       CASE WHEN is_deleted THEN {_D3} ELSE updated_at END AS updated_at,
       CASE WHEN is_deleted THEN 'UPDATE' ELSE 'NOOP' END AS action FROM ({_STATE_2})""")
def merge_reactivation(t: Tables):
    """A third delivery brings the soft-deleted rows back."""
    return _state(_after(t, 3))


@example("M-01, M-02", "SELECT 0 AS rows_inserted, 0 AS rows_updated, 0 AS rows_deleted, count(*) AS untouched FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'")
def merge_same_twice(t: Tables):
    """The same delivery again changes nothing."""
    state = _after(t, 1).drop("_action")
    moment = F.lit(SECOND_LOAD.replace(tzinfo=dt.timezone.utc))
    again = merge.merge_upsert(state, _delivery(t, 1), ["o_orderkey"], moment)
    return merge.action_counts(again).withColumn(
        "untouched", again.agg(F.count_if(F.col("_action") == merge.NOOP).alias("n")).scalar())
