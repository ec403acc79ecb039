"""Warehouse loads over files derived from the test tables: what the ledger, the logs and the published tables then hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gallery.base import Tables, example
from gallery.oracle import findings_sql, with_ctes
from sparkmart.functions import dates, text
from sparkmart.plans.entities import ENTITIES
from sparkmart.plans.load import ConflictingDuplicates, Warehouse

LOADED = ("sellers", "products", "order_payments", "product_category_name_translation")


def _build(t: Tables, root: str) -> None:
    """Deliver each entity as a folder of files, load it, and deliver and load nothing new a second time."""
    house = Warehouse(t.spark, root)
    for name in LOADED:
        files = f"{root}/files/{name}"
        options = {"header": True, "sep": ENTITIES[name].separator, "quote": "", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        t.raw(name).write.options(**options).csv(files)
        house.load_raw(ENTITIES[name], files, quoted=False)
        try:
            house.load_cleansed(ENTITIES[name])
        except ConflictingDuplicates:
            pass  # the ledger has it


def _house(t: Tables) -> Warehouse:
    return Warehouse(t.spark, t.once("house", lambda path: _build(t, path)))


def _per_entity(shown: str) -> str:
    return with_ctes(" UNION ALL ".join(shown.replace("{e}", e) for e in LOADED))


_CONFLICTS = " UNION ALL ".join(
    f"SELECT '{e}' AS entity, affected_row_count AS n FROM ({findings_sql(e)}) WHERE issue LIKE '%conflicting%'" for e in LOADED
)


@example("S-01, S-04, S-07, L-01", _per_entity("SELECT 'raw.{e}' AS pipeline, count(*) AS raw_rows, 1 AS batches, true AS named FROM raw_{e}"))
def house_raw_tables(t: Tables):
    """Rows and batches of the raw tables; every row names the file it came from."""
    house, result = _house(t), None
    for name in LOADED:
        table = t.spark.read.parquet(f"{house.root}/raw/{name}")
        line = table.agg(
            F.count("*").alias("raw_rows"), F.count_distinct("batch_id").cast("int").alias("batches"),
            F.bool_and(F.col("file_name").rlike(r"^part-.*\.csv$")).alias("named"),
        ).withColumn("pipeline", F.lit(f"raw.{name}"))
        result = line if result is None else result.unionByName(line)
    return result


@example("D-03, L-01, L-04, S-12, S-13", f"""
WITH conflicts AS ({_CONFLICTS}),
sizes AS ({" UNION ALL ".join(f"SELECT '{e}' AS entity, (SELECT count(*) FROM ({with_ctes(f'SELECT 1 FROM live_{e}')})) AS n" for e in LOADED)})
SELECT 'cleansed.' || entity AS pipeline, CASE WHEN c.n > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CASE WHEN c.n > 0 THEN 0 ELSE s.n END AS rows_processed, CASE WHEN c.n > 0 THEN 0 ELSE s.n END AS published_rows
FROM sizes s LEFT JOIN conflicts c USING (entity)""")
def house_cleansed_loads(t: Tables):
    """How each cleansed load ended, what it counted, and how many rows the published table has."""
    house = _house(t)
    ends = house.log("load_log").where("layer = 'CLEANSED' AND status <> 'RUNNING'").select("pipeline", "status", "rows_processed")
    result = None
    for name in LOADED:
        published = house.cleansed(name)
        rows = F.lit(0).cast("long") if published is None else published.agg(F.count("*")).scalar()
        line = ends.where(F.col("pipeline") == f"cleansed.{name}").withColumn("published_rows", rows)
        result = line if result is None else result.unionByName(line)
    return result


_MISSING = ("NULL value", "Empty string after cleansing", "Invalid decimal format")
_FOUND = " UNION ALL ".join(f"SELECT '{e}' AS table_name, f.* FROM ({findings_sql(e)}) f" for e in LOADED)


@example("L-03, D-01, D-02", f"""
SELECT table_name, column_name, CASE WHEN issue IN {_MISSING} THEN 'missing or unreadable' ELSE issue END AS finding,
       CAST(sum(affected_row_count) AS BIGINT) AS affected_row_count FROM ({_FOUND}) GROUP BY ALL""")
def house_findings(t: Tables):
    """The data-quality log after the loads. A file has no empty text beside NULL, so what differs by that is put together."""
    finding = F.when(F.col("issue").isin(*_MISSING), "missing or unreadable").otherwise(F.col("issue"))
    log = _house(t).log("dq_log").withColumn("finding", finding)
    return log.groupBy("table_name", "column_name", "finding").agg(F.sum("affected_row_count").alias("affected_row_count"))


@example("L-02, D-03", f"SELECT 'cleansed.' || entity AS pipeline, entity || ': ' || n || ' conflicting rows' AS error_message FROM ({_CONFLICTS})")
def house_errors(t: Tables):
    """The error log after the loads, messages whole."""
    return _house(t).log("error_log").select("pipeline", "error_message")


@example("F-23", "SELECT event_id, epoch_us(ts) // 1000 - epoch_us(date_trunc('day', ts)) // 1000 AS day_millis FROM events")
def millis_of_day(t: Tables):
    """Milliseconds from the start of its day to each event."""
    stamp = F.col("ts").cast("timestamp")
    return t.table("events").select("event_id", dates.millis_between(F.date_trunc("day", stamp), stamp).alias("day_millis"))


@example("F-31", "SELECT page_id, left(url, length(url) - length(regexp_extract(url, '[^/]*$'))) AS folder FROM pages")
def page_folders(t: Tables) -> DataFrame:
    """The folder part of every page's address."""
    return t.table("pages").select("page_id", text.drop_file_name(F.col("url"), F.regexp_extract("url", "[^/]*$", 0)).alias("folder"))
