"""Raw batches, file reading and the run ledger, over data derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gallery.base import Tables, example
from gallery.oracle import findings_sql, with_ctes
from sparkmart.plans import entities, ledger, spec
from sparkmart.sources import delimited, raw

# -- events as a load ledger: a user is a job, an event type a pipeline, an error a failed load --

_LOADS_SQL = """
SELECT event_id, 'job-' || cast(user_id AS varchar) AS job_run_id, event_type || '-' || cast(user_id % 7 AS varchar) AS pipeline,
       'batch-' || cast(event_id AS varchar) AS batch_id,
       CASE WHEN event_type = 'error' THEN 'FAILED' WHEN value < 1 THEN 'RUNNING' WHEN value > 40 THEN 'FAILED'
            ELSE 'SUCCESS' END AS status,
       cast(epoch_us(ts) AS bigint) AS load_us, 'file-' || cast(user_id AS varchar) || '.csv' AS file_name, value FROM events"""


def _loads(t: Tables) -> DataFrame:
    """The events table in the shape of the load ledger."""
    status = (
        F.when(F.col("event_type") == "error", "FAILED").when(F.col("value") < 1, "RUNNING")
        .when(F.col("value") > 40, "FAILED").otherwise("SUCCESS")
    )
    user = F.col("user_id").cast("string")
    return t.table("events").select(
        "event_id",
        F.concat(F.lit("job-"), user).alias("job_run_id"),
        F.concat("event_type", F.lit("-"), (F.col("user_id") % 7).cast("string")).alias("pipeline"),
        F.concat(F.lit("batch-"), F.col("event_id").cast("string")).alias("batch_id"),
        status.alias("status"),
        F.col("ts").alias("load_ts"),
        F.concat(F.lit("file-"), user, F.lit(".csv")).alias("file_name"),
        F.lit("RAW").alias("layer"),
        F.concat(F.lit("raw/"), F.col("event_type")).alias("table_name"),
        "value",
    )


@example("L-04, A-05", f"""
SELECT job_run_id, pipelines AS pipeline_count, failed AS pipelines_failed,
       CASE WHEN failed = 0 THEN 'SUCCESS' WHEN failed = pipelines THEN 'FAILED' ELSE 'PARTIAL' END AS status
FROM (SELECT job_run_id, count(DISTINCT CASE WHEN status = 'FAILED' THEN pipeline END) AS failed,
             count(DISTINCT pipeline) AS pipelines
      FROM ({_LOADS_SQL}) WHERE status IN ('SUCCESS', 'FAILED') GROUP BY 1)""")
def job_rollup(t: Tables):
    """Pipelines counted, pipelines failed and status per job."""
    return ledger.job_rollup(_loads(t))


@example("L-07, O-04", f"""
SELECT pipeline, status AS last_run_status, batch_id AS last_batch_id FROM (
    SELECT *, row_number() OVER (PARTITION BY pipeline ORDER BY load_us DESC, status DESC, event_id DESC) AS place
    FROM ({_LOADS_SQL})) WHERE place = 1""")
def newest_load_states(t: Tables):
    """Last state of every pipeline."""
    return ledger.pipeline_status(_loads(t)).select("pipeline", "last_run_status", "last_batch_id")


@example("L-01, A-15", f"""
SELECT job_run_id, batch_id, status FROM (
    SELECT *, row_number() OVER (PARTITION BY job_run_id ORDER BY load_us DESC, status <> 'RUNNING' DESC, event_id DESC) AS place
    FROM ({_LOADS_SQL})) WHERE place = 1""")
def latest_load_states(t: Tables):
    """Newest ledger row per job."""
    return ledger.latest_state(_loads(t), "job_run_id", "load_ts").select("job_run_id", "batch_id", "status")


@example("S-09, J-12, S-08", f"""
SELECT p.pipeline, p.source_pipeline, b.batch_id
FROM (SELECT DISTINCT pipeline, replace(pipeline, 'click', 'purchase') AS source_pipeline FROM ({_LOADS_SQL})) p
LEFT JOIN (SELECT pipeline, batch_id FROM (
    SELECT *, row_number() OVER (PARTITION BY pipeline ORDER BY load_us DESC, batch_id DESC) AS place
    FROM ({_LOADS_SQL}) WHERE status = 'SUCCESS') WHERE place = 1) b ON b.pipeline = p.source_pipeline""")
def source_batches(t: Tables):
    """Batch of each pipeline's source, taken from the source's last successful load."""
    loads = _loads(t)
    configured = loads.select("pipeline").distinct().withColumn(
        "source_pipeline", F.replace(F.col("pipeline"), F.lit("click"), F.lit("purchase")))
    return ledger.source_batches(configured, loads).select("pipeline", "source_pipeline", "batch_id")


@example("S-06, A-15", f"""
SELECT s.file_name, modified_us FROM (
    SELECT file_name, max(load_us) FILTER (WHERE value > 3) AS modified_us FROM ({_LOADS_SQL}) GROUP BY 1) s
LEFT JOIN (SELECT file_name, max(load_us) FILTER (WHERE status = 'SUCCESS') AS done FROM ({_LOADS_SQL}) GROUP BY 1) l
USING (file_name) WHERE done IS NULL OR modified_us > done""")
def changed_sources(t: Tables):
    """Sources modified after their last successful load."""
    loads = _loads(t)
    sources = loads.groupBy("file_name").agg(F.max(F.when(F.col("value") > 3, F.col("load_ts"))).alias("modified_ts"))
    due = raw.changed_sources(sources, loads)
    return due.select("file_name", F.unix_micros(F.col("modified_ts").cast("timestamp")).alias("modified_us"))


@example("L-07, J-14, O-04", f"""
SELECT event_id, status FROM ({_LOADS_SQL})
WHERE job_run_id = (SELECT job_run_id FROM ({_LOADS_SQL}) ORDER BY load_us DESC, job_run_id DESC LIMIT 1)""")
def loads_of_newest_job(t: Tables):
    """All ledger rows of the job that ran last."""
    loads = _loads(t)
    return ledger.rows_of_newest_job(loads, loads.withColumnRenamed("load_ts", "start_ts")).select("event_id", "status")


@example("L-03, L-07", f"SELECT 'order_items' AS table_name, f.* FROM ({findings_sql('order_items')}) f")
def findings_of_batch(t: Tables):
    """Findings of one batch out of a quality log of two."""
    found = spec.issues(t.clean("order_items"), entities.ORDER_ITEMS)
    log = None
    for batch in ("one", "two"):
        rows = found.select(
            F.lit(batch).alias("batch_id"), F.lit("job").alias("job_run_id"), F.lit("order_items").alias("table_name"),
            "column_name", "issue", "affected_row_count")
        log = rows if log is None else log.unionByName(rows)
    return ledger.batch_issues(log, "two")


@example("L-05, L-06", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE 'UNKNOWN' END AS status_name,
       o_orderpriority = '1-URGENT' OR o_orderpriority LIKE '%LOW' AS needs_care FROM orders""")
def schema_changes(t: Tables):
    """Two columns added with a backfill and a default, the others dropped."""
    orders = t.table("orders")
    names = F.when(F.col("o_orderstatus") == "F", "Finished").when(F.col("o_orderstatus") == "O", "Open")
    care = (F.col("o_orderpriority") == "1-URGENT") | F.col("o_orderpriority").endswith("LOW")
    wider = ledger.add_column(orders, "status_name", "string", "UNKNOWN", names)
    wider = ledger.add_column(wider, "needs_care", "boolean", False, care)
    gone = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return ledger.drop_columns(wider, gone)


# -- files: raw entities written as text files and read back --


def _files(t: Tables, name: str, rows: DataFrame, **options: object) -> str:
    return t.once(
        f"files_{name}", lambda path: rows.write.mode("overwrite").options(header=True, **options).csv(path))


@example("S-01", with_ctes(
    "SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in entities.ORDER_ITEMS.columns) + " FROM raw_order_items"))
def read_comma_files(t: Tables):
    """Items written as comma-separated text and read back with literal quotes and NULL for empty fields."""
    path = _files(t, "items", t.raw("order_items"), sep=",", quote="", emptyValue="", ignoreLeadingWhiteSpace=False,
                  ignoreTrailingWhiteSpace=False)
    return delimited.read_delimited(t.spark, path, entities.ORDER_ITEMS)


@example("S-02", with_ctes("""
SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state FROM live_customers"""))
def read_pipe_files(t: Tables):
    """Customers written with pipes, read back and cleansed."""
    path = _files(t, "customers", t.raw("customers"), sep="|", quote="", ignoreLeadingWhiteSpace=False,
                  ignoreTrailingWhiteSpace=False)
    read = delimited.read_delimited(t.spark, path, entities.CUSTOMERS)
    return spec.cleansed(read, entities.CUSTOMERS).drop("row_hash")


_NOTES = spec.EntitySpec(
    name="notes", separator=",", fields=(spec.trimmed("doc_id"), spec.trimmed("note"), spec.trimmed("lang")),
    keys=("doc_id",), hashed=("doc_id",), order=(), rules=lambda: [], admits=lambda: [],
)
_FLAT = r"nullif(trim(regexp_replace(text, '[|\r\n]', ' ', 'g')), '')"
_NOTES_SQL = f"SELECT cast(doc_id AS varchar) AS doc_id, sha256({_FLAT}) AS note_hash, length({_FLAT}) AS note_length, lang FROM documents"


#: Documents of a delivered file, some 30 MB; more of them make more files, not larger ones.
_FILE_ROWS = 10_000


def _notes(t: Tables, name: str, files: int | None = None) -> str:
    rows = t.table("documents").select(F.col("doc_id").cast("string"), F.col("text").alias("note"), "lang")
    rows = rows.repartition(files) if files else rows
    return _files(t, name, rows, sep=",", quote='"', escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False,
                  ignoreTrailingWhiteSpace=False, maxRecordsPerFile=_FILE_ROWS)


def _hashed(notes: DataFrame) -> DataFrame:
    return notes.select(
        "doc_id", F.sha2(F.col("note"), 256).alias("note_hash"), F.length("note").alias("note_length"), "lang")


@example("S-03", _NOTES_SQL)
def read_quoted_files(t: Tables):
    """Whole documents, with their line breaks, quotes and commas, through a quoted file."""
    return _hashed(delimited.read_quoted(t.spark, _notes(t, "notes"), _NOTES))


@example("S-03", _NOTES_SQL)
def read_quoted_splits(t: Tables):
    """The same documents delivered as many files, each read by a task of its own."""
    return _hashed(delimited.read_quoted(t.spark, _notes(t, "notes_split", 12), _NOTES))


@example("S-03", _NOTES_SQL)
def read_quoted_by_split(t: Tables):
    """The same documents cut into records split by split, as large files are."""
    return _hashed(delimited.read_quoted(t.spark, _notes(t, "notes"), _NOTES, whole_below=0))


@example("S-04, S-07, S-08, F-30", with_ctes("SELECT order_status, count(*) AS cnt FROM raw_orders GROUP BY 1"))
def latest_raw_batch(t: Tables):
    """Two batches appended; the profile reads only the newest."""
    orders = t.raw("orders")

    def append_both(path: str) -> None:
        for number, batch in enumerate(("first", "second")):
            stamped = raw.stamp_batch(orders, batch, "orders.csv").withColumn(
                "load_ts", F.timestamp_seconds(F.lit(1_700_000_000 + number)))
            mode = "append" if number else "overwrite"
            stamped.write.mode(mode).partitionBy("batch_id").parquet(path)

    newest = raw.latest_batch(t.spark.read.parquet(t.once("batches_orders", append_both)))
    return newest.groupBy("order_status").agg(F.count("*").alias("cnt"))
