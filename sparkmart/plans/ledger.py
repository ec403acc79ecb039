"""Run ledger: loads, errors, data-quality findings and jobs as append-only tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators import quality

LOAD_LOG = (
    "log_id string, batch_id string, job_run_id string, pipeline string, layer string, table_name string, "
    "version string, rows_processed long, rows_inserted long, rows_updated long, rows_deleted long, "
    "status string, load_ts timestamp, file_name string, processed_duration_ms long"
)
ERROR_LOG = (
    "batch_id string, job_run_id string, pipeline string, error_message string, error_ts timestamp, file_name string"
)
DQ_LOG = (
    "batch_id string, job_run_id string, table_name string, column_name string, issue string, "
    "affected_row_count long, log_ts timestamp"
)
JOB_LOG = (
    "job_run_id string, job_name string, start_ts timestamp, end_ts timestamp, duration_ms long, status string, "
    "pipeline_count long, pipelines_failed long, triggered_by string"
)
SCHEMAS = {"load_log": LOAD_LOG, "error_log": ERROR_LOG, "dq_log": DQ_LOG, "job_log": JOB_LOG}


def latest_state(log: DataFrame, key: str, stamp: str) -> DataFrame:
    """The newest row per key of an append-only log: RUNNING gives way to its outcome."""
    closed = F.col("status") != "RUNNING"
    ranked = log.withColumn("_closed", closed)
    return quality.pick_last(ranked, [key], [stamp, "_closed"]).select(*log.columns)


def last_success(load_log: DataFrame, by: str, value: str) -> DataFrame:
    """Value carried by the newest successful load, per ``by``."""
    done = load_log.where(F.col("status") == "SUCCESS")
    return done.groupBy(by).agg(F.max_by(value, F.struct("load_ts", value)).alias(value))


def source_batches(pipelines: DataFrame, load_log: DataFrame) -> DataFrame:
    """For every pipeline, the batch of its source's last successful load (NULL if there is none).

    ``pipelines`` has ``pipeline`` and ``source_pipeline``, one row per configured load.
    """
    batches = last_success(load_log, "pipeline", "batch_id").withColumnRenamed("pipeline", "source_pipeline")
    return pipelines.join(batches, "source_pipeline", "left")


def job_rollup(load_log: DataFrame, outcome: Column | None = None) -> DataFrame:
    """Per job: pipelines counted, pipelines failed and the job's status.

    Without a failure the job is a SUCCESS; when all counted pipelines failed (or none was
    counted although the run stopped, ``outcome`` false) it is FAILED, otherwise PARTIAL.
    """
    finished = load_log.where(F.col("status").isin("SUCCESS", "FAILED"))
    # one row per (job, pipeline) first: both distinct counts become plain counts
    per_pipeline = finished.groupBy("job_run_id", "pipeline").agg(
        F.max((F.col("status") == "FAILED").cast("int")).alias("failed")
    )
    jobs = per_pipeline.groupBy("job_run_id").agg(
        F.count("pipeline").alias("pipeline_count"),
        F.count_if((F.col("failed") == 1) & F.col("pipeline").isNotNull()).alias("pipelines_failed"),
    )
    completed = F.col("pipelines_failed") == 0 if outcome is None else outcome
    status = (
        F.when(completed, "SUCCESS")
        .when(F.col("pipelines_failed") == F.col("pipeline_count"), "FAILED")
        .otherwise("PARTIAL")
    )
    return jobs.withColumn("status", status)


def newest_job(job_log: DataFrame) -> DataFrame:
    return job_log.orderBy(F.desc("start_ts"), F.desc("job_run_id")).limit(1)


def rows_of_newest_job(log: DataFrame, job_log: DataFrame) -> DataFrame:
    """Load, error or data-quality rows of the last job."""
    return log.where(F.col("job_run_id") == newest_job(job_log).select("job_run_id").scalar())


def rows_of_batch(log: DataFrame, batch_id: str) -> DataFrame:
    return log.where(F.col("batch_id") == batch_id)


def batch_issues(dq_log: DataFrame, batch_id: str) -> DataFrame:
    """Findings of one batch, worst first within each table."""
    return rows_of_batch(dq_log, batch_id).select("table_name", "column_name", "issue", "affected_row_count").orderBy(
        "table_name", F.desc("affected_row_count")
    )


def pipeline_status(load_log: DataFrame) -> DataFrame:
    """Last state of every pipeline."""
    newest = quality.pick_last(load_log, ["pipeline"], ["load_ts", "status"])
    return newest.select(
        "pipeline", "layer", "table_name", F.col("status").alias("last_run_status"),
        F.col("load_ts").alias("last_run_ts"), F.col("batch_id").alias("last_batch_id"),
    )


def row(spark: SparkSession, log: str, **values: object) -> DataFrame:
    """One ledger row; columns left out are NULL."""
    schema = SCHEMAS[log]
    names = [part.split()[0] for part in schema.split(", ")]
    unknown = set(values) - set(names)
    if unknown:
        raise ValueError(f"no such ledger columns: {sorted(unknown)}")
    return spark.createDataFrame([tuple(values.get(n) for n in names)], schema)


def append(frame: DataFrame, root: str, log: str) -> None:
    frame.coalesce(1).write.mode("append").parquet(f"{root}/audit/{log}")


def create(spark: SparkSession, root: str) -> None:
    """Create the ledger tables that do not exist yet."""
    for log, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{root}/audit/{log}")


def read(spark: SparkSession, root: str, log: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[log]).parquet(f"{root}/audit/{log}")


def add_column(
    df: DataFrame, name: str, kind: str, default: object = None, backfill: Column | None = None
) -> DataFrame:
    """Schema change: a new column, filled by an expression or a default."""
    value = F.lit(default) if backfill is None else F.coalesce(backfill, F.lit(default))
    return df.withColumn(name, value.cast(kind))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)
