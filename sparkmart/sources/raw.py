"""Raw layer: batches of text rows, appended and never changed."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class EmptyLoad(ValueError):
    """A source delivered no rows."""


def stamp_batch(df: DataFrame, batch_id: str, file_name: str | None = None) -> DataFrame:
    """Rows with their batch, load time, file and a running row id; without a name each row names the file it was read from."""
    name = F.lit(file_name) if file_name is not None else F.element_at(F.split(F.input_file_name(), "/"), -1)
    return df.select(
        F.monotonically_increasing_id().alias("row_id"),
        *df.columns,
        F.current_timestamp().alias("load_ts"),
        name.alias("file_name"),
        F.lit(batch_id).alias("batch_id"),
    )


def append_raw(df: DataFrame, path: str, batch_id: str, file_name: str | None = None) -> int:
    """Append one batch as its own partition and return its rows; a source without rows is an error, found after the write."""
    stamp_batch(df, batch_id, file_name).write.mode("append").partitionBy("batch_id").parquet(path)
    try:
        rows = read_batch(df.sparkSession, path, batch_id).count()
    except AnalysisException:  # nothing was ever written here, so there is no schema to read
        rows = 0
    if not rows:
        raise EmptyLoad(f"no rows in {file_name or 'the source'}: is it the right path, separator and encoding?")
    return rows


def read_batch(spark: SparkSession, path: str, batch_id: str) -> DataFrame:
    """One batch: a partition filter, so other batches are not read."""
    return spark.read.parquet(path).where(F.col("batch_id") == batch_id)


def latest_batch(raw: DataFrame, load_log: DataFrame | None = None) -> DataFrame:
    """Rows of the batch loaded last. With the loads of this table from the ledger, which names the batch, only its partition is
    read; without, every batch's stamps are."""
    if load_log is not None:
        done = load_log.where(F.col("status") == "SUCCESS")
        found = done.agg(F.max_by("batch_id", F.struct("load_ts", "batch_id")).alias("b")).first()["b"]
        return raw.where(F.col("batch_id").eqNullSafe(F.lit(found).cast("string")) & F.lit(found is not None))
    newest = raw.agg(F.max_by("batch_id", F.struct("load_ts", "batch_id")).alias("b"))
    return raw.where(F.col("batch_id") == newest.scalar())


def changed_sources(sources: DataFrame, load_log: DataFrame) -> DataFrame:
    """Sources (``file_name``, ``modified_ts``) never loaded or modified after their last success."""
    success = F.max(F.when(F.col("status") == "SUCCESS", F.col("load_ts")))
    last = load_log.groupBy("file_name").agg(success.alias("last_success_ts"))
    joined = sources.join(last, "file_name", "left")
    return joined.where(F.col("last_success_ts").isNull() | (F.col("modified_ts") > F.col("last_success_ts")))


def source_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Names and modification times of the files in a folder, without reading them."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return listing.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "path",
        F.col("modificationTime").alias("modified_ts"),
    )



def file_times(spark: SparkSession, path: str) -> DataFrame:
    """Path and modification time of a file, or of the files in a folder, without reading them."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("modificationTime").alias("modified_ts"))
