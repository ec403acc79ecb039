"""Published tables: each load writes a new folder, and the run ledger says which one counts.

A reader takes the version named by the newest successful load, so a half-written or failed
version is never seen and the old one stays readable while the new one is written.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.plans import ledger
from sparkmart.sources import buckets


def version_path(root: str, table: str, version: str) -> str:
    return f"{root}/{table}/version={version}"


def write_version(df: DataFrame, root: str, table: str) -> str:
    """Write a new version and return its name. Nobody reads it until the ledger names it."""
    version = uuid.uuid4().hex
    df.write.parquet(version_path(root, table, version))
    return version


def current_version(spark: SparkSession, root: str, table: str) -> str | None:
    log = ledger.read(spark, root, "load_log").where(F.col("table_name") == table)
    found = ledger.last_success(log, "table_name", "version").first()
    return found["version"] if found else None


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The published state of a table, or None before its first load."""
    return read_version(spark, root, table, current_version(spark, root, table))


def version_exists(spark: SparkSession, root: str, table: str, version: str) -> bool:
    """Whether a version has not been removed."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}/manifest={version}" if buckets.is_bucketed(version) else version_path(root, table, version))
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_version(spark: SparkSession, root: str, table: str, version: str | None) -> DataFrame | None:
    """A table as one of its versions has it."""
    if version and buckets.is_bucketed(version):
        return buckets.read(spark, root, table, version)
    return spark.read.parquet(version_path(root, table, version)).drop("_action") if version else None


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def remove_old_versions(spark: SparkSession, root: str, table: str, keep: int = 1) -> list[str]:
    """Delete published versions but the current one and the keep before it; returns the deleted names.

    Only versions that a SUCCESS row names are touched, so one that is being written stays. Readers of a version that is deleted
    will fail, so keep as many as there are loads during the longest read.
    """
    log = ledger.read(spark, root, "load_log").where((F.col("table_name") == table) & (F.col("status") == "SUCCESS"))
    named = log.where(F.col("version").isNotNull()).orderBy(F.desc("load_ts"), F.desc("version")).select("version").collect()
    names = [r["version"] for r in named]  # one row a load
    old = names[keep + 1 :]
    several = [v for v in old if buckets.is_bucketed(v)]
    for folder in buckets.unused_buckets(spark, root, table, several, [v for v in names[: keep + 1] if buckets.is_bucketed(v)]):
        _delete(spark, folder)
    for version in old:
        _delete(spark, f"{root}/{table}/manifest={version}" if version in several else version_path(root, table, version))
        _delete(spark, f"{root}/{table}/seen={version}")
    return old


def staging_folder(spark: SparkSession, fallback: str) -> str:
    """The shared folder the cluster names for intermediate tables; the fallback where it names none."""
    return (spark.conf.get("spark.checkpoint.dir", None) or fallback).rstrip("/")


#: Removes what an execution has shuffled as soon as it ends; a Spark that does not know it goes on as before.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Inside, what a write or an action has shuffled leaves the disk when it ends, not when the driver next collects its garbage.

    The setting is the session's, and as it was afterwards. A frame that is run again shuffles again.
    """
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


@contextlib.contextmanager
def materialised(df: DataFrame, fallback: str) -> Iterator[DataFrame]:
    """Write a frame once and read it several times.

    A written table survives lost executors and is read column by column.
    The copy is removed afterwards.
    """
    spark = df.sparkSession
    path = f"{staging_folder(spark, fallback)}/sparkmart-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    try:
        yield spark.read.parquet(path)
    finally:
        _delete(spark, path)
