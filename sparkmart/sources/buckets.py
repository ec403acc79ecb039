"""Tables kept in buckets of their key, of which a load writes only those that it changes.

A version is a manifest, one row for each bucket with the version that wrote it. A load compares a count and a digest of each bucket's live
keys and hashes with those of the delivery, reads and merges the buckets that differ, writes these alone and names the others as they
were. Readers of the version before are not disturbed, and a half-written version is never named.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions import text
from sparkmart.operators import merge

BUCKET = "_bucket"
#: Hex digits of the key's digest that name its bucket: 16 ** DIGITS buckets, the most that a manifest has rows.
DIGITS = 2
_PREFIX = "b-"


def bucket_of(keys: Sequence[str], digits: int = DIGITS) -> Column:
    """The bucket of a row's key; the letter keeps the names text."""
    return F.concat(F.lit("b"), F.substring(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).cast("binary")), 1, digits))


def is_bucketed(version: str) -> bool:
    return version.startswith(_PREFIX)


def _folder(root: str, table: str, version: str) -> str:
    return f"{root}/{table}/version={version}"


def manifest(spark: SparkSession, root: str, table: str, version: str) -> dict[str, str]:
    """Bucket to the version that wrote it; at most one row for each bucket."""
    rows = spark.read.parquet(f"{root}/{table}/manifest={version}").select("bucket", "version").collect()
    return {r["bucket"]: r["version"] for r in rows}


def read_buckets(spark: SparkSession, root: str, table: str, buckets: dict[str, str]) -> DataFrame:
    """The rows of these buckets, each from the version named, with their bucket."""
    paths = [f"{_folder(root, table, v)}/{BUCKET}={b}" for b, v in sorted(buckets.items())]
    return spark.read.option("basePath", f"{root}/{table}").parquet(*paths).drop("version", "_action")


def read(spark: SparkSession, root: str, table: str, version: str) -> DataFrame | None:
    """The rows of a version; None if it has none."""
    buckets = manifest(spark, root, table, version)
    return read_buckets(spark, root, table, buckets).drop(BUCKET) if buckets else None


def _digests(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """One row for each bucket: how many rows it has, and a sum over their keys and hashes. Nothing but these is shuffled."""
    one = F.xxhash64(*keys, "row_hash").cast("decimal(20,0)")
    return rows.groupBy(BUCKET).agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(one).alias("digest")).alias(name))


def load(
    spark: SparkSession,
    root: str,
    table: str,
    before: str | None,
    source: DataFrame,
    keys: Sequence[str],
    now: Column,
    digits: int = DIGITS,
    protect: Column | None = None,
) -> dict:
    """Merge a whole delivery as :func:`merge_upsert` does and publish a version; returns it with the counts of its actions.

    ``source`` has unique, non-null keys, content and ``row_hash``. A bucket is left as it is if its live, unprotected rows have the
    delivery's keys and hashes, for then every row would be untouched. ``digits`` must stay what it was at a table's first load.
    """
    version = f"{_PREFIX}{uuid.uuid4().hex}"
    by = [*keys, BUCKET]
    delivered = source.withColumn(BUCKET, bucket_of(keys, digits))
    old = manifest(spark, root, table, before) if before and is_bucketed(before) else {}
    # A version that was published whole is dealt to buckets now, all of them.
    whole = spark.read.parquet(_folder(root, table, before)).drop("_action").withColumn(BUCKET, bucket_of(keys, digits)) if before and not is_bucketed(before) else None
    mine = _digests(delivered, keys, "mine")
    if whole is not None:
        mine = mine.select(BUCKET).unionByName(whole.select(BUCKET)).distinct()
    elif old:
        live = ~F.col("is_deleted") if protect is None else ~F.col("is_deleted") & ~F.coalesce(protect, F.lit(False))
        theirs = _digests(read_buckets(spark, root, table, old).where(live), keys, "theirs")
        mine = mine.join(theirs, BUCKET, "full_outer").where(~F.col("mine").eqNullSafe(F.col("theirs")))
    touched = sorted(r[BUCKET] for r in mine.select(BUCKET).collect())  # at most one row for each bucket
    now_there = {b: v for b, v in old.items() if b not in touched}
    counts = {"rows_inserted": 0, "rows_updated": 0, "rows_deleted": 0}
    if touched:
        present = {b: v for b, v in old.items() if b in touched}
        fresh = delivered.where(F.col(BUCKET).isin(touched)) if len(touched) < 16**digits else delivered
        if whole is not None:
            target = whole
        elif present:
            target = read_buckets(spark, root, table, present)
        else:
            target = fresh.limit(0).selectExpr("*", "false AS is_deleted", "CAST(NULL AS timestamp) AS deleted_at", "CAST(NULL AS timestamp) AS updated_at")
        merged = merge.merge_upsert(target, fresh, by, now, protect)
        merged.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(_folder(root, table, version))
        written = spark.read.parquet(_folder(root, table, version))
        counts = merge.action_counts(written).first().asDict()
        now_there |= {b: version for b in touched}
    rows = spark.createDataFrame(sorted(now_there.items()), "bucket string, version string")
    rows.coalesce(1).write.parquet(f"{root}/{table}/manifest={version}")
    return {**counts, "rows_processed": counts["rows_inserted"] + counts["rows_updated"], "version": version, "buckets_written": len(touched), "buckets": len(now_there)}


def _buckets_in(spark: SparkSession, folder: str) -> list[str]:
    """The buckets that a write has left in a folder, from its listing."""
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [f.getPath().getName() for f in top.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(top)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{BUCKET}="))


def replace(
    spark: SparkSession, root: str, table: str, before: str | None, rows: DataFrame, touched: Sequence[str] | None = None, packed: Sequence[str] = ()
) -> dict:
    """Publish a version in which the touched buckets (all, if not named) hold these rows, which name theirs in BUCKET.

    Other buckets stay as the version before has them; a touched bucket without rows is gone. Ids named in ``packed`` are moved packed
    and written as text; they may come packed.
    """
    version = f"{_PREFIX}{uuid.uuid4().hex}"
    old = manifest(spark, root, table, before) if before and touched is not None else {}
    there = {b: v for b, v in old.items() if b not in set(touched or ())}
    written, count = [], 0
    if touched is None or len(touched):
        folder = _folder(root, table, version)
        dealt = text.packed(rows, *packed).hint("rebalance", F.col(BUCKET)).withColumns({c: text.unpacked_id(F.col(c)) for c in packed})
        dealt.write.partitionBy(BUCKET).option("compression", "zstd").parquet(folder)
        written = _buckets_in(spark, folder)
        count = read_buckets(spark, root, table, dict.fromkeys(written, version)).count() if written else 0
    there |= dict.fromkeys(written, version)
    spark.createDataFrame(sorted(there.items()), "bucket string, version string").coalesce(1).write.parquet(f"{root}/{table}/manifest={version}")
    return {"rows": count, "version": version, "buckets_written": len(written), "buckets": len(there)}


def unused_buckets(spark: SparkSession, root: str, table: str, named: Sequence[str], keep: Sequence[str]) -> list[str]:
    """The folders that the named versions wrote and no kept version refers to."""
    kept = {(b, v) for k in keep for b, v in manifest(spark, root, table, k).items()}
    gone = {(b, v) for k in named for b, v in manifest(spark, root, table, k).items()} - kept
    return sorted(f"{_folder(root, table, v)}/{BUCKET}={b}" for b, v in gone)
