"""Upsert with soft delete, and surrogate keys for new members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

INSERT, UPDATE, SOFT_DELETE, NOOP = "INSERT", "UPDATE", "SOFT_DELETE", "NOOP"


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    now: Column,
    protect: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The table after a load, with ``_action`` per row.

    ``source`` holds unique, non-null keys, content columns and ``row_hash``; ``target`` has the
    same plus ``is_deleted``, ``updated_at`` and, if kept, ``deleted_at``. New keys are inserted; a
    changed hash or a deleted row that came back is updated and live again; a live row missing
    from the source is soft deleted unless ``protect`` (an expression over target columns)
    holds. ``keep`` names columns that are set on insert and never change. One full outer join
    on the key.
    """
    content = [c for c in source.columns if c not in keys]
    state = [c for c in target.columns if c not in keys]
    guard = F.lit(False) if protect is None else protect
    old = target.select(*keys, guard.alias("_protected"), F.struct(*state).alias("t"))
    new = source.select(*keys, F.struct(*content).alias("s"))
    both = old.join(new, list(keys), "full_outer")

    arrived, known = F.col("s").isNotNull(), F.col("t").isNotNull()
    differs = ~F.col("s.row_hash").eqNullSafe(F.col("t.row_hash")) | F.col("t.is_deleted")
    action = (
        F.when(~known, F.lit(INSERT))
        .when(arrived & differs, F.lit(UPDATE))
        .when(~arrived & ~F.col("t.is_deleted") & ~F.col("_protected"), F.lit(SOFT_DELETE))
        .otherwise(F.lit(NOOP))
    )
    both = both.withColumn("_action", action)
    fresh = F.col("_action").isin(INSERT, UPDATE)
    gone = F.col("_action") == SOFT_DELETE

    result: list[Column] = []
    for column in target.columns:
        before = F.col(f"t.{column}") if column not in keys else None
        if column in keys:
            value = F.col(column)
        elif column == "is_deleted":
            value = F.when(fresh, False).when(gone, True).otherwise(before)
        elif column == "deleted_at":
            value = F.when(gone, now).when(~fresh, before)
        elif column == "updated_at":
            value = F.when(fresh | gone, now).otherwise(before)
        elif column in keep:
            value = F.coalesce(before, F.col(f"s.{column}"))
        elif column in content:
            value = F.when(fresh, F.col(f"s.{column}")).otherwise(before)
        else:
            value = before
        result.append(value.alias(column))
    return both.select(*result, "_action")


def action_counts(merged: DataFrame) -> DataFrame:
    """One row: inserted, updated (soft deletes included) and deleted, which is always zero."""
    return merged.agg(
        F.count_if(F.col("_action") == INSERT).alias("rows_inserted"),
        F.count_if(F.col("_action").isin(UPDATE, SOFT_DELETE)).alias("rows_updated"),
        F.lit(0).cast("long").alias("rows_deleted"),
    )


def slice_digits(partitions: int) -> int:
    """Hex digits that cut keys into at least four slices a partition: the fewest that do, one at least."""
    digits = 1
    while 16**digits < 4 * partitions:
        digits += 1
    return digits


def assign_keys(rows: DataFrame, natural_key: str, start: Column, name: str, digits: int | None = None) -> DataFrame:
    """Number unique natural keys start+1, start+2, ... in order of their digest.

    The first hex ``digits`` of the digest (see :func:`slice_digits`) cut the keys into even slices. Rows are numbered inside
    their slice; slice offsets come from a table of one row per slice, at most 64 for each shuffle partition, which is the only
    thing that is sorted as a whole. The numbers do not depend on the digits.
    """
    if digits is None:
        digits = slice_digits(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    digest = F.md5(F.col(natural_key).cast("binary"))
    sliced = rows.withColumn("_digest", digest).withColumn("_slice", F.substring("_digest", 1, digits))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.count("*").alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_slice").orderBy("_digest", natural_key)
    numbered = sliced.withColumn("_place", F.row_number().over(inside))
    return (
        numbered.join(offsets, "_slice")
        .withColumn(name, (start + F.col("_offset") + F.col("_place")).cast("long"))
        .drop("_slice", "_digest", "_place", "_offset")
    )


def merge_dimension(
    target: DataFrame, source: DataFrame, natural_key: str, surrogate: str, now: Column
) -> DataFrame:
    """Type 1 dimension load: existing members keep their surrogate, new ones get the next.

    Source and target meet in one join; only the rows it inserts are numbered. The unknown member (surrogate -1) is never soft
    deleted.
    """
    newest = target.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("top"))
    start = F.greatest(newest.scalar(), F.lit(0))
    unnumbered = source.withColumn(surrogate, F.lit(None).cast("long"))
    merged = merge_upsert(target, unnumbered, [natural_key], now, protect=F.col(surrogate) == -1, keep=[surrogate])
    fresh = merged.where(F.col("_action") == INSERT).drop(surrogate)
    numbered = assign_keys(fresh, natural_key, start, surrogate).select(*merged.columns)
    return merged.where(F.col("_action") != INSERT).unionByName(numbered)


def insert_missing(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The target plus the rows whose key it lacks; running it twice adds nothing."""
    return target.unionByName(rows.join(target.select(key), key, "left_anti").select(*target.columns))
