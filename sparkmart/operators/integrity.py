"""Referential checks and duplicate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent and how many rows carry each.

    Both sides are reduced to distinct keys before they meet, so no key is heavier than another.
    Rows with a NULL key have no parent and are counted too.
    """
    carried = child.groupBy(F.col(child_key).alias("orphan_key")).agg(F.count("*").alias("row_count"))
    known = parent.select(F.col(parent_key).alias("orphan_key")).distinct()
    return carried.join(known, "orphan_key", "left_anti")


def orphan_rows(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, name: str) -> DataFrame:
    """One row: how many child rows have no parent."""
    orphans = orphan_keys(child, parent, child_key, parent_key)
    return orphans.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias(name))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "duplicate_cnt") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).where(F.col(name) > 1)
