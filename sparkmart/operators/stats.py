"""Distributions, exact medians and other summaries that reduce inside the tasks first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkmart.functions.numbers import percent_of


def distribution(df: DataFrame, value: Column | str, name: str | None = None) -> DataFrame:
    """Rows per value with their percentage of all rows.

    The total is a second, tiny aggregate rather than a window over all groups, so the number of
    different values does not matter.
    """
    label = name or (value if isinstance(value, str) else "value")
    expression = F.col(value) if isinstance(value, str) else value
    groups = df.groupBy(expression.alias(label)).agg(F.count("*").alias("cnt"))
    total = df.agg(F.count("*").alias("n")).scalar()
    return groups.withColumn("pct", percent_of(F.col("cnt"), total))


def median_of(df: DataFrame, column: str, scale: int = 2, slice_width: int = 100_000) -> DataFrame:
    """Exact median of a decimal column, one row ``median``, rounded to ``scale``.

    Values are counted per slice of ``slice_width`` steps; only the one or two slices that hold
    the middle are then counted value by value. Both running sums are over counts whose number
    is bounded by the decimal type, not by the rows.
    """
    step = 10**scale
    units = df.where(F.col(column).isNotNull()).select((F.col(column) * step).cast("long").alias("u"))
    sliced = units.withColumn("slice", F.floor(F.col("u") / slice_width))
    per_slice = sliced.groupBy("slice").agg(F.count("*").alias("n"))
    # ranks of the two middle rows; the same row twice when the count is odd
    total = per_slice.agg(F.sum("n").alias("total")).scalar()
    below = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    start = per_slice.withColumn("before", F.coalesce(F.sum("n").over(below), F.lit(0))).withColumn("total", total)
    wanted = start.select(
        "slice", "before", "n", F.explode(F.expr("array((total + 1) div 2, (total + 2) div 2)")).alias("rank")
    ).where((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n"))).drop("n")
    inside = sliced.join(F.broadcast(wanted.select("slice").distinct()), "slice", "left_semi")
    counted = inside.groupBy("slice", "u").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("slice").orderBy("u").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("last", F.sum("n").over(upto))
    found = wanted.join(placed, "slice").where(
        (F.col("rank") - F.col("before") <= F.col("last"))
        & (F.col("rank") - F.col("before") > F.col("last") - F.col("n"))
    )
    return found.agg(F.round(F.avg("u") / step, scale).alias("median"))


def number_summary(df: DataFrame, column: str, label: str) -> DataFrame:
    """Minimum, maximum, mean and exact median of a decimal column."""
    numbers = df.where(F.col(column).isNotNull())
    total = F.sum(F.col(column)).cast("double")
    summary = numbers.agg(
        F.min(column).cast("double").alias(f"min_{label}"),
        F.max(column).cast("double").alias(f"max_{label}"),
        (total / F.count("*")).alias(f"avg_{label}"),
    )
    return summary.withColumn(f"median_{label}", median_of(df, column).scalar())


def distinct_count(df: DataFrame, columns: Sequence[str]) -> Column:
    """Number of different non-null values (of one column) or value tuples, as a scalar."""
    keys = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return keys.select(*columns).distinct().agg(F.count("*").alias("n")).scalar()


def joined_values(df: DataFrame, by: str, value: str, distinct_name: str, list_name: str) -> DataFrame:
    """Groups with more than one different value, and those values in order as text; rows without a group are no group."""
    pairs = df.where(F.col(by).isNotNull()).select(by, value).distinct()
    listed = pairs.groupBy(by).agg(
        F.count(value).alias(distinct_name), F.expr(f"listagg({value}, ', ') within group (order by {value})").alias(list_name)
    )
    return listed.where(F.col(distinct_name) > 1)


def repeated_values(df: DataFrame, by: str, value: str) -> DataFrame:
    """Groups with several different values: how many, each value in order with its rows ("a x2, b x1"), and rows.

    Text holds one entry per different value, not per row, so it stays short however many rows a group has. Rows without a
    group are no group.
    """
    counted = df.where(F.col(by).isNotNull()).groupBy(by, value).agg(F.count("*").alias("n"))
    text = F.expr(f"concat({value}, ' x', cast(n as string))")
    grouped = counted.withColumn("run", text).groupBy(by).agg(
        F.count(value).alias(f"distinct_{value}s"),
        F.expr(f"listagg(run, ', ') within group (order by {value}, run)").alias(f"{value}s"),
        F.sum("n").alias("row_count"),
    )
    return grouped.where(F.col(f"distinct_{value}s") > 1).select(by, f"distinct_{value}s", f"{value}s", "row_count")
