"""Exploration of a raw batch. All inputs are text columns as delivered."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import dates, parse, text
from sparkmart.functions.numbers import percent_of, whole_average
from sparkmart.operators import integrity, stats


def _per_column(df: DataFrame, columns: Sequence[str], measures: Mapping[str, Callable[[str], Column]]) -> DataFrame:
    """Aggregates of many columns in one scan, turned to one row per column."""
    totals = df.agg(*[make(c).alias(f"{c}__{name}") for c in columns for name, make in measures.items()])
    lines = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{name}").alias(name) for name in measures])
        for c in columns
    ]
    return totals.select(F.inline(F.array(*lines)))


def _unquoted(c: Column) -> Column:
    return F.trim(F.replace(c, F.lit('"'), F.lit("")))


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    return df.limit(rows)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def text_lengths(df: DataFrame, columns: Sequence[str], unquote: bool = False) -> DataFrame:
    """Shortest and longest text per column, as delivered or without quotes."""
    suffix = "_quotes_cleansed" if unquote else ""

    def size(c: str) -> Column:
        return text.text_length(_unquoted(F.col(c)) if unquote else F.col(c))

    return _per_column(df, columns, {
        f"min_length{suffix}": lambda c: F.min(size(c)), f"max_length{suffix}": lambda c: F.max(size(c)),
    })


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _per_column(df, columns, {"null_count": lambda c: F.count_if(F.col(c).isNull())})


def empty_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _per_column(df, columns, {"empty_count": lambda c: F.count_if(text.is_blank(_unquoted(F.col(c))))})


def parse_failures(df: DataFrame, parsers: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Values that are given but do not parse, per column."""
    return _per_column(df, list(parsers), {
        "failure_count": lambda c: F.count_if(F.col(c).isNotNull() & parsers[c](F.col(c)).isNull()),
    })


def zip_format(df: DataFrame, column: str) -> DataFrame:
    """Zip codes of the wrong length, and five-character ones with anything but digits."""
    value = _unquoted(F.col(column))
    right = text.text_length(value) == 5
    return df.where(F.col(column).isNotNull()).agg(
        F.count_if(~right).alias("invalid_length"),
        F.count_if(right & text.contains_other_than(value, "0-9")).alias("invalid_format"),
    )


def zip_mismatch(df: DataFrame, column: str) -> DataFrame:
    """Given zip codes that are not exactly five digits."""
    return df.agg(F.count_if(~text.is_code(_unquoted(F.col(column)), "0-9", 5)).alias("invalid_zip_format"))


def code_distribution(df: DataFrame, column: str, name: str, keep_null: bool = True) -> DataFrame:
    """Rows per whole-number code."""
    code = parse.to_int(F.col(column))
    rows = df if keep_null else df.where(code.isNotNull())
    return rows.groupBy(code.alias(name)).agg(F.count("*").alias("cnt"))


def date_range(df: DataFrame, column: str) -> DataFrame:
    stamp = parse.to_timestamp(F.col(column))
    return df.agg(F.min(stamp).alias("earliest"), F.max(stamp).alias("latest")).withColumn(
        "date_range_days", dates.days_between(F.col("earliest"), F.col("latest"))
    )


def stamp_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """First and last moment per timestamp column."""
    return _per_column(df, columns, {
        "earliest": lambda c: F.min(parse.to_any_timestamp(F.col(c))),
        "latest": lambda c: F.max(parse.to_any_timestamp(F.col(c))),
    })


def nulls_by_group(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(group).agg(
        F.count("*").alias("total"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    )


def date_chain_violations(orders: DataFrame) -> DataFrame:
    """Five counts of orders whose dates or status contradict each other, in one scan."""
    bought = parse.to_timestamp(F.col("order_purchase_timestamp"))
    handed = parse.to_timestamp(F.col("order_delivered_carrier_date"))
    arrived = parse.to_timestamp(F.col("order_delivered_customer_date"))
    delivered = F.col("order_status") == "delivered"
    dated = F.col("order_delivered_customer_date").isNotNull()
    return orders.agg(
        F.count_if(handed < bought).alias("carrier_before_purchase"),
        F.count_if(arrived < handed).alias("customer_before_carrier"),
        F.count_if(arrived < bought).alias("customer_before_purchase"),
        F.count_if(delivered & ~dated).alias("delivered_without_date"),
        F.count_if(~delivered & dated).alias("date_without_delivered_status"),
    )


def delivery_times(orders: DataFrame) -> DataFrame:
    days = dates.days_between(
        parse.to_timestamp(F.col("order_purchase_timestamp")),
        parse.to_timestamp(F.col("order_delivered_customer_date")),
    )
    delivered = orders.where(F.col("order_status") == "delivered").select(days.alias("d"))
    return delivered.agg(
        F.min("d").alias("min_delivery_days"), F.max("d").alias("max_delivery_days"),
        whole_average(F.col("d")).alias("avg_delivery_days"),
    )


def late_deliveries(orders: DataFrame) -> DataFrame:
    late = parse.to_timestamp(F.col("order_delivered_customer_date")) > parse.to_timestamp(
        F.col("order_estimated_delivery_date")
    )
    counts = orders.where(F.col("order_status") == "delivered").agg(
        F.count_if(late).alias("late_deliveries"), F.count("*").alias("n")
    )
    return counts.select("late_deliveries", percent_of(F.col("late_deliveries"), F.col("n")).alias("pct_late"))


def slow_deliveries(orders: DataFrame, beyond: int = 60, k: int = 10) -> DataFrame:
    """The slowest deliveries over a limit; the order id settles ties."""
    days = dates.days_between(
        parse.to_timestamp(F.col("order_purchase_timestamp")),
        parse.to_timestamp(F.col("order_delivered_customer_date")),
    )
    rows = orders.select(
        "order_id", "order_purchase_timestamp", "order_delivered_customer_date", days.alias("delivery_days_outliers")
    ).where(F.col("delivery_days_outliers") > beyond)
    return rows.orderBy(F.desc("delivery_days_outliers"), F.asc("order_id")).limit(k)


def per_month(df: DataFrame, column: str, name: str = "total_orders") -> DataFrame:
    stamp = parse.to_timestamp(F.col(column))
    dated = df.select(dates.year_month(stamp).alias("year_month")).where(F.col("year_month").isNotNull())
    return dated.groupBy("year_month").agg(F.count("*").alias(name))


def returning_customers(customers: DataFrame) -> DataFrame:
    """Rows, order-level ids, people, and ids beyond one per person."""
    result = customers.agg(F.count("*").alias("total_rows")).select(
        "total_rows",
        stats.distinct_count(customers, ["customer_id"]).alias("distinct_customer_id"),
        stats.distinct_count(customers, ["customer_unique_id"]).alias("distinct_customer_unique_id"),
    )
    return result.withColumn(
        "returning_customers", F.col("distinct_customer_id") - F.col("distinct_customer_unique_id")
    )


def top_groups(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The k most frequent combinations; the values settle ties."""
    groups = df.groupBy(*columns).agg(F.count("*").alias("cnt"))
    return groups.orderBy(F.desc("cnt"), *[F.asc_nulls_last(c) for c in columns]).limit(k)


def coordinate_counts(geo: DataFrame) -> DataFrame:
    """Rows, zip codes, different spots, and rows that repeat a spot."""
    parts = [F.coalesce(F.col(f"geolocation_{c}"), F.lit("")).alias(c) for c in ("zip_code_prefix", "lat", "lng")]
    spots = geo.select(*parts, F.col("geolocation_zip_code_prefix").alias("zip")).groupBy(
        "zip_code_prefix", "lat", "lng"
    ).agg(F.count("*").alias("n"), F.max("zip").alias("zip"))
    # spots first, then zip codes, then one row: each level only counts what the one below found
    zips = spots.groupBy("zip_code_prefix").agg(
        F.sum("n").alias("n"), F.count("*").alias("spots"), F.max("zip").alias("zip")
    )
    return zips.agg(
        F.sum("n").alias("total_rows"),
        F.count("zip").alias("distinct_zip_prefixes"),
        F.sum("spots").alias("distinct_coordinates"),
        (F.sum("n") - F.sum("spots")).alias("duplicate_coordinates"),
    )


def coordinate_spread(geo: DataFrame) -> DataFrame:
    """Zip codes with several rows: how many, and how far they lie apart.

    One scan: each (zip, axis, value) is counted once, and a zip's line is made of its values.
    """
    by, axes = "geolocation_zip_code_prefix", ("lat", "lng")
    pairs = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(f"geolocation_{a}").alias("value")) for a in axes])
    spots = geo.groupBy(by, *[f"geolocation_{a}" for a in axes]).agg(F.count("*").alias("n"))
    values = spots.select(by, "n", F.inline(pairs)).groupBy(by, "axis", "value").agg(F.sum("n").alias("n"))
    number = parse.to_double(F.col("value"))
    edges = [f(F.when(F.col("axis") == a, number)).alias(f"{name}_{a}") for a in axes for name, f in (("min", F.min), ("max", F.max))]
    seen = [F.count_if((F.col("axis") == a) & F.col("value").isNotNull()).alias(f"distinct_{a}s") for a in axes]
    rows = values.groupBy(by).agg(F.sum(F.when(F.col("axis") == axes[0], F.col("n"))).alias("cnt"), *edges, *seen)
    return rows.where("cnt > 1")


def key_range(df: DataFrame, column: str) -> DataFrame:
    keys = df.select(column).distinct()
    return keys.agg(
        F.count(column).alias("distinct_zips"), F.min(column).alias("min_zip"), F.max(column).alias("max_zip")
    )


def multi_item_orders(items: DataFrame) -> DataFrame:
    sizes = items.groupBy("order_id").agg(F.count("*").alias("n"))
    counts = sizes.agg(
        F.count("order_id").alias("total_orders"), F.count_if(F.col("n") > 1).alias("multi_item_orders"),
        F.count("*").alias("_groups"),
    )
    return counts.withColumn("pct_multi_item", percent_of(F.col("multi_item_orders"), F.col("_groups"))).drop("_groups")


def amount_summary(df: DataFrame, column: str, label: str) -> DataFrame:
    """Minimum, maximum, mean and median of a money column."""
    return stats.number_summary(df.select(parse.to_decimal(F.col(column)).alias("v")), "v", label)


def amount_range(df: DataFrame, column: str, label: str) -> DataFrame:
    """Minimum, maximum and mean of a money column."""
    v = parse.to_decimal(F.col(column))
    return df.select(v.alias("v")).where("v IS NOT NULL").agg(
        F.min("v").cast("double").alias(f"min_{label}"),
        F.max("v").cast("double").alias(f"max_{label}"),
        (F.sum("v").cast("double") / F.count("*")).alias(f"avg_{label}"),
    )


def non_positive(df: DataFrame, columns: Sequence[str], parser: Callable[[Column], Column]) -> DataFrame:
    """Rows with a zero or negative value in any of the columns."""
    tests = [F.coalesce(parser(F.col(c)) <= 0, F.lit(False)) for c in columns]
    return df.where(F.greatest(*tests) if len(tests) > 1 else tests[0])


def top_prices(items: DataFrame, k: int = 10) -> DataFrame:
    rows = items.select(
        "order_id", "product_id", "order_item_id",
        parse.to_decimal(F.col("price")).alias("price"),
        parse.to_decimal(F.col("freight_value")).alias("freight_value"),
    )
    ties = ["order_id", "order_item_id", "product_id", "freight_value"]
    return rows.orderBy(F.desc_nulls_last("price"), *[F.asc_nulls_first(c) for c in ties]).limit(k)


def top_sellers(items: DataFrame, k: int = 10) -> DataFrame:
    groups = items.groupBy("seller_id").agg(
        F.count("*").alias("total_items_sold"),
        F.round(F.sum(parse.to_decimal(F.col("price"))), 2).alias("total_revenue"),
    )
    return groups.orderBy(F.desc("total_items_sold"), F.asc_nulls_first("seller_id")).limit(k)


def response_times(reviews: DataFrame) -> DataFrame:
    days = dates.days_between(
        parse.to_any_timestamp(F.col("review_creation_date")),
        parse.to_any_timestamp(F.col("review_answer_timestamp")),
    )
    return reviews.select(days.alias("d")).agg(
        whole_average(F.col("d")).alias("avg_response_days"),
        F.min("d").alias("min_response_days"),
        F.max("d").alias("max_response_days"),
    )


def product_sizes(products: DataFrame) -> DataFrame:
    def number(c: str) -> Column:
        return parse.to_int(F.col(c))

    sizes = ("weight_g", "length_cm", "height_cm", "width_cm")
    edges = [f(number(f"product_{c}")).alias(f"{n}_{c}") for c in sizes for n, f in (("min", F.min), ("max", F.max))]
    return products.agg(*edges, whole_average(number("product_weight_g")).alias("avg_weight_g"))


def untranslated(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Source categories in use that the translation does not cover."""
    used = products.where(F.col("product_category_name").isNotNull())
    return integrity.orphan_keys(used, translation, "product_category_name", "product_category_name").select(
        F.col("orphan_key").alias("products_categories_without_translation")
    )
