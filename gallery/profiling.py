"""Exploration of the raw entities."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gallery.base import Tables, example
from gallery.oracle import any_ts, dec, num, pct, ts, with_ctes
from gallery.standins import RAW
from sparkmart.functions import parse
from sparkmart.operators import integrity, stats
from sparkmart.plans import entities, profile

_COLUMNS = {name: entities.ENTITIES[name].columns for name in RAW}


def _union(branches: list[str]) -> str:
    return with_ctes(" UNION ALL ".join(branches))


def _per_column(entity: str, values: str, columns: list[str] | None = None) -> str:
    """One branch per column; ``{c}`` in ``values`` stands for the column."""
    return _union([
        f"SELECT '{c}' AS column_name, {values.replace('{c}', c)} FROM raw_{entity}"
        for c in columns or _COLUMNS[entity]
    ])


@example("E-02, A-01, U-01", _union([f"SELECT '{e}' AS entity, count(*) AS total_rows FROM raw_{e}" for e in RAW]))
def row_counts(t: Tables):
    """Rows per raw entity."""
    frames = [profile.row_count(t.raw(e)).select(F.lit(e).alias("entity"), "total_rows") for e in RAW]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _as_text(columns: list[str]) -> str:
    return " || '|' || ".join(f"coalesce({c}, '(NULL)')" for c in columns)


@example("E-01, O-03", _union([
    f"SELECT '{e}' AS entity, place, row_text FROM (SELECT {_as_text(c)} AS row_text, row_number() OVER (ORDER BY {_as_text(c)}) AS place "
    f"FROM raw_{e}) WHERE place <= 10" for e, c in _COLUMNS.items()]))
def preview_rows(t: Tables):
    """Ten rows of each raw entity, the first by their text, so that they are the same every time."""
    result = None
    for e, columns in _COLUMNS.items():
        text = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("(NULL)")) for c in columns])
        shown = profile.preview(t.raw(e).select(text.alias("row_text")).orderBy("row_text"))
        # the window sees the ten rows of the preview only
        numbered = shown.withColumn("place", F.row_number().over(Window.orderBy("row_text")).cast("long")).withColumn("entity", F.lit(e))
        result = numbered if result is None else result.unionByName(numbered)
    return result


def _register_columns() -> None:
    plain = "min(length(rtrim({c}))) AS min_length, max(length(rtrim({c}))) AS max_length"
    bare = "length(trim(replace({c}, '\"', '')))"
    clean = f"min({bare}) AS min_length_quotes_cleansed, max({bare}) AS max_length_quotes_cleansed"
    nulls = "count(*) FILTER (WHERE {c} IS NULL) AS null_count"
    empty = "count(*) FILTER (WHERE trim(replace({c}, '\"', '')) = '') AS empty_count"
    for e, cols in _COLUMNS.items():
        example("E-03, P-06, F-25", _per_column(e, plain), f"text_lengths_{e}")(
            lambda t, e=e, cols=cols: profile.text_lengths(t.raw(e), cols))
        example("E-04, F-02", _per_column(e, clean), f"unquoted_lengths_{e}")(
            lambda t, e=e, cols=cols: profile.text_lengths(t.raw(e), cols, unquote=True))
        example("E-05, A-04, P-07", _per_column(e, nulls), f"null_counts_{e}")(
            lambda t, e=e, cols=cols: profile.null_counts(t.raw(e), cols))
        example("E-06, A-04", _per_column(e, empty), f"empty_counts_{e}")(
            lambda t, e=e, cols=cols: profile.empty_counts(t.raw(e), cols))


_register_columns()


def _failures(entity: str, parsers: dict[str, str]) -> str:
    return _union([
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NOT NULL AND {e} IS NULL) AS failure_count "
        f"FROM raw_{entity}" for c, e in parsers.items()
    ])


_ORDER_DATES = _COLUMNS["orders"][3:]
_SIZES = _COLUMNS["products"][2:]


@example("E-07, F-04", _failures("orders", {c: ts(c) for c in _ORDER_DATES}))
def parse_failures_orders(t: Tables):
    """Order dates that do not parse."""
    return profile.parse_failures(t.raw("orders"), {c: parse.to_timestamp for c in _ORDER_DATES})


@example("E-07, F-04, F-05", _failures("order_items", {
    "shipping_limit_date": ts("shipping_limit_date"), "price": dec("price"), "freight_value": dec("freight_value")}))
def parse_failures_items(t: Tables):
    """Item dates and amounts that do not parse."""
    return profile.parse_failures(t.raw("order_items"), {
        "shipping_limit_date": parse.to_timestamp, "price": parse.to_decimal, "freight_value": parse.to_decimal,
    })


@example("E-07, F-05, F-06", _failures("order_payments", {
    "payment_sequential": num("payment_sequential"), "payment_installments": num("payment_installments"),
    "payment_value": dec("payment_value")}))
def parse_failures_payments(t: Tables):
    """Payment numbers that do not parse."""
    return profile.parse_failures(t.raw("order_payments"), {
        "payment_sequential": parse.to_int, "payment_installments": parse.to_int, "payment_value": parse.to_decimal,
    })


@example("E-07, F-06", _failures("products", {c: num(c) for c in _SIZES}))
def parse_failures_products(t: Tables):
    """Product numbers that do not parse."""
    return profile.parse_failures(t.raw("products"), {c: parse.to_int for c in _SIZES})


@example("E-07, F-04", _failures("order_reviews", {
    c: any_ts(c) for c in ("review_creation_date", "review_answer_timestamp")}))
def parse_failures_reviews(t: Tables):
    """Review dates that do not parse in any ISO form."""
    names = ("review_creation_date", "review_answer_timestamp")
    return profile.parse_failures(t.raw("order_reviews"), {c: parse.to_any_timestamp for c in names})


@example("E-07, F-07", _failures("geolocation", {
    c: f"try_cast(trim({c}) AS double)" for c in ("geolocation_lat", "geolocation_lng")}))
def parse_failures_geolocation(t: Tables):
    """Coordinates that are not numbers; quoted ones count as failures here."""
    return profile.parse_failures(t.raw("geolocation"), {
        c: parse.to_double for c in ("geolocation_lat", "geolocation_lng")})


_BARE_ZIP = "trim(replace(geolocation_zip_code_prefix, '\"', ''))"


@example("E-08, P-03", with_ctes(f"""
SELECT count(*) FILTER (WHERE length({_BARE_ZIP}) <> 5) AS invalid_length,
       count(*) FILTER (WHERE length({_BARE_ZIP}) = 5 AND regexp_matches({_BARE_ZIP}, '[^0-9]')) AS invalid_format
FROM raw_geolocation WHERE geolocation_zip_code_prefix IS NOT NULL"""))
def zip_format_geolocation(t: Tables):
    """Geolocation zips of the wrong length or form."""
    return profile.zip_format(t.raw("geolocation"), "geolocation_zip_code_prefix")


@example("E-08, P-04", with_ctes("""
SELECT count(*) AS invalid_zip_format FROM raw_sellers
WHERE NOT regexp_full_match(trim(replace(seller_zip_code_prefix, '"', '')), '[0-9]{5}')"""))
def zip_mismatch_sellers(t: Tables):
    """Seller zips that are not five digits."""
    return profile.zip_mismatch(t.raw("sellers"), "seller_zip_code_prefix")


@example("E-09, A-09", with_ctes("""
SELECT order_id, order_item_id, count(*) AS duplicate_cnt FROM raw_order_items GROUP BY ALL HAVING count(*) > 1"""))
def duplicate_item_keys(t: Tables):
    """Item keys that occur more than once."""
    return integrity.duplicate_keys(t.raw("order_items"), ["order_id", "order_item_id"])


@example("E-09", with_ctes("""
SELECT customer_unique_id, count(*) AS duplicate_cnt FROM raw_customers GROUP BY ALL HAVING count(*) > 1"""))
def duplicate_people(t: Tables):
    """People with several customer ids."""
    return integrity.duplicate_keys(t.raw("customers"), ["customer_unique_id"])


_PLACE = ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"]


@example("E-09", with_ctes(f"""
SELECT {', '.join(_PLACE)}, count(*) AS cnt FROM raw_geolocation GROUP BY ALL HAVING count(*) > 1"""))
def duplicate_places(t: Tables):
    """Geolocation rows that occur more than once, all columns alike."""
    return integrity.duplicate_keys(t.raw("geolocation"), _PLACE, "cnt")


def _register_duplicates() -> None:
    for name, entity, key in (
        ("orders", "orders", "order_id"), ("customers", "customers", "customer_id"), ("reviews", "order_reviews", "review_id"),
        ("products", "products", "product_id"), ("sellers", "sellers", "seller_id"),
        ("categories", "product_category_name_translation", "product_category_name"),
        ("category_names", "product_category_name_translation", "product_category_name_english"),
    ):
        sql = with_ctes(f"SELECT {key}, count(*) AS duplicate_cnt FROM raw_{entity} GROUP BY 1 HAVING count(*) > 1")
        example("E-09, A-09", sql, f"duplicate_{name}")(lambda t, e=entity, k=key: integrity.duplicate_keys(t.raw(e), [k]))


_register_duplicates()


def _share(entity: str, column: str, expression: str | None = None) -> str:
    value = expression or column
    return with_ctes(f"""
SELECT {value} AS {column}, count(*) AS cnt, {pct('count(*)', f'(SELECT count(*) FROM raw_{entity})')} AS pct
FROM raw_{entity} GROUP BY 1""")


def _register_shares() -> None:
    for entity, column in (
        ("orders", "order_status"), ("customers", "customer_state"), ("geolocation", "geolocation_state"),
        ("order_payments", "payment_type"), ("order_reviews", "review_score"), ("sellers", "seller_state"),
    ):
        example("E-10, W-04, F-26", _share(entity, column), f"distribution_{column}")(
            lambda t, e=entity, c=column: stats.distribution(t.raw(e), c))


_register_shares()


@example("E-10, F-10", _share("products", "category", "coalesce(product_category_name, '(NULL)')"))
def distribution_category(t: Tables):
    """Products per category, the missing one shown as (NULL)."""
    label = F.coalesce("product_category_name", F.lit("(NULL)"))
    return stats.distribution(t.raw("products"), label, "category")


@example("E-11, A-10", with_ctes(f"""
SELECT {num('order_item_id')} AS item_position, count(*) AS cnt FROM raw_order_items GROUP BY 1"""))
def item_positions(t: Tables):
    """Items per position."""
    return profile.code_distribution(t.raw("order_items"), "order_item_id", "item_position")


@example("E-11", with_ctes(f"""
SELECT {num('payment_installments')} AS installments, count(*) AS cnt FROM raw_order_payments
WHERE {num('payment_installments')} IS NOT NULL GROUP BY 1"""))
def installments(t: Tables):
    """Payments per number of installments."""
    return profile.code_distribution(t.raw("order_payments"), "payment_installments", "installments", keep_null=False)


@example("E-11", with_ctes(f"""
SELECT {num('product_photos_qty')} AS photos_qty, count(*) AS cnt FROM raw_products
WHERE {num('product_photos_qty')} IS NOT NULL GROUP BY 1"""))
def photos_per_product(t: Tables):
    """Products per number of photos."""
    return profile.code_distribution(t.raw("products"), "product_photos_qty", "photos_qty", keep_null=False)


@example("E-12, A-06, F-21", with_ctes(f"""
SELECT cast(min(x) AS string) AS earliest, cast(max(x) AS string) AS latest, date_diff('day', min(x), max(x)) AS date_range_days
FROM (SELECT {ts('order_purchase_timestamp')} AS x FROM raw_orders)"""))
def order_date_range(t: Tables):
    """First and last purchase."""
    found = profile.date_range(t.raw("orders"), "order_purchase_timestamp")
    return found.select(F.col("earliest").cast("string"), F.col("latest").cast("string"), "date_range_days")


@example("E-12", _union([
    f"SELECT '{c}' AS column_name, cast(min({any_ts(c)}) AS string) AS earliest, cast(max({any_ts(c)}) AS string) AS latest "
    "FROM raw_order_reviews" for c in ("review_creation_date", "review_answer_timestamp")]))
def review_date_ranges(t: Tables):
    """First and last moment of both review dates."""
    found = profile.stamp_ranges(t.raw("order_reviews"), ["review_creation_date", "review_answer_timestamp"])
    return found.select("column_name", F.col("earliest").cast("string"), F.col("latest").cast("string"))


@example("E-13", with_ctes("""
SELECT order_status, count(*) AS total, count(*) FILTER (WHERE order_approved_at IS NULL) AS null_order_approved_at,
       count(*) FILTER (WHERE order_delivered_carrier_date IS NULL) AS null_order_delivered_carrier_date,
       count(*) FILTER (WHERE order_delivered_customer_date IS NULL) AS null_order_delivered_customer_date
FROM raw_orders GROUP BY order_status"""))
def null_dates_by_status(t: Tables):
    """Missing dates per status."""
    return profile.nulls_by_group(t.raw("orders"), "order_status", [
        "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"])


_PARSED = ", ".join(f"{ts(c)} AS {c}_ts" for c in _ORDER_DATES)
_DATED = f"(SELECT *, {_PARSED} FROM raw_orders)"


@example("E-14, P-09", with_ctes(f"""
SELECT count(*) FILTER (WHERE order_delivered_carrier_date_ts < order_purchase_timestamp_ts) AS carrier_before_purchase,
       count(*) FILTER (WHERE order_delivered_customer_date_ts < order_delivered_carrier_date_ts) AS customer_before_carrier,
       count(*) FILTER (WHERE order_delivered_customer_date_ts < order_purchase_timestamp_ts) AS customer_before_purchase,
       count(*) FILTER (WHERE order_status = 'delivered' AND order_delivered_customer_date IS NULL) AS delivered_without_date,
       count(*) FILTER (WHERE order_status <> 'delivered' AND order_delivered_customer_date IS NOT NULL)
           AS date_without_delivered_status
FROM {_DATED}"""))
def date_chain_violations(t: Tables):
    """Orders whose dates contradict each other."""
    return profile.date_chain_violations(t.raw("orders"))


_LEAD = "date_diff('day', order_purchase_timestamp_ts, order_delivered_customer_date_ts)"


@example("E-15, A-08", with_ctes(f"""
SELECT min({_LEAD}) AS min_delivery_days, max({_LEAD}) AS max_delivery_days, cast(trunc(avg({_LEAD})) AS integer) AS avg_delivery_days
FROM {_DATED} WHERE order_status = 'delivered'"""))
def delivery_times(t: Tables):
    """Shortest, longest and average delivery."""
    return profile.delivery_times(t.raw("orders"))


@example("E-16", with_ctes(f"""
SELECT late_deliveries, {pct('late_deliveries', 'n')} AS pct_late FROM (
    SELECT count(*) FILTER (WHERE order_delivered_customer_date_ts > order_estimated_delivery_date_ts) AS late_deliveries,
           count(*) AS n FROM {_DATED} WHERE order_status = 'delivered')"""))
def late_deliveries(t: Tables):
    """Deliveries after the promised date."""
    return profile.late_deliveries(t.raw("orders"))


@example("E-17, O-02", with_ctes(f"""
SELECT order_id, order_purchase_timestamp, order_delivered_customer_date, {_LEAD} AS delivery_days_outliers
FROM {_DATED} WHERE {_LEAD} > 60 ORDER BY 4 DESC, order_id NULLS FIRST LIMIT 10"""))
def slow_deliveries(t: Tables):
    """The ten slowest deliveries beyond sixty days."""
    return profile.slow_deliveries(t.raw("orders"))


@example("E-18, F-24, O-01", with_ctes(f"""
SELECT strftime(order_purchase_timestamp_ts, '%Y-%m') AS year_month, count(*) AS total_orders
FROM {_DATED} WHERE order_purchase_timestamp_ts IS NOT NULL GROUP BY 1"""))
def orders_per_month(t: Tables):
    """Orders per month."""
    return profile.per_month(t.raw("orders"), "order_purchase_timestamp").orderBy("year_month")


@example("E-19, A-02", with_ctes("""
SELECT count(*) AS total_rows, count(DISTINCT customer_id) AS distinct_customer_id,
       count(DISTINCT customer_unique_id) AS distinct_customer_unique_id,
       count(DISTINCT customer_id) - count(DISTINCT customer_unique_id) AS returning_customers FROM raw_customers"""))
def returning_customers(t: Tables):
    """Customer ids against people."""
    return profile.returning_customers(t.raw("customers"))


@example("E-20, O-02", with_ctes("""
SELECT customer_city, customer_state, count(*) AS cnt FROM raw_customers GROUP BY 1, 2
ORDER BY cnt DESC, customer_city NULLS LAST, customer_state NULLS LAST LIMIT 10"""))
def top_customer_cities(t: Tables):
    """Ten cities with most customers."""
    return profile.top_groups(t.raw("customers"), ["customer_city", "customer_state"])


@example("E-20", with_ctes("""
SELECT seller_city, seller_state, count(*) AS cnt FROM raw_sellers GROUP BY 1, 2
ORDER BY cnt DESC, seller_city NULLS LAST, seller_state NULLS LAST LIMIT 10"""))
def top_seller_cities(t: Tables):
    """Ten cities with most sellers."""
    return profile.top_groups(t.raw("sellers"), ["seller_city", "seller_state"])


def _city_states(entity: str, prefix: str) -> str:
    return with_ctes(f"""
SELECT {prefix}_city, count({prefix}_state) AS distinct_states, string_agg({prefix}_state, ', ' ORDER BY {prefix}_state) AS states
FROM (SELECT DISTINCT {prefix}_city, {prefix}_state FROM raw_{entity} WHERE {prefix}_city IS NOT NULL) GROUP BY 1 HAVING count({prefix}_state) > 1""")


@example("E-21, A-11, A-13", _city_states("customers", "customer"))
def customer_cities_in_states(t: Tables):
    """Customer cities that lie in several states."""
    return stats.joined_values(t.raw("customers"), "customer_city", "customer_state", "distinct_states", "states")


@example("E-21", _city_states("geolocation", "geolocation"))
def geolocation_cities_in_states(t: Tables):
    """Geolocation cities that lie in several states."""
    return stats.joined_values(
        t.raw("geolocation"), "geolocation_city", "geolocation_state", "distinct_states", "states")


@example("E-21", _city_states("sellers", "seller"))
def seller_cities_in_states(t: Tables):
    """Seller cities that lie in several states."""
    return stats.joined_values(t.raw("sellers"), "seller_city", "seller_state", "distinct_states", "states")


_SPOT = "concat(geolocation_zip_code_prefix, '|', geolocation_lat, '|', geolocation_lng)"


@example("E-22, A-03", with_ctes(f"""
SELECT count(*) AS total_rows, count(DISTINCT geolocation_zip_code_prefix) AS distinct_zip_prefixes,
       count(DISTINCT {_SPOT}) AS distinct_coordinates, count(*) - count(DISTINCT {_SPOT}) AS duplicate_coordinates
FROM raw_geolocation"""))
def coordinate_counts(t: Tables):
    """Zips, spots and repeated spots."""
    return profile.coordinate_counts(t.raw("geolocation"))


def _edge(f: str, c: str) -> str:
    return f"{f}(try_cast(trim(geolocation_{c}) AS double)) AS {f}_{c}"


@example("E-23", with_ctes(f"""
SELECT geolocation_zip_code_prefix, count(*) AS cnt, {_edge('min', 'lat')}, {_edge('max', 'lat')}, {_edge('min', 'lng')},
       {_edge('max', 'lng')}, count(DISTINCT geolocation_lat) AS distinct_lats, count(DISTINCT geolocation_lng) AS distinct_lngs
FROM (SELECT geolocation_zip_code_prefix, geolocation_lat, replace(geolocation_lng, '"', '') AS geolocation_lng
      FROM raw_geolocation WHERE geolocation_zip_code_prefix IS NOT NULL) GROUP BY 1 HAVING count(*) > 1"""))
def coordinate_spread(t: Tables):
    """How far the spots of one zip lie apart."""
    rows = t.raw("geolocation").where(F.col("geolocation_zip_code_prefix").isNotNull())
    return profile.coordinate_spread(rows.withColumn(
        "geolocation_lng", F.replace(F.col("geolocation_lng"), F.lit('"'), F.lit(""))))


@example("E-24", with_ctes("""
SELECT count(DISTINCT geolocation_zip_code_prefix) AS distinct_zips, min(geolocation_zip_code_prefix) AS min_zip,
       max(geolocation_zip_code_prefix) AS max_zip FROM raw_geolocation"""))
def zip_range(t: Tables):
    """First and last zip."""
    return profile.key_range(t.raw("geolocation"), "geolocation_zip_code_prefix")


@example("E-25, A-14", with_ctes(f"""
SELECT count(order_id) AS total_orders, count(*) FILTER (WHERE n > 1) AS multi_item_orders,
       {pct('count(*) FILTER (WHERE n > 1)', 'count(*)')} AS pct_multi_item
FROM (SELECT order_id, count(*) AS n FROM raw_order_items GROUP BY 1)"""))
def multi_item_orders(t: Tables):
    """Orders with several items."""
    return profile.multi_item_orders(t.raw("order_items"))


def _summary(entity: str, column: str, label: str) -> str:
    return with_ctes(f"""
SELECT cast(min(v) AS double) AS min_{label}, cast(max(v) AS double) AS max_{label},
       cast(sum(v) AS double) / count(v) AS avg_{label}, round(cast(quantile_cont(v, 0.5) AS double), 2) AS median_{label}
FROM (SELECT {dec(column)} AS v FROM raw_{entity})""")


@example("E-26, A-12, W-05", _summary("order_items", "price", "price"))
def price_summary(t: Tables):
    """Price range, mean and exact median."""
    return profile.amount_summary(t.raw("order_items"), "price", "price")


@example("E-26, A-12", _summary("order_payments", "payment_value", "value_payment"))
def payment_summary(t: Tables):
    """Payment range, mean and exact median."""
    return profile.amount_summary(t.raw("order_payments"), "payment_value", "value_payment")


@example("E-27, A-07", with_ctes(f"""
SELECT cast(min(v) AS double) AS min_freight, cast(max(v) AS double) AS max_freight, cast(sum(v) AS double) / count(v) AS avg_freight
FROM (SELECT {dec('freight_value')} AS v FROM raw_order_items)"""))
def freight_range(t: Tables):
    """Freight range and mean."""
    return profile.amount_range(t.raw("order_items"), "freight_value", "freight")


@example("E-28", with_ctes(f"SELECT count(*) AS zero_or_negative_price FROM raw_order_items WHERE {dec('price')} <= 0"))
def non_positive_prices(t: Tables):
    """How many prices are not positive."""
    rows = profile.non_positive(t.raw("order_items"), ["price"], parse.to_decimal)
    return rows.agg(F.count("*").alias("zero_or_negative_price"))


@example("E-28, P-02", with_ctes(f"""
SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value AS zero_or_negative_payment_value
FROM raw_order_payments WHERE {dec('payment_value')} <= 0"""))
def non_positive_payments(t: Tables):
    """Payments that are not positive."""
    rows = profile.non_positive(t.raw("order_payments"), ["payment_value"], parse.to_decimal)
    return rows.withColumnRenamed("payment_value", "zero_or_negative_payment_value")


_FOUR = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]


@example("E-28", with_ctes(f"""
SELECT product_id, {', '.join(_FOUR)} FROM raw_products WHERE {' OR '.join(f'{num(c)} <= 0' for c in _FOUR)}"""))
def non_positive_sizes(t: Tables):
    """Products with a size that is not positive."""
    return profile.non_positive(t.raw("products"), _FOUR, parse.to_int).select("product_id", *_FOUR)


@example("E-29, O-02", with_ctes(f"""
SELECT order_id, product_id, order_item_id, cast({dec('price')} AS double) AS price, cast({dec('freight_value')} AS double) AS freight_value
FROM raw_order_items
ORDER BY {dec('price')} DESC NULLS LAST, order_id NULLS FIRST, order_item_id NULLS FIRST, product_id NULLS FIRST,
         {dec('freight_value')} NULLS FIRST LIMIT 10"""))
def top_prices(t: Tables):
    """Ten dearest items."""
    return profile.top_prices(t.raw("order_items")).withColumns({
        "price": F.col("price").cast("double"), "freight_value": F.col("freight_value").cast("double")})


@example("E-30", with_ctes(f"""
SELECT seller_id, count(*) AS total_items_sold, cast(sum({dec('price')}) AS double) AS total_revenue
FROM raw_order_items GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 10"""))
def top_sellers(t: Tables):
    """Ten sellers with most items."""
    return profile.top_sellers(t.raw("order_items")).withColumn("total_revenue", F.col("total_revenue").cast("double"))


@example("E-31, A-11", with_ctes("""
SELECT order_id, count(payment_type) AS distinct_payment_types,
       string_agg(payment_type || ' x' || n, ', ' ORDER BY payment_type) AS payment_types, cast(sum(n) AS bigint) AS row_count
FROM (SELECT order_id, payment_type, count(*) AS n FROM raw_order_payments WHERE order_id IS NOT NULL GROUP BY ALL)
GROUP BY 1 HAVING count(payment_type) > 1"""))
def mixed_payment_orders(t: Tables):
    """Orders paid in several ways."""
    return stats.repeated_values(t.raw("order_payments"), "order_id", "payment_type")


_WAIT = f"date_diff('day', {any_ts('review_creation_date')}, {any_ts('review_answer_timestamp')})"


@example("E-32, A-08", with_ctes(f"""
SELECT cast(trunc(avg({_WAIT})) AS integer) AS avg_response_days, min({_WAIT}) AS min_response_days, max({_WAIT}) AS max_response_days
FROM raw_order_reviews"""))
def response_times(t: Tables):
    """Days from review to answer."""
    return profile.response_times(t.raw("order_reviews"))


_EDGES = ", ".join(f"{f}({num(f'product_{c}')}) AS {f}_{c}" for c in ("weight_g", "length_cm", "height_cm", "width_cm")
                   for f in ("min", "max"))


@example("E-33, A-08", with_ctes(f"""
SELECT {_EDGES}, cast(trunc(avg({num('product_weight_g')})) AS integer) AS avg_weight_g FROM raw_products"""))
def product_sizes(t: Tables):
    """Smallest and largest product sizes."""
    return profile.product_sizes(t.raw("products"))


# child, child key, parent, parent key
_LINKS = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("customers", "customer_id", "orders", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_payments", "order_id", "orders", "order_id"),
    ("order_reviews", "order_id", "orders", "order_id"),
    ("products", "product_id", "order_items", "product_id"),
    ("sellers", "seller_id", "order_items", "seller_id"),
    ("geolocation", "geolocation_zip_code_prefix", "customers", "customer_zip_code_prefix"),
)


@example("E-34, J-08, J-14", _union([
    f"SELECT '{c} without {p}' AS link, count(*) AS orphan_rows FROM raw_{c} a "
    f"WHERE NOT EXISTS (SELECT 1 FROM raw_{p} b WHERE b.{pk} = a.{ck})" for c, ck, p, pk in _LINKS]))
def orphans(t: Tables):
    """Rows without a partner, for eight links between the entities."""
    result = None
    for child, child_key, parent, parent_key in _LINKS:
        found = integrity.orphan_rows(t.raw(child), t.raw(parent), child_key, parent_key, "orphan_rows")
        found = found.select(F.lit(f"{child} without {parent}").alias("link"), "orphan_rows")
        result = found if result is None else result.unionByName(found)
    return result


@example("E-35, J-08", with_ctes("""
SELECT DISTINCT product_category_name AS products_categories_without_translation FROM raw_products p
WHERE product_category_name IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM raw_product_category_name_translation x WHERE x.product_category_name = p.product_category_name)"""))
def untranslated_categories(t: Tables):
    """Categories the translation does not cover."""
    return profile.untranslated(t.raw("products"), t.raw("product_category_name_translation"))


@example("E-35, J-08", with_ctes("""
SELECT count(DISTINCT product_category_name) AS products_categories_without_translation_cnt FROM raw_products
WHERE product_category_name NOT IN (
    SELECT product_category_name FROM raw_product_category_name_translation WHERE product_category_name IS NOT NULL)"""))
def untranslated_category_count(t: Tables):
    """How many categories the translation does not cover."""
    found = profile.untranslated(t.raw("products"), t.raw("product_category_name_translation"))
    return found.agg(F.count("*").alias("products_categories_without_translation_cnt"))


