"""The checking SQL, assembled from common table expressions written for DuckDB."""

from __future__ import annotations

from gallery.standins import RAW, TABLES
from sparkmart.plans.lookups import (
    CATEGORY_LABELS, ORDER_STATUS_ROWS, ORDER_STATUSES, PAYMENT_TYPE_ROWS, PAYMENT_TYPES, STATE_NAMES,
)


def strip(c: str) -> str:
    return f"replace(trim({c}), '\"', '')"


def norm(c: str) -> str:
    # the sharp s is kept aside because upper() changes it
    raised = f"replace(upper(replace(trim({c}), 'ß', chr(57344))), chr(57344), 'ß')"
    return f"translate({raised}, 'ÁÂÃÀÉÊÍÓÔÕÚÇÄËÜ', 'AAAAEEIOOOUCAEU')"


def ts(c: str) -> str:
    return (
        rf"CASE WHEN regexp_full_match(trim({c}), '\d{{4}}-\d{{2}}-\d{{2}} \d{{2}}:\d{{2}}:\d{{2}}') "
        f"THEN try_cast(trim({c}) AS timestamp) END"
    )


def any_ts(c: str) -> str:
    return f"try_cast(trim({c}) AS timestamp)"


def dec(c: str, p: int = 10, s: int = 2) -> str:
    return f"CASE WHEN lower(trim({c})) NOT LIKE '%e%' THEN try_cast(trim({c}) AS decimal({p},{s})) END"


def num(c: str) -> str:
    return rf"CASE WHEN regexp_full_match(trim({c}), '[+-]?\d+') THEN try_cast(trim({c}) AS integer) END"


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def pct(part: str, total: str) -> str:
    return f"cast(({part} * 20000 + {total}) // (2 * {total}) AS double) / 100"


CTES: dict[str, str] = {}

for _name, _text in RAW.items():
    CTES[f"raw_{_name}"] = _text.format(**{t: t for t in TABLES})

# entity -> (columns with their cleaning, extra marks, hashed columns, keys, canonical order)
_SPECS = {
    "customers": (
        {"customer_id": strip("customer_id"), "customer_unique_id": strip("customer_unique_id"),
         "customer_zip_code_prefix": strip("customer_zip_code_prefix"), "customer_city": norm("customer_city"),
         "customer_state": norm("customer_state")},
        {}, None, ["customer_id"],
        "customer_unique_id NULLS FIRST, customer_zip_code_prefix NULLS FIRST",
    ),
    "orders": (
        {"order_id": strip("order_id"), "customer_id": strip("customer_id"), "order_status": "trim(order_status)",
         **{c: ts(c) for c in (
             "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
             "order_delivered_customer_date", "order_estimated_delivery_date")}},
        {}, None, ["order_id"], "order_purchase_timestamp NULLS LAST, customer_id NULLS FIRST",
    ),
    "order_items": (
        {"order_id": strip("order_id"), "order_item_id": "trim(order_item_id)", "product_id": strip("product_id"),
         "seller_id": strip("seller_id"), "shipping_limit_date": ts("shipping_limit_date"), "price": dec("price"),
         "freight_value": dec("freight_value")},
        {}, None, ["order_id", "order_item_id"], "product_id NULLS FIRST, seller_id NULLS FIRST",
    ),
    "order_payments": (
        {"order_id": strip("order_id"), "payment_sequential": num("payment_sequential"),
         "payment_type": strip("payment_type"), "payment_installments": num("payment_installments"),
         "payment_value": dec("payment_value")},
        {}, None, ["order_id", "payment_sequential"], "payment_type NULLS FIRST",
    ),
    "order_reviews": (
        {"review_id": strip("review_id"), "order_id": strip("order_id"),
         "review_score": f"CASE WHEN {num(strip('review_score'))} BETWEEN 0 AND 255 THEN {num(strip('review_score'))} END",
         "review_comment_title": strip("review_comment_title"),
         "review_comment_message": strip("review_comment_message"),
         "review_creation_date": any_ts(strip("review_creation_date")),
         "review_answer_timestamp": any_ts(strip("review_answer_timestamp"))},
        {}, ["review_id", "review_score", "review_comment_title", "review_comment_message", "review_creation_date",
             "review_answer_timestamp"],
        ["review_id"],
        "review_creation_date NULLS LAST, review_answer_timestamp NULLS LAST, order_id NULLS FIRST",
    ),
    "products": (
        {"product_id": strip("product_id"),
         "product_category_name": f"coalesce(CASE WHEN rtrim({strip('product_category_name')}) <> '' "
                                  f"THEN {strip('product_category_name')} END, '')",
         **{c: num(c) for c in ("product_name_lenght", "product_description_lenght", "product_photos_qty")},
         **{c: f"CASE WHEN {num(c)} > 0 THEN {num(c)} END" for c in (
             "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")}},
        {f"{c}_number": num(c) for c in (
            "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")},
        None, ["product_id"], "product_category_name NULLS FIRST",
    ),
    "sellers": (
        {"seller_id": strip("seller_id"), "seller_zip_code_prefix": strip("seller_zip_code_prefix"),
         "seller_city": norm("seller_city"), "seller_state": norm("seller_state")},
        {}, None, ["seller_id"], "seller_zip_code_prefix NULLS FIRST, seller_city NULLS FIRST",
    ),
    "geolocation": (
        {"geolocation_zip_code_prefix": strip("geolocation_zip_code_prefix"),
         "geolocation_lat": dec(strip("geolocation_lat"), 10, 7), "geolocation_lng": dec(strip("geolocation_lng"), 10, 7),
         "geolocation_city": norm("replace(geolocation_city, '\"', '')"),
         "geolocation_state": norm("replace(geolocation_state, '\"', '')")},
        {}, None, ["geolocation_zip_code_prefix"],
        "geolocation_lat NULLS LAST, geolocation_lng NULLS LAST, geolocation_city NULLS FIRST",
    ),
    "product_category_name_translation": (
        {"product_category_name": strip("product_category_name"),
         "product_category_name_english": strip("product_category_name_english")},
        {}, None, ["product_category_name"], "product_category_name_english NULLS FIRST",
    ),
}

for _name, (_columns, _marks, _hashed, _keys, _order) in _SPECS.items():
    _values = ", ".join(f"{e} AS {c}" for c, e in {**_columns, **_marks}.items())
    _given = ", ".join(f"{c} IS NOT NULL AS has_{c}" for c in _columns)
    _digest = ", '|', ".join(_hashed or list(_columns))
    CTES[f"clean_{_name}"] = (
        f"SELECT *, sha256(concat({_digest})) AS row_hash FROM (SELECT {_values}, {_given} FROM raw_{_name})"
    )
    _rest = ", ".join(f"{c} NULLS FIRST" for c in _columns if c not in _keys)
    CTES[f"ranked_{_name}"] = (
        f"SELECT *, row_number() OVER (PARTITION BY {', '.join(_keys)} ORDER BY {_order}, {_rest}) AS rn "
        f"FROM clean_{_name}"
    )


def is_hex(c: str) -> str:
    return f"regexp_full_match({c}, '[0-9a-f]{{32}}')"


def is_zip(c: str) -> str:
    return f"regexp_full_match({c}, '[0-9]{{5}}')"


def is_state(c: str) -> str:
    return f"regexp_full_match({c}, '[A-Z]{{2}}')"


def filled(c: str) -> str:
    return f"({c} IS NOT NULL AND rtrim({c}) <> '')"


_ADMIT = {
    "customers": [is_hex("customer_id"), is_hex("customer_unique_id"), is_zip("customer_zip_code_prefix"),
                  filled("customer_city"), is_state("customer_state")],
    "orders": [is_hex("order_id"), is_hex("customer_id"), filled("order_status"),
               "order_purchase_timestamp IS NOT NULL", "order_estimated_delivery_date IS NOT NULL"],
    "order_items": [is_hex("order_id"), is_hex("product_id"), is_hex("seller_id"),
                    "regexp_full_match(order_item_id, '[0-9]+')", "shipping_limit_date IS NOT NULL",
                    "price IS NOT NULL", "freight_value IS NOT NULL"],
    "order_payments": [is_hex("order_id"), "payment_sequential IS NOT NULL", filled("payment_type"),
                       "payment_installments IS NOT NULL", "payment_value IS NOT NULL"],
    "order_reviews": [is_hex("review_id"), is_hex("order_id"), "review_score IS NOT NULL",
                      "review_creation_date IS NOT NULL", "review_answer_timestamp IS NOT NULL"],
    "products": [is_hex("product_id")],
    "sellers": [is_hex("seller_id"), is_zip("seller_zip_code_prefix"), filled("seller_city"), is_state("seller_state")],
    "geolocation": [is_zip("geolocation_zip_code_prefix"), "geolocation_lat IS NOT NULL",
                    "geolocation_lng IS NOT NULL", filled("geolocation_city"), is_state("geolocation_state")],
    "product_category_name_translation": [filled("product_category_name"), filled("product_category_name_english")],
}
_STORED = {
    "products": {"product_category_name"}, "order_reviews": {"review_comment_title", "review_comment_message"},
}

for _name, _tests in _ADMIT.items():
    _out = ", ".join(
        f"CASE WHEN rtrim({c}) <> '' THEN {c} END AS {c}" if c in _STORED.get(_name, ()) else c for c in _SPECS[_name][0]
    )
    CTES[f"live_{_name}"] = f"SELECT {_out}, row_hash FROM ranked_{_name} WHERE rn = 1 AND {' AND '.join(_tests)}"


def _nulls(texts, parsed=()):
    return [(c, "NULL value", f"{c} IS NULL") for c in texts] + [(c, "NULL value", f"NOT has_{c}") for c in parsed]


def _empties(texts):
    return [(c, "Empty string after cleansing", f"rtrim({c}) = ''") for c in texts]


def _format(c, test, expected):
    return (c, f"Invalid length or format: expected {expected}", f"rtrim({c}) <> '' AND NOT {test(c)}")


def _unparsed(c, kind, value=None):
    return (c, f"Invalid {kind} format", f"has_{c} AND {value or c} IS NULL")


_HEX, _ZIP, _STATE = "32-char lowercase hex", "5 numeric digits", "2 uppercase letters"
_SIZES = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]

FINDINGS = {
    "customers": [
        *_nulls(list(_SPECS["customers"][0])), *_empties(list(_SPECS["customers"][0])),
        _format("customer_id", is_hex, _HEX), _format("customer_unique_id", is_hex, _HEX),
        _format("customer_zip_code_prefix", is_zip, _ZIP), _format("customer_state", is_state, _STATE),
    ],
    "orders": [
        *_nulls(["order_id", "customer_id", "order_status"],
                ["order_purchase_timestamp", "order_estimated_delivery_date"]),
        *_empties(["order_id", "customer_id", "order_status"]),
        _format("order_id", is_hex, _HEX), _format("customer_id", is_hex, _HEX),
        ("order_status", "Invalid value: not a recognized order status",
         f"rtrim(order_status) <> '' AND order_status NOT IN ({quoted(ORDER_STATUSES)})"),
        *[_unparsed(c, "datetime") for c in (
            "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date")],
        ("order_delivered_customer_date", "Delivered before purchase",
         "order_delivered_customer_date < order_purchase_timestamp"),
    ],
    "order_items": [
        *_nulls(["order_id", "order_item_id", "product_id", "seller_id"],
                ["shipping_limit_date", "price", "freight_value"]),
        *_empties(["order_id", "order_item_id", "product_id", "seller_id"]),
        *[_format(c, is_hex, _HEX) for c in ("order_id", "product_id", "seller_id")],
        ("order_item_id", "Invalid numeric format",
         "rtrim(order_item_id) <> '' AND regexp_matches(order_item_id, '[^0-9]')"),
        _unparsed("shipping_limit_date", "datetime"), _unparsed("price", "decimal"),
        _unparsed("freight_value", "decimal"),
        ("price", "Invalid range: must be > 0", "price <= 0"),
    ],
    "order_payments": [
        *_nulls(["order_id", "payment_type"], ["payment_sequential", "payment_installments", "payment_value"]),
        *_empties(["order_id", "payment_type"]),
        _format("order_id", is_hex, _HEX),
        _unparsed("payment_sequential", "numeric"), _unparsed("payment_installments", "numeric"),
        _unparsed("payment_value", "decimal"),
        ("payment_type", "Invalid value: not a recognized payment type",
         f"rtrim(payment_type) <> '' AND payment_type NOT IN ({quoted(PAYMENT_TYPES)})"),
        ("payment_sequential", "Invalid range: must be >= 1", "payment_sequential < 1"),
        ("payment_installments", "Invalid range: must be >= 1", "payment_installments < 1"),
        ("payment_value", "Invalid range: must be > 0", "payment_value <= 0 AND payment_type <> 'voucher'"),
    ],
    "order_reviews": [
        *_nulls(["review_id", "order_id"], ["review_score", "review_creation_date", "review_answer_timestamp"]),
        *_empties(["review_id", "order_id"]),
        _format("review_id", is_hex, _HEX), _format("order_id", is_hex, _HEX),
        _unparsed("review_score", "numeric"),
        ("review_score", "Invalid range: must be 1-5", "review_score < 1 OR review_score > 5"),
        _unparsed("review_creation_date", "datetime"), _unparsed("review_answer_timestamp", "datetime"),
    ],
    "products": [
        *_nulls(["product_id"]), *_empties(["product_id"]), _format("product_id", is_hex, _HEX),
        *[_unparsed(c, "numeric") for c in (
            "product_name_lenght", "product_description_lenght", "product_photos_qty")],
        *[_unparsed(c, "numeric", f"{c}_number") for c in _SIZES],
        *[(c, "Invalid range: must be > 0; stored as NULL", f"{c}_number <= 0") for c in _SIZES],
    ],
    "sellers": [
        *_nulls(list(_SPECS["sellers"][0])), *_empties(list(_SPECS["sellers"][0])),
        _format("seller_id", is_hex, _HEX), _format("seller_zip_code_prefix", is_zip, _ZIP),
        _format("seller_state", is_state, _STATE),
    ],
    "geolocation": [
        *_nulls(["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"],
                ["geolocation_lat", "geolocation_lng"]),
        *_empties(["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"]),
        _format("geolocation_zip_code_prefix", is_zip, _ZIP), _format("geolocation_state", is_state, _STATE),
        _unparsed("geolocation_lat", "decimal"), _unparsed("geolocation_lng", "decimal"),
    ],
    "product_category_name_translation": [
        *_nulls(list(_SPECS["product_category_name_translation"][0])),
        *_empties(list(_SPECS["product_category_name_translation"][0])),
    ],
}


def findings_sql(entity: str) -> str:
    """Union of one count per rule, plus the duplicate classes found by self semi and anti joins."""
    branches = [
        f"SELECT '{column}' AS column_name, '{issue}' AS issue, count(*) AS affected_row_count "
        f"FROM clean_{entity} WHERE {test} HAVING count(*) > 0"
        for column, issue, test in FINDINGS[entity]
    ]
    keys = _SPECS[entity][3]
    label = ", ".join(keys)
    if entity == "geolocation":
        branches.append(
            f"SELECT '{label}', 'Duplicate zip_code_prefix: kept smallest (lat, lng) occurrence', count(*) "
            f"FROM ranked_{entity} WHERE rn > 1 HAVING count(*) > 0"
        )
        return with_ctes(" UNION ALL ".join(branches))
    subject = label if len(keys) == 1 else f"({label})"
    counted = key_counts(f"ranked_{entity}", keys)
    for amount, ending in (
        ("n_kept - 1", "identical content, deduplicated silently"),
        ("n_rows - n_kept", "conflicting content — investigate before reload"),
    ):
        branches.append(
            f"SELECT '{label}', 'Duplicate {subject}: {ending}', CAST(sum({amount}) AS BIGINT) FROM {counted} HAVING sum({amount}) > 0"
        )
    return with_ctes(" UNION ALL ".join(branches))


def key_counts(ranked: str, keys: list[str]) -> str:
    """Keys that repeat: their rows, and how many have the content of the row of rank 1; a NULL key's rows match no other."""
    label, missing = ", ".join(keys), " OR ".join(f"{k} IS NULL" for k in keys)
    return (
        f"(SELECT {label}, sum(n) AS n_rows, CASE WHEN {missing} THEN 1 ELSE max(n) FILTER (WHERE first = 1) END AS n_kept "
        f"FROM (SELECT {label}, row_hash, count(*) AS n, min(rn) AS first FROM {ranked} GROUP BY ALL) GROUP BY {label} HAVING sum(n) > 1)"
    )


def _case(c: str, labels: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {quoted([v])}" for k, v in labels.items())
    return f"CASE {c} {arms} ELSE {c} END"


def _numbered(key: str, natural: str) -> str:
    return f"row_number() OVER (ORDER BY md5({natural}), {natural}) AS {key}"


def _place_dim(prefix: str, entity: str, natural: list[str]) -> tuple[str, str]:
    own = ", ".join(natural)
    hashed = [*natural[1:], *[f"{prefix}_{c}" for c in ("zip_code", "city", "state", "state_name", "lat", "lng")]]
    source = (
        f"SELECT *, sha256(concat({', chr(124), '.join(hashed)})) AS row_hash FROM (SELECT {own}, "
        f"{prefix}_zip_code_prefix AS {prefix}_zip_code, {prefix}_city, {prefix}_state, "
        f"{_case(f'{prefix}_state', STATE_NAMES)} AS {prefix}_state_name, "
        f"geolocation_lat AS {prefix}_lat, geolocation_lng AS {prefix}_lng FROM live_{entity} "
        f"LEFT JOIN live_geolocation ON geolocation_zip_code_prefix = {prefix}_zip_code_prefix)"
    )
    unknown = ", ".join("'UNKNOWN'" for _ in natural)
    dim = (
        f"SELECT {_numbered(f'{prefix}_key', natural[0])}, * FROM source_{prefix} UNION ALL "
        f"SELECT -1, {unknown}, '00000', 'UNKNOWN', 'XX', 'UNKNOWN', NULL, NULL, NULL"
    )
    return source, dim


CTES["source_customer"], CTES["dim_customer"] = _place_dim("customer", "customers", ["customer_id", "customer_unique_id"])
CTES["source_seller"], CTES["dim_seller"] = _place_dim("seller", "sellers", ["seller_id"])
_PRODUCT = [
    "product_category_name", "product_category_name_english", "product_name_length", "product_description_length",
    "product_photos_qty", *_SIZES,
]
_EN = "coalesce(product_category_name_english, p.product_category_name)"
CTES["source_product"] = (
    f"SELECT *, sha256(concat({', chr(124), '.join(_PRODUCT)})) AS row_hash FROM (SELECT product_id, "
    "coalesce(p.product_category_name, 'UNKNOWN') AS product_category_name, "
    f"coalesce({_case(_EN, CATEGORY_LABELS)}, 'UNKNOWN') AS product_category_name_english, "
    "product_name_lenght AS product_name_length, product_description_lenght AS product_description_length, "
    f"product_photos_qty, {', '.join(_SIZES)} FROM live_products p LEFT JOIN live_product_category_name_translation t "
    "ON t.product_category_name = p.product_category_name)"
)
CTES["dim_product"] = (
    f"SELECT {_numbered('product_key', 'product_id')}, * FROM source_product UNION ALL "
    "SELECT -1, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL"
)


def _values(rows) -> str:
    def lit(v):
        return "NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v))

    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


CTES["dim_order_status"] = (
    f"SELECT * FROM (VALUES {_values(ORDER_STATUS_ROWS)}) "
    "AS v(order_status_key, status_name, status_category, sort_order, source_value)"
)
CTES["dim_payment_type"] = (
    f"SELECT * FROM (VALUES {_values(PAYMENT_TYPE_ROWS)}) AS v(payment_type_key, payment_type_name, source_value)"
)
CTES["days"] = (
    "SELECT cast(unnest(generate_series(cast(min(o_orderdate) AS date), cast(max(o_orderdate) AS date), "
    "INTERVAL 1 DAY)) AS date) AS d FROM orders"
)
CTES["dim_date"] = """
SELECT year(d) * 10000 + month(d) * 100 + day(d) AS date_key, d AS full_date, year(d) AS year, isoyear(d) AS iso_year,
       quarter(d) AS quarter, month(d) AS month, strftime(d, '%b') AS month_name, year(d) * 100 + month(d) AS year_month_key,
       strftime(d, '%Y-%m') AS year_month, strftime(d, '%b %Y') AS month_year_short, weekofyear(d) AS week_of_year,
       day(d) AS day_of_month, dayofweek(d) + 1 AS day_of_week, strftime(d, '%A') AS day_name,
       dayofweek(d) IN (0, 6) AS is_weekend
FROM days
UNION ALL SELECT 0, DATE '1900-01-01', 1900, 1900, 1, 1, 'UNKNOWN', 0, 'UNKNOWN', 'UNKNOWN', 1, 1, 0, 'UNKNOWN', false
"""
CTES["latest_review"] = """
SELECT order_id, review_score FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY review_creation_date DESC, review_answer_timestamp DESC,
                                 review_id DESC) AS place FROM live_order_reviews) WHERE place = 1
"""


def day_key(c: str) -> str:
    return f"year({c}) * 10000 + month({c}) * 100 + day({c})"


CTES["order_days"] = f"""
SELECT order_id, role, day FROM (
    SELECT order_id, role, day FROM (
        SELECT order_id, {day_key('order_purchase_timestamp')} AS purchase, {day_key('order_estimated_delivery_date')} AS estimate,
               {day_key('order_delivered_carrier_date')} AS handoff, {day_key('order_delivered_customer_date')} AS arrival
        FROM live_orders) UNPIVOT (day FOR role IN (purchase, estimate, handoff, arrival)))
WHERE day IN (SELECT date_key FROM dim_date)
"""
CTES["order_keys"] = """
SELECT order_id, max(day) FILTER (WHERE role = 'purchase') AS purchase, max(day) FILTER (WHERE role = 'estimate') AS estimate,
       max(day) FILTER (WHERE role = 'handoff') AS handoff, max(day) FILTER (WHERE role = 'arrival') AS arrival
FROM order_days GROUP BY order_id
"""
CTES["order_grain"] = """
SELECT order_id, ifnull(purchase, 0) AS purchase_date_key, ifnull(estimate, 0) AS estimated_delivery_date_key,
       handoff AS carrier_handoff_date_key, arrival AS actual_delivery_date_key,
       ifnull((SELECT max(customer_key) FROM dim_customer WHERE dim_customer.customer_id = live_orders.customer_id), -1) AS customer_key,
       ifnull((SELECT max(order_status_key) FROM dim_order_status WHERE source_value = order_status), -1) AS order_status_key,
       datediff('day', order_purchase_timestamp, order_delivered_customer_date) AS purchase_to_delivery_days,
       datediff('day', order_estimated_delivery_date, order_delivered_customer_date) AS delivery_vs_estimate_days,
       datediff('hour', order_purchase_timestamp, order_approved_at) AS purchase_to_approval_hours,
       datediff('day', order_delivered_carrier_date, order_delivered_customer_date) AS carrier_to_delivery_days, review_score
FROM live_orders LEFT JOIN order_keys USING (order_id) LEFT JOIN latest_review USING (order_id)
"""
CTES["fact_sales"] = """
SELECT order_grain.* EXCLUDE (order_id), order_id, CAST(order_item_id AS INTEGER) AS order_item_id, price, freight_value,
       CAST(price + freight_value AS DECIMAL(10,2)) AS total_value,
       ifnull((SELECT max(seller_key) FROM dim_seller WHERE dim_seller.seller_id = live_order_items.seller_id), -1) AS seller_key,
       ifnull((SELECT max(product_key) FROM dim_product WHERE dim_product.product_id = live_order_items.product_id), -1) AS product_key
FROM order_grain JOIN live_order_items USING (order_id)
"""
CTES["fact_payments"] = """
SELECT purchase_date_key, customer_key, order_id, payment_sequential, payment_installments, payment_value,
       ifnull((SELECT max(payment_type_key) FROM dim_payment_type WHERE source_value = payment_type), -1) AS payment_type_key
FROM order_grain JOIN live_order_payments USING (order_id)
"""


def _mentions(text: str) -> list[str]:
    import re

    words = set(re.findall(r"[a-z_]+", text))
    return [n for n in CTES if n in words]


def with_ctes(body: str) -> str:
    """Put the common table expressions a query mentions, and theirs, in front of it."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for needed in _mentions(CTES[name]):
            if needed != name:
                visit(needed)
        order.append(name)

    for name in _mentions(body):
        visit(name)
    if not order:
        return body
    # materialised: each is computed once although several others read it
    parts = ", ".join(f"{n} AS MATERIALIZED ({CTES[n].strip()})" for n in order)
    return f"WITH {parts} {body.strip()}"
