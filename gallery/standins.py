"""The nine raw entities, derived from the test tables.

One SQL text per entity that both engines understand. It reads every row of its table and spoils
some values (quotes, blanks, upper-case ids, bad dates and numbers) so that each rule has work.
"""

from __future__ import annotations

from sparkmart.plans.lookups import STATE_NAMES

#: State codes by nation key, each two letters.
_STATES = "".join(sorted(STATE_NAMES)[:25])


def _id(column: str) -> str:
    return f"md5(cast({column} AS string))"


def _place(prefix: str, key: str, group: str) -> str:
    """Zip, city and state columns for customers, sellers and geolocation."""
    return f"""
        lpad(cast({key} * 1000 + length({group}) * 10 AS string), 5, '0') AS {prefix}_zip,
        CASE WHEN length({group}) = 8 THEN 'São ' || replace(n_name, '_', ' ')
             WHEN length({group}) = 10 THEN '  sao ' || lower(replace(n_name, '_', ' '))
             ELSE lower(r_name) END AS {prefix}_city_text,
        substr('{_STATES}', 1 + 2 * {key}, 2) AS {prefix}_state_code"""


RAW: dict[str, str] = {}

RAW["customers"] = f"""
SELECT
    CASE WHEN c_acctbal < -950 THEN NULL
         WHEN c_acctbal < -930 THEN '   '
         WHEN c_acctbal > 9900 THEN upper({_id('c_custkey')})
         WHEN c_mktsegment = 'MACHINERY' THEN ' "' || {_id('c_custkey')} || '" '
         ELSE {_id('c_custkey')} END AS customer_id,
    md5(cast(cast(floor(c_acctbal / 10) AS bigint) AS string) || '-' || cast(c_nationkey AS string)) AS customer_unique_id,
    CASE WHEN c_acctbal BETWEEN 9800 AND 9850 THEN substr(c_zip, 2, 4)
         WHEN c_acctbal BETWEEN 9850 AND 9900 THEN 'A' || substr(c_zip, 2, 4)
         ELSE c_zip END AS customer_zip_code_prefix,
    c_city_text AS customer_city,
    CASE WHEN c_acctbal BETWEEN 9700 AND 9750 THEN 'S1' ELSE lower(c_state_code) END AS customer_state
FROM (SELECT *, {_place('c', 'c_nationkey', 'c_mktsegment')}
      FROM {{customer}} JOIN {{nation}} ON n_nationkey = c_nationkey JOIN {{region}} ON r_regionkey = n_regionkey) AS c
"""

RAW["geolocation"] = f"""
SELECT
    CASE WHEN c_acctbal < -990 THEN NULL ELSE '"' || c_zip || '"' END AS geolocation_zip_code_prefix,
    CASE WHEN c_acctbal > 9950 THEN 'n/a'
         ELSE cast(cast(c_acctbal / 1000 AS decimal(10,7)) AS string) END AS geolocation_lat,
    CASE WHEN c_acctbal BETWEEN 9900 AND 9950 THEN NULL
         ELSE '"' || cast(cast(c_acctbal / 2000 AS decimal(10,7)) AS string) || '"' END AS geolocation_lng,
    c_city_text AS geolocation_city,
    c_state_code AS geolocation_state
FROM (SELECT *, {_place('c', 'c_nationkey', 'c_mktsegment')}
      FROM {{customer}} JOIN {{nation}} ON n_nationkey = c_nationkey JOIN {{region}} ON r_regionkey = n_regionkey) AS c
"""

RAW["sellers"] = f"""
SELECT
    CASE WHEN s_acctbal < -900 THEN '' ELSE {_id('s_suppkey')} END AS seller_id,
    CASE WHEN s_acctbal > 9500 THEN '12 45' ELSE s_zip END AS seller_zip_code_prefix,
    s_city_text AS seller_city,
    CASE WHEN s_acctbal BETWEEN 9000 AND 9100 THEN NULL ELSE s_state_code END AS seller_state
FROM (SELECT *, {_place('s', 's_nationkey', "CASE WHEN s_nationkey > 11 THEN 'BUILDING' ELSE 'FURNITURE' END")}
      FROM {{supplier}} JOIN {{nation}} ON n_nationkey = s_nationkey JOIN {{region}} ON r_regionkey = n_regionkey) AS s
"""

RAW["products"] = f"""
SELECT
    CASE WHEN p_retailprice > 999 AND p_size = 50 THEN substr({_id('p_partkey')}, 1, 31)
         ELSE '"' || {_id('p_partkey')} || '"' END AS product_id,
    CASE p_type WHEN 'ECONOMY' THEN 'cama_mesa_banho' WHEN 'STANDARD' THEN 'beleza_saude' WHEN 'PROMO' THEN 'pc_gamer'
                WHEN 'MEDIUM' THEN 'brinquedos' WHEN 'LARGE' THEN 'categoria_nova'
                ELSE CASE WHEN p_size > 25 THEN NULL ELSE '  ' END END AS product_category_name,
    cast(length(p_name) AS string) AS product_name_lenght,
    CASE WHEN p_brand = 'Brand#3' THEN 'abc' ELSE cast(p_size * 13 AS string) END AS product_description_lenght,
    CASE WHEN p_size = 7 THEN NULL ELSE ' ' || cast(p_size - 5 AS string) END AS product_photos_qty,
    cast((p_size - 2) * 50 AS string) AS product_weight_g,
    CASE WHEN p_size = 9 THEN '1O' ELSE cast(p_size * 2 AS string) END AS product_length_cm,
    CASE WHEN p_size > 45 THEN '0' ELSE cast(p_size + 1 AS string) END AS product_height_cm,
    CASE WHEN p_size = 11 THEN '12x' ELSE cast(p_size AS string) END AS product_width_cm
FROM {{part}}
"""

RAW["product_category_name_translation"] = """
SELECT DISTINCT
    CASE p_type WHEN 'ECONOMY' THEN 'cama_mesa_banho' WHEN 'STANDARD' THEN ' "beleza_saude"'
                WHEN 'MEDIUM' THEN 'brinquedos' WHEN 'SMALL' THEN NULL ELSE 'moveis' END AS product_category_name,
    CASE p_type WHEN 'ECONOMY' THEN 'bed_bath_table' WHEN 'STANDARD' THEN 'health_beauty'
                WHEN 'MEDIUM' THEN 'toys' WHEN 'SMALL' THEN 'small' ELSE '' END AS product_category_name_english
FROM {part}
"""

_BOUGHT = "(o_orderdate + (cast(floor(o_totalprice) AS bigint) % 1440) * INTERVAL '1' MINUTE)"

RAW["orders"] = f"""
SELECT
    CASE WHEN o_totalprice < 1200 THEN NULL
         WHEN o_totalprice < 1500 THEN ' '
         WHEN o_totalprice > 499000 THEN upper({_id('o_orderkey')})
         WHEN o_orderpriority = '1-URGENT' THEN ' "' || {_id('o_orderkey')} || '"'
         ELSE {_id('o_orderkey')} END AS order_id,
    CASE WHEN o_totalprice BETWEEN 498000 AND 499000 THEN substr({_id('o_custkey')}, 1, 30)
         ELSE {_id('o_custkey')} END AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
         ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'processing' WHEN '2-HIGH' THEN 'canceled'
                                   WHEN '3-MEDIUM' THEN 'invoiced' WHEN '4-NOT SPECIFIED' THEN 'unavailable'
                                   ELSE 'on_hold' END END AS order_status,
    CASE WHEN day(o_orderdate) = 31 THEN replace(cast({_BOUGHT} AS string), '-', '/')
         ELSE cast({_BOUGHT} AS string) END AS order_purchase_timestamp,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus <> 'F' THEN NULL
         WHEN o_totalprice > 495000 THEN 'soon'
         ELSE cast({_BOUGHT} + (cast(floor(o_totalprice / 3) AS bigint) % 5000) * INTERVAL '1' MINUTE AS string)
         END AS order_approved_at,
    CASE WHEN o_orderstatus = 'P' THEN NULL
         ELSE cast({_BOUGHT} + (cast(floor(o_totalprice / 7) AS bigint) % 9 - 1) * INTERVAL '1' DAY AS string)
         END AS order_delivered_carrier_date,
    CASE WHEN o_orderstatus = 'F' AND o_totalprice < 6000 THEN NULL
         WHEN o_orderstatus = 'F' THEN cast({_BOUGHT} + (cast(floor(o_totalprice / 10) AS bigint) % 75 - 1) * INTERVAL '1' DAY
                                            + (cast(floor(o_totalprice) AS bigint) % 700) * INTERVAL '1' MINUTE AS string)
         WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN cast({_BOUGHT} + INTERVAL '4' DAY AS string)
         END AS order_delivered_customer_date,
    CASE WHEN o_totalprice BETWEEN 480000 AND 481000 THEN 'unknown'
         ELSE cast(o_orderdate + (10 + cast(floor(o_totalprice / 100) AS bigint) % 30) * INTERVAL '1' DAY AS string)
         END AS order_estimated_delivery_date
FROM {{orders}}
"""

RAW["order_items"] = f"""
SELECT
    CASE WHEN l_extendedprice < 920 THEN NULL
         WHEN l_returnflag = 'R' THEN '"' || {_id('l_orderkey')} || '"'
         ELSE {_id('l_orderkey')} END AS order_id,
    CASE WHEN l_extendedprice > 104000 THEN '#' || cast(l_linenumber AS string)
         WHEN l_linestatus = 'O' THEN ' ' || cast(l_linenumber AS string)
         ELSE cast(l_linenumber AS string) END AS order_item_id,
    CASE WHEN l_tax = 0.08 AND l_quantity = 50 THEN md5('gone' || cast(l_partkey AS string))
         ELSE {_id('l_partkey')} END AS product_id,
    CASE WHEN l_tax = 0.01 AND l_quantity = 50 THEN upper({_id('l_suppkey')})
         ELSE {_id('l_suppkey')} END AS seller_id,
    CASE WHEN l_quantity = 49 AND l_discount = 0.1 THEN '' ELSE cast(l_shipdate AS string) END AS shipping_limit_date,
    CASE WHEN l_quantity = 2 AND l_discount = 0.05 THEN 'free'
         WHEN l_quantity = 1 AND l_tax = 0.0 THEN '0.00'
         WHEN l_quantity = 1 AND l_tax = 0.02 THEN '-1.5'
         ELSE cast(cast(l_extendedprice AS decimal(10,2)) AS string) END AS price,
    CASE WHEN l_quantity = 3 AND l_discount = 0.05 THEN NULL
         ELSE cast(cast(l_quantity + l_tax AS decimal(10,2)) AS string) END AS freight_value
FROM {{lineitem}}
"""

RAW["order_payments"] = f"""
SELECT
    {_id('o_orderkey')} AS order_id,
    '1' AS payment_sequential,
    CASE o_orderpriority WHEN '1-URGENT' THEN '"credit_card"' WHEN '2-HIGH' THEN 'credit_card' WHEN '3-MEDIUM' THEN 'boleto'
                         WHEN '4-NOT SPECIFIED' THEN 'debit_card' ELSE 'pix' END AS payment_type,
    CASE WHEN o_totalprice > 499000 THEN 'many' ELSE cast(cast(floor(o_totalprice) AS bigint) % 13 AS string) END
        AS payment_installments,
    CASE WHEN o_totalprice < 1500 THEN '0.00' WHEN o_totalprice < 2000 THEN ''
         ELSE cast(cast(o_totalprice AS decimal(10,2)) AS string) END AS payment_value
FROM {{orders}}
UNION ALL
SELECT
    {_id('o_orderkey')} AS order_id,
    CASE WHEN o_totalprice > 490000 THEN '0' ELSE ' 2' END AS payment_sequential,
    CASE WHEN o_orderpriority = '2-HIGH' THEN 'voucher' ELSE 'credit_card' END AS payment_type,
    '1' AS payment_installments,
    CASE WHEN o_totalprice < 5000 THEN '0' ELSE cast(cast(floor(o_totalprice / 50) AS bigint) AS string) || '.5' END
        AS payment_value
FROM {{orders}}
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
"""

_ASKED = "(o_orderdate + (12 + cast(floor(o_totalprice / 9) AS bigint) % 20) * INTERVAL '1' DAY)"

RAW["order_reviews"] = f"""
SELECT
    CASE WHEN o_totalprice < 1200 THEN 'none' ELSE '"' || md5('a' || cast(o_orderkey AS string)) || '"' END AS review_id,
    {_id('o_orderkey')} AS order_id,
    CASE WHEN o_totalprice > 499000 THEN '9' WHEN o_totalprice < 2000 THEN 'bad'
         ELSE '"' || cast(1 + cast(floor(o_totalprice) AS bigint) % 5 AS string) || '"' END AS review_score,
    CASE WHEN o_orderpriority = '5-LOW' THEN '""' ELSE o_orderpriority END AS review_comment_title,
    CASE WHEN o_orderstatus = 'O' THEN NULL ELSE 'paid ' || cast(cast(o_totalprice AS decimal(10,2)) AS string) END
        AS review_comment_message,
    substr(cast({_ASKED} AS string), 1, 10) AS review_creation_date,
    CASE WHEN o_totalprice BETWEEN 480000 AND 482000 THEN 'later'
         ELSE cast({_ASKED} + (cast(floor(o_totalprice) AS bigint) % 9000) * INTERVAL '1' MINUTE AS string)
         END AS review_answer_timestamp
FROM {{orders}}
UNION ALL
SELECT
    md5('b' || cast(o_orderkey AS string)) AS review_id,
    {_id('o_orderkey')} AS order_id,
    '1' AS review_score,
    'second' AS review_comment_title,
    'again' AS review_comment_message,
    substr(cast({_ASKED} + INTERVAL '2' DAY AS string), 1, 10) AS review_creation_date,
    cast({_ASKED} + INTERVAL '3' DAY AS string) AS review_answer_timestamp
FROM {{orders}}
WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'
"""

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")
