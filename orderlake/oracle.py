"""Independent SQL (DuckDB dialect) for every registered query.

The SQL re-derives each adapter value and each rule from the driver tables on its
own: plain joins, CASE expressions, window functions and VALUES lists. It shares only
the fixed-value tables with the Spark side (symbol maps, seed rows, patterns).
Measures are exact decimals cast to DOUBLE at the edge; dates are cast to text;
integers to BIGINT - the same edge casts the Spark queries apply.
"""

from __future__ import annotations

from orderlake.functions.currency import (
    CART_SYMBOL_TO_CODE, PRODUCT_FORMAT_STRIP, PRODUCT_SYMBOL_FALLBACK, PRODUCT_SYMBOL_TO_CODE, PRODUCT_UNKNOWN,
)
from orderlake.functions.text import URL_DOMAIN_PATTERN, WHITESPACE_CLASS
from orderlake.plans.extract import PRODUCT_EVENTS, SPECIAL_EVENT, fallback_url_template
from orderlake.schemas import PRODUCT_FIELDS
from orderlake.sources.adapters import (
    CART_SYMBOLS, CITIES_PER_NATION, CITY_BLOCK, EVENT_TYPE_TO_COLLECTION, FAIL_EVERY, GONE_AT, GONE_EVERY,
    GONE_SUFFIX, HUGE_QUANTITY, NATION_BLOCK, OBJECT_EVERY, OBJECT_PAYLOAD, PAYLOAD_PATTERN, PRICE_FORMATS, TRACK_PATTERN,
    WIDE_CODES, ZERO_PRICE_SPELLINGS, shop_urls,
)
from orderlake.sources.seed import DEFAULT_SHOP_HOST, seed_values_sql

HOST = DEFAULT_SHOP_HOST


def q(s) -> str:
    if s is None:
        return "NULL"
    return "'" + str(s).replace("'", "''") + "'"


def utrim(x: str) -> str:
    return f"regexp_replace({x}, '^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$', '', 'g')"


def nullif_blank(x: str) -> str:
    return f"NULLIF({utrim(x)}, '')"


def pick(key: str, values: list) -> str:
    arms = " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(values) if v is not None)
    return f"(CASE {key} {arms} ELSE NULL END)"


def skey(*parts: str) -> str:
    """Surrogate key: first 16 hex digits of md5, signed, of the parts joined by U+001F."""
    s = " || chr(31) || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return (f"(CASE WHEN ({s}) IS NOT NULL THEN "
            f"(('0x' || substr(md5({s}), 1, 16))::UBIGINT::HUGEINT + 9223372036854775808) % 18446744073709551616 "
            f"- 9223372036854775808 END)::BIGINT")


def safe_int(x: str) -> str:
    t = utrim(f"CAST({x} AS VARCHAR)")
    return f"(CASE WHEN regexp_matches({t}, '^[-+]?[0-9]+$') THEN TRY_CAST({t} AS BIGINT) END)"


def safe_decimal(x: str, width: int = 25) -> str:
    t = utrim(x)
    return (f"(CASE WHEN regexp_matches({t}, '^[-+]?[0-9.]+([eE][-+]?[0-9]+)?$') "
            f"THEN TRY_CAST({t} AS DECIMAL({width},9)) END)")


def parse_price(raw: str, width: int = 25) -> str:
    t = utrim(raw)
    norm = (f"(CASE WHEN strpos({t}, '٫') > 0 THEN replace({t}, '٫', '.') "
            f"WHEN regexp_matches({t}, '\\d''\\d') THEN replace({t}, '''', '') "
            f"WHEN regexp_matches({t}, '\\d,\\d{{2}}$') THEN replace(replace({t}, '.', ''), ',', '.') "
            f"ELSE replace({t}, ',', '') END)")
    return f"NULLIF({safe_decimal(norm, width)}, 0)"


def price_status(raw: str) -> str:
    t = utrim(raw)
    return f"(CASE WHEN {t} IN ('0,00', '0.00', '') THEN 'zero_price' ELSE 'valid' END)"


def price_priority(raw: str) -> str:
    t = utrim(raw)
    return f"(CASE WHEN {t} NOT IN ('0,00', '0.00') AND {t} != '' THEN 0 ELSE 1 END)"


def cart_currency(sym: str) -> str:
    t = utrim(sym)
    arms = " ".join(f"WHEN {t} = {q(s)} THEN {q(c)}" for s, c in CART_SYMBOL_TO_CODE)
    return f"(CASE {arms} ELSE NULL END)"


def product_symbol(fmt: str) -> str:
    return utrim(f"upper(regexp_replace({fmt}, {q(PRODUCT_FORMAT_STRIP)}, '', 'g'))")


def product_currency(fmt: str) -> str:
    s = product_symbol(fmt)
    arms = " ".join(f"WHEN {s} = {q(k)} THEN {q(v)}" for k, v in PRODUCT_SYMBOL_TO_CODE)
    mapped = f"(CASE {arms} ELSE {q(PRODUCT_UNKNOWN)} END)"
    fb = " ".join(f"WHEN {mapped} IS NULL AND {s} = {q(k)} THEN {q(v)}" for k, v in PRODUCT_SYMBOL_FALLBACK)
    return f"(CASE {fb} ELSE {mapped} END)"


def url_domain(x: str) -> str:
    return f"NULLIF(regexp_extract({x}, '{URL_DOMAIN_PATTERN}', 1), '')"


def clean_string(x: str) -> str:
    s = f"regexp_replace(regexp_replace({x}, '[\\r\\n]', ' ', 'g'), '[\\x00-\\x1f]', '', 'g')"
    return utrim(s)


def money(cents: str) -> dict:
    whole = f"({cents} // 100)"
    frac = f"lpad(CAST({cents} % 100 AS VARCHAR), 2, '0')"
    grp = f"format('{{:,}}', {whole})"
    return {
        "whole": f"CAST({whole} AS VARCHAR)", "frac": frac, "grouped": grp,
        "eu_grouped": f"replace({grp}, ',', '.')",
        "plain": f"(CAST({whole} AS VARCHAR) || '.' || {frac})",
        "eu": f"(replace({grp}, ',', '.') || ',' || {frac})",
        "swiss": f"(replace({grp}, ',', '''') || '.' || {frac})",
        "us": f"({grp} || '.' || {frac})",
        "arabic_sep": f"(CAST({whole} AS VARCHAR) || '٫' || {frac})",
    }


SEED = seed_values_sql(HOST)

# --- adapters --------------------------------------------------------------------

CHECKOUT_BASE = f"""
_j AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_linenumber AS ln, l.l_quantity, l.l_extendedprice, l.l_returnflag,
         o.o_custkey AS ck, o.o_orderstatus, o.o_orderdate,
         CAST(ROUND(l.l_extendedprice * 100) AS BIGINT) AS cents,
         ((o.o_custkey % 1000003) * 2654435761) & 4294967295 AS ipl
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
_ev AS (
  SELECT
    CASE WHEN o_orderstatus = 'P' THEN 'add_to_cart_action' ELSE 'checkout_success' END AS collection,
    CASE WHEN ck % 50 = 49 THEN 'not-an-ip'
         ELSE concat_ws('.', ipl >> 24, (ipl >> 16) & 255, (ipl >> 8) & 255, ipl & 255) END AS ip,
    'agent-' || CAST(ck % 3 AS VARCHAR) AS user_agent,
    {pick('ck % 3', ['1920x1080', '1366x768', '390x844'])} AS resolution,
    CASE WHEN ck % 7 = 0 THEN NULL WHEN ck % 7 = 1 THEN '  ' ELSE 'u' || CAST(ck AS VARCHAR) END AS user_id_db,
    CASE WHEN ck % 11 = 0 THEN NULL ELSE 'dev_' || CAST(ck AS VARCHAR) END AS device_id,
    CASE WHEN ck % 5 = 0 THEN NULL WHEN ck % 5 = 1 THEN ' '
         ELSE 'user' || CAST(ck AS VARCHAR) || '@mail.test' END AS email_address,
    CAST(ck % 10 AS VARCHAR) AS store_id,
    CAST(l_orderkey AS VARCHAR) AS order_id,
    {pick('ck % 5', shop_urls(HOST))} AS current_url,
    strftime(o_orderdate + to_seconds(l_orderkey % 86400), '%Y-%m-%d %H:%M:%S') AS local_time,
    CAST(epoch(o_orderdate) AS BIGINT) + l_orderkey % 86400 AS time_stamp,
    ln,
    CASE WHEN l_partkey % 97 = 0 THEN 'P-' || CAST(l_partkey AS VARCHAR) ELSE CAST(l_partkey AS VARCHAR) END AS item_product_id,
    CAST(trunc(l_quantity) AS INTEGER) AS item_amount,
    CASE ln % 5 WHEN 0 THEN {money('cents')['plain']} WHEN 1 THEN {money('cents')['eu']}
                WHEN 2 THEN {money('cents')['swiss']} WHEN 3 THEN {money('cents')['us']}
                ELSE {money('cents')['arabic_sep']} END AS item_price,
    {pick('ck % 8', CART_SYMBOLS)} AS item_currency,
    {pick('l_orderkey % 3', ZERO_PRICE_SPELLINGS)} AS zero_price
  FROM _j
),
_items AS (
  SELECT *, item_price AS price FROM _ev WHERE ln <> 7
  UNION ALL
  SELECT *, zero_price AS price FROM _ev WHERE ln % 4 = 0 AND ln <> 7
),
cart_lines AS (
  SELECT
    ip AS ip_address, user_agent, resolution,
    COALESCE({nullif_blank('user_id_db')}, 'guest_' || device_id) AS user_id,
    device_id, store_id, order_id,
    COALESCE({nullif_blank('email_address')}, 'Unknown') AS email_address,
    {safe_int('item_product_id')} AS product_id,
    item_amount AS order_qty,
    price AS item_price_raw,
    item_currency AS currency_code_raw,
    {url_domain('current_url')} AS domain,
    CAST(strptime(local_time, '%Y-%m-%d %H:%M:%S') AS DATE) AS order_local_time,
    time_stamp AS order_timestamp
  FROM _items WHERE collection = 'checkout_success'
)"""

W3_TIEBREAK = ["ip_address", "user_agent", "resolution", "user_id", "device_id", "store_id", "email_address",
               "order_qty", "item_price_raw", "currency_code_raw", "domain", "order_local_time", "order_timestamp"]

STG_FACT = CHECKOUT_BASE + f""",
_dedup AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, product_id ORDER BY {price_priority('item_price_raw')} ASC,
      {', '.join(c + ' ASC NULLS FIRST' for c in W3_TIEBREAK)}) AS rn
    FROM cart_lines) WHERE rn = 1
),
_priced AS (
  SELECT * EXCLUDE (rn), {parse_price('item_price_raw')} AS item_price, {price_status('item_price_raw')} AS item_price_status,
         {cart_currency('currency_code_raw')} AS currency_code_from_symbol
  FROM _dedup
),
_resolved AS (
  SELECT f.* EXCLUDE (currency_code_from_symbol),
         COALESCE(f.currency_code_from_symbol, er.currency_code, 'USD') AS currency_code,
         CASE WHEN f.currency_code_from_symbol IS NOT NULL THEN 'from_symbol'
              WHEN er.currency_code IS NOT NULL THEN 'from_domain' ELSE 'default_usd' END AS currency_source
  FROM _priced f LEFT JOIN {SEED} er ON f.domain = er.domain
),
stg_fact AS (
  SELECT f.*, CAST(ROUND(f.item_price * e.rate_to_usd, 2) AS DECIMAL(33,9)) AS item_price_usd
  FROM _resolved f LEFT JOIN {SEED} e ON f.currency_code = e.currency_code
),
int_fact AS (
  SELECT {skey('order_id', 'product_id')} AS fact_sales_order_key, * FROM stg_fact
)"""

PRODUCT_BASE = f"""
_parts AS (
  SELECT p_partkey, p_name, p_type, p_size, p_retailprice, 0 AS version FROM part
  UNION ALL
  SELECT p_partkey, p_name, p_type, p_size, p_retailprice, 1 AS version FROM part WHERE p_partkey % 10 = 0
),
_pc AS (
  SELECT *, CAST(ROUND(p_retailprice * 100) AS BIGINT) AS cents FROM _parts
),
_pc2 AS (
  SELECT *, (cents * 9) // 10 AS min_cents, (cents * (11 + version)) // 10 AS max_cents FROM _pc
),
product_info AS (
  SELECT
    CAST(p_partkey AS VARCHAR) AS product_id,
    CASE WHEN version = 1 THEN p_name || ' (v2)' ELSE p_name END AS name,
    'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
    'simple' AS type_id,
    {money('cents')['plain']} AS price,
    {money('min_cents')['plain']} AS min_price,
    {money('max_cents')['plain']} AS max_price,
    CASE p_partkey % {len(PRICE_FORMATS)} {' '.join(f"WHEN {i} THEN {{FMT{i}}}" for i in range(len(PRICE_FORMATS)))} END AS min_price_format,
    CAST(p_size AS VARCHAR) AS qty,
    CASE WHEN p_partkey % 13 = 0 THEN 'cat-' || CAST(p_size AS VARCHAR) ELSE CAST(p_size AS VARCHAR) END AS category,
    CASE WHEN p_partkey % 9 = 0 THEN ' ' ELSE p_type END AS category_name
  FROM _pc2
)"""


def _fmt_sql(template, m: dict) -> str:
    if template is None:
        return "NULL"
    out, buf, i = [], "", 0
    while i < len(template):
        if template[i] == "{":
            j = template.index("}", i)
            if buf:
                out.append(q(buf))
                buf = ""
            out.append({"m": m["whole"], "g": m["grouped"], "e": m["eu_grouped"], "f": m["frac"]}[template[i + 1:j]])
            i = j + 1
        else:
            buf += template[i]
            i += 1
    if buf:
        out.append(q(buf))
    return "(" + " || ".join(out) + ")"


_m = money("min_cents")
PRODUCT_BASE = PRODUCT_BASE.format(**{f"FMT{i}": _fmt_sql(t, _m) for i, t in enumerate(PRICE_FORMATS)})

STG_PRODUCT = PRODUCT_BASE + f""",
_prod_renamed AS (
  SELECT {safe_int('product_id')} AS product_id, name AS product_name, {safe_int('category')} AS category_id,
         COALESCE({nullif_blank('category_name')}, 'Unknown') AS category_name,
         {safe_decimal('price')} AS unit_price, {safe_decimal('min_price')} AS min_price,
         {safe_decimal('max_price')} AS max_price, qty AS product_qty, min_price_format
  FROM product_info
),
_prod_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY product_name ASC NULLS FIRST,
      category_id ASC NULLS FIRST, category_name ASC NULLS FIRST, unit_price ASC NULLS FIRST,
      min_price ASC NULLS FIRST, max_price ASC NULLS FIRST, product_qty ASC NULLS FIRST,
      min_price_format ASC NULLS FIRST) AS rn
    FROM _prod_renamed) WHERE rn = 1
),
stg_product AS (
  SELECT *, {product_symbol('min_price_format')} AS raw_symbol, {product_currency('min_price_format')} AS currency_code
  FROM _prod_dedup
),
int_product AS (
  SELECT {skey('product_id')} AS product_key, p.product_id, p.product_name, p.category_id, p.category_name,
         p.unit_price, p.min_price, p.max_price, p.currency_code,
         CAST(ROUND(p.unit_price * e.rate_to_usd, 2) AS DECIMAL(33,9)) AS unit_price_usd,
         CAST(ROUND(p.min_price * e.rate_to_usd, 2) AS DECIMAL(33,9)) AS min_price_usd,
         CAST(ROUND(p.max_price * e.rate_to_usd, 2) AS DECIMAL(33,9)) AS max_price_usd
  FROM stg_product p LEFT JOIN {SEED} e ON p.currency_code = e.currency_code
  UNION ALL
  SELECT -1, -1, 'Unknown', -1, 'Unknown', 0.00, 0.00, 0.00, 'Unknown', 0.00, 0.00, 0.00
),
dim_product AS (
  SELECT product_key, product_id, product_name, category_id, category_name, unit_price_usd, min_price_usd, max_price_usd
  FROM int_product
)"""

IP_RANGES = f"""
_nr AS (
  SELECT n.n_nationkey, n.n_name, r.r_name, UNNEST(range({CITIES_PER_NATION})) AS city_no
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
ip_ranges AS (
  SELECT CAST(n_nationkey AS BIGINT) * {NATION_BLOCK} + city_no * {CITY_BLOCK} AS ip_from,
         CAST(n_nationkey AS BIGINT) * {NATION_BLOCK} + city_no * {CITY_BLOCK} + {CITY_BLOCK - 1} AS ip_to,
         n_name AS country, r_name AS region, n_name || '-city-' || CAST(city_no AS VARCHAR) AS city
  FROM _nr
)"""

_IPV4 = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$"

IP_LOCATIONS = f""",
{IP_RANGES},
_ips AS (SELECT DISTINCT ip FROM _ev),
_ipn AS (
  SELECT ip, CAST(regexp_extract(ip, '{_IPV4}', 1) AS BIGINT) AS a, CAST(regexp_extract(ip, '{_IPV4}', 2) AS BIGINT) AS b,
         CAST(regexp_extract(ip, '{_IPV4}', 3) AS BIGINT) AS c, CAST(regexp_extract(ip, '{_IPV4}', 4) AS BIGINT) AS d
  FROM _ips WHERE regexp_matches(ip, '{_IPV4}')
),
_ipv AS (
  SELECT ip, a * 16777216 + b * 65536 + c * 256 + d AS ip_num FROM _ipn WHERE a <= 255 AND b <= 255 AND c <= 255 AND d <= 255
),
ip_locations AS (
  SELECT v.ip, r.country, r.region, r.city FROM _ipv v JOIN ip_ranges r ON v.ip_num BETWEEN r.ip_from AND r.ip_to
),
stg_location AS (
  SELECT DISTINCT ip AS ip_address, country AS country_name, region AS region_name, city AS city_name FROM ip_locations
),
int_location AS (
  SELECT * FROM (SELECT DISTINCT {skey('country_name', 'region_name', 'city_name')} AS location_key,
                        country_name, region_name, city_name, ip_address FROM stg_location)
  UNION ALL SELECT -1, 'Unknown', 'Unknown', 'Unknown', 'Unknown'
),
dim_location AS (
  SELECT DISTINCT location_key, country_name, region_name, city_name FROM int_location
)"""

DIMS = """,
_cust AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT user_id, device_id, user_agent, resolution, email_address,
           ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY device_id ASC NULLS FIRST, user_agent ASC NULLS FIRST,
                              resolution ASC NULLS FIRST, email_address ASC NULLS FIRST) AS rn
    FROM stg_fact) WHERE rn = 1
),
dim_customer AS (
  SELECT {ck} AS customer_key, user_id, device_id, user_agent, resolution, email_address FROM _cust
  UNION ALL SELECT -1, 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown'
),
_dates AS (SELECT DISTINCT order_local_time AS full_date FROM stg_fact),
dim_date AS (
  SELECT {dk} AS date_key, full_date, day(full_date) AS day, month(full_date) AS month,
         quarter(full_date) AS quarter, year(full_date) AS year, strftime(full_date, '%A') AS day_name,
         strftime(full_date, '%B') AS month_name, dayofweek(full_date) IN (0, 6) AS is_weekend
  FROM _dates
  UNION ALL SELECT -1, CAST(NULL AS DATE), -1, -1, -1, -1, 'Unknown', 'Unknown', FALSE
)""".format(ck=skey("user_id"), dk=skey("full_date"))

FACT = STG_FACT + ",\n" + STG_PRODUCT.lstrip() + IP_LOCATIONS + DIMS + """,
_loc_ip AS (
  SELECT ip_address, MIN(location_key) AS location_key FROM int_location GROUP BY ip_address
),
fact AS (
  SELECT f.fact_sales_order_key, f.order_id,
         COALESCE(p.product_key, -1) AS product_key, COALESCE(c.customer_key, -1) AS customer_key,
         COALESCE(l.location_key, -1) AS location_key, COALESCE(d.date_key, -1) AS date_key,
         f.store_id, f.order_local_time, f.order_timestamp, f.currency_code, f.item_price_status, f.order_qty,
         f.item_price_usd * f.order_qty AS line_total_price,
         SUM(f.item_price_usd * f.order_qty) OVER (PARTITION BY f.order_id) AS order_total_amount
  FROM int_fact f
  LEFT JOIN dim_customer c ON f.user_id = c.user_id
  LEFT JOIN dim_product p ON f.product_id = p.product_id
  LEFT JOIN dim_date d ON f.order_local_time = d.full_date
  LEFT JOIN _loc_ip l ON f.ip_address = l.ip_address
)"""

BEHAVIOUR = """
_bev AS (
  SELECT CAST(e.event_id AS VARCHAR) AS _id,
         CASE e.event_type {arms} ELSE e.event_type END AS collection,
         CASE WHEN e.event_id % 3 != 0 THEN json_extract_string(e.props, '$.k') END AS product_id,
         CASE WHEN e.event_id % 3 = 0 AND e.event_id % 9 != 0 THEN json_extract_string(e.props, '$.k') END AS viewing_product_id,
         cur.url AS current_url, ref.url AS referrer_url
  FROM events e LEFT JOIN pages cur ON cur.page_id = e.user_id LEFT JOIN pages ref ON ref.page_id = e.user_id + 1
),
url_pairs AS (
  SELECT DISTINCT product_id, url FROM (
    SELECT COALESCE(product_id, viewing_product_id) AS product_id,
           CASE WHEN collection = {special} THEN referrer_url ELSE current_url END AS url
    FROM _bev WHERE collection IN ({events}))
  WHERE product_id IS NOT NULL AND url IS NOT NULL
)""".format(arms=" ".join(f"WHEN {q(t)} THEN {q(n)}" for t, n in EVENT_TYPE_TO_COLLECTION),
            special=q(SPECIAL_EVENT), events=", ".join(q(e) for e in PRODUCT_EVENTS + [SPECIAL_EVENT]))

_FALSY = ", ".join(q(x) for x in ["{}", "[]", "null", "false", "0", '""'])
PAGE_RESOLUTION = BEHAVIOUR + f""",
_wanted AS (
  SELECT product_id, CASE WHEN CAST(product_id AS BIGINT) % {GONE_EVERY} = {GONE_AT} THEN url || '{GONE_SUFFIX}' ELSE url END AS url
  FROM url_pairs
),
_page AS (
  SELECT page_id, url, CASE WHEN page_id % {OBJECT_EVERY} = 0 THEN regexp_replace(html, '{TRACK_PATTERN}',
    'track({OBJECT_PAYLOAD.replace('<n>', chr(92) + '1')})', 'g') ELSE html END AS html
  FROM pages
),
_payloads AS (
  SELECT url, payload FROM (
    SELECT url, NULLIF(regexp_extract(html, '{PAYLOAD_PATTERN}', 1), '') AS payload FROM (
      SELECT url, html FROM _page WHERE page_id % {FAIL_EVERY} != 0
      UNION ALL
      SELECT printf({q(fallback_url_template(HOST))}, CAST(page_id AS VARCHAR)), html FROM _page WHERE page_id % 4 = 0))
  WHERE payload IS NOT NULL AND json_valid(payload) AND trim(payload) NOT IN ({_FALSY})
),
_cand AS (
  SELECT product_id, url, 0 AS priority FROM _wanted
  UNION ALL
  SELECT DISTINCT product_id, printf({q(fallback_url_template(HOST))}, product_id) AS url, 1 AS priority FROM _wanted
),
resolved AS (
  SELECT product_id, url, payload FROM (
    SELECT c.product_id, c.url, p.payload,
           ROW_NUMBER() OVER (PARTITION BY c.product_id ORDER BY c.priority, c.url, p.payload) AS rn
    FROM _cand c JOIN _payloads p ON c.url = p.url) WHERE rn = 1
)"""


def cents_text(c: str) -> str:
    """Whole cents as the text of a decimal with two places."""
    return (f"(CASE WHEN {c} < 0 THEN '-' ELSE '' END || CAST(abs({c}) // 100 AS VARCHAR) || '.' || "
            f"lpad(CAST(abs({c}) % 100 AS VARCHAR), 2, '0'))")


# Whole 10^-9 units and cents as HUGEINT; the product with a rate is taken in two halves.
_nine = "lpad(CAST(({}) % 1000000000 AS VARCHAR), 9, '0')"
_a, _b, _c = (_nine.format(x) for x in ("l_orderkey", "l_partkey", "CAST(ROUND(l_extendedprice * 100) AS BIGINT)"))
WIDE = f"""
_digits AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(trunc(l_quantity) AS INTEGER) AS qty,
         CASE l_linenumber % 5 WHEN 0 THEN {_c} WHEN 1 THEN {_a} || {_c} WHEN 2 THEN {_b} || {_a} || {_c}
              WHEN 3 THEN CAST(l_suppkey % 99 + 1 AS VARCHAR) || {_b} || {_a} || {_c}
              ELSE '100' || {_b} || {_a} || {_c} END AS whole,
         {_nine.format('l_partkey * 7919 + l_orderkey')} AS nine
  FROM lineitem
),
_raw AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_partkey % 101 = 0 THEN 'n/a' WHEN l_partkey % 107 = 0 THEN ' 0,00 '
              ELSE CASE WHEN l_suppkey % 11 = 0 THEN '-' ELSE '' END || whole ||
                   CASE l_orderkey % 3 WHEN 0 THEN '.' || nine WHEN 1 THEN ',' || lpad(CAST(l_suppkey % 100 AS VARCHAR), 2, '0')
                                       ELSE '٫' || nine END END AS price_raw,
         {pick('l_suppkey % 6', WIDE_CODES)} AS currency_code,
         CASE WHEN l_partkey % 103 = 0 THEN {HUGE_QUANTITY} ELSE qty END AS quantity
  FROM _digits
),
_units AS (
  SELECT r.*, {parse_price('price_raw', 38)} AS price, e.rate_to_usd AS rate,
         CAST(e.rate_to_usd * 1000000 AS HUGEINT) AS micro
  FROM _raw r LEFT JOIN {SEED} e ON r.currency_code = e.currency_code
),
_whole AS (SELECT *, CAST(replace(CAST(price AS VARCHAR), '.', '') AS HUGEINT) AS u FROM _units),
_cents AS (
  SELECT *, CASE WHEN u < 0 THEN -1 ELSE 1 END * (
           (abs(u) // 10000000000000000000) * micro * 1000000
           + ((abs(u) % 10000000000000000000) * micro + 5000000000000) // 10000000000000) AS usd
  FROM _whole
),
_lines AS (
  SELECT *, CASE WHEN abs(usd) <= 99999999999999999999999999999999999999 // quantity THEN usd * quantity END AS line_total
  FROM _cents
)"""


_V4_DOTTED = "concat_ws('.', v // 16777216, v // 65536 % 256, v // 256 % 256, v % 256)"
_V4_KEY, _SITE_KEY = "repeat('0', 20) || 'ffff' || printf('%08x', {})", "'20010db8' || printf('%04x', n)"
_HOST_KEY = f"{_SITE_KEY} || repeat('0', 16) || printf('%04x', n)"
ADDRESSES = f"""
_ord AS (SELECT o_orderkey, o_orderkey % 8 AS m, o_orderkey % 25 AS n, o_orderkey % 65536 AS low, o_orderkey // 65536 % 65536 AS high,
                (o_orderkey % 1000003) * 2654435761 % 4294967296 AS v FROM orders),
_addr AS (
  SELECT o_orderkey,
    CASE WHEN m < 3 THEN {_V4_DOTTED} WHEN m = 3 THEN '::ffff:' || {_V4_DOTTED}
         WHEN m = 4 THEN printf('2001:db8:%x::%x', n, low)
         WHEN m = 5 THEN printf('2001:0DB8:%04X:0:0:0:%X:%X', n, high, low)
         WHEN m = 6 THEN printf('2001:db8:%x::', n) || {_V4_DOTTED} ELSE printf('2001:db8:%x::1::2', n) END AS address,
    CASE WHEN m < 4 THEN {_V4_KEY.format('v')}
         WHEN m = 4 THEN {_SITE_KEY} || repeat('0', 16) || printf('%04x', low)
         WHEN m = 5 THEN {_SITE_KEY} || repeat('0', 12) || printf('%04x%04x', high, low)
         WHEN m = 6 THEN {_SITE_KEY} || repeat('0', 12) || printf('%08x', v) END AS key
  FROM _ord),
_nat AS (SELECT n_name AS country, n_nationkey AS n FROM nation),
_addr_ranges AS (
  SELECT 'block' AS kind, country, {_V4_KEY.format('CAST(n AS BIGINT) * 167772160')} AS lo, {_V4_KEY.format('CAST(n AS BIGINT) * 167772160 + 16777215')} AS hi FROM _nat
  UNION ALL SELECT 'odd', country, {_V4_KEY.format('(CAST(n AS BIGINT) * 10 + 1) * 16777216 + 131844')},
    {_V4_KEY.format('(CAST(n AS BIGINT) * 10 + 3) * 16777216 + 13126921')} FROM _nat
  UNION ALL SELECT 'site', country, {_SITE_KEY} || repeat('0', 20), {_SITE_KEY} || repeat('f', 20) FROM _nat
  UNION ALL SELECT 'host', country, {_HOST_KEY}, {_HOST_KEY} FROM _nat)"""


def with_(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip().lstrip(",").strip() + "\n" + body


def edge(cols: list[tuple[str, str]], src: str) -> str:
    """Final projection with edge casts: s text, i bigint, d double, b boolean, t date-as-text."""
    out = []
    for name, kind in cols:
        expr = {"s": f"CAST({name} AS VARCHAR)", "i": f"CAST({name} AS BIGINT)", "d": f"CAST({name} AS DOUBLE)",
                "b": f"CAST({name} AS BOOLEAN)", "t": f"CAST({name} AS VARCHAR)"}[kind]
        out.append(f"{expr} AS {name}")
    return f"SELECT {', '.join(out)} FROM {src}"


CART_LINE_COLS = [("ip_address", "s"), ("user_agent", "s"), ("resolution", "s"), ("user_id", "s"),
                  ("device_id", "s"), ("store_id", "s"), ("order_id", "s"), ("email_address", "s"),
                  ("product_id", "i"), ("order_qty", "i"), ("item_price_raw", "s"), ("currency_code_raw", "s"),
                  ("domain", "s"), ("order_local_time", "t"), ("order_timestamp", "i")]
STG_FACT_COLS = CART_LINE_COLS + [("item_price", "d"), ("item_price_status", "s"), ("currency_code", "s"),
                                  ("currency_source", "s"), ("item_price_usd", "d")]
FACT_COLS = [("fact_sales_order_key", "i"), ("order_id", "s"), ("product_key", "i"), ("customer_key", "i"),
             ("location_key", "i"), ("date_key", "i"), ("store_id", "s"), ("order_local_time", "t"),
             ("order_timestamp", "i"), ("currency_code", "s"), ("item_price_status", "s"), ("order_qty", "i"),
             ("line_total_price", "d"), ("order_total_amount", "d")]
DIM_PRODUCT_COLS = [("product_key", "i"), ("product_id", "i"), ("product_name", "s"), ("category_id", "i"),
                    ("category_name", "s"), ("unit_price_usd", "d"), ("min_price_usd", "d"), ("max_price_usd", "d")]
DIM_DATE_COLS = [("date_key", "i"), ("full_date", "t"), ("day", "i"), ("month", "i"), ("quarter", "i"), ("year", "i"),
                 ("day_name", "s"), ("month_name", "s"), ("is_weekend", "b")]
DIM_CUSTOMER_COLS = [("customer_key", "i"), ("user_id", "s"), ("device_id", "s"), ("user_agent", "s"),
                     ("resolution", "s"), ("email_address", "s")]
DIM_LOCATION_COLS = [("location_key", "i"), ("country_name", "s"), ("region_name", "s"), ("city_name", "s")]
STG_PRODUCT_COLS = [("product_id", "i"), ("product_name", "s"), ("category_id", "i"), ("category_name", "s"),
                    ("unit_price", "d"), ("min_price", "d"), ("max_price", "d"), ("product_qty", "s"),
                    ("min_price_format", "s"), ("raw_symbol", "s"), ("currency_code", "s")]
METRIC_COLS = [("revenue", "d"), ("orders", "i"), ("items_sold", "i"), ("unique_customers", "i")]


def _metrics(dim: str, key: str, attrs: list[tuple[str, str]]) -> str:
    names = ", ".join(a for a, _ in attrs)
    body = (f"(SELECT {', '.join('d.' + a for a, _ in attrs)}, SUM(f.line_total_price) AS revenue, "
            f"COUNT(DISTINCT f.order_id) AS orders, SUM(f.order_qty) AS items_sold, "
            f"COUNT(DISTINCT f.customer_key) AS unique_customers "
            f"FROM fact f LEFT JOIN {dim} d ON f.{key} = d.{key} GROUP BY {names})")
    return with_(FACT, edge(attrs + METRIC_COLS, body))


def _dq_summary(checks: list[tuple[str, str]]) -> str:
    parts = " UNION ALL ".join(f"SELECT {q(name)} AS check_name, CAST(COUNT(*) AS BIGINT) AS failures FROM ({sql})"
                               for name, sql in checks)
    return with_(FACT, f"SELECT * FROM ({parts})")


def dq_unique_checks():
    u = lambda t, c: f"SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1"
    return [("dim_product.product_key", u("dim_product", "product_key")),
            ("dim_product.product_id", u("dim_product", "product_id")),
            ("dim_customer.customer_key", u("dim_customer", "customer_key")),
            ("dim_customer.user_id", u("dim_customer", "user_id")),
            ("dim_date.date_key", u("dim_date", "date_key")),
            ("dim_date.full_date", u("dim_date", "full_date")),
            ("dim_location.location_key", u("dim_location", "location_key")),
            ("fact_sales_order.fact_sales_order_key", u("fact", "fact_sales_order_key")),
            ("product_info.product_id", u("product_info", "product_id"))]


def dq_not_null_checks():
    n = lambda t, c: f"SELECT 1 FROM {t} WHERE {c} IS NULL"
    return [("dim_product.product_key", n("dim_product", "product_key")),
            ("dim_product.product_id", n("dim_product", "product_id")),
            ("dim_customer.customer_key", n("dim_customer", "customer_key")),
            ("dim_customer.user_id", n("dim_customer", "user_id")),
            ("dim_date.date_key", n("dim_date", "date_key")),
            ("dim_date.is_weekend", n("dim_date", "is_weekend")),
            ("dim_location.location_key", n("dim_location", "location_key")),
            ("fact_sales_order.fact_sales_order_key", n("fact", "fact_sales_order_key")),
            ("fact_sales_order.product_key", n("fact", "product_key")),
            ("fact_sales_order.date_key", n("fact", "date_key")),
            ("fact_sales_order.customer_key", n("fact", "customer_key")),
            ("fact_sales_order.location_key", n("fact", "location_key")),
            ("fact_sales_order.order_id", n("fact", "order_id")),
            ("fact_sales_order.order_qty", n("fact", "order_qty"))]


def dq_relationship_checks():
    r = lambda c, t: f"SELECT 1 FROM fact f WHERE f.{c} IS NOT NULL AND f.{c} NOT IN (SELECT {c} FROM {t} WHERE {c} IS NOT NULL)"
    return [("fact_sales_order.product_key", r("product_key", "dim_product")),
            ("fact_sales_order.date_key", r("date_key", "dim_date")),
            ("fact_sales_order.customer_key", r("customer_key", "dim_customer")),
            ("fact_sales_order.location_key", r("location_key", "dim_location")),
            ("orders.o_custkey", "SELECT 1 FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN "
                                 "(SELECT c_custkey FROM customer WHERE c_acctbal >= 0 AND c_custkey IS NOT NULL)")]


def oracle_sql() -> dict[str, str]:
    sq = {}
    sq["cart_explode"] = with_(CHECKOUT_BASE, edge(CART_LINE_COLS, "cart_lines"))
    sq["parse_price"] = with_(CHECKOUT_BASE, edge(
        [("item_price_raw", "s"), ("item_price", "d"), ("item_price_status", "s")],
        f"(SELECT item_price_raw, {parse_price('item_price_raw')} AS item_price, "
        f"{price_status('item_price_raw')} AS item_price_status FROM cart_lines)"))
    sq["dedup_order_items"] = with_(STG_FACT, edge(CART_LINE_COLS, "_dedup"))
    sq["currency_from_symbol"] = with_(CHECKOUT_BASE, edge(
        [("currency_code_raw", "s"), ("currency_code_from_symbol", "s")],
        f"(SELECT currency_code_raw, {cart_currency('currency_code_raw')} AS currency_code_from_symbol FROM cart_lines)"))
    sq["currency_resolved"] = with_(STG_FACT, edge(
        [("order_id", "s"), ("product_id", "i"), ("domain", "s"), ("currency_code_raw", "s"),
         ("currency_code", "s"), ("currency_source", "s")], "stg_fact"))
    sq["usd_conversion"] = with_(STG_FACT, edge(
        [("order_id", "s"), ("product_id", "i"), ("item_price", "d"), ("currency_code", "s"), ("item_price_usd", "d")],
        "stg_fact"))
    sq["guest_identity"] = with_(CHECKOUT_BASE, edge(
        [("user_id_db", "s"), ("device_id", "s"), ("email_raw", "s"), ("user_id", "s"), ("email_address", "s")],
        f"(SELECT user_id_db, device_id, email_address AS email_raw, "
        f"COALESCE({nullif_blank('user_id_db')}, 'guest_' || device_id) AS user_id, "
        f"COALESCE({nullif_blank('email_address')}, 'Unknown') AS email_address FROM _ev WHERE collection = 'checkout_success')"))
    sq["stg_fact_sales_order"] = with_(STG_FACT, edge(STG_FACT_COLS, "stg_fact"))
    sq["int_fact_sales_order"] = with_(STG_FACT, edge([("fact_sales_order_key", "i")] + STG_FACT_COLS, "int_fact"))
    sq["surrogate_key"] = edge(
        [("o_orderkey", "i"), ("key_single", "i"), ("key_pair", "i"), ("key_with_null", "i")],
        f"(SELECT o_orderkey, {skey('o_orderkey')} AS key_single, {skey('o_orderkey', 'o_orderstatus')} AS key_pair, "
        f"{skey('CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END', 'o_orderstatus')} AS key_with_null FROM orders)")
    sq["stg_dim_product"] = with_(STG_PRODUCT, edge(STG_PRODUCT_COLS, "stg_product"))
    sq["product_currency"] = with_(PRODUCT_BASE, edge(
        [("product_id", "s"), ("min_price_format", "s"), ("raw_symbol", "s"), ("currency_code", "s")],
        f"(SELECT product_id, min_price_format, {product_symbol('min_price_format')} AS raw_symbol, "
        f"{product_currency('min_price_format')} AS currency_code FROM product_info)"))
    sq["dim_product"] = with_(STG_PRODUCT, edge(DIM_PRODUCT_COLS, "dim_product"))
    sq["dedup_products"] = with_(STG_PRODUCT, edge(STG_PRODUCT_COLS[:9], "_prod_dedup"))
    sq["dedup_customers"] = with_(STG_FACT + DIMS, edge(DIM_CUSTOMER_COLS[1:], "_cust"))
    sq["ip_range_join"] = with_(CHECKOUT_BASE + IP_LOCATIONS, edge(
        [("ip", "s"), ("country", "s"), ("region", "s"), ("city", "s")], "ip_locations"))
    sq["address_locations"] = with_(ADDRESSES, edge(
        [("o_orderkey", "i"), ("address", "s"), ("kind", "s"), ("country", "s")],
        "(SELECT a.o_orderkey, a.address, r.kind, r.country FROM _addr a LEFT JOIN _addr_ranges r ON a.key BETWEEN r.lo AND r.hi)"))
    sq["ip_lookup_counters"] = with_(CHECKOUT_BASE + IP_LOCATIONS, edge(
        [("total", "i"), ("failed", "i"), ("located", "i"), ("not_found", "i")],
        "(SELECT (SELECT COUNT(*) FROM _ips) AS total, (SELECT COUNT(*) FROM _ips) - (SELECT COUNT(*) FROM _ipv) AS failed, "
        "(SELECT COUNT(DISTINCT ip) FROM ip_locations) AS located, "
        "(SELECT COUNT(*) FROM _ipv) - (SELECT COUNT(DISTINCT ip) FROM ip_locations) AS not_found)"))
    sq["stg_dim_location"] = with_(CHECKOUT_BASE + IP_LOCATIONS, edge(
        [("ip_address", "s"), ("country_name", "s"), ("region_name", "s"), ("city_name", "s")], "stg_location"))
    sq["dim_location"] = with_(CHECKOUT_BASE + IP_LOCATIONS, edge(DIM_LOCATION_COLS, "dim_location"))
    sq["dim_customer"] = with_(STG_FACT + DIMS, edge(DIM_CUSTOMER_COLS, "dim_customer"))
    sq["dim_date"] = with_(STG_FACT + DIMS, edge(DIM_DATE_COLS, "dim_date"))
    sq["fact_sales_order"] = with_(FACT, edge(FACT_COLS, "fact"))
    sq["order_total"] = with_(STG_FACT, edge(
        [("order_id", "s"), ("product_id", "i"), ("line_total_price", "d"), ("order_total_amount", "d")],
        "(SELECT order_id, product_id, item_price_usd * order_qty AS line_total_price, "
        "SUM(item_price_usd * order_qty) OVER (PARTITION BY order_id) AS order_total_amount FROM stg_fact)"))
    sq["metrics_by_month"] = _metrics("dim_date", "date_key", [("year", "i"), ("month", "i")])
    sq["metrics_by_country"] = _metrics("dim_location", "location_key", [("country_name", "s")])
    sq["metrics_by_category"] = _metrics("dim_product", "product_key", [("category_name", "s")])
    sq["dq_unique"] = _dq_summary(dq_unique_checks())
    sq["unique_columns"] = "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{t}.{c}' AS check_name, CAST(COUNT(*) AS BIGINT) AS failures FROM "
        f"(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)"
        for t, cols in {"orders": ["o_orderkey", "o_custkey", "o_orderdate"], "customer": ["c_custkey", "c_name", "c_nationkey"],
                        "lineitem": ["l_orderkey", "l_partkey"], "part": ["p_partkey", "p_name"],
                        "documents": ["doc_id", "text"]}.items() for c in cols) + ")"
    sq["dq_not_null"] = _dq_summary(dq_not_null_checks())
    sq["dq_accepted_values"] = _dq_summary([("dim_date.is_weekend", "SELECT 1 FROM dim_date WHERE is_weekend IS NOT NULL AND is_weekend NOT IN (TRUE, FALSE)"),
                                            ("orders.o_orderstatus", "SELECT 1 FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')")])
    sq["dq_relationships"] = _dq_summary(dq_relationship_checks())
    money_text = ", ".join(f"{cents_text(c)} AS {c}" for c in ("usd", "line_total", "order_total"))
    sq["wide_money"] = with_(WIDE, edge(
        [("l_orderkey", "i"), ("l_linenumber", "i"), ("price_raw", "s"), ("currency_code", "s"), ("quantity", "i"),
         ("price", "s"), ("usd", "s"), ("line_total", "s"), ("order_total", "s")],
        f"(SELECT * EXCLUDE (usd, line_total, order_total), {money_text} FROM "
        "(SELECT *, SUM(line_total) OVER (PARTITION BY l_orderkey) AS order_total FROM _lines))"))
    sq["money_losses"] = with_(WIDE, edge(
        [("currency_code", "s")] + [(c, "i") for c in ("n_lines", "n_unread", "n_no_rate", "n_lost_usd", "n_lost_totals")],
        "(SELECT currency_code, COUNT(*) AS n_lines, COUNT(*) FILTER (price_raw <> ' 0,00 ' AND price IS NULL) AS n_unread, "
        "COUNT(*) FILTER (price IS NOT NULL AND rate IS NULL) AS n_no_rate, "
        "COUNT(*) FILTER (price IS NOT NULL AND rate IS NOT NULL AND usd IS NULL) AS n_lost_usd, "
        "COUNT(*) FILTER (usd IS NOT NULL AND line_total IS NULL) AS n_lost_totals FROM _lines GROUP BY currency_code)"))
    lines = ("_skew AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE CAST(l_orderkey AS VARCHAR) END AS order_id, "
             "l_orderkey AS line_order, l_linenumber AS line_number, CASE WHEN l_linenumber % 3 = 1 THEN 1 "
             "WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_partkey END AS part_id, "
             "CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)")
    hot = " UNION ALL ".join(
        f"SELECT '{c}' AS key_name, CAST({c} AS VARCHAR) AS key_value, COUNT(*) AS n_rows, "
        f"(SELECT COUNT(*) FROM _skew) AS n_total FROM _skew GROUP BY {c}" for c in ("order_id", "part_id"))
    sq["hot_keys"] = with_(lines, edge([("key_name", "s"), ("key_value", "s"), ("n_rows", "i"), ("n_total", "i")],
                                       f"({hot}) WHERE n_rows >= 0.05 * n_total"))
    sq["salted_join"] = with_(lines, edge(
        [("order_id", "s"), ("line_order", "i"), ("line_number", "i"), ("part_id", "i"), ("cents", "i"), ("p_name", "s"),
         ("order_cents", "i")],
        "(SELECT s.*, p_name, SUM(cents) OVER (PARTITION BY order_id) AS order_cents FROM _skew s "
        "LEFT JOIN part ON part_id = p_partkey)"))
    sq["url_domain"] = edge([("page_id", "i"), ("url", "s"), ("domain", "s")],
                            f"(SELECT page_id, url, {url_domain('url')} AS domain FROM pages)")
    sq["clean_string"] = edge([("doc_id", "i"), ("text_clean", "s")],
                              f"(SELECT doc_id, {clean_string('text')} AS text_clean FROM documents)")
    sq["script_extract"] = edge([("page_id", "i"), ("payload", "s")],
                                f"(SELECT page_id, NULLIF(regexp_extract(html, '{TRACK_PATTERN}', 1), '') AS payload FROM pages)")
    sq["json_field"] = edge([("event_id", "i"), ("k", "i")],
                            "(SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)")
    sq["option_normalize"] = edge(
        [("event_id", "i"), ("n_options", "i"), ("first_k", "s")],
        "(SELECT event_id, CASE WHEN event_id % 4 IN (0, 1) THEN 1 ELSE 0 END AS n_options, "
        "CASE WHEN event_id % 4 IN (0, 1) THEN json_extract_string(props, '$.k') END AS first_k FROM events)")
    sq["product_url_pairs"] = with_(BEHAVIOUR, edge([("product_id", "s"), ("url", "s")], "url_pairs"))
    sq["product_urls"] = with_(BEHAVIOUR, edge(
        [("product_id", "s"), ("n_urls", "i"), ("first_url", "s"), ("last_url", "s")],
        "(SELECT product_id, COUNT(*) AS n_urls, MIN(url) AS first_url, MAX(url) AS last_url "
        "FROM url_pairs GROUP BY product_id)"))
    sq["url_lists"] = with_(BEHAVIOUR, edge(
        [("product_id", "s"), ("n_urls", "i"), ("url", "s")],
        "(SELECT product_id, 1 AS n_urls, url FROM url_pairs QUALIFY ROW_NUMBER() OVER "
        "(PARTITION BY product_id ORDER BY length(url) % 3 DESC, url) = 1)"))
    sq["product_url_counts"] = with_(BEHAVIOUR, edge(
        [("n_products", "i"), ("n_urls", "i")],
        "(SELECT COUNT(DISTINCT product_id) AS n_products, COUNT(*) AS n_urls FROM url_pairs)"))
    sq["resolve_pages"] = with_(PAGE_RESOLUTION, edge([("product_id", "s"), ("url", "s"), ("payload", "s")], "resolved"))
    unresolved = "product_id NOT IN (SELECT product_id FROM resolved)"
    sq["failed_products"] = with_(PAGE_RESOLUTION, edge(
        [("product_id", "s")],
        f"(SELECT DISTINCT product_id FROM _wanted WHERE {unresolved})"))
    filled = ["product_id", "name", "sku", "type_id", "price", "min_price", "max_price", "min_price_format", "qty",
              "category", "category_name"]
    product_text = ", ".join((clean_string(f) if f in filled else "CAST(NULL AS VARCHAR)") + f" AS {f}" for f in PRODUCT_FIELDS)
    sq["product_export"] = with_(PRODUCT_BASE, edge([(f, "s") for f in PRODUCT_FIELDS],
                                                    f"(SELECT {product_text} FROM product_info)"))
    event_text = ["collection", "local_time", "ip", "user_agent", "resolution", "user_id_db", "device_id", "email_address",
                  "store_id", "order_id", "current_url"]
    no_text = ["referrer_url", "product_id", "viewing_product_id"]
    sq["event_export"] = with_(CHECKOUT_BASE, edge(
        [(c, "s") for c in event_text + no_text + ["first_product", "first_currency"]]
        + [(c, "i") for c in ("time_stamp", "option", "n_items", "first_amount", "n_item_options")],
        "(SELECT " + ", ".join(f"{clean_string(c)} AS {c}" for c in event_text) + ", "
        + ", ".join(f"NULL AS {c}" for c in no_text) + ", time_stamp, 0 AS option, "
        "CASE WHEN ln = 7 THEN 0 WHEN ln % 4 = 0 THEN 2 ELSE 1 END AS n_items, "
        "CASE WHEN ln <> 7 THEN item_product_id END AS first_product, CASE WHEN ln <> 7 THEN item_currency END AS first_currency, "
        "CASE WHEN ln <> 7 THEN item_amount END AS first_amount, "
        "CASE WHEN ln <> 7 THEN CASE WHEN ln % 2 = 0 AND ln % 4 <> 0 THEN 1 ELSE 0 END END AS n_item_options FROM _ev)"))
    cell = lambda x: f"COALESCE('=' || CAST({x} AS VARCHAR), '-')"
    digest = lambda name, cells, src: (
        f"SELECT '{name}' AS dataset, COUNT(*) AS n_rows, CAST(SUM(CAST(h AS HUGEINT)) AS VARCHAR) AS hash_sum, "
        f"bit_xor(h) AS hash_xor FROM (SELECT ('0x' || substr(md5(concat_ws(chr(31), {', '.join(cells)})), 1, 15))::BIGINT AS h FROM {src})")
    products = [cell(clean_string(f)) if f in filled else "'-'" for f in PRODUCT_FIELDS]
    events = [cell(c) if c == "time_stamp" else cell(clean_string(c)) for c in
              ["collection", "time_stamp", *event_text[1:]]] + ["'=' || CASE WHEN ln = 7 THEN 0 WHEN ln % 4 = 0 THEN 2 ELSE 1 END"]
    sq["export_content"] = with_(CHECKOUT_BASE + IP_LOCATIONS + ",\n" + PRODUCT_BASE.lstrip(), edge(
        [("dataset", "s"), ("n_rows", "i"), ("hash_sum", "s"), ("hash_xor", "i")], "(" + " UNION ALL ".join([
            digest("ip_locations", [cell(c) for c in ("ip", "country", "region", "city")], "ip_locations"),
            digest("product_info", products, "product_info"), digest("product_info_clean", products, "product_info"),
            digest("raw_events", events, "_ev")]) + ")"))
    sq["ip_location_load"] = with_(CHECKOUT_BASE + IP_LOCATIONS, edge(
        [("ip", "s"), ("country", "s"), ("region", "s"), ("city", "s"), ("source", "s")],
        "(SELECT *, UNNEST(['json', 'csv']) AS source FROM ip_locations)"))
    sq["option_string_entries"] = edge([("event_id", "i"), ("n_options", "i"), ("first_k", "s")],
                                       "(SELECT event_id, 1 AS n_options, json_extract_string(props, '$.k') AS first_k FROM events)")
    spread = ", ".join(f"CASE WHEN payload LIKE '{{%' THEN json_extract_string(payload, '$.{f}') END AS {f}" for f in ("sku", "qty", "name"))
    sq["collect_products"] = with_(PAGE_RESOLUTION, edge(
        [(c, "s") for c in ("product_id", "url", "payload", "sku", "qty", "name", "status")],
        f"(SELECT product_id, url, payload, {spread}, 'found' AS status FROM resolved UNION ALL "
        f"SELECT DISTINCT product_id, NULL, NULL, NULL, NULL, NULL, 'failed' FROM _wanted WHERE {unresolved})"))
    one_field = lambda f, x: f"SELECT product_id, '{f}' AS field, {x} AS value FROM resolved"
    records = [one_field(f, f) for f in ("product_id", "url", "payload")] + [
        one_field(f, f"json_extract_string(payload, '$.{f}')") + " WHERE payload LIKE '{%'" for f in ("sku", "qty", "name", "shelf")]
    sq["page_records"] = with_(PAGE_RESOLUTION, edge([(c, "s") for c in ("product_id", "field", "value")],
                                                     f"({' UNION ALL '.join(records)}) WHERE value IS NOT NULL"))
    sq["jsonl_roundtrip"] = sq["cart_explode"]
    sq["ingest_idempotent"] = sq["cart_explode"]
    sq["normalize_record"] = with_(CHECKOUT_BASE, edge(
        [("collection", "s"), ("order_id", "s"), ("user_id_db", "s"), ("email_address", "s"), ("device_id", "s"),
         ("n_items", "i"), ("first_price", "s")],
        f"(SELECT collection, order_id, {clean_string('user_id_db')} AS user_id_db, "
        f"{clean_string('email_address')} AS email_address, {clean_string('device_id')} AS device_id, "
        "CASE WHEN ln = 7 THEN 0 WHEN ln % 4 = 0 THEN 2 ELSE 1 END AS n_items, "
        "CASE WHEN ln = 7 THEN NULL WHEN ln % 4 = 0 THEN zero_price ELSE item_price END AS first_price FROM _ev)"))
    sq["corrupt_lines"] = with_(PRODUCT_BASE, edge(
        [("product_id", "s"), ("name", "s"), ("status", "s")],
        "(SELECT product_id, name, 'ok' AS status FROM product_info WHERE CAST(product_id AS BIGINT) % 11 != 0 "
        "UNION ALL SELECT NULL, NULL, 'rejected' FROM product_info WHERE CAST(product_id AS BIGINT) % 11 = 0)"))
    sq["product_rejects"] = with_(PRODUCT_BASE, edge(
        [("product_id", "s"), ("name", "s"), ("file_no", "i"), ("line_no", "i")],
        "(SELECT product_id, name, NULL AS file_no, NULL AS line_no FROM product_info WHERE CAST(product_id AS BIGINT) % 11 != 0 "
        "UNION ALL SELECT product_id, NULL, file_no, line_no FROM (SELECT *, ROW_NUMBER() OVER "
        "(PARTITION BY file_no ORDER BY pk, name, pos) AS line_no FROM (SELECT product_id, name, pos, "
        "CAST(product_id AS BIGINT) AS pk, CAST(product_id AS BIGINT) // 500 AS file_no "
        "FROM product_info, (VALUES (0), (1)) AS _l(pos) WHERE pos = 1 OR CAST(product_id AS BIGINT) % 17 = 0)) "
        "WHERE pos = 1 AND pk % 11 = 0)"))
    sq["table_load"] = with_(PRODUCT_BASE, edge(
        [("product_id", "s"), ("name", "s"), ("sku", "s"), ("min_price_format", "s")],
        "(SELECT product_id, name, sku, min_price_format FROM product_info WHERE CAST(product_id AS BIGINT) % 7 != 0)"))
    sq["export_datasets"] = with_(CHECKOUT_BASE + IP_LOCATIONS + ",\n" + PRODUCT_BASE.lstrip(), edge(
        [("dataset", "s"), ("records", "i")],
        "(SELECT 'ip_locations' AS dataset, COUNT(*) AS records FROM ip_locations "
        "UNION ALL SELECT 'product_info', COUNT(*) FROM product_info "
        "UNION ALL SELECT 'product_info_clean', COUNT(*) FROM product_info "
        "UNION ALL SELECT 'raw_events', COUNT(*) FROM _ev)"))
    loaded = {"raw_events": "_ev", "product_info": "product_info", "ip_locations": "ip_locations"}
    outcomes = " UNION ALL ".join(
        f"SELECT '{f}' AS feed, 'SUCCESS' AS status, COUNT(*) AS rows, 0 AS bad_lines FROM {t} "
        f"UNION ALL SELECT '{f}', 'DUPLICATE_SKIPPED', 0, 0" for f, t in loaded.items())
    feeds = CHECKOUT_BASE + IP_LOCATIONS + ",\n" + PRODUCT_BASE.lstrip()
    sq["ingest_feeds"] = with_(feeds, edge(
        [("feed", "s"), ("status", "s"), ("rows", "i"), ("bad_lines", "i")],
        f"({outcomes} UNION ALL SELECT 'product_info', 'FAILED', 0, COUNT(*) FROM product_info "
        "WHERE CAST(product_id AS BIGINT) % 11 = 0)"))
    sq["feed_rows"] = with_(feeds, edge(
        [("feed", "s"), ("key", "s"), ("value", "s")],
        "(SELECT 'raw_events' AS feed, order_id AS key, concat_ws('|', ip, local_time, "
        "CASE WHEN ln = 7 THEN '0' WHEN ln % 4 = 0 THEN '2' ELSE '1' END, "
        "CASE WHEN ln = 7 THEN NULL WHEN ln % 4 = 0 THEN zero_price ELSE item_price END) AS value FROM _ev "
        "UNION ALL SELECT 'product_info', product_id, concat_ws('|', name, sku, price, min_price_format) FROM product_info "
        "UNION ALL SELECT 'ip_locations', ip, concat_ws('|', country, region, city) FROM ip_locations)"))
    return sq
