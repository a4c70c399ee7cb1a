"""Pure Column expressions. Every function here takes and returns ``Column`` and
compiles to built-in Catalyst expressions (no Python UDF), so it stays inside
whole-stage code generation."""

from orderlake.functions.text import (  # noqa: F401
    clean_string, nullif_blank, unicode_trim, url_domain, extract_script_payload, WHITESPACE_CLASS,
)
from orderlake.functions.price import parse_price, item_price_status, safe_decimal, safe_int  # noqa: F401
from orderlake.functions.currency import cart_currency_from_symbol, product_currency, product_raw_symbol  # noqa: F401
from orderlake.functions.keys import surrogate_key, key_text  # noqa: F401
from orderlake.functions.dates import parse_local_date, date_attributes  # noqa: F401
from orderlake.functions.json_shape import normalize_option_json, normalize_cart_json, json_array_of_objects  # noqa: F401
