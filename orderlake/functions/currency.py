"""Currency from a price symbol: the cart rule (C6) and the product rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlake.functions.text import _col, unicode_trim

# ---------------------------------------------------------------------------------
# Cart currency symbol -> ISO code, in the order the rules are tried.
# The symbol is compared after trimming; an unknown symbol gives null.
CART_SYMBOL_TO_CODE = [
    ("€", "EUR"), ("£", "GBP"), ("¥", "JPY"), ("￥", "JPY"), ("₺", "TRY"), ("₹", "INR"),
    ("₱", "PHP"), ("₫", "VND"), ("₲", "PYG"), ("₡", "CRC"), ("zł", "PLN"), ("Ft", "HUF"),
    ("Kč", "CZK"), ("kn", "HRK"), ("лв.", "BGN"), ("лв", "BGN"), ("CHF", "CHF"),
    ("CLP", "CLP"), ("UYU", "UYU"), ("د.ك.‏", "KWD"), ("kr", "SEK"),
    ("SGD $", "SGD"), ("USD $", "USD"), ("CAD $", "CAD"), ("MXN $", "MXN"), ("AU $", "AUD"),
    ("NZD $", "NZD"), ("HKD $", "HKD"), ("COP $", "COP"), ("DOP $", "DOP"), ("R$", "BRL"),
    ("Lei", "RON"), ("BOB Bs", "BOB"), ("PEN S/.", "PEN"), ("CRC ₡", "CRC"), ("GTQ Q", "GTQ"),
    ("din.", "RSD"), ("$", "USD"),
]

# Product price-format symbol (digits, separators, blanks and slashes
# removed, upper-cased, trimmed) -> ISO code. KR, ¥ and L map to null here and are
# settled by PRODUCT_SYMBOL_FALLBACK; every other symbol is UNKNOWN.
PRODUCT_SYMBOL_TO_CODE = [
    ("USD", "USD"), ("MXN", "MXN"), ("CLP", "CLP"), ("AED", "AED"), ("AZN", "AZN"),
    ("BOB", "BOB"), ("CHF", "CHF"), ("ZAR", "ZAR"), ("RON", "RON"), ("COP$", "COP"),
    ("€", "EUR"), ("£", "GBP"), ("₫", "VND"), ("₱", "PHP"), ("₲", "PYG"), ("₡", "CRC"),
    ("฿", "THB"), ("R$", "BRL"), ("RM", "MYR"), ("AU$", "AUD"), ("CA$", "CAD"),
    ("SG$", "SGD"), ("RD$", "DOP"), ("$U", "UYU"), ("COP", "COP"),
    ("LEI", "RON"), ("ZL", "PLN"), ("KC", "CZK"), ("FT", "HUF"), ("DIN", "RSD"),
    ("Q", "GTQ"), ("RP", "IDR"), ("PENS", "PEN"), ("LEKE", "ALL"),
    ("KR", None), ("¥", None), ("L", None),
]
PRODUCT_SYMBOL_FALLBACK = [("KR", "SEK"), ("¥", "JPY"), ("￥", "JPY"), ("L", "UNKNOWN")]
PRODUCT_UNKNOWN = "UNKNOWN"
# Characters removed from a product price format before the symbol is read.
PRODUCT_FORMAT_STRIP = r"[\d,\.\s'/]"
# ---------------------------------------------------------------------------------


def sql_str(v) -> str:
    """A SQL string literal (or NULL)."""
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(pairs) -> Column:
    """A map literal, built by the SQL parser in one call."""
    return F.expr("map(" + ", ".join(f"{sql_str(k)}, {sql_str(v)}" for k, v in pairs) + ")")


def _lookup(key: Column, pairs) -> Column:
    """Literal-map lookup: one reference to ``key`` (a CASE would repeat it per arm),
    null for a missing or null key."""
    return F.try_element_at(literal_map(pairs), key)


def cart_currency_from_symbol(symbol) -> Column:
    """ISO code for a cart currency symbol (trimmed), null when unknown."""
    return _lookup(unicode_trim(_col(symbol)), CART_SYMBOL_TO_CODE)


def product_raw_symbol(min_price_format) -> Column:
    return unicode_trim(F.upper(F.regexp_replace(_col(min_price_format), PRODUCT_FORMAT_STRIP, "")))


# The first map's null arms, settled by the fallback rule (a fallback arm for a symbol
# the first map sends to UNKNOWN can never fire).
_NULL_ARMS = {k for k, v in PRODUCT_SYMBOL_TO_CODE if v is None}


def product_currency_of_symbol(sym) -> Column:
    """ISO code for an already extracted product symbol (see ``product_raw_symbol``)."""
    sym = _col(sym)
    mapped = [(k, v) for k, v in PRODUCT_SYMBOL_TO_CODE if v is not None]
    settled = [(k, v) for k, v in PRODUCT_SYMBOL_FALLBACK if k in _NULL_ARMS]
    return F.coalesce(_lookup(sym, mapped), _lookup(sym, settled), F.lit(PRODUCT_UNKNOWN))


def product_currency(min_price_format) -> Column:
    """ISO code for a product from its formatted minimum price; UNKNOWN when no rule fits."""
    return product_currency_of_symbol(product_raw_symbol(min_price_format))
