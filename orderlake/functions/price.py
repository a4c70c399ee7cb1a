"""Locale-tolerant price parsing (rule C1) and the price status flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.money import AMOUNT_TYPE
from orderlake.functions.text import _col, unicode_trim

# 29 integer and 9 fraction digits; a number past it is null, as for the safe cast of the model
PRICE_TYPE = AMOUNT_TYPE

# A number that both Spark and SQL engines cast the same way: ASCII digits only.
# (Spark alone would also accept Arabic-Indic digits.)
_ASCII_NUMBER = r"^[-+]?[0-9.]+([eE][-+]?[0-9]+)?$"
_ASCII_INT = r"^[-+]?[0-9]+$"


def safe_decimal(c, dtype: str = PRICE_TYPE) -> Column:
    """SAFE_CAST(x AS NUMERIC) on trimmed ASCII text; anything else is null."""
    s = unicode_trim(_col(c))
    return F.when(s.rlike(_ASCII_NUMBER), s.try_cast(dtype))


def safe_int(c) -> Column:
    """SAFE_CAST(x AS INT) for text: whole ASCII numbers only, as bigint."""
    s = unicode_trim(_col(c).cast("string"))
    return F.when(s.rlike(_ASCII_INT), s.try_cast("bigint"))


def normalize_price_text(t) -> Column:
    """Rules 1-4 of ``parse_price`` on already trimmed text."""
    t = _col(t)
    return (
        F.when(t.contains("٫"), F.replace(t, F.lit("٫"), F.lit(".")))
        .when(t.rlike(r"\d'\d"), F.replace(t, F.lit("'")))
        .when(t.rlike(r"\d,\d{2}$"), F.translate(t, ",.", "."))
        .otherwise(F.replace(t, F.lit(",")))
    )


def with_parsed_price(df: DataFrame, raw: str = "item_price_raw", out: str = "item_price",
                      status: str | None = "item_price_status") -> DataFrame:
    """``parse_price`` and ``item_price_status`` as staged projections: the trimmed and
    the normalised text are columns computed once per row (Catalyst keeps a projection
    whose costly result is used several times instead of inlining it)."""
    df = df.withColumn("__price_t", unicode_trim(raw))
    df = df.withColumn("__price_n", normalize_price_text("__price_t"))
    n = F.col("__price_n")
    df = df.withColumn("__price_v", F.when(n.rlike(_ASCII_NUMBER), n.try_cast(PRICE_TYPE)))
    v = F.col("__price_v")
    cols = {out: F.when(v != 0, v)}
    if status:
        cols[status] = F.when(F.col("__price_t").isin(*ZERO_PRICE_TEXTS), F.lit("zero_price")).otherwise(F.lit("valid"))
    return df.withColumns(cols).drop("__price_t", "__price_n", "__price_v")


def parse_price(raw) -> Column:
    """Raw price text to a decimal, first matching rule wins:

    1. contains the Arabic decimal separator U+066B: it becomes '.';
    2. digit-apostrophe-digit (Swiss grouping): apostrophes are dropped;
    3. ends in digit, comma, two digits (European decimal comma): dots are dropped,
       commas become '.';
    4. otherwise commas are dropped (thousands grouping).
    Then a safe cast; zero becomes null.
    """
    normalized = normalize_price_text(unicode_trim(_col(raw)))
    value = safe_decimal(normalized)
    return F.nullif(value, F.lit(0).cast(PRICE_TYPE))


# Trimmed raw prices that mark a zero-priced cart line.
ZERO_PRICE_TEXTS = ["0,00", "0.00", ""]


def item_price_status(raw) -> Column:
    """'zero_price' when the trimmed raw text is 0,00 / 0.00 / empty, else 'valid'.
    Null text is 'valid' (three-valued IN gives null, so the ELSE arm is taken)."""
    t = unicode_trim(_col(raw))
    return F.when(t.isin(*ZERO_PRICE_TEXTS), F.lit("zero_price")).otherwise(F.lit("valid"))


def price_priority(raw) -> Column:
    """0 for a usable price (non-zero, non-blank), else 1; null sorts with the 1s."""
    t = unicode_trim(_col(raw))
    return F.when(~t.isin("0,00", "0.00") & (t != ""), F.lit(0)).otherwise(F.lit(1))


def unread_price(raw, price) -> Column:
    """A price text that is neither blank nor a zero price and still gave no price: not a
    number, or wider than ``PRICE_TYPE``."""
    t = unicode_trim(_col(raw))
    value = F.when(t.rlike(r"^[-+]?0*[.,]?0*$"), F.lit(None)).otherwise(t)
    return value.isNotNull() & _col(price).isNull()
