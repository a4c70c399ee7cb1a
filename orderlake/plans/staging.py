"""Staging models (M1-M3): rename, unnest, dedup, clean prices, resolve currency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.currency import cart_currency_from_symbol, product_currency_of_symbol, product_raw_symbol
from orderlake.functions.dates import parse_local_date
from orderlake.functions.price import price_priority, safe_decimal, safe_int, with_parsed_price
from orderlake.functions.text import nullif_blank, url_domain
from orderlake.operators.currency import resolve_currency, to_usd
from orderlake.operators.dedup import keep_first

CHECKOUT = "checkout_success"


def stg_dim_location(ip_locations: DataFrame) -> DataFrame:
    """M1: ip, country, region, city renamed; distinct rows."""
    return ip_locations.select(
        F.col("ip").alias("ip_address"), F.col("country").alias("country_name"),
        F.col("region").alias("region_name"), F.col("city").alias("city_name"),
    ).distinct()


def product_rename(product_info: DataFrame) -> DataFrame:
    """P2 + F1 + F2 + C11: typed product columns."""
    return product_info.select(
        safe_int("product_id").alias("product_id"),
        F.col("name").alias("product_name"),
        safe_int("category").alias("category_id"),
        F.coalesce(nullif_blank("category_name"), F.lit("Unknown")).alias("category_name"),
        safe_decimal("price").alias("unit_price"),
        safe_decimal("min_price").alias("min_price"),
        safe_decimal("max_price").alias("max_price"),
        F.col("qty").alias("product_qty"),
        F.col("min_price_format"),
    )


def stg_dim_product(product_info: DataFrame) -> DataFrame:
    """M2: one row per product id (W1), currency from the formatted price."""
    dedup = keep_first(product_rename(product_info), ["product_id"])
    with_sym = dedup.withColumn("raw_symbol", product_raw_symbol("min_price_format"))
    return with_sym.withColumn("currency_code", product_currency_of_symbol("raw_symbol"))


def cart_lines(raw_events: DataFrame, strict_dates: bool = True) -> DataFrame:
    """One row per cart item of each checkout event.
    Events with an empty or null cart produce no row (``explode``, not ``explode_outer``)."""
    ev = raw_events.filter(F.col("collection") == CHECKOUT).select(
        F.col("ip").alias("ip_address"),
        "user_agent",
        "resolution",
        F.coalesce(nullif_blank("user_id_db"), F.concat(F.lit("guest_"), F.col("device_id"))).alias("user_id"),
        "device_id",
        "store_id",
        "order_id",
        F.coalesce(nullif_blank("email_address"), F.lit("Unknown")).alias("email_address"),
        F.explode("cart_products").alias("cp"),
        url_domain("current_url").alias("domain"),
        parse_local_date("local_time", strict_dates).alias("order_local_time"),
        F.col("time_stamp").alias("order_timestamp"),
    )
    return ev.select(
        "ip_address", "user_agent", "resolution", "user_id", "device_id", "store_id", "order_id", "email_address",
        safe_int(F.col("cp.product_id")).alias("product_id"),
        F.col("cp.amount").alias("order_qty"),
        F.col("cp.price").alias("item_price_raw"),
        F.col("cp.currency").alias("currency_code_raw"),
        "domain", "order_local_time", "order_timestamp",
    )


def dedup_order_items(lines: DataFrame) -> DataFrame:
    """One line per (order, product), a usable price preferred; remaining ties are
    broken by every other column."""
    return keep_first(lines, ["order_id", "product_id"], order=[price_priority("item_price_raw").asc()],
                      tie_breakers=[c for c in lines.columns if c not in ("order_id", "product_id")])


def clean_prices(lines: DataFrame) -> DataFrame:
    """C1 + C5."""
    return with_parsed_price(lines, "item_price_raw", "item_price", "item_price_status")


def stg_fact_sales_order(raw_events: DataFrame, rates: DataFrame, strict_dates: bool = True) -> DataFrame:
    """M3: unnest carts, dedup, parse prices, resolve currency (symbol -> domain -> USD),
    convert to USD."""
    lines = clean_prices(dedup_order_items(cart_lines(raw_events, strict_dates)))
    lines = lines.withColumn("currency_code_from_symbol", cart_currency_from_symbol("currency_code_raw"))
    lines = resolve_currency(lines, rates)
    return to_usd(lines, rates, {"item_price_usd": "item_price"})
