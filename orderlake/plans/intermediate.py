"""Intermediate models (M4-M8): surrogate keys and default members."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.dates import date_attributes
from orderlake.functions.keys import surrogate_key
from orderlake.operators.currency import to_usd
from orderlake.operators.dedup import keep_first
from orderlake.operators.defaults import with_default_row

UNKNOWN = "Unknown"
CUSTOMER_COLUMNS = ["user_id", "device_id", "user_agent", "resolution", "email_address"]


def int_dim_customer(stg_fact: DataFrame) -> DataFrame:
    """M4: one row per user (W2), key = hash(user_id), plus the default member."""
    users = keep_first(stg_fact.select(*CUSTOMER_COLUMNS), ["user_id"])
    keyed = users.select(surrogate_key("user_id").alias("customer_key"), *CUSTOMER_COLUMNS)
    return with_default_row(keyed, {"customer_key": -1, **{c: UNKNOWN for c in CUSTOMER_COLUMNS}})


def int_dim_date(stg_fact: DataFrame) -> DataFrame:
    """M5: observed order dates (not a full calendar) with calendar attributes."""
    dates = stg_fact.select(F.col("order_local_time").alias("full_date")).distinct()
    attrs = date_attributes("full_date")
    keyed = dates.select(surrogate_key(F.col("full_date").cast("string")).alias("date_key"), "full_date",
                         *[v.alias(k) for k, v in attrs.items()])
    return with_default_row(keyed, {"date_key": -1, "full_date": None, "day": -1, "month": -1, "quarter": -1,
                                    "year": -1, "day_name": UNKNOWN, "month_name": UNKNOWN, "is_weekend": False})


def int_dim_location(stg_location: DataFrame) -> DataFrame:
    """M6: IP-grain locations keyed by the place (country, region, city)."""
    keyed = stg_location.select(
        surrogate_key("country_name", "region_name", "city_name").alias("location_key"),
        "country_name", "region_name", "city_name", "ip_address",
    ).distinct()
    return with_default_row(keyed, {"location_key": -1, "country_name": UNKNOWN, "region_name": UNKNOWN,
                                    "city_name": UNKNOWN, "ip_address": UNKNOWN})


def int_dim_product(stg_product: DataFrame, rates: DataFrame) -> DataFrame:
    """M7: product key, USD prices via the seed, plus the default member."""
    keyed = stg_product.select(
        surrogate_key("product_id").alias("product_key"), "product_id", "product_name", "category_id",
        "category_name", "unit_price", "min_price", "max_price", "currency_code",
    )
    priced = to_usd(keyed, rates, {"unit_price_usd": "unit_price", "min_price_usd": "min_price",
                                   "max_price_usd": "max_price"})
    zero = Decimal("0.00")
    return with_default_row(priced, {
        "product_key": -1, "product_id": -1, "product_name": UNKNOWN, "category_id": -1, "category_name": UNKNOWN,
        "unit_price": zero, "min_price": zero, "max_price": zero, "currency_code": UNKNOWN,
        "unit_price_usd": zero, "min_price_usd": zero, "max_price_usd": zero,
    })


def fact_key() -> Column:
    """hash(order_id, product_id)."""
    return surrogate_key("order_id", "product_id")


def int_fact_sales_order(stg_fact: DataFrame) -> DataFrame:
    """M8: the staging fact with its key."""
    return stg_fact.select(fact_key().alias("fact_sales_order_key"), "*")
