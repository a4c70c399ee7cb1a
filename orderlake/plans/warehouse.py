"""Warehouse models (M9, M10): the four dimensions and the fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.keys import surrogate_key
from orderlake.functions.money import times
from orderlake.operators.skew import HotKeys, salted_left_join
from orderlake.operators.totals import own_shuffle, with_group_total

PRODUCT_DIM_COLUMNS = ["product_key", "product_id", "product_name", "category_id", "category_name",
                       "unit_price_usd", "min_price_usd", "max_price_usd"]


def dim_customer(int_customer: DataFrame) -> DataFrame:
    return int_customer


def dim_date(int_date: DataFrame) -> DataFrame:
    return int_date


def dim_location(int_location: DataFrame) -> DataFrame:
    """Place grain: the IP is dropped, then distinct."""
    return int_location.select("location_key", "country_name", "region_name", "city_name").distinct()


def dim_product(int_product: DataFrame) -> DataFrame:
    return int_product.select(*PRODUCT_DIM_COLUMNS)


# Columns of the fact whose hot keys can be split, and those its rows are dealt by.
HOT_COLUMNS = ["order_id", "product_id", "ip_address"]
SPREAD = ["fact_sales_order_key", "order_id", "product_id", "user_id", "order_timestamp", "ip_address"]


def _keyed_join(f: DataFrame, side: DataFrame, key: str, side_key: str, hot: HotKeys | None,
                spread: list[str]) -> DataFrame:
    """LEFT JOIN on the text of ``key``; ``side`` holds a key once."""
    if hot is not None:
        return salted_left_join(f, side, F.col(key), F.col(side_key), hot, spread).drop(side_key)
    return f.join(side, f[key].cast("string") == side[side_key], "left").drop(side_key)


def fact_sales_order(int_fact: DataFrame, dim_product_df: DataFrame | None, int_location: DataFrame | None,
                     dim_customer_df: DataFrame | None = None, dim_date_df: DataFrame | None = None,
                     dedup_location_ip: bool = True, with_order_total: bool = True,
                     hot: dict[str, HotKeys] | None = None, fact_key: Column | None = None) -> DataFrame:
    """One row per product per order with the four dimension keys (-1 when
    missing), the line total and the order total. Without a product dimension, a
    location table or ``with_order_total`` that column, and the join for it, is left
    out: a measure that reads only some columns passes only what it needs.

    Plan choices:
    * Customer and date dimensions are built from this same fact, so every non-null
      ``user_id`` / date has its row and its key is the hash of that value. When the
      dimensions are not passed, the key is computed from the value, which equals the
      left join + COALESCE(-1) without shuffling the fact twice.
    * The product and location sides are unique per key and joined on the key's text:
      each side then has a shuffle of its own, which lets AQE split a hot product or IP
      (or broadcast a side measured small). With ``hot`` (measured on the written fact,
      for ``HOT_COLUMNS``) hot keys are salted instead, and so are the order totals.
    * The IP-grain location table grows with the traffic. With
      ``dedup_location_ip`` one place per IP (the smallest key) is kept first, so an
      IP with two places cannot duplicate fact rows (the reference would fan out).
    * Keys that are hashes of values the rows hold anyway are computed after the joins: eight
      random bytes do not compress, and the joins would shuffle them with every row. With
      ``fact_key`` (the expression of the fact's key) that goes for the fact's key, too.
    * The order total is an aggregate joined back, not a window: partial aggregation
      before the shuffle, and AQE's skew split on the join, keep an order holding a
      large share of all lines from landing in one task.
    """
    of = hot or {}
    f = int_fact.withColumn("line_total_price", times(F.col("item_price_usd"), F.col("order_qty")))
    if fact_key is not None:
        f = f.drop("fact_sales_order_key")
    spread = [c for c in SPREAD if c in f.columns]
    # With one place per IP the joins below keep one row per fact line, so the order
    # total (W4) is computed from the fact columns alone, before the dimension joins.
    if with_order_total and (dedup_location_ip or int_location is None):
        f = with_group_total(f, "order_id", "line_total_price", "order_total_amount", of.get("order_id"), spread)

    if dim_product_df is not None:
        p = (dim_product_df.groupBy("product_id").agg(F.min("product_key").alias("product_key"))
             .select(own_shuffle(F.col("product_id").cast("string")).alias("__p_id"), "product_key"))
        f = _keyed_join(f, p, "product_id", "__p_id", of.get("product_id"), spread) \
            .withColumn("product_key", F.coalesce("product_key", F.lit(-1).cast("bigint")))

    if int_location is not None:
        loc = int_location.select("ip_address", "location_key")
        if dedup_location_ip:  # one place per IP (the smallest key)
            loc = loc.groupBy("ip_address").agg(F.min("location_key").alias("location_key"))
        loc = loc.select(own_shuffle("ip_address").alias("__l_ip"), "location_key")
        f = _keyed_join(f, loc, "ip_address", "__l_ip", of.get("ip_address") if dedup_location_ip else None, spread) \
            .withColumn("location_key", F.coalesce("location_key", F.lit(-1).cast("bigint")))
        if with_order_total and not dedup_location_ip:  # an IP may have several places: total over the fanned-out rows
            f = with_group_total(f, "order_id", "line_total_price", "order_total_amount")
    # keys of values: after the joins above
    if fact_key is not None:
        f = f.withColumn("fact_sales_order_key", fact_key)
    if dim_customer_df is None:
        f = f.withColumn("customer_key", F.coalesce(surrogate_key("user_id"), F.lit(-1).cast("bigint")))
    else:
        c = dim_customer_df.select(F.col("user_id").alias("__c_user"), F.col("customer_key"))
        f = f.join(c, f.user_id == c.__c_user, "left").drop("__c_user") \
             .withColumn("customer_key", F.coalesce("customer_key", F.lit(-1).cast("bigint")))
    if dim_date_df is None:
        f = f.withColumn("date_key", F.coalesce(surrogate_key(F.col("order_local_time").cast("string")),
                                                F.lit(-1).cast("bigint")))
    else:
        d = dim_date_df.select(F.col("full_date").alias("__d_date"), F.col("date_key"))
        f = f.join(d, f.order_local_time == d.__d_date, "left").drop("__d_date") \
             .withColumn("date_key", F.coalesce("date_key", F.lit(-1).cast("bigint")))

    columns = ["fact_sales_order_key", "order_id", "product_key", "customer_key", "location_key", "date_key", "store_id",
               "order_local_time", "order_timestamp", "currency_code", "item_price_status", "order_qty",
               "line_total_price", "order_total_amount"]
    return f.select(*[c for c in columns if c in f.columns])
