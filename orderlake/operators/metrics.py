"""Report measures (A10): revenue, orders, items sold and unique customers, sliced
by a dimension attribute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.money import total


def sales_measures(fact: DataFrame, dim: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """``fact JOIN dim USING key GROUP BY attrs``. The distinct counts are planned as
    a two-level aggregation (by attribute and value first), so a hot attribute value
    is pre-aggregated before any shuffle."""
    d = dim.select(key, *attrs)
    j = fact.join(d, key, "left")
    return j.groupBy(*attrs).agg(
        total(F.col("line_total_price")).alias("revenue"),
        F.countDistinct("order_id").alias("orders"),
        F.sum("order_qty").alias("items_sold"),
        F.countDistinct("customer_key").alias("unique_customers"),
    )
