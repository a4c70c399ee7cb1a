"""Currency resolution (C7, J1) and USD conversion.

The seed has about 70 rows and is unique by code and by domain, so Spark plans both
lookups as broadcast joins from its known size: no shuffle, no fan-out, the fact side
keeps its partitioning. No hint is given: a larger rates table is joined as its size
demands, and ``check_rates`` refuses one that is not unique."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.money import convert



def check_rates(rates: DataFrame) -> DataFrame:
    """The rates, after a check that no code and no domain occurs twice (a doubled one
    would multiply fact rows)."""
    for c in ("currency_code", "domain"):
        twice = rates.filter(F.col(c).isNotNull()).groupBy(c).count().filter("count > 1")
        if not twice.isEmpty():
            raise ValueError(f"exchange rates: {c} is not unique")
    return rates


def resolve_currency(df: DataFrame, rates: DataFrame, symbol_code: str = "currency_code_from_symbol",
                     domain: str = "domain") -> DataFrame:
    """currency_code = symbol code, else the shop domain's currency, else USD;
    currency_source tells which rule applied."""
    by_domain = rates.select(F.col("domain").alias("__rate_domain"),
                                               F.col("currency_code").alias("__domain_code"))
    j = df.join(by_domain, df[domain] == by_domain["__rate_domain"], "left")
    sym = F.col(symbol_code)
    return (j.withColumn("currency_code", F.coalesce(sym, F.col("__domain_code"), F.lit("USD")))
             .withColumn("currency_source",
                         F.when(sym.isNotNull(), F.lit("from_symbol"))
                          .when(F.col("__domain_code").isNotNull(), F.lit("from_domain"))
                          .otherwise(F.lit("default_usd")))
             .drop(symbol_code, "__rate_domain", "__domain_code"))


def to_usd(df: DataFrame, rates: DataFrame, amounts: dict[str, str], code: str = "currency_code") -> DataFrame:
    """For each ``{out: amount}``: ROUND(amount * rate_to_usd, 2), exact at any width; a
    code without a seed row gives null."""
    r = rates.select(F.col("currency_code").alias("__rate_code"), F.col("rate_to_usd").alias("__rate"))
    j = df.join(r, df[code] == r["__rate_code"], "left")
    for out, amount in amounts.items():
        j = j.withColumn(out, convert(F.col(amount), F.col("__rate")))
    return j.drop("__rate_code", "__rate")
