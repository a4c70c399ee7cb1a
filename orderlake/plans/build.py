"""Build the whole model graph as written tables (K10), layer by layer.

Warehouse tables, and every model with more than one consumer (the staging fact,
the IP-grain locations), are written once (Parquet, full rebuild) into
``<root>/<layer>/<name>`` and read back for their consumers; single-consumer staging
models stay views. Models that do not read each other are built at the same time, so
that the last tasks of one leave no core idle. This cuts the lineage at every
layer: a lost executor recomputes at most one layer from the previous layer's files,
and the staging fact, used by three models, is computed once. ``root`` must be a
folder every executor can reach - by default a fresh folder under the session's
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from orderlake.operators.skew import find_hot_keys
from orderlake.plans import extract as X
from orderlake.plans import intermediate as I
from orderlake.plans import staging as S
from orderlake.plans import warehouse as W
from orderlake.sources.sinks import materialize


def together(**jobs: Callable) -> dict:
    """The results of independent jobs, run at the same time (their tasks share the cores)."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


def build_warehouse(raw_events: DataFrame, product_info: DataFrame, ip_ranges: DataFrame, rates: DataFrame,
                    root: str) -> dict[str, DataFrame]:
    """raw events + product records + IP ranges + seed -> staging, intermediate and
    warehouse tables. Returns the warehouse tables (read from their files)."""
    def m(df, layer, name):
        return materialize(df, layer, name, root=root)

    ip_loc = X.ip_locations(raw_events, ip_ranges)  # one consumer: stays lazy
    # single-consumer staging models stay views (lazy), as in the reference
    stg_product = S.stg_dim_product(product_info)
    stg_location = S.stg_dim_location(ip_loc)
    int_product = I.int_dim_product(stg_product, rates)
    first = together(
        stg_fact=lambda: m(S.stg_fact_sales_order(raw_events, rates), "staging", "stg_fact_sales_order"),
        int_location=lambda: m(I.int_dim_location(stg_location), "intermediate", "int_dim_location"),
        dim_product=lambda: m(W.dim_product(int_product), "warehouse", "dim_product"))
    stg_fact, int_location, dim_product = first["stg_fact"], first["int_location"], first["dim_product"]

    def built_fact():
        # customer and date keys are derived from the values (both dimensions are built
        # from this same staging table), which saves a shuffle of the fact on user_id
        hot = find_hot_keys(stg_fact, W.HOT_COLUMNS)  # two narrow passes over the written table
        int_fact = I.int_fact_sales_order(stg_fact)
        return m(W.fact_sales_order(int_fact, dim_product, int_location, hot=hot, fact_key=I.fact_key()),
                 "warehouse", "fact_sales_order")

    return {"dim_product": dim_product} | together(
        fact_sales_order=built_fact,
        dim_customer=lambda: m(W.dim_customer(I.int_dim_customer(stg_fact)), "warehouse", "dim_customer"),
        dim_date=lambda: m(W.dim_date(I.int_dim_date(stg_fact)), "warehouse", "dim_date"),
        dim_location=lambda: m(W.dim_location(int_location), "warehouse", "dim_location"))
