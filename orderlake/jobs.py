"""Job entry points (``python -m orderlake <job>`` or ``spark-submit``):

* ``ingest``  exactly-once load of newly landed raw-event files into the raw table;
* ``feeds``   the same for raw events, product records and IP locations on one stream,
              into published tables that several ingests may load at once;
* ``extract`` the collection chain over a raw events table: IP geolocation (ip
              locations JSON lines, with counters), urls per product (JSON lines),
              product records from fetched pages plus the ids without a usable page;
* ``build``   staging -> intermediate -> warehouse tables, then the 27 declared
              data-quality checks (exit status 1 when any check fails).
"""

from __future__ import annotations

import argparse
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from orderlake.operators import quality as Q
from orderlake.plans import extract as X
from orderlake.plans.build import build_warehouse
from orderlake.schemas import PRODUCT_INFO, RAW_EVENT, RAW_EVENT_TEXT
from orderlake.operators.currency import check_rates
from orderlake.session import apply_session_conf
from orderlake.sources import readers as R
from orderlake.sources import sinks as K
from orderlake.sources.seed import DEFAULT_SHOP_HOST, exchange_rates
from orderlake.streaming.feeds import feed_counters, ingest_feeds, read_feed, read_outcomes
from orderlake.streaming.ingest import ingest_files, job_counters, read_report

# The declared warehouse tests (27 checks over the four dimensions and the fact).
UNIQUE_TESTS = {
    "dim_product": ["product_key", "product_id"],
    "dim_customer": ["customer_key", "user_id"],
    "dim_date": ["date_key", "full_date"],
    "dim_location": ["location_key"],
    "fact_sales_order": ["fact_sales_order_key"],
}
NOT_NULL_TESTS = {
    "dim_product": ["product_key", "product_id"],
    "dim_customer": ["customer_key", "user_id"],
    "dim_date": ["date_key", "is_weekend"],
    "dim_location": ["location_key"],
    "fact_sales_order": ["fact_sales_order_key", "product_key", "date_key", "customer_key", "location_key",
                         "order_id", "order_qty"],
}
ACCEPTED_VALUES_TESTS = {"dim_date": {"is_weekend": [True, False]}}
RELATIONSHIP_TESTS = {"product_key": "dim_product", "date_key": "dim_date", "customer_key": "dim_customer",
                      "location_key": "dim_location"}


def run_checks(star: dict[str, DataFrame]) -> DataFrame:
    """All declared checks as one small table (check_type, check_name, failures)."""
    from pyspark.sql import functions as F
    parts = []
    for t, cols in UNIQUE_TESTS.items():
        parts.append(Q.unique_summary(star[t], t, cols).withColumn("check_type", F.lit("unique")))
    for t, cols in NOT_NULL_TESTS.items():
        parts.append(Q.not_null_summary(star[t], t, cols).withColumn("check_type", F.lit("not_null")))
    for t, rules in ACCEPTED_VALUES_TESTS.items():
        parts.append(Q.accepted_values_summary(star[t], t, rules).withColumn("check_type", F.lit("accepted_values")))
    rel = Q.relationships_summary(star["fact_sales_order"], "fact_sales_order",
                                  {c: (star[t], c) for c, t in RELATIONSHIP_TESTS.items()})
    parts.append(rel.withColumn("check_type", F.lit("relationships")))
    return reduce(DataFrame.unionByName, parts).select("check_type", "check_name", "failures")


def build(spark: SparkSession, args) -> int:
    rates = check_rates(R.read_seed(spark, args.rates)) if args.rates else exchange_rates(spark, shop_host=args.shop_host)
    if args.feeds:
        raw, products = (read_feed(spark, args.feeds, name, record).drop("_file_name")
                         for name, record in (("raw_events", RAW_EVENT), ("product_info", PRODUCT_INFO)))
    else:
        raw, products = spark.read.parquet(args.raw), R.read_product_info(spark, args.products)
    star = build_warehouse(
        raw_events=raw,
        product_info=products,
        ip_ranges=spark.read.parquet(args.ip_ranges),
        rates=rates,
        root=args.out,
    )
    failed = 0
    for r in run_checks(star).collect():  # 27 rows: one per declared check
        print(f"{r.check_type:16s} {r.check_name:45s} {'PASS' if r.failures == 0 else 'FAIL'} {r.failures}")
        failed += r.failures > 0
    return 1 if failed else 0


def extract(spark: SparkSession, args) -> int:
    from pyspark.sql import Observation
    out = args.out.rstrip("/")
    events = spark.read.parquet(args.events)
    counters = Observation("ip_lookup")
    K.write_jsonl(X.ip_locations(events, spark.read.parquet(args.ip_ranges), counters), f"{out}/ip_locations")
    print("ip lookup:", counters.get)
    K.write_jsonl(X.product_urls(events), f"{out}/urls")
    pairs = R.read_url_pairs(spark, f"{out}/urls")
    pages = spark.read.parquet(args.pages)
    X.collect_products(pairs, pages, f"{out}/product_info", f"{out}/failed_products",
                       pattern=args.pattern, shop_host=args.shop_host)
    return 0


def ingest(spark: SparkSession, args) -> int:
    root = args.root.rstrip("/")
    ingest_files(spark, args.landing, args.glob, RAW_EVENT_TEXT, target_path=f"{root}/raw_events",
                 ledger_path=f"{root}/load_tracking", report_path=f"{root}/load_report",
                 checkpoint_path=f"{root}/_checkpoint", transform=R.normalize_events)
    print(job_counters(read_report(spark, f"{root}/load_report")).first().asDict())
    return 0


def feeds(spark: SparkSession, args) -> int:
    root = args.root.rstrip("/")
    ingest_feeds(spark, args.landing, root, f"{root}/_checkpoint")
    for r in feed_counters(read_outcomes(spark, root)).orderBy("feed", "status").collect():  # one row a feed and outcome
        print(r.asDict())
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="orderlake")
    sub = p.add_subparsers(dest="job", required=True)
    b = sub.add_parser("build", help="build staging, intermediate and warehouse tables, then run the checks")
    b.add_argument("--feeds", default=None, help="root of the published feeds (instead of --raw and --products)")
    b.add_argument("--raw", default=None, help="raw events table (parquet, as written by ingest)")
    b.add_argument("--products", default=None, help="product records (JSON lines)")
    b.add_argument("--ip-ranges", required=True, help="IP ranges table (parquet: ip_from, ip_to, country, region, city)")
    b.add_argument("--rates", default=None, help="exchange-rate CSV with a header (default: the bundled seed)")
    b.add_argument("--shop-host", default=DEFAULT_SHOP_HOST, help="shop host name of the bundled seed's domains")
    b.add_argument("--out", required=True, help="root folder of the built layers (shared storage)")
    x = sub.add_parser("extract", help="ip locations, urls per product, product records from fetched pages")
    x.add_argument("--events", required=True, help="raw events table (parquet)")
    x.add_argument("--pages", required=True, help="fetched pages table (parquet: url, status, html)")
    x.add_argument("--ip-ranges", required=True, help="IP ranges table (parquet)")
    x.add_argument("--pattern", default=None, help="payload pattern in the page script (default: the shop's)")
    x.add_argument("--shop-host", default=DEFAULT_SHOP_HOST, help="host name of the fallback product url")
    x.add_argument("--out", required=True, help="output folder (shared storage)")
    i = sub.add_parser("ingest", help="load newly landed raw-event files exactly once")
    i.add_argument("--landing", required=True)
    i.add_argument("--glob", default="raw_events*.jsonl")
    i.add_argument("--root", required=True, help="folder of the raw table, ledger, report and checkpoint")
    f = sub.add_parser("feeds", help="load newly landed files of all three feeds exactly once")
    f.add_argument("--landing", required=True)
    f.add_argument("--root", required=True, help="folder of the published feeds and the checkpoint")
    args = p.parse_args(argv)
    if args.job == "build" and not args.feeds and not (args.raw and args.products):
        p.error("build needs --feeds, or --raw and --products")
    spark = SparkSession.builder.appName(f"orderlake-{args.job}").getOrCreate()
    apply_session_conf(spark)
    return {"build": build, "extract": extract, "ingest": ingest, "feeds": feeds}[args.job](spark, args)


if __name__ == "__main__":
    sys.exit(main())
