"""The registered queries: one callable (spark, sf_dir) -> DataFrame per operator
family. Every query reads the driver tables (or data Spark derives from them) in
full; there are no row caps, id subsets or sampling. Outputs get the same edge casts
as the SQL oracle (``orderlake.oracle``): decimals -> double, dates -> text,
integers -> bigint."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions.currency import cart_currency_from_symbol, product_currency, product_raw_symbol
from orderlake.functions.json_shape import normalize_option_json
from orderlake.functions.keys import surrogate_key
from orderlake.functions.money import is_lost, times
from orderlake.functions.price import unread_price, with_parsed_price
from orderlake.functions.text import clean_string, extract_script_payload, nullif_blank, url_domain
from orderlake.operators import quality as Q
from orderlake.operators.currency import to_usd
from orderlake.operators.dedup import keep_first
from orderlake.operators.metrics import sales_measures
from orderlake.operators.skew import find_hot_keys, hot_key_table, salted_left_join
from orderlake.operators.totals import with_group_total
from orderlake.plans import extract as X
from orderlake.plans import intermediate as I
from orderlake.plans import staging as S
from orderlake.plans import warehouse as W
from orderlake.sources import adapters as A
from orderlake.sources.adapters import PAYLOAD_PATTERN, TRACK_PATTERN
from orderlake.sources.seed import exchange_rates
from orderlake.session import apply_session_conf

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def edge(df: DataFrame) -> DataFrame:
    """Edge casts shared with the oracle."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


class Inputs:
    """Lazy access to the driver tables and the derived raw layer for one sf folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        apply_session_conf(spark)
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._memo: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        # one relation per table: identical sub-plans over it can then share their
        # shuffle output (ReusedExchange) instead of being recomputed
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._tables[name]

    def rates(self) -> DataFrame:
        return exchange_rates(self.spark)

    def raw_events(self) -> DataFrame:
        if "raw" not in self._memo:
            self._memo["raw"] = A.checkout_events(self.table("lineitem"), self.table("orders"))
        return self._memo["raw"]

    def product_info(self) -> DataFrame:
        return A.product_records(self.table("part"))

    def ranges(self) -> DataFrame:
        return A.ip_ranges(self.table("nation"), self.table("region"))

    def behaviour(self) -> DataFrame:
        return A.behaviour_events(self.table("events"), self.table("pages"))

    # -- models --
    def stg_fact(self) -> DataFrame:
        return S.stg_fact_sales_order(self.raw_events(), self.rates())

    def int_fact(self) -> DataFrame:
        return I.int_fact_sales_order(self.stg_fact())

    def stg_product(self) -> DataFrame:
        return S.stg_dim_product(self.product_info())

    def int_product(self) -> DataFrame:
        return I.int_dim_product(self.stg_product(), self.rates())

    def ip_locations(self, observation=None) -> DataFrame:
        return X.ip_locations(self.raw_events(), self.ranges(), observation)

    def stg_location(self) -> DataFrame:
        return S.stg_dim_location(self.ip_locations())

    def int_location(self) -> DataFrame:
        return I.int_dim_location(self.stg_location())

    def star(self) -> dict[str, DataFrame]:
        stg = self.stg_fact()
        int_loc = self.int_location()
        dims = {
            "dim_customer": W.dim_customer(I.int_dim_customer(stg)),
            "dim_date": W.dim_date(I.int_dim_date(stg)),
            "dim_location": W.dim_location(int_loc),
            "dim_product": W.dim_product(self.int_product()),
        }
        fact = W.fact_sales_order(I.int_fact_sales_order(stg), dims["dim_product"], int_loc, fact_key=I.fact_key())
        return {"fact_sales_order": fact, **dims}

    def fact_by(self, dim: str) -> tuple[DataFrame, DataFrame]:
        """The fact with the key of one dimension, and that dimension; nothing else is built."""
        stg = self.stg_fact()
        int_loc = self.int_location() if dim == "dim_location" else None
        product = W.dim_product(self.int_product()) if dim == "dim_product" else None
        fact = W.fact_sales_order(I.int_fact_sales_order(stg), product, int_loc, with_order_total=False,
                                  fact_key=I.fact_key())
        if dim == "dim_location":
            return fact, W.dim_location(int_loc)
        return fact, product if dim == "dim_product" else W.dim_date(I.int_dim_date(stg))


def _q(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return edge(fn(Inputs(spark, sf_dir)))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# ---- cart, price and currency rules ------------------------------------------------

def cart_explode(i: Inputs):
    """One row per cart item of each checkout event."""
    return S.cart_lines(i.raw_events())


def parse_price_q(i: Inputs):
    """C1, C5, F2, F13, F14 over every cart line."""
    lines = S.cart_lines(i.raw_events())
    return with_parsed_price(lines.select("item_price_raw"))


def dedup_order_items(i: Inputs):
    """One line per (order, product), usable price first."""
    return S.dedup_order_items(S.cart_lines(i.raw_events()))


def currency_from_symbol(i: Inputs):
    """Symbol map."""
    lines = S.cart_lines(i.raw_events())
    return lines.select("currency_code_raw",
                        cart_currency_from_symbol("currency_code_raw").alias("currency_code_from_symbol"))


def currency_resolved(i: Inputs):
    """Symbol, then shop domain, then USD."""
    return i.stg_fact().select("order_id", "product_id", "domain", "currency_code_raw", "currency_code",
                               "currency_source")


def usd_conversion(i: Inputs):
    """USD price in decimal."""
    return i.stg_fact().select("order_id", "product_id", "item_price", "currency_code", "item_price_usd")


def _wide_lines(i: Inputs) -> DataFrame:
    lines = with_parsed_price(A.wide_prices(i.table("lineitem")), "price_raw", "price", None)
    lines = to_usd(lines, i.rates(), {"usd": "price"})
    return lines.withColumn("line_total", times(F.col("usd"), F.col("quantity")))


def wide_money(i: Inputs):
    """Prices of up to 29 integer digits parsed, converted, multiplied and
    added up per order without losing a digit; amounts as exact text."""
    lines = with_group_total(_wide_lines(i), "l_orderkey", "line_total", "order_total")
    text = [F.col(c).cast("string").alias(c) for c in ("price", "usd", "line_total", "order_total")]
    return lines.select("l_orderkey", "l_linenumber", "price_raw", "currency_code", "quantity", *text)


def money_losses(i: Inputs):
    """What money columns lose, by currency: price texts that gave no price, prices
    that gave no dollars, dollars that gave no line total."""
    usd, line = F.col("usd"), F.col("line_total")
    rated = i.rates().select(F.col("currency_code").alias("rated"), F.col("rate_to_usd").alias("rate"))
    lines = _wide_lines(i).join(rated, F.col("currency_code") == F.col("rated"), "left")
    return lines.groupBy("currency_code").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(unread_price("price_raw", "price")).alias("n_unread"),
        F.count_if(is_lost(F.col("rate"), F.col("price"))).alias("n_no_rate"),
        F.count_if(is_lost(usd, F.col("price"), F.col("rate"))).alias("n_lost_usd"),
        F.count_if(is_lost(line, usd, F.col("quantity"))).alias("n_lost_totals"))


def guest_identity(i: Inputs):
    """C10, C11, F5, F7, F9."""
    ev = i.raw_events().filter(F.col("collection") == S.CHECKOUT)
    return ev.select(
        "user_id_db", "device_id", F.col("email_address").alias("email_raw"),
        F.coalesce(nullif_blank("user_id_db"), F.concat(F.lit("guest_"), F.col("device_id"))).alias("user_id"),
        F.coalesce(nullif_blank("email_address"), F.lit("Unknown")).alias("email_address"),
    )


def stg_fact_sales_order(i: Inputs):
    """M3."""
    return i.stg_fact()


def int_fact_sales_order(i: Inputs):
    """M8, F10, F22."""
    return i.int_fact()


def surrogate_key_q(i: Inputs):
    """F22 with one part, two parts, and a null part (null key)."""
    o = i.table("orders")
    maybe_null = F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey"))
    return o.select("o_orderkey", surrogate_key("o_orderkey").alias("key_single"),
                    surrogate_key("o_orderkey", "o_orderstatus").alias("key_pair"),
                    surrogate_key(maybe_null, "o_orderstatus").alias("key_with_null"))


# ---- products ------------------------------------------------------------------------

def stg_dim_product(i: Inputs):
    """M2, W1, F1, F2, C8, C11."""
    return i.stg_product()


def dedup_products(i: Inputs):
    """One record per product id, chosen by a total order."""
    return keep_first(S.product_rename(i.product_info()), ["product_id"])


def dedup_customers(i: Inputs):
    """One row per user id over the staging fact's customer columns."""
    return keep_first(i.stg_fact().select(*I.CUSTOMER_COLUMNS), ["user_id"])


def product_currency_q(i: Inputs):
    """C8, F11, F12 on every product record (before dedup)."""
    p = i.product_info()
    return p.select("product_id", "min_price_format", product_raw_symbol("min_price_format").alias("raw_symbol"),
                    product_currency("min_price_format").alias("currency_code"))


def dim_product(i: Inputs):
    """M7, M9, J3, P14, A8, F4."""
    return W.dim_product(i.int_product())


# ---- locations -----------------------------------------------------------------------

def ip_range_join(i: Inputs):
    """Distinct IPs located by a bucketed range join."""
    return i.ip_locations()


def ip_lookup_counters(i: Inputs):
    """Total / failed / located / not-found counts of the IP lookup."""
    return X.ip_lookup_counters(i.raw_events(), i.ranges())


def address_locations(i: Inputs):
    """IPv4 and IPv6 addresses in every spelling located in ranges from one address to a
    quarter of a network, by prefixes; addresses without a place are kept."""
    return X.address_locations(A.mixed_addresses(i.table("orders")), A.address_ranges(i.table("nation")))


def stg_dim_location(i: Inputs):
    """M1."""
    return i.stg_location()


def dim_location(i: Inputs):
    """M6, M9, A6, A7."""
    return W.dim_location(i.int_location())


# ---- star ----------------------------------------------------------------------------

def dim_customer(i: Inputs):
    """M4, W2."""
    return W.dim_customer(I.int_dim_customer(i.stg_fact()))


def dim_date(i: Inputs):
    """M5, A5, F16-F19."""
    return W.dim_date(I.int_dim_date(i.stg_fact()))


def fact_sales_order(i: Inputs):
    """M10, J4-J7, J12, W4."""
    return i.star()["fact_sales_order"]


def order_total(i: Inputs):
    """Order total on every line (an aggregate joined back on the order id)."""
    s = i.stg_fact().select("order_id", "product_id",
                            times(F.col("item_price_usd"), F.col("order_qty")).alias("line_total_price"))
    return with_group_total(s, "order_id", "line_total_price", "order_total_amount")


HOT_SHARE = 0.05


def hot_keys(i: Inputs):
    """The keys that hold a twentieth of the lines or more, with exact counts."""
    return hot_key_table(A.skewed_lines(i.table("lineitem")), ["order_id", "part_id"], HOT_SHARE)


def salted_join(i: Inputs):
    """Every line's part name and order total, the hot order and part salted."""
    lines = A.skewed_lines(i.table("lineitem"))
    hot = find_hot_keys(lines, ["order_id", "part_id"], HOT_SHARE)
    spread = ["line_order", "line_number", "cents"]
    parts = i.table("part").select("p_partkey", "p_name")
    named = salted_left_join(lines, parts, F.col("part_id"), F.col("p_partkey"), hot["part_id"], spread).drop("p_partkey")
    return with_group_total(named, "order_id", "cents", "order_cents", hot["order_id"], spread)


def _metrics(dim: str, key: str, attrs: list[str]):
    def run(i: Inputs):
        fact, members = i.fact_by(dim)
        return sales_measures(fact, members, key, attrs)
    return run


metrics_by_month = _metrics("dim_date", "date_key", ["year", "month"])
metrics_by_country = _metrics("dim_location", "location_key", ["country_name"])
metrics_by_category = _metrics("dim_product", "product_key", ["category_name"])


from orderlake.jobs import NOT_NULL_TESTS, RELATIONSHIP_TESTS, UNIQUE_TESTS  # noqa: E402


def built_star(i: Inputs) -> dict[str, DataFrame]:
    """The star built as tables in the shared folder (``plans.build``), so the checks
    read the built tables instead of re-deriving them from the raw layer."""
    from orderlake.plans.build import build_warehouse
    from orderlake.session import scratch_path
    return build_warehouse(i.raw_events(), i.product_info(), i.ranges(), i.rates(), scratch_path(i.spark, "warehouse"))


def dq_unique(i: Inputs):
    """Q1 on every declared unique column, and on the raw product records, where every
    tenth product occurs twice."""
    s = built_star(i) | {"product_info": i.product_info()}
    tests = UNIQUE_TESTS | {"product_info": ["product_id"]}
    return reduce(DataFrame.unionByName, [Q.unique_summary(s[t], t, cols) for t, cols in tests.items()])


def unique_columns(i: Inputs):
    """Q1 with one shuffle a table: keys and repeated values of the given tables."""
    tests = {"orders": ["o_orderkey", "o_custkey", "o_orderdate"], "customer": ["c_custkey", "c_name", "c_nationkey"],
             "lineitem": ["l_orderkey", "l_partkey"], "part": ["p_partkey", "p_name"], "documents": ["doc_id", "text"]}
    return reduce(DataFrame.unionByName, [Q.unique_summary(i.table(t), t, cols) for t, cols in tests.items()])


def dq_not_null(i: Inputs):
    """Q2 on every declared not-null column: one aggregation pass per table."""
    s = built_star(i)
    return reduce(DataFrame.unionByName, [Q.not_null_summary(s[t], t, cols) for t, cols in NOT_NULL_TESTS.items()])


def dq_accepted_values(i: Inputs):
    """Q3: is_weekend in (true, false); and the order status, of which one value
    is outside the list."""
    dates = W.dim_date(I.int_dim_date(i.stg_fact()))
    return (Q.accepted_values_summary(dates, "dim_date", {"is_weekend": [True, False]})
            .unionByName(Q.accepted_values_summary(i.table("orders"), "orders", {"o_orderstatus": ["F", "O"]})))


def dq_relationships(i: Inputs):
    """Q4: every fact key has its dimension row; and the orders of customers in debt
    are orphans among the customers that are not."""
    s = built_star(i)
    solvent = i.table("customer").filter("c_acctbal >= 0")
    return Q.relationships_summary(s["fact_sales_order"], "fact_sales_order",
                                   {c: (s[t], c) for c, t in RELATIONSHIP_TESTS.items()}).unionByName(
        Q.relationships_summary(i.table("orders"), "orders", {"o_custkey": (solvent, "c_custkey")}))


# ---- text, json, pages ---------------------------------------------------------------

def url_domain_q(i: Inputs):
    """F15 over every page url."""
    return i.table("pages").select("page_id", "url", url_domain("url").alias("domain"))


def clean_string_q(i: Inputs):
    """F26 + F8 over every whole document text."""
    return i.table("documents").select("doc_id", clean_string("text").alias("text_clean"))


def script_extract(i: Inputs):
    """F27 with the pattern as a parameter: the tracking id in each page's script."""
    return i.table("pages").select("page_id", extract_script_payload("html", TRACK_PATTERN).alias("payload"))


def json_field(i: Inputs):
    """a field of the JSON props."""
    return i.table("events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


def option_normalize(i: Inputs):
    """Object / list-with-junk / null / scalar option fields, normalised to a list
    of option objects."""
    e = i.table("events")
    m = F.col("event_id") % 4
    text = (F.when(m == 0, F.col("props")).when(m == 1, F.concat(F.lit("["), F.col("props"), F.lit(", 7]")))
            .when(m == 2, F.lit(None).cast("string")).otherwise(F.lit("7")))
    opts = normalize_option_json(text, "struct<k:string>")
    return e.select("event_id", F.size(opts).cast("bigint").alias("n_options"),
                    F.get(opts, 0).getField("k").alias("first_k"))


def option_string_entries(i: Inputs):
    """A list whose first entry is a string that holds the text of an object; only the
    object entries count."""
    text = F.concat(F.lit('["'), F.replace("props", F.lit('"'), F.lit('\\"')), F.lit('", '), F.col("props"), F.lit(", null]"))
    opts = normalize_option_json(text, "struct<k:string>")
    return i.table("events").select("event_id", F.size(opts).cast("bigint").alias("n_options"),
                                    F.get(opts, 0).getField("k").alias("first_k"))


def product_url_pairs(i: Inputs):
    """Distinct (product, url) pairs from product events."""
    return X.product_url_pairs(i.behaviour())


def product_urls(i: Inputs):
    """The hand-off written as JSON lines and read back; per product the number
    of its urls, the first and the last."""
    from orderlake.session import scratch_path
    from orderlake.sources.readers import read_url_pairs
    from orderlake.sources.sinks import write_jsonl
    path = scratch_path(i.spark, "urls")
    write_jsonl(X.product_urls(i.behaviour()), path)
    return read_url_pairs(i.spark, path).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_urls"), F.min("url").alias("first_url"), F.max("url").alias("last_url"))


def product_url_counts(i: Inputs):
    """Products with a url, and urls."""
    return X.url_counts(X.product_url_pairs(i.behaviour()))


def _fetched(i: Inputs) -> DataFrame:
    return A.fetched_pages(i.table("pages"))


def _wanted(i: Inputs) -> DataFrame:
    """Pairs to collect; those of a few products are gone."""
    return A.gone_urls(X.product_url_pairs(i.behaviour()))


def resolve_pages(i: Inputs):
    """First usable fetched page per product."""
    return X.resolve_pages(_wanted(i), _fetched(i), PAYLOAD_PATTERN)


def failed_products(i: Inputs):
    """Products without a usable page."""
    pairs = _wanted(i)
    return X.failed_products(pairs, X.resolve_pages(pairs, _fetched(i), PAYLOAD_PATTERN))


def collect_products(i: Inputs):
    """Url records written as JSON lines and read back with the urls
    schema, pages resolved, product records (object payloads spread into their fields)
    and failed ids written; both are read back from their files."""
    from orderlake.session import scratch_path
    from orderlake.sources.readers import read_url_pairs
    from orderlake.sources.sinks import write_jsonl
    root = scratch_path(i.spark, "collect")
    write_jsonl(A.gone_urls(X.product_urls(i.behaviour())), f"{root}/urls")
    pairs = read_url_pairs(i.spark, f"{root}/urls")
    X.collect_products(pairs, _fetched(i), f"{root}/product_info", f"{root}/failed", PAYLOAD_PATTERN)
    fields = ["url", "payload", "sku", "qty", "name"]
    records = i.spark.read.schema(", ".join(f"{c} string" for c in ["product_id", *fields])).json(f"{root}/product_info")
    failed = i.spark.read.text(f"{root}/failed").select(
        F.col("value").alias("product_id"), *[F.lit(None).cast("string").alias(c) for c in fields])
    return records.withColumn("status", F.lit("found")).unionByName(failed.withColumn("status", F.lit("failed")))


def page_records(i: Inputs):
    """Every field of every collected record, known or not, as (name, text)."""
    from orderlake.session import scratch_path
    root = scratch_path(i.spark, "page-records")
    X.collect_products(_wanted(i), _fetched(i), f"{root}/product_info", f"{root}/failed", PAYLOAD_PATTERN)
    fields = F.from_json("value", "map<string,string>")
    return (i.spark.read.text(f"{root}/product_info")
            .select(F.get_json_object("value", "$.product_id").alias("product_id"), F.explode(fields).alias("field", "value")))


def product_export(i: Inputs):
    """Every kept product field as cleaned text."""
    from orderlake.plans.export import normalize_product
    return normalize_product(i.product_info())


# ---- files: sources, sinks, ingestion --------------------------------------------

def raw_event_lines(raw: DataFrame) -> DataFrame:
    """Raw events as JSON-lines text, with the messiness the normaliser must absorb:
    a one-item cart is written as a bare object on every other second, the rest as
    lists; null fields are left out of the line."""
    base = F.to_json(F.struct(*[c for c in raw.columns if c != "cart_products"]))
    single = (F.size("cart_products") == 1) & (F.col("time_stamp") % 2 == 0)
    cart = F.when(single, F.to_json(F.get(F.col("cart_products"), 0))).otherwise(F.to_json("cart_products"))
    line = F.concat(F.expr("substring({0}, 1, length({0}) - 1)".format("__base")), F.lit(',"cart_products":'),
                    F.col("__cart"), F.lit("}"))
    return raw.select(base.alias("__base"), cart.alias("__cart")).select(line.alias("value"))


def _write_raw_lines(i: Inputs, name: str) -> str:
    """The raw events' lines, written packed: as plain text they are over sixteen times the
    tables they are made from. Nothing reads the shuffle of the two tables again."""
    from orderlake.session import scratch_path, shuffles_removed
    from orderlake.sources.sinks import PACKED
    path = scratch_path(i.spark, name)
    with shuffles_removed(i.spark):
        raw_event_lines(i.raw_events()).write.mode("overwrite").options(**PACKED).text(path)
    return path


def jsonl_roundtrip(i: Inputs):
    """Raw events written as JSON lines (object-or-list carts), read back
    with the explicit schema and normalised, then unnested: equal to cart_explode."""
    from orderlake.sources.readers import read_raw_events
    path = _write_raw_lines(i, "raw-jsonl")
    return S.cart_lines(read_raw_events(i.spark, path))


def normalize_record_q(i: Inputs):
    """C3 (M14's event export): _id dropped, carts and options normalised, text cleaned."""
    from orderlake.plans.export import normalize_record
    from orderlake.schemas import RAW_EVENT_TEXT
    path = _write_raw_lines(i, "raw-normalize")
    ev = normalize_record(i.spark.read.schema(RAW_EVENT_TEXT).json(path))
    return ev.select("collection", "order_id", "user_id_db", "email_address", "device_id",
                     F.size("cart_products").alias("n_items"),
                     F.get(F.col("cart_products"), 0).getField("price").alias("first_price"))


def event_export(i: Inputs):
    """All 17 exported event fields, lists as their size and first entry."""
    from orderlake.plans.export import normalize_record
    from orderlake.schemas import RAW_EVENT_TEXT
    ev = normalize_record(i.spark.read.schema(RAW_EVENT_TEXT).json(_write_raw_lines(i, "raw-event-export")))
    first = F.get(F.col("cart_products"), 0)
    return ev.withColumns({"n_items": F.size("cart_products"), "first_product": first.getField("product_id"),
                           "first_amount": first.getField("amount"), "first_currency": first.getField("currency"),
                           "n_item_options": F.size(first.getField("option")),
                           "option": F.size("option")}).drop("cart_products")


def product_lines(products: DataFrame) -> DataFrame:
    """Product records as JSON-lines text with planted faults: the record of every
    eleventh part is cut in half (malformed JSON) and every seventeenth part adds a
    blank line."""
    line = F.to_json(F.struct(*products.columns))
    pk = F.col("product_id").cast("long")
    cut = F.when(F.col("__pk") % 11 == 0, F.expr("substring(__l, 1, length(__l) div 2)")).otherwise(F.col("__l"))
    lines = products.select(line.alias("__l"), pk.alias("__pk")).select(cut.alias("value"), "__pk")
    blanks = lines.filter(F.col("__pk") % 17 == 0).select(F.lit("").alias("value"))
    return lines.select("value").unionByName(blanks)


def corrupt_lines(i: Inputs):
    """Line-tolerant read; malformed lines are quarantined, blank lines skipped."""
    from orderlake.schemas import PRODUCT_INFO
    from orderlake.session import scratch_path
    from orderlake.sources.readers import read_jsonl_tolerant
    path = scratch_path(i.spark, "products-corrupt")
    product_lines(i.product_info()).write.mode("overwrite").text(path)
    good, bad = read_jsonl_tolerant(i.spark, path, PRODUCT_INFO)
    return (good.select("product_id", "name", F.lit("ok").alias("status"))
            .unionByName(bad.select(F.lit(None).cast("string").alias("product_id"),
                                    F.lit(None).cast("string").alias("name"), F.lit("rejected").alias("status"))))


def product_rejects(i: Inputs):
    """Product files of up to 500 part numbers each, blank and malformed lines
    among them, loaded into a table; each record, and each rejected line with the number of
    its file and its line."""
    from orderlake.plans.export import load_products
    from orderlake.session import scratch_path
    src, out = scratch_path(i.spark, "products-files"), scratch_path(i.spark, "products-loaded")
    products = i.product_info()
    pk = F.col("product_id").cast("long")
    line = F.to_json(F.struct(*products.columns))
    cut = F.when(pk % 11 == 0, F.substring(line, F.lit(1), (F.length(line) / 2).cast("int"))).otherwise(line)
    texts = F.when(pk % 17 == 0, F.array(F.lit(""), cut)).otherwise(F.array(cut))
    (products.select(F.floor(pk / 500).alias("file_no"), pk.alias("pk"), "name", F.posexplode(texts).alias("pos", "value"))
     .repartition("file_no").sortWithinPartitions("file_no", "pk", "name", "pos")
     .select("file_no", "value").write.partitionBy("file_no").text(src))
    loaded = load_products(i.spark, src, f"{out}/table", rejects=f"{out}/rejects")
    rejected = i.spark.read.parquet(f"{out}/rejects")
    none = F.lit(None)
    return loaded.select("product_id", "name", none.cast("long").alias("file_no"), none.cast("long").alias("line_no")).unionByName(
        rejected.select(F.regexp_extract("line", r'"product_id":"(\d+)"', 1).alias("product_id"), none.cast("string").alias("name"),
                        F.regexp_extract("file", r"file_no=(\d+)/", 1).cast("long").alias("file_no"), "line_no"))


def url_lists(i: Inputs):
    """Product and url list on many lines of many files; each product's last line."""
    from orderlake.session import scratch_path
    from orderlake.sources.readers import read_urls
    path = scratch_path(i.spark, "url-lists")
    (X.product_url_pairs(i.behaviour()).select((F.length("url") % 3).alias("part"), "url", "product_id", F.array("url").alias("urls"))
     .orderBy("part", F.desc("url"), "product_id").select("part", "product_id", "urls").write.partitionBy("part").json(path))
    return read_urls(i.spark, path).select("product_id", F.size("urls").alias("n_urls"), F.get("urls", F.lit(0)).alias("url"))


def table_load(i: Inputs):
    """Product records exported as JSON lines (every seventh part
    without its id), loaded into a table, records without an id dropped."""
    from orderlake.plans.export import load_products
    from orderlake.session import scratch_path
    from orderlake.sources.sinks import write_jsonl
    src = scratch_path(i.spark, "products-jsonl")
    products = i.product_info()
    products = products.withColumn("product_id", F.when(F.col("product_id").cast("long") % 7 != 0,
                                                        F.col("product_id")))
    write_jsonl(products, src)
    loaded = load_products(i.spark, src, scratch_path(i.spark, "products-table"))
    return loaded.select("product_id", "name", "sku", "min_price_format")


def export_datasets_q(i: Inputs):
    """The three hand-off datasets written; the counts read back from them."""
    from orderlake.plans.export import export_datasets
    from orderlake.schemas import RAW_EVENT_TEXT
    from orderlake.session import scratch_path
    raw_path = _write_raw_lines(i, "raw-export")
    root = scratch_path(i.spark, "export")
    export_datasets(i.ip_locations(), i.product_info(), i.spark.read.schema(RAW_EVENT_TEXT).json(raw_path), root)
    parts = []
    for name in ["ip_locations", "product_info", "product_info_clean", "raw_events"]:
        parts.append(i.spark.read.text(f"{root}/{name}").agg(F.count(F.lit(1)).alias("records"))
                     .select(F.lit(name).alias("dataset"), "records"))
    return reduce(DataFrame.unionByName, parts)


def export_content(i: Inputs):
    """M14, K4-K6, Q: the exported files read back and digested, both product copies and
    the raw export, which a second export of other events leaves as it was."""
    from orderlake.plans.export import export_datasets
    from orderlake.schemas import IP_LOCATION, PRODUCT_INFO, RAW_EVENT, RAW_EVENT_TEXT
    from orderlake.session import scratch_path
    from orderlake.sources.sinks import digest_columns
    raw = i.spark.read.schema(RAW_EVENT_TEXT).json(_write_raw_lines(i, "raw-content"))
    root = scratch_path(i.spark, "export")
    export_datasets(i.ip_locations(), i.product_info(), raw, root)
    export_datasets(i.ip_locations(), i.product_info(), raw.filter("order_id is null"), root)
    parts = []
    for name, schema in {"ip_locations": IP_LOCATION, "product_info": PRODUCT_INFO, "product_info_clean": PRODUCT_INFO,
                         "raw_events": RAW_EVENT}.items():
        back = i.spark.read.schema(schema).json(f"{root}/{name}")
        if name == "raw_events":
            back = back.select("collection", "time_stamp", "local_time", "ip", "user_agent", "resolution", "user_id_db",
                               "device_id", "email_address", "store_id", "order_id", "current_url",
                               F.size("cart_products").alias("n_items"))
        parts.append(back.agg(*digest_columns(back)).select(
            F.lit(name).alias("dataset"), "n_rows", F.col("hash_sum").cast("string").alias("hash_sum"), "hash_xor"))
    return reduce(DataFrame.unionByName, parts)


def ip_location_load(i: Inputs):
    """Located IPs loaded from JSON lines (with malformed ones among them)
    and from CSV, each read back by its source name."""
    from orderlake.plans.export import load_ip_locations
    from orderlake.session import scratch_path
    from orderlake.sources.readers import read_table
    src, out = scratch_path(i.spark, "ip-files"), scratch_path(i.spark, "ip-tables")
    located = i.ip_locations()
    line = F.to_json(F.struct(*located.columns))
    cut = located.filter(F.col("ip").endswith("7")).select(F.substring(line, 1, 9).alias("value"))
    located.select(line.alias("value")).unionByName(cut).write.text(f"{src}/json")
    located.write.option("header", True).csv(f"{src}/csv")
    parts = []
    for fmt in ("json", "csv"):
        load_ip_locations(i.spark, f"{src}/{fmt}", f"{out}/{fmt}", fmt)
        parts.append(read_table(i.spark, "ip_locations", {"ip_locations": f"{out}/{fmt}"}).withColumn("source", F.lit(fmt)))
    return parts[0].unionByName(parts[1])


def ingest_idempotent(i: Inputs):
    """Raw-event files land in a folder; the stream ingests them, runs
    again (nothing new), and once more from a lost checkpoint (the ledger skips every
    file). The loaded rows, unnested, equal cart_explode: each file exactly once."""
    from orderlake.schemas import RAW_EVENT_TEXT
    from orderlake.session import scratch_path
    from orderlake.sources.readers import normalize_events
    from orderlake.streaming.ingest import ingest_files, read_loaded
    landing, files = _write_raw_lines(i, "landing"), "part-*.txt.gz"
    work = scratch_path(i.spark, "ingest")
    kw = dict(target_path=f"{work}/raw_events", ledger_path=f"{work}/load_tracking",
              report_path=f"{work}/load_report", transform=normalize_events)
    ingest_files(i.spark, landing, files, RAW_EVENT_TEXT, checkpoint_path=f"{work}/ckpt-a", **kw)
    ingest_files(i.spark, landing, files, RAW_EVENT_TEXT, checkpoint_path=f"{work}/ckpt-a", **kw)
    ingest_files(i.spark, landing, files, RAW_EVENT_TEXT, checkpoint_path=f"{work}/ckpt-b", **kw)
    return S.cart_lines(read_loaded(i.spark, kw["target_path"]))


def _landed_feeds(i: Inputs) -> str:
    """A landing folder with the three feeds, and product files of malformed lines, all packed."""
    from orderlake.session import scratch_path, shuffles_removed
    from orderlake.sources.sinks import PACKED
    landing = scratch_path(i.spark, "feeds-landing")
    products = i.product_info()
    cut = F.to_json(F.struct(*products.columns))
    with shuffles_removed(i.spark):  # a landed file is read from here on, not what it was made from
        raw_event_lines(i.raw_events()).write.options(**PACKED).text(f"{landing}/raw_events")
        products.write.options(**PACKED).json(f"{landing}/product_info")
        i.ip_locations().write.options(**PACKED).json(f"{landing}/ip_locations")
        (products.filter(F.col("product_id").cast("long") % 11 == 0)
         .select(F.substring(cut, F.lit(1), (F.length(cut) / 2).cast("int")).alias("value"))
         .write.options(**PACKED).text(f"{landing}/product_info_cut"))
    return landing


def ingest_feeds_q(i: Inputs):
    """Three feeds on one stream, two ingests at once and a third from a lost
    checkpoint; per feed and outcome the rows loaded and the lines rejected."""
    from concurrent.futures import ThreadPoolExecutor

    from orderlake.session import scratch_path
    from orderlake.streaming.feeds import feed_counters, ingest_feeds, read_outcomes
    landing, root, work = _landed_feeds(i), scratch_path(i.spark, "feeds"), scratch_path(i.spark, "feeds-checkpoint")
    with ThreadPoolExecutor(2) as pool:
        for run in [pool.submit(ingest_feeds, i.spark, landing, root, f"{work}/{k}") for k in ("a", "b")]:
            run.result()
    ingest_feeds(i.spark, landing, root, f"{work}/c")
    return feed_counters(read_outcomes(i.spark, root)).drop("files")


def feed_rows(i: Inputs):
    """The records of the three feeds as loaded, one row each."""
    from orderlake.schemas import IP_LOCATION, PRODUCT_INFO, RAW_EVENT
    from orderlake.session import scratch_path
    from orderlake.streaming.feeds import ingest_feeds, read_feed
    root = scratch_path(i.spark, "feeds")
    ingest_feeds(i.spark, _landed_feeds(i), root, scratch_path(i.spark, "feeds-checkpoint"))
    feed = lambda name, record, key, *values: read_feed(i.spark, root, name, record).select(
        F.lit(name).alias("feed"), F.col(key).alias("key"), F.concat_ws("|", *values).alias("value"))
    first = F.get(F.col("cart_products"), 0)
    return (feed("raw_events", RAW_EVENT, "order_id", "ip", "local_time", F.size("cart_products").cast("string"), first.getField("price"))
            .unionByName(feed("product_info", PRODUCT_INFO, "product_id", "name", "sku", "price", "min_price_format"))
            .unionByName(feed("ip_locations", IP_LOCATION, "ip", "country", "region", "city")))


QUERIES: dict[str, Callable] = {
    "cart_explode": cart_explode,
    "parse_price": parse_price_q,
    "dedup_order_items": dedup_order_items,
    "currency_from_symbol": currency_from_symbol,
    "currency_resolved": currency_resolved,
    "usd_conversion": usd_conversion,
    "wide_money": wide_money,
    "money_losses": money_losses,
    "guest_identity": guest_identity,
    "stg_fact_sales_order": stg_fact_sales_order,
    "int_fact_sales_order": int_fact_sales_order,
    "surrogate_key": surrogate_key_q,
    "stg_dim_product": stg_dim_product,
    "product_currency": product_currency_q,
    "dedup_products": dedup_products,
    "dedup_customers": dedup_customers,
    "dim_product": dim_product,
    "ip_range_join": ip_range_join,
    "ip_lookup_counters": ip_lookup_counters,
    "address_locations": address_locations,
    "stg_dim_location": stg_dim_location,
    "dim_location": dim_location,
    "dim_customer": dim_customer,
    "dim_date": dim_date,
    "fact_sales_order": fact_sales_order,
    "order_total": order_total,
    "hot_keys": hot_keys,
    "salted_join": salted_join,
    "metrics_by_month": metrics_by_month,
    "metrics_by_country": metrics_by_country,
    "metrics_by_category": metrics_by_category,
    "dq_unique": dq_unique,
    "unique_columns": unique_columns,
    "dq_not_null": dq_not_null,
    "dq_accepted_values": dq_accepted_values,
    "dq_relationships": dq_relationships,
    "url_domain": url_domain_q,
    "clean_string": clean_string_q,
    "script_extract": script_extract,
    "json_field": json_field,
    "option_normalize": option_normalize,
    "product_url_pairs": product_url_pairs,
    "product_urls": product_urls,
    "product_url_counts": product_url_counts,
    "resolve_pages": resolve_pages,
    "failed_products": failed_products,
    "product_export": product_export,
    "collect_products": collect_products,
    "page_records": page_records,
    "jsonl_roundtrip": jsonl_roundtrip,
    "normalize_record": normalize_record_q,
    "event_export": event_export,
    "export_content": export_content,
    "ip_location_load": ip_location_load,
    "option_string_entries": option_string_entries,
    "corrupt_lines": corrupt_lines,
    "product_rejects": product_rejects,
    "url_lists": url_lists,
    "table_load": table_load,
    "export_datasets": export_datasets_q,
    "ingest_idempotent": ingest_idempotent,
    "ingest_feeds": ingest_feeds_q,
    "feed_rows": feed_rows,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _q(v) for k, v in QUERIES.items()}
