"""Extraction models: urls per product (M11), product records from fetched pages
(M12), and IP geolocation (M13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orderlake.functions.text import extract_script_payload
from orderlake.operators.prefix_join import address_key, prefix_join
from orderlake.operators.range_join import ipv4_to_long, range_join
from orderlake.sources.seed import DEFAULT_SHOP_HOST

# The event names that carry a product page, and the one event whose
# product page is its referrer rather than its current url.
PRODUCT_EVENTS = [
    "view_product_detail",
    "select_product_option",
    "select_product_option_quality",
    "add_to_cart_action",
    "product_detail_recommendation_visible",
    "product_detail_recommendation_noticed",
]
SPECIAL_EVENT = "product_view_all_recommend_clicked"


def product_url_pairs(events: DataFrame) -> DataFrame:
    """Distinct (product_id, url). The id is product_id, else
    viewing_product_id; the url is the referrer for the special event, else the current
    url; rows missing either are dropped. The filter reaches the scan."""
    e = events.filter(F.col("collection").isin(*PRODUCT_EVENTS, SPECIAL_EVENT))
    pairs = e.select(
        F.coalesce("product_id", "viewing_product_id").alias("product_id"),
        F.when(F.col("collection") == SPECIAL_EVENT, F.col("referrer_url")).otherwise(F.col("current_url")).alias("url"),
    )
    return pairs.filter(F.col("product_id").isNotNull() & F.col("url").isNotNull()).distinct()


def product_urls(events: DataFrame) -> DataFrame:
    """The JSONL hand-off, one record per distinct (product_id, url). The shape
    is the same at every size, and no list of a product's urls is gathered anywhere."""
    return product_url_pairs(events)


def url_counts(pairs: DataFrame) -> DataFrame:
    """How many products have a url, and how many urls there are."""
    return pairs.agg(F.count_distinct("product_id").alias("n_products"), F.count(F.lit(1)).alias("n_urls"))


def fallback_url_template(shop_host: str = DEFAULT_SHOP_HOST) -> str:
    return f"https://www.{shop_host}.com/catalog/product/view/id/%s"


# JSON values that count as "no data" (empty or false-like), as the crawler skipped them.
_FALSY_JSON = ["{}", "[]", "null", "false", "0", '""']


def page_payloads(pages: DataFrame, pattern: str | None = None) -> DataFrame:
    """(url, payload) for every fetched page whose script holds a usable JSON
    payload: the pattern matches, the text parses as JSON, and it is not empty/false."""
    payload = extract_script_payload("html") if pattern is None else extract_script_payload("html", pattern)
    p = pages
    if "status" in pages.columns:
        p = p.filter(F.col("status") == 200)
    p = p.select("url", payload.alias("payload"))
    ok = F.col("payload").isNotNull() & F.try_parse_json("payload").isNotNull() & \
        ~F.trim(F.col("payload")).isin(*_FALSY_JSON)
    return p.filter(ok)


def candidate_urls(pairs: DataFrame, shop_host: str = DEFAULT_SHOP_HOST) -> DataFrame:
    """Every url of a product (priority 0, in url order) and the fallback url
    (priority 1) built from the product id."""
    originals = pairs.select("product_id", "url", F.lit(0).alias("priority"))
    fallback = pairs.select("product_id").distinct().select(
        "product_id", F.format_string(fallback_url_template(shop_host), F.col("product_id")).alias("url"),
        F.lit(1).alias("priority"))
    return originals.unionByName(fallback)


def resolve_pages(pairs: DataFrame, pages: DataFrame, pattern: str | None = None,
                  shop_host: str = DEFAULT_SHOP_HOST) -> DataFrame:
    """Per product, the payload of the first candidate url with usable
    data (original urls in order, then the fallback). Candidates are joined to the
    fetched pages on the url (an equi-join), and the winner is ``min_by`` over
    (priority, url, payload) - an aggregate with map-side partial aggregation, so a
    product with very many urls never gathers them in one task."""
    cand = candidate_urls(pairs, shop_host)
    hits = cand.join(page_payloads(pages, pattern), "url", "inner")
    best = hits.groupBy("product_id").agg(
        F.min(F.struct("priority", "url", "payload")).alias("best"))
    return best.select("product_id", F.col("best.url").alias("url"), F.col("best.payload").alias("payload"))


def failed_products(pairs: DataFrame, resolved: DataFrame) -> DataFrame:
    """Products with no usable page."""
    return pairs.select("product_id").distinct().join(resolved.select("product_id"), "product_id", "left_anti")


def distinct_ips(raw_events: DataFrame) -> DataFrame:
    """A3: distinct IP values (null is a value too)."""
    return raw_events.select("ip").distinct()


def ip_locations(raw_events: DataFrame, ranges: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Distinct IPs -> (ip, country, region, city) by range lookup. Text that
    is no IPv4 address is counted as failed; a valid address outside every range is
    counted as not found. Counters go to ``observation`` (total, failed)."""
    ips = distinct_ips(raw_events).withColumn("ip_num", ipv4_to_long("ip"))
    if observation is not None:
        ips = ips.observe(observation, F.count(F.lit(1)).alias("total"),
                          F.count_if(F.col("ip_num").isNull()).alias("failed"))
    valid = ips.filter(F.col("ip_num").isNotNull())
    hit = range_join(valid, "ip_num", ranges.select("ip_from", "ip_to", "country", "region", "city"))
    return hit.select("ip", "country", "region", "city")


def address_locations(addresses: DataFrame, ranges: DataFrame, address: str = "address") -> DataFrame:
    """J10 for IPv4 and IPv6: ``addresses`` with the columns of every range (``addr_from`` and
    ``addr_to`` as text, ends included) that holds them; what is no address, or in no range,
    keeps nulls. Each distinct address is looked up once."""
    keyed = addresses.withColumn("__key", address_key(address))
    ends = ranges.withColumns({"key_from": address_key("addr_from"), "key_to": address_key("addr_to")})
    keys = keyed.select(F.col("__key").alias("__at")).filter("__at is not null").distinct()
    hits = prefix_join(keys, "__at", ends).drop("key_from", "key_to", "addr_from", "addr_to")
    return keyed.join(hits, keyed["__key"] == hits["__at"], "left").drop("__key", "__at")


def collect_products(pairs: DataFrame, pages: DataFrame, records_path: str, failed_path: str,
                     pattern: str | None = None, shop_host: str = DEFAULT_SHOP_HOST) -> DataFrame:
    """Product records from fetched pages, written as JSON lines (K2), and the ids
    of products without a usable page, one per line (K3). A record is the product id,
    the winning url and the page data: every field of an object payload becomes a field of
    the record, known or not and whatever its type (the outer product id is kept); the
    payload itself stays as JSON text."""
    from orderlake.sources.sinks import write_text_lines
    resolved = resolve_pages(pairs, pages, pattern, shop_host)
    records = page_records(resolved)
    write_text_lines(records, "record", records_path)
    write_text_lines(failed_products(pairs, resolved), "product_id", failed_path)
    return records


def page_records(resolved: DataFrame, payload: str = "payload") -> DataFrame:
    """(product_id, record): the columns of ``resolved`` as one JSON object, with the
    fields of an object payload spread into it. The payload is parsed once, to variants that
    keep numbers, lists and objects as they are; fields named like a column are left out;
    null columns are too, while a payload's nulls stay. Payloads that are no object add nothing; a field named twice in a
    payload occurs twice in the record."""
    fields = F.from_json(payload, "map<string,variant>", {"mode": "PERMISSIVE"})
    others = F.map_filter(fields, lambda name, _: ~name.isin(*resolved.columns))
    spread = F.when(F.size(others) > 0, F.concat(F.lit(","), F.substr(F.to_json(others), F.lit(2)))).otherwise(F.lit("}"))
    own = F.to_json(F.struct(*resolved.columns))
    return resolved.select("product_id", F.concat(F.substr(own, F.lit(1), F.length(own) - 1), spread).alias("record"))


def ip_lookup_counters(raw_events: DataFrame, ranges: DataFrame) -> DataFrame:
    """I6 for M13: distinct IPs, and how many failed to parse, were located, or fell
    outside every range - one left range join, collapsed to one row per IP."""
    ips = distinct_ips(raw_events).withColumn("ip_num", ipv4_to_long("ip"))
    hits = range_join(ips, "ip_num", ranges.select("ip_from", "ip_to"), how="left")
    per_ip = hits.groupBy("ip").agg(F.max(F.col("ip_num").isNotNull()).alias("parsed"),
                                    F.max(F.col("ip_from").isNotNull()).alias("found"))
    return per_ip.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("parsed")).alias("failed"),
        F.count_if("found").alias("located"),
        F.count_if(F.col("parsed") & ~F.col("found")).alias("not_found"),
    )
