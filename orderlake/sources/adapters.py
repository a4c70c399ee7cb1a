"""Driver tables -> the reference's input shapes.

The driver data has no carts, price strings, IP addresses or currencies. These
adapters derive them from the TPC-H-style tables by integer arithmetic only, so a
SQL engine can repeat every value exactly (see ``orderlake.oracle``). All of them are
narrow projections plus at most one equi-join, so they scale with their inputs:

* ``checkout_events``  lineitem JOIN orders: one checkout event per line item, carrying
  a one- or two-item cart (a zero-priced copy precedes the real line on every fourth
  line number; line number 7 has an empty cart; pending orders are cart events).
* ``behaviour_events`` events LEFT JOIN pages (twice, on page id): product views and
  clicks with their page urls, for the product-url map.
* ``product_records``  part, plus a second version of every tenth part: catalogue
  records with 28 text fields and formatted prices in many locales.
* ``ip_ranges``        nation JOIN region: four city ranges inside each nation's block.
* ``fetched_pages``    pages with an HTTP status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions.currency import sql_str
from orderlake.schemas import CART_ITEM, OPTION, PRODUCT_FIELDS
from orderlake.sources.seed import DEFAULT_SHOP_HOST


def _pick(key: Column, values: list) -> Column:
    """values[key] for a non-negative integer key: an array literal indexed by key."""
    arr = F.expr("array(" + ", ".join(sql_str(v) for v in values) + ")")
    return F.try_element_at(arr, (key + 1).cast("int"))


def _div(x: Column, n: int) -> Column:
    """Exact integer division of a non-negative bigint (the numerator is made a
    multiple of n first, so the quotient is exact in double precision as well)."""
    return ((x - x % n) / n).cast("long")


def price_texts(cents: Column) -> dict[str, Column]:
    """Spellings of an amount given in cents (a non-negative bigint)."""
    whole = _div(cents, 100)
    frac = F.lpad((cents % 100).cast("string"), 2, "0")
    grouped = F.format_number(whole, 0)  # 1,234,567
    return {
        "whole": whole.cast("string"),
        "frac": frac,
        "plain": F.concat(whole.cast("string"), F.lit("."), frac),                           # 1234.56
        "eu": F.concat(F.translate(grouped, ",", "."), F.lit(","), frac),                   # 1.234,56
        "swiss": F.concat(F.translate(grouped, ",", "'"), F.lit("."), frac),                # 1'234.56
        "us": F.concat(grouped, F.lit("."), frac),                                          # 1,234.56
        "arabic_sep": F.concat(whole.cast("string"), F.lit("٫"), frac),                     # 1234٫56
        "grouped": grouped,
        "eu_grouped": F.translate(grouped, ",", "."),
    }


# Fixed values of the adapter (ours): symbols and shop addresses cycled over customers.
CART_SYMBOLS = ["€", "£", "$", "zł", " kr ", "Kč", "??", None]
ZERO_PRICE_SPELLINGS = ["0,00", "0.00", " "]


def shop_urls(host: str) -> list:
    return [f"https://www.{host}.de/checkout/onepage/success/", f"https://{host}.cz/checkout",
            f"http://{host}.co.uk/success", "https://unknown-shop.example/checkout", None]


def ip_text(ipl: Column) -> Column:
    """Dotted IPv4 text of a 32-bit value."""
    a = F.shiftright(ipl, 24)
    b = F.shiftright(ipl, 16).bitwiseAND(255)
    c = F.shiftright(ipl, 8).bitwiseAND(255)
    d = ipl.bitwiseAND(255)
    return F.concat_ws(".", a.cast("string"), b.cast("string"), c.cast("string"), d.cast("string"))


def customer_ip_long(custkey: Column) -> Column:
    """A well-spread 32-bit value per customer (multiplicative hashing, no overflow)."""
    return ((custkey % 1000003) * 2654435761).bitwiseAND(4294967295)


def checkout_events(lineitem: DataFrame, orders: DataFrame, shop_host: str = DEFAULT_SHOP_HOST) -> DataFrame:
    l = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    # Both sides grow with the data: a sort-merge join on the order key, never a
    # broadcast of ``orders``. The projections below then run in the post-shuffle
    # tasks, spread over the whole cluster.
    j = l.join(o.hint("merge"), l.l_orderkey == o.o_orderkey, "inner")

    # Staged projections: intermediate values are computed once per row and keep
    # the generated code small.
    ck, ln = F.col("o_custkey"), F.col("l_linenumber")
    j = j.select(
        "l_orderkey", "l_partkey", "l_returnflag", "o_orderstatus", ck.alias("ck"), ln.alias("ln"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
        (F.unix_timestamp(F.col("o_orderdate")) + F.col("o_orderkey") % 86400).alias("secs"),
        customer_ip_long(ck).alias("ipl"),
        F.col("l_quantity").cast("int").alias("amount"),
        F.when(F.col("l_partkey") % 97 == 0, F.concat(F.lit("P-"), F.col("l_partkey").cast("string")))
         .otherwise(F.col("l_partkey").cast("string")).alias("item_pid"),
        _pick(ck % 8, CART_SYMBOLS).alias("currency"),
    )
    j = j.select("*", _div(F.col("cents"), 100).alias("whole"),
                 F.lpad((F.col("cents") % 100).cast("string"), 2, "0").alias("frac"))
    j = j.select("*", F.format_number(F.col("whole"), 0).alias("grouped"))
    whole_s, frac, grouped = F.col("whole").cast("string"), F.col("frac"), F.col("grouped")
    ln = F.col("ln")
    price = (F.when(ln % 5 == 0, F.concat(whole_s, F.lit("."), frac))                          # 1234.56
             .when(ln % 5 == 1, F.concat(F.translate(grouped, ",", "."), F.lit(","), frac))    # 1.234,56
             .when(ln % 5 == 2, F.concat(F.translate(grouped, ",", "'"), F.lit("."), frac))    # 1'234.56
             .when(ln % 5 == 3, F.concat(grouped, F.lit("."), frac))                           # 1,234.56
             .otherwise(F.concat(whole_s, F.lit("٫"), frac)))                                  # 1234٫56
    empty_opt = F.array().cast(T.ArrayType(OPTION))
    option = F.when(ln % 2 == 0, F.array(F.struct(F.lit("alloy").alias("option_label"),
                                                   F.col("l_returnflag").alias("value_label")))).otherwise(empty_opt)
    item = F.struct(F.col("item_pid").alias("product_id"), F.col("amount"), price.alias("price"),
                    F.col("currency"), option.alias("option"))
    zero = F.struct(F.col("item_pid").alias("product_id"), F.col("amount"),
                    _pick(F.col("l_orderkey") % 3, ZERO_PRICE_SPELLINGS).alias("price"),
                    F.col("currency"), empty_opt.alias("option"))
    cart = (F.when(ln == 7, F.array().cast(T.ArrayType(CART_ITEM)))
            .when(ln % 4 == 0, F.array(zero, item)).otherwise(F.array(item)))

    ck = F.col("ck")
    cks = ck.cast("string")
    ip = F.when(ck % 50 == 49, F.lit("not-an-ip")).otherwise(ip_text(F.col("ipl")))
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), ln.cast("string"), F.col("l_partkey").cast("string")).alias("_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("add_to_cart_action")).otherwise(F.lit("checkout_success")).alias("collection"),
        F.col("secs").cast("long").alias("time_stamp"),
        F.from_unixtime(F.col("secs"), "yyyy-MM-dd HH:mm:ss").alias("local_time"),
        ip.alias("ip"),
        F.concat(F.lit("agent-"), (ck % 3).cast("string")).alias("user_agent"),
        _pick(ck % 3, ["1920x1080", "1366x768", "390x844"]).alias("resolution"),
        F.when(ck % 7 == 0, F.lit(None).cast("string")).when(ck % 7 == 1, F.lit("  "))
         .otherwise(F.concat(F.lit("u"), cks)).alias("user_id_db"),
        F.when(ck % 11 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("dev_"), cks)).alias("device_id"),
        F.when(ck % 5 == 0, F.lit(None).cast("string")).when(ck % 5 == 1, F.lit(" "))
         .otherwise(F.concat(F.lit("user"), cks, F.lit("@mail.test"))).alias("email_address"),
        (ck % 10).cast("string").alias("store_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        _pick(ck % 5, shop_urls(shop_host)).alias("current_url"),
        F.lit(None).cast("string").alias("referrer_url"),
        F.lit(None).cast("string").alias("product_id"),
        F.lit(None).cast("string").alias("viewing_product_id"),
        F.lit(None).cast(T.ArrayType(OPTION)).alias("option"),
        cart.alias("cart_products"),
    )


# Fixed values of the adapter (ours): currencies of the wide prices, the last without a rate.
WIDE_CODES = ["EUR", "JPY", "KWD", "VND", "USD", "XXX"]
HUGE_QUANTITY = 2_000_000_000


def wide_prices(lineitem: DataFrame) -> DataFrame:
    """Price texts of 9 to 30 integer digits, one per line item: the line's cents, after
    the order key (18 digits), the part key (27) and a head of its own (28 or 29); every
    fifth line number has 30 digits, one more than a price holds. Three spellings, signs,
    some texts that are no number, and some huge quantities."""
    digits = lambda c: F.lpad((c % 1000000000).cast("string"), 9, "0")
    l = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                        F.col("l_quantity").cast("int").alias("quantity"),
                        F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"))
    a, b, c = digits(F.col("l_orderkey")), digits(F.col("l_partkey")), digits(F.col("cents"))
    head = (F.col("l_suppkey") % 99 + 1).cast("string")
    m = F.col("l_linenumber") % 5
    whole = (F.when(m == 0, c).when(m == 1, F.concat(a, c)).when(m == 2, F.concat(b, a, c))
             .when(m == 3, F.concat(head, b, a, c)).otherwise(F.concat(F.lit("100"), b, a, c)))
    nine = digits(F.col("l_partkey") * 7919 + F.col("l_orderkey"))
    k = F.col("l_orderkey") % 3
    spelled = (F.when(k == 0, F.concat(whole, F.lit("."), nine))
               .when(k == 1, F.concat(whole, F.lit(","), F.lpad((F.col("l_suppkey") % 100).cast("string"), 2, "0")))
               .otherwise(F.concat(whole, F.lit("٫"), nine)))
    signed = F.when(F.col("l_suppkey") % 11 == 0, F.concat(F.lit("-"), spelled)).otherwise(spelled)
    return l.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_partkey") % 101 == 0, "n/a").when(F.col("l_partkey") % 107 == 0, " 0,00 ").otherwise(signed).alias("price_raw"),
        _pick(F.col("l_suppkey") % 6, WIDE_CODES).alias("currency_code"),
        F.when(F.col("l_partkey") % 103 == 0, HUGE_QUANTITY).otherwise(F.col("quantity")).alias("quantity"))


def skewed_lines(lineitem: DataFrame) -> DataFrame:
    """Line items with hot keys: a third of the orders become one, a third of the lines
    buy part 1, and a fifth of the others no known part."""
    order, n = F.col("l_orderkey"), F.col("l_linenumber")
    return lineitem.select(
        F.when(order % 3 == 0, "hot").otherwise(order.cast("string")).alias("order_id"), order.alias("line_order"),
        n.alias("line_number"),
        F.when(n % 3 == 1, 1).when(F.col("l_suppkey") % 5 == 0, None).otherwise(F.col("l_partkey")).cast("long").alias("part_id"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"))


# Fixed values of the adapter (ours): driver event types -> shop event names.
EVENT_TYPE_TO_COLLECTION = [
    ("view", "view_product_detail"),
    ("click", "product_view_all_recommend_clicked"),
    ("signup", "add_to_cart_action"),
    ("purchase", "checkout_success"),
    ("error", "error"),
]


def behaviour_events(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Product events: product id from ``props.k`` (as product_id, or as
    viewing_product_id on every third event, neither on every ninth), the current page
    is page ``user_id`` and the referrer page is page ``user_id + 1``."""
    e = events.select("event_id", "ts", "user_id", "event_type", "props")
    cur = pages.select(F.col("page_id").alias("cur_id"), F.col("url").alias("current_url"))
    ref = pages.select(F.col("page_id").alias("ref_id"), F.col("url").alias("referrer_url"))
    j = (e.join(cur, e.user_id == cur.cur_id, "left")
          .join(ref, (e.user_id + 1) == ref.ref_id, "left"))
    coll = None
    for t, name in EVENT_TYPE_TO_COLLECTION:
        coll = F.when(F.col("event_type") == t, F.lit(name)) if coll is None else coll.when(F.col("event_type") == t, F.lit(name))
    coll = coll.otherwise(F.col("event_type"))
    k = F.get_json_object(F.col("props"), "$.k")
    eid = F.col("event_id")
    return j.select(
        eid.cast("string").alias("_id"),
        coll.alias("collection"),
        F.unix_timestamp(F.col("ts")).cast("long").alias("time_stamp"),
        F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss").alias("local_time"),
        F.col("user_id").cast("string").alias("user_id_db"),
        F.when(eid % 3 != 0, k).alias("product_id"),
        F.when((eid % 3 == 0) & (eid % 9 != 0), k).alias("viewing_product_id"),
        F.col("current_url"),
        F.col("referrer_url"),
        F.col("props").alias("option_json"),
    )


# Fixed values of the adapter (ours): price-format templates cycled over parts.
# {m} = whole units, {g} = grouped with commas, {e} = grouped with dots, {f} = cents.
PRICE_FORMATS = [
    "${g}.{f}", "USD {m}", "{e},{f} €", "{g} kr", "¥{m}", "￥{m}", "L {m}", "{e},{f} Kč",
    "{m} zł", "{m} lei", "LEKE {m}", "PEN S/.{m}", "S/.{m}", "din. {m}", None, "£{g}.{f}",
]


def _format_price_sql(template) -> str:
    """SQL for one price-format template over the staged columns __m (whole units),
    __g (grouped with commas), __e (grouped with dots) and __f (cents)."""
    if template is None:
        return "CAST(NULL AS STRING)"
    parts, buf, i = [], "", 0
    while i < len(template):
        if template[i] == "{":
            j = template.index("}", i)
            if buf:
                parts.append(sql_str(buf))
                buf = ""
            parts.append("__" + template[i + 1:j])
            i = j + 1
        else:
            buf += template[i]
            i += 1
    if buf:
        parts.append(sql_str(buf))
    return "concat(" + ", ".join(parts) + ")"


def product_records(part: DataFrame) -> DataFrame:
    """Catalogue records (28 text fields). Every tenth part appears twice, the second
    time with a revised name and maximum price, so the per-product dedup has work."""
    base = part.select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice", F.lit(0).alias("version"))
    again = part.filter(F.col("p_partkey") % 10 == 0).select(
        "p_partkey", "p_name", "p_type", "p_size", "p_retailprice", F.lit(1).alias("version"))
    u = base.unionByName(again)
    u = u.select("*", F.round(F.col("p_retailprice") * 100).cast("long").alias("cents"))
    u = u.select("*", _div(F.col("cents") * 9, 10).alias("min_cents"),
                 _div(F.col("cents") * (11 + F.col("version")), 10).alias("max_cents"))
    pk = F.col("p_partkey")
    cents, max_cents = F.col("cents"), F.col("max_cents")
    pm = price_texts(F.col("min_cents"))
    u = u.select("*", pm["whole"].alias("__m"), pm["grouped"].alias("__g"), pm["eu_grouped"].alias("__e"),
                 pm["frac"].alias("__f"))
    arms = " ".join(f"WHEN {i} THEN {_format_price_sql(t)}" for i, t in enumerate(PRICE_FORMATS))
    fmt = F.expr(f"CASE pmod(p_partkey, {len(PRICE_FORMATS)}) {arms} END")
    cols = {
        "product_id": pk.cast("string"),
        "name": F.when(F.col("version") == 1, F.concat(F.col("p_name"), F.lit(" (v2)"))).otherwise(F.col("p_name")),
        "sku": F.concat(F.lit("SKU-"), pk.cast("string")),
        "price": price_texts(cents)["plain"],
        "min_price": F.concat(F.col("__m"), F.lit("."), F.col("__f")),
        "max_price": price_texts(max_cents)["plain"],
        "min_price_format": fmt,
        "qty": F.col("p_size").cast("string"),
        "category": F.when(pk % 13 == 0, F.concat(F.lit("cat-"), F.col("p_size").cast("string")))
                     .otherwise(F.col("p_size").cast("string")),
        "category_name": F.when(pk % 9 == 0, F.lit(" ")).otherwise(F.col("p_type")),
        "type_id": F.lit("simple"),
    }
    return u.select(*[(cols[f] if f in cols else F.lit(None).cast("string")).alias(f) for f in PRODUCT_FIELDS])


# Geometry of the synthetic IP plan (ours): one 2^27 block per nation, four 2^25 cities.
NATION_BLOCK = 134217728
CITY_BLOCK = 33554432
CITIES_PER_NATION = 4


def ip_ranges(nation: DataFrame, region: DataFrame) -> DataFrame:
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    r = region.select("r_regionkey", "r_name")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    j = j.select("*", F.explode(F.sequence(F.lit(0), F.lit(CITIES_PER_NATION - 1))).alias("city_no"))
    lo = F.col("n_nationkey").cast("long") * NATION_BLOCK + F.col("city_no").cast("long") * CITY_BLOCK
    return j.select(
        lo.alias("ip_from"), (lo + (CITY_BLOCK - 1)).alias("ip_to"),
        F.col("n_name").alias("country"), F.col("r_name").alias("region"),
        F.concat(F.col("n_name"), F.lit("-city-"), F.col("city_no").cast("string")).alias("city"),
    )


def _dotted(v: Column) -> Column:
    """A 32-bit number as a dotted address."""
    return F.concat_ws(".", *[(F.shiftright(v, s) % 256).cast("string") for s in (24, 16, 8, 0)])


def mixed_addresses(orders: DataFrame) -> DataFrame:
    """One address an order: dotted, mapped, compressed, written out in capitals, with a
    dotted tail, or (every eighth) no address."""
    k = F.col("o_orderkey").cast("long")
    v4 = _dotted((k % 1000003) * 2654435761 % 4294967296)
    site = F.concat(F.lit("2001:db8:"), F.lower(F.hex(k % 25)))
    low, high = F.hex(k % 65536), F.hex(_div(k, 65536) % 65536)
    spelled = {3: F.concat(F.lit("::ffff:"), v4), 4: F.concat(site, F.lit("::"), F.lower(low)),
               5: F.concat(F.lit("2001:0DB8:"), F.lpad(F.hex(k % 25), 4, "0"), F.lit(":0:0:0:"), high, F.lit(":"), low),
               6: F.concat(site, F.lit("::"), v4), 7: F.concat(site, F.lit("::1::2"))}
    address = F.when(k % 8 < 3, v4)
    for kind, text in spelled.items():
        address = address.when(k % 8 == kind, text)
    return orders.select("o_orderkey", address.alias("address"))


def address_ranges(nation: DataFrame) -> DataFrame:
    """Four ranges a nation, as unequal as they come: a whole /8, one that starts and ends
    inside blocks, an IPv6 /48, and a single IPv6 address inside it."""
    n = F.col("n_nationkey").cast("long")
    site = F.concat(F.lit("2001:db8:"), F.lower(F.hex(n)), F.lit(":"))
    at = lambda x, rest: F.concat(x.cast("string"), F.lit(rest))
    host = F.concat(site, F.lit(":"), F.lower(F.hex(n)))
    ranges = [("block", at(n * 10, ".0.0.0"), at(n * 10, ".255.255.255")), ("odd", at(n * 10 + 1, ".2.3.4"), at(n * 10 + 3, ".200.77.9")),
              ("site", F.concat(site, F.lit(":")), F.concat(site, F.lit("ffff:ffff:ffff:ffff:ffff"))), ("host", host, host)]
    rows = F.array(*[F.struct(F.lit(kind).alias("kind"), lo.alias("addr_from"), hi.alias("addr_to")) for kind, lo, hi in ranges])
    return nation.select("n_name", F.explode(rows).alias("r")).select("r.*", F.col("n_name").alias("country"))


# Planted faults (ours): every seventh page is not found, and every 25th product from the
# third on is only known by urls that are gone.
FAIL_EVERY = 7
GONE_EVERY, GONE_AT, GONE_SUFFIX = 25, 3, "#gone"
# Every third page holds its data as an object, one of whose fields is no product field.
OBJECT_EVERY = 3
OBJECT_PAYLOAD = '{"sku":"S-<n>","qty":"<n>","name":"Page <n>","shelf":<n>}'


def gone_urls(pairs: DataFrame) -> DataFrame:
    """(product_id, url) pairs, those of the gone products with urls that are gone."""
    gone = F.col("product_id").cast("long") % GONE_EVERY == GONE_AT
    return pairs.select("product_id", F.when(gone, F.concat("url", F.lit(GONE_SUFFIX))).otherwise(F.col("url")).alias("url"))


def fetched_pages(pages: DataFrame, shop_host: str = DEFAULT_SHOP_HOST) -> DataFrame:
    """The fetched pages: status 200, but for every ``FAIL_EVERY``-th page (404) and the
    gone urls (410). Every fourth page was also fetched under the fallback url of the
    product of its number."""
    html = F.when(F.col("page_id") % OBJECT_EVERY == 0, F.regexp_replace(
        "html", r"track\((\d+)\)", f"track({OBJECT_PAYLOAD.replace('<n>', '$1')})")).otherwise(F.col("html"))
    p = pages.select("page_id", "url", html.alias("html"))
    own = p.select("url", F.when(F.col("page_id") % FAIL_EVERY == 0, 404).otherwise(200).alias("status"), "html")
    gone = p.select(F.concat("url", F.lit(GONE_SUFFIX)).alias("url"), F.lit(410).alias("status"), "html")
    fallback = p.filter(F.col("page_id") % 4 == 0).select(
        F.format_string(f"https://www.{shop_host}.com/catalog/product/view/id/%s",
                        F.col("page_id").cast("string")).alias("url"), F.lit(200).alias("status"), "html")
    return own.unionByName(gone).unionByName(fallback)


# The script call in the driver's pages whose digits stand for a product payload.
TRACK_PATTERN = r"track\((\d+)\)"
# The same call with either payload: the digits or an object.
PAYLOAD_PATTERN = r"track\((\{[^)]*\}|\d+)\)"
