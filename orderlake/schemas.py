"""Input and ledger schemas (FIXTURES.md §1)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

OPTION = T.StructType([T.StructField("option_label", S), T.StructField("value_label", S)])
OPTION_DDL = "struct<option_label:string,value_label:string>"

CART_ITEM = T.StructType([
    T.StructField("product_id", S),
    T.StructField("amount", T.IntegerType()),
    T.StructField("price", S),
    T.StructField("currency", S),
    T.StructField("option", T.ArrayType(OPTION)),
])
# Item schema used while normalising JSON text: ``option`` is kept as raw text first.
CART_ITEM_TEXT_DDL = "struct<product_id:string,amount:int,price:string,currency:string,option:string>"

RAW_EVENT = T.StructType([
    T.StructField("_id", S),
    T.StructField("collection", S),
    T.StructField("time_stamp", T.LongType()),
    T.StructField("local_time", S),
    T.StructField("ip", S),
    T.StructField("user_agent", S),
    T.StructField("resolution", S),
    T.StructField("user_id_db", S),
    T.StructField("device_id", S),
    T.StructField("email_address", S),
    T.StructField("store_id", S),
    T.StructField("order_id", S),
    T.StructField("current_url", S),
    T.StructField("referrer_url", S),
    T.StructField("product_id", S),
    T.StructField("viewing_product_id", S),
    T.StructField("option", T.ArrayType(OPTION)),
    T.StructField("cart_products", T.ArrayType(CART_ITEM)),
])

# The same event with the two polymorphic fields read as JSON text (object or list).
RAW_EVENT_TEXT = T.StructType(
    [f if f.name not in ("option", "cart_products") else T.StructField(f.name, S) for f in RAW_EVENT.fields]
)

# The 28 product fields kept by the catalogue export, in their order.
PRODUCT_FIELDS = [
    "product_id", "name", "sku", "attribute_set_id",
    "attribute_set", "type_id", "price", "min_price", "max_price",
    "min_price_format", "max_price_format", "gold_weight",
    "none_metal_weight", "fixed_silver_weight", "material_design",
    "qty", "collection", "collection_id", "product_type",
    "product_type_value", "category", "category_name",
    "store_code", "platinum_palladium_info_in_alloy",
    "bracelet_without_chain", "show_popup_quantity_eternity",
    "visible_contents", "gender",
]
PRODUCT_INFO = T.StructType([T.StructField(f, S) for f in PRODUCT_FIELDS])

IP_LOCATION = T.StructType([
    T.StructField("ip", S), T.StructField("country", S), T.StructField("region", S), T.StructField("city", S),
])

IP_RANGE = T.StructType([
    T.StructField("ip_from", T.LongType()), T.StructField("ip_to", T.LongType()),
    T.StructField("country", S), T.StructField("region", S), T.StructField("city", S),
])

URLS = T.StructType([T.StructField("product_id", S), T.StructField("urls", T.ArrayType(S))])
URL_PAIR = T.StructType([T.StructField("product_id", S), T.StructField("url", S)])

FETCHED_PAGE = T.StructType([T.StructField("url", S), T.StructField("status", T.IntegerType()), T.StructField("html", S)])

LOAD_TRACKING = T.StructType([
    T.StructField("file_name", S, False),
    T.StructField("loaded_at", T.TimestampType(), False),
    # ours: which load wrote the entry (run id - batch id), so that a batch's own
    # entries never count as "already loaded" when it re-reads the ledger
    T.StructField("load_id", S, True),
])
