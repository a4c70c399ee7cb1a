"""Export and load models (M14, M15): cleaned hand-off files and table loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions.text import clean_string
from orderlake.schemas import PRODUCT_FIELDS, PRODUCT_INFO
from orderlake.session import scratch_path
from orderlake.sources import readers as R
from orderlake.sources import sinks as K
from orderlake.sources.lines import read_jsonl_numbered


def normalize_record(events_text: DataFrame) -> DataFrame:
    """Drop ``_id``, normalise ``option`` and ``cart_products`` to lists (C2), and
    clean every top-level text field (F26). Input: events with the two polymorphic
    fields as JSON text (``read_raw_events`` schema before normalisation)."""
    df = R.normalize_events(events_text).drop("_id")
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: clean_string(c) for c in strings})


def normalize_product(products: DataFrame) -> DataFrame:
    """C4 + P12: the 28 kept fields, every value as cleaned text. Fields a record lacks
    stay null and are left out when written as JSON."""
    cols = []
    for f in PRODUCT_FIELDS:
        c = F.col(f).cast("string") if f in products.columns else F.lit(None).cast("string")
        cols.append(clean_string(c).alias(f))
    return products.select(*cols)


def export_datasets(ip_locations: DataFrame, product_info: DataFrame, raw_events_text: DataFrame,
                    out_root: str) -> dict[str, int]:
    """The three hand-off datasets. Returns the record counts written; the raw
    export is skipped (0) when its target already exists."""
    root = out_root.rstrip("/")
    K.write_jsonl(ip_locations, f"{root}/ip_locations")
    n_products = K.write_two(normalize_product(product_info), f"{root}/product_info", f"{root}/product_info_clean")
    n_raw = K.export_if_absent(normalize_record(raw_events_text), f"{root}/raw_events")
    return {"product_info": n_products, "raw_events": n_raw}


def load_products(spark: SparkSession, jsonl_path: str, target: str, as_table: bool = False,
                  rejects: str | None = None) -> DataFrame:
    """K8 + K7: products without a product id are dropped, the rest appended. With a folder
    for ``rejects`` the malformed lines are appended there as (file, line_no, line), S10."""
    if rejects is None:
        products = R.read_product_info(spark, jsonl_path)
    else:
        records, bad = read_jsonl_numbered(spark, jsonl_path, PRODUCT_INFO, scratch_path(spark, "product-lines"))
        products = records.select(PRODUCT_INFO.names)
        K.append_records(bad, rejects)
    K.append_records(products.filter(F.col("product_id").isNotNull()), target, as_table=as_table)
    return spark.table(target) if as_table else spark.read.parquet(target)


def load_ip_locations(spark: SparkSession, path: str, target: str, fmt: str = "json", as_table: bool = False) -> DataFrame:
    """S8 + K7: ip locations (JSON lines or CSV with a header) appended to the target."""
    K.append_records(R.read_ip_locations(spark, path, fmt), target, as_table=as_table)
    return spark.table(target) if as_table else spark.read.parquet(target)
