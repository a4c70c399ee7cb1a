"""Golden tables of FIXTURES.md §3 for the column functions."""

from decimal import Decimal

from pyspark.sql import functions as F

from orderlake.functions import (
    cart_currency_from_symbol, clean_string, item_price_status, parse_price, product_currency, product_raw_symbol,
    surrogate_key, unicode_trim, url_domain,
)
from orderlake.functions.json_shape import normalize_option_json
from orderlake.functions.price import with_parsed_price
from orderlake.operators.range_join import ipv4_to_long

PRICES = [
    ("1234.56", Decimal("1234.56"), "valid"),
    ("1,234.56", Decimal("1234.56"), "valid"),
    ("1.234,56", Decimal("1234.56"), "valid"),
    ("12,50", Decimal("12.50"), "valid"),
    ("1,234", Decimal("1234"), "valid"),
    ("1.234", Decimal("1.234"), "valid"),
    ("1.234.567,00", Decimal("1234567.00"), "valid"),
    ("1'234.50", Decimal("1234.50"), "valid"),
    ("1'234,50", None, "valid"),
    ("12٫5", Decimal("12.5"), "valid"),
    ("١٢٫٥", None, "valid"),
    ("1 234,50", None, "valid"),
    ("1,234,56", None, "valid"),
    ("abc", None, "valid"),
    ("0", None, "valid"),
    (None, None, "valid"),
    ("0,00", None, "zero_price"),
    ("0.00", None, "zero_price"),
    (" 0.00 ", None, "zero_price"),
    ("", None, "zero_price"),
]


def _norm(d):
    return None if d is None else d.normalize()


def test_price_golden(spark):
    df = spark.createDataFrame([(p,) for p, _, _ in PRICES], "raw string")
    got = df.select("raw", parse_price("raw").alias("v"), item_price_status("raw").alias("s")).collect()
    for (raw, want, status), row in zip(PRICES, got):
        assert _norm(row.v) == _norm(want), raw
        assert row.s == status, raw


def test_price_staged_matches_column_form(spark):
    df = spark.createDataFrame([(p,) for p, _, _ in PRICES], "item_price_raw string")
    staged = with_parsed_price(df).collect()
    for (raw, want, status), row in zip(PRICES, staged):
        assert _norm(row.item_price) == _norm(want), raw
        assert row.item_price_status == status


PRODUCT_FORMATS = [
    ("$1,234.00", "$", "UNKNOWN"), ("USD 12", "USD", "USD"), ("12,00 €", "€", "EUR"), ("1,234 kr", "KR", "SEK"),
    ("¥12", "¥", "JPY"), ("￥12", "￥", "UNKNOWN"), ("L 5", "L", "UNKNOWN"), ("1.234,00 Kč", "KČ", "UNKNOWN"),
    ("12 zł", "ZŁ", "UNKNOWN"), ("12 lei", "LEI", "RON"), ("LEKE 4", "LEKE", "ALL"), ("PEN S/.12", "PENS", "PEN"),
    ("S/.12", "S", "UNKNOWN"), ("din. 5", "DIN", "RSD"), (None, None, "UNKNOWN"),
]


def test_product_currency_golden(spark):
    df = spark.createDataFrame([(f,) for f, _, _ in PRODUCT_FORMATS], "f string")
    got = df.select(product_raw_symbol("f").alias("sym"), product_currency("f").alias("code")).collect()
    for (fmt, sym, code), row in zip(PRODUCT_FORMATS, got):
        assert row.sym == sym, fmt
        assert row.code == code, fmt


def test_cart_currency(spark):
    cases = [("€", "EUR"), (" $ ", "USD"), ("kr", "SEK"), ("zł", "PLN"), ("??", None), (None, None), ("лв.", "BGN"),
             ("PEN S/.", "PEN")]
    df = spark.createDataFrame(cases, "s string, want string")
    for row in df.select("want", cart_currency_from_symbol("s").alias("got")).collect():
        assert row.got == row.want


def test_cleaning_and_trim(spark):
    df = spark.createDataFrame([("a\nb",), ("a\u0001b",), ("  x  ",), (None,), (" y ",)], "s string")
    got = [r[0] for r in df.select(clean_string("s")).collect()]
    assert got == ["a b", "ab", "x", None, "y"]
    assert df.select(unicode_trim(F.lit(" 12,00 € "))).first()[0] == "12,00 €"


def test_url_domain(spark):
    cases = [("https://www.shop.de/x/y", "shop.de"), ("http://shop.cz", "shop.cz"), ("ftp://a.b/", None), (None, None),
             ("https://shop.com:8080/a", "shop.com:8080")]
    df = spark.createDataFrame(cases, "u string, want string")
    for row in df.select("want", url_domain("u").alias("got")).collect():
        assert row.got == row.want


def test_surrogate_key_null_and_separator(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3"), (None, "3")], "a string, b string")
    keys = [r[0] for r in df.select(surrogate_key("a", "b")).collect()]
    assert keys[0] != keys[1]
    assert keys[2] is None
    assert all(-(1 << 63) <= k < 1 << 63 for k in keys[:2])


def test_json_shape_golden(spark):
    cases = [(None, 0), ('{"option_label":"1"}', 1), ('[{"option_label":"2"}]', 1), ("7", 0), ("text", 0),
             ('[{"option_label":"3"}, 7, "x"]', 1), ('[{"option_label":"4"}, "{abc"]', 1)]
    df = spark.createDataFrame(cases, "t string, n int")
    opts = normalize_option_json("t", "struct<option_label:string,value_label:string>")
    for row in df.select("n", F.size(opts).alias("got")).collect():
        assert row.got == row.n


def test_ipv4(spark):
    cases = [("1.2.3.4", 16909060), ("255.255.255.255", 4294967295), ("256.1.1.1", None), ("1.2.3", None),
             ("a.b.c.d", None), (None, None), ("1.2.3.4.", None), ("::1", None)]
    df = spark.createDataFrame(cases, "ip string, want long")
    for row in df.select("want", ipv4_to_long("ip").alias("got")).collect():
        assert row.got == row.want


def test_string_entries_are_no_objects(spark):
    texts = ['["{\\"k\\": \\"a\\"}", {"k": "b"}]', '[{"k": "a"}, 7, null, [1], "x", {"k": "b"}]', '{"k": "c"}', '[{"k": "a"', None, "[]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: [o.k for o in r.o] for r in df.select("i", normalize_option_json("t", "struct<k:string>").alias("o")).collect()}
    assert got == {0: ["b"], 1: ["a", "b"], 2: ["c"], 3: [], 4: [], 5: []}


def test_rates_are_joined_without_moving_the_lines(spark):
    from pyspark.sql import functions as F
    from orderlake.operators.currency import to_usd
    from orderlake.sources.seed import exchange_rates, seed_rows
    rates = exchange_rates(spark)
    assert [tuple(r) for r in rates.collect()] == seed_rows()
    lines = spark.range(10).select(F.concat(F.lit("E"), F.col("id")).alias("currency_code"), F.col("id").cast("decimal(38,9)").alias("price"))
    plan = to_usd(lines, rates, {"usd": "price"})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_lists_are_parsed_once_and_entries_that_do_not_fit_one_by_one(spark):
    from orderlake.functions.json_shape import normalize_cart_json
    from orderlake.schemas import CART_ITEM_TEXT_DDL, OPTION_DDL
    texts = ['[{"product_id":"1","amount":2,"option":[{"option_label":"a"}]},{"product_id":"2"}]',
             '[7,{"product_id":"1","amount":"x","price":1.5,"option":{"option_label":"a"}},"{}",null]',
             '[{"amount":1,"amount":2}]', "[{'amount':1}]", '{"option":[7,{"option":[]}]}', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", normalize_cart_json("t", CART_ITEM_TEXT_DDL, OPTION_DDL).alias("c")).collect()}
    assert [(x.product_id, x.amount, x.price, [o.option_label for o in x.option]) for x in got[0]] == [
        ("1", 2, None, ["a"]), ("2", None, None, [])]
    assert [(x.product_id, x.amount, x.price, [o.option_label for o in x.option]) for x in got[1]] == [("1", None, "1.5", ["a"])]
    assert got[2] == got[3] == got[5] == [] and [len(x.option) for x in got[4]] == [1]


def test_entries_are_not_looked_up_by_parsing_the_list_again(spark):
    from orderlake.functions.json_shape import json_array_of_objects
    df = spark.createDataFrame([("[{}]",)], "t string").select(json_array_of_objects("t").alias("j"))
    plan = df._jdf.queryExecution().analyzed().toString()
    # a filter whose lambda holds the parser parses the whole list for each of its entries
    assert "zip_with" in plan and not [x for x in plan.split("lambdafunction(")[1:] if "schema_of_variant" in x and "get(" in x]


def test_events_of_a_feed_are_parsed_once(spark):
    from pyspark.sql import functions as F
    from orderlake.streaming.feeds import event_shape
    line = F.col("id").cast("string")
    df = spark.range(1).select(F.when(line != "x", event_shape(line)).alias("e"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("StructField(_id") == 1


def test_exports_are_packed(spark, tmp_dir):
    import os
    from orderlake.sources import sinks as K
    K.write_two(spark.range(3), f"{tmp_dir}/a", f"{tmp_dir}/b")
    assert K.export_if_absent(spark.range(3), f"{tmp_dir}/c") == 3
    for d in "abc":
        assert {f.rsplit(".", 1)[1] for f in os.listdir(f"{tmp_dir}/{d}") if f.startswith("part-")} == {"gz"}
        assert spark.read.json(f"{tmp_dir}/{d}").count() == 3
