"""Object payloads spread into records, and uniqueness checks of one shuffle."""

import json

from pyspark.sql import functions as F

from orderlake.operators import quality as Q
from orderlake.plans.extract import page_records


def test_spread_keeps_unknown_fields_and_types(spark):
    deep = {"sku": "S-1", "shelf": 7, "open": True, "deep": {"a": [1, 2, {"b": "}"}]}, "ü": 'say "é"', "ratio": 1.25}
    rows = [("1", "u1", json.dumps(deep)), ("2", "u2", "17"), ("3", None, '{"a}":1,"n":null}'), ("4", "u", "{}"), ("5", "u", "{bad"),
            ("6", "u}", None), ("7", "u", '"{}"'), ("8", "u", "[1]"), ("9", "u", ""),
            ("10", "u", '{"product_id":99,"url":"other","payload":1,"kept":2}')]
    got = {r.product_id: json.loads(r.record) for r in
           page_records(spark.createDataFrame(rows, "product_id string, url string, payload string")).collect()}
    extra = {"1": deep, "3": {"a}": 1, "n": None}, "10": {"kept": 2}}
    for key, url, payload in rows:
        own = {k: v for k, v in {"product_id": key, "url": url, "payload": payload}.items() if v is not None}
        assert got[key] == own | extra.get(key, {})


def table(spark):
    rows = [(i, f"n{i % 40}", None if i % 3 else i % 5, "all the same") for i in range(100)] + [(None, None, None, None)] * 3
    return spark.createDataFrame(rows, "id long, name string, few long, one string")


WANT = {"t.id": 0, "t.name": 40, "t.few": 5, "t.one": 1}


def failures(df):
    return {r.check_name: r.failures for r in Q.unique_summary(df, "t", ["id", "name", "few", "one"]).collect()}


def test_unique_summary_counts_repeated_values(spark):
    assert failures(table(spark)) == WANT
    assert failures(table(spark).limit(0)) == dict.fromkeys(WANT, 0)


def test_equal_hashes_of_different_values_fail_nothing(spark, monkeypatch):
    monkeypatch.setattr(Q.F, "xxhash64", lambda c: F.lit(1).cast("long"))
    assert failures(table(spark)) == WANT


def test_unique_summary_equals_the_row_check(spark):
    df = table(spark)
    assert failures(df) == {f"t.{c}": Q.check_unique(df, c).count() for c in df.columns}
