"""Operators against brute force on small fixtures."""

import random

from pyspark.sql import functions as F

from orderlake.operators import quality as Q
from orderlake.operators.dedup import keep_first
from orderlake.operators.defaults import with_default_row
from orderlake.operators.range_join import range_join
from orderlake.plans import extract as X


def test_keep_first_is_total_and_repeatable(spark):
    rows = [("o1", 1, "0,00", "a"), ("o1", 1, "12.00", "b"), ("o1", 1, "11.00", "a"), ("o2", 2, None, "z"),
            ("o2", 2, "", "y")]
    df = spark.createDataFrame(rows, "order_id string, product_id int, price string, other string")
    prio = F.when(F.col("price").isin("0,00", "0.00") | (F.col("price") == "") | F.col("price").isNull(), 1).otherwise(0)
    a = sorted(map(tuple, keep_first(df, ["order_id", "product_id"], [prio]).collect()))
    b = sorted(map(tuple, keep_first(df.orderBy(F.rand(7)), ["order_id", "product_id"], [prio]).collect()))
    assert a == b == [("o1", 1, "11.00", "a"), ("o2", 2, None, "z")]


def test_range_join_matches_brute_force(spark):
    rng = random.Random(3)
    ranges, lo = [], 0
    while lo < 2**32 - 1:
        hi = min(lo + rng.randint(1, 2**27), 2**32 - 1)
        if rng.random() < 0.8:
            ranges.append((lo, hi, f"c{len(ranges)}"))
        lo = hi + 1
    points = [(rng.randint(0, 2**32 - 1),) for _ in range(400)] + [(r[0],) for r in ranges[:5]] + [(r[1],) for r in ranges[:5]]
    rdf = spark.createDataFrame(ranges, "ip_from long, ip_to long, city string")
    pdf = spark.createDataFrame(points, "ip long")
    got = sorted((r.ip, r.city) for r in range_join(pdf, "ip", rdf, bucket_bits=20).collect())
    want = sorted((p, c) for (p,) in points for lo, hi, c in ranges if lo <= p <= hi)
    assert got == want
    # the shuffle path (no broadcast) gives the same answer
    got2 = sorted((r.ip, r.city) for r in range_join(pdf, "ip", rdf, bucket_bits=20).collect())
    assert got2 == want


def test_default_row(spark):
    df = spark.createDataFrame([(1, "a")], "k long, name string")
    out = with_default_row(df, {"k": -1, "name": "Unknown"}).collect()
    assert sorted(tuple(r) for r in out) == [(-1, "Unknown"), (1, "a")]


def test_quality_checks(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k long, v string")
    fact = spark.createDataFrame([(1,), (3,), (None,)], "k long")
    assert Q.check_unique(dim, "k").count() == 1
    assert Q.check_not_null(dim, "k").count() == 1
    assert Q.check_relationships(fact, "k", dim, "k").collect()[0].k == 3
    s = {r.check_name: r.failures for r in Q.not_null_summary(dim, "dim", ["k", "v"]).collect()}
    assert s == {"dim.k": 1, "dim.v": 0}
    u = {r.check_name: r.failures for r in Q.unique_summary(dim, "dim", ["k", "v"]).collect()}
    assert u == {"dim.k": 1, "dim.v": 0}


def test_resolve_pages_first_success_by_priority(spark):
    pairs = spark.createDataFrame([("7", "u/b"), ("7", "u/a"), ("8", "u/c"), ("9", "u/d")], "product_id string, url string")
    pages = spark.createDataFrame([
        ("u/a", 200, "<script>var react_data = {};</script>"),          # empty object: no data
        ("u/b", 200, 'x var react_data = {"name": "B"}; y'),
        ("u/c", 404, 'var react_data = {"name": "C"};'),                 # not fetched
        ("https://www.shop.com/catalog/product/view/id/8", 200, 'var react_data = {"name": "F8"};'),
        ("u/d", 200, 'var react_data = {"name": "D"}; var react_data = {"name": "E"};'),
    ], "url string, status int, html string")
    got = {r.product_id: (r.url, r.payload) for r in X.resolve_pages(pairs, pages).collect()}
    assert got["7"] == ("u/b", '{"name": "B"}')
    assert got["8"] == ("https://www.shop.com/catalog/product/view/id/8", '{"name": "F8"}')
    assert got["9"][1] == '{"name": "D"}'
    failed = X.failed_products(pairs, X.resolve_pages(pairs, pages)).collect()
    assert failed == []


def test_product_urls_filter_and_special_event(spark):
    ev = spark.createDataFrame([
        ("view_product_detail", "1", None, "c1", "r1"),
        ("product_view_all_recommend_clicked", None, "1", "c2", "r2"),
        ("checkout_success", "1", None, "c3", "r3"),
        ("add_to_cart_action", None, None, "c4", "r4"),
        ("view_product_detail", "2", None, None, "r5"),
        ("view_product_detail", "1", None, "c1", "r1"),
    ], "collection string, product_id string, viewing_product_id string, current_url string, referrer_url string")
    assert sorted(map(tuple, X.product_urls(ev).collect())) == [("1", "c1"), ("1", "r2")]
    assert tuple(X.url_counts(X.product_urls(ev)).first()) == (1, 2)


def test_hot_keys_are_split(spark):
    """A third of the rows on one nullable key: the final plans split that key."""
    from orderlake.operators.totals import with_group_total
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', if(id % 7 = 0, null, concat('k', id % 900))) AS k", "id AS v", "sha2(string(id), 256) AS x")
    parent = spark.range(0, 900, 1, 8).selectExpr("concat('k', id) AS p")
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        total = with_group_total(rows, "k", "v", "t")
        orphans = Q.check_relationships(rows, "k", parent, "p")
        n = {}
        for name, df in (("total", total), ("orphans", orphans)):
            n[name] = len(df.collect())
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString(), name
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert n == {"total": 60_000, "orphans": 20_000}


def test_hot_key_dedup_and_totals_match_brute_force(spark):
    """One order holds a third of all lines: dedup and order totals stay exact."""
    import collections
    from decimal import Decimal
    rows = []
    for n in range(3000):
        order = "hot" if n % 3 == 0 else f"o{n % 200}"
        rows.append((order, n % 37, ["0,00", "1.50", "2,25", ""][n % 4], n % 5 + 1, f"u{n % 11}"))
    df = spark.createDataFrame(rows, "order_id string, product_id int, item_price_raw string, order_qty int, user_id string")
    from orderlake.functions.price import price_priority, with_parsed_price
    dedup = keep_first(df, ["order_id", "product_id"], [price_priority("item_price_raw")])
    priced = with_parsed_price(dedup)
    line = (F.col("item_price") * F.col("order_qty")).alias("line_total")
    got = {r.order_id: r.t for r in priced.groupBy("order_id").agg(F.sum(line).alias("t")).collect()}
    # brute force: per (order, product) the first row by (priority, remaining columns)
    best = {}
    for r in rows:
        t = r[2].strip()
        prio = 0 if t not in ("0,00", "0.00") and t != "" else 1
        key = (r[0], r[1])
        cand = (prio, r[2], r[3], r[4])
        if key not in best or cand < best[key]:
            best[key] = cand
    want = collections.defaultdict(Decimal)
    for (order, _), (_, raw, qty, _) in best.items():
        price = {"1.50": Decimal("1.50"), "2,25": Decimal("2.25")}.get(raw)
        if price is not None:
            want[order] += price * qty
    assert {k: v for k, v in got.items() if v is not None} == dict(want)
    assert dedup.count() == len(best)


def test_group_total_null_safe(spark):
    from orderlake.operators.totals import with_group_total
    rows = [("a", 1), ("a", 2), (None, 5), (None, 7), ("", 11), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v int")
    got = sorted(((r.k, r.v, r.t) for r in with_group_total(df, "k", "v", "t").collect()),
                 key=lambda x: (x[0] is None, str(x[0]), str(x[1])))
    assert got == [("", 11, 11), ("a", 1, 3), ("a", 2, 3), ("b", None, None), (None, 5, 12), (None, 7, 12)]


def test_planning_runs_no_job_and_cluster_conf(spark):
    from orderlake.session import cluster_conf
    points = spark.range(100).withColumnRenamed("id", "ip")
    ranges = spark.range(10).selectExpr("id * 10 AS ip_from", "id * 10 + 9 AS ip_to")
    spark.sparkContext.setJobGroup("plan-only", "")
    try:
        joined = range_join(points, "ip", ranges)
        joined._jdf.queryExecution().executedPlan()
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert joined.count() == 100
    conf = cluster_conf(input_bytes=100 * 2**40, executors=1000, cores_per_executor=4)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 * 2**40) // (256 << 20)
    assert int(cluster_conf(input_bytes=1 << 20, executors=10)["spark.sql.shuffle.partitions"]) == 80


def test_large_prices_are_exact_and_overflow_is_null(spark):
    from orderlake.functions.price import parse_price
    from orderlake.operators.currency import check_rates, to_usd
    df = spark.createDataFrame([("99999999999.00",), ("100000000000.00",), ("1234567890123.45",), ("1" * 17,), ("1" * 29,), ("1" * 30,)], "p string")
    got = [r[0] for r in df.select(parse_price("p")).collect()]
    assert [None if g is None else f"{g:.2f}" for g in got] == ["99999999999.00", "100000000000.00", "1234567890123.45", "1" * 17 + ".00",
                                                                    "1" * 29 + ".00", None]
    rates = spark.createDataFrame([("KWD", 3.25)], "currency_code string, r double").selectExpr(
        "currency_code", "'kw' AS domain", "cast(r AS decimal(12,6)) AS rate_to_usd")
    usd = to_usd(spark.createDataFrame([("KWD", "9000000000000000")], "currency_code string, p string").selectExpr(
        "currency_code", "cast(p AS decimal(25,9)) AS a"), rates, {"u": "a"}).first()
    assert f"{usd.u:.2f}" == "29250000000000000.00"
    import pytest
    with pytest.raises(ValueError):
        check_rates(rates.unionByName(rates))
