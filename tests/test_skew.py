"""Hot keys: named by measurement, split by salt, the results unchanged."""

from pyspark.sql import functions as F

from orderlake.operators.skew import HotKeys, find_hot_keys, salted_left_join
from orderlake.operators.totals import with_group_total

PLAIN = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
SPLIT = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.autoBroadcastJoinThreshold": "-1"}


class settings:
    def __init__(self, spark, conf):
        self.spark, self.conf = spark, conf

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k, None) for k in self.conf}
        for k, v in self.conf.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_):
        for k, v in self.old.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)


def rows(spark, n=60_000):
    """A third on one key, a third null, the rest over 900 keys."""
    return spark.range(0, n, 1, 8).selectExpr(
        "id", "CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN NULL ELSE 1000 + id % 900 END AS k", "id % 11 AS v")


def shares(df):
    """Share of the rows in the largest partition."""
    n = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(n) / sum(n)


def test_hot_keys_are_named_with_exact_counts(spark):
    got = find_hot_keys(rows(spark), ["k", "v", "id"], 0.05)
    assert got["k"] == HotKeys(60_000, {"7": 20_000, None: 20_000})
    assert got["v"].counts == {str(v): 60_000 // 11 + (v < 60_000 % 11) for v in range(11)}
    assert got["id"].counts == {}
    assert find_hot_keys(rows(spark, 0), ["k"])["k"] == HotKeys(0, {})
    every = rows(spark).groupBy(F.col("k").cast("string").alias("k")).count().collect()
    assert find_hot_keys(rows(spark), ["k"], 0.0003)["k"].counts == {r["k"]: r["count"] for r in every if r["count"] >= 18}


def test_a_key_just_above_the_share_is_not_missed(spark):
    df = spark.range(0, 200_000, 1, 7).selectExpr("IF(id % 97 = 0, -1, id) AS k")  # 1.03 %
    assert find_hot_keys(df, ["k"], 0.01)["k"].counts == {"-1": 2062}
    assert find_hot_keys(df, ["k"], 0.011)["k"].counts == {}


def test_salted_join_is_whole_and_even(spark):
    df = rows(spark)
    dim = spark.range(0, 2000, 1, 4).selectExpr("id AS d", "concat('n', id) AS name")
    want = sorted(df.join(dim, df.k == dim.d, "left").select("id", "name").collect())
    with settings(spark, PLAIN):
        hot = find_hot_keys(df, ["k"])["k"]
        plain = df.join(dim, df.k == dim.d, "left")
        salted = salted_left_join(df, dim, F.col("k"), F.col("d"), hot, ["id"])
        assert "BroadcastHashJoin" not in salted._jdf.queryExecution().executedPlan().toString()
        assert sorted(salted.select("id", "name").collect()) == want
        assert shares(plain) > 0.3 and shares(salted) < 0.15
        none = salted_left_join(df, dim, F.col("k"), F.col("d"), HotKeys(60_000), ["id"])
        assert sorted(none.select("id", "name").collect()) == want


def test_salted_totals(spark):
    df = rows(spark)
    want = {r["k"]: r["t"] for r in df.groupBy("k").agg(F.sum("v").alias("t")).collect()}
    with settings(spark, PLAIN):
        got = with_group_total(df, "k", "v", "t", find_hot_keys(df, ["k"])["k"], ["id"])
        assert got.columns == ["id", "k", "v", "t"]
        assert shares(got) < 0.15
        found = got.collect()
    assert len(found) == 60_000 and all(r["t"] == want[r["k"]] for r in found)


def fact_inputs(spark, n=30_000):
    """A third of the lines on one product, one IP and one order; some keys null."""
    fact = spark.range(0, n, 1, 6).selectExpr(
        "id AS fact_sales_order_key", "IF(id % 3 = 0, 'hot', IF(id % 10 = 1, NULL, concat('o', id % 5000))) AS order_id",
        "IF(id % 3 = 0, 1, IF(id % 7 = 1, NULL, 2 + id % 3000)) AS product_id",
        "IF(id % 3 = 0, '10.0.0.1', IF(id % 9 = 1, NULL, concat('10.0.', id % 200, '.', id % 250))) AS ip_address",
        "concat('u', id % 100) AS user_id", "DATE'2024-05-01' AS order_local_time", "'1' AS store_id", "id AS order_timestamp",
        "'USD' AS currency_code", "'valid' AS item_price_status", "CAST(id % 5 AS INT) AS order_qty",
        "CAST(id % 100 AS DECIMAL(38,2)) AS item_price_usd")
    product = spark.range(0, 2500, 1, 3).selectExpr("id AS product_id", "id * 10 AS product_key")
    place = spark.range(0, 40_000, 1, 3).selectExpr("concat('10.0.', id % 200, '.', id % 250) AS ip_address", "id % 77 AS location_key") \
        .unionByName(spark.sql("SELECT '10.0.0.1' AS ip_address, 5L AS location_key"))
    return fact, product, place


def test_fact_joins_split_hot_keys_with_and_without_measurement(spark):
    from orderlake.plans.warehouse import HOT_COLUMNS, fact_sales_order
    fact, product, place = fact_inputs(spark)
    with settings(spark, SPLIT):
        lazy = fact_sales_order(fact, product, place)
        plain = sorted(map(tuple, lazy.collect()), key=str)
        plan = lazy._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.split("== Initial Plan ==")[0].splitlines() if "SortMergeJoin" in line]
    assert len(joins) == 3 and all("skew=true" in line for line in joins), joins
    with settings(spark, PLAIN):
        salted = fact_sales_order(fact, product, place, hot=find_hot_keys(fact, HOT_COLUMNS))
        assert shares(salted) < 0.15
        assert sorted(map(tuple, salted.collect()), key=str) == plain
    assert len(plain) == 30_000


def test_fact_joins_shuffle_no_hashed_key_and_no_copy_of_the_order(spark):
    from orderlake.plans import intermediate as I
    from orderlake.plans.warehouse import fact_sales_order
    rows, product, place = fact_inputs(spark, 3_000)
    fact = I.int_fact_sales_order(rows.drop("fact_sales_order_key").distinct())
    with settings(spark, PLAIN):
        carried = fact_sales_order(fact, product, place)
        late = fact_sales_order(fact, product, place, fact_key=I.fact_key())
        plan = late._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, late.collect()), key=str) == sorted(map(tuple, carried.collect()), key=str)
        assert late.columns == carried.columns
    assert "md5(" in plan and "__gk" not in plan
    assert plan.rindex("md5(") < plan.index("Exchange"), plan
