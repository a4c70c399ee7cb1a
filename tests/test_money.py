from decimal import ROUND_HALF_UP, Decimal, getcontext
import random

from pyspark.sql import functions as F

from orderlake.functions.money import convert, is_lost, times
from orderlake.functions.price import unread_price, with_parsed_price

getcontext().prec = 100


def test_convert_is_exact_at_every_width(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(3000):
        whole = rng.randrange(10 ** rng.randrange(1, 30))
        amount = Decimal(f"{rng.choice(['', '-'])}{whole}.{rng.randrange(10 ** 9):09d}")
        rate = Decimal(rng.randrange(10 ** rng.randrange(1, 13))) / 10 ** 6
        rows.append((amount, rate))
    big = Decimal(10 ** 29) - Decimal("0.000000001")
    rows += [(big, Decimal("999999.999999")), (-big, Decimal("999999.999999")), (Decimal("0.004999995"), Decimal("1.000001")),
             (Decimal("0.005"), Decimal(1)), (Decimal("-0.005"), Decimal(1)), (Decimal(10 ** 16), Decimal("0.000001")),
             (Decimal("10000000000000000.005"), Decimal(1)), (Decimal("-10000000000000000.005"), Decimal(1)), (None, Decimal(1)), (big, None)]
    df = spark.createDataFrame(rows, "a decimal(38,9), r decimal(12,6)")
    for a, r, got in df.select("a", "r", convert(F.col("a"), F.col("r"))).collect():
        want = None if a is None or r is None else (a * r).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert got == want, (a, r)


def test_times_and_losses(spark):
    rows = [("9" * 29, 3), ("9" * 29 + "000000", 2_000_000_000), ("-12.34", 7), (None, 1), ("1", None)]
    df = spark.createDataFrame(rows, "u string, q int").withColumn("usd", F.col("u").cast("decimal(38,2)"))
    t = times(F.col("usd"), F.col("q"))
    got = df.select(t.alias("t"), is_lost(t, F.col("usd"), F.col("q")).alias("lost")).collect()
    assert [r.t for r in got] == [Decimal("2" + "9" * 28 + "7.00"), None, Decimal("-86.38"), None, None]
    assert [r.lost for r in got] == [False, True, False, False, False]


def test_unread_prices(spark):
    texts = ["1.50", "n/a", " 0,00 ", "0.00", "", " ", None, "0", "1" * 30, "1" * 29, "1 234,50", "-", "1'234,50"]
    df = with_parsed_price(spark.createDataFrame([(t,) for t in texts], "item_price_raw string"))
    got = {r.item_price_raw: r.lost for r in df.select("item_price_raw", unread_price("item_price_raw", "item_price").alias("lost")).collect()}
    assert {t for t, lost in got.items() if lost} == {"n/a", "1" * 30, "1 234,50", "1'234,50"}
