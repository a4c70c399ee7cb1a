"""Addresses and prefixes against Python's ipaddress and plain comparisons."""

import ipaddress
import random

import pytest

from orderlake.operators.prefix_join import address_key, prefix_join, range_prefixes
from orderlake.plans.extract import address_locations


def key_of(text):
    try:
        a = ipaddress.ip_address(text)
    except ValueError:
        return None
    return f"{int(a) if a.version == 6 else int(a) + (0xFFFF << 32):032x}"


SPELLINGS = ["1.2.3.4", "255.255.255.255", "::", "::1", "1::", "fe80::1:2", "2001:DB8::ff00:42:8329", "::ffff:1.2.3.4",
             "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4", "64:ff9b::192.0.2.33"]
OTHERS = ["1:2", "1::2::3", ":::", "1.2.3", "300.1.1.1", "", "x", "12345::", "1:2:3:4:5:6:7:8:9", "::1.2.3.400", "1.2.3.4::",
          ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "1:2:3:4:5:6:7:1.2.3.4", "::1.2.3.4:5", "g::1", " ::1", "::1%eth0", "[::1]"]


def test_address_key(spark):
    rows = spark.createDataFrame([(t,) for t in SPELLINGS + OTHERS + [None]], "t string").select("t", address_key("t").alias("k")).collect()
    for r in rows:
        if r.t in SPELLINGS:
            assert r.k == key_of(r.t) is not None, r
        else:
            assert r.k is None, r


def random_range(rnd):
    a = rnd.getrandbits(rnd.choice([8, 16, 32, 64, 128]))
    b = a + rnd.getrandbits(rnd.choice([1, 4, 8, 16, 40, 100, 127]))
    if rnd.random() < 0.4:
        bits = rnd.choice([3, 4, 8, 12, 64, 128])
        a = (a >> bits) << bits
        b = a + (1 << bits) - 1
    return f"{a:032x}", f"{min(b, 2 ** 128 - 1):032x}"


def test_prefixes_cover_the_range_once(spark):
    rnd = random.Random(3)
    rows = [random_range(rnd) for _ in range(300)] + [("0" * 32, "f" * 32), ("f" * 32, "0" * 32), (None, "0" * 32)]
    for r in spark.createDataFrame(rows, "a string, b string").select("a", "b", range_prefixes("a", "b").alias("p")).collect():
        if r.a is None or r.a > r.b:
            assert r.p == []
            continue
        parts = sorted((int((p or "0").ljust(32, "0"), 16), int((p or "f").ljust(32, "f"), 16)) for p in r.p)
        assert parts[0][0] == int(r.a, 16) and parts[-1][1] == int(r.b, 16)
        assert all(x[1] + 1 == y[0] for x, y in zip(parts, parts[1:], strict=False))
        assert len(parts) <= 2 * 15 * 32


def test_wide_and_narrow_ranges_cost_alike(spark):
    texts = [("10.0.0.0", "10.255.255.255"), ("2001:db8::5", "2001:db8::5"), ("2001:db8::", "2001:db8:ffff:ffff:ffff:ffff:ffff:ffff")]
    rows = spark.createDataFrame([(key_of(a), key_of(b)) for a, b in texts], "a string, b string")
    assert [len(r.p) for r in rows.select(range_prefixes("a", "b").alias("p")).collect()] == [1, 1, 1]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_equals_comparison(spark, how):
    rnd = random.Random(7)
    ranges = [(i, *random_range(rnd)) for i in range(60)] + [(60, "0" * 32, "f" * 32), (61, None, "f" * 32)]
    ranges += ranges[:2]  # repeated ranges
    points = []
    for _, a, _ in ranges[:40]:
        n = int(a, 16)
        points += [f"{max(0, n + d) % 2 ** 128:032x}" for d in (-1, 0, 1, rnd.getrandbits(60))]
    points += points[:3] + [None]
    got = prefix_join(spark.createDataFrame([(p,) for p in points], "key string"), "key",
                      spark.createDataFrame(ranges, "i int, key_from string, key_to string"), how=how)
    want = []
    for p in points:
        hits = [i for i, a, b in ranges if p is not None and a is not None and a <= p <= b]
        want += [(p, i) for i in hits] or ([(p, None)] if how == "left" else [])
    order = lambda rows: sorted(rows, key=str)
    assert order((r.key, r.i) for r in got.collect()) == order(want)


def test_locations_keep_every_address(spark):
    addresses = [("1.2.3.4",), ("::ffff:1.2.3.4",), ("2001:DB8:0::1",), ("nowhere",), (None,), ("9.9.9.9",), ("1.2.3.4",)]
    ranges = spark.createDataFrame([("1.0.0.0", "1.255.255.255", "A"), ("2001:db8::", "2001:db8::ff", "B")],
                                   "addr_from string, addr_to string, country string")
    got = address_locations(spark.createDataFrame(addresses, "address string"), ranges).collect()
    want = [("1.2.3.4", "A"), ("::ffff:1.2.3.4", "A"), ("2001:DB8:0::1", "B"), ("nowhere", None), (None, None), ("9.9.9.9", None),
            ("1.2.3.4", "A")]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_no_ranges(spark):
    none = spark.createDataFrame([], "addr_from string, addr_to string, country string")
    got = address_locations(spark.createDataFrame([("1.2.3.4",)], "address string"), none).collect()
    assert [tuple(r) for r in got] == [("1.2.3.4", None)]
