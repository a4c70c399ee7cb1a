"""IPv4 and IPv6 location by address prefixes.

An address is a key of 32 hexadecimal digits (IPv4 under ``::ffff:0:0/96``, as IPv6 maps
it). A range of addresses is cut into the fewest whole prefixes of such keys: at most 15 a
digit on either side, and one for a range that is a block of digits, whether it is a /8 or a
/128. An address then lies in a range if one of its own prefixes is one of the range's, which
is an equi-join; addresses are looked up only by the prefix lengths that occur (at most 33,
for IPv4 at most 9).

Compared with fixed buckets (``range_join``) the cost of a range does not depend on its
width. No hint is given: AQE broadcasts the prefixes where it measures them small and
splits a prefix that holds too many addresses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 32
V4_HEAD = "0" * 20 + "ffff"
_HEX = "0123456789abcdef"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _v4_hex(text: Column) -> Column:
    """Eight digits of a dotted IPv4 address, null for any other text."""
    def of(parts):
        fine = (F.size(parts) == 4) & F.forall(parts, lambda p: p.rlike("^[0-9]{1,3}$") & (p.try_cast("int") <= 255))
        return F.when(fine, F.array_join(F.transform(parts, lambda p: F.lpad(F.lower(F.hex(p.try_cast("int"))), 2, "0")), ""))
    return _let(F.split(text, r"\."), of)


def _v6_groups(halves: Column) -> Column:
    """Eight groups from the texts before and after ``::`` (or the only one), null if there
    are more or fewer."""
    listed = lambda h: F.when(h == "", F.array().cast("array<string>")).otherwise(F.split(h, ":"))
    left, right = listed(F.get(halves, F.lit(0))), listed(F.get(halves, F.lit(1)))

    def filled(h):
        missing = 8 - F.size(h["left"]) - F.size(h["right"])
        return F.when(missing >= 1, F.concat(h["left"], F.array_repeat(F.lit("0"), missing), h["right"]))
    two = _let(F.struct(left.alias("left"), right.alias("right")), filled)
    return F.when(F.size(halves) == 2, two).when((F.size(halves) == 1) & (F.size(left) == 8), left)


def address_key(address) -> Column:
    """Address text -> key of 32 digits, null for what is no address. IPv6 in any spelling:
    upper or lower case, ``::`` once for one group of zeros or more, an IPv4 tail. No zone,
    no brackets."""
    s = F.col(address) if isinstance(address, str) else address
    tail = F.substring_index(s, ":", -1)
    head = F.substring(s, F.lit(1), F.length(s) - F.length(tail))
    with_tail = _let(_v4_hex(tail), lambda t: F.concat(head, F.substring(t, 1, 4), F.lit(":"), F.substring(t, 5, 4)))
    plain = F.lower(F.when(F.contains(tail, F.lit(".")), with_tail).otherwise(s))
    v6 = _let(_let(F.split(plain, "::"), _v6_groups), lambda groups: F.when(
        F.forall(groups, lambda g: g.rlike("^[0-9a-f]{1,4}$")), F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), "")))
    return F.when(F.contains(s, F.lit(":")), v6).otherwise(F.concat(F.lit(V4_HEAD), _v4_hex(s)))


def _digit(key: Column, i: Column) -> Column:
    """Value of the i-th digit (from 1)."""
    return F.position(F.substring(key, i, F.lit(1)), F.lit(_HEX)) - 1


def range_prefixes(lo, hi) -> Column:
    """Two keys -> array of the prefixes that make up all keys from ``lo`` to ``hi``, both
    included; empty where ``lo`` is above ``hi`` or one is null."""
    lo, hi = (F.col(c) if isinstance(c, str) else c for c in (lo, hi))
    none = F.array().cast("array<string>")
    span = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    children = lambda key, i, a, b: F.transform(
        span(a, b), lambda d: F.concat(F.substring(key, F.lit(1), i - 1), F.substring(F.lit(_HEX), d + 1, F.lit(1))))

    def pieces(at):  # the first digit that differs, and those up to which each end is no block's edge
        split, low_end, high_end = at["split"], at["low_end"], at["high_end"]
        below = F.flatten(F.transform(span(split + 1, low_end), lambda i: children(lo, i, _digit(lo, i) + 1, F.lit(15))))
        above = F.flatten(F.transform(span(split + 1, high_end), lambda i: children(hi, i, F.lit(0), _digit(hi, i) - 1)))
        edges = F.filter(F.array(F.when(low_end > split, F.substring(lo, F.lit(1), low_end)),
                                 F.when(high_end > split, F.substring(hi, F.lit(1), high_end))), lambda x: x.isNotNull())
        first = _digit(lo, split) + F.when(low_end > split, 1).otherwise(0)
        last = _digit(hi, split) - F.when(high_end > split, 1).otherwise(0)
        middle = F.when((first == 0) & (last == 15), F.array(F.substring(lo, F.lit(1), split - 1))).otherwise(
            children(lo, split, first, last))
        return F.concat(below, edges, middle, above)

    differ = F.filter(F.sequence(F.lit(1), F.lit(DIGITS)), lambda i: F.substring(lo, i, F.lit(1)) != F.substring(hi, i, F.lit(1)))
    ends = lambda i: F.struct(
        i.alias("split"), F.greatest(F.length(F.rtrim(lo, F.lit("0"))), i).alias("low_end"),
        F.greatest(F.length(F.rtrim(hi, F.lit("f"))), i).alias("high_end"))
    cut = _let(_let(F.get(differ, F.lit(0)), ends), pieces)
    return F.when(lo == hi, F.array(lo)).when(lo < hi, cut).otherwise(none)


def prefix_join(points: DataFrame, key: str, ranges: DataFrame, lo: str = "key_from", hi: str = "key_to",
                how: str = "inner") -> DataFrame:
    """Joins each point (its ``key`` a column of ``address_key``) to the ranges that contain
    it, one row for each; ``how`` is inner or left (a point in no range, or without a key,
    has nulls). Both tables may hold repeated rows; a range with a null end contains nothing."""
    cut = ranges.withColumn("__prefix", F.explode(range_prefixes(lo, hi)))
    # at most 33 numbers: the prefix lengths in use
    lengths = sorted(r[0] for r in cut.select(F.length("__prefix")).distinct().collect())
    names = [c for c in points.columns]
    own = F.array(*[F.substring(key, 1, n) for n in lengths]) if lengths else F.array().cast("array<string>")
    looked = points.withColumn("__own", F.explode(own))
    found = looked.join(cut, looked["__own"] == cut["__prefix"]).drop("__own", "__prefix")
    if how == "inner":
        return found
    met = found.select(F.col(key).alias("__met")).distinct()
    lost = points.join(met, points[key] == met["__met"], "left_anti")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in ranges.schema.fields]
    return found.unionByName(lost.select(*names, *empty))
