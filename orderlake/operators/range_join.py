"""IPv4 text -> number, and a bucketed range join.

Spark has no range-join operator: ``ip BETWEEN lo AND hi`` alone plans a nested loop.
Each range is exploded over the fixed-width buckets it touches; the join is then an
equi-join on the bucket plus the BETWEEN as a residual filter. With non-overlapping
ranges the exploded side has at most (#ranges + #buckets) rows. No hint is
given: AQE broadcasts that side where it measures it small, else the join is a shuffle
join on the bucket, where AQE splits a bucket that holds too many points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def ipv4_to_long(c) -> Column:
    """Dotted IPv4 text to its 32-bit value; anything else (text, IPv6, an octet that
    is not 1-3 ASCII digits or is above 255, null) gives null.

    One split and a fold over the four parts: cheap enough that Catalyst may push a
    predicate on it down to the scan without a cost blow-up."""
    s = F.col(c) if isinstance(c, str) else c
    parts = F.split(s, r"\.")

    def step(acc, x):
        o = x.try_cast("long")
        return F.when(x.rlike(r"^[0-9]{1,3}$") & (o <= 255), F.shiftleft(acc, 8) + o)

    return F.when(F.size(parts) == 4, F.aggregate(parts, F.lit(0).cast("long"), step))


def range_join(points: DataFrame, point_col: str, ranges: DataFrame, lo: str = "ip_from", hi: str = "ip_to",
               how: str = "inner", bucket_bits: int = 16) -> DataFrame:
    """Join each point to the range that contains it. ``how`` is inner or left."""
    b = lambda c: F.shiftright(c, bucket_bits)
    exploded = ranges.withColumn("__bucket", F.explode(F.sequence(b(F.col(lo)), b(F.col(hi)))))
    p = points.withColumn("__pbucket", b(F.col(point_col)))
    cond = (p["__pbucket"] == exploded["__bucket"]) & p[point_col].between(exploded[lo], exploded[hi])
    return p.join(exploded, cond, how).drop("__pbucket", "__bucket")
