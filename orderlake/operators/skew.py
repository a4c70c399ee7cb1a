"""Measured skew: name the keys that hold many rows, and salt only those.

``find_hot_keys`` runs a mergeable frequent-items summary (``approx_top_k``: a bounded
Misra-Gries-like sketch per task, merged) over any number of key columns in one pass and
counts its candidates exactly. A key with at least ``share`` of the rows cannot be missed:
the sketch's error stays below a quarter of that share.

``salted_left_join`` then deals the rows of a hot key over pieces of a quarter of a mean
partition, and repeats that key's one row on the other side as often; rows of a null key
match nothing and are dealt freely. The plan splits hot keys whatever its shape, with or
without AQE, whose own skew join needs both sides to come straight from a shuffle.

The salt is a hash of the row, so a recomputed task deals its rows as before.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 0.001


@dataclass(frozen=True)
class HotKeys:
    """Rows of a table and of its hot keys, by the key's text (None: the null key)."""

    n_rows: int
    counts: dict[str | None, int] = field(default_factory=dict)

    def pieces(self, partitions: int) -> dict[str, int]:
        """For each hot key that is not null, the number of its pieces: quarters of a mean
        partition, so that some of them may meet by chance."""
        mean = max(1, self.n_rows / max(1, partitions))
        return {k: ceil(4 * n / mean) for k, n in sorted(self.counts.items(), key=lambda x: str(x[0]))
                if k is not None and n > mean}


def find_hot_keys(df: DataFrame, keys: list[str], share: float = SHARE) -> dict[str, HotKeys]:
    """For each of ``keys`` (columns), its values with at least ``share`` of all rows and
    their exact counts. Two narrow passes over ``df`` (a written table); what reaches the
    driver is bounded by 1 / share."""
    k = min(4000, ceil(4 / share))
    items = 1 << max(6, (ceil(16 / share) - 1).bit_length())
    text = df.select(*[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(keys)])
    found = text.agg(F.count(F.lit(1)).alias("n"),
                     *[F.expr(f"approx_top_k(k{i}, {k}, {items})").alias(f"t{i}") for i in range(len(keys))]).first()
    out = {}
    for i, c in enumerate(keys):
        candidates = [r["item"] for r in found[f"t{i}"] or [] if r["count"] >= 0.7 * share * found["n"]]
        counts = {}
        if candidates:
            at = F.col(f"k{i}")
            mine = at.isin([v for v in candidates if v is not None])
            rows = text.filter(mine | at.isNull() if None in candidates else mine).groupBy(at.alias("k")).count().collect()
            counts = {r["k"]: r["count"] for r in rows if r["count"] >= share * found["n"]}
        out[c] = HotKeys(found["n"], counts)
    return out


def hot_key_table(df: DataFrame, keys: list[str], share: float = SHARE) -> DataFrame:
    """The hot keys as a table: key_name, key_value, n_rows, n_total."""
    rows = [(c, v, n, h.n_rows) for c, h in find_hot_keys(df, keys, share).items() for v, n in h.counts.items()]
    return df.sparkSession.createDataFrame(rows, "key_name string, key_value string, n_rows long, n_total long")


def salted_left_join(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, hot: HotKeys,
                     spread: list[str]) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on the texts of the keys, hot keys in pieces. ``right``
    holds each key once and keeps all its columns but the key; rows are dealt by a hash of
    the ``spread`` columns of ``left``."""
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = hot.pieces(partitions)
    table = F.create_map(*[F.lit(x) for kv in pieces.items() for x in kv]) if pieces else None
    n_of = lambda k: F.try_element_at(table, k) if pieces else F.lit(None).cast("int")
    dealt = F.xxhash64(*spread)
    lk, rk = left_key.cast("string"), right_key.cast("string")
    salt = (F.when(lk.isNull(), F.pmod(dealt, F.lit(partitions)))
            .when(n_of(lk).isNotNull(), F.pmod(dealt, n_of(lk).cast("long"))).otherwise(F.lit(0)).cast("int"))
    l = left.withColumns({"__lk": lk, "__salt": salt})
    r = (right.withColumn("__rk", rk)
         .withColumn("__rsalt", F.explode(F.sequence(F.lit(0), F.coalesce(n_of(F.col("__rk")), F.lit(1)) - 1))))
    return (l.join(r, (F.col("__lk") == F.col("__rk")) & (F.col("__salt") == F.col("__rsalt")), "left")
            .drop("__lk", "__salt", "__rk", "__rsalt"))
