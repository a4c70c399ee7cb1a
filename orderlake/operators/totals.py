"""Whole-group totals on every row (W4): ``SUM(x) OVER (PARTITION BY key)``.

Computed as an aggregate joined back rather than a window: the sum is partially
aggregated in each map task before the shuffle, so a key holding a large share of the
rows never lands in one task. The join is null-safe (a null key is a group of its own, as
in the window), on the key itself: the rows are shuffled with no second copy of it.

AQE splits a skewed join only if both sides come straight from a shuffle. The totals
are therefore joined on an expression of their key, which gives that side (one row per
group) a shuffle of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.operators.skew import HotKeys, salted_left_join


def own_shuffle(key: str | Column) -> Column:
    """The same text, but no longer the attribute an aggregate below is partitioned by."""
    return F.concat(F.col(key) if isinstance(key, str) else key, F.lit(""))


def with_group_total(df: DataFrame, key: str, value: Column | str, out: str, hot: HotKeys | None = None,
                     spread: list[str] | None = None) -> DataFrame:
    """``df`` with ``out`` = the sum of ``value`` over all rows sharing ``key``
    (nulls in ``value`` are skipped; a group of nulls totals null, and so does a sum past
    the type). With ``hot`` (measured keys) the rows of a hot key are dealt over tasks by
    the ``spread`` columns, else AQE may split it."""
    v = F.col(value) if isinstance(value, str) else value
    if hot is not None:
        mark = lambda c: F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n"))
        marked = HotKeys(hot.n_rows, {"n" if k is None else "v" + k: n for k, n in hot.counts.items()})
        totals = df.groupBy(mark(F.col(key)).alias("__t_gk")).agg(F.try_sum(v).alias(out))
        return salted_left_join(df, totals, mark(F.col(key)), F.col("__t_gk"), marked,
                                spread or df.columns).drop("__t_gk")
    text = F.col(key).cast("string")
    totals = df.groupBy(text.alias("__t_gk")).agg(F.try_sum(v).alias(out)).withColumn("__t_gk", own_shuffle("__t_gk"))
    return df.join(totals, text.eqNullSafe(F.col("__t_gk")), "left").drop("__t_gk")
