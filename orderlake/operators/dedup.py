"""Keep one row per key.

The reference picks an arbitrary row per key (ROW_NUMBER without ORDER BY, or ties in
the ORDER BY). Here the choice is made repeatable by a total order: the given
priority columns first, then every other column, nulls first.

Plan: ``row_number() OVER (PARTITION BY keys ORDER BY ...) = 1`` is planned by
Catalyst as a WindowGroupLimit: a partial top-1 runs *before* the shuffle inside each
map task, so a hot key (even a third of all rows) ships at most one row per map task,
and the final top-1 runs after the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _sortable(df: DataFrame, name: str) -> bool:
    """Maps and variants have no order in Spark; everything else can break ties."""
    return not isinstance(df.schema[name].dataType, (T.MapType, T.VariantType))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (),
               tie_breakers: Sequence[str] | None = None, rn_col: str = "__rn") -> DataFrame:
    """One row per ``keys``: the first by ``order``, then by ``tie_breakers``
    (default: all other sortable columns in schema order), ascending, nulls first."""
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in keys and _sortable(df, c)]
    spec = list(order) + [F.col(c).asc_nulls_first() for c in tie_breakers]
    w = Window.partitionBy(*keys).orderBy(*spec)
    return df.withColumn(rn_col, F.row_number().over(w)).filter(F.col(rn_col) == 1).drop(rn_col)
