"""Data-quality checks (Q1-Q4).

Row-level forms (``check_*``) return the failing rows, so a check passes when its
result is empty. Summary forms (``*_summary``) return one row per check,
``(check_name, failures)``, computed on the executors:

* not-null and accepted-values checks of one table share a single aggregation pass
  (one ``count_if`` per column), however many columns are checked;
* the uniqueness checks of one table share one shuffle of (column, hash) with map-side
  partial aggregation, so a hot value is counted per map task before it; values are looked
  at again only where a hash repeats;
* a relationship check is a left anti join against the parent.

Run the checks on built tables (written, or checkpointed into the shared checkpoint
folder) so that every check reads the table instead of re-deriving it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once (nulls ignored)."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is outside ``values`` (nulls are left to not_null)."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def check_relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null key has no parent row. The parent is joined as it is
    (an anti join needs no distinct keys), so that AQE can split a hot child key."""
    p = parent.select(F.col(field).alias("__parent_key"))
    c = child.filter(F.col(column).isNotNull())
    return c.join(p, c[column] == p["__parent_key"], "left_anti")


def _count_rows(name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(F.lit(name).alias("check_name"),
                                                                               "failures")


def _unpivot_counts(counts: DataFrame, names: dict[str, str]) -> DataFrame:
    return counts.unpivot([], list(names), "__col", "failures").select(
        F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("__col")).alias("check_name"),
        F.col("failures").cast("bigint").alias("failures"))


def not_null_summary(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """All not-null checks of one table in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"__nn_{i}") for i, c in enumerate(columns)])
    return _unpivot_counts(counts, {f"__nn_{i}": f"{table}.{c}" for i, c in enumerate(columns)})


def accepted_values_summary(df: DataFrame, table: str, rules: dict[str, list]) -> DataFrame:
    """All accepted-values checks of one table in one pass."""
    cols = list(rules)
    counts = df.agg(*[F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*rules[c])).alias(f"__av_{i}")
                      for i, c in enumerate(cols)])
    return _unpivot_counts(counts, {f"__av_{i}": f"{table}.{c}" for i, c in enumerate(cols)})


def unique_summary(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """All uniqueness checks of one table with one shuffle: (column number, hash of the
    value), counted in the tasks first. Only values whose hash occurs more than once are
    then counted by the value itself, so equal hashes of different values fail nothing.
    Values are compared as text; a failure is a value that occurs more than once."""
    cells = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)])
    values = (df.select(F.explode(cells).alias("__cell")).select("__cell.c", "__cell.v").filter("v is not null")
              .withColumn("h", F.xxhash64("v")))
    again = values.groupBy("c", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        F.col("c").alias("__c"), F.col("h").alias("__h"))
    met = values.join(again, (F.col("c") == F.col("__c")) & (F.col("h") == F.col("__h")), "left_semi")
    repeated = met.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    counts = repeated.agg(*[F.count_if(F.col("c") == i).alias(f"__un_{i}") for i in range(len(columns))])
    return _unpivot_counts(counts, {f"__un_{i}": f"{table}.{c}" for i, c in enumerate(columns)})


def relationships_summary(child: DataFrame, table: str, rules: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        _count_rows(f"{table}.{c}", check_relationships(child, c, parent, field)) for c, (parent, field) in rules.items()
    ])


def failures_summary(checks: dict[str, DataFrame]) -> DataFrame:
    """One row per named row-level check: (check_name, failures)."""
    return reduce(DataFrame.unionByName, [_count_rows(name, df) for name, df in checks.items()])
