"""Helpers shared by the corpus operators: word rules, row keys, written tables and a
distributed rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.session import scratch_path

# The white space of the contracts (space, tab to carriage return).
WS_CHARS = " \t\n\x0b\x0c\r"
WS_PATTERN = "[\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table into the shared folder (``spark.checkpoint.dir``)
    and return a read of it. Cuts the lineage: a lost executor recomputes nothing above
    the table, and a join on it sees a plain scan, which AQE can split when skewed."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words(c: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order; null counts as empty."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), WS_PATTERN), "")


def n_words(c: Column) -> Column:
    return F.size(words(c)).cast("long")


def range_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Gapless 0-based rank over a total order without sorting in one task: a range
    shuffle, a rank inside each range, plus the sizes of the ranges before it (one
    number per range reaches the driver, bounded by the shuffle setting)."""
    spark = df.sparkSession
    ranged = written(df.repartitionByRange(range_partitions(spark), *order)
                     .withColumn("_range", F.spark_partition_id()), "ranked")
    sizes = {r["_range"]: r["count"] for r in ranged.groupBy("_range").count().collect()}
    offset, before = {}, 0
    for pid in sorted(sizes):
        offset[pid] = before
        before += sizes[pid]
    if not offset:
        return ranged.withColumn(name, F.lit(0).cast("long")).drop("_range")
    starts = F.create_map(*[F.lit(x) for pid, n in offset.items() for x in (pid, n)])
    w = Window.partitionBy("_range").orderBy(*order)
    return (ranged.withColumn(name, (starts[F.col("_range")] + F.row_number().over(w) - 1).cast("long"))
            .drop("_range"))
