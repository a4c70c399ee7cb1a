"""The default ("Unknown", key -1) member of a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def with_default_row(df: DataFrame, values: dict) -> DataFrame:
    """``df UNION ALL (one row)``, matched by column name, the row cast to df's schema.
    Columns missing from ``values`` are null."""
    spark: SparkSession = df.sparkSession
    row = tuple(values.get(f.name) for f in df.schema.fields)
    default = spark.createDataFrame([row], df.schema)
    return df.unionByName(default)
