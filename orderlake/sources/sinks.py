"""Sinks (K1-K11). All writes go through Spark's file commit protocol: a task's
output becomes visible only when the job commits, so a retried task or a lost
executor never leaves half a file behind."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Exports are gzipped, a tenth of their size; Spark's readers unpack them by their name. Such a
# file is read by one task, so a task writes several files of a bounded number of records.
PACKED = {"compression": "gzip", "maxRecordsPerFile": "500000"}
# Loaded rows that a job keeps beside the files they came from.
STORED = {"compression": "zstd"}


def _export_options(fmt: str) -> dict[str, str]:
    return PACKED if fmt in ("json", "text", "csv") else {}


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1, K2, K4: JSON lines, UTF-8 with non-ASCII text kept as is; null fields are
    left out of the record (only present fields are written)."""
    df.write.mode(mode).json(path)


def write_text_lines(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    """K3: one value per line."""
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


def write_counted(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite",
                  name: str = "written") -> int:
    """Write and return the number of records written (an observed metric of the write
    job itself, no second pass)."""
    obs = Observation(name)
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode(mode).format(fmt).options(**_export_options(fmt)).save(path)
    return int(obs.get["n"])


def digest_columns(df: DataFrame) -> list:
    """Aggregates that prove the content of a table whatever its order: rows, and the sum
    and xor of a 60-bit hash of every row's texts (null, empty and absent lists differ)."""
    cells = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        text = F.to_json(c) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else c.cast("string")
        cells.append(F.coalesce(F.concat(F.lit("="), text), F.lit("-")))
    h = F.conv(F.substring(F.md5(F.concat_ws("\x1f", *cells)), 1, 15), 16, 10).cast("long")
    return [F.count(F.lit(1)).alias("n_rows"), F.sum(h.cast("decimal(38,0)")).alias("hash_sum"), F.bit_xor(h).alias("hash_xor")]


def write_digested(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> tuple:
    """Write and return (rows, hash sum, hash xor) of what the write job itself saw."""
    obs = Observation()
    df.observe(obs, *digest_columns(df)).write.mode(mode).format(fmt).options(**_export_options(fmt)).save(path)
    return tuple(obs.get[k] for k in ("n_rows", "hash_sum", "hash_xor"))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def list_dirs(spark: SparkSession, path: str) -> set[str]:
    """Sub-folders of ``path`` (empty when it does not exist)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return set()
    return {st.getPath().toString() for st in fs.listStatus(p) if st.isDirectory()}


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursive delete on the path's file system (for a job's own scratch output)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def export_if_absent(df: DataFrame, path: str, fmt: str = "json") -> int:
    """K5: export unless a finished export exists; returns the record count, 0 when
    skipped. Finished means committed: a folder that a failed run left is written anew."""
    if path_exists(df.sparkSession, path.rstrip("/") + "/_SUCCESS"):
        return 0
    return write_counted(df, path, fmt=fmt, mode="overwrite")


def write_two(df: DataFrame, path_a: str, path_b: str, fmt: str = "json") -> int:
    """K6: the same records to two sinks with one computation: the second copy is read
    back from the first sink (no cache to lose with an executor). Both writes digest their
    rows; a copy that differs is an error. Returns the count."""
    first = write_digested(df, path_a, fmt=fmt)
    copy = write_digested(df.sparkSession.read.format(fmt).schema(df.schema).load(path_a), path_b, fmt=fmt)
    if copy != first:
        raise RuntimeError(f"{path_b} differs from {path_a}: {copy} against {first}")
    return first[0]


def append_records(df: DataFrame, path_or_table: str, fmt: str = "parquet", as_table: bool = False) -> None:
    """K7: unordered append; each write task is one batch."""
    w = df.write.mode("append")
    if as_table:
        w.format(fmt).saveAsTable(path_or_table)
    else:
        w.format(fmt).save(path_or_table)


def ensure_layers(spark: SparkSession, layers=("raw", "staging", "intermediate", "warehouse")) -> None:
    """One database per layer, named exactly after the layer."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")


def materialize(df: DataFrame, layer: str, name: str, root: str | None = None, as_table: bool = False,
                fmt: str = "parquet") -> DataFrame:
    """Full rebuild of a table, returned as a fresh read of what was written (so
    downstream plans start from the table, not from the lineage that built it).
    ``as_table`` saves into the ``layer`` database of the catalog; otherwise the table
    is the folder ``<root>/<layer>/<name>``."""
    spark = df.sparkSession
    if as_table:
        ensure_layers(spark, [layer])
        df.write.mode("overwrite").format(fmt).saveAsTable(f"`{layer}`.`{name}`")
        return spark.table(f"`{layer}`.`{name}`")
    path = f"{root.rstrip('/')}/{layer}/{name}"
    df.write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).load(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """K9: a view materialisation - the DataFrame stays lazy; the name is registered."""
    df.createOrReplaceTempView(name)
    return df
