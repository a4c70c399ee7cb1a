"""Line numbers of split text files.

A large file is read as blocks by many tasks, so no task knows its lines' numbers. The
lines are written once with the block they come from and their place in the task that read
it; the lines of each block are counted, and their prefix sums in block order give every
block's first line. Only one row per block is shuffled and sorted, and the texts of lines
whose number nobody asks for are not joined.

The table is written first because a second scan may cut the files into other blocks (their
size depends on the executors present); a task run again reads the same blocks in the same
order, so the places in the table fit together.

Defined results: lines end at a line feed, a carriage return or both, and count from 1,
blank ones included; a line belongs to the block it starts in. Files without lines give no
rows. A compressed file is one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE, BLOCK, PLACE = "_file", "_block", "_place"


def position() -> list[Column]:
    """Columns that order the lines of a file while it is scanned: file, block, place."""
    return [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
            F.monotonically_increasing_id().alias(PLACE)]


def tagged_lines(spark: SparkSession, path: str, table: str) -> DataFrame:
    """All lines below ``path`` with their positions, written to the folder ``table``."""
    spark.read.text(path).select(*position(), "value").write.mode("overwrite").parquet(table)
    return spark.read.parquet(table)


def block_starts(tagged: DataFrame) -> DataFrame:
    """One row per block: the place of its first line, and the lines before it in its file."""
    blocks = tagged.groupBy(FILE, BLOCK).agg(F.min(PLACE).alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(FILE, BLOCK, "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))


def with_line_number(rows: DataFrame, tagged: DataFrame, name: str = "line_no") -> DataFrame:
    """``rows`` (any of the ``tagged`` lines, with other columns) with their line numbers."""
    number = F.col("__before") + F.col(PLACE) - F.col("__first") + 1
    return rows.join(block_starts(tagged), [FILE, BLOCK]).withColumn(name, number).drop("__before", "__first")


def read_jsonl_numbered(spark: SparkSession, path: str, schema: T.StructType, table: str) -> tuple[DataFrame, DataFrame]:
    """S10 with line numbers: (records, rejected). Records have the fields of ``schema`` and
    their position (``_file``, ``_block``, ``_place``); rejected lines, those that are no JSON
    object, are (file, line_no, line). Blank lines are skipped and counted. The lines are
    written to ``table`` and parsed from there, so the files are read once."""
    tagged = tagged_lines(spark, path, table)
    ok = F.ltrim("value").startswith("{") & F.try_parse_json("value").isNotNull()
    lines = tagged.filter(F.trim("value") != "").withColumn("__ok", ok)
    records = lines.filter("__ok").select(F.from_json("value", schema).alias("r"), FILE, BLOCK, PLACE).select(
        "r.*", FILE, BLOCK, PLACE)
    rejected = with_line_number(lines.filter(~F.col("__ok")), tagged).select(
        F.col(FILE).alias("file"), "line_no", F.col("value").alias("line"))
    return records, rejected


def last_of_key(records: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Per key the values of its last line: files in path order, then lines in file order."""
    at = F.struct(FILE, BLOCK, PLACE)
    last = F.max_by(F.struct(*values), at)
    return records.groupBy(key).agg(last.alias("__last")).select(key, *[F.col(f"__last.{v}").alias(v) for v in values])
