"""Sharding by Karmarkar-Karp differencing: shards of near equal bytes, with the rows of
one text kept together.

Items are groups of equal texts. The partial partition of an item has its size in one
subset and zeros elsewhere; two partial partitions combine by joining the largest subset
of one with the smallest of the other. Always the two with the largest spread combine.
Groups over 1/GRAIN of a mean shard are items of their own; the smaller ones are packed by
a hash of the text into GRAIN bundles per shard, so at most some thousand sums reach the
driver, which differences them all together. No rows are shuffled to their shard's label:
the labels of bundles and large groups are broadcast.

A group over one mean shard cannot stay whole under the law of near equal bytes: it is
dealt row by row into pieces of about a quarter shard. Where whole groups up to a mean
shard still leave a spread over SPREAD of a shard, that limit is halved until they do not.

Defined results: null text is empty (size 16 with the row overhead); rows with equal
doc_id and text follow their group; slots order by doc_id (nulls first), ties broken
arbitrarily among identical rows; a text of any length counts with all its bytes; an empty
table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import range_partitions, text_of, written

BLOCK = 1 << 15
GRAIN = 100  # bundles per shard, fewer from 40 shards on
SPREAD = 0.01


def difference(parts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Karmarkar-Karp over partial partitions (arrays of k sums, any order of subsets).

    Returns the k sums of the result and, per input, the subset of the result that each of
    its subsets joined."""
    k = len(parts[0])
    # a node keeps its sums in ascending order; leaf: (None, order), inner: (left, right, order)
    heap = []
    for n, sums in enumerate(parts):
        order = np.argsort(sums, kind="stable")
        s = sums[order]
        heap.append((-(int(s[-1]) - int(s[0])), n, s, (n, None, order)))
    heapq.heapify(heap)
    at = len(parts)
    while len(heap) > 1:
        _, _, a, ta = heapq.heappop(heap)
        _, _, b, tb = heapq.heappop(heap)
        s = a + b[::-1]
        order = np.argsort(s, kind="stable")
        s = s[order]
        heapq.heappush(heap, (-(int(s[-1]) - int(s[0])), at, s, (ta, tb, order)))
        at += 1
    _, _, sums, tree = heap[0]
    where: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(parts)
    todo = [(tree, np.arange(k))]  # label of each sorted position of the node
    while todo:
        (left, right, order), label = todo.pop()
        before = np.empty(k, dtype=np.int64)  # label of each position before the node's sort
        before[order] = label
        if right is None:
            where[left] = before
        else:
            todo.append((left, before))
            todo.append((right, before[::-1]))
    return sums, where


def _difference_items(sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Subset of each item and the k sums: blocks of items first, then the blocks."""
    labels = np.zeros(len(sizes), dtype=np.int64)
    blocks, spans = [], []
    order = np.argsort(-sizes, kind="stable")
    n_blocks = max(1, -(-len(sizes) // BLOCK))
    for b in range(n_blocks):
        own = order[b::n_blocks]  # large and small items in each block
        parts = []
        for size in sizes[own]:
            one = np.zeros(k, dtype=np.int64)
            one[-1] = size
            parts.append(one)
        sums, where = difference(parts)
        labels[own] = [w[-1] for w in where]
        blocks.append(sums)
        spans.append(own)
    if n_blocks == 1:
        return labels, blocks[0]
    sums, where = difference(blocks)
    for own, w in zip(spans, where):
        labels[own] = w[labels[own]]
    return labels, sums


def _whole_limit(large: list[int], bundles: list[int], n_shards: int, mean: float, floor: float) -> float:
    """Size up to which groups stay whole: one mean shard, or less where that leaves a wide spread."""
    limit = mean
    while True:
        sizes = list(bundles)
        for size in large:
            n = _pieces(size, limit)
            sizes += [size // n] * n
        _, sums = _difference_items(np.array(sizes, dtype=np.int64), n_shards)
        if limit / 2 < floor or sums.max() - sums.min() <= SPREAD * mean:
            return limit
        limit /= 2


def _pieces(size: int, limit: float) -> int:
    return 1 if size <= limit else math.ceil(4 * size / limit)


def shard_items(rows: DataFrame, n_shards: int) -> DataFrame:
    """rows (_key, _row, size, ...) -> rows with ``shard``, those of one _key together as
    far as near equal bytes allow."""
    spark = rows.sparkSession
    grain = max(10, min(GRAIN, 40 * GRAIN // n_shards))
    mean = int(rows.agg(F.sum("size")).first()[0] or 0) / n_shards
    if not mean:
        return rows.withColumn("shard", F.lit(0)).limit(0)
    bundle = F.pmod(F.xxhash64("_key"), F.lit(grain * n_shards))
    groups = written(rows.groupBy("_key").agg(F.sum("size").alias("_size")).withColumn("_bundle", bundle), "shard-groups")
    large = [(bytes(r["_key"]), r["_size"])
             for r in groups.filter(F.col("_size") > mean / grain).collect()]  # at most grain * n_shards rows
    bundles = [r["s"] for r in groups.filter(F.col("_size") <= mean / grain).groupBy("_bundle")
               .agg(F.sum("_size").alias("s")).collect()]
    limit = _whole_limit([size for _, size in large], bundles, n_shards, mean, mean / grain)
    pieces = spark.createDataFrame([(key, _pieces(size, limit)) for key, size in large], "_key binary, _n int")
    piece = F.when(F.col("_n").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("doc_id", "_row"), F.col("_n")).cast("int"))
    item = F.struct(F.when(F.col("_n").isNull(), bundle.cast("string")).otherwise(F.hex("_key")).alias("of"),
                    piece.alias("piece"))
    items = rows.join(F.broadcast(pieces), "_key", "left").withColumn("_item", item).drop("_n")
    sums = sorted((r["_item"]["of"], r["_item"]["piece"], r["s"])
                  for r in items.groupBy("_item").agg(F.sum("size").alias("s")).collect())
    labels, _ = _difference_items(np.array([s for _, _, s in sums], dtype=np.int64), n_shards)
    final = spark.createDataFrame([((of, n), int(x)) for (of, n, _), x in zip(sums, labels)],
                                  "_item struct<of:string,piece:int>, shard int")
    return items.join(F.broadcast(final), "_item").drop("_item")


def shard_documents(docs: DataFrame, n_shards: int = 40, overhead: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per document row."""
    spark = docs.sparkSession
    rows = written(docs.select("doc_id", F.monotonically_increasing_id().alias("_row"), (F.octet_length(text_of()) + F.lit(overhead)).cast("long").alias("size"),
                               F.crc32(text_of().cast("binary")).alias("text_crc32"),
                               F.unhex(F.md5(text_of().cast("binary"))).alias("_key")), "shard-rows")
    placed = written(shard_items(rows, n_shards)
                     .select("doc_id", "size", "text_crc32", "shard",
                             F.pmod(F.xxhash64("doc_id"), F.lit(range_partitions(spark))).cast("int").alias("_cell")),
                     "shard-placed")
    # slots: places inside a cell, after the rows of the shard's earlier cells
    cells = placed.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("shard", "_cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("shard", "_cell").orderBy("doc_id", "text_crc32")
    return (placed.withColumn("_at", F.row_number().over(inside)).join(starts, ["shard", "_cell"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
                    (F.col("_start") + F.col("_at") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
