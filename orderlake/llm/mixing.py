"""Mixing sources to target weights by capped water-filling (native expressions only).

Targets: the budget is shared by weight; a source whose share exceeds its maximum epochs
is clamped there and the excess is shared again among the others by weight, until no
share is above its cap. Only three sums leave the executors per round.

Sampling: a source's rate is its target over its size. Every document is taken
``floor(rate)`` times in full; the fractional repetition takes the documents of a seeded
order up to the remaining words, each in full, and then the largest documents that fit
into what is left. The order is found by distributed bins: a
source's documents are dealt to bins by their seeded hash, the bins' sums give the place
of the cut, and only the documents of the one bin with the cut are ordered.

Defined results: null text has size 0; null is a source of its own, ranked last; a source
without words has target 0; repeated rows are mixed as rows of their own; rows of one id
or of none draw by their texts, so they spread over the bins; very long texts count whole;
an empty table gives an empty result; extra columns are kept out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import n_words, with_global_rank, written

BINS = 4096


def seeded_draw(seed: int, *cols: Column) -> Column:
    """A 60-bit number from the seed and the columns (same in SQL engines with MD5)."""
    parts = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(parts), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget_percent: int = 150,
                   max_epochs: int = 2) -> DataFrame:
    """(source, source_size, target, whole, extra): one row per source."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_global_rank(sums, [F.col("source").asc_nulls_last()])
    pick = F.array(*[F.lit(w).cast("long") for w in weights])
    s = written(ranked.select("source", "source_size",
                              F.get(pick, (F.col("rank") % len(weights)).cast("int")).alias("weight"),
                              (F.col("source_size") * max_epochs).alias("cap")), "mixing-sources")
    total = int(s.agg(F.sum("source_size")).first()[0] or 0)
    # a share is weight * num / den, in whole numbers until the last division
    clamped, num, den = F.lit(False), 0, 1
    while True:
        free = s.filter(~clamped).agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n")).first()
        fixed = int(s.filter(clamped).agg(F.sum("cap")).first()[0] or 0)
        if not free["n"]:
            break
        num, den = budget_percent * total - 100 * fixed, 100 * int(free["w"])
        share = F.col("weight").cast("double") * F.lit(float(num)) / F.lit(float(den))
        above = s.filter(~clamped & (share > F.col("cap"))).count()
        if not above:
            break
        clamped = clamped | (share > F.col("cap"))
    share = F.col("weight").cast("double") * F.lit(float(num)) / F.lit(float(den))
    target = F.when(clamped, F.col("cap").cast("double")).otherwise(share)
    whole = (F.when(clamped, F.lit(max_epochs)).when(F.col("source_size") == 0, F.lit(0))
             .otherwise(F.floor(target / F.col("source_size"))).cast("long"))
    return (s.withColumn("target", target).withColumn("whole", whole)
            .withColumn("extra", F.when(clamped, F.lit(0.0))
                        .otherwise(F.col("target") - F.col("whole") * F.col("source_size")))
            .select("source", "source_size", "target", "whole", "extra"))


def mix_counts(docs: DataFrame, seed: int = 7, fills: int = 3, **rules) -> DataFrame:
    """Per document row: doc_id, text_hash, size, source_size, target, reps, taken.

    ``fills``: after the cut, so many times the largest untaken document that still fits
    into a source's remaining words is added; then one whose size is nearest to what
    remains, if that brings the source closer to its target."""
    sizes = written(docs.select("doc_id", "source", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
                                n_words(F.col("text")).alias("size"))
                    .withColumn("draw", seeded_draw(seed, F.col("doc_id"), F.col("text_hash")))
                    .withColumn("_row", F.monotonically_increasing_id()), "mixing-sizes")
    targets = written(source_targets(sizes, **rules), "mixing-targets")
    in_bin = F.expr(f"cast(draw div {(1 << 60) // BINS} as int)")
    bins = sizes.groupBy("source", in_bin.alias("bin")).agg(F.sum("size").alias("n"))
    order = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("source").eqNullSafe(F.col("_source"))
    at_cut = (bins.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
              .join(targets.select(F.col("source").alias("_source"), "extra"), same)
              .filter((F.col("before") <= F.col("extra")) & (F.col("n") > 0))
              .groupBy("source").agg(F.max(F.struct("bin", "before")).alias("cut")))
    cuts = written(targets.join(at_cut.select(F.col("source").alias("_source"), "cut"), same, "left")
                   .select(F.col("source").alias("_source"), "source_size", "target", "whole", "extra",
                           F.coalesce("cut.bin", F.lit(-1)).alias("cut_bin"),
                           F.coalesce("cut.before", F.lit(0)).alias("cut_before")), "mixing-cuts")
    placed = sizes.withColumn("bin", in_bin).join(cuts, same)
    clear = placed.filter("bin <> cut_bin").withColumn("more", (F.col("bin") < F.col("cut_bin")).cast("long"))
    inner = Window.partitionBy("source").orderBy("draw", "doc_id", "text_hash", "_row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    edge = placed.filter("bin = cut_bin").withColumn(
        "more", (F.col("cut_before") + F.sum("size").over(inner) <= F.col("extra")).cast("long"))
    base = written(clear.unionByName(edge).select("_row", "doc_id", "text_hash", "source", "size", "draw",
                                                  "source_size", "target", "whole", "extra", "more"), "mixing-cut")
    gap = written(base.groupBy(F.col("source").alias("_source"))
                  .agg((F.max("extra") - F.sum(F.col("size") * F.col("more"))).alias("gap")), "mixing-gap")
    added = None
    for k in range(fills + 1):
        free = base.filter("more = 0 and size > 0")
        if added is not None:
            free = free.join(added, "_row", "left_anti")
        miss = F.abs(F.col("gap") - F.col("size"))
        fit = (free.join(gap, same).filter("size <= gap" if k < fills else "size < 2 * gap").groupBy("_source", "gap")
               .agg(F.min(F.struct(miss, "size", "draw", "doc_id", "text_hash", "_row")).alias("best")))
        step = written(fit.select("_source", "best.size", "best._row"), "mixing-fill")
        rows = step.select("_row")
        added = rows if added is None else added.unionByName(rows)
        gap = written(gap.join(step.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")), "left")
                      .select("_source", (F.col("gap") - F.coalesce("size", F.lit(0))).alias("gap")), "mixing-gap")
    if added is not None:
        base = (base.join(added.withColumn("_fill", F.lit(1).cast("long")), "_row", "left")
                .withColumn("more", F.col("more") + F.coalesce("_fill", F.lit(0))))
    reps = F.col("whole") + F.col("more")
    return base.select("doc_id", "text_hash", "size", "source_size", "target", reps.alias("reps"),
                       (F.col("size") * reps).alias("taken"))


def mix_documents(docs: DataFrame, seed: int = 7, **rules) -> DataFrame:
    """The mixed corpus: each document as many times as it is taken (documents without
    words carry nothing to mix and go)."""
    counts = (mix_counts(docs, seed, **rules).filter("taken > 0")
              .groupBy(F.col("doc_id").alias("_id"), "text_hash").agg(
                  F.count(F.lit(1)).alias("_rows"), F.sum("reps").alias("_sum")))
    # repeated rows share one total, dealt evenly over them
    keyed = docs.withColumn("_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    once = keyed.join(counts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("text_hash")))
    many = Window.partitionBy("_id", "text_hash").orderBy(F.lit(1))
    single = once.filter("_rows = 1").withColumn("_n", F.col("_sum"))
    several = (once.filter("_rows > 1").withColumn("_k", F.row_number().over(many))
               .withColumn("_n", F.expr("_sum div _rows + if(_k <= _sum % _rows, 1, 0)")).drop("_k"))
    return (single.unionByName(several).filter("_n > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
            .select(*docs.columns))
