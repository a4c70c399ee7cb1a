"""Quality rules by cross-document line frequency (native column expressions only).

Lines are normalised and hashed, the distinct documents that hold a line are counted per
host (``source``), lines above the limits are removed, and a document that loses most of
its words is rejected.

Two points keep clean documents:

- A line's limit is the larger of ``min_docs`` documents and ``max_share`` of the host's
  documents, so it means the same at every corpus size.
- Exact copies of one document are one document here (removing copies is the
  near-dedup's work): the documents of a line and of a host are counted by the hash of
  their whole text.

Defined results: null text is an empty text (no words, base_failed); a null host is a
host of its own; repeated rows are judged alike; a line held by exactly its limit of
documents stays, and so does a document that loses exactly the share allowed; texts of any
length are judged whole; an empty table gives an empty result; extra columns do not matter
(columns are taken by name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import WS_CHARS, WS_PATTERN, text_of, words, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"


def normalised_line(line: Column) -> Column:
    """Lower case, digits as one class, white space as single spaces."""
    return F.translate(F.lower(F.trim(F.regexp_replace(line, WS_PATTERN, " "))), "123456789", "000000000")


def line_features(docs: DataFrame) -> DataFrame:
    """One row per document: base counts and its lines (hash, words), all computed inside
    the row; no shuffle, and no text in the result."""
    blank = F.lit("")
    base = docs.select("doc_id", F.col("source").alias("_source"), text_of().alias("_t"))
    split = base.select(
        "doc_id",
        F.when(F.col("_source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("h"), F.col("_source"))).alias("host"),
        F.xxhash64("_t").alias("text_hash"),
        F.length(F.translate("_t", WS_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.transform(words(F.col("_t")), lambda w: F.xxhash64(w)).alias("_h"),
        F.filter(F.split("_t", "\n"), lambda x: F.translate(x, WS_CHARS, "") != blank).alias("_lines"))
    hashed = split.select(
        "doc_id", "host", "text_hash", "word_chars", "n_symbols", F.size("_h").cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_lines", lambda x: F.struct(
            F.xxhash64(normalised_line(x)).alias("h"),
            F.size(words(x)).alias("w"))).alias("lines"),
        F.when(F.size("_h") >= 3,
               F.transform(F.sequence(F.lit(0), F.size("_h") - 3),
                           lambda i: F.xxhash64(F.get("_h", i), F.get("_h", i + 1), F.get("_h", i + 2))))
        .otherwise(F.array().cast("array<bigint>")).alias("_g"))
    # windows sorted by hash: a repeated one has an equal neighbour
    ordered = hashed.withColumn("_s", F.when(
        F.size(F.array_distinct("_g")) < F.size("_g"),
        F.sort_array(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    places = ordered.withColumn("_p", F.sort_array(F.transform(
        F.filter("_s", lambda s, i: (F.get("_s", i - 1)["g"] == s["g"]) | (F.get("_s", i + 1)["g"] == s["g"])),
        lambda s: s["i"])))
    repeated = F.aggregate(
        "_p", F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("at"), (a["n"] + F.least(F.lit(3), p - a["at"])).alias("n")),
        lambda a: a["n"].cast("long"))
    return places.select("doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         F.coalesce(repeated, F.lit(0).cast("long")).alias("n_repeat_words"), "lines")


def frequent_lines(features: DataFrame, min_docs: int = 20, max_share: float = 0.05) -> DataFrame:
    """(host, h, n_docs): lines held by more distinct documents of their host than its limit.

    Both counts are aggregates with map-side partial sums, so neither a hot line nor a
    hot host reaches one task in full."""
    held = features.select("host", "text_hash", F.explode(F.array_distinct("lines.h")).alias("h")).distinct()
    per_line = (held.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n_docs"))
                .filter(F.col("n_docs") > min_docs))
    hosts = (features.select("host", "text_hash").distinct()
             .groupBy("host").agg(F.count(F.lit(1)).alias("host_docs")))
    return (per_line.join(hosts, "host").filter(F.col("n_docs") > F.col("host_docs") * F.lit(max_share))
            .select("host", "h", "n_docs"))


def quality_rules(docs: DataFrame, min_docs: int = 20, max_share: float = 0.05,
                  max_lost_percent: int = 50) -> DataFrame:
    """Verdict per document: base counts, words removed with frequent lines, ``kept``, and
    the hashes of its frequent lines (``cut_lines``)."""
    features = written(line_features(docs).withColumn("_row", F.monotonically_increasing_id()), "quality-features")
    frequent = written(frequent_lines(features, min_docs, max_share), "quality-frequent")
    lost = (features.select("_row", "host", F.explode("lines").alias("l"))
            .select("_row", "host", F.col("l.h").alias("h"), F.col("l.w").alias("w"))
            .join(frequent.select("host", "h"), ["host", "h"])
            .groupBy("_row").agg(F.sum("w").alias("n_cut_words"), F.collect_set("h").alias("cut_lines")))
    out = features.drop("lines").join(lost, "_row", "left").drop("_row")
    cut = F.coalesce("n_cut_words", F.lit(0)).cast("long")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (out.withColumn("n_cut_words", cut)
            .withColumn("cut_lines", F.coalesce("cut_lines", F.array().cast("array<bigint>")))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & ~(100 * F.col("n_cut_words") > max_lost_percent * F.col("n_words"))))


def filter_documents(docs: DataFrame, **limits) -> DataFrame:
    """The kept documents, without their frequent lines (other lines stay byte for byte)."""
    verdict = (quality_rules(docs, **limits).filter("kept")
               .select(F.col("doc_id").alias("_id"), "text_hash", "cut_lines")
               .dropDuplicates(["_id", "text_hash"]))
    keyed = docs.withColumn("_hash", F.xxhash64(text_of()))
    joined = keyed.join(verdict, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("text_hash")))
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(
        F.col("cut_lines"), F.xxhash64(normalised_line(x)))), "\n")
    cleaned = F.when(F.size("cut_lines") > 0, left).otherwise(F.col("text"))
    out = joined.withColumn("text", cleaned)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("cut_lines") > 0, F.length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
