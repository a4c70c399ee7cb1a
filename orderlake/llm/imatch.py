"""Document fingerprints by I-Match (native column expressions only).

The lexicon holds the terms in a band of inverse document frequency: a term is in it if
between ``low`` and ``high`` of all distinct texts hold it, so copies of a text do not
push its terms out of the band. A document's terms in the lexicon are sorted and hashed under several randomised subsets of the lexicon; the list of those
hashes is its fingerprint. Subsets keep a term with chance 1/2, 1/4 ... 1/256 (four seeds
each), so that some subsets hold only a few of a document's terms, whatever its length,
and survive an edit. The likeness of two fingerprints is the share of their non-empty
subset hashes that agree. A document with fewer than ``ENOUGH`` terms of the lexicon is
filled up to that many with its own terms of the smallest hashes, so that a vocabulary
outside the band survives an edit too. A document with no term in any subset is hashed
by all of its terms instead.

The lexicon is broadcast: its size has a bound that does not grow with the corpus. The
texts hold D distinct terms on average, so at most D / low terms can be held by a share
``low`` of them.

Each document meets the text of the next one (ascending doc_id) in one range-like
shuffle: every range also gets a copy of the first document of the following range. All
later steps keep that partitioning.

Defined results: null text is empty; a null doc_id sorts first; equal doc_ids order by
text hash; repeated rows follow each other; texts of any length give all their terms; an
empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import range_partitions, text_of, written

SEEDS = 4
LEVELS = 8
ENOUGH = 16
TERM_BREAK = r"[\x20\x09-\x0D.,;:!?\"'()]+"
_FIRST = -(1 << 63)


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-case terms."""
    return F.array_distinct(F.transform(F.array_remove(F.split(F.lower(text), TERM_BREAK), ""), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, low: float = 0.0005, high: float = 0.05) -> DataFrame:
    """(h, df): terms held by at least two rows and by low .. high of all."""
    return _band(docs.select(terms(text_of()).alias("terms")), low, high)


def text_lexicon(docs: DataFrame, low: float = 0.0005, high: float = 0.05) -> DataFrame:
    """The lexicon of the distinct texts: each text counts once, whatever its copies."""
    texts = docs.select(F.xxhash64(text_of()).alias("t"), terms(text_of()).alias("terms")).dropDuplicates(["t"])
    return _band(written(texts.select("terms"), "imatch-texts"), low, high)


def _band(held_by: DataFrame, low: float, high: float) -> DataFrame:
    n = held_by.count()
    held = held_by.select(F.explode("terms").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    return held.filter((F.col("df") >= max(2.0, low * n)) & (F.col("df") <= max(2.0, high * n)))


def _in_subset(terms_left: Column, seed: int, level: int) -> Column:
    bit = 1 << (level - 1)
    return F.filter(terms_left, lambda t: F.xxhash64(t, F.lit(seed)).bitwiseAND(F.lit(bit)) == 0)


def with_subset_hashes(df: DataFrame, sets: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds a fingerprint column for each entry of ``sets``: name -> (column of sorted
    distinct terms, hash of all terms that stands in when all subsets are empty). Each level
    halves the terms the level before it kept, one projection per level."""
    for level in range(1, LEVELS + 1):
        df = df.select("*", *[
            _in_subset(F.col(c if level == 1 else f"_{name}_{seed}_{level - 1}"), seed, level).alias(f"_{name}_{seed}_{level}")
            for name, (c, _) in sets.items() for seed in range(SEEDS)])
    out = []
    for name, (c, whole) in sets.items():
        parts = [F.col(f"_{name}_{seed}_{level}") for seed in range(SEEDS) for level in range(1, LEVELS + 1)]
        hashed = [F.when(F.size(p) == 0, F.lit("-")).otherwise(_hex32(F.xxhash64(p))) for p in parts]
        alone = F.array_repeat(F.when(whole.isNull(), F.lit("-")).otherwise(_hex32(whole)), SEEDS * LEVELS)
        # the deeper levels keep a part of level 1
        none = reduce(lambda x, y: x & y, [F.size(f"_{name}_{seed}_1") == 0 for seed in range(SEEDS)])
        out.append(F.when(none, alone).otherwise(F.array(*hashed)).alias(name))
    return df.select(*[x for x in df.columns if not x.startswith(tuple(f"_{n}_" for n in sets))], *out)


def _hex32(h: Column) -> Column:
    return F.lower(F.lpad(F.hex(F.shiftrightunsigned(h, 32)), 8, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of the subsets non-empty in either that agree; two empty fingerprints agree."""
    both = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    seen = F.filter(both, lambda p: (p["x"] != "-") | (p["y"] != "-"))
    same = F.filter(seen, lambda p: p["x"] == p["y"])
    return F.when(F.size(seen) == 0, F.lit(1.0)).otherwise(F.size(same) / F.size(seen))


def with_next_document(docs: DataFrame) -> DataFrame:
    """Columns _pid, _g (0: the document, 1 or 2: a copy of the next range's first one),
    _k (sort key of doc_id), _h, doc_id, _t and _next (text of the next document)."""
    spark = docs.sparkSession
    partitions = range_partitions(spark)
    n = 4 * partitions  # ranges are hashed to partitions: several each, to even out
    key = F.coalesce(F.col("doc_id"), F.lit(_FIRST).cast("long"))
    at = [k / n for k in range(1, n)]
    bounds = sorted(set((docs.select(key.alias("k")).agg(F.percentile_approx("k", at, 10 * max(n, 100)).alias("q"))
                         .first()["q"] or []) if at else []))
    # range of a key: how many bounds are <= key, by binary search
    steps = [1 << k for k in reversed(range(max(1, len(bounds)).bit_length()))]
    edges = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    pid = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda p, s: F.when(F.coalesce(F.get(edges, p + s - 1) <= F.col("_k"), F.lit(False)), p + s).otherwise(p))
    base = docs.select("doc_id", text_of().alias("_t"), key.alias("_k")).withColumn("_home", pid)
    first = {r["_home"]: r["k"] for r in base.groupBy("_home").agg(F.min("_k").alias("k")).collect()}
    used = sorted(first)
    goes = {p: used[i - 1] for i, p in enumerate(used)}  # the first range's goes to the last
    size = len(bounds) + 1
    firsts = F.array(*[F.lit(first.get(p)).cast("long") for p in range(size)])
    dest = F.array(*[F.lit(goes.get(p, 0)) for p in range(size)])
    own = F.struct(F.col("_home").alias("p"), F.lit(0).alias("g"))
    copy = F.struct(F.get(dest, F.col("_home")).alias("p"),
                    F.when(F.col("_home") == (used[0] if used else 0), F.lit(2)).otherwise(F.lit(1)).alias("g"))
    put = base.withColumn("_to", F.explode(F.when(F.get(firsts, F.col("_home")) == F.col("_k"), F.array(own, copy))
                                           .otherwise(F.array(own))))
    dealt = put.select("doc_id", "_t", "_k", F.xxhash64("_t").alias("_h"), F.col("_to.p").alias("_pid"),
                       F.col("_to.g").alias("_g")).repartition(partitions, "_pid")
    return dealt.withColumn("_next", F.coalesce(F.lead("_t").over(
        Window.partitionBy("_pid").orderBy("_g", "_k", "_h")), F.lit("")))


def fingerprints(docs: DataFrame, low: float = 0.0005, high: float = 0.05) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    words = written(text_lexicon(docs, low, high).select("h").unionByName(
        docs.sparkSession.range(1).select(F.lit(0).cast("long").alias("h"))).distinct(), "imatch-lexicon")
    n = F.length("_t")
    quarter = F.floor(n / 4).cast("int")
    edited = with_next_document(docs).withColumn(
        "_e", F.concat(F.substr("_t", F.lit(1), n - quarter), F.substr("_next", F.lit(1), quarter)))
    sets = edited.select(
        "_pid", "_g", "_k", "_h", F.monotonically_increasing_id().alias("_row"),
        F.struct("doc_id", n.cast("long").alias("n_chars"), F.sha2("_e", 256).alias("sha")).alias("_info"),
        terms(F.col("_t")).alias("_a"), terms(F.col("_e")).alias("_b"))
    tag = lambda c, bits: F.transform(c, lambda h: F.struct(
        h.alias("h"), F.lit(bits).alias("in"), F.lit(None).cast(
            "struct<doc_id:bigint,n_chars:bigint,sha:string,a:bigint,b:bigint,fa:array<bigint>,fb:array<bigint>>").alias("info")))
    whole = lambda c: F.when(F.size(c) > 0, F.xxhash64(F.sort_array(c)))
    fill = lambda c: F.slice(F.sort_array(c), 1, ENOUGH)
    # hash 0 stands for the document itself; it is in the lexicon, so no document is lost
    self_row = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("in"), F.struct(
        F.col("_info.doc_id"), F.col("_info.n_chars"), F.col("_info.sha"), whole("_a").alias("a"),
        whole("_b").alias("b"), fill("_a").alias("fa"), fill("_b").alias("fb")).alias("info"))
    rows = sets.select("_pid", "_g", "_k", "_h", "_row", F.explode(F.concat(
        F.array(self_row), tag(F.array_intersect("_a", "_b"), 3), tag(F.array_except("_a", "_b"), 1),
        tag(F.array_except("_b", "_a"), 2))).alias("t"))
    kept = (rows.select("_pid", "_g", "_k", "_h", "_row", "t.h", "t.in", "t.info")
            .join(F.broadcast(words), "h")
            .groupBy("_pid", "_row").agg(
                F.first("_g").alias("_g"), F.first("_k").alias("_k"), F.first("_h").alias("_h"),
                F.max("info").alias("i"),
                F.collect_list(F.when(F.col("in").bitwiseAND(1) > 0, F.col("h"))).alias("a"),
                F.collect_list(F.when(F.col("in").bitwiseAND(2) > 0, F.col("h"))).alias("b")))
    filled = lambda c, own: F.sort_array(F.when(F.size(c) >= ENOUGH, F.col(c)).otherwise(F.concat(
        c, F.slice(F.array_except(own, c), F.lit(1), F.greatest(F.lit(ENOUGH) - F.size(c), F.lit(0))))))
    ordered = kept.select("_pid", "_g", "_k", "_h", "_row", "i", filled("a", "i.fa").alias("a"), filled("b", "i.fb").alias("b"))
    prints = with_subset_hashes(ordered, {"fp": ("a", F.col("i.a")), "efp": ("b", F.col("i.b"))}).drop("a", "b")
    following = prints.withColumn("nfp", F.lead("fp").over(Window.partitionBy("_pid").orderBy("_g", "_k", "_h", "_row")))
    return following.filter("_g = 0").select(
        F.col("i.doc_id").alias("doc_id"), F.col("i.n_chars").alias("n_chars"), F.col("i.sha").alias("edited_sha256"),
        F.array_join("fp", ",").alias("fingerprint"), F.array_join("efp", ",").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"), likeness(F.col("fp"), F.col("nfp")).alias("near_next"))
