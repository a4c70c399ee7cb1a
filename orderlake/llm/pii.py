"""Personal data by bootstrapped contextual extraction (native column expressions only).

1. Base patterns find the seed entities (email, ip, card, phone), with their checks.
2. Tokens that look like identifiers, and numbers written in groups, give instances; the
   one or two words before them give lexical patterns (an identifier that follows another
   one shares its context). Edges join patterns and instances.
3. Rounds of scoring: a pattern's confidence for a kind is the share of its instances
   that are believed to be of that kind; an instance's belief is the noisy-or of its
   confident patterns. Seeds are always believed.
4. Instances believed at ``accept`` or more, and shaped like their kind, are added.

Positions of matches are running sums over the pieces between them (split and extract by
the same pattern). Running values are taken in two levels (``scan``), blocks of sqrt(n)
matches, so that no array is copied per match; contexts are read from the pieces and
redacted texts are cut block by block, so no text is walked from its start per match. The
patterns start only where a run of their characters starts, which keeps them linear on
very long runs. Texts stay where they are read: only spans, tokens and two context words
per token are shuffled.

Defined results: null text is empty (no spans); repeated rows get the same spans; a null
doc_id keeps its row; very long texts are read whole; of kinds believed alike the first
listed is taken; an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import WS_PATTERN, text_of, written

KINDS = ["email", "ip", "card", "phone"]

# Each pattern as in its contract, with run starts and possessive runs for linear time.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
# A number in groups of two to four digits, as phones and cards are written.
GROUPS = (r"(?<![^\x20\x09-\x0D])\(?[0-9]{2,4}+\)?+(?:[\x20.-]{1,2}+[0-9]{2,4}+){2,5}+"
          r"(?=[^A-Za-z0-9@\x20\x09-\x0D]*(?:[\x20\x09-\x0D]|\z))")
# What an unseen identifier of a kind must look like.
SHAPES = {
    "email": r"^[^@]+@[^@]+$",
    "ip": r"^(?:[0-9]+(?:\.[0-9]+){2,}|[0-9a-fA-F]{0,4}(?::[0-9a-fA-F]{0,4}){2,7})$",
    "card": r"^[0-9](?:[\x20-]?[0-9]){11,18}$",
    "phone": r"^\(?[0-9]{2,4}\)?(?:[\x20.-]{0,2}[0-9]{2,4}){2,4}$",
}
CONTEXT = 80  # characters of a gap in which the context words are looked for

_SPANS = "array<struct<a:int,b:int,m:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blocks(p: Column) -> tuple[Column, Callable[[Column], Column]]:
    """Numbers of the blocks of sqrt(n) elements of a non-empty array, and the block of a number."""
    size = F.ceil(F.sqrt(F.size(p))).cast("int")
    return (F.sequence(F.lit(0), (F.ceil(F.size(p) / size) - 1).cast("int")),
            lambda c: F.slice(p, c * size + 1, size))


def scan(items: Column, zero: Column, step: Callable, emit: Callable, out: str, state: str) -> Column:
    """``emit(state, x)`` of every element, ``state`` being ``step`` folded over those before
    it. The states at the starts of the blocks are folded first, then every block on its
    own, so arrays of sqrt(n) elements are the longest that grow."""
    none = lambda kind: F.array().cast(f"array<{kind}>")

    def run(p: Column) -> Column:
        numbers, block = blocks(p)
        starts = F.aggregate(
            numbers, F.struct(zero.alias("s"), none(state).alias("o")),
            lambda acc, c: F.struct(F.aggregate(block(c), acc["s"], step).alias("s"),
                                    F.concat(acc["o"], F.array(acc["s"])).alias("o")), lambda acc: acc["o"])
        each = F.transform(starts, lambda at, c: F.aggregate(
            block(c), F.struct(at.alias("s"), none(out).alias("o")),
            lambda acc, x: F.struct(step(acc["s"], x).alias("s"), F.concat(acc["o"], F.array(emit(acc["s"], x))).alias("o")),
            lambda acc: acc["o"]))
        return F.flatten(each)

    return let(items, lambda p: F.when(F.size(p) > 0, run(p)).otherwise(none(out)))


def matches(text: Column, pattern: str, gaps: bool = False) -> Column:
    """All leftmost non-overlapping matches as (a, b, m) structs, with ``gaps`` also the
    text before each since the match before it; and no Python."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(found, F.split(text, pattern, -1), lambda m, gap: F.struct(
        m.alias("m"), F.length(gap).alias("g"), F.length(m).alias("n"), *([gap.alias("t")] if gaps else [])))
    at = lambda s, x: F.struct((s + x["g"]).alias("a"), (s + x["g"] + x["n"]).alias("b"), x["m"].alias("m"),
                               *([x["t"].alias("t")] if gaps else []))
    return scan(F.filter(pairs, lambda p: p["m"].isNotNull()), F.lit(0), lambda s, x: s + x["g"] + x["n"], at,
                "struct<a:int,b:int,m:string,t:string>" if gaps else "struct<a:int,b:int,m:string>", "int")


def luhn(digits: Column) -> Column:
    backwards = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, F.substr(backwards, i, F.lit(1)).cast("int"))
        .otherwise(F.get(F.array(*[F.lit(d) for d in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                         F.substr(backwards, i, F.lit(1)).cast("int"))))
    return total % 10 == 0


def valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$")
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> dict[str, Column]:
    hint = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+")),
            "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9][\x20-]?[0-9]")}
    none = F.array().cast(_SPANS)
    checked = lambda kind: F.filter(matches(text, PATTERNS[kind]), lambda s: valid(kind, s["m"]))
    return {k: F.when(hint[k], checked(k)).otherwise(none) for k in KINDS}


def _context(gap: Column) -> Column:
    tail = F.transform(F.array_remove(F.split(F.lower(F.right(gap, F.lit(CONTEXT))), WS_PATTERN), ""),
                       lambda w: F.regexp_replace(w, r"[^\p{L}\p{N}]+$|^[^\p{L}\p{N}]+", ""))
    return F.filter(tail, lambda w: w != "")


def first_over(spans: Column, a: Column, b: Column) -> Column:
    """The first of the spans (in order, none overlapping) that overlaps a..b, else null:
    its block by the blocks' last ends, then within the block."""
    numbers, block = blocks(spans)
    n, size = F.size(spans), F.ceil(F.sqrt(F.size(spans))).cast("int")
    gone = F.size(F.filter(numbers, lambda c: F.get(spans, F.least((c + 1) * size, n) - 1)["b"] <= a))
    near = F.get(F.filter(block(gone), lambda x: x["b"] > a), F.lit(0))
    return F.when((F.size(spans) > 0) & (near["a"] < b), near)


def features(docs: DataFrame) -> DataFrame:
    """Per document: its key, base spans by kind, and identifier-like tokens with their
    two context words. Computed inside the row."""
    t = docs.select("doc_id", text_of().alias("_t"))
    spans = t.select("doc_id", F.xxhash64("_t").alias("text_hash"), "_t", *[
        c.alias(k) for k, c in base_spans(F.col("_t")).items()])
    tag = lambda n, kind: F.transform(kind, lambda s: F.struct(
        F.lit(n).alias("k"), s["a"].alias("a"), s["b"].alias("b"), s["m"].alias("m")))
    all_base = F.concat(*[tag(n, k) for n, k in enumerate(KINDS)])
    flat = spans.select("doc_id", "text_hash", all_base.alias("base"), *[
        F.transform(k, lambda x: F.struct(x["a"], x["b"], x["m"])).alias(k) for k in KINDS],
        F.when(F.col("_t").rlike("[0-9@]"), F.transform(matches(F.col("_t"), f"(?:{GROUPS}|{TOKEN})", gaps=True), lambda s: F.struct(
            s["a"].alias("a"), s["b"].alias("b"), s["m"].alias("m"), _context(s["t"]).alias("w")))).alias("_tokens"))
    # the words before a token, or before the identifiers it follows at once
    words = "array<string>"
    last = lambda s, x: F.when(F.size(x["w"]) > 0, x["w"]).otherwise(s)
    cut = flat.withColumn("_cand", F.when(F.col("_tokens").isNotNull(), scan(
        F.col("_tokens"), F.array().cast(words), last,
        lambda s, x: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["m"].alias("m"), last(s, x).alias("w")),
        f"struct<a:int,b:int,m:string,w:{words}>", words)).otherwise(F.array().cast(f"array<struct<a:int,b:int,m:string,w:{words}>>")))
    # a token inside a base span but not at its start is part of that span
    own = lambda s: F.coalesce(*[
        let(first_over(F.col(k), s["a"], s["b"]), lambda x: F.when(x.isNotNull(), F.struct(
            F.lit(n).alias("k"), x["a"].alias("a"), x["b"].alias("b"), x["m"].alias("m")))) for n, k in enumerate(KINDS)])
    bare = lambda m: F.lower(F.regexp_replace(m, r"^[^A-Za-z0-9@:(]+|[^A-Za-z0-9:)]+$", ""))
    lead = lambda m: F.length(m) - F.length(F.regexp_replace(m, r"^[^A-Za-z0-9@:(]+", ""))
    seeded = cut.withColumn("_seeded", F.transform("_cand", lambda s: F.struct(
        s["a"].alias("a0"), s["m"].alias("m"), s["w"].alias("w"), own(s).alias("o"))))
    kept = F.filter("_seeded", lambda s: (F.size(s["w"]) > 0) & (s["o"].isNull() | (s["o"]["a"] >= s["a0"])))
    cand = F.transform(kept, lambda s: F.struct(
        (s["a0"] + lead(s["m"])).alias("a"),
        F.coalesce(F.lower(s["o"]["m"]), bare(s["m"])).alias("instance"),
        F.coalesce(s["o"]["k"], F.lit(-1)).alias("seed"),
        F.element_at(s["w"], -1).alias("w1"),
        F.when(F.size(s["w"]) > 1, F.concat_ws(" ", F.get(s["w"], F.size(s["w"]) - 2), F.element_at(s["w"], -1))).alias("w2")))
    shaped = F.filter(cand, lambda c: (c["seed"] >= 0) | ((F.length(c["instance"]) >= 6) & reduce(
        lambda x, y: x | y, [c["instance"].rlike(SHAPES[k]) for k in KINDS])))
    return seeded.select("doc_id", "text_hash", "base", shaped.alias("cand")).select(
        "doc_id", "text_hash", F.transform("base", lambda s: F.struct(s["k"], s["a"], s["b"])).alias("base"), "cand")


def score_graph(occurrences: DataFrame, rounds: int = 3, min_support: int = 5, min_confidence: float = 0.6,
                accept: float = 0.8) -> DataFrame:
    """(instance, kind, belief) of unseen identifiers. ``occurrences``: instance, seed
    (kind number or -1), w1, w2. Edges are distinct before anything is joined, so a copied
    passage counts once."""
    kinds = F.when(F.col("seed") >= 0, F.array("seed")).otherwise(F.array_compact(F.array(*[
        F.when(F.col("instance").rlike(SHAPES[k]), F.lit(n)) for n, k in enumerate(KINDS)])))
    edges = written(
        occurrences.select("instance", (F.col("seed") >= 0).alias("is_seed"), F.explode(kinds).alias("kind"),
                           F.array_compact(F.array(F.concat(F.lit("1|"), "w1"), F.concat(F.lit("2|"), "w2"))).alias("p"))
        .select("instance", "is_seed", "kind", F.explode("p").alias("pattern")).distinct(), "pii-edges")
    counted = written(edges.groupBy("pattern", "kind").agg(
        F.sum(F.col("is_seed").cast("long")).alias("seeds"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("seeds") >= min_support) & (F.col("seeds") < F.col("n"))), "pii-patterns")
    unseen = written(edges.filter("not is_seed").join(counted, ["pattern", "kind"])
                     .select("pattern", "kind", "instance", "seeds", "n"), "pii-unseen")
    belief = None
    for _ in range(rounds):
        if belief is None:
            held = unseen.withColumn("belief", F.lit(0.0))
        else:
            held = unseen.join(belief, ["instance", "kind"], "left").fillna(0.0, ["belief"])
        confident = (held.groupBy("pattern", "kind").agg(
            ((F.max("seeds") + F.sum("belief")) / (F.max("n") + 1)).alias("confidence"))
            .filter(F.col("confidence") >= min_confidence))
        belief = written(unseen.join(confident, ["pattern", "kind"]).groupBy("instance", "kind").agg(
            (1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("belief")), "pii-belief")
    return belief.filter(F.col("belief") >= accept)


def find_pii(docs: DataFrame, **scoring) -> DataFrame:
    """doc_id, text_hash, base and spans: arrays of (k, a, b) in the order of KINDS, then
    start; ``spans`` holds the base spans and the added ones."""
    feats = written(features(docs).withColumn("_row", F.monotonically_increasing_id()), "pii-features")
    occurrences = (feats.filter(F.size("cand") > 0).select("_row", F.explode("cand").alias("c")).select("_row", "c.*"))
    found = score_graph(occurrences, **scoring)
    # one kind per instance: the most believed one
    best = written(found.groupBy("instance").agg(
        F.max(F.struct("belief", (-F.col("kind")).alias("k"))).alias("best"))
        .select("instance", (-F.col("best.k")).alias("k")), "pii-found")
    added = (occurrences.filter("seed < 0").join(best, "instance").groupBy("_row").agg(F.collect_set(F.struct(
        "k", "a", (F.col("a") + F.length("instance")).alias("b"))).alias("added")))
    return (feats.join(added, "_row", "left")
            .select("doc_id", "text_hash", F.sort_array("base").alias("base"),
                    F.sort_array(F.concat("base", F.coalesce("added", F.array().cast(
                        "array<struct<k:int,a:int,b:int>>")))).alias("spans")))


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["k"]), s["a"].cast("string"), s["b"].cast("string"))), ",")


def pii_digest(docs: DataFrame, **scoring) -> DataFrame:
    found = find_pii(docs, **scoring)
    count = lambda n: F.size(F.filter("base", lambda s: s["k"] == n)).cast("long")
    return found.select("doc_id", *[count(n).alias(f"n_{k}") for n, k in enumerate(KINDS)],
                        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, **scoring) -> DataFrame:
    """The documents with each span replaced by its kind in brackets; where spans overlap,
    the one that starts first (then the longer) is named and the rest is left out."""
    found = (find_pii(docs, **scoring).filter(F.size("spans") > 0)
             .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_th"), "spans")
             .dropDuplicates(["_id", "_th"]))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(
        s["a"].alias("a"), (-s["b"]).alias("e"), s["k"].alias("k"))))
    # with each span the end of what lies before it; those that start inside are left out
    span = "struct<a:int,b:int,k:int,at:int>"
    ended = scan(by_start, F.lit(0), lambda s, x: F.greatest(s, -x["e"]), lambda s, x: F.struct(
        x["a"].alias("a"), (-x["e"]).alias("b"), x["k"].alias("k"), s.alias("at")), span, "int")
    text = F.col("text")

    def pieces(p: Column) -> Column:
        numbers, block = blocks(p)
        whole = lambda b: let(F.struct(F.get(b, F.lit(0))["at"].alias("from"), F.substr(
            text, F.get(b, F.lit(0))["at"] + 1, F.element_at(b, -1)["a"] - F.get(b, F.lit(0))["at"]).alias("t")), lambda cut: F.array_join(
                F.transform(b, lambda x: F.concat(F.substr(cut["t"], x["at"] - cut["from"] + 1, x["a"] - x["at"]), F.get(names, x["k"]))), ""))
        return F.array_join(F.transform(numbers, lambda c: let(block(c), whole)), "")

    done = let(ended, lambda e: F.concat(let(F.filter(e, lambda x: x["a"] >= x["at"]), pieces),
                                         F.substr(text, F.array_max(F.transform(e, lambda x: x["b"])) + 1)))
    keyed = docs.withColumn("_hash", F.xxhash64(text_of()))
    joined = keyed.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_th")), "left")
    out = joined.withColumn("_new", F.when(F.col("spans").isNotNull(), done).otherwise(F.col("text")))
    cols = [F.col("_new").alias("text") if c == "text" else
            F.when(F.col("spans").isNotNull(), F.length("_new").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
            if c == "n_chars" else F.col(c) for c in docs.columns]
    return out.select(*cols)
