"""Near-duplicate documents by SetSketch registers.

A document's set of word shingles becomes ``REGISTERS`` SetSketch registers: for each
register the smallest of the elements' pseudo-random exponential numbers, put on an
exponentially spaced scale (base ``BASE``) and truncated to 16 bits. Sketches merge by
the larger register. Equal registers are as likely as the sets are similar, so bands of
``ROWS`` registers are hashed to buckets: a pair at the threshold 0.8 misses all of the
40 bands with a chance of about 1e-7. Pairs from the buckets are first judged by the
joint maximum-likelihood estimate of their similarity (five standard errors below the
threshold are passed on), then confirmed on their full sets.

Groups of copies are never expanded into all pairs:

- Equal sets are one node from the start (an aggregate with map-side sums).
- Round 1 links every member of a bucket to the bucket's hub, the member with the most
  bucket neighbours. Verified links give components.
- Round 2 takes the buckets that still span several components. Their members, gathered
  by the hub's component, are dealt to blocks of about ``BLOCK`` sets; the blocks of the
  members outside the hub's component meet the blocks of all members, and a task compares
  two blocks exactly, set by set, and returns at most one link per set and component.

So every pair of a bucket is verified or already connected, and no row is made per pair.

Defined results: documents without words (null or empty texts too) have no shingles and
are linked with nothing; a null doc_id counts as the smallest id (its group has a null
component_id, and rows with a null id are kept); repeated rows are copies of one another;
of equal sets the smallest id stands for all; texts of any length are shingled whole, one
text at a time; an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import text_of, written

REGISTERS, ROWS = 200, 5
BASE, RATE, TOP = 1.001, 20.0, 65534
NO_ID = -(1 << 63)
BLOCK = 128
CACHE = 100_000  # word hashes kept by a worker
SLICE = 1024  # pairs estimated at once
_rng = np.random.default_rng(20240229)
_MUL = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)
_C = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _WordHashes()


def shingles(text: str | None, k: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; words are split at ASCII white
    space and only A-Z are lower-cased. Fewer than k words: the whole sequence as one."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(k, len(h))
    s = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for j in range(size):
        s = (s + h[j:len(h) - size + 1 + j]) * _C[0]
        s ^= s >> np.uint64(29)
    s *= _C[1]
    s ^= s >> np.uint64(32)
    return np.unique(s)


def registers(s: np.ndarray) -> np.ndarray:
    """The SetSketch of a set of 64-bit hashes (all zero for the empty set)."""
    if not len(s):
        return np.zeros(REGISTERS, dtype=np.uint16)
    low = None
    for at in range(0, len(s), 8192):
        part = (_MUL[:, None] * s[None, at:at + 8192] + _ADD[:, None]).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0 ** 64) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def band_keys(regs: np.ndarray, rows: int = ROWS) -> list[int]:
    return [xxhash.xxh3_64_intdigest(regs[i:i + rows].tobytes(), seed=i) - (1 << 63) for i in range(0, len(regs), rows)]


def estimate(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood similarity of pairs (rows of registers, set sizes)."""
    up, down = (ra > rb).sum(axis=1)[:, None], (ra < rb).sum(axis=1)[:, None]
    same = ra.shape[1] - up - down
    u, v = (na / (na + nb))[:, None], (nb / (na + nb))[:, None]
    grid = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    pu, pv = p(u - v * grid), p(v - u * grid)
    tiny = 1e-12
    like = up * np.log(pu + tiny) + down * np.log(pv + tiny) + same * np.log(np.maximum(1 - pu - pv, 0) + tiny)
    return np.take_along_axis(grid, like.argmax(axis=1)[:, None], 1)[:, 0]


def sketch_documents(docs: DataFrame, k: int = 2) -> DataFrame:
    """id, text_hash, n_shingles, sid (hash of the set, null when empty), keys (one per band)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sids, keys = [], [], []
            for t in batch.column("text"):
                s = shingles(t.as_py(), k)
                sizes.append(len(s))
                sids.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None)
                keys.append(band_keys(registers(s)) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(sids, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))], ["id", "text_hash", "n_shingles", "sid", "keys"])

    return (docs.select(F.coalesce("doc_id", F.lit(NO_ID).cast("long")).alias("id"),
                        F.xxhash64(text_of()).alias("text_hash"), "text")
            .mapInArrow(run, "id long, text_hash long, n_shingles long, sid long, keys array<long>"))


def _members(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(sid, text, regs) of the wanted sets, each from its representative document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids, texts, regs = [], [], []
            for sid, text in zip(batch.column("sid").to_pylist(), batch.column("text").to_pylist()):
                s = shingles(text, k)  # texts may share a hash: take the one with this set
                if len(s) and xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) == sid:
                    sids.append(sid)
                    texts.append(text)
                    regs.append(registers(s).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(sids, pa.int64()), pa.array(texts, pa.string()), pa.array(regs, pa.binary())],
                ["sid", "text", "regs"])

    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID).cast("long")).alias("id"),
                        F.xxhash64(text_of()).alias("text_hash"), "text")
    found = texts.join(wanted.select(F.col("rep").alias("id"), F.col("rep_hash").alias("text_hash"), "sid"),
                       ["id", "text_hash"]).select("sid", "text").mapInArrow(
        run, "sid long, text string, regs binary")
    return found.dropDuplicates(["sid"])


def _verify(pairs: DataFrame, members: DataFrame, k: int, percent: int, margin: float) -> DataFrame:
    """(a, b, dist, linked) of the pairs that pass the estimate; dist is exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, None
        for batch in batches:
            out = []
            n = batch.num_rows
            if n:
                a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
                sides = [np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(n, -1)
                         for c in ("ra", "rb")]
                size = [batch.column(c).to_numpy().astype(np.float64) for c in ("na", "nb")]
                close = np.concatenate([estimate(*(x[at:at + SLICE] for x in (*sides, *size)))
                                        for at in range(0, n, SLICE)]) >= percent / 100 - margin
                ta, tb = batch.column("ta"), batch.column("tb")
                for i in np.flatnonzero(close):
                    if b[i] != hub:
                        hub, hub_set = b[i], shingles(tb[i].as_py(), k)
                    s = shingles(ta[i].as_py(), k)
                    both = len(np.intersect1d(s, hub_set, assume_unique=True))
                    union = len(s) + len(hub_set) - both
                    out.append((a[i], b[i], 1 - both / union, 100 * both >= percent * union))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, (pa.int64(), pa.int64(), pa.float64(), pa.bool_()))], ["a", "b", "dist", "linked"])

    side = lambda x: members.select(F.col("sid").alias(x), F.col("text").alias(f"t{x}"), F.col("regs").alias(f"r{x}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .select("a", "b", "na", "nb", "ra", "rb", "ta", "tb")
            .mapInArrow(run, "a long, b long, dist double, linked boolean"))


def _link_blocks(rest: DataFrame, members: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between sets of different components among the members (g, sid, comp)
    of each group g: those outside component g against all members, in blocks."""

    def compare(own: list[dict], all_: list[dict]) -> Iterator[tuple[int, int]]:
        sets = [shingles(m["text"], k) for m in all_]
        sizes = np.array([len(s) for s in sets])
        ids, where = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        comps = np.array([m["comp"] for m in all_])
        mark = np.zeros(len(ids), dtype=np.int32)
        for o in own:
            s = shingles(o["text"], k)
            at = np.searchsorted(ids, s)
            at = at[ids[np.minimum(at, len(ids) - 1)] == s]
            mark[at] = 1
            both = np.add.reduceat(mark[where], starts)
            mark[at] = 0
            linked = (100 * both >= percent * (sizes + len(s) - both)) & (comps != o["comp"])
            _, one = np.unique(comps[linked], return_index=True)
            for i in np.flatnonzero(linked)[one]:
                yield o["sid"], all_[i]["sid"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                out = list(compare(batch.column("own")[i].as_py(), batch.column("all")[i].as_py()))
                cols = list(zip(*out)) or [(), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])

    blocks = lambda n: F.ceil(F.col(n) / F.lit(BLOCK))
    count = written(rest.groupBy(F.col("g").alias("_g")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("comp") != F.col("g")).alias("outside"))
        .filter("outside > 0"), "nd-groups")
    texts = written(rest.join(count, F.col("g") == F.col("_g")).join(members.select("sid", "text"), "sid")
                    .select("g", "sid", "comp", "text", "n", "outside"), "nd-texts")

    def packed(df: DataFrame, n: str, name: str) -> DataFrame:
        return (df.withColumn("blk", F.pmod(F.xxhash64("sid"), blocks(n))).groupBy("g", "blk")
                .agg(F.collect_list(F.struct("sid", "comp", "text")).alias(name)).select("g", name))

    own = written(packed(texts.filter("comp <> g"), "outside", "own"), "nd-own")
    every = written(packed(texts, "n", "all"), "nd-all")
    return own.join(every, "g").select("own", "all").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(sid, comp): for every node of the links (a, b), the smallest node it can reach.
    Neighbour minima with pointer jumping; every round is a written table, so a hub's
    edges can be split and a lost executor costs one round."""
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .distinct(), "nd-edges")
    labels = written(both.groupBy(F.col("a").alias("sid")).agg(F.min("b").alias("m"))
                     .select("sid", F.least("sid", "m").alias("comp")), "nd-labels")
    while True:
        near = (both.join(labels.select(F.col("sid").alias("b"), F.col("comp").alias("c")), "b")
                .groupBy(F.col("a").alias("sid")).agg(F.min("c").alias("near")))
        step = labels.join(near, "sid").select("sid", "comp", F.least("comp", "near").alias("best"))
        jump = labels.select(F.col("sid").alias("best"), F.col("comp").alias("far"))
        new = written(step.join(jump, "best").select("sid", F.col("comp").alias("old"),
                                                     F.least("best", "far").alias("comp")), "nd-labels")
        if new.filter("old <> comp").isEmpty():
            return labels
        labels = new.select("sid", "comp")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, standard_errors: float = 5.0) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document row."""
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return _grouped(docs, k, percent, standard_errors).select(
        real("id").alias("doc_id"), "n_shingles", real("least").alias("component_id"),
        (F.col("id") == F.col("least")).alias("kept"))


def _grouped(docs: DataFrame, k: int = 5, percent: int = 80, standard_errors: float = 5.0) -> DataFrame:
    """id, text_hash, n_shingles, comp (null without words) and the component's least id,
    for every document row."""
    margin = standard_errors * (percent / 100 * (1 - percent / 100) / REGISTERS) ** 0.5
    sketches = written(sketch_documents(docs, k), "nd-sketches")
    sets = (sketches.filter("sid is not null").groupBy("sid")
            .agg(F.min("id").alias("rep"), F.max("n_shingles").alias("n"), F.first("keys").alias("keys")))
    dealt = written(sets.select("sid", "n", F.explode("keys").alias("key")), "nd-bands")
    reps = written(sketches.filter("sid is not null").groupBy("sid").agg(F.min(F.struct("id", "text_hash")).alias("r"))
                   .select("sid", F.col("r.id").alias("rep"), F.col("r.text_hash").alias("rep_hash")), "nd-sets")
    crowded = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    buckets = written(dealt.join(written(crowded, "nd-crowded"), "key"), "nd-buckets")
    degree = written(buckets.groupBy("sid").agg(F.sum("size").alias("degree"), F.max("n").alias("n")), "nd-degree")
    members = written(_members(docs, degree.select("sid").join(reps, "sid"), k), "nd-members")

    hubs = written(buckets.select("key", "sid", "n").join(degree.select("sid", "degree"), "sid").groupBy("key").agg(
        F.max(F.struct("degree", "sid", "n")).alias("h")).select(
            "key", F.col("h.sid").alias("hub"), F.col("h.n").alias("hub_n")), "nd-hubs")
    spread = buckets.select("key", "sid", "n").join(hubs, "key")
    star = spread.filter("sid <> hub").select(
        F.col("sid").alias("a"), F.col("hub").alias("b"), F.col("n").alias("na"), F.col("hub_n").alias("nb"))
    fits = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    first = written(_verify(written(star.filter(fits).distinct(), "nd-star"), members, k, percent, margin), "nd-first")

    # buckets that still span several components
    found = components(first.filter("linked"))
    placed = (spread.join(found, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
              .join(found.select(F.col("sid").alias("hub"), F.col("comp").alias("hub_comp")), "hub", "left")
              .select("key", "sid", "comp", F.coalesce("hub_comp", "hub").alias("g")))
    open_keys = placed.filter("comp <> g").select("key").distinct()
    rest = written(placed.join(open_keys, "key").select("g", "sid", "comp").distinct(), "nd-rest")
    second = written(_link_blocks(rest, members, k, percent), "nd-second")
    final = components(first.filter("linked").select("a", "b").unionByName(second))

    classes = written(reps.join(final, "sid", "left").select("sid", "rep", F.coalesce("comp", "sid").alias("comp")), "nd-classes")
    smallest = written(classes.groupBy("comp").agg(F.min("rep").alias("least")), "nd-least")
    of_set = written(classes.join(smallest, "comp").select("sid", "comp", "least"), "nd-class-of-set")
    return (sketches.select("id", "text_hash", "n_shingles", "sid").join(of_set, "sid", "left")
            .select("id", "text_hash", "n_shingles", "comp", F.coalesce("least", "id").alias("least")))


def drop_near_duplicates(docs: DataFrame, **rules) -> DataFrame:
    """One document of each group: of those with the smallest doc_id, the text with the
    smallest hash (one row of it). Different texts that share an id, or have none, are
    documents of their own; without words, rows of equal id and text are one."""
    least = _grouped(docs, **rules).filter(F.col("id") == F.col("least"))
    linked = least.filter("comp is not null").groupBy("comp").agg(F.min(F.struct("id", "text_hash")).alias("r")).select("r.*")
    alone = least.filter("comp is null").select("id", "text_hash").distinct()
    kept = linked.unionByName(alone).select(F.col("id").alias("_id"), F.col("text_hash").alias("_th"))
    keyed = docs.withColumn("_key", F.coalesce("doc_id", F.lit(NO_ID).cast("long"))).withColumn("_hash", F.xxhash64(text_of()))
    out = keyed.join(kept, (F.col("_key") == F.col("_id")) & (F.col("_hash") == F.col("_th")))
    return out.dropDuplicates(["_key", "_hash"]).select(*docs.columns)
