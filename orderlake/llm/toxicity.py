"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

1. Examples: at most ``PER_CLASS`` labelled documents of each class, those with the least
   hash of their id (a documented bound; all else covers every document).
2. Terms: whole words and word beginnings of ``BEGINNINGS`` letters, lower-cased. The
   model keeps at most ``MAX_TERMS``, those whose presence tells most of the label among
   the examples: n * KL(share of toxic ones among its n examples, share among all) of at
   least ``LEAST_GAIN`` nats, which chance gives about one term in 10^7. Their document
   frequencies are counted over all documents.
3. Index: unit TF-IDF vectors of the examples (1 + log tf, smoothed idf) in blocks of
   ``BLOCK`` examples, similar ones side by side. For each block the largest weight of
   every term is kept (block-max), so weights . block maxima bounds every cosine in it.
4. Search: a document visits its blocks from the best bound on and stops when no bound
   reaches its ``NEIGHBOURS``-th cosine so far, which leaves the exact nearest examples.
   Ties go to the example of the smaller position; cosines are compared to 9 digits.
5. Score: votes weighted by 1 / (distance + ``SOFT``) plus a prior vote, calibrated by a
   logistic curve fitted to the examples' own leave-one-out votes, weighted back to the
   labels' real shares. A text without any known term gets the smoothed share of toxic
   ones among such examples. The evidence lists the nearest examples and their cosines.

The index has at most 2 * PER_CLASS examples of MAX_TERMS terms, so what the driver holds
and sends does not grow with the documents.

Defined results: a null label is no label; a document labelled more than once counts as
toxic if any label says so; a null doc_id reads as empty text, is held out and never an
example; null and empty texts have no terms; repeated rows get equal scores; very long
texts are read whole; without documents the result is empty, without labels of both
classes every score is the share of toxic labels (0 without labels); extra columns are
kept out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import written

PER_CLASS, MAX_TERMS, LEAST_GAIN = 4096, 1024, 16.0
BEGINNINGS = (4, 5, 6, 7)
BLOCK, NEIGHBOURS, SOFT, PRIOR = 64, 15, 0.05, 1.0
EVIDENCE = 3
FOLDS = 5  # fixed by the contract: ids whose crc32 is divisible by it are held out

_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def term_counts(text: str | None) -> Counter:
    """Words and their beginnings, with counts."""
    words = Counter(_WORD.findall((text or "").lower()))
    out = Counter(words)
    for w, n in words.items():
        for k in BEGINNINGS:
            if len(w) <= k:
                break
            out[w[:k] + "*"] += n
    return out


def example_labels(labels: DataFrame) -> DataFrame:
    """doc_id, toxic: the labels that may be learnt from."""
    return (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))


def _sample(labels: DataFrame, per_class: int) -> list[tuple[int, int]]:
    """(doc_id, toxic) of at most ``per_class`` labels of each class."""
    out = []
    for label in (0, 1):
        rows = labels.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        out += [(r["doc_id"], label) for r in rows.select("doc_id").collect()]
    return out


def choose_terms(examples: DataFrame, max_terms: int = MAX_TERMS) -> list[str]:
    """The terms that depend most on the label (``examples``: text, toxic)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                terms = list(term_counts(text.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()),
                                                  pa.array([toxic] * len(terms), pa.int64())], ["term", "toxic"])

    n, p = examples.agg(F.count("*"), F.sum("toxic")).first()
    if not p or p == n:
        return []
    df = (examples.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(run, "term string, toxic long")
          .groupBy("term").agg(F.count("*").alias("n"), F.sum("toxic").alias("a")))
    x, share = F.col("n").cast("double"), p / n
    part = lambda k, q: F.when(k > 0, k * F.log(k / (x * q))).otherwise(0.0)
    gain = part(F.col("a"), share) + part(F.col("n") - F.col("a"), 1 - share)
    best = df.withColumn("gain", gain).filter(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "term").limit(max_terms)
    return sorted(r["term"] for r in best.select("term").collect())


def count_terms(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, out, terms, counts: positions and counts of the known terms of each text."""
    place = {t: i for i, t in enumerate(terms)}
    starts = {t[:-1] for t in terms if t.endswith("*")}
    depths = sorted({len(s) for s in starts})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in batches:
            rows, counts = [], []
            for text in batch.column("text"):
                found: dict[int, int] = {}
                for w, n in Counter(_WORD.findall((text.as_py() or "").lower())).items():
                    at = known.get(w)
                    if at is None:
                        at = tuple(place[t] for t in (w, *(w[:k] + "*" for k in depths if k < len(w))) if t in place)
                        if len(w) < 32 and len(known) < 200_000:
                            known[w] = at
                    for t in at:
                        found[t] = found.get(t, 0) + n
                keys = sorted(found)
                rows.append(keys)
                counts.append([found[k] for k in keys])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("out"), pa.array(rows, pa.list_(pa.int32())),
                                              pa.array(counts, pa.list_(pa.int64()))], ["doc_id", "out", "terms", "counts"])

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("out"), "text").mapInArrow(
        run, "doc_id long, out boolean, terms array<int>, counts array<long>")


def document_frequencies(counted: DataFrame, n_terms: int) -> np.ndarray:
    """Documents of each term, added up inside every task first (one row a task and term)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["t", "n"])

    df = np.zeros(n_terms)
    for r in counted.select("terms").mapInArrow(run, "t int, n long").groupBy("t").agg(F.sum("n").alias("n")).collect():
        df[r["t"]] = r["n"]
    return df


# ---- index -----------------------------------------------------------------------------


@dataclass
class Index:
    """Unit vectors of the examples in blocks, and the largest weight of a term per block."""

    idf: np.ndarray
    vectors: np.ndarray   # examples x terms
    tops: np.ndarray      # blocks x terms
    toxic: np.ndarray
    ids: np.ndarray
    curve: tuple[float, float]
    base: float           # share of toxic examples, as the labels have them
    plain: float          # the same among texts without known terms


def unit_vectors(rows: list, counts: list, idf: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), len(idf)))
    for i, (t, n) in enumerate(zip(rows, counts)):
        if len(t):
            w = (1 + np.log(np.asarray(n, float))) * idf[np.asarray(t)]
            out[i, t] = w / math.sqrt((w * w).sum())
    return out


def nearest(index: Index, q: np.ndarray, k: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(positions, cosines) of the k nearest examples of each row of q, nearest first, and
    the number of (row, block) pairs looked at; ``skip`` leaves one example out per row."""
    blocks = len(index.tops)
    bounds = np.round(q @ index.tops.T, 9) + 2e-9
    order = np.argsort(-bounds, axis=1, kind="stable")
    best = np.full((len(q), k), -1.0)
    where = np.full((len(q), k), len(index.vectors), np.int64)
    active, looked = np.arange(len(q)), 0
    for step in range(blocks):
        block = order[active, step]
        live = bounds[active, block] >= np.maximum(best[active, k - 1], 0)
        active, block = active[live], block[live]
        if not len(active):
            break
        looked += len(active)
        for b in np.unique(block):
            rows = active[block == b]
            first = int(b) * BLOCK
            found = np.round(q[rows] @ index.vectors[first:first + BLOCK].T, 9)
            at = np.broadcast_to(np.arange(first, first + found.shape[1]), found.shape)
            if skip is not None:
                found = np.where(at == skip[rows][:, None], -1.0, found)
            cos, pos = np.hstack([best[rows], found]), np.hstack([where[rows], at])
            keep = np.lexsort((pos, -cos), axis=1)[:, :k]
            best[rows], where[rows] = np.take_along_axis(cos, keep, 1), np.take_along_axis(pos, keep, 1)
    return where, best, looked


def votes(index: Index, where: np.ndarray, cos: np.ndarray) -> np.ndarray:
    """Distance-weighted share of toxic neighbours, with a prior vote for the base share."""
    real = cos > 0
    w = np.where(real, 1 / (1 - np.minimum(cos, 1) + SOFT), 0)
    y = np.append(index.toxic, 0)[np.where(real, where, len(index.toxic))]
    return ((w * y).sum(1) + PRIOR * index.base) / (w.sum(1) + PRIOR)


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic slope and offset by Newton steps with a small ridge; the slope stays positive."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(weight * (p - y) * x).sum() + 1e-2 * (a - 1), (weight * (p - y)).sum() + 1e-2 * b])
        s = weight * p * (1 - p)
        h = np.array([[(s * x * x).sum() + 1e-2, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    return max(float(a), 1e-3), float(b)


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def build_index(examples: list[tuple], idf: np.ndarray, shares: dict[int, int]) -> Index:
    """``examples``: (doc_id, toxic, terms, counts); ``shares``: labels of each class."""
    examples = sorted(examples, key=lambda e: e[0])
    vectors = unit_vectors([e[2] for e in examples], [e[3] for e in examples], idf)
    toxic = np.array([e[1] for e in examples], float)
    known = vectors.any(axis=1) if len(examples) else np.zeros(0, bool)
    total = sum(shares.values())
    sampled = Counter(e[1] for e in examples)
    weight = np.array([shares[e[1]] / sampled[e[1]] for e in examples])
    base = shares.get(1, 0) / total if total else 0.0
    rest = ~known
    plain = ((weight * toxic)[rest].sum() + base) / (weight[rest].sum() + 1) if len(examples) else base
    # similar examples side by side: by heaviest term, then by the second
    heavy = np.argsort(-vectors, axis=1, kind="stable")[:, :2] if vectors.size else np.zeros((len(examples), 2), int)
    order = [i for i in sorted(range(len(examples)), key=lambda i: (*heavy[i].tolist(), i)) if known[i]]
    v, y = vectors[order], toxic[order]
    tops = np.array([v[i:i + BLOCK].max(0) for i in range(0, len(v), BLOCK)]) if len(v) else v
    index = Index(idf, v, tops, y, np.array([examples[i][0] for i in order], np.int64), (1.0, 0.0), base, float(plain))
    if len(v) > 1:
        own = np.concatenate([votes(index, *nearest(index, v[i:i + 512], NEIGHBOURS, np.arange(i, min(i + 512, len(v))))[:2])
                              for i in range(0, len(v), 512)])
        index.curve = fit_curve(logit(own), y, weight[order])
    return index


def score_rows(index: Index, rows: list, counts: list) -> tuple[np.ndarray, list[str]]:
    scores = np.full(len(rows), round(index.plain, 6))
    evidence = [""] * len(rows)
    known = [i for i, t in enumerate(rows) if t]
    if known and len(index.vectors):
        q = unit_vectors([rows[i] for i in known], [counts[i] for i in known], index.idf)
        where, cos, _ = nearest(index, q, NEIGHBOURS)
        a, b = index.curve
        p = 1 / (1 + np.exp(-np.clip(a * logit(votes(index, where, cos)) + b, -30, 30)))
        scores[known] = np.round(p, 6)
        for r, i in enumerate(known):
            evidence[i] = ",".join(f"{index.ids[w]}:{c:.3f}:{index.toxic[w]:.0f}"
                                   for w, c in zip(where[r, :EVIDENCE], cos[r, :EVIDENCE]) if c > 0)
    return scores, evidence


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (doc_id:cosine:label of the nearest)."""
    spark = docs.sparkSession
    usable = written(example_labels(labels), "toxicity-labels")
    shares = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    chosen = spark.createDataFrame(_sample(usable, per_class), "doc_id long, toxic int")  # 2 * per_class rows
    examples = written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "toxicity-examples")
    terms = choose_terms(examples)
    counted = written(count_terms(docs, terms), "toxicity-terms")
    n = counted.count()
    df = document_frequencies(counted, len(terms))
    idf = 1 + np.log((1 + n) / (1 + df))
    rows = (counted.join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
            .agg(F.max("toxic").alias("toxic"), F.min(F.struct("terms", "counts")).alias("v")).collect())
    index = build_index([(r["doc_id"], r["toxic"], r["v"]["terms"], r["v"]["counts"]) for r in rows], idf, shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                scores, evidence = score_rows(index, part.column("terms").to_pylist(), part.column("counts").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)),
                     pa.array(evidence, pa.string())], ["doc_id", "held_out", "score", "predicted", "evidence"])

    return counted.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, evidence string")
