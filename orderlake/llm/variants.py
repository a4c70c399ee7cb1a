"""Spelling variant grouping with k-d trees over letter-count vectors.

Two words are near if they differ by one inserted, deleted or replaced letter. One edit
moves a letter-count vector by at most two in L1: a replaced letter takes one count up
and one down, an inserted one takes one up. So near words are found by range searches in
k-d trees, one tree per word length, searched by the words of that length and of the two
neighbouring ones, and the letters' order is verified afterwards.

1. Words are counted by Spark (map-side partial counts).
2. The top of every tree is built from a sample of at most ``SAMPLE`` words and only
   balances the work: each word is a point of one cell and a query of every cell whose
   box one edit can reach. Cells hold about ``CELL`` words, whatever the vocabulary.
3. Each cell builds its own tree (tight boxes, leaves of ``LEAF`` words); all queries of
   the cell walk it together, pruned by the boxes. Counts and the best neighbour of a word
   are added over its cells; no pair leaves a cell.
4. A word's form is its near word of largest count (ties: the smallest) where that is at
   least ``RATIO`` times its own; roots follow the forms by pointer doubling, whose rounds
   follow from the largest count, as each step multiplies it by ``RATIO``.

Letters beyond a-z share ``OTHER`` counters; that only widens the search. Words of one
letter multiset cannot be parted by counts and stay in one cell.

Defined results: null and empty texts have no words; a null doc_id reads as empty text in
the seed of the deletion rule; repeated rows count again; ties as above; a run of any
length is one word; an empty table gives an empty result; extra columns are kept out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import text_of, written

# Fixed values of the contract.
MIN_LENGTH, MIN_COUNT, RATIO, DELETE_EVERY = 7, 2, 10, 31
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SAMPLE, CELL, LEAF = 200_000, 8192, 128
OTHER = 6
DIMS = 26 + OTHER
PAIRS = 1 << 22  # letters compared at once


def count_words(docs: DataFrame) -> DataFrame:
    """word, n: lower-cased runs, some with one letter deleted, of 7 letters or more that
    occur twice or more."""
    runs = F.regexp_extract_all(F.translate(text_of(), UPPER, LOWER), F.lit(f"[a-zÀ-ÿ]{{{MIN_LENGTH},}}"), F.lit(0))
    words = docs.select("doc_id", F.explode(runs).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return (words.withColumn("h", h)
            .select(F.when(F.col("h") % DELETE_EVERY == 0, cut).otherwise(F.col("run")).alias("word"))
            .filter(F.length("word") >= MIN_LENGTH)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_COUNT))


# ---- letters and trees -----------------------------------------------------------------


def letters(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    cell = np.where((codes >= 97) & (codes <= 122), codes - 97, 26 + codes % OTHER).astype(np.int64)
    rows = np.arange(len(codes))[:, None] * DIMS
    return np.bincount((cell + rows).ravel(), minlength=len(codes) * DIMS).reshape(len(codes), DIMS).astype(np.int32)


def reach(of: int, to: int) -> tuple[int, int]:
    """Counts that may go up and down from a word of one length to one of another."""
    return {0: (1, 1), 1: (1, 0), -1: (0, 1)}[to - of]


def near_box(v: np.ndarray, low: np.ndarray, high: np.ndarray, up: int, down: int) -> np.ndarray:
    return ((np.maximum(low - v, 0).sum(1) <= up) & (np.maximum(v - high, 0).sum(1) <= down))


def split(v: np.ndarray) -> tuple[int, int] | None:
    """Dimension of the widest spread and the count that parts it nearest the middle."""
    spread = v.var(axis=0)
    d = int(spread.argmax())
    if spread[d] == 0:
        return None
    values, n = np.unique(v[:, d], return_counts=True)
    below = np.cumsum(n)[:-1]
    return d, int(values[np.abs(below - len(v) / 2).argmin()])


def top_tree(v: np.ndarray, room: float, ids: Iterator[int], low: dict | None = None, high: dict | None = None):
    """(cell, low, high) leaves or (dim, at, left, right); a cell's bounds are those of the
    splits above it."""
    low, high = low or {}, high or {}
    s = split(v) if len(v) > room else None
    if s is None:
        return {"cell": next(ids), "low": low, "high": high}
    d, at = s
    left = v[:, d] <= at
    return {"dim": d, "at": at, "low": low, "high": high,
            "left": top_tree(v[left], room, ids, low, {**high, d: at}),
            "right": top_tree(v[~left], room, ids, {**low, d: at + 1}, high)}


def build_forest(sample: list[str], room: float) -> dict:
    """A top tree for each word length of the sample, split down to ``room`` words."""
    by_length: dict[int, list[str]] = {}
    for w in sample:
        by_length.setdefault(len(w), []).append(w)
    return {n: top_tree(letter_counts(letters(ws, n)), room, iter(range(1 << 24))) for n, ws in by_length.items()}


def cells_of(tree, v: np.ndarray, idx: np.ndarray, up: int, down: int, out: list) -> None:
    """Appends (cell, rows) for the cells whose boxes the edits can reach."""
    if not len(idx):
        return
    part = v[idx]
    over = np.zeros(len(idx), np.int32)
    under = np.zeros(len(idx), np.int32)
    for d, x in tree["low"].items():
        over += np.maximum(x - part[:, d], 0)
    for d, x in tree["high"].items():
        under += np.maximum(part[:, d] - x, 0)
    idx = idx[(over <= up) & (under <= down)]
    if "cell" in tree:
        if len(idx):
            out.append((tree["cell"], idx))
        return
    cells_of(tree["left"], v, idx, up, down, out)
    cells_of(tree["right"], v, idx, up, down, out)


def deal(words: list[str], forest: dict):
    """(cell, length of its points, row, is point) arrays for a batch of words."""
    parts = []
    lengths = np.array([len(w) for w in words])
    whole = {"cell": 0, "low": {}, "high": {}}
    for n in np.unique(lengths):
        mine = np.flatnonzero(lengths == n)
        v = letter_counts(letters([words[i] for i in mine], int(n)))
        for to in (n - 1, n, n + 1):
            if to < MIN_LENGTH:
                continue
            tree, found, home = forest.get(int(to), whole), [], {}
            cells_of(tree, v, np.arange(len(mine)), *reach(n, to), found)
            if to == n:
                at: list = []
                cells_of(tree, v, np.arange(len(mine)), 0, 0, at)
                home = dict(at)
            for cell, rows in found:
                point = np.isin(rows, home[cell]) if cell in home else np.zeros(len(rows), bool)
                parts.append((np.full(len(rows), (int(to) << 24) + cell), mine[rows], point))
    return [np.concatenate(c) for c in zip(*parts)]


def kd_pairs(q: np.ndarray, p: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of q, rows of p) whose letter counts are within one edit."""
    kind = np.float32 if max(q.max(initial=0), p.max(initial=0)) < 1024 else np.float64
    qf, pf = q.astype(kind), p.astype(kind)
    q2, p2 = (qf * qf).sum(1), (pf * pf).sum(1)
    stack = [(np.arange(len(p)), np.arange(len(q)))]
    while stack:
        points, asks = stack.pop()
        box = p[points]
        asks = asks[near_box(q[asks], box.min(0), box.max(0), up, down)]
        if not len(asks):
            continue
        s = split(box) if len(points) > LEAF else None
        if s:
            left = box[:, s[0]] <= s[1]
            stack += [(points[left], asks), (points[~left], asks)]
            continue
        for k in range(0, len(asks), 1024):  # whole counts: the square of the distance is exact
            a = asks[k:k + 1024]
            for j in range(0, len(points), 1024):
                b = points[j:j + 1024]
                far = q2[a][:, None] + p2[b][None, :] - 2 * (qf[a] @ pf[b].T)
                i, m = np.nonzero(far <= up + down)
                if len(i):
                    yield a[i], b[m]


def one_edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by exactly one inserted, deleted or replaced letter."""
    if x.shape[1] == y.shape[1]:
        return (x != y).sum(1) == 1
    if x.shape[1] > y.shape[1]:
        x, y = y, x
    n = x.shape[1]
    front = np.cumprod(x == y[:, :n], axis=1, dtype=bool).sum(1)
    back = np.cumprod((x == y[:, 1:])[:, ::-1], axis=1, dtype=bool).sum(1)
    return front + back >= n


def search_cell(pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts and best near words of the queries of one cell."""
    words, n = pdf["word"].tolist(), pdf["n"].to_numpy()
    points = np.flatnonzero(pdf["point"].to_numpy())
    near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    if len(points):
        order = sorted(points.tolist(), key=lambda i: (-n[i], words[i]))
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(order))
        size = len(words[points[0]])
        pl = letters([words[i] for i in points], size)
        pv = letter_counts(pl)
        lengths = np.array([len(w) for w in words])
        for of in np.unique(lengths):
            asks = np.flatnonzero(lengths == of)
            ql = letters([words[i] for i in asks], int(of))
            step = max(1, PAIRS // int(of))
            for a, b in kd_pairs(letter_counts(ql), pv, *reach(int(of), size)):
                for k in range(0, len(a), step):
                    i, m = a[k:k + step], b[k:k + step]
                    good = one_edit(ql[i], pl[m])
                    i, m = asks[i[good]], points[m[good]]
                    near += np.bincount(i, minlength=len(words))
                    np.minimum.at(best, i, rank[m])
    hit = np.flatnonzero(near)
    chosen = [order[best[i]] for i in hit]
    text = lambda rows: pd.Series([words[i] for i in rows], dtype=object)
    return pd.DataFrame({"word": text(hit), "near": near[hit], "best_n": n[chosen] if len(hit) else near[hit],
                         "best": text(chosen)})


def near_words(vocabulary: DataFrame) -> DataFrame:
    """word, n_near, best_n, best: for every word with a near one (``vocabulary``: word, n)."""
    total = vocabulary.count()
    every = max(1, -(-total // SAMPLE))
    sample = [r["word"] for r in vocabulary.filter(F.pmod(F.xxhash64("word"), F.lit(every)) == 0)
              .select("word").limit(2 * SAMPLE).collect()]
    forest = build_forest(sample, CELL / every)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, row, point = deal(batch.column("word").to_pylist(), forest)
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), batch.column("word").take(row),
                                              batch.column("n").take(row), pa.array(point)], ["cell", "word", "n", "point"])

    dealt = vocabulary.mapInArrow(run, "cell long, word string, n long, point boolean")
    found = dealt.groupBy("cell").applyInPandas(search_cell, "word string, near long, best_n long, best string")
    top = F.min(F.struct((-F.col("best_n")).alias("k"), F.col("best").alias("w")))
    return (found.groupBy("word").agg(F.sum("near").alias("n_near"), top.alias("top"))
            .select("word", "n_near", (-F.col("top.k")).alias("best_n"), F.col("top.w").alias("best")))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n."""
    vocabulary = written(count_words(docs), "variant-words")
    near = near_words(vocabulary)
    taken = F.col("best_n") >= RATIO * F.col("n")
    forms = written(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("best")).alias("form"), F.when(taken, F.col("best_n")).alias("form_n")), "variant-forms")
    links = forms.filter("form is not null").select("word", F.col("form").alias("root"))
    most = forms.agg(F.max("n")).first()[0] or 0
    steps = 1
    while MIN_COUNT * RATIO ** (2 * steps) <= most:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        links = written(links.join(onward, "root", "left")
                        .select("word", F.coalesce("onward", "root").alias("root")), "variant-roots")
        steps *= 2
    return (forms.join(links, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
