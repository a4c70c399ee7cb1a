import random

import numpy as np

from pyspark.sql import functions as F

from orderlake.llm.near_dup import (
    _members, drop_near_duplicates, estimate, merge, near_duplicates, registers, shingles, sketch_documents,
)


def sets_of(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute(rows, k=2):
    """Components over all pairs: list of (doc_id, n, component_id, kept)."""
    ids = [-(1 << 63) if r[0] is None else r[0] for r in rows]
    sets = [sets_of(r[1], k) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        if s:
            by.setdefault(s, []).append(i)
    groups = list(by.items())
    for _, own in groups:
        for i in own[1:]:
            root[find(i)] = find(own[0])
    for x, (s, own) in enumerate(groups):
        for t, other in groups[x + 1:]:
            if 100 * min(len(s), len(t)) >= 80 * max(len(s), len(t)):
                both = len(s & t)
                if 100 * both >= 80 * (len(s) + len(t) - both):
                    root[find(own[0])] = find(other[0])
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), 1 << 63), ids[i])
    real = lambda v: None if v == -(1 << 63) else v
    return sorted(((real(ids[i]), len(sets[i]), real(least[find(i)]), ids[i] == least[find(i)])
                   for i in range(len(rows))), key=str)


def check(df, rows, k=2):
    assert sorted((tuple(r) for r in near_duplicates(df, k=k).collect()), key=str) == brute(rows, k)


def test_edge_documents(edge_docs, edge_rows, no_docs):
    check(edge_docs, [r[:2] for r in edge_rows])
    assert near_duplicates(no_docs).count() == 0


def test_groups_of_near_copies(spark):
    """Copies at all distances from a base, chains of copies, and many outsiders."""
    rng = random.Random(6)
    rows = []
    for g in range(3):
        base = [f"{g}w{rng.randrange(2000)}" for _ in range(160)]
        for _ in range(150):
            w = list(base)
            for _ in range(rng.randrange(0, 22)):
                w[rng.randrange(160)] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
        for _ in range(40):  # a chain
            base = list(base)
            for _ in range(6):
                base[rng.randrange(160)] = f"c{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(base)))
    rng.shuffle(rows)
    rows = [(n, t) for n, (_, t) in enumerate(rows)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)


def test_whole_table(sf_docs):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs.collect()]
    check(sf_docs, rows)
    out = drop_near_duplicates(sf_docs, k=2)
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(r[0] for r in brute(rows) if r[3])
    assert out.columns == sf_docs.columns


def test_texts_without_or_with_equal_ids_stay(spark):
    rng = random.Random(8)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))
    rows = [(None, text()) for _ in range(12)] + [(7, text()) for _ in range(5)] + [(k, text()) for k in range(10, 20)]
    copies = [rows[0], rows[0], rows[13], (None, rows[1][1].upper()), (30, rows[2][1])]
    out = drop_near_duplicates(spark.createDataFrame(rows + copies, "doc_id long, text string"), k=2).collect()
    assert sorted((r["doc_id"] or 0, r["text"].lower()) for r in out) == sorted((d or 0, t) for d, t in rows)


def test_members_meet_their_own_row_only(spark):
    rows = [(None, f"a{k} b{k} c{k}") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = sketch_documents(docs, 2).select("sid", F.col("id").alias("rep"), F.col("text_hash").alias("rep_hash"))
    found = _members(docs, wanted, 2)
    assert found.count() == 30
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    join = next(x for x in plan.splitlines() if "Join Inner" in x)
    assert "text_hash" in join and " AND " in join  # not by id alone, which is one key here


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[1000:])
    assert (merge(registers(a), registers(b)) == registers(np.union1d(a, b))).all()
    got, want = [], []
    for shared in (0, 300, 600, 900, 1000):
        x, y = pool[:1000], np.concatenate([pool[:shared], pool[1000:2000 - shared]])
        got.append(estimate(registers(x)[None], registers(y)[None], np.array([1000.0]), np.array([float(len(y))]))[0])
        want.append(shared / (1000 + len(y) - shared))
    assert np.abs(np.array(got) - want).max() < 0.12
    assert len(shingles("A b")) == 1 and (shingles("A b") == shingles("a  B")).all() and not len(shingles(" \t"))
    assert (shingles("É x") != shingles("é x")).all()
