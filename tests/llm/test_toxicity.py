import random
import zlib

import numpy as np

from orderlake.llm import toxicity
from orderlake.llm.toxicity import Index, choose_terms, fit_curve, nearest, score_toxicity, term_counts

DOCS = "doc_id long, text string, lang string, source string, score double, toxic int"
LABELS = "doc_id long, quality int, toxic int"
BAD = ["idiot", "vile", "trashy", "scummy", "worthless", "clown"]


def planted(seed, n=900):
    """Documents of which an eighth hold some of six bad words; a few clean ones hold one."""
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        words = [f"{rng.choice('abcdefgh')}{rng.choice('rst')}o{rng.randrange(400)}x" for _ in range(rng.randrange(20, 200))]
        words = ["".join(chr(97 + int(c)) if c.isdigit() else c for c in w) for w in words]
        toxic = int(rng.random() < 0.125)
        for _ in range(rng.randrange(2, 6) if toxic else rng.random() < 0.03):
            words.insert(rng.randrange(len(words)), rng.choice(BAD).title())
        rows.append((k, " ".join(words), "en", "s", 0.0, 0))
        if rng.random() < 0.7:
            labels.append((k, 0, toxic))
    return rows, labels


def out(k):
    return zlib.crc32(str(k).encode()) % 5 == 0


def run(spark, rows, labels):
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    return score_toxicity(df, spark.createDataFrame(labels, LABELS)).collect()


def test_held_out_accuracy_and_no_leak(spark):
    rows, labels = planted(1)
    got = run(spark, rows, labels)
    by = {r["doc_id"]: r for r in got}
    assert sorted(by) == list(range(900)) and len(got) == 900
    assert all(r["held_out"] == out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in got)
    truth = {k: t for k, _, t in labels if out(k)}
    assert np.mean([by[k]["predicted"] == t for k, t in truth.items()]) >= 0.95
    assert np.mean([by[k]["predicted"] for k, t in truth.items() if t]) >= 0.8
    assert any(r["evidence"] for r in got)
    # the labels of held-out rows, lang, source and the order of rows change nothing
    flipped = [(k, q, 1 - t if out(k) else t) for k, q, t in labels]
    moved = [(k, t, "xx", None, 1.0, 1) for k, t, *_ in reversed(rows)]
    assert {r["doc_id"]: r["score"] for r in run(spark, moved, flipped)} == {k: r["score"] for k, r in by.items()}


def test_odd_input(spark):
    rows, labels = planted(2, 300)
    rows += [(1000, None, None, None, None, None), (1001, "", "", "", 0.0, 0), (None, "idiot clown vile", None, None, None, None),
             (1002, "idiot vile " * 20000, None, None, None, None), (1003, "x" * 30000, None, None, None, None), rows[0], rows[0]]
    labels += [(5000, 1, 1), (None, 1, 1), (3, None, None), *[x for x in labels if x[0] == 1]]
    got = run(spark, rows, labels)
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    assert score[1000] == score[1001] == score[1003] < 0.5
    assert score[1002] > 0.5 and score[None] > 0.5 and next(r for r in got if r["doc_id"] is None)["held_out"]
    assert len({r["score"] for r in got if r["doc_id"] == 0}) == 1
    assert run(spark, [], labels) == []
    assert {r["score"] for r in run(spark, rows[:5], [])} == {0.0}
    one = [x for x in labels if x[2] == 0 and x[0] and not out(x[0])]
    assert all(r["predicted"] == 0 for r in run(spark, rows[:5], one))


def test_terms_are_chosen_by_the_label(spark):
    rows, labels = planted(3)
    label = {k: t for k, _, t in labels}
    terms = choose_terms(spark.createDataFrame([(r[1], label[r[0]]) for r in rows if r[0] in label], "text string, toxic int"))
    assert set(BAD) <= set(terms)
    assert all(t in BAD or any(b.startswith(t[:-1]) for b in BAD) for t in terms)
    assert term_counts("Été ABCDEFGHI abc") == {"été": 1, "abcdefghi": 1, "abc": 1, "abcd*": 1, "abcde*": 1, "abcdef*": 1, "abcdefg*": 1}


def test_nearest_equals_brute_force_and_prunes():
    rng = np.random.default_rng(5)
    for _ in range(20):
        n, terms = int(rng.integers(1, 500)), 40
        group = np.sort(rng.integers(0, 8, n))
        v = np.where(rng.random((n, terms)) < 0.1, rng.random((n, terms)), 0)
        v[np.arange(n), group] += 2
        v[rng.random(n) < 0.2] = v[0]  # ties
        v /= np.sqrt((v * v).sum(1))[:, None]
        q = np.where(rng.random((60, terms)) < 0.1, rng.random((60, terms)), 0)
        q[np.arange(60), rng.integers(0, 8, 60)] += 2
        q /= np.sqrt((q * q).sum(1))[:, None]
        tops = np.array([v[i:i + toxicity.BLOCK].max(0) for i in range(0, n, toxicity.BLOCK)])
        index = Index(np.ones(terms), v, tops, np.zeros(n), np.arange(n), (1.0, 0.0), 0.1, 0.1)
        where, cos, looked = nearest(index, q, 15)
        every = np.round(q @ v.T, 9)
        for i in range(60):
            best = sorted(range(n), key=lambda j: (-every[i, j], j))[:15]
            real = [j for j in best if every[i, j] > 0]
            assert [int(w) for w, c in zip(where[i], cos[i]) if c > 0] == real
        if n > 300:
            assert looked < 60 * len(tops) * 0.9
        where, _, _ = nearest(index, v[:50], 5, np.arange(min(50, n)))
        assert all(i not in row for i, row in enumerate(where.tolist()))


def test_curve_is_calibrated():
    rng = np.random.default_rng(2)
    x = rng.normal(size=5000)
    y = (rng.random(5000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(float)
    a, b = fit_curve(x, y, np.ones(5000))
    assert abs(a - 2) < 0.2 and abs(b + 1) < 0.2
