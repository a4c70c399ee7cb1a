import random
import re
import zlib
from collections import Counter

import numpy as np

from orderlake.llm import variants
from orderlake.llm.variants import one_edit, letters, spelling_variants

SCHEMA = "doc_id long, text string, word string, n long, root string"


def brute_counts(rows):
    count = Counter()
    for doc_id, text, *_ in rows:
        low = (text or "").translate(str.maketrans(variants.UPPER, variants.LOWER))
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = brute_counts(rows)
    holes = {}  # a word with one letter left out, or kept out of sight
    for w in n:
        for i in range(len(w)):
            holes.setdefault((len(w) - 1, w[:i] + w[i + 1:]), set()).add(w)
        holes.setdefault((len(w), w), set()).add(w)
    form, near = {}, {}
    for w in n:
        close = set(holes.get((len(w), w), ()))
        for i in range(len(w)):
            close |= holes.get((len(w) - 1, w[:i] + w[i + 1:]), set())
        close = {x for x in close if x != w and one_apart(w, x)}
        near[w] = len(close)
        if close:
            best = min(close, key=lambda x: (-n[x], x))
            form[w] = best if n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form.get(root):
            root = form[root]
        out[w] = (form.get(w), root, n[w], near[w], n[form[w]] if form.get(w) else None)
    return out


def run(df):
    rows = spelling_variants(df).collect()
    got = {r["word"]: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


def planted(rng):
    stems = ["".join(rng.choice("abcdeéü") for _ in range(rng.randrange(6, 12))) for _ in range(60)]
    rows = []
    for k in range(400):
        said = []
        for _ in range(30):
            w = stems[min(int(rng.expovariate(0.25)), 59)]
            if rng.random() < 0.3:
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abxé×÷") + w[i:], w[:i] + rng.choice("abxé") + w[i + 1:]])
            said.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((k, " ".join(said), None, 1, "clash"))
    rows += [(1000 + k, "abcdefg " * 300, None, 1, "") for k in range(130)]  # one word holds over a third
    rows += [(2000, "abcdefh " * 400 + "abcdegh " * 40 + "abcdfgh abcdfgh", None, 1, "")]  # a chain of forms
    anagrams = ["".join(rng.sample("abcdefgh", 8)) for _ in range(300)]  # one letter multiset
    rows += [(3000 + k, " ".join(anagrams), None, None, None) for k in range(2)]
    long = "q" * 5000
    rows += [(4000, f"{long} {long} {long}z {long}z z{long}z z{long}z", None, 1, "")]
    rows += [(None, None, None, None, None), (None, "nullids nullids nullidz nullidz", None, 0, ""), (5, "", "", 0, ""), rows[3]]
    return rows


def test_against_brute_force(spark, monkeypatch):
    rows = planted(random.Random(12))
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    expected = brute(rows)
    assert run(df) == expected
    assert any(v[1] != v[0] and v[0] for v in expected.values())  # a chain of two forms
    monkeypatch.setattr(variants, "CELL", 20)  # many cells, boxes on every side
    assert run(df) == expected


def test_empty(spark):
    assert spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spelling_variants(spark.createDataFrame([(1, "short words only", "", 1, "")], SCHEMA)).count() == 0


def test_given_documents(spark, sf_docs, edge_docs, edge_rows):
    rows = [tuple(r) for r in sf_docs.select("doc_id", "text").collect()]
    assert run(sf_docs) == brute(rows)
    assert run(edge_docs) == brute(edge_rows)


def test_letter_order():
    rng = random.Random(1)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 6)))
        b = "".join(rng.choice("ab") for _ in range(len(a) + rng.choice([-1, 0, 1]) or 1))
        if abs(len(a) - len(b)) <= 1:
            assert bool(one_edit(letters([a], len(a)), letters([b], len(b)))[0]) == one_apart(a, b), (a, b)


def test_range_search_finds_every_pair():
    rng = np.random.default_rng(3)
    p, q = rng.integers(0, 3, (700, variants.DIMS)), rng.integers(0, 3, (300, variants.DIMS))
    p[:, 4:] = q[:, 4:] = 1
    for up, down in ((1, 1), (1, 0), (0, 1)):
        found = {(int(i), int(j)) for a, b in variants.kd_pairs(q, p, up, down) for i, j in zip(a, b)}
        diff = p[None] - q[:, None]
        every = {(int(i), int(j)) for i, j in zip(*np.nonzero(((diff > 0) * diff).sum(2) <= up))
                 if (-diff[i, j] * (diff[i, j] < 0)).sum() <= down and abs(diff[i, j]).sum() <= up + down}
        assert every <= found
