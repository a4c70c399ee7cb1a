import collections
import hashlib
import random
import re

from orderlake.llm.imatch import fingerprints, lexicon, terms

BREAK = re.compile(r"[\x20\x09-\x0D.,;:!?\"'()]+")


def term_set(t):
    return {w for w in BREAK.split(t.lower()) if w}


def check(df, rows, exact_terms=True):
    got = fingerprints(df).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r["doc_id"]].append(r)
    firsts = collections.Counter(r[0] for r in rows)
    for n, (doc_id, text) in enumerate(order):
        if firsts[doc_id] > 1 or firsts[order[(n + 1) % len(order)][0]] > 1:
            continue  # ties: their order is by hash
        t, nxt = text or "", order[(n + 1) % len(order)][1] or ""
        q = len(t) // 4
        edited = t[:len(t) - q] + nxt[:q]
        r = by_id[doc_id][0]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = r["fingerprint"].split(","), r["edited_fingerprint"].split(",")
        seen = [(x, y) for x, y in zip(a, b) if (x, y) != ("-", "-")]
        assert abs(r["near_edited"] - (sum(x == y for x, y in seen) / len(seen) if seen else 1.0)) < 1e-12
        nf = by_id[order[(n + 1) % len(order)][0]][0]["fingerprint"].split(",")
        seen = [(x, y) for x, y in zip(a, nf) if (x, y) != ("-", "-")]
        assert abs(r["near_next"] - (sum(x == y for x, y in seen) / len(seen) if seen else 1.0)) < 1e-12
    text_of = collections.defaultdict(set)
    for doc_id, text in rows:
        if firsts[doc_id] == 1:
            text_of[frozenset(term_set(text or ""))].add(by_id[doc_id][0]["fingerprint"])
    assert all(len(v) == 1 for v in text_of.values())  # equal terms, equal fingerprints
    return got


def test_edge_documents(edge_docs, edge_rows, no_docs):
    check(edge_docs, [r[:2] for r in edge_rows])
    assert fingerprints(no_docs).count() == 0


def test_whole_table(sf_docs):
    got = check(sf_docs, [(r["doc_id"], r["text"]) for r in sf_docs.collect()])
    mean = lambda c: sum(r[c] for r in got) / len(got)
    assert mean("near_edited") > 5 * mean("near_next")


def test_one_document(spark):
    r = fingerprints(spark.createDataFrame([(5, "abcd efgh")], "doc_id long, text string")).collect()
    assert len(r) == 1 and r[0]["edited_sha256"] == hashlib.sha256(b"abcd efab").hexdigest() and r[0]["near_next"] == 1.0


def test_lexicon_against_brute_force(sf_docs):
    docs = [r["text"] or "" for r in sf_docs.collect()]
    df = collections.Counter(w for t in docs for w in term_set(t))
    low, high = max(2, 0.02 * len(docs)), 0.2 * len(docs)
    want = sorted(v for v in df.values() if low <= v <= high)
    assert sorted(r["df"] for r in lexicon(sf_docs, 0.02, 0.2).collect()) == want
    assert sf_docs.select(terms(sf_docs["text"]).alias("t")).count() == len(docs)


def test_copies_and_small_vocabularies_keep_near_edited(spark):
    rng = random.Random(3)
    text = lambda word, n: " ".join(word + str(rng.randrange(n)) for _ in range(80))
    hot = text("h", 10**6)
    rows = [(k, text("m", 4000)) for k in range(600)]
    rows += [(1000 + k, hot) for k in range(300)]
    rows += [(2000 + k, text("s", 10**6)) for k in range(60)]  # no term is held by two texts
    got = fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    mean = lambda a, c: sum(r[c] for r in got if a <= r["doc_id"] < a + 1000) / sum(a <= r["doc_id"] < a + 1000 for r in got)
    last = next(r for r in got if r["doc_id"] == 1299)
    assert last["near_edited"] > 0.1  # the others of the group end in their own text's start
    assert mean(0, "near_edited") > 0.1 and mean(2000, "near_edited") > 0.1
    assert mean(2000, "near_next") < 0.05
