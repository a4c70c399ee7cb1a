import hashlib
import random

import numpy as np

from orderlake.llm import suffix_dedup as S


def brute(rows):
    least = {}
    data = [(-(1 << 63) if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for p in range(len(b) - 49):
            w = b[p:p + 50]
            if i < least.get(w, 1 << 63):
                least[w] = i
    out = []
    for (doc_id, _), (i, b) in zip(rows, data):
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - 49):
            if least[b[p:p + 50]] < i:
                gone[p:p + 50] = True
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def check(df, rows):
    got = S.dedup_substrings(df).drop("kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_edge_documents(edge_docs, edge_rows, no_docs):
    check(edge_docs, [r[:2] for r in edge_rows])
    assert S.dedup_substrings(no_docs).count() == 0


def passages(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randrange(2, 9)))
    shared = [" ".join(word() for _ in range(n)) for n in (8, 9, 10, 12, 30, 200)] + ["é漢🙂" * 9, "z" * 70, "ab" * 40]
    rows = []
    for k in range(150):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            parts.append(" ".join(word() for _ in range(rng.randrange(0, 25))))
            p = rng.choice(shared)
            a = rng.randrange(0, max(1, len(p) - 40))
            parts.append(p if rng.random() < .6 else p[a:a + rng.randrange(30, 70)])
        rows.append((k * 3 % 151, rng.choice(["", " "]).join(parts)))
    return rows


def test_passages_at_the_length_limit(spark, monkeypatch):
    rows = passages() + [(9, passages()[3][1]), (None, passages()[5][1]), (500, None)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows)


def test_whole_table(sf_docs):
    check(sf_docs, [(r["doc_id"], r["text"]) for r in sf_docs.collect()])


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(0)
    for n, top in ((1, 3), (2, 1), (300, 2), (900, 4), (700, 1)):
        data = rng.integers(0, top, n).astype(np.uint8)
        raw = data.tobytes()
        sa = S.suffix_array(data, 50)
        assert sorted(sa.tolist()) == list(range(n))
        cut = [raw[i:i + 50] for i in sa]
        assert cut == sorted(cut)
        lcp = S.common_prefixes(data, sa, 50)
        for k in range(1, n):
            a, b = raw[sa[k - 1]:], raw[sa[k]:]
            want = next((x for x in range(min(50, len(a), len(b))) if a[x] != b[x]), min(50, len(a), len(b)))
            assert lcp[k] == want


def test_one_minimizer_over_several_shards(monkeypatch):
    """Segments beyond one shard: the shards' windows are found in each other."""
    rng = random.Random(4)
    base = "".join(rng.choice("xyz") for _ in range(200))
    segs = [base[a:a + 60 + rng.randrange(30)].encode() for a in (rng.randrange(0, 110) for _ in range(60))]
    docs = np.array([rng.randrange(0, 1000) for _ in segs])
    marks = np.zeros(len(segs), dtype=np.uint64)

    def covered():
        return sorted((n, p) for n, a, b in S.settle(marks, docs, segs) for p in range(a, b))

    want = covered()
    monkeypatch.setattr(S, "SHARD", 500)
    assert covered() == want and want


def test_many_shards_cost_little_more_than_few():
    """4 MiB of one minimizer's segments: every shard is looked up once."""
    rng = np.random.default_rng(2)
    segs = [rng.integers(97, 123, 600).astype(np.uint8).tobytes() for _ in range(7000)]
    segs += [s[100:300] for s in segs[:50]]
    docs = np.arange(len(segs))
    found = {(n, p) for n, a, b in S.settle(np.zeros(len(segs), dtype=np.uint64), docs, segs) for p in range(a, b)}
    assert found == {(7000 + k, p) for k in range(50) for p in range(151)}


def test_many_buckets_and_a_third_without_id(spark, monkeypatch):
    """More buckets than partitions; a third of the rows has no id, a third one id."""
    monkeypatch.setattr(S, "BUCKET", 300)
    rows = [(None if k % 3 == 0 else 77 if k % 3 == 1 else i, t) for k, (i, t) in enumerate(passages(8))]
    rows += rows[:9]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows)


def test_minimizers_depend_on_the_window_alone():
    rng = np.random.default_rng(5)
    window = rng.integers(0, 256, 50).astype(np.uint8)
    for _ in range(20):
        left, right = rng.integers(0, 256, rng.integers(0, 60)), rng.integers(0, 256, rng.integers(0, 60))
        m = S.minimizers(np.concatenate([left, window, right]).astype(np.uint8))
        assert m[len(left)] == S.minimizers(window)[0]


def test_settled_spans_are_packed_by_bucket():
    """What a chunk settles is sent on in one row a bucket, not one a document."""
    import pyarrow as pa
    rng = random.Random(5)
    line = lambda n: "".join(rng.choices("abcdefghij", k=n))
    shared = line(200)
    texts = [line(60) + shared + line(60) for _ in range(300)]
    marks = [np.unique(S.minimizers(np.frombuffer(t.encode(), dtype=np.uint8))).tobytes() for t in texts]
    docs = pa.RecordBatch.from_arrays(
        [pa.array(range(300), pa.int64()), pa.array([i * 7919 for i in range(300)], pa.int64()), pa.array(texts),
         pa.array(marks, pa.binary()), pa.array([False] * 300)], ["id", "hash", "text", "marks", "copy"])
    cut = list(S._cut_segments(4)(iter([docs])))
    settled = list(S._settle_segments(4)(iter(cut)))
    assert sum(b.num_rows for b in settled) <= 4 * sum(b.num_rows for b in cut) <= 20
    ids = {int(i) for b in settled for x in b.column("ids").to_pylist() for i in np.frombuffer(x, dtype="<i8")}
    assert ids == set(range(1, 300))


def sent(batches):
    return sum(len(x) for b in batches for c in b.columns if str(c.type) == "binary" for x in c.to_pylist() if x)


def test_lists_and_segments_travel_packed():
    """Less than 10 bytes a listed minimizer (17 in full), and a segment takes fewer bytes than it has."""
    import pyarrow as pa
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(2000)]
    shared = " ".join(rng.choices(words, k=400))
    texts = [" ".join(rng.choices(words, k=200)) + shared[k % 50:] for k in range(200)]
    hashes = [rng.randrange(-(1 << 63), 1 << 63) for _ in texts]
    marks = [np.unique(S.minimizers(np.frombuffer(t.encode(), dtype=np.uint8))) for t in texts]
    docs = pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(texts)], ["hash", "text"])
    assert sent(S._list_minimizers(4)(iter([docs]))) < 10 * sum(map(len, marks))
    docs = pa.RecordBatch.from_arrays(
        [pa.array(range(200), pa.int64()), pa.array(hashes, pa.int64()), pa.array(texts),
         pa.array([m.tobytes() for m in marks], pa.binary()), pa.array([False] * 200)], ["id", "hash", "text", "marks", "copy"])
    cut = [S.minimizers(np.frombuffer(t.encode(), dtype=np.uint8)) for t in texts]
    segments = {t[a:b + 49] for t, m in zip(texts, cut) for a, b in zip(*S.runs_of(m))}
    assert sent(S._cut_segments(4)(iter([docs]))) < sum(map(len, segments))


def test_packed_numbers_come_back():
    for kind in (S._I64, S._I32, S._U8, S._U64):
        low, high = np.iinfo(kind).min, np.iinfo(kind).max
        for values in ([], [low], [high], [low, high, 0, 1, 1]):
            values = np.array(values, dtype=kind)
            assert S._unpack(S._pack(values, kind), kind).tolist() == values.tolist()
    h = np.array([5, S.NO_ID, 5, (1 << 63) - 1, -1, S.NO_ID], dtype=np.int64)
    assert S._unpack_hashes(*S._pack_hashes(h)).tolist() == h.tolist()
    marks = np.array([0, 3, 3, (1 << 64) - 1], dtype=np.uint64)
    assert S._unpack_sorted(S._pack_sorted(marks)).tolist() == marks.tolist()


def test_shuffle_files_of_the_lists_are_removed_once_written(spark, monkeypatch):
    key, held = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", {}
    before = spark.conf.get(key)
    write = S.written

    def written(df, name):
        held[name] = spark.conf.get(key)
        return write(df, name)

    monkeypatch.setattr(S, "written", written)
    S.dedup_substrings(spark.createDataFrame(passages(3), "doc_id long, text string"))
    assert held["sd-notes"] == "true"
    assert spark.conf.get(key) == before
