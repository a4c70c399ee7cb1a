import os
import re

import pytest

from orderlake.llm.mixing import mix_counts, mix_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(rows, weights=(3, 1, 2), budget=1.5, epochs=2):
    size = {}
    for _, text, source in rows:
        size[source] = size.get(source, 0) + len(WORD.findall(text or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, clamped = budget * sum(size.values()), set()
    while True:
        free = [s for s in order if s not in clamped]
        rest = total - sum(epochs * size[s] for s in clamped)
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > epochs * size[s]}
        if not over:
            return {s: float(epochs * size[s]) if s in clamped else share[s] for s in order}, size
        clamped |= over


def check(df, rows):
    want, size = targets(rows)
    got = mix_counts(df).collect()
    source = {(r[0], len(WORD.findall(r[1] or ""))): r[2] for r in rows}
    taken = dict.fromkeys(size, 0)
    assert len(got) == len(rows)
    for r in got:
        s = source[(r["doc_id"], r["size"])]
        assert r["source_size"] == size[s] and r["target"] == pytest.approx(want[s])
        assert r["taken"] <= 2 * r["size"] and r["taken"] == r["reps"] * r["size"]
        taken[s] += r["taken"]
    for s in size:
        sizes = [len(WORD.findall(r[1] or "")) for r in rows if r[2] == s and r[1]]
        assert abs(want[s] - taken[s]) <= max([1, *sizes])
    return sorted(map(str, got))


def test_edge_documents(edge_docs, edge_rows):
    rows = [(r[0], r[1], r[3]) for r in edge_rows]
    first = check(edge_docs, rows)
    assert first == sorted(map(str, mix_counts(edge_docs.repartition(7)).collect()))  # reruns agree


def test_whole_table(sf_docs):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in sf_docs.collect()]
    check(sf_docs, rows)


def test_taken_words_come_near_the_targets(spark):
    path = "/root/testdata/sf0.01/documents.parquet"  # 50 documents a source
    if not os.path.exists(path):
        pytest.skip("driver test data not present")
    sf_docs = spark.read.parquet(path)
    want, _ = targets([(r["doc_id"], r["text"], r["source"]) for r in sf_docs.collect()])
    out = {r["source"]: r["n"] for r in mix_counts(sf_docs).join(sf_docs.select("doc_id", "source"), "doc_id")
           .groupBy("source").agg({"taken": "sum"}).withColumnRenamed("sum(taken)", "n").collect()}
    assert all(abs(out[s] - want[s]) <= 0.01 * want[s] for s in want)


def test_documents_are_repeated_as_taken(edge_docs):
    words = lambda df: sum(len(WORD.findall(r["text"] or "")) for r in df.collect())
    out = mix_documents(edge_docs)
    assert out.columns == edge_docs.columns
    assert words(out) == sum(r["taken"] for r in mix_counts(edge_docs).collect())


def test_empty(no_docs):
    assert mix_counts(no_docs).count() == 0 and mix_documents(no_docs).count() == 0


def test_rows_without_ids_spread_over_the_bins(spark):
    """A third of the rows have no id: their draws differ by text, so no bin holds them all."""
    from pyspark.sql import functions as F

    from orderlake.llm.mixing import BINS, mix_counts, seeded_draw
    rows = [(None if k % 3 == 0 else k, f"text {k} " + "w " * (k % 7), "s") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    at = seeded_draw(7, F.col("doc_id"), F.xxhash64("text"))
    largest = df.filter("doc_id is null").groupBy(F.expr("0").alias("z"), (at / ((1 << 60) // BINS)).cast("int")).count().agg(F.max("count")).first()[0]
    assert largest < 10
    got = mix_counts(df)
    n, taken, target = got.agg(F.count("*"), F.sum("taken"), F.max("target")).first()
    assert n == 3000 and abs(taken - target) <= 8
