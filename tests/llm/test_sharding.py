import binascii
import random

import numpy as np
import pytest

from orderlake.llm.sharding import _difference_items, difference, shard_documents, shard_items


def test_differencing_labels_give_the_sums():
    rng = np.random.default_rng(0)
    parts = [rng.integers(0, 1000, 7) for _ in range(50)]
    sums, where = difference(parts)
    again = np.zeros(7, dtype=np.int64)
    for p, w in zip(parts, where):
        assert sorted(w) == list(range(7))
        np.add.at(again, w, p)
    assert (again == sums).all()


def test_blocks_stay_balanced():
    sizes = np.random.default_rng(1).lognormal(7, 1.2, 20000).astype(np.int64)
    labels, sums = _difference_items(sizes, 40)
    assert (np.bincount(labels, sizes, 40).astype(np.int64) == sums).all()
    assert sums.max() - sums.min() < 0.001 * sums.mean()


def check(out, rows, n):
    assert len(out) == len(rows)
    want = sorted(((r[0] is not None, r[0] or 0, len((r[1] or "").encode()) + 16, binascii.crc32((r[1] or "").encode()))
                   for r in rows))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in out) == want
    shards = {}
    for r in out:
        assert 0 <= r["shard"] < n and r["law"] == "bytes" and r["grown_shard"] is None
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    return [sum(r["size"] for r in out if r["shard"] == k) for k in range(n)]


def test_edge_documents(edge_docs, edge_rows, no_docs):
    check(shard_documents(edge_docs, 5).collect(), [r[:2] for r in edge_rows], 5)
    assert shard_documents(no_docs, 5).count() == 0


def test_balance_and_groups(spark):
    rng = random.Random(4)
    rows = [(k, "t" * int(rng.lognormvariate(5, 1)) + str(k % 900)) for k in range(1200)]
    rows += [(k, "copied text of a hot group " * 9) for k in range(5000, 5600)]  # about a third of all bytes
    out = shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    bytes_of = check(out, rows, 10)
    assert max(bytes_of) - min(bytes_of) <= 0.02 * sum(bytes_of) / 10
    text, where = dict(rows), {}
    for r in out:
        where.setdefault(text[r["doc_id"]], set()).add(r["shard"])
    hot = where.pop("copied text of a hot group " * 9)
    assert len(hot) > 1 and all(len(s) == 1 for s in where.values())


@pytest.mark.parametrize("partitions", [32, 200])
def test_balance_on_skewed_groups(spark, partitions):
    """A hot third and groups of 0.1 to 0.9 shard among small items, 40 shards. The sizes
    are those of rows that stand for texts."""
    rng = np.random.default_rng(7)
    sizes = rng.lognormal(7, 1.2, 8000).astype(np.int64) + 16
    mean = sizes.sum() / 40 / (2 / 3 - 0.125)  # 0.1 + ... + 0.9 + 0.5 = 5 shards
    groups = [x / 10 for x in range(1, 10)] + [0.5]
    rows = [(k, f"t{k}", int(s)) for k, s in enumerate(sizes)]
    rows += [(10000 + 100 * g + k, f"g{g}", int(x * mean / 50)) for g, x in enumerate(groups) for k in range(50)]
    rows += [(None, "hot", int(mean * 40 / 3 / 3000)) for _ in range(3000)]
    df = spark.createDataFrame([(d, n, t.encode(), s) for n, (d, t, s) in enumerate(rows)],
                               "doc_id long, _row long, _key binary, size long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        out = shard_items(df, 40).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    sums, where = np.zeros(40), {}
    for r in out:
        sums[r["shard"]] += r["size"]
        where.setdefault(bytes(r["_key"]), set()).add(r["shard"])
    assert len(out) == len(rows) and sums.max() - sums.min() <= 0.02 * sums.mean()
    assert len(where.pop(b"hot")) > 1 and all(len(s) == 1 for s in where.values())


def test_whole_table(sf_docs):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs.collect()]
    check(shard_documents(sf_docs).collect(), rows, 40)
