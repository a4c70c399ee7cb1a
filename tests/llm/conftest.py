import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, host string, shard string, size long"


def prose(rng, n, vocab=300):
    return " ".join(f"{rng.choice('abcdefgh')}w{rng.randrange(vocab)}" for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns
    whose names clash with the operators' own."""
    rng = random.Random(5)
    license_line = "All rights reserved under the common corpus license, see the notice file for terms."
    rows = []

    def add(doc_id, text, source="a"):
        rows.append((doc_id, text, "en", source, None if text is None else len(text), "h", "x", 1))

    for k in range(60):
        lines = [prose(rng, 12) for _ in range(8)]
        add(k, "\n".join([license_line] + lines if k % 2 else lines), source="a" if k % 3 else "b")
    base = prose(rng, 400)
    for k in range(60, 80):  # near copies
        w = base.split(" ")
        w[rng.randrange(400)] = f"edit{k}"
        add(k, " ".join(w), source="c")
    for k in range(80, 90):  # exact copies
        add(k, base, source="a")
    add(90, None)
    add(91, "")
    add(92, " \t\n ")
    add(93, prose(rng, 30000))
    add(94, "one")
    add(95, "x" * 30000)
    add(96, "é ü ñ 漢字 🙂 <|endoftext|> tail  two   spaces nb\x1c\x85 end ", source=None)
    add(97, "\n".join([license_line] * 3 + ["tiny tail"]), source="a")
    add(98, license_line + "\n" + prose(rng, 5), source="a")
    add(99, "a b c " * 40)
    rows.append((None, prose(rng, 60), None, None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None))
    rows.append(rows[3])  # a repeated row
    rows.append(rows[85])
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def sf_docs(spark):
    import os
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("driver test data not present")
    return spark.read.parquet(f"{path}/documents.parquet")
