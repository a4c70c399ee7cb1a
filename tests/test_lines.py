"""Line numbers of split files: positions against the files as Python reads them."""

import json
import os

import pytest
from pyspark.sql import functions as F

from orderlake.plans.export import load_products
from orderlake.schemas import PRODUCT_INFO
from orderlake.sources import lines as L
from orderlake.sources import readers as R


@pytest.fixture()
def small_blocks(spark):
    """Blocks of 100 bytes, so that every file is cut into many."""
    names = {"spark.sql.files.maxPartitionBytes": "100", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        f.write(text)


def numbers(spark, folder, table):
    tagged = L.tagged_lines(spark, folder, table)
    rows = L.with_line_number(tagged, tagged).select(F.substring_index("_file", "/", -1).alias("f"), "line_no", "value").collect()
    blocks = tagged.select("_file", "_block").distinct().count()
    return sorted(tuple(r) for r in rows), blocks


def test_numbers_of_many_blocks(spark, tmp_dir, small_blocks):
    files = {
        "a.txt": "".join(f"line {i} {'é' * (i % 40)}\n" for i in range(300)),
        "b.txt": "\n\n" + "x" * 950 + "\n\nafter a line of many blocks",   # blocks without a line start
        "c.txt": "\r\n".join(["windows", "", "ends"] * 30),
        "d.txt": "",
        "e.txt": "\n" * 400,
    }
    for name, text in files.items():
        write(f"{tmp_dir}/in", name, text)
    got, blocks = numbers(spark, f"{tmp_dir}/in", f"{tmp_dir}/lines")
    want = []
    for name, text in files.items():
        want += [(name, i, v) for i, v in enumerate(text.replace("\r\n", "\n").removesuffix("\n").split("\n") if text else [], 1)]
    assert got == sorted(want)
    assert blocks > 50


def test_rejects_carry_file_and_line(spark, tmp_dir, small_blocks):
    texts = {}
    for f in range(3):
        out = []
        for i in range(80):
            line = json.dumps({"product_id": str(f * 100 + i), "name": f"n{i}"})
            out.append("" if i % 9 == 4 else "[1, 2]" if i % 13 == 5 else line[:7] if i % 7 == f else line)
        texts[f"p{f}.jsonl"] = out
        write(f"{tmp_dir}/in", f"p{f}.jsonl", "\n".join(out))
    loaded = load_products(spark, f"{tmp_dir}/in", f"{tmp_dir}/table", rejects=f"{tmp_dir}/rejects")
    bad = spark.read.parquet(f"{tmp_dir}/rejects").collect()
    want = {(f, n, x) for f, out in texts.items() for n, x in enumerate(out, 1) if x and not x.endswith("}")}
    assert {(r.file.rsplit("/", 1)[1], r.line_no, r.line) for r in bad} == want and len(bad) == len(want)
    good = {json.loads(x)["product_id"] for out in texts.values() for x in out if x.endswith("}")}
    assert {r.product_id for r in loaded.collect()} == good
    assert loaded.columns == PRODUCT_INFO.names


def test_all_lines_good_gives_no_rejects(spark, tmp_dir):
    write(f"{tmp_dir}/in", "p.jsonl", '{"product_id":"1"}\n{"product_id":"2"}\n')
    load_products(spark, f"{tmp_dir}/in", f"{tmp_dir}/table", rejects=f"{tmp_dir}/rejects")
    assert spark.read.parquet(f"{tmp_dir}/rejects").count() == 0


def test_later_line_wins_over_blocks_and_files(spark, tmp_dir, small_blocks):
    want = {}
    for f in range(4):
        out = []
        for i in range(120):
            record = {"product_id": str((i * 7 + f) % 23), "urls": [f"https://s/{f}/{i}"] * (1 + i % 3)}
            out.append(json.dumps(record))
            want[record["product_id"]] = record["urls"]
        write(f"{tmp_dir}/urls", f"part-{f}.json", "\n".join(out) + "\n")
    assert {r.product_id: r.urls for r in R.read_urls(spark, f"{tmp_dir}/urls").collect()} == want
