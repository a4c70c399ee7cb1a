"""Files that queries write between their steps take little disk: lines are gzipped, loaded
rows are packed, and the shuffle of the tables they are made from is gone once they are written."""

import datetime
import glob
import os
import threading

import pytest

from orderlake import queries as Q
from orderlake import session
from orderlake.schemas import RAW_EVENT
from orderlake.streaming.feeds import feed_counters, ingest_feeds, read_feed, read_outcomes
from orderlake.streaming.publish import PublishedTable

ORDERS, LINES = 20, 7  # line number 7 has an empty cart, every fourth a second item
ITEMS = ORDERS * (LINES - 1) + ORDERS


@pytest.fixture()
def inputs(spark, tmp_dir, monkeypatch):
    """Small tables, and a known folder for what a query writes."""
    day = datetime.datetime(2024, 5, 1)
    rows = {
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp",
                   [(k, k % 9, "OFP"[k % 3], day) for k in range(1, ORDERS + 1)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string",
                     [(k, k * n, n, 2.0, 10.5 * n, "N") for k in range(1, ORDERS + 1) for n in range(1, LINES + 1)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(k, f"part {k}", "Brand#11", "RING", k, 9.75 * k) for k in range(1, 23)]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(k, f"nation {k}", 0) for k in range(25)]),
        "region": ("r_regionkey int, r_name string", [(0, "EUROPE")]),
    }
    for name, (schema, data) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_dir}/tables/{name}.parquet")
    monkeypatch.setattr(session, "scratch_path", lambda spark, name: f"{tmp_dir}/scratch/{name}")
    return Q.Inputs(spark, f"{tmp_dir}/tables")


def written(tmp_dir, folder):
    return [f for f in glob.glob(f"{tmp_dir}/scratch/{folder}/**/part-*", recursive=True) if os.path.isfile(f)]


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def packed(files):
    return len(files) > 0 and {f.rsplit(".", 1)[1] for f in files} == {"gz"}


def test_jsonl_roundtrip(spark, inputs, tmp_dir):
    before = shuffle_files(spark)
    out = Q.jsonl_roundtrip(inputs)
    assert packed(written(tmp_dir, "raw-jsonl")) and shuffle_files(spark) <= before
    key = lambda df: sorted(map(str, df.collect()))
    assert out.count() > 0 and key(out) == key(Q.cart_explode(inputs))


def test_normalize_record(spark, inputs, tmp_dir):
    before = shuffle_files(spark)
    out = Q.normalize_record_q(inputs)
    assert packed(written(tmp_dir, "raw-normalize")) and shuffle_files(spark) <= before
    assert out.count() == ORDERS * LINES and out.agg({"n_items": "sum"}).first()[0] == ITEMS


def test_event_export(spark, inputs, tmp_dir):
    before = shuffle_files(spark)
    out = Q.event_export(inputs)
    assert packed(written(tmp_dir, "raw-event-export")) and shuffle_files(spark) <= before
    assert out.count() == ORDERS * LINES and out.agg({"n_items": "sum"}).first()[0] == ITEMS


def test_ingest_idempotent(spark, inputs, tmp_dir):
    out = Q.ingest_idempotent(inputs)
    assert packed(written(tmp_dir, "landing"))
    loaded = written(tmp_dir, "ingest/raw_events")
    assert loaded and all(f.endswith(".zstd.parquet") for f in loaded)
    status = sorted(r.status for r in spark.read.parquet(f"{tmp_dir}/scratch/ingest/load_report").collect())
    files = len(written(tmp_dir, "landing"))
    assert status == ["DUPLICATE_SKIPPED"] * files + ["SUCCESS"] * files
    assert out.count() == Q.cart_explode(inputs).count() > 0


def test_feed_rows(spark, inputs, tmp_dir):
    out = Q.feed_rows(inputs)
    loaded = written(tmp_dir, "feeds/data")
    assert loaded and all(f.endswith(".zstd.parquet") for f in loaded)
    counts = {r.feed: r["count"] for r in out.groupBy("feed").count().collect()}
    assert counts["raw_events"] == ORDERS * LINES and counts["product_info"] == inputs.product_info().count()


def test_landed_feeds(spark, inputs, tmp_dir):
    before = shuffle_files(spark)
    Q._landed_feeds(inputs)
    for name in ("raw_events", "product_info", "ip_locations", "product_info_cut"):
        assert packed(written(tmp_dir, f"feeds-landing/{name}")), name
    assert shuffle_files(spark) <= before


def test_ingests_at_once_write_rows_once(spark, tmp_dir, monkeypatch):
    """The second ingest starts while the first one has written its rows, not published them."""
    import time
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/raw_events_1.jsonl", "w") as f:
        f.write('{"order_id": "1"}\n{"order_id": "2"}\n')
    publish, failures = PublishedTable.publish, []

    def slow(self, manifest, settle=None):
        time.sleep(4)
        return publish(self, manifest, settle)

    def go(k):
        try:
            ingest_feeds(spark, f"{tmp_dir}/in", f"{tmp_dir}/t", f"{tmp_dir}/c{k}")
        except Exception as e:  # noqa: BLE001
            failures.append(e)

    monkeypatch.setattr(PublishedTable, "publish", slow)
    threads = [threading.Thread(target=go, args=(k,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failures
    assert len(glob.glob(f"{tmp_dir}/t/data/*/feed=raw_events")) == 1
    outcomes = {(r.feed, r.status): (r.files, r.rows) for r in feed_counters(read_outcomes(spark, f"{tmp_dir}/t")).collect()}
    assert outcomes == {("raw_events", "SUCCESS"): (1, 2), ("raw_events", "DUPLICATE_SKIPPED"): (1, 0)}
    assert sorted(r.order_id for r in read_feed(spark, f"{tmp_dir}/t", "raw_events", RAW_EVENT).collect()) == ["1", "2"]
