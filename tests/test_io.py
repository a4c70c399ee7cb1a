"""Sources, sinks and the exactly-once ingestion."""

import os

from pyspark.sql import functions as F

from orderlake.schemas import PRODUCT_INFO, RAW_EVENT_TEXT
from orderlake.sources import readers as R
from orderlake.sources import sinks as K
from orderlake.sources.seed import exchange_rates
from orderlake.streaming.ingest import ingest_files, job_counters, read_ledger, read_loaded, read_report


def test_seed_is_unique_and_csv_roundtrip(spark, tmp_dir):
    rates = exchange_rates(spark)
    assert rates.count() == 71
    assert rates.select("currency_code").distinct().count() == 71
    assert rates.select("domain").distinct().count() == 71
    path = os.path.join(tmp_dir, "rates")
    rates.write.option("header", True).csv(path)
    back = R.read_seed(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rates.collect()))


def test_tolerant_reader(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p.jsonl")
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"product_id": "1", "name": "ä"}\n\n{"product_id": 2, "price": 12.5}\n{"product_id": "3", "na\n[1,2]\n')
    good, bad = R.read_jsonl_tolerant(spark, path, PRODUCT_INFO)
    assert sorted((r.product_id, r.name) for r in good.collect()) == [("1", "ä"), ("2", None)]
    assert good.filter(F.col("product_id") == "2").first().price == "12.5"
    assert sorted(r.line for r in bad.collect()) == ['[1,2]', '{"product_id": "3", "na']


def test_export_if_absent_and_write_two(spark, tmp_dir):
    df = spark.createDataFrame([("1", "a"), ("2", None)], "product_id string, name string")
    target = os.path.join(tmp_dir, "once")
    assert K.export_if_absent(df, target) == 2
    assert K.export_if_absent(df, target) == 0
    assert K.write_two(df, os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")) == 2
    assert spark.read.json(os.path.join(tmp_dir, "b")).count() == 2


def test_ingest_exactly_once(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    lines = {
        "raw_events_1.jsonl": ['{"collection": "checkout_success", "order_id": "1", "cart_products": {"product_id": "5", "price": "1,00"}}',
                               '{"collection": "checkout_success", "order_id": "2", "cart_products": [{"product_id": "6"}, 7]}'],
        "raw_events_2.jsonl": ['{"collection": "view_product_detail", "product_id": "9", "extra": 1}'],
        "other_1.jsonl": ['{"collection": "checkout_success", "order_id": "x"}'],
    }
    for name, ls in lines.items():
        with open(os.path.join(landing, name), "w") as f:
            f.write("\n".join(ls) + "\n")
    kw = dict(target_path=os.path.join(tmp_dir, "raw"), ledger_path=os.path.join(tmp_dir, "ledger"),
              report_path=os.path.join(tmp_dir, "report"), transform=R.normalize_events)
    ingest_files(spark, landing, "raw_events*.jsonl", RAW_EVENT_TEXT, checkpoint_path=os.path.join(tmp_dir, "c1"), **kw)
    ingest_files(spark, landing, "raw_events*.jsonl", RAW_EVENT_TEXT, checkpoint_path=os.path.join(tmp_dir, "c1"), **kw)
    # a lost checkpoint: the ledger still prevents a second load
    ingest_files(spark, landing, "raw_events*.jsonl", RAW_EVENT_TEXT, checkpoint_path=os.path.join(tmp_dir, "c2"), **kw)
    loaded = read_loaded(spark, kw["target_path"])
    assert loaded.count() == 3
    carts = {r.order_id: [c.product_id for c in r.cart_products] for r in loaded.filter("order_id is not null").collect()}
    assert carts == {"1": ["5"], "2": ["6"]}
    assert read_ledger(spark, kw["ledger_path"]).count() == 2
    c = job_counters(read_report(spark, kw["report_path"])).first()
    assert (c.success, c.skipped, c.failed, c.rows_written) == (2, 2, 0, 3)
    # a new file is picked up once
    with open(os.path.join(landing, "raw_events_3.jsonl"), "w") as f:
        f.write('{"collection": "checkout_success", "order_id": "3", "cart_products": []}\n')
    with open(os.path.join(landing, "raw_events_4.jsonl"), "w") as f:
        f.write('{"collection": "checkout_success", "order_id": "4"}\n{"collection": "che\n')
    ingest_files(spark, landing, "raw_events*.jsonl", RAW_EVENT_TEXT, checkpoint_path=os.path.join(tmp_dir, "c1"), **kw)
    assert read_loaded(spark, kw["target_path"]).count() == 4
    report = read_report(spark, kw["report_path"])
    assert [r.file_name for r in report.filter("status = 'FAILED'").collect()] == ["raw_events_4.jsonl"]
    assert read_ledger(spark, kw["ledger_path"]).count() == 3


def test_materialize_layers(spark, tmp_dir):
    df = spark.createDataFrame([(1,)], "k int")
    back = K.materialize(df, "warehouse", "t", root=tmp_dir)
    assert back.count() == 1 and os.path.isdir(os.path.join(tmp_dir, "warehouse", "t"))


def test_text_sink_and_urls_reader(spark, tmp_dir):
    df = spark.createDataFrame([("7", ["b", "a"]), ("8", [])], "product_id string, urls array<string>")
    K.write_jsonl(df, os.path.join(tmp_dir, "urls"))
    back = R.read_urls(spark, os.path.join(tmp_dir, "urls"))
    assert sorted((r.product_id, tuple(r.urls)) for r in back.collect()) == [("7", ("b", "a")), ("8", ())]
    K.write_text_lines(df, "product_id", os.path.join(tmp_dir, "ids"))
    assert sorted(r.value for r in spark.read.text(os.path.join(tmp_dir, "ids")).collect()) == ["7", "8"]


def test_catalog_layers(spark, tmp_dir):
    from orderlake.sources.readers import read_table
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    K.ensure_layers(spark, ["staging_t"])
    back = K.materialize(df, "staging_t", "t1", as_table=True)
    assert back.collect()[0].v == "a"
    assert read_table(spark, "staging_t.t1").count() == 1
    df.write.parquet(os.path.join(tmp_dir, "p"))
    assert read_table(spark, "logical", {"logical": os.path.join(tmp_dir, "p")}).count() == 1
    K.as_view(df, "v_t1")
    assert spark.table("v_t1").count() == 1


def test_urls_last_line_wins_and_csv_locations(spark, tmp_dir):
    path = os.path.join(tmp_dir, "urls.jsonl")
    with open(path, "w") as f:
        f.write('{"product_id": "1", "urls": ["a"]}\n{"product_id": "2", "urls": ["b"]}\n{"product_id": "1", "urls": ["c", "d"]}\n')
    got = {r.product_id: r.urls for r in R.read_urls(spark, path).collect()}
    assert got == {"1": ["c", "d"], "2": ["b"]}
    csv = os.path.join(tmp_dir, "ip.csv")
    with open(csv, "w") as f:
        f.write("ip,country,region,city\n1.2.3.4,Viet Nam,Ha Noi,\n5.6.7.8,,,\n")
    rows = sorted(tuple(r) for r in R.read_ip_locations(spark, csv, fmt="csv").collect())
    assert rows == [("1.2.3.4", "Viet Nam", "Ha Noi", None), ("5.6.7.8", None, None, None)]


def test_ingest_continuous_trigger(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "raw_events_a.jsonl"), "w") as f:
        f.write('{"collection": "checkout_success", "order_id": "1"}\n')
    kw = dict(target_path=os.path.join(tmp_dir, "raw"), ledger_path=os.path.join(tmp_dir, "ledger"),
              report_path=os.path.join(tmp_dir, "report"), transform=R.normalize_events)
    q = ingest_files(spark, landing, "raw_events*.jsonl", RAW_EVENT_TEXT, checkpoint_path=os.path.join(tmp_dir, "c"),
                     processing_time="1 second", **kw)
    try:
        q.processAllAvailable()
        with open(os.path.join(landing, "raw_events_b.jsonl"), "w") as f:
            f.write('{"collection": "checkout_success", "order_id": "2"}\n')
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.order_id for r in read_loaded(spark, kw["target_path"]).collect()) == ["1", "2"]


def test_build_job_runs_all_checks(spark, tmp_dir):
    from orderlake.jobs import run_checks
    from orderlake.plans.build import build_warehouse
    from orderlake.queries import Inputs
    i = Inputs(spark, "/root/testdata/sf0.001")
    star = build_warehouse(i.raw_events(), i.product_info(), i.ranges(), i.rates(), tmp_dir)
    res = {(r.check_type, r.check_name): r.failures for r in run_checks(star).collect()}
    assert len(res) == 27
    assert res[("not_null", "fact_sales_order.fact_sales_order_key")] > 0   # planted invalid product ids
    assert res[("relationships", "fact_sales_order.customer_key")] == 0


def test_extract_job(spark, tmp_dir):
    from orderlake.jobs import main
    from orderlake.queries import Inputs
    i = Inputs(spark, "/root/testdata/sf0.001")
    events = i.raw_events().drop("option", "cart_products").unionByName(
        i.behaviour().drop("option_json"), allowMissingColumns=True)
    events.write.parquet(os.path.join(tmp_dir, "events"))
    i.table("pages").select("url", "html").write.parquet(os.path.join(tmp_dir, "pages"))
    i.ranges().write.parquet(os.path.join(tmp_dir, "ranges"))
    out = os.path.join(tmp_dir, "out")
    assert main(["extract", "--events", os.path.join(tmp_dir, "events"), "--pages", os.path.join(tmp_dir, "pages"),
                 "--ip-ranges", os.path.join(tmp_dir, "ranges"), "--pattern", r"track\((\d+)\)", "--out", out]) == 0
    assert spark.read.json(os.path.join(out, "product_info")).count() > 0
    assert spark.read.json(os.path.join(out, "urls")).count() > 0
    assert spark.read.json(os.path.join(out, "ip_locations")).count() > 0


def test_ingest_crash_between_data_and_ledger(spark, tmp_dir):
    """Rows were written but the ledger append was lost (a crash between the two
    steps): the rerun loads the file again into its own partition, no duplicates."""
    from orderlake.schemas import LOAD_TRACKING
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "raw_events_a.jsonl"), "w") as f:
        f.write('{"collection": "checkout_success", "order_id": "1"}\n{"collection": "checkout_success", "order_id": "2"}\n')
    kw = dict(target_path=os.path.join(tmp_dir, "raw"), ledger_path=os.path.join(tmp_dir, "ledger"),
              report_path=os.path.join(tmp_dir, "report"), transform=R.normalize_events)
    ingest_files(spark, landing, "raw_events*.jsonl", RAW_EVENT_TEXT, checkpoint_path=os.path.join(tmp_dir, "c1"), **kw)
    spark.createDataFrame([], LOAD_TRACKING).write.mode("overwrite").parquet(kw["ledger_path"])  # the lost append
    ingest_files(spark, landing, "raw_events*.jsonl", RAW_EVENT_TEXT, checkpoint_path=os.path.join(tmp_dir, "c2"), **kw)
    assert sorted(r.order_id for r in read_loaded(spark, kw["target_path"]).collect()) == ["1", "2"]
    assert read_ledger(spark, kw["ledger_path"]).count() == 1


def test_url_hand_off_round_trip(spark, tmp_dir):
    from orderlake.plans import extract as X
    rows = [("view_product_detail", "hot", None, f"u{n:03d}", None) for n in range(120)]
    ev = spark.createDataFrame(rows, "collection string, product_id string, viewing_product_id string, "
                                     "current_url string, referrer_url string")
    K.write_jsonl(X.product_urls(ev), os.path.join(tmp_dir, "urls"))
    back = R.read_url_pairs(spark, os.path.join(tmp_dir, "urls"))
    assert sorted(map(tuple, back.collect())) == [("hot", f"u{n:03d}") for n in range(120)]


def test_build_job_exit_status(spark, tmp_dir):
    """The build job exits 1 when a declared check fails (the planted invalid product
    ids give null fact keys)."""
    from orderlake.jobs import main
    from orderlake.queries import Inputs
    i = Inputs(spark, "/root/testdata/sf0.001")
    i.raw_events().write.parquet(os.path.join(tmp_dir, "raw"))
    i.product_info().write.json(os.path.join(tmp_dir, "products"))
    i.ranges().write.parquet(os.path.join(tmp_dir, "ranges"))
    assert main(["build", "--raw", os.path.join(tmp_dir, "raw"), "--products", os.path.join(tmp_dir, "products"),
                 "--ip-ranges", os.path.join(tmp_dir, "ranges"), "--out", os.path.join(tmp_dir, "wh")]) == 1


def test_failed_export_is_repeated(spark, tmp_dir):
    import os

    from orderlake.sources import sinks as K
    target = f"{tmp_dir}/left-by-a-failed-run"
    os.makedirs(target)
    assert K.export_if_absent(spark.range(3), target) == 3
    assert K.export_if_absent(spark.range(3), target) == 0


def test_same_file_name_in_two_folders_loads_both(spark, tmp_dir):
    import os

    from pyspark.sql import types as T

    from orderlake.streaming.ingest import ingest_files, read_loaded
    for day, k in (("a", 1), ("b", 2)):
        os.makedirs(f"{tmp_dir}/in/{day}")
        with open(f"{tmp_dir}/in/{day}/raw_events_1.jsonl", "w") as f:
            f.write('{"k": %d}\n' % k)
    kw = dict(target_path=f"{tmp_dir}/t", ledger_path=f"{tmp_dir}/l", report_path=f"{tmp_dir}/r")
    for ckpt in ("c1", "c2"):
        ingest_files(spark, f"{tmp_dir}/in/*", "raw_events*.jsonl", T.StructType([T.StructField("k", T.LongType())]),
                     checkpoint_path=f"{tmp_dir}/{ckpt}", **kw)
    assert sorted(r.k for r in read_loaded(spark, kw["target_path"]).collect()) == [1, 2]


def test_malformed_lines_give_no_record(spark, tmp_dir):
    with open(f"{tmp_dir}/p.jsonl", "w") as f:
        f.write('{"product_id": 1, "name": "a"}\n{"product_id": "2", "na\n7\n[{"product_id": "3"}]\n\n{"product_id": "4"}\n')
    assert [(r.product_id, r.name) for r in R.read_product_info(spark, f"{tmp_dir}/p.jsonl").collect()] == [("1", "a"), ("4", None)]
    with open(f"{tmp_dir}/ip.jsonl", "w") as f:
        f.write('{"ip": "1.1.1.1", "country": "X"}\n{"ip": "2.2\n')
    assert [r.ip for r in R.read_ip_locations(spark, f"{tmp_dir}/ip.jsonl").collect()] == ["1.1.1.1"]


def test_digests_prove_both_copies(spark, tmp_dir, monkeypatch):
    df = spark.createDataFrame([("a", 1, ["x"]), ("a", 1, ["x"]), (None, None, None), ("", 2, [])], "s string, n int, l array<string>")
    one = df.agg(*K.digest_columns(df)).first()
    assert one == df.repartition(3).agg(*K.digest_columns(df)).first() and one.n_rows == 4
    for other in (df.dropDuplicates(), df.fillna(""), df.filter("s is not null")):
        assert other.agg(*K.digest_columns(other)).first() != one
    assert K.write_two(df, f"{tmp_dir}/a", f"{tmp_dir}/b") == 4
    assert spark.read.schema(df.schema).json(f"{tmp_dir}/b").agg(*K.digest_columns(df)).first() == one
    digests = iter([(4, 1, 1), (4, 1, 2)])
    monkeypatch.setattr(K, "write_digested", lambda d, p, fmt: (d.write.mode("overwrite").json(p), next(digests))[1])
    import pytest
    with pytest.raises(RuntimeError):
        K.write_two(df, f"{tmp_dir}/c", f"{tmp_dir}/d")
