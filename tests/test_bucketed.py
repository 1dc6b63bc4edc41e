"""Tables in buckets by key, and one round of asking a carrier."""

import datetime as dt
import json
import time
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parcelworks.operators import classify
from parcelworks.operators.keyed import left_join
from parcelworks.plans import carrier_refresh, queries
from parcelworks.sources import bucketed, history, sinks

SMALL = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    left = spark.createDataFrame([(f"k{i % 7}" if i % 5 else None, i) for i in range(60)], "k string, v int")
    right = spark.createDataFrame([("k1", "x"), ("k2", "y"), ("k2", "z"), (None, "w"), ("k9", "q")], "awb string, w string")
    name = tmp_path.name.replace("-", "_")
    stored = [
        bucketed.store_bucketed(left, f"l_{name}", str(tmp_path / "l"), "k", 4),
        bucketed.store_bucketed(right, f"r_{name}", str(tmp_path / "r"), "awb", 4),
    ]
    yield left, right, *stored
    for side in "lr":
        spark.sql(f"drop table {side}_{name}")


def test_stored_join_equals_the_join_and_exchanges_nothing(spark, tables):
    left, right, stored, other = tables
    want = left_join(left, right, "k", "awb")
    got = bucketed.join_stored(stored, other)
    assert rows(got.drop(bucketed.JOIN_KEY), "k", "v", "awb", "w") == rows(want, "k", "v", "awb", "w")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(bucketed.join_stored(stored, other))
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert "Exchange" in _plan(left_join(left, right, "k", "awb"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_refresh_goes_to_the_buckets(spark, tables):
    _, _, stored, _ = tables
    new = bucketed.with_join_key(spark.createDataFrame([("k1", 1), (None, 2)], "k string, n int"), "k", "new")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = bucketed.join_stored(stored, new.select(bucketed.JOIN_KEY), "left_anti")
        plan = _plan(kept)
        # The one exchange is that of the refresh.
        assert plan.count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert kept.where("k = 'k1'").count() == 0 and kept.count() == stored.where("k is null or k <> 'k1'").count()
    with pytest.raises(ValueError, match="join_key"):
        bucketed.with_join_key(new, "k", "again")


def test_classify_stored(spark, tmp_path):
    lines = spark.createDataFrame(
        [("1", "A", "Yes", "No", "x"), ("2", None, "No", "Yes", "x")],
        "suborder_no string, tracking_number string, shipping_status_new string, cancelled_status string, order_status string",
    )
    shipped = spark.createDataFrame(
        [("A", "Delivered", "", "")], "awb_no string, status string, delivered_date string, pickup_date string"
    )
    want = rows(classify.classify_orders(lines, shipped), "suborder_no", "final_status")
    a = bucketed.store_bucketed(lines, "c_lines", str(tmp_path / "l"), "tracking_number", 2)
    b = bucketed.store_bucketed(shipped, "c_shipped", str(tmp_path / "s"), "awb_no", 2)
    got = classify.classify_stored(a, b)
    assert rows(got, "suborder_no", "final_status") == want and bucketed.JOIN_KEY not in got.columns
    for name in ("c_lines", "c_shipped"):
        spark.sql(f"drop table {name}")


def _body(*keys):
    return json.dumps({"ShipmentData": [{"Shipment": {"AWB": k, "Status": {"Status": "Delivered", "StatusType": "DL"}}} for k in keys]})


def test_a_round_of_asking(spark, tmp_path):
    root, letters = str(tmp_path / "history"), str(tmp_path / "letters")
    schema = "awb_number string, status string, mapped_status string"
    stored = [("A", "In Transit", "active"), ("B", "Delivered", "status_completed"), ("C", "In Transit", "active"), ("D", "x", "status_completed")]
    history.start_history(spark.createDataFrame(stored, schema), root, "awb_number", buckets=2)
    recent = spark.createDataFrame([("D",), ("N",), (None,)], "tracking_number string")
    seen = []

    def ask(requests):
        seen.append(sorted(k for r in requests.collect() for k in r["awbs"].split(",")))
        return spark.createDataFrame([("1", _body("A", "D", "N", None)), ("2", "{"), ("3", "")], "awb string, body string")

    for _ in range(2):  # the second time nothing changes
        counts = carrier_refresh.poll_round(recent, root, ask, letters, dt.date(2024, 5, 1), 1)
    assert seen[0] == ["A", "C", "D", "N"]
    assert (counts["n_letters"], counts["n_unanswered"], counts["n_refreshed"]) == (4, 1, 3)
    got = rows(history.read_history(spark, root).select("awb_number", "status", "mapped_status"))
    assert got == [
        ("A", "Delivered", "status_completed"), ("B", "Delivered", "status_completed"), ("C", "In Transit", "active"),
        ("D", "x", "status_completed"), ("N", "Delivered", "status_completed"),
    ]
    lost = rows(sinks.read_batches(spark, letters).select("awb", "reason"))
    assert ("C", "no_answer") in lost and ("2", "not_json") in lost and ("3", "empty") in lost
    assert history.read_history(spark, root).where(F.col("awb_number") == "C").count() == 1


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark, tmp_path):
    before = _shuffle_files(spark)
    df = spark.range(50, numPartitions=4).select(F.col("id").cast("string").alias("k"), "id")
    stored = bucketed.store_bucketed(df, "left_alone", str(tmp_path / "t"), "k", 3)
    until = time.time() + 10
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before and stored.count() == 50
    spark.sql("drop table left_alone")


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables here")
def test_stored_lines_hold_what_their_status_reads(spark, monkeypatch):
    held = []
    store = bucketed.store_bucketed
    monkeypatch.setattr(bucketed, "store_bucketed", lambda df, *a: held.append(len(df.columns)) or store(df, *a))
    df = queries.QUERIES["classify_stored"](spark, SMALL)
    assert held == [6, 5]
    assert rows(df) == rows(queries.QUERIES["classify_orders"](spark, SMALL))


def test_buckets_follow_the_rows():
    assert [bucketed.bucket_count(n) for n in (0, 3_200_000, 3_200_001, 216_000_000)] == [8, 8, 9, 540]
