"""Stored scan states, answers as variants, message pieces, counted writes, months that change."""

import datetime as dt
import json
import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parcelworks.operators import answers, batches, corrections, outbox, scan_state, tracking
from parcelworks.plans import order_flow, queries
from parcelworks.sources import sinks

D = dt.date
SMALL = "/root/testdata/sf0.001"
SCANS = "awb string, status string, time timestamp, n int"


def _scans():
    r = random.Random(2)
    kinds = ["PickupDone", "InTransit", "ReturnInitiated", "Delivered", None]
    start = dt.datetime(2024, 1, 1)
    return [
        (r.choice([*"abcdefgh", None]), r.choice(kinds), start + dt.timedelta(hours=r.randint(0, 400)), n) for n in range(200)
    ]


def test_states_day_by_day_equal_one_pass(spark, tmp_path):
    scans = _scans()
    root, order = str(tmp_path / "state"), ["time", "n"]
    days = {}
    for s in scans:
        days.setdefault(s[2].date(), []).append(s)
    some = list(days.values())
    random.Random(1).shuffle(some)
    for part in [*some[:6], [s for p in some[6:] for s in p], some[0]]:  # the last one again
        scan_state.fold_scans(spark.createDataFrame(part, SCANS), root, "awb", order, buckets=4)
    want = rows(tracking.rollup_scan_history(spark.createDataFrame(scans, SCANS), "awb", order))
    assert rows(scan_state.rolled_up(scan_state.read_states(spark, root), "awb")) == want
    with pytest.raises(ValueError, match="4 buckets"):
        scan_state.fold_scans(spark.createDataFrame(scans, SCANS), root, "awb", order, buckets=5)


def test_only_touched_states_are_written(spark, tmp_path):
    root = tmp_path / "state"
    first = spark.createDataFrame([(f"k{i}", "PickupDone", dt.datetime(2024, 1, 1), i) for i in range(40)], SCANS)
    scan_state.fold_scans(first, str(root), "awb", ["time"], buckets=8)
    before = {p for p in root.rglob("*.parquet") if "bucket=" in str(p)}
    scan_state.fold_scans(first.where("awb = 'k3'").withColumn("status", F.lit("Delivered")), str(root), "awb", ["time"], buckets=8)
    after = {p for p in root.rglob("*.parquet") if "bucket=" in str(p)}
    assert len({p.parent for p in before - after}) == len({p.parent for p in after - before}) == 1
    with pytest.raises(FileNotFoundError):
        scan_state.read_states(spark, str(tmp_path / "none"))
    scan_state.fold_scans(first.limit(0), str(root), "awb", ["time"], buckets=8)
    assert scan_state.read_states(spark, str(root)).count() == 40


def _package(awb="A", **more):
    return {"Shipment": {"AWB": awb, "Status": {"Status": "Delivered", "StatusType": "DL"}, **more}}


def test_answers_keep_unknown_fields_and_say_what_is_wrong(spark, tmp_path):
    listed = lambda *p: json.dumps({"ShipmentData": list(p)})
    docs = [
        ("1", listed(_package("A", PickedupDate="2024-05-01T10:00:00", Note={"zone": [1, "x"]}), _package("B", DeliveryDate="soon"))),
        ("2", listed(_package(None), _package(" "), {"Shipment": {"AWB": 7, "Status": "odd"}}, "no package", 5)),
        ("3", None), ("4", "  "), ("5", '{"ShipmentData": ['), ("6", '{"error": "x"}'), ("7", '{"ShipmentData": []}'),
        ("8", '{"ShipmentData": {"Shipment": 1}}'), ("9", "[1, 2]"),
    ]
    frame = spark.createDataFrame(docs, "awb string, body string")
    path = str(tmp_path / "packages")
    answers.package_rows(frame, D(2024, 6, 1)).write.parquet(path)
    stored = spark.read.parquet(path)
    got = rows(stored, "awb_number", "status", "pickup_date", "delivery_date", "mapped_status", "unreadable")
    assert got == [
        ("7", None, None, None, "active", []),
        ("A", "Delivered", "01-05-2024", None, "status_completed", []),
        ("B", "Delivered", None, None, "status_completed", ["delivery_date"]),
    ]
    # A field that nobody asked for is read from the stored rows.
    zone = F.try_variant_get("package", "$.Shipment.Note.zone[1]", "string")
    assert rows(stored.where("awb_number = 'A'").select(zone)) == [("x",)]
    letters = rows(answers.dead_letters(frame))
    assert letters == sorted([
        ("2", 0, "no_key"), ("2", 1, "no_key"), ("2", 3, "no_key"), ("2", 4, "no_key"), ("3", None, "empty"), ("4", None, "empty"),
        ("5", None, "not_json"), ("6", None, "no_data"), ("7", None, "no_data"), ("8", None, "no_data"), ("9", None, "no_data"),
    ], key=repr)
    scans = spark.createDataFrame([("1", '{"data": [{"awbNumber": "A"}]}'), ("2", '{"data": []}')], "awb string, body string")
    assert rows(answers.dead_letters(scans, answers.SCANS)) == [("2", None, "no_data")]
    assert answers.package_rows(frame.limit(0), D(2024, 6, 1)).count() == 0


FACT = (
    "suborder_no string, order_number string, order_date date, manifested_at date, final_status string, sku string, "
    "shipping_customer_name string, mobile_no string"
)


def test_a_long_list_comes_in_pieces(spark):
    day = D(2024, 5, 1)
    lines = spark.range(20_000).select(
        F.format_string("s%06d", "id").alias("suborder_no"), F.lit("K-1").alias("order_number"), F.lit(day).alias("order_date"),
        F.lit(None).cast("date").alias("manifested_at"), F.lit("Not Shipped").alias("final_status"),
        F.concat(F.lit("p"), F.col("id") % 7).alias("sku"), F.lit("N").alias("shipping_customer_name"), F.lit("1").alias("mobile_no"),
    )
    few = spark.createDataFrame([("b", "K-2", day, None, "Not Shipped", "p1", "M", "2"), ("a", "K-2", day, None, "Not Shipped", "none", "M", "2"),
                                 ("c", "K-3", day, None, "Not Shipped", "none", "M", "2")], FACT)
    products = spark.createDataFrame([(f"p{i}", f"Plant {i}") for i in range(6)], "sku string, product_name string")
    fact = lines.unionByName(few)
    pieces = outbox.product_chunks(fact, products, D(2024, 5, 4), size=300, ranges=6).collect()
    whole = {r["order_no"]: r["product_list"] for r in outbox.delayed_order_outbox(fact, products, D(2024, 5, 4)).collect()}
    parts = sorted((r["order_no"], r["chunk"], r["n_products"], r["product_list"]) for r in pieces)
    assert max(p[2] for p in parts) == 300 and len(parts) > 50
    for order in ("K-1", "K-2"):
        mine = [p for p in parts if p[0] == order]
        assert [p[1] for p in mine] == list(range(len(mine)))
        assert ", ".join(p[3] for p in mine) == whole[order]
    assert whole["K-3"] == "" and not [p for p in parts if p[0] == "K-3"]
    assert outbox.product_chunks(fact.limit(0), products, D(2024, 5, 4)).count() == 0


def test_responses(spark):
    messages = spark.createDataFrame([("K-1", "pending"), ("K-2", "pending"), ("K-3", "pending"), (None, "pending")], "order_no string, msg_status string")
    codes = spark.createDataFrame([("K-1", 200), ("K-2", 404), ("K-9", 200)], "order_no string, status_code int")
    got = rows(outbox.with_responses(messages, codes), "order_no", "msg_status")
    assert got == [("K-1", "sent"), ("K-2", "not_sent"), ("K-3", "pending"), (None, "pending")]


def test_counts_are_taken_while_writing(spark, tmp_path):
    path, log = str(tmp_path / "out"), str(tmp_path / "log")
    passes = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            passes.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([(i, "x" if i % 3 else None) for i in range(10)], "k int, s string").mapInArrow(seen, "k int, s string")
    counts = sinks.write_counted(df, lambda d: sinks.append_rows(d, path), {"n_x": F.col("s") == "x", "n_none": F.col("s").isNull()})
    assert counts == {"n_rows": 10, "n_x": 6, "n_none": 4} and passes.value == 10
    for _ in range(2):
        sinks.log_counts(spark, log, "job", dt.datetime(2024, 1, 2, 3), counts, 5)
    assert rows(sinks.read_batches(spark, log), "script", "updated_at", "metric", "value") == [
        ("job", "2024-01-02 03:00:00", "n_none", 4), ("job", "2024-01-02 03:00:00", "n_rows", 10), ("job", "2024-01-02 03:00:00", "n_x", 6),
    ]
    sinks.append_run_logs(spark.createDataFrame([("a",), ("b",)], "name string"), str(tmp_path / "runs"), dt.datetime(2024, 1, 2, 3))
    assert rows(spark.read.parquet(str(tmp_path / "runs"))) == [("a", "2024-01-02 03:00:00"), ("b", "2024-01-02 03:00:00")]


def test_preview(spark):
    df = spark.range(100)
    assert sinks.preview(df).count() == 10 and sinks.preview(df, 3).count() == 3 and sinks.preview(df.limit(2)).count() == 2
    assert "Limit" in sinks.preview(df)._jdf.queryExecution().optimizedPlan().toString()


FLOW = "suborder_no string, order_date date, v int"


def test_only_changed_months_are_written(spark, tmp_path):
    path = tmp_path / "flow"
    stored = [("a", D(2024, 1, 5), 0), ("b", D(2024, 2, 5), 0), ("c", D(2024, 3, 5), 0), ("d", None, 0), (None, D(2024, 2, 7), 0)]
    order_flow.store_months(spark.createDataFrame(stored, FLOW), str(path))
    files = lambda month: {p.name for p in Path(path, f"order_month={month}").glob("*.parquet")}
    before = {m: files(m) for m in ("2024-01", "2024-02", "2024-03", "no_date")}
    # b moves from February to April; a new line comes in April.
    new = spark.createDataFrame([("b", D(2024, 4, 1), 1, "x"), ("e", D(2024, 4, 2), 1, None)], FLOW + ", note string")
    assert order_flow.refresh_months(new, str(path)) == ["2024-02", "2024-04"]
    assert all(files(m) == before[m] for m in ("2024-01", "2024-03", "no_date")) and files("2024-02") != before["2024-02"]
    got = order_flow.read_flow(spark, str(path), new.schema)
    assert rows(got, "suborder_no", "order_month", "v", "note") == [
        ("a", "2024-01", 0, None), ("b", "2024-04", 1, "x"), ("c", "2024-03", 0, None), ("d", "no_date", 0, None),
        ("e", "2024-04", 1, None), (None, "2024-02", 0, None),
    ]
    # A month that loses its last line is empty afterwards.
    assert order_flow.refresh_months(spark.createDataFrame([("a", D(2024, 3, 1), 2, None)], new.schema), str(path)) == ["2024-01", "2024-03"]
    assert rows(order_flow.read_flow(spark, str(path), new.schema).where("order_month = '2024-01'")) == []


def test_months_are_pruned_by_a_table_of_months(spark, tmp_path):
    path = str(tmp_path / "flow")
    days = [(f"s{m}", D(2024, m, 1), m) for m in range(1, 13)]
    flow = spark.createDataFrame(days, FLOW)
    order_flow.store_months(flow, path)
    calendar = str(tmp_path / "months")
    spark.createDataFrame([(f"2024-{m:02d}", f"Q{(m + 2) // 3}") for m in range(1, 13)], "order_month string, quarter string").write.parquet(calendar)
    wanted = order_flow.of_months(order_flow.read_flow(spark, path, flow.schema), spark.read.parquet(calendar).where("quarter = 'Q4'"))
    assert rows(wanted, "v") == [(10,), (11,), (12,)]
    assert "dynamicpruning" in wanted._jdf.queryExecution().executedPlan().toString()


def test_no_corrections(spark):
    fact = spark.createDataFrame([("1", 2.0)], "suborder_no string, selling_price double")
    assert rows(corrections.apply_corrections(fact)) == [("1", 2.0, None)]
    assert corrections.of_month(None, 5) is None


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables here")
def test_stored_flows_and_batch_lines_read_sales_lines_written_once(spark, monkeypatch):
    flows, lines = [], []
    segment, enrich = order_flow.order_flow_segment, batches.enrich_batches
    monkeypatch.setattr(order_flow, "order_flow_segment", lambda *a: flows.append(a[0]) or segment(*a))
    monkeypatch.setattr(batches, "enrich_batches", lambda *a: lines.append(a[0]) or enrich(*a))
    queries.QUERIES["batch_stored_flows"](spark, SMALL)
    queries.QUERIES["batch_refresh"](spark, SMALL)
    read = [*[given.sales for given in flows], *lines]
    assert len(flows) == 3 and len(lines) == 2
    assert all(df.inputFiles() and all("/sales-" in f for f in df.inputFiles()) for df in read)
    assert all("/shipments_" in f for given in flows for f in given.shipments.inputFiles())


def test_a_batch_day_and_tag_for_every_status_of_a_line(spark):
    """Two statuses of one line double it, but not its batch; lines without a number or batch stay."""
    day = lambda n: D(2024, 5, n)
    keys = [("a", "7", day(1)), ("a", "8", day(3)), (None, "7", day(4)), ("b", None, day(5)), ("c", " 7 ", day(2)), (None, None, day(6))]
    given = spark.createDataFrame(keys, "suborder_no string, batch_id string, order_date date")
    texts = ["client_location", "mp_name", "brand", "order_number", "sku", "order_status", "shipping_status", "tracking_number", "message",
             "courier_aggregator_name", "payment_mode", "shipping_zip_code", "shipping_city", "suborder_quantity"]
    raw = given.withColumns({t: F.lit("1") for t in texts}).withColumn("selling_price", F.lit(2.0))
    statuses = spark.createDataFrame([("a", "Cancelled"), ("a", "RTO"), ("z", "RTO")], "status_key string, final_status string")
    found = batches.enrich_batches(raw, statuses, {"1": "W"}, "Own", day(9))
    assert rows(found, "suborder_no", "batch_id", "batch_date", "tagging", "new_wh_name") == sorted(
        [("a", 7, day(4), "Cancelled", "W"), ("a", 7, day(4), "Shipped", "W"), ("a", 8, day(3), "Cancelled", "W"), ("a", 8, day(3), "Shipped", "W"),
         (None, 7, day(4), "Shipped", "W"), ("b", None, None, "Shipped", "W"), ("c", 7, day(4), "Shipped", "W"), (None, None, None, "Shipped", "W")],
        key=repr,
    )


def _tables(spark, folder, lines):
    """Tables of a shop: one order per (key, day, channel) with one line each, as (key, day, segment, quantity, line status, priority)."""
    spark.createDataFrame([(n, f"Customer {n}", 1, segment) for n, _, segment, *_ in lines], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(1, "N", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(0, "ASIA")], "r_regionkey int, r_name string").write.parquet(f"{folder}/region.parquet")
    spark.createDataFrame([(1, "fern green", "Brand#2", "SMALL", 8, 90.0), (2, "moss", "Brand#1", "PROMO", 50, 80.0)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(n, n, "F", 2500.0, day, priority) for n, day, _, _, _, priority in lines],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(n, 1 + n % 2, 1, 4, quantity, 50.0, "A", status, day) for n, day, _, quantity, status, _ in lines],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_the_stored_ledger_holds_every_month(spark, tmp_path):
    at = lambda y, m: dt.datetime(y, m, 3)
    days = [at(1995, 2), at(1996, 12), at(1997, 3), at(1997, 5), at(1999, 2), at(2001, 7), None]
    lines = [(n, day, "AUTOMOBILE", 13.0 if n in (1, 4) else 2.0, "O", "1-URGENT") for n, day in enumerate(days, 1)]
    folder = _tables(spark, tmp_path, lines)
    entries = queries.QUERIES["ledger_stored"](spark, folder)
    sold = rows(entries.where("tagging = 'Sales'"), "date", "order_id", "value")
    assert sold == sorted([(day and day.date(), f"K-{n}", 50.0) for n, day in enumerate(days, 1)], key=repr)
    # Corrections of February and of May, each for its own month's line; 20 days after the corrected pickup.
    closed = rows(entries.where("tagging like 'forced%'"), "order_id", "date", "tagging")
    assert closed == [("K-1", D(1995, 2, 26), "forced_closure_lost"), ("K-4", D(1997, 5, 26), "forced_closure_lost")]


def test_corrections_of_the_own_month(spark):
    """One number in two months, corrected in one; a correction without a month, a line without a date or number."""
    fact = spark.createDataFrame([("a", D(2024, 5, 1), 1.0), ("a", D(2024, 6, 1), 1.0), ("b", None, 1.0), (None, D(2024, 5, 2), 1.0), ("c", D(2023, 6, 9), 1.0)],
                                 "suborder_no string, order_date date, selling_price double").withColumns({c: F.lit(None).cast("date") for c in ("pickup_date", "manifested_at")})
    fixes = spark.createDataFrame([("5", "a", "selling_price", "2", 1), (" 5", "a", "selling_price", "3", 2), ("x", "a", "selling_price", "9", 3), (None, "b", "selling_price", "9", 1),
                                   ("6", "c", "Selling Price", "4", 1), ("5", "c", "selling_price", "9", 2), ("5", None, "selling_price", "9", 2)],
                                  "parent_order_month string, suborder_id string, column_name string, change_value_to string, row_no long")
    got = corrections.apply_corrections(fact, fixes, True)
    assert got.columns == [*fact.columns, "forced_closure_date"]
    want = [("a", D(2024, 5, 1), 3.0), ("a", D(2024, 6, 1), 1.0), ("b", None, 1.0), (None, D(2024, 5, 2), 1.0), ("c", D(2023, 6, 9), 4.0)]
    assert rows(got, "suborder_no", "order_date", "selling_price") == sorted(want, key=repr)
    for month in (5, 6):
        one = fact.where(F.month("order_date") == month)
        assert rows(corrections.apply_corrections(one, corrections.of_month(fixes, month))) == rows(got.where(F.month("order_date") == month))


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables here")
@pytest.mark.parametrize(("name", "left", "wide"), [
    ("ledger_main", ["fact"], 2), ("ledger_totals", ["base", "fact"], 2), ("ledger_enriched", ["entries"], 1),
])
def test_a_ledger_holds_no_more_copies_of_its_lines_than_it_reads(spark, monkeypatch, tmp_path, name, left, wide):
    """The lines are written between joins, and older copies go; no more than two shuffles of them are left for the end."""
    written = []
    stage = queries.stage_table
    monkeypatch.setattr("parcelworks.session.shared_folder", lambda _: str(tmp_path))
    monkeypatch.setattr(queries, "stage_table", lambda df, label, *a: written.append(label) or stage(df, label, *a))
    df = queries.QUERIES[name](spark, SMALL)
    assert written[:3] == ["ledger-base", "ledger-costs", "ledger-fact"]
    assert sorted(p.name.split("-")[1] for p in tmp_path.iterdir()) == left
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert 0 < sum("__jk" in line and "Exchange hashpartitioning" in line for line in plan.splitlines()) <= wide


@pytest.mark.parametrize("staged", [False, True])
def test_batch_lines_written_between_their_joins_are_the_same(spark, monkeypatch, tmp_path, staged):
    """Lines that come twice, without a number or batch, and with two statuses."""
    monkeypatch.setattr("parcelworks.session.shared_folder", lambda _: str(tmp_path))
    day = lambda n: D(2024, 5, n)
    given = spark.createDataFrame(
        [("a", "7", day(1), "Amazon.in", "Own"), ("a", "7", day(1), "Amazon.in", "Own"), (None, " 7", day(4), "Shopify", None), (None, None, day(6), None, "x"), ("b", "x", None, "B2B", "x")],
        "suborder_no string, batch_id string, order_date date, mp_name string, brand string",
    )
    texts = ["client_location", "order_number", "sku", "order_status", "shipping_status", "tracking_number", "message", "courier_aggregator_name",
             "payment_mode", "shipping_zip_code", "shipping_city", "suborder_quantity", "shipping_customer_name", "mobile_no"]
    raw = given.withColumns({t: F.lit("1") for t in texts}).withColumn("selling_price", F.lit(2.0))
    statuses = spark.createDataFrame([("a", "Cancelled"), ("a", "RTO"), ("z", "RTO")], "status_key string, final_status string")
    found = batches.enrich_batches(raw, statuses, {"1": "W"}, "Own", day(9), True, staged)
    assert found.columns == [*batches.BATCH_COLUMNS, "shipping_customer_name", "mobile_no"]
    assert [p.name.startswith("batch-lines-") for p in tmp_path.iterdir()] == [True] * staged
    want = [("a", 7, day(4), tag, "amz-own", "W") for tag in ("Cancelled", "Shipped") for _ in range(2)]
    want += [(None, 7, day(4), "Shipped", "web-own", "W"), (None, None, None, "Shipped", None, "W"), ("b", None, None, "Not Shipped", "bulk-order", "W")]
    assert rows(found, "suborder_no", "batch_id", "batch_date", "tagging", "new_mp_name", "new_wh_name") == sorted(want, key=repr)


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables here")
@pytest.mark.parametrize("name", ["batch_enrich", "batch_stored_flows", "ledger_stored"])
def test_written_sales_lines_go_once_they_are_read(spark, monkeypatch, tmp_path, name):
    folder = lambda _: str(tmp_path)
    monkeypatch.setattr("parcelworks.session.shared_folder", folder)
    monkeypatch.setattr(queries, "shared_folder", folder)
    df = queries.QUERIES[name](spark, SMALL)
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}
    assert not left & {"sales", "statuses", "order-costs", "order-flow", "order-months"}
    if name.startswith("batch"):
        assert "batch-lines" in left and all("/batch-lines-" in f for f in df.inputFiles())
    assert df.count() > 0
