import datetime as dt
import json
import zipfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parcelworks import schemas
from parcelworks.operators import (
    batches,
    corrections,
    costs,
    ledger,
    outbox,
    tracking,
    upsert,
)
from parcelworks.sources import readers, sinks
from parcelworks.streaming.refresh import refresh_history

D = dt.date


# Costs and allocation --------------------------------------------------------

LINES = [
    # suborder, order, price, fee, rate
    ("a1", "A", 100.0, 59.0, 0.18),
    ("b1", "B", 100.0, 118.0, 0.05),
    ("b2", "B", 200.0, 118.0, 0.12),
    ("b3", "B", 33.33, 118.0, None),
    ("z1", "Z", 0.0, 50.0, 0.05),
    ("z2", "Z", 0.0, 50.0, None),
    ("n1", "N", 80.0, None, 0.05),
    ("n2", "N", 80.0, None, None),
    ("x1", None, 10.0, None, 0.05),
]
LINE_SCHEMA = "suborder_no string, order_number string, selling_price double, order_fee double, tax_rate double"


def _expected(line, total):
    _, _, price, fee, rate = line

    def r(x):
        return float(__import__("numpy").round(x, 2))

    if fee is None:
        return (None,) * 4
    s = r(price / total * fee) if total else 0.0
    t = r(s / 118 * 18) if total else 0.0
    if rate is None:
        return (None, None, s - t, t)
    base = r(price - s)
    tax = r(base / (1 + rate) * rate)
    return (base - tax, tax, r(s - t), t)


def test_allocation(spark):
    got = costs.allocate_shipping_tax(spark.createDataFrame(LINES, LINE_SCHEMA))
    got = {r["suborder_no"]: r for r in got.collect()}
    totals = {"A": 100.0, "B": 333.33, "Z": 0.0, "N": 160.0}
    for line in LINES:
        r = got[line[0]]
        want = _expected(line, totals.get(line[1], 0.0))
        names = ("pd_taxable_value", "pd_tax", "shipping_value", "shipping_tax")
        assert tuple(r[n] for n in names) == want
        no_fee = "no_shipping_avl" if line[3] is None else None
        no_rate = no_fee or ("no_tax_avl" if line[4] is None else None)
        reasons = tuple(r[n + "_reason"] for n in names)
        assert reasons == (no_rate, no_rate, no_fee, no_fee)
    spread = sum(got[k]["shipping_value"] + got[k]["shipping_tax"] for k in ("b1", "b2", "b3"))
    assert abs(spread - 118.0) <= 0.03


def test_courier_split(spark):
    df = spark.createDataFrame(
        [("1", "T1", 100.0, None), ("2", "T3", 100.0, None), ("3", "T3", 100.0, None),
         ("4", "T3", 100.0, None), ("5", "T4", None, None), ("6", "T5", None, "no_cost_avl"),
         ("7", None, None, None)],
        "suborder_no string, tracking_number string, total_charges double, total_charges_reason string",
    )
    got = rows(costs.split_courier_charge(df), "suborder_no", "total_charges", "total_charges_reason")
    assert got == [
        ("1", 100.0, None), ("2", 33.33, None), ("3", 33.33, None), ("4", 33.33, None),
        ("5", None, None), ("6", None, "no_cost_avl"), ("7", None, None),
    ]


def test_cost_table_and_fan_out(spark):
    bundles = spark.createDataFrame(
        [("s1", "1,000", "0.05", "cost_avl"), ("s2", "5", "0.05", "cost_pending"), ("", "7", "0", "cost_avl")],
        "sku string, total_b2c_cost_with_tax string, tax_rate string, b2c_other string",
    )
    singles = spark.createDataFrame(
        [("s1", "10", "", "all_completed"), ("s3", "2.5", "0.18", "all_completed")],
        "sku string, total_b2c_cost_with_tax string, tax_rate string, tagging string",
    )
    fact = spark.createDataFrame(
        [("1", "s1", 2), ("2", "s2", 1), ("3", "s3", 3), ("4", "", 1), ("5", None, 1)],
        "suborder_no string, sku string, suborder_quantity int",
    )
    got = costs.attach_cost(fact, costs.cost_table(bundles, singles))
    assert rows(got, "suborder_no", "pd_cost", "pd_cost_reason", "tax_rate") == [
        ("1", 20.0, None, None), ("1", 2000.0, None, 0.05), ("2", None, "no_cost_avl", None),
        ("3", 7.5, None, 0.18), ("4", None, "no_cost_avl", None), ("5", None, "no_cost_avl", None),
    ]


# Upserts ---------------------------------------------------------------------

UPSERT = "k string, mapped_status string, v int"


def test_upserts(spark):
    old = spark.createDataFrame(
        [("open", "active", 1), ("done", "status_completed", 1), ("both", "active", 1),
         ("both", "status_completed", 2), ("quiet", "active", 1), (None, "active", 1),
         ("odd", "no_mapping_avl", 1), ("blank", None, 1)],
        UPSERT,
    )
    new = spark.createDataFrame(
        [("open", "active", 9), ("done", "active", 9), ("both", "active", 9), ("fresh", "active", 8),
         ("fresh", "active", 9), (None, "active", 9), ("odd", "active", 9), ("blank", "active", 9)],
        UPSERT,
    )
    frozen = rows(upsert.upsert_freeze_completed(old, new, "k"), "k", "v")
    assert frozen == sorted(
        [("open", 9), ("done", 1), ("both", 9), ("quiet", 1), (None, 1), (None, 9), ("fresh", 8),
         ("fresh", 9), ("odd", 9), ("blank", 9)],
        key=repr,
    )
    replaced = rows(upsert.upsert_replace(old, new, "k"), "k", "v")
    assert replaced == sorted([("quiet", 1), (None, 1), *rows(new, "k", "v")], key=repr)


def test_upsert_twice_is_upsert_once(spark):
    old = spark.createDataFrame([("a", "active", 1), ("b", "status_completed", 1)], UPSERT)
    new = spark.createDataFrame([("a", "active", 2), ("b", "active", 2), ("c", "active", 2)], UPSERT)
    once = upsert.upsert_freeze_completed(old, new, "k")
    twice = upsert.upsert_freeze_completed(once, new, "k")
    assert rows(once, "k", "v") == rows(twice, "k", "v") == [("a", 2), ("b", 1), ("c", 2)]


def test_published_versions(spark, tmp_path):
    old = spark.createDataFrame([("a", "active", 1), ("b", "status_completed", 1)], UPSERT)
    new = spark.createDataFrame([("a", "active", 2), ("b", "active", 2), ("c", "active", 2)], UPSERT)
    root = str(tmp_path / "history")
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, root)
    assert refresh_history(old, root, "k") == 1
    assert refresh_history(new, root, "k", version=2) == 2
    assert rows(sinks.read_published(spark, root), "k", "v") == [("a", 2), ("b", 1), ("c", 2)]
    # A replayed batch changes nothing.
    before = sinks.current_version(spark, root)
    assert refresh_history(new, root, "k", version=2) == before[0]
    assert sinks.current_version(spark, root) == before


# Corrections -----------------------------------------------------------------


def _corrections(spark, entries):
    return spark.createDataFrame(
        [(str(m), i, c, v, n) for n, (m, i, c, v) in enumerate(entries)],
        "parent_order_month string, suborder_id string, column_name string, change_value_to string, row_no int",
    )


def test_corrections(spark):
    fact = spark.createDataFrame(
        [(k, "O", D(2024, 5, 1), m, p, 10.0, "Active", 5.0, None)
         for k, m, p in [("a", D(2024, 5, 2), "03-05-2024"), ("b", D(2024, 5, 2), None),
                         ("c", None, ""), ("d", None, None), ("e", None, "03-05-2024")]],
        "suborder_no string, order_number string, order_date date, manifested_at date, "
        "pickup_date string, selling_price double, final_status string, total_charges double, "
        "total_charges_reason string",
    )
    fixes = _corrections(
        spark,
        [
            (5, "a", "final_status", "RTO"),
            (5, "a", "final_status", "forced_closure_x"),
            (5, "b", "final_status", "forced_closure_x"),
            (5, "c", "final_status", "forced_closure_x"),
            (5, "d", "Selling Price", "1,000.5"),
            (5, "d", "total_charges", "no_cost_avl"),
            (6, "d", "final_status", "RTO"),
            (5, "e", "pickup_date", "10-05-2024"),
            (5, "e", "final_status", "forced_closure_x"),
            (5, "e", "final_status", "Delivered"),
            (5, "e", "pickup_date", "11-05-2024"),
            (5, "gone", "final_status", "RTO"),
            (5, "a", "no such column", "RTO"),
        ],
    )
    month = corrections.of_month(fixes, 5)
    got = corrections.apply_corrections(fact, month)
    assert rows(got, "suborder_no", "final_status", "forced_closure_date", "selling_price",
                "total_charges", "total_charges_reason", "pickup_date") == [
        ("a", "forced_closure_x", "23-05-2024", 10.0, 5.0, None, "03-05-2024"),
        ("b", "forced_closure_x", "22-05-2024", 10.0, 5.0, None, None),
        ("c", "forced_closure_x", "21-05-2024", 10.0, 5.0, None, ""),
        ("d", "Active", None, 1000.5, None, "no_cost_avl", None),
        ("e", "Delivered", "30-05-2024", 10.0, 5.0, None, "11-05-2024"),
    ]
    assert rows(corrections.unmatched_corrections(fact, month)) == [("gone", 1)]
    assert corrections.unknown_columns(fact, month).count() == 1


def test_last_reshipment_wins(spark):
    fact = spark.createDataFrame([("1", "K_s"), ("2", "L_s"), ("3", None)], "suborder_no string, combine_id string")
    stored = spark.createDataFrame(
        [("K_s", "r1", 1), ("K_s", "r9", 3), ("K_s", "r5", 2), (None, "r0", 4)],
        "clean_id_sku_comb string, suborder_no string, row_no int",
    )
    got = corrections.link_reshipments(fact, stored, ["row_no"])
    assert rows(got, "suborder_no", "rs_suborder_no") == [("1", "r9"), ("2", None), ("3", None)]


# Tracking --------------------------------------------------------------------


def _docs(spark, bodies):
    return spark.createDataFrame(
        [(k, b if isinstance(b, str) else json.dumps(b)) for k, b in bodies.items()],
        "awb string, body string",
    )


def test_scan_documents(spark):
    def history(*scans):
        steps = json.dumps([{"status": s, "time": t} for s, t in scans])
        return {"data": [{"awbNumber": "n", "orderStatus": "Booked", "shippingHistory": steps}]}

    docs = _docs(
        spark,
        {
            "plain": {"data": [{"awbNumber": "77", "orderStatus": "Booked"}]},
            "sent": history(("PickupDone", "2024-05-03 10:00:00"), ("PickupDone", "2024-05-02 09:00:00"),
                            ("Delivered", "2024-05-04 10:00:00"), ("Delivered", "2024-05-05 11:00:00")),
            "back": history(("ReturnInitiated", "2024-05-04"), ("Delivered", "2024-05-09"), ("Scan", "2024-05-10")),
            "open": history(("ReturnInitiated", "2024-05-04")),
            "empty": {"data": []},
            "none": {"data": [{"awbNumber": "n", "orderStatus": "x", "shippingHistory": "[]"}]},
            "bad": "no json",
        },
    )
    t = dt.datetime
    assert rows(tracking.read_scan_documents(docs)) == sorted(
        [
            ("77", "Booked", None, None, None, None),
            ("sent", "Delivered", t(2024, 5, 2, 9), t(2024, 5, 5, 11), None, None),
            ("back", "RTO Scan", None, None, t(2024, 5, 4), t(2024, 5, 9)),
            ("open", "RTO ReturnInitiated", None, None, t(2024, 5, 4), None),
        ],
        key=repr,
    )
    assert rows(tracking.failed_scan_documents(docs)) == [("bad",), ("empty",), ("none",)]


def test_shipment_lists(spark):
    def element(kind, day, status, scans=None, **more):
        out = {"StatusType": kind, "StatusDate": day, "Status": status, **more}
        return out if scans is None else {**out, "Scans": [{"ScanDetail": {"ScanDate": s}} for s in scans]}

    def doc(*elements):
        return {"ShipmentData": {"Shipment": list(elements)}}

    first = dict(PickUpDate="2024-05-01", WaybillNo="9")
    docs = _docs(
        spark,
        {
            "1": doc(element("DL", "2024-05-05", "SHIPMENT DELIVERED", **first)),
            "2": doc(element("RT", "2024-05-05", "Returned", **first)),
            "3": doc(element("RT", "2024-05-05", "Returned", **first), element("DL", "2024-05-09", "SHIPMENT DELIVERED", ["2024-05-08"])),
            "4": doc(element("RT", "2024-05-05", "Returned", **first), element("DL", "2024-05-09", "ARRIVED", [])),
            "5": {"ShipmentData": {}},
        },
    )
    got = tracking.flatten_shipment_lists(docs, D(2024, 6, 1)).drop("awb_number", "pickup_date", "updated_at")
    assert rows(got) == sorted(
        [
            ("SHIPMENT DELIVERED", "DL", "2024-05-05", "2024-05-05", "", ""),
            ("Returned", "RT", "2024-05-05", "", "2024-05-05", ""),
            ("RTO SHIPMENT DELIVERED", "RT", "2024-05-08", "", "2024-05-05", "2024-05-09"),
            ("RTO ARRIVED", "RT", "", "", "2024-05-05", ""),
        ],
        key=repr,
    )
    assert rows(tracking.failed_shipment_lists(docs)) == [("5",)]


def test_worklist(spark):
    recent = spark.createDataFrame([(k,) for k in ["new", "new", "open", "done", "odd", "", None]], "tracking_number string")
    stored = spark.createDataFrame(
        [("open", "active"), ("done", "status_completed"), ("odd", "no_mapping_avl"), ("far", "active"),
         ("old", "status_completed"), ("done", "status_completed")],
        "awb string, mapped_status string",
    )
    assert rows(tracking.tracking_worklist(recent, stored, "awb")) == [("done",), ("far",), ("new",), ("odd",), ("open",)]
    kept = rows(tracking.tracking_worklist(recent, stored, "awb", skip_finished=True))
    assert kept == [("far",), ("new",), ("odd",), ("open",)]
    counts = tracking.worklist_counts(recent, stored, "awb").first().asDict()
    assert counts == dict(n_window=4, n_common=4, n_common_active=1, n_common_completed=2, n_new=2, n_overlap=1, n_final=3)


@pytest.mark.parametrize("keys_held", [1, 100_000])
def test_request_batches(spark, keys_held):
    keys = [f"{p}{i}" for p in ("35", "34", "9") for i in range(130 if p != "34" else 50)]
    df = spark.createDataFrame([(k,) for k in keys + keys[:20] + [None]], "awb_no string")
    got = tracking.request_batches(df, size=50, bucket_keys=keys_held).collect()
    sizes = sorted((r["mode"], r["chunk"], r["n_keys"]) for r in got)
    full = [(m, c, n) for m in ("surface", "unknown") for c, n in ((0, 50), (1, 50), (2, 30))]
    assert sizes == sorted([("express", 0, 50), *full])
    asked = [k for r in got for k in r["awbs"].split(",")]
    assert sorted(asked) == sorted(keys)


# Ledger ----------------------------------------------------------------------


def _ledger_fact(spark, lines):
    return spark.createDataFrame(
        [(str(n), "O", "s", "state", "wh", "x", D(2024, 5, 1), c, p, m, rd, fc, f, ms, 100.0, "7", 3.0, None, 4.0, None)
         for n, (f, ms, c, p, m, rd, fc) in enumerate(lines)],
        "suborder_no string, order_number string, sku string, shipping_state string, client_location string, "
        "order_status string, order_date date, cancelled_at date, pickup_date date, manifested_at date, "
        "rto_delivered_date date, forced_closure_date string, final_status string, mapped_status string, "
        "selling_price double, rs_cogs string, pd_cost double, pd_cost_reason string, total_charges double, "
        "total_charges_reason string",
    ).withColumns(
        {k: F.lit(1.0) for k in ledger.TAXES.values()}
        | {k + "_reason": F.lit(None).cast("string") for k in ledger.TAXES.values()}
    )


CASES = [
    ("Delivered", None, None, D(2024, 5, 3), D(2024, 5, 2), None, None),
    ("Cancelled", None, None, None, None, None, None),
    ("RTO", "status_completed", None, None, D(2024, 5, 2), D(2024, 5, 9), None),
    ("RTO", "active", None, None, None, None, None),
    ("Lost or Damaged", None, None, None, D(2024, 5, 2), None, None),
    ("forced_closure_x", None, None, None, None, None, "21-05-2024"),
    ("Not Shipped", None, None, None, None, None, None),
    ("Not Shipped (No Inventory)", None, None, None, None, None, None),
]


def test_ledger_main_and_reship(spark):
    fact = _ledger_fact(spark, CASES)
    main = ledger.ledger_main(fact)
    tags = {}
    for r in main.collect():
        tags.setdefault(r["suborder_no"], {})[r["tagging"]] = r
    costs_and_ship = {"pd_cogs", "shipped", "courier_cogs"}
    want = ["", "Cancelled", "RTO_delivered", "", "Lost/Damaged", "forced_closure_x", "", ""]
    for n, tag in enumerate(want):
        shipped = costs_and_ship if n not in (1, 6, 7) else set()
        assert set(tags[str(n)]) == {"Sales", *([tag] if tag else []), *shipped}
    assert tags["0"]["shipped"]["date"] == D(2024, 5, 3)
    assert tags["2"]["shipped"]["date"] == D(2024, 5, 2)
    assert (tags["3"]["shipped"]["date"], tags["3"]["shipped"]["date_reason"]) == (None, "date_missing")
    assert tags["5"]["forced_closure_x"]["date"] == D(2024, 5, 21)
    assert tags["1"]["Cancelled"]["date"] is None
    assert (tags["0"]["Sales"]["product_tax"], tags["0"]["pd_cogs"]["product_tax"]) == (1.0, None)
    assert (tags["0"]["pd_cogs"]["value"], tags["0"]["courier_cogs"]["value"]) == (3.0, 4.0)

    reship = {(r["suborder_no"], r["tagging"]): r for r in ledger.ledger_reship(fact).collect()}
    assert reship["1", "RS_Cancelled"]["date"] == D(2024, 5, 1)
    assert ("5", "RS_forced_closure_x") in reship
    assert reship["0", "rs_cogs"]["value"] == 7.0
    assert reship["3", "rs_cogs"]["date"] is None and reship["3", "rs_cogs"]["date_reason"] is None
    assert reship["3", "rs_shipped"]["date_reason"] == "date_missing"
    assert all(r["product_tax"] is None for r in reship.values())
    assert len(ledger.ledger_cogs_only(fact, "rs_cogs").collect()) == 5


def test_unshipped_return_of_cancelled_order(spark):
    fact = _ledger_fact(spark, CASES[2:4]).withColumn("order_status", F.lit("Cancelled"))
    got = ledger.cancel_unshipped_returns(fact).select("final_status").distinct().collect()
    assert [r[0] for r in got] == ["Cancelled"]


def test_refunds(spark):
    df = spark.createDataFrame(
        [(D(2024, 5, 1), str(i), "s", a, r, p) for i, (a, r, p) in enumerate([
            ("1,200.5", "Damaged Plant", "Yes"), ("", "Damaged Plant", "Yes"), (None, "Damaged Plant", "Yes"),
            ("0.00", "Damaged Plant", "Yes"), ("5", "Other", "Yes"), ("5", "Damaged Replacement", "No"),
            ("7", "Damaged Replacement", "Yes"), ("seven", "Damaged Plant", "Yes")])],
        "date date, order_id string, sku string, amount string, refund_reason string, approval string",
    )
    got = rows(ledger.ledger_refunds(df), "order_id", "value", "value_reason", "tagging")
    assert got == [("K-0", 1200.5, None, "Refund"), ("K-6", 7.0, None, "Refund"), ("K-7", None, "seven", "Refund")]


# Batches and messages --------------------------------------------------------


def test_batches(spark):
    blank = {n: None for n in schemas.SALES_HEADERS.values()}
    lines = [
        ("1", "7", D(2024, 1, 1)), ("2", "7", D(2024, 12, 31)), ("3", "MAN", D(2023, 1, 1)), ("4", None, D(2025, 1, 5)),
    ]
    schema = ", ".join(f"{n} {'date' if n == 'order_date' else 'int' if n == 'suborder_quantity' else 'string'}" for n in blank)
    raw = spark.createDataFrame(
        [tuple({**blank, "suborder_no": s, "batch_id": b, "order_date": d, "order_number": "`K", "mp_name": "Shopify",
                "shipping_status": "Delivered", "suborder_quantity": 2, "client_location": "A"}.values()) for s, b, d in lines],
        schema,
    )
    statuses = spark.createDataFrame([("3", "Cancelled")], "status_key string, final_status string")
    got = batches.enrich_batches(raw, statuses, {"A": "Alpha"}, "OWN", D(2025, 1, 10))
    assert rows(got, "suborder_no", "batch_id", "batch_id_reason", "batch_date", "week", "tagging", "days_diff") == [
        ("1", 7, None, D(2024, 12, 31), 53, "Shipped", 375),
        ("2", 7, None, D(2024, 12, 31), 53, "Shipped", 10),
        ("3", None, "no_batch_created", D(2023, 1, 1), 0, "Cancelled", 740),
        ("4", None, "no_batch_created", None, 0, "Shipped", 5),
    ]
    summary = rows(batches.batch_shipped_summary(got), "batch_id", "order_date", "n_suborders", "n_orders", "units")
    assert summary == [(7, D(2024, 1, 1), 1, 1, 2), (7, D(2024, 12, 31), 1, 1, 2), (None, D(2025, 1, 5), 1, 1, 2)]
    assert rows(batches.batch_pending(got), "suborder_no") == [("3",)]
    assert "mobile_no" not in got.columns


def test_outbox(spark):
    day = D(2024, 5, 1)
    fact = spark.createDataFrame(
        [("2", "K-1", day, None, "Not Shipped", "s2", "Second", "2"), ("1", "K-1", day, None, "Not Shipped", "s1", "First", " +00 09876543210 "),
         ("3", "K-1", day, None, "Not Shipped", "none", "Third", "3"), ("4", "K-2", day, day, "Not Shipped", "s1", "x", "4"),
         ("5", "K-3", day, None, "Active", "s1", "x", "5"), ("6", "K-4", D(2024, 5, 2), None, "Not Shipped", "s1", "x", "6")],
        "suborder_no string, order_number string, order_date date, manifested_at date, final_status string, sku string, "
        "shipping_customer_name string, mobile_no string",
    )
    products = spark.createDataFrame([("s1", "Fern"), ("s2", "Palm")], "sku string, product_name string")
    got = outbox.delayed_order_outbox(fact, products, D(2024, 5, 4))
    assert rows(got) == [("First", "+919876543210", "K-1", "🌱Fern, 🌱Palm", "pending", "04/05/2024")]
    assert rows(outbox.outbox_counts(got)) == [("pending", 1)]


# Sources and sinks -----------------------------------------------------------


def test_sheet_and_log(spark, tmp_path):
    path = str(tmp_path / "sheet")
    df = spark.createDataFrame([("K-1", ""), ("K-2", " 5 ")], "`Order ID` string, Shipping string")
    sinks.write_csv(df, path)
    got = readers.read_text_table(spark, path, schemas.FEE_HEADERS)
    assert rows(got) == [("K-1", None), ("K-2", "5")]
    log = str(tmp_path / "log")
    for n in (1, 2):
        sinks.append_run_log(spark, log, "refresh", dt.datetime(2024, 5, n, 3, 4, 5))
    assert rows(spark.read.parquet(log)) == [("refresh", "2024-05-01 03:04:05"), ("refresh", "2024-05-02 03:04:05")]


def test_month_replacement(spark, tmp_path):
    path = str(tmp_path / "months")
    df = spark.createDataFrame([("2024-04", 1), ("2024-05", 2)], "order_month string, v int")
    sinks.replace_table(df, path, partition_by="order_month")
    sinks.replace_table(spark.createDataFrame([("2024-05", 3)], df.schema), path, partition_by="order_month")
    assert rows(readers.read_months(spark, path, ["2024-05", "2024-06"]), "v") == [(3,)]
    assert rows(spark.read.parquet(path), "v") == [(1,), (3,)]


def test_zipped_export(spark, tmp_path):
    header = ",".join(f'"{h}"' for h in reversed(schemas.SALES_HEADERS))
    cells = {"Suborder No": "1", "Selling Price": "1,5", "Message": 'a\n"b"', "Order Date": "2024-05-01 10:00:00"}
    line = ",".join('"' + cells.get(h, "").replace('"', '""') + '"' for h in reversed(schemas.SALES_HEADERS))
    for name, members in {"good": {"x.csv": f"{header}\n{line}\n", "y.csv": "other"}, "empty": {}}.items():
        (tmp_path / name).mkdir()
        with zipfile.ZipFile(tmp_path / name / "report.zip", "w") as archive:
            for member, content in members.items():
                archive.writestr(member, content)
    got = readers.read_zipped_sales(spark, str(tmp_path / "good")).first()
    assert (got["suborder_no"], got["selling_price"], got["message"]) == ("1", "1,5", 'a\n"b"')
    assert got["order_date"] == dt.datetime(2024, 5, 1, 10)
    assert got["sku"] is None
    with pytest.raises(Exception, match="archive without members"):
        readers.read_zipped_sales(spark, str(tmp_path / "empty")).collect()


def test_export_view(spark):
    df = spark.createDataFrame([("1", None, "no_cost_avl", None)], "suborder_no string, total_charges double, total_charges_reason string, o2s int")
    shown = sinks.export_view(df, schemas.HEADERS)
    assert shown.columns == ["Suborder No", "total_charges", "O2S"]
    assert tuple(shown.first()) == ("1", "no_cost_avl", "")


def test_csv_may_be_compressed(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'x "y"\nz'), (None, " ")], "s string, t string")
    sinks.write_csv(df, f"{tmp_path}/csv", compression="gzip")
    assert [p.name for p in (tmp_path / "csv").glob("part-*") if not p.name.endswith(".csv.gz")] == []
    assert rows(readers.read_csv(spark, f"{tmp_path}/csv", df.schema).where("s is not null")) == [("a,b", 'x "y"\nz')]
