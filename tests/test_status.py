import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parcelworks.operators import batches, carriers, classify, sales, sla

D = dt.date
SALES = "status string, cancelled_status string, shipping_status_new string, order_status string, delivered_date string, pickup_date string"


@pytest.mark.parametrize(
    "row, want",
    [
        (("Shipment lost", "No", "Yes", "", None, None), "Lost or Damaged"),
        (("RTO Lost", "No", "Yes", "", None, None), "Lost or Damaged"),
        (("lost", "No", "Yes", "", None, None), "Lost or Damaged"),
        (("DAMAGED", "No", "Yes", "", None, None), "Lost or Damaged"),
        (("CONTACT CUSTOMER SERVICE", "No", "Yes", "", None, None), "Lost or Damaged"),
        (("rto in transit", "No", "Yes", "", None, None), "RTO"),
        (("DELIVERED BACK TO SHIPPER", "No", "Yes", "", None, None), "RTO"),
        (("RETURN TO SHIPPER", "No", "Yes", "", None, None), "Cancelled"),
        (("PICKUP CANCELLED BY CALL", "No", "Yes", "", None, None), "Cancelled"),
        (("In Transit", "Yes", "No", "", None, None), "Cancelled"),
        ((None, "Yes", "No", "", "", None), "Cancelled"),
        (("In Transit", "Yes", "No", "", "01-01-2024", None), "Active"),
        (("SHIPMENT DELIVERED", "No", "Yes", "", None, None), "Delivered"),
        (("CANCELED", "No", "Yes", "", None, None), "Active"),
        (("CANCELED", "No", "No", "", None, None), "Not Shipped"),
        ((None, "No", "No", "Pending", None, None), "Not Shipped (No Inventory)"),
        (("", "No", "No", "Shipped", None, "01-01-2024"), "Active"),
        (("", "No", "No", "Shipped", None, ""), "Not Shipped"),
        ((None, "No", "Yes", None, None, None), "Active"),
    ],
)
def test_final_status(spark, row, want):
    got = spark.createDataFrame([row], SALES).select(classify.final_status()).first()[0]
    assert got == want


@pytest.mark.parametrize(
    "status, said, final, charge, want",
    [
        ("", "RTO In-Transit", "Active", None, ("RTO", "no_cost_avl")),
        (None, "Delivered To Origin", "Not Shipped", None, ("RTO", None)),
        (None, "Delivered", "Cancelled", None, ("Delivered", None)),
        ("In Transit", "Delivered", "Active", 5.0, ("Active", None)),
        (None, None, "Not Shipped (No Inventory)", None, ("Not Shipped (No Inventory)", "no_cost_avl")),
    ],
)
def test_fallback(spark, status, said, final, charge, want):
    df = spark.createDataFrame(
        [(status, said, final, charge)],
        "status string, shipping_status string, final_status string, total_charges double",
    )
    got = classify.status_fallback(df).select("final_status", "total_charges_reason").first()
    assert tuple(got) == want


def _fact(spark, final, mapped, manifested=None, pickup=None, delivered=None, returned=None, cancelled=None):
    return spark.createDataFrame(
        [(final, mapped, D(2024, 5, 1), manifested, pickup, delivered, returned, cancelled)],
        "final_status string, mapped_status string, order_date date, manifested_at date, "
        "pickup_date date, delivered_date date, rto_delivered_date date, cancelled_at date",
    )


@pytest.mark.parametrize(
    "kwargs, want",
    [
        (dict(final="Delivered", mapped="x", pickup=D(2024, 5, 3), delivered=D(2024, 5, 7)),
         dict(date_missing="No", o2s=2, s2d=4, o2d=6, s2nd_reason="NA", o2ns_reason="NA", o2c_reason="NA")),
        (dict(final="Delivered", mapped="x", manifested=D(2024, 4, 30), delivered=D(2024, 5, 7)),
         dict(date_missing="No", o2s=-1, s2d=7)),
        (dict(final="Delivered", mapped="x", pickup=D(2024, 5, 3)),
         dict(date_missing="Yes", o2s_reason="date_missing", s2d_reason="date_missing", o2d=None)),
        (dict(final="RTO", mapped="status_completed", pickup=D(2024, 5, 3), returned=D(2024, 5, 9)),
         dict(date_missing="No", s2d=6, s2nd_reason="NA")),
        (dict(final="RTO", mapped="status_completed", pickup=D(2024, 5, 3)),
         dict(date_missing="Yes", s2d_reason="date_missing")),
        (dict(final="RTO", mapped="active", pickup=D(2024, 5, 3)),
         dict(date_missing="No", s2nd=28, s2d_reason="NA")),
        (dict(final="Cancelled", mapped=None, cancelled=D(2024, 5, 4)),
         dict(date_missing="No", o2c=3, o2s_reason="NA")),
        (dict(final="Cancelled", mapped=None), dict(date_missing="Yes", o2c_reason="date_missing")),
        (dict(final="Not Shipped", mapped=None), dict(date_missing="No", o2ns=30, o2s_reason="NA")),
        (dict(final="Not Shipped (No Inventory)", mapped=None),
         dict(date_missing="No", o2s_reason="NA", s2nd=None, s2nd_reason=None)),
        (dict(final="Active", mapped=None), dict(date_missing="Yes", s2nd_reason="date_missing")),
        (dict(final="forced_closure_x", mapped=None, pickup=D(2024, 5, 2)),
         dict(date_missing="No", o2s=1, s2nd=29)),
    ],
)
def test_sla(spark, kwargs, want):
    got = sla.sla_metrics(_fact(spark, **kwargs), D(2024, 5, 31)).first().asDict()
    assert {k: got[k] for k in want} == want


def test_sales_flags_and_segments(spark):
    raw = [
        ("SHOPIFY", "`K-1", "Shipped", None),
        ("Offline", "`K-2_RS_1", "Cancelled", "Pickup Exception"),
        ("Offline", "K-3_RP", "x", "Delivered"),
        ("Offline", "K-4_RS_CORP", "x", "Returned"),
        ("offline", "K-5_MS", "x", "In Transit"),
        ("B2B", "K-6_samp", "x", "Cancelled"),
        ("B2B", None, "x", ""),
    ]
    df = spark.createDataFrame(
        raw, "mp_name string, order_number string, order_status string, shipping_status string"
    )
    for c in {"suborder_no", *sales.SALES_COLUMNS} - {*df.columns, "combine_id", "combine_id_mp"}:
        kind = "timestamp_ntz" if c.endswith("_at") or c == "order_date" else "string"
        df = df.withColumn(c, F.lit(None).cast(kind))
    numbers = {
        seg: rows(sales.prepare_sales(df, seg), "order_number") for seg in sales.SEGMENTS
    }
    assert numbers["retail"] == [("K-1",)]
    assert numbers["reship"] == [("K-2_RS_1",)]
    assert numbers["replace"] == [("K-3_RP",)]
    assert numbers["missing"] == [("K-5_MS",)]
    assert numbers["corporate"] == [("K-4_RS_CORP",), ("K-6_samp",)]
    assert len(numbers["offline"]) == 4
    flags = rows(
        sales.clean_sales(df).where("order_number is not null"),
        "order_number", "shipping_status_new", "cancelled_status", "delivered",
    )
    assert flags == [
        ("K-1", "No", "No", "Active"),
        ("K-2_RS_1", "No", "Yes", "Active"),
        ("K-3_RP", "Yes", "No", "Yes"),
        ("K-4_RS_CORP", "Yes", "No", "RTO"),
        ("K-5_MS", "Yes", "No", "Active"),
        ("K-6_samp", "No", "Yes", "Active"),
    ]
    assert sales.prepare_sales(df, "reship").first()["clean_id"] == "K-2"


def test_batch_rules(spark):
    df = spark.createDataFrame(
        [
            ("Vendor Central Dropship 9", "x", "K-1", "Shipped", None),
            ("Vendor Central Dropship", "x", "K-1", "Packed", "Delivered"),
            ("Amazon.in", "OWN", "K-1", "Shipped", None),
            ("Amazon.in", "x", "K-1", "Cancelled", "Delivered"),
            ("Offline", "x", "K-1_SAMP", "x", "Delivered"),
            ("Offline", "x", "K-1_samp", "x", None),
            ("B2B", "x", "K-1_CORP", "Shipped", None),
            ("B2B", "x", "K-1", "x", "Delivered"),
            ("Elsewhere", "x", "K-1", "x", "Delivered"),
        ],
        "mp_name string, brand string, order_number string, order_status string, shipping_status string",
    )
    got = batches.with_channel(df, "OWN").withColumn("out", batches.left_warehouse_by_channel())
    assert rows(got, "mp_name", "new_mp_name", "out") == sorted(
        [
            ("Vendor Central Dropship 9", None, "Yes"),
            ("Vendor Central Dropship", "amz-own", "No"),
            ("Amazon.in", "amz-own", "Yes"),
            ("Amazon.in", "amz-rb", "No"),
            ("Offline", "corp-mp", "Yes"),
            ("Offline", "rs-rp-order", "No"),
            ("B2B", "corp-mp", "Yes"),
            ("B2B", "bulk-order", "No"),
            ("Elsewhere", None, "Yes"),
        ],
        key=repr,
    )
    tags = spark.createDataFrame(
        [(None, "Yes", "Yes"), ("", "No", "No"), (None, "No", "Yes"), ("Cancelled", "No", "Yes"),
         ("Not Shipped", "No", "Yes"), ("Not Shipped (No Inventory)", "No", "No")],
        "final_status string, cancelled_status string, shipping_status_new string",
    ).select(batches.tagging())
    assert [r[0] for r in tags.collect()] == [
        "Cancelled", "Not Shipped", "Shipped", "Cancelled", "Not Shipped", "Shipped",
    ]


def test_status_classes(spark):
    assert (len(carriers.STATUS_A), len(carriers.STATUS_B), len(carriers.STATUS_C)) == (30, 22, 76)
    df = spark.createDataFrame(
        [("C'NEE SHIFTED FROM THE GIVEN ADDRESS",), ("",), (None,), ("new text",)], "status string"
    )
    got = rows(carriers.map_status(df, "status", carriers.STATUS_C), "status", "mapped_status")
    assert got == sorted(
        [
            ("C'NEE SHIFTED FROM THE GIVEN ADDRESS", "active"),
            ("", "active"),
            (None, "no_mapping_avl"),
            ("new text", "no_mapping_avl"),
        ],
        key=repr,
    )
    a = carriers.map_status(df, "status", carriers.STATUS_A).where("status = ''").first()
    assert a["mapped_status"] == "no_status"
