"""Carrier tables: status classes, export cleaning, one shipment schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelworks.functions import dates, money, text
from parcelworks.functions.sentinels import NO_MAPPING
from parcelworks.operators.keyed import small_map

ACTIVE = "active"
COMPLETED = "status_completed"

# Status texts of carrier A and their classes.
STATUS_A = {
    "OUT FOR PICKUP": "active",
    "IN TRANSIT-AT DESTINATION HUB": "active",
    "PICKED UP": "active",
    "NEW ORDER": "active",
    "PICKUP EXCEPTION": "active",
    "PICKUP SCHEDULED": "active",
    "IN TRANSIT": "active",
    "OUT FOR DELIVERY": "active",
    "DELIVERED": "status_completed",
    "MISROUTED": "active",
    "REACHED DESTINATION HUB": "active",
    "SHIPPED": "active",
    "IN TRANSIT-EN-ROUTE": "active",
    "RTO IN TRANSIT": "active",
    "RTO DELIVERED": "status_completed",
    "UNDELIVERED-2nd Attempt": "active",
    "RTO INITIATED": "active",
    "RTO OFD": "active",
    "CANCELED": "status_completed",
    "LOST": "status_completed",
    "UNDELIVERED-3rd Attempt": "active",
    "UNDELIVERED-1st Attempt": "active",
    "UNDELIVERED": "active",
    "UNTRACEABLE": "status_completed",
    "DESTROYED": "status_completed",
    "READY TO SHIP": "active",
    "RETURN PENDING": "active",
    "DISPOSED OFF": "status_completed",
    "RETURN DELIVERED": "status_completed",
    "": "no_status",
}

# Status texts of carrier B and their classes.
STATUS_B = {
    "Cancelled": "status_completed",
    "Damaged": "status_completed",
    "Delivered": "status_completed",
    "In Transit": "active",
    "Lost": "status_completed",
    "NDR": "active",
    "Out For Delivery": "active",
    "Out For Pickup": "active",
    "Picked Up": "active",
    "Pickup Exception": "active",
    "Pickup Scheduled": "active",
    "Queued": "active",
    "RTO Delivered": "status_completed",
    "RTO In Transit": "active",
    "RTO Initiated": "active",
    "RTO Out For Delivery": "active",
    "RTO Picked Up": "active",
    "Undelivered": "active",
    "ZFM": "active",
    "ZLM": "active",
    "RTO Undelivered": "active",
    "Z": "active",
}

# Carrier B rows that are no shipments of ours.
IGNORED_B = ["Z", "ZFM", "ZLM"]

# Status texts of carrier C and their classes.
STATUS_C = {
    "RTO In Transit. Await delivery information": "active",
    "RTO NETWORK DELAY, WILL IMPACT DELIVERY": "active",
    "SHIPMENT DELIVERED": "status_completed",
    "OUT OF DELIVERY AREA": "active",
    "RTO SHIPMENT DELIVERED": "status_completed",
    "In Transit. Await delivery information": "active",
    "CONSIGNEE'S ADDRESS INCORRECT/INCORRECT": "active",
    "CONSIGNEE REFUSED TO ACCEPT": "active",
    "CONSIGNEE ADD IS EDUCATIONAL INSTITUTION": "active",
    "CONTACT CUSTOMER SERVICE": "status_completed",
    "SHIPPER INSTRUCTED TO RTO THE SHIPMENT": "active",
    "Online shipment booked": "active",
    "PICKUP EMPLOYEE IS OUT TO P/U SHIPMENT": "active",
    "CONSIGNEE NOT AVAILABLE": "active",
    "SHIPMENT PICKED UP": "active",
    "NEED DEPARTMENT NAME/EXTENTION NUMBER": "active",
    "DELIVERY ATTEMPTED-PREMISES CLOSED": "active",
    "RTO SHIPMENT ARRIVED": "active",
    "PROHIBITED AREA-ENTRY RESTRICTED FOR DELIVERY": "active",
    "DELAY CAUSED BEYOND OUR CONTROL": "active",
    "RETURN TO SHIPPER": "status_completed",
    "DELIVERED BACK TO SHIPPER": "status_completed",
    "NETWORK ISSUES": "active",
    "NECESSARY CHARGES PENDING FROM CONSIGNEE": "active",
    "LOAD ON HOLD;SPACE CONSTRAINT IN NET VEH": "active",
    "NETWORK DELAY, WILL IMPACT DELIVERY": "active",
    "SHIPMENT REDIRECTED ON SAME AWB": "active",
    "DELIVERY  SCHEDULED FOR NEXT WORKING DAY": "active",
    "CUSTOMER REQUESTED FUTURE DELIVERY: HAL": "active",
    "NO SUCH CONSIGNEE AT THE GIVEN ADDRESS": "active",
    "OUT FOR DELIVERY,  DETAILS AWAITED": "active",
    "DELIVERY DELAYED": "active",
    "MISROUTED-DELIVERY DELAYED": "active",
    "DELIVERY ON NEXT BUSINESS DAY": "active",
    "WRONG PINCODE, WILL IMPACT DELIVERY": "active",
    "RTO LOAD ON HOLD;SPACE CONSTRAINT IN NET VEH": "active",
    "C'NEE SHIFTED FROM THE GIVEN ADDRESS": "active",
    "SHIPMENT MANIFESTED - NOT RECEIVED": "active",
    "RTO CONSIGNEE'S ADDRESS INCORRECT/INCORRECT": "active",
    "RTO HELD AT ORIGIN FOR FURTHER PROCESSING": "active",
    "BULK ORDER, REFUSED BY CONSIGNEE": "active",
    "LOAD ON HOLD;SPACE CONSTRAINT-COMML FLT": "active",
    "RTO NETWORK ISSUES": "active",
    "RTO CUSTOMER REQUESTED FUTURE DELIVERY: HAL": "active",
    "OFFICE CLOSED; UNABLE TO DELIVER": "active",
    "RTO SHIPMENT REDIRECTED ON SAME AWB": "active",
    "NETWORK DELAY, WILL IMPACT TIMELY DELIVERY": "active",
    "RTO at Origin outscan for Delivery": "active",
    "LOAD/VEHICLE ARRIVAL AT TRANSIT HUB": "active",
    "SHIPMENT FURTHER CONNECTED": "active",
    "SHIPMENT ARRIVED": "active",
    "LOAD/VEHICLE ARRIVED AT DELIVERY LOC": "active",
    "CONSIGNEE HAS GIVEN BDE HAL ADDRESS": "active",
    "PICKUP HAS BEEN REGISTERED": "active",
    "SHIPMENT DESTROYED": "status_completed",
    "PICKUP NOT ATTEMPTED, ADDRESS INCOMPLETE": "active",
    "RTO PROCESS COMPLETED, READY TO DESPATCH": "active",
    "REDIRECTED ON SAME AWB TO SHIPPER": "active",
    "Rejected AWB Inscanned": "active",
    "CONSIGNEE REFUSED TO PAY NECESSARY CHARGES": "active",
    "RTO CONTACT CUSTOMER SERVICE": "status_completed",
    "Incorrect Waybill number or No Information": "active",
    "RTO SHIPMENT MANIFESTED - NOT RECEIVED": "active",
    "SHIPMENT MISPLACED": "active",
    "UNDELIVERED RETURN/REDIRECT INITIATED": "active",
    "ON HOLD FOR REGULATORY PAPERWORK": "active",
    "CANVAS BAG RECEIVED AS OVERAGE": "active",
    "CNEE REFUSED ID/OTP NOT SHARED-INCORRECT": "active",
    "ON HOLD;SPACE CONSTRAINT AT DELVRY LOC": "active",
    "AUTO PICKUP REGISTERED": "active",
    "DELIVERY SCHEDULED THROUGH APPOINTMENT": "active",
    "": "active",
    "NETWORK ISSUE, WILL IMPACT DELIVERY": "active",
    "PICKUP CANCELLED BY CALL": "status_completed",
    "RTO DELIVERY DELAYED": "active",
    "UD SHIPMENT RECEIVED FOR FURTHER PROCESS": "active",
}

# Columns of the shipment schema shared by all carriers.
SHIPMENT_COLUMNS = [
    "awb_no", "status", "pickup_date", "delivered_date", "rto_initiation_date",
    "rto_delivered_date", "mapped_status", "updated_at", "cod_charges", "total_charges",
]

# Columns of the stored tables of carriers A and B.
STORED_A = [
    "status", "courier_company", "awb_code", "order_picked_up_date", "order_delivered_date",
    "rto_delivered_date", "cod_remittance_date", "mapped_status", "cod_charges",
    "freight_total_amount", "updated_at",
]

STORED_B = [
    "order_no", "delivery_name", "delivery_no", "invoice_amount", "item_count", "gr_provider",
    "awb_no", "status", "mapped_status", "status_ts", "order_date", "cod_charges",
    "cod_payout_amount", "shipping_charges", "rto_cod_charges", "rto_charges",
    "actual_pickup_date", "delivery_date", "rto_delivery_date", "updated_at",
]


def map_status(df: DataFrame, column: str, classes: dict[str, str]) -> DataFrame:
    """Add ``mapped_status``; texts without a class get ``no_mapping_avl``."""
    mapped = small_map(df, column, classes, "mapped_status")
    return mapped.withColumn("mapped_status", F.coalesce("mapped_status", F.lit(NO_MAPPING)))


def _rendered(columns: list[str], parse) -> dict[str, Column]:
    return {c: dates.render(parse(F.col(c))) for c in columns}


def clean_export_a(raw: DataFrame, as_of: dt.date) -> DataFrame:
    """Carrier A export: day-first dates, classes, one charge per shipment, no repeated rows.

    A shipment with two different charges is an error of the export and stops the job;
    ``duplicate_keys`` on ``charges_a`` names such shipments.
    """
    days = ["order_picked_up_date", "order_delivered_date", "rto_delivered_date"]
    # Repeated rows go before days are parsed; rows whose days are written in two ways, after.
    once = raw.select(
        "status", "courier_company", "awb_code", *days, "cod_remittance_date",
        "cod_charges", "freight_total_amount",
    ).dropDuplicates()
    lines = once.withColumns(_rendered(days, dates.parse_day_first))
    lines = lines.withColumn("updated_at", dates.render(F.lit(as_of))).dropDuplicates()
    lines = map_status(lines, "status", STATUS_A).select(*STORED_A)
    # The check adds no rows, but stops the job if it must.
    return lines.unionByName(_two_charges(once).select(*[F.col(c) if c == "awb_code" else F.lit(None).alias(c) for c in STORED_A]))


def _two_charges(raw: DataFrame) -> DataFrame:
    """No rows; an error if a shipment of the export has two different charges."""
    charges = F.struct("cod_charges", "freight_total_amount")
    seen = raw.where(F.col("awb_code").isNotNull()).groupBy("awb_code").agg(F.min(charges).alias("low"), F.max(charges).alias("high"))
    message = F.concat(F.lit("two different charges for shipment "), F.col("awb_code"))
    several = ~F.col("low").eqNullSafe(F.col("high"))
    return seen.where(F.when(several, F.raise_error(message).cast("boolean")).otherwise(False)).select("awb_code")


def charges_a(raw: DataFrame) -> DataFrame:
    """Distinct charges per shipment of a carrier A export."""
    return raw.select("awb_code", "cod_charges", "freight_total_amount").dropDuplicates()


def drop_ignored_b(df: DataFrame) -> DataFrame:
    return df.where(~text.one_of(F.col("status"), IGNORED_B))


def clean_export_b(raw: DataFrame, as_of: dt.date) -> DataFrame:
    """Carrier B export: month-first dates and classes."""
    days = ["status_ts", "order_date", "actual_pickup_date", "delivery_date", "rto_delivery_date"]
    lines = raw.withColumns(
        {
            **_rendered(days, dates.parse_month_first),
            "updated_at": dates.render(F.lit(as_of)),
        }
    )
    return map_status(lines, "status", STATUS_B).select(*STORED_B)


def clean_tracking_c(rows: DataFrame) -> DataFrame:
    """Flattened carrier C tracking rows: month-first dates and classes."""
    days = [
        "pickup_date", "last_status_date", "delivery_date", "rto_initiation_date",
        "rto_delivered_date",
    ]
    return map_status(
        rows.withColumns(_rendered(days, dates.parse_month_first)), "status", STATUS_C
    )


def completed_from_dates(delivered: Column, returned: Column) -> Column:
    done = ~text.is_blank(delivered) | ~text.is_blank(returned)
    return F.when(done, COMPLETED).otherwise(ACTIVE)


def clean_tracking_d(rows: DataFrame, as_of: dt.date) -> DataFrame:
    """Rolled-up carrier D rows: days only, class from the two closing dates."""
    days = ["pickup_date", "delivery_date", "rto_initiated_date", "rto_delivered_date"]
    return rows.withColumns(_rendered(days, dates.parse_iso)).withColumns(
        {
            "mapped_status": completed_from_dates(
                F.col("delivery_date"), F.col("rto_delivered_date")
            ),
            "updated_at": dates.render(F.lit(as_of)),
        }
    )


def class_from_type(status_type: Column) -> Column:
    return F.when(status_type == "DL", COMPLETED).otherwise(ACTIVE)


def unify_shipments(
    a: DataFrame, b: DataFrame, c: DataFrame, d: DataFrame, e: DataFrame
) -> DataFrame:
    """Five stored carrier tables as one table of shipments."""
    no_text = F.lit(None).cast("string")
    number = money.to_number
    parts = [
        a.withColumnsRenamed(
            {
                "awb_code": "awb_no",
                "order_picked_up_date": "pickup_date",
                "order_delivered_date": "delivered_date",
            }
        ).withColumns(
            {
                "rto_initiation_date": no_text,
                "total_charges": number(F.col("cod_charges"))
                + number(F.col("freight_total_amount")),
            }
        ),
        b.withColumnsRenamed(
            {
                "actual_pickup_date": "pickup_date",
                "delivery_date": "delivered_date",
                "rto_delivery_date": "rto_delivered_date",
            }
        ).withColumns(
            {
                "rto_initiation_date": no_text,
                "total_charges": number(F.col("cod_charges"))
                + number(F.col("shipping_charges"))
                + number(F.col("rto_cod_charges"))
                + number(F.col("rto_charges")),
            }
        ),
        c.withColumnsRenamed({"awb_number": "awb_no", "delivery_date": "delivered_date"}),
        d.withColumnsRenamed(
            {
                "awb_num": "awb_no",
                "delivery_date": "delivered_date",
                "rto_initiated_date": "rto_initiation_date",
            }
        ),
        e.withColumnsRenamed({"awb_number": "awb_no", "delivery_date": "delivered_date"}),
    ]
    unified = None
    for part in parts:
        if "cod_charges" not in part.columns:
            part = part.withColumn("cod_charges", no_text)
        part = part.withColumns(
            {
                "awb_no": text.blank_to_null(F.col("awb_no").cast("string")),
                "total_charges": number(F.col("total_charges")),
            }
        ).select(*SHIPMENT_COLUMNS)
        unified = part if unified is None else unified.unionByName(part)
    return unified
