"""Sales lines: segments, shipping flags, recent lines of one carrier."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelworks.functions import dates, money, text

# Marketplace names, order-number marks and status texts of the sales export.
RETAIL_CHANNEL = "shopify"
OFFLINE_CHANNEL = "offline"
CORPORATE_CHANNELS = ["offline", "b2b"]
SEGMENT_MARKS = {"reship": "_RS", "replace": "_RP", "missing": "_MS"}
CORPORATE_PATTERN = "corp|samp"
NOT_LEFT_WAREHOUSE = [
    "Cancelled",
    "Out For Pickup",
    "Shipment Created",
    "Pickup Exception",
    "Pickup Scheduled",
]
CANCELLED_ORDER = ["Cancelled", "CANCELLED"]
RETURNING = ["Delivered To Origin", "RTO initiated", "RTO In-Transit", "Returned"]

SEGMENTS = ["retail", "offline", "corporate", *SEGMENT_MARKS]

# Columns of the sales lines, and of the lines a carrier is asked about.
SALES_COLUMNS = [
    "suborder_no", "client_location", "order_date", "order_number", "sku", "marketplace_sku",
    "combine_id", "combine_id_mp", "suborder_quantity", "selling_price",
    "courier_aggregator_name", "courier_name", "tracking_number", "order_status",
    "shipping_status", "payment_mode", "payment_transaction_id", "manifested_at", "cancelled_at",
    "delivered_at", "pickup_canceled", "rto_initiated", "shipping_status_new",
    "cancelled_status", "delivered", "batch_id",
    "shipping_state", "shipping_zip_code", "message", "shipping_customer_name", "mobile_no",
]
RECENT_COLUMNS = [
    "order_date", "order_number", "courier_name", "tracking_number", "sku", "order_status",
    "shipping_status", "selling_price", "suborder_quantity",
]


def left_warehouse(shipping_status: Column) -> Column:
    waiting = text.is_blank(shipping_status) | text.one_of(shipping_status, NOT_LEFT_WAREHOUSE)
    return F.when(waiting, "No").otherwise("Yes")


def cancelled_flag(order_status: Column, shipping_status: Column) -> Column:
    hit = text.one_of(order_status, CANCELLED_ORDER) | text.one_of(shipping_status, ["Cancelled"])
    return F.when(hit, "Yes").otherwise("No")


def delivered_flag(shipping_status: Column) -> Column:
    return (
        F.when(shipping_status == "Delivered", "Yes")
        .when(shipping_status.isin(*RETURNING), "RTO")
        .otherwise("Active")
    )


def in_segment(segment: str) -> Column:
    """Whether a line belongs to a segment, by channel and order number."""
    channel, number = F.lower("mp_name"), F.col("order_number")
    if segment == "retail":
        return channel == RETAIL_CHANNEL
    if segment == "corporate":
        return channel.isin(*CORPORATE_CHANNELS) & F.lower(number).rlike(CORPORATE_PATTERN)
    offline = channel == OFFLINE_CHANNEL
    if segment == "offline":
        return offline
    return offline & ~F.lower(number).contains("corp") & number.contains(SEGMENT_MARKS[segment])


def clean_sales(raw: DataFrame, *keep: str) -> DataFrame:
    """Lines of all channels with clean keys, whole days and the three status flags.

    ``keep`` names further columns of the export to carry along.
    """
    number = text.blank_to_null(text.strip_backticks(F.col("order_number")))
    return raw.withColumns(
        {
            "order_number": number,
            "suborder_no": text.blank_to_null(F.col("suborder_no")),
            "tracking_number": text.blank_to_null(text.strip_backticks(F.col("tracking_number"))),
            "combine_id": text.pair_key(number, F.col("sku")),
            "combine_id_mp": text.pair_key(number, F.col("marketplace_sku")),
            "order_date": F.to_date("order_date"),
            "manifested_at": F.to_date("manifested_at"),
            "cancelled_at": F.to_date("cancelled_at"),
            "pickup_canceled": F.lit(None).cast("string"),
            "rto_initiated": F.lit(None).cast("string"),
            "shipping_status_new": left_warehouse(F.col("shipping_status")),
            "cancelled_status": cancelled_flag(F.col("order_status"), F.col("shipping_status")),
            "delivered": delivered_flag(F.col("shipping_status")),
        }
    ).select(*SALES_COLUMNS, *keep)


def prepare_sales(raw: DataFrame, segment: str) -> DataFrame:
    """Cleaned lines of one segment; offline segments also get their link to the first order."""
    if segment not in SEGMENTS:
        raise ValueError(f"unknown segment {segment!r}")
    cleaned = clean_sales(raw.where(in_segment(segment)))
    if segment not in SEGMENT_MARKS:
        return cleaned
    clean_id = text.first_part(F.col("order_number"))
    return cleaned.withColumns(
        {"clean_id": clean_id, "clean_id_sku_comb": text.pair_key(clean_id, F.col("sku"))}
    )


def with_zero_prices(df: DataFrame) -> DataFrame:
    """Prices that are missing or not numeric count as zero."""
    return df.withColumn("selling_price", money.number_or_zero(F.col("selling_price")))


# How the sales export marks the lines of three carriers.
CARRIER_MARKS = {
    "air": ("courier_name", "BLUEDART"),
    "marketplace": ("courier_name", "ATS"),
    "packages": ("courier_aggregator_name", "Delhivery"),
}


def recent_carrier_lines(raw: DataFrame, carrier: str, as_of: dt.date) -> DataFrame:
    """Lines of one carrier ordered in the 30 days before ``as_of``."""
    column, mark = CARRIER_MARKS[carrier]
    recent = raw.where((F.col(column) == mark) & dates.last_30_days(F.col("order_date"), as_of))
    return recent.withColumns(
        {
            "order_date": F.to_date("order_date"),
            "order_number": text.strip_backticks(F.col("order_number")),
            "tracking_number": text.strip_backticks(F.col("tracking_number")),
            "selling_price": money.cents(money.number_or_zero(F.col("selling_price"))),
            "suborder_quantity": money.number_or_zero(F.col("suborder_quantity")).cast("int"),
        }
    ).select(*RECENT_COLUMNS)
