"""Warehouse batches: enriched lines, shipped summary, pending lines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelworks.functions import dates
from parcelworks.functions.money import to_number
from parcelworks.functions.sentinels import NO_BATCH
from parcelworks.functions.text import blank_to_null, is_blank, one_of, strip_backticks
from parcelworks.operators import classify as st
from parcelworks.operators.keyed import left_join, lookup, small_map
from parcelworks.operators.sales import cancelled_flag, delivered_flag, left_warehouse
from parcelworks.session import stage_table

# Marketplaces whose order status tells whether a line was shipped.
STATUS_BY_ORDER = ["Amazon.in", "B2B", "Production Order"]
STATUS_BY_ORDER_PART = "Vendor Central"

# Channel per marketplace; ``{own}`` stands for the house brand.
CHANNELS = {
    "Vendor Central Dropship 2": "amz-rb",
    "Vendor Central Dropship 3": "amz-rb",
    "Vendor Central Dropship": "amz-{own}",
    "Shopify": "web-{own}",
    "Shopify13": "web-rb",
    "Myntra PPMP": "other-MP",
    "Production Order": "other-MP",
}
AMAZON, AMAZON_OTHER = "Amazon.in", "amz-rb"
CORPORATE_MARKS, CORPORATE_CHANNEL = ["SAMP", "CORP"], "corp-mp"
OTHERWISE = {"Offline": "rs-rp-order", "B2B": "bulk-order"}

BATCH_COLUMNS = [
    "client_location", "mp_name", "tagging", "week", "days_diff", "new_wh_name", "new_mp_name",
    "batch_id", "batch_id_reason", "batch_date", "order_date", "order_number", "suborder_no",
    "order_status", "final_status", "courier_aggregator_name", "tracking_number", "payment_mode",
    "message", "sku", "suborder_quantity", "selling_price", "shipping_zip_code", "shipping_city",
]
SUMMARY_KEYS = [
    "client_location", "mp_name", "week", "new_wh_name", "new_mp_name", "batch_id",
    "batch_id_reason", "order_date", "batch_date",
]
SHIPPED = "Shipped"


def left_warehouse_by_channel() -> Column:
    """Some marketplaces report shipment in the order status only."""
    by_order = F.coalesce(
        F.col("mp_name").contains(STATUS_BY_ORDER_PART), F.lit(False)
    ) | one_of(F.col("mp_name"), STATUS_BY_ORDER)
    shipped = F.when(F.col("order_status") == "Shipped", "Yes").otherwise("No")
    return F.when(by_order, shipped).otherwise(left_warehouse(F.col("shipping_status")))


def tag_from_sales() -> Column:
    return (
        F.when(F.col("cancelled_status") != "No", st.CANCELLED)
        .when(F.col("shipping_status_new") == "No", st.NOT_SHIPPED)
        .otherwise(SHIPPED)
    )


def tagging(from_sales: Column | None = None) -> Column:
    status = F.col("final_status")
    return (
        F.when(is_blank(status), tag_from_sales() if from_sales is None else from_sales)
        .when(status.isin(st.CANCELLED, st.NOT_SHIPPED), status)
        .otherwise(SHIPPED)
    )


def with_channel(df: DataFrame, house_brand: str) -> DataFrame:
    """Add ``new_mp_name``; a marketplace without a rule gets none."""
    own = house_brand.lower()
    fixed = {mp: name.format(own=own) for mp, name in CHANNELS.items()}
    mp, number = F.col("mp_name"), F.col("order_number")
    corporate = F.lit(False)
    for mark in CORPORATE_MARKS:
        corporate = corporate | F.coalesce(number.contains(mark), F.lit(False))
    rule = F.when(
        mp == AMAZON,
        F.when(F.col("brand") == house_brand, f"amz-{own}").otherwise(AMAZON_OTHER),
    )
    for name, otherwise in OTHERWISE.items():
        rule = rule.when(mp == name, F.when(corporate, CORPORATE_CHANNEL).otherwise(otherwise))
    named = small_map(df, "mp_name", fixed, "__channel")
    return named.withColumn("new_mp_name", F.coalesce("__channel", rule)).drop("__channel")


def union_statuses(*facts: DataFrame) -> DataFrame:
    """Final status per suborder out of several flows."""
    out = None
    for fact in facts:
        part = fact.select(F.col("suborder_no").alias("status_key"), "final_status")
        out = part if out is None else out.unionByName(part)
    return out


def enrich_batches(
    raw: DataFrame,
    statuses: DataFrame,
    warehouses: dict[str, str],
    house_brand: str,
    as_of: dt.date,
    contacts: bool = False,
    staged: bool = False,
) -> DataFrame:
    """Sales lines with status tag, channel, warehouse, batch day, week and age.

    ``warehouses`` gives a short name per client location. With ``staged`` the lines are written
    once they have their status, so that their two shuffles don't lie on the disk together;
    ``raw`` and ``statuses`` aren't read after that. A result of few columns is better off without.
    """
    lines = raw.withColumns(
        {
            "order_number": strip_backticks(F.col("order_number")),
            "tracking_number": strip_backticks(F.col("tracking_number")),
            "order_date": F.to_date("order_date"),
            "shipping_status_new": left_warehouse_by_channel(),
            "cancelled_status": cancelled_flag(F.col("order_status"), F.col("shipping_status")),
            "delivered": delivered_flag(F.col("shipping_status")),
            "batch_id": blank_to_null(F.col("batch_id").cast("string")),
            "suborder_quantity": to_number(F.col("suborder_quantity")).cast("bigint"),
        }
    )
    extra = ["shipping_customer_name", "mobile_no"] if contacts else []
    tagged = lines.withColumn("__from_sales", tag_from_sales())
    # What the tag is made of is shuffled once: by the status join, which comes first.
    tagged = left_join(
        tagged, statuses, "suborder_no", "status_key", spread=["order_number", "sku"]
    ).withColumn("tagging", tagging(F.col("__from_sales")))
    if staged:
        held = [c for c in [*BATCH_COLUMNS, "brand", *extra] if c in tagged.columns]
        lines = tagged = stage_table(tagged.select(*held), "batch-lines", "zstd")
    # Batch days depend on the sales lines alone.
    batched = lines.where(F.col("batch_id").isNotNull()).groupBy("batch_id")
    days = batched.agg(F.max("order_date").alias("batch_date"))
    lines = lookup(tagged, days, "batch_id", "batch_id", ["batch_date"], spread=["suborder_no"])
    # Names made of other columns come after the shuffles.
    lines = with_channel(lines, house_brand)
    lines = small_map(lines, "client_location", warehouses, "new_wh_name")
    number = to_number(F.col("batch_id")).cast("bigint")
    day = F.coalesce("batch_date", "order_date")
    out = lines.withColumns(
        {
            "week": dates.monday_week(day),
            "days_diff": dates.days_between(F.col("order_date"), F.lit(as_of)),
            "batch_id_reason": F.when(number.isNull(), NO_BATCH),
            "batch_id": number,
        }
    )
    return out.select(*BATCH_COLUMNS, *extra)


def batch_shipped_summary(lines: DataFrame) -> DataFrame:
    """Shipped lines, orders and units per batch, place and channel."""
    return (
        lines.where(F.col("tagging") == SHIPPED)
        .groupBy(*SUMMARY_KEYS)
        .agg(
            F.count(F.lit(1)).alias("n_suborders"),
            F.countDistinct(F.coalesce("order_number", F.lit(""))).alias("n_orders"),
            F.coalesce(F.sum("suborder_quantity"), F.lit(0)).cast("bigint").alias("units"),
        )
    )


def batch_pending(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("tagging") != SHIPPED)
