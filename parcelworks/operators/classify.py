"""Final status of an order line from its sales flags and its shipment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelworks.functions.money import exact_sum, number_or_zero
from parcelworks.functions.sentinels import NO_COST
from parcelworks.functions.text import contains_any_case, is_blank, one_of
from parcelworks.operators.keyed import left_join
from parcelworks.sources.bucketed import JOIN_KEY, join_stored

# The final statuses.
LOST = "Lost or Damaged"
RTO = "RTO"
CANCELLED = "Cancelled"
DELIVERED = "Delivered"
NO_INVENTORY = "Not Shipped (No Inventory)"
NOT_SHIPPED = "Not Shipped"
ACTIVE = "Active"
FORCED_CLOSURE = "forced_closure"

# Carrier status texts behind them.
LOST_STATUS = ["CONTACT CUSTOMER SERVICE"]
RTO_STATUS = ["DELIVERED BACK TO SHIPPER"]
CANCELLED_STATUS = [
    "RETURN TO SHIPPER",
    "PickupCancelled",
    "Cancelled",
    "PICKUP EMPLOYEE IS OUT TO P/U SHIPMENT",
    "PICKUP CANCELLED BY CALL",
]
DELIVERED_STATUS = ["Delivered", "SHIPMENT DELIVERED", "DELIVERED"]

NEVER_SHIPPED = [CANCELLED, NOT_SHIPPED, NO_INVENTORY]


def final_status() -> Column:
    """First matching rule wins; a missing shipment behaves like blank texts."""
    status = F.col("status")
    waiting = (F.col("shipping_status_new") == "No") & is_blank(F.col("delivered_date"))
    lost = contains_any_case(status, "lost") | contains_any_case(status, "damaged")
    return (
        F.when(lost | one_of(status, LOST_STATUS), LOST)
        .when(contains_any_case(status, "rto") | one_of(status, RTO_STATUS), RTO)
        .when(
            one_of(status, CANCELLED_STATUS) | ((F.col("cancelled_status") == "Yes") & waiting),
            CANCELLED,
        )
        .when(one_of(status, DELIVERED_STATUS), DELIVERED)
        .when(waiting & one_of(F.col("order_status"), ["Pending"]), NO_INVENTORY)
        .when(waiting & is_blank(F.col("pickup_date")), NOT_SHIPPED)
        .otherwise(ACTIVE)
    )


def join_shipments(sales: DataFrame, shipments: DataFrame) -> DataFrame:
    return left_join(sales, shipments, "tracking_number", "awb_no", spread=["suborder_no"])


def classify_orders(sales: DataFrame, shipments: DataFrame) -> DataFrame:
    """Sales lines with the columns of their shipment and ``final_status``."""
    return join_shipments(sales, shipments).withColumn("final_status", final_status())


def classify_stored(sales: DataFrame, shipments: DataFrame) -> DataFrame:
    """As ``classify_orders``, for tables in buckets by tracking key: neither is exchanged."""
    return join_stored(sales, shipments).drop(JOIN_KEY).withColumn("final_status", final_status())


def status_fallback(df: DataFrame, use_sales_status: bool = True) -> DataFrame:
    """Mark missing courier charges, and let the sales status speak where the carrier is silent.

    Whether a charge is due is decided on the status before the sales status is used.
    """
    charge_due = ~one_of(F.col("final_status"), [CANCELLED, NOT_SHIPPED])
    out = {
        "total_charges_reason": F.when(
            charge_due & F.col("total_charges").isNull(), F.lit(NO_COST)
        ),
    }
    if use_sales_status:
        silent, said = is_blank(F.col("status")), F.col("shipping_status")
        returned = contains_any_case(said, "rto") | one_of(said, ["Delivered To Origin"])
        out["final_status"] = (
            F.when(silent & returned, RTO)
            .when(silent & one_of(said, ["Delivered"]), DELIVERED)
            .otherwise(F.col("final_status"))
        )
    return df.withColumns(out)


def status_summary(classified: DataFrame) -> DataFrame:
    """Lines, units and value per final status."""
    return classified.groupBy("final_status").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("suborder_quantity").cast("bigint").alias("units"),
        exact_sum(number_or_zero(F.col("selling_price"))).alias("value"),
    )
