"""Messages to customers whose order is late."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelworks.functions import dates
from parcelworks.functions.text import blank_to_null, international_phone
from parcelworks.operators import classify as st
from parcelworks.operators.keyed import left_join
from parcelworks.session import stage_table

# When an order is late, and the shape of the message parts.
LATE_AFTER_DAYS = 3
BULLET = "🌱"
SEPARATOR = ", "
PENDING, SENT, NOT_SENT = "pending", "sent", "not_sent"
SENT_CODE = 200


def late_lines(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """Lines ordered three days ago that were neither manifested nor shipped."""
    return fact.where(
        (F.col("order_date") == F.lit(as_of - dt.timedelta(days=LATE_AFTER_DAYS)))
        & F.col("order_number").isNotNull()
        & F.col("manifested_at").isNull()
        & (F.col("final_status") == st.NOT_SHIPPED)
    )


def _late_items(fact: DataFrame, products: DataFrame, as_of: dt.date) -> DataFrame:
    """Late lines with the name of their product."""
    names = products.select(
        blank_to_null(F.col("sku")).alias("product_sku"), F.col("product_name")
    )
    late = late_lines(fact, as_of).withColumn("__sku", blank_to_null(F.col("sku")))
    return left_join(late, names, "__sku", "product_sku", spread=["suborder_no"])


def _joined(items: str):
    return F.array_join(
        F.transform(items, lambda i: F.concat(F.lit(BULLET), i["product_name"])), SEPARATOR
    )


def delayed_order_outbox(fact: DataFrame, products: DataFrame, as_of: dt.date) -> DataFrame:
    """One message per late order: first name and phone, all product names.

    Lines count in the order of their suborder number. A product without a name
    is left out of the list; a line without an order number has no order to write
    about. The message of an order is one cell, so its late lines of that one day
    meet in one task; ``product_chunks`` gives the same list in pieces.
    """
    lines = _late_items(fact, products, as_of)
    item = F.struct("suborder_no", "product_name")
    named = F.collect_list(F.when(F.col("product_name").isNotNull(), item))
    return (
        lines.groupBy(F.col("order_number").alias("order_no"))
        .agg(
            F.min_by("shipping_customer_name", "suborder_no").alias("cust_name"),
            international_phone(F.min_by("mobile_no", "suborder_no")).alias("mob_no"),
            F.array_sort(named).alias("__items"),
        )
        .select(
            "cust_name",
            "mob_no",
            "order_no",
            _joined("__items").alias("product_list"),
            F.lit(PENDING).alias("msg_status"),
            dates.render(F.lit(as_of), dates.MESSAGE_FORMAT).alias("msg_send_date"),
        )
    )


def product_chunks(
    fact: DataFrame, products: DataFrame, as_of: dt.date, size: int = 500, ranges: int | None = None
) -> DataFrame:
    """The product lists of late orders in numbered pieces of at most ``size`` names.

    Pieces of an order joined by the separator, in the order of ``chunk``, are the list of its
    message. Lines are numbered in two steps: they are sorted by range, so that an order of
    any length spreads over tasks, and numbered within a range; the lines that an order has
    in the ranges before are added. Orders without a named product have no pieces.
    """
    lines = _late_items(fact, products, as_of).where(F.col("product_name").isNotNull())
    lines = lines.select(F.col("order_number").alias("order_no"), "suborder_no", "product_name")
    order = ["order_no", "suborder_no", "product_name"]
    ranged = lines.repartitionByRange(ranges, *order) if ranges else lines.repartitionByRange(*order)
    # Written, so that a task that runs again finds the ranges as they were.
    ranged = stage_table(ranged.withColumn("range", F.spark_partition_id()), "late-lines")
    sizes = ranged.groupBy("order_no", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("order_no").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("order_no", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("order_no", "range").orderBy("suborder_no", "product_name"))
    numbered = ranged.withColumn("place", place).join(offsets, ["order_no", "range"])
    numbered = numbered.withColumn("number", F.col("before") + F.col("place") - 1)
    chunk = F.expr(f"number div {size}")
    item = F.struct("number", "product_name")
    return (
        numbered.groupBy("order_no", chunk.alias("chunk"))
        .agg(F.count(F.lit(1)).alias("n_products"), F.array_sort(F.collect_list(item)).alias("__items"))
        .select("order_no", "chunk", "n_products", _joined("__items").alias("product_list"))
    )


def with_responses(messages: DataFrame, responses: DataFrame) -> DataFrame:
    """Messages with the answer (``order_no``, ``status_code``) of the message service.

    Code 200 is sent, any other is not sent; a message without an answer stays pending.
    """
    answers = responses.select(F.col("order_no").alias("__order"), "status_code")
    known = left_join(messages.drop("status_code"), answers, "order_no", "__order").drop("__order")
    code = F.col("status_code")
    status = F.when(code == SENT_CODE, SENT).when(code.isNotNull(), NOT_SENT).otherwise(F.col("msg_status"))
    return known.withColumn("msg_status", status)


def outbox_counts(outbox: DataFrame) -> DataFrame:
    """Messages by status."""
    return outbox.groupBy("msg_status").agg(F.count(F.lit(1)).alias("n_messages"))
