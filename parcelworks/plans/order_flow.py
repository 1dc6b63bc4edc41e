"""The monthly order flow and its segment variants, put together from the operators."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelworks.functions.dates import in_window, month_window
from parcelworks.functions.text import contains_any_case
from parcelworks.operators.classify import classify_orders, status_fallback
from parcelworks.operators.corrections import apply_corrections, link_reshipments, of_month
from parcelworks.operators.costs import (
    allocate_shipping_tax,
    attach_cost,
    attach_order_fee,
    split_courier_charge,
)
from parcelworks.operators.sales import prepare_sales, with_zero_prices
from parcelworks.operators.sla import parse_fact_dates, sla_metrics
from parcelworks.operators.upsert import upsert_replace
from parcelworks.schemas import CONTACT_COLUMNS, CORPORATE_COLUMNS, FLOW_COLUMNS
from parcelworks.session import drop_staged, stage_table
from parcelworks.sources.sinks import replace_partitions, replace_table


@dataclass(frozen=True)
class Inputs:
    """The tables a flow reads; ``sales`` is the raw export, ``shipments`` the unified table."""

    sales: DataFrame
    shipments: DataFrame
    costs: DataFrame
    fees: DataFrame | None = None
    corrections: DataFrame | None = None
    reship_table: DataFrame | None = None


def of_order_month(sales: DataFrame, year: int, month: int, as_of: dt.date) -> DataFrame:
    """Sales lines of one calendar month, up to the day before ``as_of``."""
    return sales.where(in_window(F.col("order_date"), *month_window(year, month, as_of)))


def drop_cancelled_keys(fact: DataFrame) -> DataFrame:
    return fact.where(~contains_any_case(F.col("suborder_no"), "cancel"))


def _with_reasons(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns, each followed by its reason if it has one."""
    return df.select(
        *[n for c in columns for n in (c, c + "_reason") if n == c or n in df.columns]
    )


def order_flow_month(
    inputs: Inputs,
    year: int,
    month: int,
    as_of: dt.date,
    stored: DataFrame | None = None,
    contacts: bool = False,
) -> DataFrame:
    """The retail flow of one month's sales: status, cost, fee and tax split, durations.

    ``stored`` is the consolidated flow so far: its rows stay, but for those of the month's
    suborders.
    """
    lines = of_order_month(inputs.sales, year, month, as_of)
    given = replace(inputs, sales=lines, corrections=of_month(inputs.corrections, month))
    flow = _retail_flow(given, as_of, contacts)
    return flow if stored is None else upsert_replace(stored, flow, "suborder_no")


def order_flow_months(inputs: Inputs, as_of: dt.date, contacts: bool = False) -> DataFrame:
    """The retail flow of all months' sales, each line with the corrections of its month.

    For a first run over stored sales: one pass, however many months they have.
    """
    return _retail_flow(inputs, as_of, contacts, by_month=True)


def _retail_flow(inputs: Inputs, as_of: dt.date, contacts: bool, by_month: bool = False) -> DataFrame:
    """The joins are written to the shared folder; the totals per order and per parcel are then
    read from there. Every second shuffle of the wide lines ends with a copy, and the copy before
    goes, so that no more than two of them lie on the disk together.
    """
    fact = classify_orders(prepare_sales(inputs.sales, "retail"), inputs.shipments)
    costed = stage_table(attach_cost(fact, inputs.costs), "order-costs", "zstd")
    fact = with_zero_prices(attach_order_fee(costed, inputs.fees))
    fact = link_reshipments(fact, inputs.reship_table, order=["row_no"])
    linked = stage_table(status_fallback(fact), "order-flow", "zstd")
    drop_staged(costed)
    fact = stage_table(split_courier_charge(allocate_shipping_tax(linked)), "order-shares", "zstd")
    drop_staged(linked)
    fact = fact.withColumn("forced_closure_date", F.lit(None).cast("string"))
    fact = apply_corrections(fact, inputs.corrections, by_month)
    fact = sla_metrics(parse_fact_dates(fact), as_of)
    wanted = FLOW_COLUMNS + (CONTACT_COLUMNS if contacts else [])
    return _with_reasons(drop_cancelled_keys(fact), wanted)


_MONTH, _NO_MONTH = "order_month", "no_date"


def _with_month(flow: DataFrame) -> DataFrame:
    return flow.withColumn(_MONTH, F.coalesce(F.date_format("order_date", "yyyy-MM"), F.lit(_NO_MONTH)))


def store_months(flow: DataFrame, path: str) -> None:
    """Replace the month partitions that the flow has rows of; other months stay as they are."""
    # The flow may be made from the table it is to replace.
    staged = stage_table(_with_month(flow), "order-months", "zstd")
    replace_table(staged, path, partition_by=_MONTH)
    drop_staged(staged)


def read_flow(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """The stored months with these columns; a month that was stored without one has nulls there."""
    fields = [f for f in columns.fields if f.name != _MONTH]
    return spark.read.schema(T.StructType([*fields, T.StructField(_MONTH, T.StringType())])).parquet(path)


def of_months(flow: DataFrame, months: DataFrame) -> DataFrame:
    """Lines of the stored months that the month table (``order_month``) lists.

    A join, so that months come from a table and need no list in the program; dynamic
    partition pruning keeps the others from being read.
    """
    wanted = months.select(_MONTH).distinct()
    return flow.join(wanted, _MONTH).drop(_MONTH)


def refresh_months(flow: DataFrame, path: str) -> list[str]:
    """Merge new lines into the stored months, and return the months that were written.

    Stored lines of the same suborder number give way, in whatever month they lie. Only the
    new lines' months and those that lose a line are read in full and replaced; of the others
    one column is read, and their files stay.
    """
    fresh = stage_table(_with_month(flow), "order-flow-new")
    keys = fresh.where(F.col("suborder_no").isNotNull()).select("suborder_no").distinct()
    stored = read_flow(fresh.sparkSession, path, fresh.schema)
    losing = stored.select("suborder_no", _MONTH).join(keys, "suborder_no", "left_semi").select(_MONTH)
    # As many as there are months.
    months = sorted({r[0] for r in losing.union(fresh.select(_MONTH)).distinct().collect()})
    rows = upsert_replace(stored.where(F.col(_MONTH).isin(months)), fresh, "suborder_no")
    replace_partitions(stage_table(rows, "order-months"), path, [_MONTH], [(m,) for m in months])
    return months


def _segment_lines(inputs: Inputs, kind: str, as_of: dt.date) -> DataFrame:
    corporate = kind == "corporate"
    fact = classify_orders(prepare_sales(inputs.sales, kind), inputs.shipments)
    fact = attach_cost(fact, inputs.costs).drop("tax_rate")
    if corporate:
        fact = with_zero_prices(fact)
    fact = status_fallback(fact, use_sales_status=corporate)
    if not corporate:
        fact = split_courier_charge(stage_table(fact, f"order-flow-{kind}"))
    fact = sla_metrics(parse_fact_dates(fact), as_of)
    if corporate:
        return _with_reasons(fact, CORPORATE_COLUMNS)
    return fact.drop(*CONTACT_COLUMNS)


def order_flow_segment(
    inputs: Inputs, kind: str, as_of: dt.date, stored: DataFrame | None = None
) -> DataFrame:
    """The flow of reship, replace, missing or corporate lines, merged into its stored table."""
    fact = _segment_lines(inputs, kind, as_of)
    if stored is not None:
        fact = upsert_replace(stored, fact, "suborder_no")
    return drop_cancelled_keys(fact)
