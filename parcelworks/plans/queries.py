"""Every operator over the given tables, whole."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelworks import schemas
from parcelworks.functions import dates
from parcelworks.functions.text import strip_backticks
from parcelworks.operators import (
    answers,
    batches,
    carriers,
    classify,
    corrections,
    costs,
    keyed,
    ledger,
    outbox,
    sales,
    scan_state,
    sla,
    tracking,
    upsert,
)
from parcelworks.plans import carrier_refresh, order_flow, star
from parcelworks.plans.star import Star
from parcelworks.session import drop_staged, shared_folder, stage_bucketed, stage_table
from parcelworks.sources import archives, bucketed, history, readers, sinks
from parcelworks.streaming import worklist
from parcelworks.streaming.refresh import refresh_history, stream_refresh

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Star(spark, folder))
    return build


def _shipments(s: Star) -> DataFrame:
    return carriers.unify_shipments(*[s.role("carrier_" + c) for c in "abcde"])


def _classified(s: Star) -> DataFrame:
    return classify.classify_orders(sales.clean_sales(s.role("sales")), _shipments(s))


def _costs(s: Star) -> DataFrame:
    return costs.cost_table(s.role("bundle_costs"), s.role("single_costs"))


def _once(df: DataFrame, label: str) -> DataFrame:
    """A wide table of the lines, written for the next step alone, thus small rather than fast."""
    return stage_table(df, label, "zstd")


def _unread(df: DataFrame, names: list[str]) -> DataFrame:
    """Nulls in the columns that a query never reads, which a written table can't drop for it."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in df.schema.fields if f.name in names})


def _sales_once(s: Star, *wanted: str) -> DataFrame:
    """The sales lines, written once: for queries that read them several times.

    A query that wants some columns alone names them; the others are null.
    """
    lines = s.role("sales")
    return _once(_unread(lines, [c for c in lines.columns if wanted and c not in wanted]), "sales")


def _bucketed(df: DataFrame, label: str, key: str) -> DataFrame:
    """Rows with a key, in buckets by it: shuffled once for several joins. Others match nothing there."""
    # No fewer buckets than a shuffle has parts: else Spark would exchange the table for every join.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage_bucketed(df.where(F.col(key).isNotNull()), label, key, parts)


def _folder(s: Star, label: str) -> str:
    return f"{shared_folder(s.spark)}/{label}-{uuid.uuid4().hex}"


# Sales lines -----------------------------------------------------------------

_SALES_VIEW = [
    "suborder_no", "order_date", "order_number", "sku", "combine_id", "combine_id_mp",
    "suborder_quantity", "selling_price", "tracking_number", "order_status", "shipping_status",
    "manifested_at", "cancelled_at", "shipping_status_new", "cancelled_status", "delivered",
    "batch_id",
]


@query
def prepare_sales_retail(s: Star) -> DataFrame:
    return sales.prepare_sales(s.role("sales"), "retail").select(*_SALES_VIEW)


@query
def prepare_sales_corporate(s: Star) -> DataFrame:
    return sales.prepare_sales(s.role("sales"), "corporate").select(*_SALES_VIEW)


@query
def prepare_sales_offline(s: Star) -> DataFrame:
    return sales.prepare_sales(s.role("sales"), "offline").select(*_SALES_VIEW)


@query
def prepare_sales_segments(s: Star) -> DataFrame:
    out = None
    for segment in sales.SEGMENT_MARKS:
        part = sales.prepare_sales(s.role("sales"), segment).select(
            F.lit(segment).alias("segment"),
            "suborder_no",
            "order_number",
            "clean_id",
            "clean_id_sku_comb",
            "delivered",
        )
        out = part if out is None else out.unionByName(part)
    return out


@query
def recent_carrier_lines(s: Star) -> DataFrame:
    out = None
    for carrier in sales.CARRIER_MARKS:
        part = sales.recent_carrier_lines(s.role("sales"), carrier, star.RECENT_AS_OF).select(
            F.lit(carrier).alias("carrier"), *sales.RECENT_COLUMNS
        )
        out = part if out is None else out.unionByName(part)
    return out


@query
def month_window(s: Star) -> DataFrame:
    lines = order_flow.of_order_month(s.role("sales"), 2001, 7, star.RECENT_AS_OF)
    return lines.select("suborder_no", "order_date")


@query
def batch_window(s: Star) -> DataFrame:
    recent = dates.batch_window(F.col("order_date"), star.RECENT_AS_OF)
    return s.role("sales").where(recent).select("suborder_no", "order_date")


# Carriers --------------------------------------------------------------------


@query
def unify_shipments(s: Star) -> DataFrame:
    return _shipments(s)


@query
def clean_export_a(s: Star) -> DataFrame:
    return carriers.clean_export_a(s.role("export_a"), star.AS_OF)


@query
def clean_export_b(s: Star) -> DataFrame:
    kept = carriers.drop_ignored_b(s.role("export_b"))
    return carriers.clean_export_b(kept, star.AS_OF).select(
        "awb_no", "status", "mapped_status", "status_ts", "order_date", "actual_pickup_date",
        "delivery_date", "rto_delivery_date", "updated_at",
    )


@query
def status_map_lookup(s: Star) -> DataFrame:
    return carriers.map_status(s.role("carrier_c"), "status", carriers.STATUS_C).select(
        "awb_number", "status", "mapped_status"
    )


@query
def status_class_counts(s: Star) -> DataFrame:
    mapped = carriers.map_status(s.role("export_a"), "status", carriers.STATUS_A)
    return mapped.groupBy("status", "mapped_status").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def dedupe_charges(s: Star) -> DataFrame:
    return carriers.charges_a(s.role("export_a"))


@query
def duplicate_key_check(s: Star) -> DataFrame:
    priced = s.role("lines").select(
        F.col("l_orderkey").cast("string").alias("awb_code"),
        F.col("l_quantity").alias("cod_charges"),
        F.col("l_linenumber").alias("freight_total_amount"),
    )
    return keyed.duplicate_keys(carriers.charges_a(priced), "awb_code")


# Status ----------------------------------------------------------------------


@query
def classify_orders(s: Star) -> DataFrame:
    return _classified(s).select(
        "suborder_no", "order_number", "tracking_number", "awb_no", "status", "mapped_status",
        "pickup_date", "delivered_date", "final_status",
    )


# What a line's final status depends on, and the keys it is known by.
_STATUS_READS = [
    "suborder_no", "order_number", "tracking_number", "order_status", "shipping_status_new",
    "cancelled_status",
]


@query
def classify_stored(s: Star) -> DataFrame:
    """Sales and shipments stored in buckets by tracking key, and joined without an exchange."""
    name = uuid.uuid4().hex
    buckets = bucketed.bucket_count(s.table("lineitem").count())
    lines = bucketed.store_bucketed(
        sales.clean_sales(s.role("sales")).select(*_STATUS_READS), f"sales_{name}", _folder(s, "sales-buckets"), "tracking_number", buckets
    )
    shipped = bucketed.store_bucketed(
        _shipments(s).select("awb_no", "status", "mapped_status", "pickup_date", "delivered_date"),
        f"shipments_{name}", _folder(s, "shipment-buckets"), "awb_no", buckets,
    )
    return classify.classify_stored(lines, shipped).select(
        "suborder_no", "order_number", "tracking_number", "awb_no", "status", "mapped_status",
        "pickup_date", "delivered_date", "final_status",
    )


@query
def status_summary(s: Star) -> DataFrame:
    return classify.status_summary(_classified(s))


@query
def status_fallback(s: Star) -> DataFrame:
    return classify.status_fallback(_classified(s)).select(
        "suborder_no", "tracking_number", "final_status", "total_charges", "total_charges_reason"
    )


@query
def status_fallback_segments(s: Star) -> DataFrame:
    return classify.status_fallback(_classified(s), use_sales_status=False).groupBy(
        "final_status", "total_charges_reason"
    ).agg(F.count(F.lit(1)).alias("n_lines"))


# Costs and allocation --------------------------------------------------------


@query
def attach_cost(s: Star) -> DataFrame:
    lines = sales.clean_sales(s.role("sales")).select(
        "suborder_no", "order_number", "sku", "suborder_quantity"
    )
    return costs.attach_cost(lines, _costs(s))


def _with_fee_and_rate(s: Star) -> DataFrame:
    lines = sales.with_zero_prices(
        sales.clean_sales(s.role("sales")).select(
            "suborder_no", "order_number", "sku", "suborder_quantity", "selling_price"
        )
    )
    return costs.attach_order_fee(costs.attach_cost(lines, _costs(s)), s.role("fees"))


@query
def allocate_shipping_tax(s: Star) -> DataFrame:
    return costs.allocate_shipping_tax(_with_fee_and_rate(s)).drop(
        "suborder_quantity", "pd_cost", "pd_cost_reason"
    )


@query
def split_courier_charge(s: Star) -> DataFrame:
    marked = classify.status_fallback(_classified(s)).select(
        "suborder_no", "order_number", "sku", "tracking_number", "total_charges",
        "total_charges_reason",
    )
    return costs.split_courier_charge(marked).drop("order_number", "sku")


# Durations -------------------------------------------------------------------


def _flow_with_dates(s: Star) -> DataFrame:
    return sla.parse_fact_dates(classify.status_fallback(_classified(s)))


@query
def date_missing_flags(s: Star) -> DataFrame:
    return (
        sla.with_date_missing(_flow_with_dates(s))
        .groupBy("final_status", "mapped_status", "date_missing")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )


@query
def sla_metrics(s: Star) -> DataFrame:
    return sla.sla_metrics(_flow_with_dates(s), star.AS_OF).select(
        "suborder_no", "final_status", "date_missing",
        *[c for d in sla.DURATIONS for c in (d, d + "_reason")],
    )


# Corrections and links -------------------------------------------------------


@query
def last_wins_lookup(s: Star) -> DataFrame:
    lines = sales.clean_sales(s.role("sales")).select("suborder_no", "combine_id")
    return corrections.link_reshipments(lines, s.role("reship_table"), order=["row_no"])


@query
def apply_corrections(s: Star) -> DataFrame:
    fact = classify.status_fallback(_classified(s)).select(
        "suborder_no", "order_number", "order_date", "manifested_at", "pickup_date",
        "selling_price", "final_status", "total_charges", "total_charges_reason",
    )
    return corrections.apply_corrections(
        fact, corrections.of_month(s.role("corrections"), star.FLOW_MONTH)
    )


@query
def unmatched_corrections(s: Star) -> DataFrame:
    return corrections.unmatched_corrections(
        sales.clean_sales(s.role("sales")), s.role("corrections")
    )


# Upserts ---------------------------------------------------------------------


@query
def upsert_replace(s: Star) -> DataFrame:
    return upsert.upsert_replace(s.role("history"), s.role("refresh"), "awb_no")


@query
def upsert_freeze_completed(s: Star) -> DataFrame:
    return upsert.upsert_freeze_completed(s.role("history"), s.role("refresh"), "awb_no")


@query
def published_refresh(s: Star) -> DataFrame:
    root = _folder(s, "history")
    sinks.publish(s.role("history"), root)
    refresh_history(s.role("refresh"), root, "awb_no")
    return sinks.read_published(s.spark, root)


@query
def history_refresh(s: Star) -> DataFrame:
    """Two refreshes of a bucketed history, the second one repeated."""
    root = _folder(s, "history")
    history.start_history(s.role("history"), root, "awb_no", buckets=16)
    late = F.coalesce(F.crc32(F.col("awb_no").cast("binary")) % 3 == 0, F.lit(True))
    for batch, rows in ((1, s.role("refresh").where(~late)), (2, s.role("refresh").where(late)), (2, s.role("refresh"))):
        history.refresh(rows, root, "awb_no", batch)
    return history.read_history(s.spark, root)


@query
def streamed_refresh(s: Star) -> DataFrame:
    root, arrivals = _folder(s, "history"), stage_table(s.role("refresh"), "arrivals")
    history.start_history(s.role("history"), root, "awb_no", buckets=16)
    landed = arrivals.inputFiles()[0].rsplit("/", 1)[0]
    stream = s.spark.readStream.schema(arrivals.schema).parquet(landed)
    writer = stream_refresh(stream, root, "awb_no", _folder(s, "stream"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return history.read_history(s.spark, root)


# Tracking --------------------------------------------------------------------


def _recent(s: Star) -> DataFrame:
    lines = s.role("sales").where(dates.last_30_days(F.col("order_date"), star.RECENT_AS_OF))
    return lines.select(strip_backticks(F.col("tracking_number")).alias("tracking_number"))


@query
def tracking_worklist(s: Star) -> DataFrame:
    return tracking.tracking_worklist(_recent(s), _shipments(s), "awb_no")


@query
def tracking_worklist_open(s: Star) -> DataFrame:
    return tracking.tracking_worklist(_recent(s), _shipments(s), "awb_no", skip_finished=True)


def _tracking_events(s: Star) -> DataFrame:
    """Lines on their order day, shipments open a day later, and closed nine days later if they are."""
    lines = worklist.line_events(s.role("sales"))
    orders = s.spark.sql(
        f"select {star.AWB} as awb_no, o_orderdate, {star.CLASS} as final from {{orders}}", orders=s.table("orders")
    )
    began = orders.select("awb_no", F.lit(carriers.ACTIVE).alias("mapped_status"), F.expr("o_orderdate + interval 1 day").alias("at"))
    ended = orders.where(F.col("final") == carriers.COMPLETED).select(
        "awb_no", F.col("final").alias("mapped_status"), F.expr("o_orderdate + interval 9 day").alias("at")
    )
    return lines.unionByName(worklist.status_events(began.unionByName(ended), "at"))


@query
def streamed_worklist(s: Star) -> DataFrame:
    """Keys due on three poll days, out of events that land in three parts, some late and some twice."""
    landed, out, marks = _folder(s, "events"), _folder(s, "due"), _folder(s, "stream")
    events = stage_table(_tracking_events(s), "tracking-events")
    early, late = F.lit(star.POLL_DAYS[0]).cast("timestamp"), F.lit(star.POLL_DAYS[1]).cast("timestamp")
    day = F.expr("interval 1 day")
    parts = [F.col("time") < early, (F.col("time") >= early - day) & (F.col("time") < late), F.col("time") >= late - day]
    for part in parts:
        sinks.append_rows(events.where(part), landed)
        stream = s.spark.readStream.schema(events.schema).parquet(landed)
        due = worklist.due_keys(stream, star.POLL_DAYS, delay="2 days").writeStream.format("parquet")
        run = due.option("path", out).option("checkpointLocation", marks).trigger(availableNow=True).start()
        run.awaitTermination()
    return s.spark.read.schema("awb_no string, poll_day date").parquet(out)


@query
def worklist_counts(s: Star) -> DataFrame:
    return tracking.worklist_counts(_recent(s), _shipments(s), "awb_no")


@query
def request_batches(s: Star) -> DataFrame:
    return tracking.request_batches(_shipments(s).select("awb_no"))


@query
def request_mode_counts(s: Star) -> DataFrame:
    return tracking.mode_counts(_shipments(s).select("awb_no"))


@query
def scan_rollup(s: Star) -> DataFrame:
    rolled = tracking.rollup_scan_history(s.role("scans"), "awb", ["time", "event_id"])
    return carriers.clean_tracking_d(rolled, star.EVENTS_AS_OF)


@query
def scan_state_refresh(s: Star) -> DataFrame:
    """Scans of three spans of the day folded into a stored state, the latest first and one twice."""
    root = _folder(s, "scan-state")
    scans = s.role("scans")
    for lo, hi in ((16, 24), (0, 8), (8, 16), (0, 8)):
        span = scans.where(F.hour("time").between(lo, hi - 1))
        scan_state.fold_scans(span, root, "awb", ["time", "event_id"], buckets=16)
    state = scan_state.read_states(s.spark, root)
    return carriers.clean_tracking_d(scan_state.rolled_up(state, "awb"), star.EVENTS_AS_OF)


@query
def scan_history_json(s: Star) -> DataFrame:
    """Answers landed as JSON lines and read from there."""
    landed = _folder(s, "answers")
    s.role("scan_documents").write.json(landed)
    rolled = tracking.read_scan_documents(readers.read_documents(s.spark, landed))
    return carriers.clean_tracking_d(rolled, star.AS_OF)


@query
def flatten_shipment_lists(s: Star) -> DataFrame:
    rows = tracking.flatten_shipment_lists(s.role("shipment_documents"), star.AS_OF)
    return carriers.clean_tracking_c(rows)


@query
def flatten_packages(s: Star) -> DataFrame:
    return tracking.flatten_packages(s.role("package_documents"), star.AS_OF)


@query
def package_answers(s: Star) -> DataFrame:
    """Answers of several packages, stored with the fields that nobody asked for."""
    path = _folder(s, "packages")
    answers.package_rows(s.role("package_lists"), star.AS_OF).write.parquet(path)
    return s.spark.read.parquet(path).select(
        "awb_number", "status", "status_type", "pickup_date", "delivery_date", "updated_at", "mapped_status",
        F.array_join("unreadable", ",").alias("unreadable"),
        F.try_variant_get("package", "$.Shipment.Extra.Zone", "bigint").alias("zone"),
    )


@query
def answer_dead_letters(s: Star) -> DataFrame:
    """Unusable answers and packages with their reasons, appended once although the job runs twice."""
    path = _folder(s, "letters")
    for _ in range(2):
        sinks.append_batch(answers.dead_letters(s.role("package_lists")), path, 1)
    return sinks.read_batches(s.spark, path).select("awb", "place", "reason")


@query
def poll_round(s: Star) -> DataFrame:
    """One round of worklist, requests, landed answers and refresh; every seventh order isn't answered."""
    root, letters = _folder(s, "history"), _folder(s, "letters")
    history.start_history(s.role("carrier_e").drop("total_charges"), root, "awb_number", buckets=16)
    landed = stage_table(s.role("package_documents"), "landed")
    unanswered = F.substring("awb", 3, 20).try_cast("bigint") % 7 == 0

    def ask(requests: DataFrame) -> DataFrame:
        asked = requests.select(F.explode(F.split("awbs", ",")).alias("awb"))
        return landed.where(~unanswered).join(asked, "awb", "left_semi")

    for _ in range(2):
        carrier_refresh.poll_round(_recent(s), root, ask, letters, star.AS_OF, 1)
    return history.read_history(s.spark, root)


@query
def dead_letters(s: Star) -> DataFrame:
    path = _folder(s, "failed")
    sinks.append_rows(tracking.failed_scan_documents(s.role("scan_documents")), path)
    sinks.append_rows(tracking.failed_shipment_lists(s.role("shipment_documents")), path)
    return s.spark.read.parquet(path)


@query
def unanswered_keys(s: Star) -> DataFrame:
    answered = tracking.read_scan_documents(s.role("scan_documents"))
    return carrier_refresh.unanswered_keys(
        tracking.tracking_worklist(_recent(s), _shipments(s), "awb_no"), answered, "awb_num"
    )


@query
def refresh_carrier_a(s: Star) -> DataFrame:
    return carrier_refresh.refresh_carrier_a(s.role("carrier_a"), s.role("export_a"), star.AS_OF)


@query
def refresh_carrier_b(s: Star) -> DataFrame:
    return carrier_refresh.refresh_carrier_b(
        s.role("carrier_b"), s.role("export_b"), star.AS_OF
    ).select("awb_no", "status", "mapped_status", "actual_pickup_date", "delivery_date")


@query
def refresh_carrier_c(s: Star) -> DataFrame:
    return carrier_refresh.refresh_carrier_c(
        s.role("carrier_c"), s.role("shipment_documents"), star.AS_OF
    )


@query
def refresh_carrier_d(s: Star) -> DataFrame:
    return carrier_refresh.refresh_carrier_d(
        s.role("carrier_d"), s.role("scan_documents"), star.AS_OF
    )


@query
def refresh_carrier_e(s: Star) -> DataFrame:
    return carrier_refresh.refresh_carrier_e(
        s.role("carrier_e"), s.role("package_documents"), star.AS_OF
    )


# Ledger ----------------------------------------------------------------------


_LEDGER_INPUT = [
    "suborder_no", "mp_name", "order_number", "sku", "suborder_quantity", "selling_price",
    "order_date", "order_status", "shipping_status", "status", "mapped_status", "final_status",
    "manifested_at", "cancelled_at", "pickup_date", "rto_delivered_date", "forced_closure_date",
    "total_charges", "tracking_number", "shipping_state", "client_location",
]


# Columns that a ledger without the place of an entry doesn't read.
_PLACE = ["shipping_state", "client_location"]


def _ledger_base(s: Star, *unread: str) -> DataFrame:
    """Classified lines of all channels with typed dates: what every stored flow starts from."""
    lines = sales.clean_sales(s.role("sales"), "mp_name")
    fact = sla.parse_fact_dates(classify.classify_orders(lines, _shipments(s)))
    fact = fact.withColumn("forced_closure_date", F.lit(None).cast("string")).select(
        *_LEDGER_INPUT
    )
    return _unread(fact, list(unread))


def _retail_fact(s: Star, base: DataFrame) -> DataFrame:
    """All lines with the columns the ledger reads, costs and fees included.

    Written after each of the two joins, so that one shuffle of the lines lies on the disk at a time.
    """
    fact = classify.status_fallback(base).drop("mp_name", "shipping_status", "status")
    costed = costs.attach_cost(sales.with_zero_prices(fact), _costs(s)).drop("suborder_quantity")
    costed = _once(costed, "ledger-costs")
    fact = _once(costs.attach_order_fee(costed, s.role("fees")), "ledger-fact")
    drop_staged(costed)
    return fact


def _shares(fact: DataFrame) -> DataFrame:
    return costs.split_courier_charge(costs.allocate_shipping_tax(fact))


def _segment_fact(base: DataFrame, segment: str, cogs: str) -> DataFrame:
    lines = base.where(sales.in_segment(segment))
    return lines.withColumn(cogs, F.concat(F.col("suborder_quantity").cast("string"), F.lit(".5")))


@query
def ledger_main(s: Star) -> DataFrame:
    base = _once(_ledger_base(s, *_PLACE), "ledger-base")
    fact = _retail_fact(s, base)
    drop_staged(base)
    return ledger.ledger_main(_shares(fact)).drop("shipping_state", "warehouse")


@query
def ledger_reship(s: Star) -> DataFrame:
    return ledger.ledger_reship(_segment_fact(_ledger_base(s), "reship", "rs_cogs")).select(
        "date", "date_reason", "order_id", "suborder_no", "sku", "tagging", "value", "value_reason"
    )


@query
def ledger_cogs_only(s: Star) -> DataFrame:
    base = _ledger_base(s)
    parts = [
        ledger.ledger_cogs_only(_segment_fact(base, segment, tag), tag)
        for segment, tag in [("replace", "rp_cogs"), ("missing", "ms_cogs")]
    ]
    return parts[0].unionByName(parts[1]).select(
        "date", "order_id", "suborder_no", "sku", "tagging", "value", "warehouse"
    )


@query
def ledger_refunds(s: Star) -> DataFrame:
    return ledger.ledger_refunds(s.role("refunds")).select(
        "date", "order_id", "sku", "tagging", "value"
    )


def _full_ledger(s: Star, base: DataFrame, fact: DataFrame) -> DataFrame:
    """All five kinds out of one written copy of the classified lines."""
    return ledger.full_ledger(
        _shares(fact),
        _segment_fact(base, "reship", "rs_cogs"),
        _segment_fact(base, "replace", "rp_cogs"),
        _segment_fact(base, "missing", "ms_cogs"),
        s.role("refunds"),
    )


@query
def ledger_totals(s: Star) -> DataFrame:
    # Entries are counted and summed, whatever their day and place.
    base = _once(_ledger_base(s, "order_date", "cancelled_at", "rto_delivered_date", *_PLACE), "ledger-base")
    return ledger.ledger_totals(_full_ledger(s, base, _retail_fact(s, base)))


@query
def ledger_enriched(s: Star) -> DataFrame:
    base = _once(_ledger_base(s, *_PLACE), "ledger-base")
    fact = _retail_fact(s, base)
    entries = _full_ledger(s, base, fact).select("date", "order_id", "suborder_no", "sku", "tagging", "value")
    entries = _once(entries, "ledger-entries")
    drop_staged(base, fact)
    return ledger.enrich_ledger(entries, s.role("category")).select(
        "date", "order_id", "suborder_no", "sku", "tagging", "value", "category_name", "plant",
        "pot", "color", "units", "weight_actual_in_gms",
    )


# Batches ---------------------------------------------------------------------


def _batch_lines(s: Star, lines: DataFrame | None = None, staged: bool = False) -> DataFrame:
    lines = s.role("sales") if lines is None else lines
    # Lines without a parcel have no flow yet, so their tag comes from the sales flags.
    number = F.col("order_number")
    flows = {"in_retail": ~number.contains("_"), "in_reship": number.contains("_RS"), "in_replace": number.contains("_RP")}
    fact = classify.classify_orders(sales.clean_sales(lines).withColumns(flows), _shipments(s))
    fact = fact.withColumn("in_retail", F.col("in_retail") & F.col("awb_no").isNotNull())
    fact = stage_table(fact.where(" or ".join(flows)).select("suborder_no", "final_status", *flows), "statuses")
    statuses = batches.union_statuses(*[fact.where(flow) for flow in flows])
    enriched = batches.enrich_batches(
        lines, statuses, star.WAREHOUSES, star.HOUSE_BRAND, star.AS_OF, False, staged
    )
    if staged:
        drop_staged(fact)
    return enriched


# What batch lines show, and what their status, tag, channel and batch depend on.
_BATCH_READS = [
    "suborder_no", "mp_name", "brand", "client_location", "order_date", "order_number", "sku",
    "suborder_quantity", "selling_price", "courier_aggregator_name", "tracking_number",
    "order_status", "shipping_status", "payment_mode", "batch_id", "message", "shipping_zip_code",
    "shipping_city",
]


@query
def batch_enrich(s: Star) -> DataFrame:
    raw = _sales_once(s, *_BATCH_READS)
    lines = _batch_lines(s, raw, True).drop("message")
    drop_staged(raw)
    return lines


@query
def batch_shipped_summary(s: Star) -> DataFrame:
    return batches.batch_shipped_summary(_batch_lines(s))


@query
def batch_pending(s: Star) -> DataFrame:
    return batches.batch_pending(_batch_lines(s)).select(
        "suborder_no", "tagging", "batch_id", "batch_id_reason", "batch_date", "week", "days_diff"
    )


# What a batch line's status, tag, batch and week depend on.
_REFRESH_READS = [
    "suborder_no", "order_number", "order_date", "sku", "mp_name", "tracking_number",
    "order_status", "shipping_status", "batch_id",
]


@query
def batch_refresh(s: Star) -> DataFrame:
    """Batch lines merged into a published table that holds some of them and some older ones."""
    root, raw = _folder(s, "batches"), _sales_once(s, *_REFRESH_READS)
    old = raw.where(F.col("order_date") < F.lit("1996-01-01").cast("date"))
    gone = F.concat(F.lit("old-"), F.col("suborder_no"))
    key = F.when(F.length("sku") % 2 == 0, gone).otherwise(F.col("suborder_no"))
    sinks.publish(old.select(key.alias("suborder_no"), F.lit("Stored").alias("tagging")), root)
    lines = _batch_lines(s, raw).select(
        "suborder_no", "tagging", "batch_id", "batch_id_reason", "batch_date", "week", "days_diff"
    )
    sinks.publish(upsert.upsert_replace(sinks.read_published(s.spark, root), lines, "suborder_no"), root)
    return sinks.read_published(s.spark, root)


# Late orders -----------------------------------------------------------------


@query
def delayed_outbox(s: Star) -> DataFrame:
    return outbox.delayed_order_outbox(_classified(s), s.role("products"), star.OUTBOX_AS_OF)


@query
def outbox_counts(s: Star) -> DataFrame:
    """Messages of two days in one appended outbox, by status."""
    path = _folder(s, "outbox")
    for day in (star.OUTBOX_AS_OF, star.OUTBOX_AS_OF + dt.timedelta(days=1)):
        sinks.append_rows(outbox.delayed_order_outbox(_classified(s), s.role("products"), day), path)
    return outbox.outbox_counts(s.spark.read.parquet(path))


@query
def outbox_chunks(s: Star) -> DataFrame:
    """Product lists of late orders in pieces of two names."""
    return outbox.product_chunks(_classified(s), s.role("products"), star.OUTBOX_AS_OF, size=2)


def _responses(s: Star) -> DataFrame:
    """Answers of the message service: finished orders got theirs, open ones failed, others have none."""
    return s.spark.sql(
        """select 'K-' || cast(o_orderkey as string) as order_no,
          case o_orderstatus when 'F' then 200 when 'O' then 500 end as status_code
        from {orders} where o_orderstatus <> 'P'""",
        orders=s.table("orders"),
    )


@query
def run_counts(s: Star) -> DataFrame:
    """What two jobs wrote, counted while they wrote it, from their run log."""
    log, at = _folder(s, "log"), dt.datetime.combine(star.AS_OF, dt.time())
    messages = outbox.delayed_order_outbox(_classified(s), s.role("products"), star.OUTBOX_AS_OF)
    status = F.col("msg_status")
    sent = {"n_sent": status == outbox.SENT, "n_not_sent": status == outbox.NOT_SENT, "n_pending": status == outbox.PENDING}
    path = _folder(s, "outbox")
    counts = sinks.write_counted(
        outbox.with_responses(messages, _responses(s)), lambda df: sinks.append_batch(df, path, 1), sent
    )
    letters, reason = answers.dead_letters(s.role("package_lists")), F.col("reason")
    failed = {"n_" + r: reason == r for r in (answers.EMPTY, answers.NOT_JSON, answers.NO_DATA, answers.NO_KEY)}
    failures = sinks.write_counted(letters, lambda df: sinks.append_batch(df, _folder(s, "letters"), 1), failed)
    for _ in range(2):  # logging again changes nothing
        sinks.log_counts(s.spark, log, "messages", at, counts, 1)
        sinks.log_counts(s.spark, log, "tracking", at, failures, 2)
    return sinks.read_batches(s.spark, log).select("script", "updated_at", "metric", "value")


# Flows -----------------------------------------------------------------------


def _inputs(s: Star) -> order_flow.Inputs:
    return order_flow.Inputs(
        sales=s.role("sales"),
        shipments=_shipments(s),
        costs=_costs(s),
        fees=s.role("fees"),
        corrections=s.role("corrections"),
        reship_table=s.role("reship_table"),
    )


@query
def order_flow_month(s: Star) -> DataFrame:
    """One month over a stored flow with rows of that month and of the next one."""
    path = _folder(s, "flow")
    lines = s.role("sales").where(sales.in_segment("retail"))
    first, last = star.STORED_DAYS
    days = dates.in_window(F.col("order_date"), first, last)
    stored = lines.where(days).select(
        "suborder_no", F.to_date("order_date").alias("order_date"), F.lit("Active").alias("final_status")
    )
    order_flow.store_months(stored, path)
    flow = order_flow.order_flow_month(_inputs(s), star.FLOW_YEAR, star.FLOW_MONTH, star.AS_OF)
    order_flow.refresh_months(flow, path)
    return order_flow.read_flow(s.spark, path, flow.schema).drop("order_month")


_SEGMENT_VIEW = [
    "suborder_no", "order_number", "sku", "final_status", "total_charges", "total_charges_reason",
    "pd_cost", "pd_cost_reason", "date_missing", "o2s", "s2d", "s2nd", "o2c",
]


def _stored_segment(s: Star, mark: str) -> DataFrame:
    """A stored table of an earlier run: lines of the mark, some gone from the sales since."""
    lines = sales.clean_sales(s.role("sales"))
    return lines.where(F.col("order_number").contains(mark)).select(
        F.when(F.col("order_date") < F.lit("1996-01-01").cast("date"), F.concat(
            F.lit("old-"), "suborder_no")).otherwise(F.col("suborder_no")).alias("suborder_no"),
        "order_number",
        "sku",
        F.lit("Active").alias("final_status"),
    )


@query
def segment_flow_reship(s: Star) -> DataFrame:
    stored = _stored_segment(s, "_RS")
    flow = order_flow.order_flow_segment(_inputs(s), "reship", star.AS_OF, stored)
    return flow.select(*_SEGMENT_VIEW)


@query
def segment_flow_replace(s: Star) -> DataFrame:
    stored = _stored_segment(s, "_RP")
    flow = order_flow.order_flow_segment(_inputs(s), "replace", star.AS_OF, stored)
    return flow.select(*_SEGMENT_VIEW)


@query
def segment_flow_missing(s: Star) -> DataFrame:
    stored = _stored_segment(s, "_MS")
    flow = order_flow.order_flow_segment(_inputs(s), "missing", star.AS_OF, stored)
    return flow.select(*_SEGMENT_VIEW)


@query
def segment_flow_corporate(s: Star) -> DataFrame:
    stored = _stored_segment(s, "_Corp")
    flow = order_flow.order_flow_segment(_inputs(s), "corporate", star.AS_OF, stored)
    return flow.select(*_SEGMENT_VIEW, "selling_price", "o2d", "o2ns")


def _stored_flows(
    s: Star, raw: DataFrame, months: list[int] | None = None
) -> tuple[str, T.StructType, dict[str, DataFrame]]:
    """The retail flow stored by month, and the three stored segments, read back.

    All months of the sales, unless a query names some of the flow's year.
    """
    path, inputs = _folder(s, "flow"), _inputs(s)
    # Several flows read them.
    inputs = replace(
        inputs,
        sales=raw,
        shipments=_bucketed(inputs.shipments, "shipments", "awb_no"),
        reship_table=_bucketed(inputs.reship_table, "reships", "clean_id_sku_comb"),
    )
    flows = [order_flow.order_flow_months(inputs, star.AS_OF)] if months is None else []
    for month in months or []:
        # Only one month has corrections, and with them forced closures.
        given = inputs if month == star.FLOW_MONTH else replace(inputs, corrections=None)
        flows.append(order_flow.order_flow_month(given, star.FLOW_YEAR, month, star.AS_OF))
    for flow in flows:
        order_flow.store_months(flow, path)
    kinds = flows[-1].schema
    segments = {}
    for kind, tag in (("reship", "rs_cogs"), ("replace", "rp_cogs"), ("missing", "ms_cogs")):
        flow = order_flow.order_flow_segment(inputs, kind, star.AS_OF)
        cogs = F.concat(F.col("suborder_quantity").cast("string"), F.lit(".5"))
        flow = flow.withColumns({tag: cogs, "forced_closure_date": F.lit(None).cast("string")})
        segments[kind] = stage_table(flow, kind)
    return path, kinds, segments


# All but what only a contact or a batch line shows.
_FLOW_READS = [c for c in sales.SALES_COLUMNS if c not in schemas.CONTACT_COLUMNS] + ["mp_name"]


@query
def ledger_stored(s: Star) -> DataFrame:
    """The ledger of all stored months and segments, forced closures included."""
    raw = _sales_once(s, *_FLOW_READS)
    path, kinds, segments = _stored_flows(s, raw)
    drop_staged(raw)
    # Lines without an order date lie in a part of their own.
    months = s.spark.sql(
        "select distinct coalesce(date_format(o_orderdate, 'yyyy-MM'), 'no_date') as order_month from {orders}",
        orders=s.table("orders"),
    )
    main = order_flow.of_months(order_flow.read_flow(s.spark, path, kinds), months)
    entries = ledger.full_ledger(main, segments["reship"], segments["replace"], segments["missing"], s.role("refunds"))
    return entries.drop("shipping_state", "warehouse")


@query
def batch_stored_flows(s: Star) -> DataFrame:
    """Batch lines tagged by the statuses of the three stored flows."""
    raw = _sales_once(s, *_FLOW_READS, *_BATCH_READS)
    path, kinds, segments = _stored_flows(s, raw, [star.FLOW_MONTH - 1, star.FLOW_MONTH, star.FLOW_MONTH + 1])
    flow = order_flow.read_flow(s.spark, path, kinds)
    statuses = batches.union_statuses(flow, segments["reship"], segments["replace"])
    lines = batches.enrich_batches(
        raw, statuses, star.WAREHOUSES, star.HOUSE_BRAND, star.AS_OF, False, True
    )
    drop_staged(raw, *segments.values())
    return lines.drop("message")


# Sources and sinks -----------------------------------------------------------

_SALES_CHECK = [
    "suborder_no", "mp_name", "order_date", "order_number", "sku", "suborder_quantity",
    "selling_price", "tracking_number", "shipping_status", "manifested_at", "batch_id",
]


def _sales_export(s: Star) -> DataFrame:
    """The sales lines under the headers of the export, as text; one cell spans lines."""
    names = {n: h for h, n in schemas.SALES_HEADERS.items()}
    lines = s.role("sales").withColumn("message", F.lit('call first,\n"back" door'))
    return lines.select(*[F.col(n).cast("string").alias(h) for n, h in names.items()])


def _checked(df: DataFrame) -> DataFrame:
    return df.withColumn("selling_price", F.col("selling_price").try_cast("double")).select(
        *_SALES_CHECK
    )


@query
def csv_roundtrip(s: Star) -> DataFrame:
    path = _folder(s, "sales-csv")
    sinks.write_csv(_sales_export(s), path, compression="gzip")
    return _checked(readers.read_sales_csv(s.spark, path))


@query
def zipped_csv(s: Star) -> DataFrame:
    path = _folder(s, "sales-zip")
    archives.write_zipped_csv(_sales_export(s), path)
    return _checked(readers.typed_sales(archives.read_zipped_csv(s.spark, path, schemas.SALES_HEADERS)))


@query
def preview(s: Star) -> DataFrame:
    """How many rows a preview of the sales lines shows, and how many of them are sales lines."""
    shown = sinks.preview(s.role("sales").select("suborder_no"), 10)
    known = shown.join(s.role("sales").select("suborder_no").distinct(), "suborder_no", "left_semi")
    return shown.agg(F.count(F.lit(1)).alias("n_shown")).join(known.agg(F.count(F.lit(1)).alias("n_known")))


@query
def text_table(s: Star) -> DataFrame:
    """The sales lines as a sheet in which every cell is text."""
    path = _folder(s, "sheet")
    sinks.write_csv(_sales_export(s), path, compression="gzip")
    return readers.read_text_table(s.spark, path, schemas.SALES_HEADERS).select(
        "suborder_no", "mp_name", "sku", "suborder_quantity", "client_location"
    )


@query
def run_log(s: Star) -> DataFrame:
    """One log row for each channel that has lines."""
    path = _folder(s, "log")
    sinks.append_run_logs(s.role("sales").select("mp_name").distinct(), path, dt.datetime.combine(star.AS_OF, dt.time()))
    return s.spark.read.parquet(path)


@query
def month_partitions(s: Star) -> DataFrame:
    path = _folder(s, "months")
    fact = sales.clean_sales(s.role("sales")).select("suborder_no", "order_date", "sku")
    month = F.date_format("order_date", "yyyy-MM")
    sinks.replace_table(fact.withColumn("order_month", month), path, partition_by="order_month")
    nine = [f"1998-{m:02d}" for m in range(4, 13)]
    return readers.read_months(s.spark, path, nine).select(
        "suborder_no", "order_date", "sku", F.col("order_month").cast("string")
    )


@query
def export_sentinels(s: Star) -> DataFrame:
    fact = classify.status_fallback(_classified(s)).select(
        "suborder_no", "selling_price", "total_charges", "total_charges_reason"
    )
    shown = sinks.export_view(fact, schemas.HEADERS)
    text = F.col("total_charges").rlike("^[0-9]") | (F.col("total_charges") == "")
    return (
        shown.groupBy(F.when(text, "value or blank").otherwise(F.col("total_charges")).alias("shown"))
        .agg(F.count("Suborder No").alias("n_lines"))
    )
