"""Tracking answers: scan histories, nested documents, what to ask for next."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelworks import schemas
from parcelworks.functions import dates, text
from parcelworks.operators.carriers import ACTIVE, COMPLETED, class_from_type
from parcelworks.operators.keyed import key_presence

# Scan and type codes of the tracking services.
PICKED_UP = "PickupDone"
RETURN_STARTED = "ReturnInitiated"
ARRIVED = "Delivered"
RETURN_TYPE = "RT"
DELIVERED_TYPE = "DL"
RETURN_PREFIX = "RTO "
MODE_PREFIXES = {"35": "surface", "34": "express"}
UNKNOWN_MODE = "unknown"
REQUEST_SIZE = 50


def rollup_scan_history(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per shipment from (key, status, time) scans; the last scan is by ``order``."""

    def times(status: str) -> Column:
        return F.when(F.col("status") == status, F.col("time"))

    rolled = events.groupBy(key).agg(
        F.min(times(PICKED_UP)).alias("pickup_date"),
        F.max_by("status", F.struct(*order)).alias("last_status"),
        F.min(times(RETURN_STARTED)).alias("rto_initiated_date"),
        F.max(times(ARRIVED)).alias("arrived"),
        F.max((F.col("status") == RETURN_STARTED).cast("int")).alias("returned"),
    )
    return closing_dates(rolled, F.col("returned") == 1).select(
        F.col(key).alias("awb_num"), *ROLLED
    )


ROLLED = ["status", "pickup_date", "delivery_date", "rto_initiated_date", "rto_delivered_date"]


def closing_dates(df: DataFrame, returned: Column) -> DataFrame:
    """A returned shipment arrives back at the sender, any other at the customer."""
    status = F.col("last_status")
    return df.withColumns(
        {
            "status": F.when(returned, F.concat(F.lit(RETURN_PREFIX), status)).otherwise(status),
            "delivery_date": F.when(~returned, F.col("arrived")),
            "rto_delivered_date": F.when(returned, F.col("arrived")),
        }
    )


def _scan_documents(docs: DataFrame) -> DataFrame:
    entry = F.get(F.from_json("body", schemas.SCAN_DOCUMENT)["data"], F.lit(0))
    return docs.withColumn("__entry", entry).withColumns(
        {
            "__scans": F.from_json(F.col("__entry.shippingHistory"), schemas.SCAN_HISTORY),
            "__plain": text.is_blank(F.col("__entry.shippingHistory")),
            "__ok": F.col("__entry").isNotNull(),
        }
    ).withColumn(
        "__ok",
        F.col("__ok") & (F.col("__plain") | F.coalesce(F.size("__scans") > 0, F.lit(False))),
    )


def read_scan_documents(docs: DataFrame) -> DataFrame:
    """Scan-history answers (``awb``, ``body``) as one row per shipment.

    Works inside each document; an answer without a history gives its order
    status and no dates.
    """

    def times(status: str) -> Column:
        hits = F.filter("__scans", lambda s: s["status"] == status)
        return F.transform(hits, lambda s: s["time"].try_cast("timestamp_ntz"))

    last = F.try_element_at(F.col("__scans"), F.lit(-1))
    parsed = _scan_documents(docs).where("__ok")
    rolled = parsed.withColumns(
        {
            "awb_num": F.when(F.col("__plain"), F.col("__entry.awbNumber")).otherwise(F.col("awb")),
            "last_status": F.when(F.col("__plain"), F.col("__entry.orderStatus")).otherwise(
                last["status"]
            ),
            "pickup_date": F.array_min(times(PICKED_UP)),
            "rto_initiated_date": F.array_min(times(RETURN_STARTED)),
            "arrived": F.array_max(times(ARRIVED)),
            "returned": F.coalesce(
                F.exists("__scans", lambda s: s["status"] == RETURN_STARTED), F.lit(False)
            ),
        }
    )
    return closing_dates(rolled, F.col("returned")).select("awb_num", *ROLLED)


def failed_scan_documents(docs: DataFrame) -> DataFrame:
    """Keys whose answer held nothing usable."""
    return _scan_documents(docs).where(~F.col("__ok")).select("awb")


def _shipment_lists(docs: DataFrame) -> DataFrame:
    shipments = F.from_json("body", schemas.SHIPMENT_LIST)["ShipmentData"]["Shipment"]
    return docs.withColumns({"__first": F.get(shipments, 0), "__second": F.get(shipments, 1)})


def _or_blank(path: str) -> Column:
    return F.coalesce(F.col(path), F.lit(""))


def flatten_shipment_lists(docs: DataFrame, as_of: dt.date) -> DataFrame:
    """Carrier C answers, one row each; a second element describes the way back."""
    blank = F.lit("")
    first_type, first_day = _or_blank("__first.StatusType"), _or_blank("__first.StatusDate")
    returning = first_type == RETURN_TYPE
    way_back = returning & F.col("__second").isNotNull()
    scans = F.col("__second.Scans")
    scanned = F.coalesce(F.size(scans) > 0, F.lit(False))
    scan_day = F.coalesce(F.get(scans, 0)["ScanDetail"]["ScanDate"], blank)
    back = way_back & scanned & (F.col("__second.StatusType") == DELIVERED_TYPE)
    return (
        _shipment_lists(docs)
        .where(F.col("__first").isNotNull())
        .select(
            _or_blank("__first.WaybillNo").alias("awb_number"),
            F.when(way_back, F.concat(F.lit(RETURN_PREFIX), _or_blank("__second.Status")))
            .otherwise(_or_blank("__first.Status"))
            .alias("status"),
            first_type.alias("status_type"),
            _or_blank("__first.PickUpDate").alias("pickup_date"),
            F.when(way_back & scanned, scan_day)
            .when(way_back, blank)
            .otherwise(first_day)
            .alias("last_status_date"),
            F.when(first_type == DELIVERED_TYPE, first_day).otherwise(blank).alias("delivery_date"),
            F.when(returning, first_day).otherwise(blank).alias("rto_initiation_date"),
            F.when(back, _or_blank("__second.StatusDate"))
            .otherwise(blank)
            .alias("rto_delivered_date"),
            dates.render(F.lit(as_of)).alias("updated_at"),
        )
    )


def failed_shipment_lists(docs: DataFrame) -> DataFrame:
    return _shipment_lists(docs).where(F.col("__first").isNull()).select("awb")


def flatten_packages(docs: DataFrame, as_of: dt.date) -> DataFrame:
    """Carrier E answers, one row per package (at most ``REQUEST_SIZE`` in an answer)."""
    package = "p.Shipment."

    def day(name: str) -> Column:
        return dates.render(dates.parse_iso(F.col(package + name)))

    return docs.select(
        F.explode(F.from_json("body", schemas.PACKAGE_LIST)["ShipmentData"]).alias("p")
    ).select(
        F.col(package + "AWB").alias("awb_number"),
        F.col(package + "Status.Status").alias("status"),
        F.col(package + "Status.StatusType").alias("status_type"),
        day("PickedupDate").alias("pickup_date"),
        day("DeliveryDate").alias("delivery_date"),
        day("RTOStartedDate").alias("rto_initiation_date"),
        day("ReturnedDate").alias("rto_delivered_date"),
        dates.render(F.lit(as_of)).alias("updated_at"),
        class_from_type(F.col(package + "Status.StatusType")).alias("mapped_status"),
    )


def _known_keys(recent: DataFrame, shipments: DataFrame, key: str) -> DataFrame:
    status = F.coalesce("mapped_status", F.lit(""))
    return key_presence(
        {
            "recent": (
                recent.withColumn("__awb", text.blank_to_null(F.col("tracking_number"))),
                "__awb",
                {},
            ),
            "stored": (
                shipments.withColumn("__awb", text.blank_to_null(F.col(key).cast("string"))),
                "__awb",
                {
                    "n_active": (status == ACTIVE).cast("int"),
                    "n_completed": (status == COMPLETED).cast("int"),
                },
            ),
        }
    )


def _finished() -> Column:
    return (F.col("n_completed") > 0) & (F.col("n_active") == 0)


def tracking_worklist(
    recent: DataFrame, shipments: DataFrame, key: str, skip_finished: bool = False
) -> DataFrame:
    """Keys to ask for: those of recent lines and those still under way.

    With ``skip_finished`` recent keys that are already closed are left out.
    """
    wanted = F.col("n_recent") > 0
    if skip_finished:
        wanted = wanted & ~_finished()
    return (
        _known_keys(recent, shipments, key)
        .where(wanted | (F.col("n_active") > 0))
        .select(F.col("key").alias("awb_no"))
    )


def worklist_counts(recent: DataFrame, shipments: DataFrame, key: str) -> DataFrame:
    """Counts behind a worklist; stored shipments are counted by row, the rest by key."""
    seen = F.col("n_recent") > 0
    unknown = seen & (F.col("n_active") == 0) & (F.col("n_completed") == 0)

    def rows(measure: str) -> Column:
        return F.coalesce(F.sum(F.when(seen, F.col(measure))), F.lit(0)).cast("bigint")

    return (
        _known_keys(recent, shipments, key)
        .agg(
            F.count_if(seen).alias("n_window"),
            rows("n_stored").alias("n_common"),
            rows("n_active").alias("n_common_active"),
            rows("n_completed").alias("n_common_completed"),
            F.count_if(unknown).alias("n_new"),
            # Keys that are both recent and under way: asked for once only.
            F.count_if(seen & (F.col("n_active") > 0)).alias("n_overlap"),
        )
        .withColumn("n_final", F.col("n_common_active") + F.col("n_new"))
    )


def request_mode(key: Column) -> Column:
    mode = F.when(key.isNull(), UNKNOWN_MODE)
    for prefix, name in MODE_PREFIXES.items():
        mode = mode.when(key.startswith(prefix), name)
    return mode.otherwise(UNKNOWN_MODE)


def request_batches(
    keys: DataFrame, key: str = "awb_no", size: int = REQUEST_SIZE, bucket_keys: int = 100_000
) -> DataFrame:
    """Distinct keys in full groups of ``size`` per mode, joined to one request text.

    Keys go by their hash, and are numbered without a global sort: by their place in a
    bucket of hashes plus the keys in the buckets before it. There are so many buckets
    that each holds about ``bucket_keys`` keys; the numbers do not depend on them.
    """
    given = keys.where(F.col(key).isNotNull()).select(F.col(key).alias("__key"))
    count = given.agg(F.approx_count_distinct("__key")).first()[0]
    digits = 1
    while 16**digits * bucket_keys < count:
        digits += 1
    bucketed = given.distinct().withColumns(
        {"mode": request_mode(F.col("__key")), "__hash": F.md5(F.col("__key").cast("binary"))}
    )
    bucketed = bucketed.withColumn("__bucket", F.left("__hash", F.lit(digits)))
    # One row per mode and bucket.
    sizes = bucketed.groupBy("mode", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("mode").orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        "mode", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    place = F.row_number().over(
        Window.partitionBy("mode", "__bucket").orderBy("__hash", "__key")
    )
    numbered = (
        bucketed.withColumn("__place", place)
        .join(offsets, ["mode", "__bucket"])
        .withColumn("__row", F.col("__before") + F.col("__place") - 1)
        .withColumn("chunk", F.floor(F.col("__row") / F.lit(size)).cast("bigint"))
    )
    return (
        numbered.groupBy("mode", "chunk")
        .agg(
            F.count(F.lit(1)).alias("n_keys"),
            # At most ``size`` keys in a group.
            F.array_sort(F.collect_list(F.struct("__row", "__key"))).alias("__keys"),
        )
        .withColumn("awbs", F.array_join(F.col("__keys")["__key"], ","))
        .drop("__keys")
    )


def mode_counts(keys: DataFrame, key: str = "awb_no") -> DataFrame:
    """Distinct keys per request mode."""
    return (
        keys.where(F.col(key).isNotNull())
        .select(key)
        .distinct()
        .groupBy(request_mode(F.col(key)).alias("mode"))
        .agg(F.count(F.lit(1)).alias("n_keys"))
    )
