"""Tracking answers as variants: unknown fields stay, unusable answers say why.

An answer's body is parsed once into a variant, whatever its shape. Fields are taken out by
path and kind; one that is missing or of another kind is null, and the package itself stays
next to them, so that a field nobody asked for today can be read from the stored table
tomorrow. What can't be used goes to the dead letters with a reason.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelworks.functions import dates, text
from parcelworks.operators.carriers import class_from_type

# Where the answers of the tracking services hold what was asked for.
SCANS, SHIPMENTS, PACKAGES = "$.data", "$.ShipmentData.Shipment", "$.ShipmentData"
_PACKAGE = {
    "awb_number": "$.Shipment.AWB",
    "status": "$.Shipment.Status.Status",
    "status_type": "$.Shipment.Status.StatusType",
}
_DAYS = {
    "pickup_date": "$.Shipment.PickedupDate",
    "delivery_date": "$.Shipment.DeliveryDate",
    "rto_initiation_date": "$.Shipment.RTOStartedDate",
    "rto_delivered_date": "$.Shipment.ReturnedDate",
}

EMPTY, NOT_JSON, NO_DATA, NO_KEY = "empty", "not_json", "no_data", "no_key"


def read_answers(docs: DataFrame, path: str) -> DataFrame:
    """Add ``answer`` (variant), ``elements`` (the list at ``path``) and ``reason``.

    ``reason`` is null for an answer with elements; otherwise ``empty`` (null or blank body),
    ``not_json`` (malformed) or ``no_data`` (no list there, or nothing in it).
    """
    parsed = docs.withColumn("answer", F.try_parse_json("body"))
    listed = parsed.withColumn("elements", F.try_variant_get("answer", path, "array<variant>"))
    reason = (
        F.when(text.is_blank(F.trim("body")), EMPTY)
        .when(F.col("answer").isNull(), NOT_JSON)
        .when(F.coalesce(F.size("elements"), F.lit(0)) == 0, NO_DATA)
    )
    return listed.withColumn("reason", reason)


def _field(path: str) -> Column:
    return F.try_variant_get("package", path, "string")


def _packages(docs: DataFrame) -> DataFrame:
    usable = read_answers(docs, PACKAGES).where("reason is null")
    found = usable.select("awb", F.posexplode("elements").alias("place", "package"))
    return found.withColumns({name: text.blank_to_null(_field(path)) for name, path in {**_PACKAGE, **_DAYS}.items()})


def package_rows(docs: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per package with a key: the columns of ``flatten_packages``, and the whole ``package``.

    A day that is present and no date is null, and its column is named in ``unreadable``.
    """
    days = {name: dates.parse_iso(F.col(name)) for name in _DAYS}
    wrong = [F.when(F.col(name).isNotNull() & day.isNull(), F.lit(name)) for name, day in days.items()]
    return _packages(docs).where("awb_number is not null").select(
        *_PACKAGE,
        *[dates.render(day).alias(name) for name, day in days.items()],
        dates.render(F.lit(as_of)).alias("updated_at"),
        class_from_type(F.col("status_type")).alias("mapped_status"),
        F.array_compact(F.array(*wrong)).alias("unreadable"),
        "package",
    )


def dead_letters(docs: DataFrame, path: str = PACKAGES) -> DataFrame:
    """``awb``, ``place`` and ``reason`` of every answer, or package in it, that can't be used."""
    no_place = F.lit(None).cast("int")
    answers = read_answers(docs, path).where("reason is not null").select("awb", no_place.alias("place"), "reason")
    if path != PACKAGES:
        return answers
    unnamed = _packages(docs).where("awb_number is null")
    return answers.unionByName(unnamed.select("awb", "place", F.lit(NO_KEY).alias("reason")))
