"""Manual corrections of single cells, and the link from a line to its reshipment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelworks.functions import dates
from parcelworks.functions.money import to_number
from parcelworks.functions.sentinels import SUFFIX
from parcelworks.operators.classify import FORCED_CLOSURE
from parcelworks.operators.keyed import group_stats, key_presence, last_by_key, lookup
from parcelworks.schemas import HEADERS

# Fixed value: days from shipment to a forced closure.
CLOSURE_DAYS = 20

_BASES = ["pickup_date", "manifested_at", "order_date"]


def of_month(corrections: DataFrame | None, month: int) -> DataFrame | None:
    return None if corrections is None else corrections.where(F.col("parent_order_month").try_cast("int") == month)


def _in_month(month: Column, number: Column) -> Column:
    return F.concat(month.cast("string"), F.lit("/"), number)


def _internal_name(column: Column) -> Column:
    """Corrections may name a column by its export header or by its table name."""
    pairs = [F.lit(x) for header, name in HEADERS.items() for x in (header, name)]
    return F.coalesce(F.create_map(*pairs)[column], column)


def _collapsed(corrections: DataFrame, columns: list[str]) -> DataFrame:
    """One row per suborder: last value per column, and what a forced closure needs."""
    cells = corrections.select(
        F.col("suborder_id").alias("__id"),
        _internal_name(F.col("column_name")).alias("column_name"),
        F.col("change_value_to").alias("value"),
        "row_no",
    ).where(F.col("column_name").isin(*columns))
    closes = F.col("value").contains(FORCED_CLOSURE)
    cells = group_stats(cells, "__id", {"__closed_at": F.max(F.when(closes, F.col("row_no")))})
    earlier = F.when(F.col("row_no") < F.col("__closed_at"), F.col("row_no"))
    last = cells.groupBy("__id", "column_name").agg(
        F.max_by("value", "row_no").alias("value"),
        F.max("row_no").alias("row_no"),
        F.max("__closed_at").alias("__closed_at"),
        # The value a date had when the closure was entered.
        F.max_by("value", earlier).alias("before"),
        F.max(earlier).alias("before_at"),
    )

    def of(name: str, what: str) -> Column:
        return F.max(F.when(F.col("column_name") == name, F.col(what)))

    # At most one entry per column of the fact.
    return last.groupBy("__id").agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", "value"))).alias("__fix"),
        F.max("__closed_at").alias("__closed_at"),
        of("forced_closure_date", "row_no").alias("__closure_fix_at"),
        *[of(b, "before").alias("__before_" + b) for b in _BASES],
        *[of(b, "before_at").alias("__before_at_" + b) for b in _BASES],
    )


def apply_corrections(
    fact: DataFrame, corrections: DataFrame | None = None, by_month: bool = False
) -> DataFrame:
    """Overwrite single cells; per line and column the last correction in ``row_no`` wins.

    With ``by_month`` the fact holds lines of many months, and each takes the corrections of
    its own order month alone, as ``of_month`` picks them for a fact of one month.

    A value containing ``forced_closure`` also sets ``forced_closure_date`` to 20
    days after pickup, else manifest, else order day of the row. Corrections of
    columns the fact does not have are named by ``unknown_columns``.
    """
    if corrections is None:
        own = "forced_closure_date" in fact.columns
        return fact if own else fact.withColumn("forced_closure_date", F.lit(None).cast("string"))
    columns, key = fact.columns, "suborder_no"
    types = {f.name: f.dataType.typeName() for f in fact.schema.fields}
    if by_month:
        key = "__in_month"
        own = _in_month(F.col("parent_order_month").try_cast("int"), F.col("suborder_id"))
        corrections = corrections.withColumn("suborder_id", own)
        fact = fact.withColumn(key, _in_month(F.month("order_date"), F.col("suborder_no")))
    fixes = _collapsed(corrections, [*columns, "forced_closure_date"])
    extra = ["__fix", "__closed_at", "__closure_fix_at"]
    extra += [kind + b for b in _BASES for kind in ("__before_", "__before_at_")]
    joined = lookup(fact, fixes, key, "__id", extra)

    def fixed(name: str) -> Column:
        return F.coalesce(F.map_contains_key(F.col("__fix"), F.lit(name)), F.lit(False))

    changed: dict[str, Column] = {}
    for name, kind in types.items():
        if name == "suborder_no" or name.endswith(SUFFIX):
            continue
        text = F.col("__fix")[name]
        if kind == "string":
            value = text
        elif kind == "date":
            value = dates.parse_day_first(text) if name == "cancelled_at" else dates.parse_iso(text)
        elif kind.startswith("timestamp"):
            value = text.try_cast(fact.schema[name].dataType)
        else:
            value = to_number(text).cast(fact.schema[name].dataType)
        changed[name] = F.when(fixed(name), value).otherwise(F.col(name))
        if name + SUFFIX in types:
            reason = F.when(to_number(text).isNull(), text)
            changed[name + SUFFIX] = F.when(fixed(name), reason).otherwise(F.col(name + SUFFIX))

    def base(name: str) -> Column:
        own = F.col(name)
        own = own if types[name] == "date" else dates.parse_day_first(own)
        earlier = F.col("__before_at_" + name).isNotNull()
        return F.when(earlier, dates.parse_day_first(F.col("__before_" + name))).otherwise(own)

    closure = dates.render(F.date_add(F.coalesce(*[base(b) for b in _BASES]), CLOSURE_DAYS))
    entered_later = F.coalesce(
        F.col("__closure_fix_at") > F.col("__closed_at"), F.lit(False)
    )
    changed["forced_closure_date"] = F.when(
        F.col("__closed_at").isNotNull() & ~entered_later, closure
    ).otherwise(changed.get("forced_closure_date", F.lit(None).cast("string")))
    return joined.withColumns(changed).drop(*extra, "__in_month")


def unknown_columns(fact: DataFrame, corrections: DataFrame) -> DataFrame:
    """Corrections that name a column the fact does not have."""
    return corrections.where(~_internal_name(F.col("column_name")).isin(*fact.columns))


def unmatched_corrections(fact: DataFrame, corrections: DataFrame) -> DataFrame:
    """Corrections of suborders the fact does not hold."""
    return (
        key_presence(
            {"fact": (fact, "suborder_no", {}), "corrections": (corrections, "suborder_id", {})}
        )
        .where("n_fact = 0")
        .select(F.col("key").alias("suborder_id"), "n_corrections")
    )


def link_reshipments(fact: DataFrame, reship: DataFrame, order: list[str]) -> DataFrame:
    """Add ``rs_suborder_no``: the last reshipment of the same order and SKU."""
    last = last_by_key(
        reship.select(
            F.col("clean_id_sku_comb"), F.col("suborder_no").alias("rs_suborder_no"), *order
        ),
        "clean_id_sku_comb",
        "rs_suborder_no",
        order,
    )
    return lookup(
        fact, last, "combine_id", "clean_id_sku_comb", ["rs_suborder_no"], spread=["suborder_no"]
    )
