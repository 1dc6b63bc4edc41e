"""Reference SQL for the queries, over the same roles of the given tables.

The roles are shared text; every rule on top of them is written here a second
time, in plain SQL with joins, windows and CASE.
"""

from __future__ import annotations

import re

from parcelworks.operators.batches import CHANNELS
from parcelworks.operators.carriers import STATUS_A, STATUS_B, STATUS_C
from parcelworks.plans import star
from parcelworks.plans.star import AWB, CLOSED, DELIVERY, PICKUP, RETURN, RETURNED, ROLES, M


def _values(entries: dict[str, str]) -> str:
    rows = ", ".join(
        "('{}', '{}')".format(k.replace("'", "''"), v.replace("'", "''"))
        for k, v in entries.items()
    )
    return f"(values {rows})"


def _r(x: str) -> str:
    return f"(round_even(({x}) * 100.0::double, 0) / 100.0::double)"


def _num(text: str) -> str:
    return f"try_cast(replace({text}, ',', '') as double)"


def _sum(x: str) -> str:
    return f"cast(sum(cast({x} as decimal(28,6))) as double)"


def _stored(text: str) -> str:
    return f"cast(try_strptime({text}, '%d-%m-%Y') as date)"


AS_OF = f"date '{star.AS_OF}'"
AS_OF_TEXT = star.AS_OF.strftime("%d-%m-%Y")

_WAITING = "(shipping_status_new = 'No' and coalesce(delivered_date, '') = '')"

CTES: dict[str, str] = {
    **{name: text.replace("{", "").replace("}", "") for name, text in ROLES.items()},
    "cleaned": """
      select * replace (cast(order_date as date) as order_date,
          replace(order_number, '`', '') as order_number,
          nullif(trim(replace(tracking_number, '`', '')), '') as tracking_number,
          cast(manifested_at as date) as manifested_at,
          cast(cancelled_at as date) as cancelled_at),
        replace(order_number, '`', '') || '_' || sku as combine_id,
        replace(order_number, '`', '') || '_' || marketplace_sku as combine_id_mp,
        case when shipping_status is null or shipping_status in ('', 'Cancelled',
            'Out For Pickup', 'Shipment Created', 'Pickup Exception', 'Pickup Scheduled')
          then 'No' else 'Yes' end as shipping_status_new,
        case when order_status in ('Cancelled', 'CANCELLED') or shipping_status = 'Cancelled'
          then 'Yes' else 'No' end as cancelled_status,
        case when shipping_status = 'Delivered' then 'Yes'
          when shipping_status in ('Delivered To Origin', 'RTO initiated', 'RTO In-Transit',
            'Returned') then 'RTO' else 'Active' end as delivered
      from sales""",
    "ships": f"""
      select awb_code as awb_no, status, order_picked_up_date as pickup_date,
        order_delivered_date as delivered_date, cast(null as string) as rto_initiation_date,
        rto_delivered_date, mapped_status, updated_at, cod_charges,
        {_num("cod_charges")} + {_num("freight_total_amount")} as total_charges
      from carrier_a
      union all
      select awb_no, status, actual_pickup_date, delivery_date, null, rto_delivery_date,
        mapped_status, updated_at, cod_charges,
        {_num("cod_charges")} + {_num("shipping_charges")} + {_num("rto_cod_charges")}
          + {_num("rto_charges")}
      from carrier_b
      union all
      select awb_number, status, pickup_date, delivery_date, rto_initiation_date,
        rto_delivered_date, mapped_status, updated_at, null, {_num("total_charges")}
      from carrier_c
      union all
      select awb_num, status, pickup_date, delivery_date, rto_initiated_date,
        rto_delivered_date, mapped_status, updated_at, null, {_num("total_charges")}
      from carrier_d
      union all
      select awb_number, status, pickup_date, delivery_date, rto_initiation_date,
        rto_delivered_date, mapped_status, updated_at, null, {_num("total_charges")}
      from carrier_e""",
    "joined": "select c.*, s.* from cleaned c left join ships s on c.tracking_number = s.awb_no",
    "classified": f"""
      select *, case
        when lower(status) like '%lost%' or lower(status) like '%damaged%'
          or status = 'CONTACT CUSTOMER SERVICE' then 'Lost or Damaged'
        when upper(status) like '%RTO%' or status = 'DELIVERED BACK TO SHIPPER' then 'RTO'
        when status in ('RETURN TO SHIPPER', 'PickupCancelled', 'Cancelled',
            'PICKUP EMPLOYEE IS OUT TO P/U SHIPMENT', 'PICKUP CANCELLED BY CALL')
          or (cancelled_status = 'Yes' and {_WAITING}) then 'Cancelled'
        when status in ('Delivered', 'SHIPMENT DELIVERED', 'DELIVERED') then 'Delivered'
        when {_WAITING} then (case when order_status = 'Pending' then 'Not Shipped (No Inventory)'
          when coalesce(pickup_date, '') <> '' then 'Active' else 'Not Shipped' end)
        else 'Active' end as final_status
      from joined""",
    "flowing": """
      select * replace (case
          when coalesce(status, '') = '' and (upper(coalesce(shipping_status, '')) like '%RTO%'
            or shipping_status = 'Delivered To Origin') then 'RTO'
          when coalesce(status, '') = '' and shipping_status = 'Delivered' then 'Delivered'
          else final_status end as final_status),
        case when final_status not in ('Cancelled', 'Not Shipped') and total_charges is null
          then 'no_cost_avl' end as total_charges_reason
      from classified""",
    "sku_costs": f"""
      select nullif(trim(sku), '') as cost_sku, nullif(total_b2c_cost_with_tax, '') as unit_cost,
        {_num("tax_rate")} as tax_rate from bundle_costs where b2c_other = 'cost_avl'
      union all
      select nullif(trim(sku), ''), nullif(total_b2c_cost_with_tax, ''), {_num("tax_rate")}
      from single_costs where tagging = 'all_completed'""",
    "order_fees": f"select order_id, {_num('shipping')} as order_fee from fees",
    "costed": f"""
      select c.*, {_num("k.unit_cost")} * coalesce(c.suborder_quantity, 0) as pd_cost,
        case when k.unit_cost is null then 'no_cost_avl' end as pd_cost_reason, k.tax_rate
      from flowing c left join sku_costs k on nullif(trim(c.sku), '') = k.cost_sku""",
    "feed": """
      select * replace (coalesce(selling_price, 0) as selling_price), f.order_fee
      from costed left join order_fees f on order_number = f.order_id""",
    "totalled": f"""
      select *, {_sum("selling_price")} over (partition by order_number) as tot from feed"""
    .replace("cast(sum(cast(selling_price as decimal(28,6))) as double) over (partition by "
             "order_number)",
             "cast(sum(cast(selling_price as decimal(28,6))) over (partition by order_number) "
             "as double)"),
    "shared": f"""
      select *, case when tot <> 0 then {_r("selling_price / tot * order_fee")} else 0 end as s
      from totalled""",
    "nets": f"""
      select *, {_r("s / 118.0::double * 18.0::double")} as t, {_r("selling_price - s")} as base
      from shared""",
    "allocated": f"""
      select * exclude (tot, s, t, base),
        case when order_fee is null then 'no_shipping_avl' when tax_rate is null then 'no_tax_avl'
          end as pd_tax_reason,
        case when order_fee is null then 'no_shipping_avl' when tax_rate is null then 'no_tax_avl'
          end as pd_taxable_value_reason,
        case when order_fee is null then 'no_shipping_avl' end as shipping_value_reason,
        case when order_fee is null then 'no_shipping_avl' end as shipping_tax_reason,
        case when order_fee is not null and tax_rate is not null
          then {_r("base / (1.0::double + tax_rate) * tax_rate")} end as pd_tax,
        case when order_fee is not null and tax_rate is not null
          then base - {_r("base / (1.0::double + tax_rate) * tax_rate")} end as pd_taxable_value,
        case when order_fee is null then null when tax_rate is null then s - t
          else {_r("s - t")} end as shipping_value,
        case when order_fee is not null then t end as shipping_tax
      from nets""",
    "dated": f"""
      select * replace ({_stored("pickup_date")} as pickup_date,
        {_stored("delivered_date")} as delivered_date,
        {_stored("rto_delivered_date")} as rto_delivered_date) from flowing""",
}


def _missing() -> str:
    return """case
        when final_status = 'Delivered' then (ship is null or delivered_date is null)
        when final_status like '%forced_closure%' then false
        when final_status = 'Cancelled' then cancelled_at is null
        when final_status in ('Active', 'Lost or Damaged') then ship is null
        when final_status = 'RTO' and mapped_status = 'status_completed'
          then (rto_delivered_date is null or ship is null)
        when final_status = 'RTO' then ship is null
        else false end"""


def _sla(source: str, extra: str = "*") -> str:
    """Durations over a source with typed dates."""
    returned = "(final_status = 'RTO' and coalesce(mapped_status, '') = 'status_completed')"

    def one(name: str, applies: str, start: str, end: str, na: str | None = None) -> str:
        na = na or f"not ({applies})"
        return f"""
          case when ({applies}) and date_missing = 'No'
            then cast(date_diff('day', {start}, {end}) as int) end as {name},
          case when {na} then 'NA' when date_missing = 'Yes' then 'date_missing' end
            as {name}_reason"""

    gone = "final_status not in ('Not Shipped', 'Cancelled')"
    return f"""
      select *, {one("o2s", gone, "order_date", "ship",
                     f"not ({gone}) or (date_missing = 'No' and ship is null)")},
        {one("o2ns", "final_status = 'Not Shipped'", "order_date", AS_OF)},
        {one("s2d", f"final_status = 'Delivered' or {returned}", "ship",
             "case when final_status = 'Delivered' then delivered_date "
             "else rto_delivered_date end")},
        {one("s2nd", f"final_status not in ('Cancelled', 'Not Shipped', 'Delivered') "
             f"and not {returned}", "ship", AS_OF)},
        {one("o2c", "final_status = 'Cancelled'", "order_date", "cancelled_at")},
        {one("o2d", "final_status = 'Delivered'", "order_date", "delivered_date")}
      from (select *, case when {_missing()} then 'Yes' else 'No' end as date_missing
            from (select *, coalesce(pickup_date, manifested_at) as ship from {source}))"""


CTES["timed"] = _sla("dated")


def _parsed(source: str) -> str:
    return f"""(select * replace ({_stored("pickup_date")} as pickup_date,
        {_stored("delivered_date")} as delivered_date,
        {_stored("rto_delivered_date")} as rto_delivered_date) from {source})"""


_SEGMENTS = {"reship": "_RS", "replace": "_RP", "missing": "_MS"}


def _is_segment(kind: str) -> str:
    if kind == "retail":
        return "lower(mp_name) = 'shopify'"
    if kind == "corporate":
        return (
            "lower(mp_name) in ('offline', 'b2b') "
            "and regexp_matches(lower(order_number), 'corp|samp')"
        )
    return (
        "lower(mp_name) = 'offline' and not contains(lower(order_number), 'corp') "
        f"and contains(order_number, '{_SEGMENTS[kind]}')"
    )


_OUT = "final_status not in ('Cancelled', 'Not Shipped', 'Not Shipped (No Inventory)')"
_TAXES = """pd_taxable_value as product_taxable_value,
  pd_taxable_value_reason as product_taxable_value_reason, pd_tax as product_tax,
  pd_tax_reason as product_tax_reason, shipping_value, shipping_value_reason, shipping_tax,
  shipping_tax_reason"""
_NO_TAXES = """cast(null as double) as product_taxable_value,
  cast(null as string) as product_taxable_value_reason, cast(null as double) as product_tax,
  cast(null as string) as product_tax_reason, cast(null as double) as shipping_value,
  cast(null as string) as shipping_value_reason, cast(null as double) as shipping_tax,
  cast(null as string) as shipping_tax_reason"""


def _entry(
    source: str, tag: str, day: str, value: str, where: str, taxed: bool = False,
    value_reason: str = "cast(null as string)", day_reason: str = "cast(null as string)",
) -> str:
    return f"""select {day} as date, {day_reason} as date_reason, order_number as order_id,
      suborder_no, sku, {tag} as tagging, cast({value} as double) as value,
      {value_reason} as value_reason, {_TAXES if taxed else _NO_TAXES}, shipping_state,
      client_location as warehouse from {source} where {where}"""


CTES["ledger_charges"] = f"""
  select * replace (case when tracking_number is null then {_r("total_charges")}
      else {_r("total_charges / count(*) over (partition by tracking_number)")} end
    as total_charges) from allocated"""
CTES["ledger_fact"] = f"""
  select * replace (case when final_status = 'RTO' and order_status = 'Cancelled'
    and pickup_date is null then 'Cancelled' else final_status end as final_status)
  from {_parsed("ledger_charges")}"""
_SHIP = "coalesce(pickup_date, manifested_at)"
_NO_DAY = f"case when {_SHIP} is null then 'date_missing' end"
_DONE = "final_status = 'RTO' and mapped_status = 'status_completed'"
CTES["main_entries"] = " union all ".join(
    [
        _entry("ledger_fact", "'Sales'", "order_date", "selling_price", "true", True),
        _entry("ledger_fact", "'Cancelled'", "cancelled_at", "selling_price",
               "final_status = 'Cancelled'", True),
        _entry("ledger_fact", "'RTO_delivered'", "rto_delivered_date", "selling_price", _DONE,
               True),
        _entry("ledger_fact", "'Lost/Damaged'", "manifested_at", "selling_price",
               "final_status = 'Lost or Damaged'", True),
        _entry("ledger_fact", "'pd_cogs'", "order_date", "pd_cost", _OUT,
               value_reason="pd_cost_reason"),
        _entry("ledger_fact", "'shipped'", _SHIP, "selling_price", _OUT, True,
               day_reason=_NO_DAY),
        _entry("ledger_fact", "'courier_cogs'", "order_date", "total_charges", _OUT,
               value_reason="total_charges_reason"),
    ]
)
for _kind, _tag in [("reship", "rs_cogs"), ("replace", "rp_cogs"), ("missing", "ms_cogs")]:
    CTES[f"{_kind}_fact"] = f"""
      select *, suborder_quantity + 0.5 as {_tag}
      from {_parsed("classified")} where {_is_segment(_kind)}"""
CTES["reship_entries"] = " union all ".join(
    [
        _entry("reship_fact", "'RS_Sales'", "order_date", "selling_price", "true"),
        _entry("reship_fact", "'RS_Cancelled'", "coalesce(cancelled_at, order_date)",
               "selling_price", "final_status = 'Cancelled'"),
        _entry("reship_fact", "'RS_RTO_delivered'", "rto_delivered_date", "selling_price", _DONE),
        _entry("reship_fact", "'RS_Lost/Damaged'", "manifested_at", "selling_price",
               "final_status = 'Lost or Damaged'"),
        _entry("reship_fact", "'rs_cogs'", _SHIP, "rs_cogs", _OUT),
        _entry("reship_fact", "'rs_shipped'", _SHIP, "selling_price", _OUT, day_reason=_NO_DAY),
    ]
)
CTES["cogs_entries"] = " union all ".join(
    [
        _entry("replace_fact", "'rp_cogs'", _SHIP, "rp_cogs", _OUT),
        _entry("missing_fact", "'ms_cogs'", _SHIP, "ms_cogs", _OUT),
    ]
)
CTES["refund_entries"] = f"""
  select date, cast(null as string) as date_reason, 'K-' || order_id as order_id,
    cast(null as string) as suborder_no, sku, 'Refund' as tagging, {_num("amount")} as value,
    cast(null as string) as value_reason, {_NO_TAXES}, cast(null as string) as shipping_state,
    cast(null as string) as warehouse
  from refunds
  where refund_reason in ('Damaged Plant', 'Damaged Replacement') and approval = 'Yes'
    and amount <> '' and {_num("amount")} <> 0"""
CTES["all_entries"] = """
  select * from main_entries union all by name select * from reship_entries
  union all by name select * from cogs_entries union all by name select * from refund_entries"""

_WAREHOUSES = _values(star.WAREHOUSES)
_CHANNELS = _values({k: v.format(own=star.HOUSE_BRAND.lower()) for k, v in CHANNELS.items()})
CTES["statuses"] = """
  select suborder_no, final_status from classified
  where (awb_no is not null and not contains(order_number, '_'))
    or contains(order_number, '_RS') or contains(order_number, '_RP')"""
CTES["batched"] = f"""
  select r.* replace (replace(order_number, '`', '') as order_number,
      replace(tracking_number, '`', '') as tracking_number,
      cast(order_date as date) as order_date,
      cast(suborder_quantity as bigint) as suborder_quantity),
    st.final_status, w.b as new_wh_name,
    max(cast(order_date as date)) over (partition by batch_id) as top_date,
    case when contains(mp_name, 'Vendor Central')
        or mp_name in ('Amazon.in', 'B2B', 'Production Order')
      then (case when order_status = 'Shipped' then 'Yes' else 'No' end)
      when shipping_status is null or shipping_status in ('', 'Cancelled', 'Out For Pickup',
        'Shipment Created', 'Pickup Exception', 'Pickup Scheduled') then 'No'
      else 'Yes' end as left_wh,
    case when ch.b is not null then ch.b
      when mp_name = 'Amazon.in' then (case when brand = '{star.HOUSE_BRAND}'
        then 'amz-{star.HOUSE_BRAND.lower()}' else 'amz-rb' end)
      when mp_name in ('Offline', 'B2B') and (contains(order_number, 'SAMP')
        or contains(order_number, 'CORP')) then 'corp-mp'
      when mp_name = 'Offline' then 'rs-rp-order' when mp_name = 'B2B' then 'bulk-order'
      end as new_mp_name
  from sales r
    left join statuses st on r.suborder_no = st.suborder_no
    left join {_WAREHOUSES} w(a, b) on r.client_location = w.a
    left join {_CHANNELS} ch(a, b) on r.mp_name = ch.a"""
CTES["batch_lines"] = f"""
  select client_location, mp_name,
    case when coalesce(final_status, '') = '' then (case
        when order_status in ('Cancelled', 'CANCELLED') or shipping_status = 'Cancelled'
          then 'Cancelled'
        when left_wh = 'No' then 'Not Shipped' else 'Shipped' end)
      when final_status in ('Cancelled', 'Not Shipped') then final_status
      else 'Shipped' end as tagging,
    cast(strftime(case when batch_id is null then order_date else top_date end, '%W') as int)
      as week,
    cast(date_diff('day', order_date, {AS_OF}) as int) as days_diff, new_wh_name, new_mp_name,
    try_cast(batch_id as bigint) as batch_id,
    case when try_cast(batch_id as bigint) is null then 'no_batch_created' end as batch_id_reason,
    case when batch_id is not null then top_date end as batch_date, order_date, order_number,
    suborder_no, order_status, final_status, courier_aggregator_name, tracking_number,
    payment_mode, message, sku, suborder_quantity, selling_price, shipping_zip_code, shipping_city
  from batched"""

CTES["renewed"] = """
  select awb_no, max(case when mapped_status <> 'status_completed' then 1 else 0 end) as still_open
  from history where awb_no is not null group by awb_no"""
CTES["asked_keys"] = "select distinct awb_no from refresh where awb_no is not null"
CTES["upserted"] = """
  select * from history where awb_no is null
  union all
  select h.* from history h join renewed r on h.awb_no = r.awb_no
    left join asked_keys a on h.awb_no = a.awb_no where a.awb_no is null or r.still_open = 0
  union all
  select * from refresh where awb_no is null
  union all
  select n.* from refresh n left join renewed r on n.awb_no = r.awb_no
    where n.awb_no is not null and (r.awb_no is null or r.still_open = 1)"""

CTES["recent_keys"] = f"""
  select distinct nullif(trim(replace(tracking_number, '`', '')), '') as awb_no from sales
  where order_date >= date '{star.RECENT_AS_OF}' - interval 30 day
    and order_date < date '{star.RECENT_AS_OF}'
    and nullif(trim(replace(tracking_number, '`', '')), '') is not null"""

_MODE = """case when starts_with(awb_no, '35') then 'surface'
  when starts_with(awb_no, '34') then 'express' else 'unknown' end"""

# Corrections of the month, and the fact before them.
CTES["month_fixes"] = f"""
  select *, case when column_name = 'Selling Price' then 'selling_price' else column_name end as c,
    max(case when contains(change_value_to, 'forced_closure') then row_no end)
      over (partition by suborder_id) as closed_at
  from corrections where cast(parent_order_month as int) = {star.FLOW_MONTH}"""
CTES["fixes"] = """
  select suborder_id,
    arg_max(change_value_to, row_no) filter (c = 'final_status') as f_status,
    arg_max(change_value_to, row_no) filter (c = 'pickup_date') as f_pickup,
    arg_max(change_value_to, row_no) filter (c = 'selling_price') as f_price,
    arg_max(change_value_to, row_no) filter (c = 'total_charges') as f_charge,
    arg_max(change_value_to, row_no) filter (c = 'pickup_date' and row_no < closed_at)
      as f_earlier,
    max(closed_at) as closed_at
  from month_fixes group by suborder_id"""


def _fixed(source: str, extra: str = "") -> str:
    closure = f"""coalesce({_stored("f_earlier")}, {_stored("pickup_date")},
        manifested_at, order_date)"""
    return f"""
      select {source}.* replace (coalesce(f_status, final_status) as final_status,
          coalesce(f_pickup, pickup_date) as pickup_date,
          case when f_price is not null then {_num("f_price")} else selling_price end
            as selling_price,
          case when f_charge is not null then {_num("f_charge")} else total_charges end
            as total_charges,
          case when f_charge is not null and {_num("f_charge")} is null then f_charge
            when f_charge is null then total_charges_reason end as total_charges_reason),
        case when closed_at is not null
          then strftime({closure} + interval 20 day, '%d-%m-%Y') end as forced_closure_date
      from {source} left join fixes on suborder_no = suborder_id"""


CTES["retail_split"] = f"""
  select a.* replace (
      case when tracking_number is null then {_r("total_charges")}
        else {_r("total_charges / count(*) over (partition by tracking_number)")} end
        as total_charges), l.rs_suborder_no
  from (select * from allocated_retail) a left join last_links l
    on a.combine_id = l.clean_id_sku_comb"""
CTES["last_links"] = """
  select clean_id_sku_comb, arg_max(suborder_no, row_no) as rs_suborder_no
  from reship_table where clean_id_sku_comb is not null group by 1"""


def _retail(text: str) -> str:
    """The same step over the retail lines only, since shares depend on the lines present."""
    for name in ["allocated", "nets", "shared", "totalled", "feed", "costed", "flowing"]:
        text = re.sub(rf"\bfrom {name}\b", f"from {name}_retail", text)
    return text


for _name in ["costed", "feed", "totalled", "shared", "nets", "allocated"]:
    CTES[_name + "_retail"] = _retail(CTES[_name])
CTES["flowing_retail"] = f"select * from flowing where {_is_segment('retail')}"
CTES["fixed_retail"] = _fixed("retail_split")
CTES["timed_retail"] = _sla(_parsed("fixed_retail"))


def _segment(kind: str) -> str:
    corporate = kind == "corporate"
    source = "flowing" if corporate else "unspoken"
    charge = _r("total_charges / count(*) over (partition by tracking_number)")
    charge = (
        "total_charges"
        if corporate
        else f"case when tracking_number is null then {_r('total_charges')} else {charge} end"
    )
    price = "coalesce(selling_price, 0)" if corporate else "selling_price"
    lines = f"""(select c.* replace ({charge} as total_charges, {price} as selling_price),
        {_num("k.unit_cost")} * coalesce(c.suborder_quantity, 0) as pd_cost,
        case when k.unit_cost is null then 'no_cost_avl' end as pd_cost_reason
      from (select * from {source} where {_is_segment(kind)}) c
        left join sku_costs k on nullif(trim(c.sku), '') = k.cost_sku)"""
    return _sla(f"(select * from {_parsed(lines)})")


CTES["unspoken"] = """
  select *, case when final_status not in ('Cancelled', 'Not Shipped') and total_charges is null
    then 'no_cost_avl' end as total_charges_reason from classified"""
_SEGMENT_VIEW = """suborder_no, order_number, sku, final_status, total_charges,
  total_charges_reason, pd_cost, pd_cost_reason, date_missing, o2s, s2d, s2nd, o2c"""
_KEPT = "not coalesce(contains(lower(suborder_no), 'cancel'), false)"
CTES["month_flow"] = f"""
  select * from timed_retail where {_KEPT}
    and order_date >= date '{star.FLOW_YEAR}-{star.FLOW_MONTH:02d}-01'
    and order_date < date '{star.FLOW_YEAR}-{star.FLOW_MONTH + 1:02d}-01'"""


def _segment_flow(kind: str, mark: str, more: tuple[str, ...] = ()) -> str:
    extra, nulls = "".join(f", {c}" for c in more), ", null" * len(more)
    return f"""
      with fresh as ({_segment(kind)}), stored as (
        select case when order_date < date '1996-01-01' then 'old-' else '' end || suborder_no
          as suborder_no, order_number, sku from cleaned where contains(order_number, '{mark}'))
      select {_SEGMENT_VIEW}{extra} from fresh where {_KEPT}
      union all
      select suborder_no, order_number, sku, 'Active', null, null, null, null, null, null, null,
        null, null{nulls} from stored
      where {_KEPT} and suborder_no not in (select suborder_no from fresh)"""


# The order comes from the rules of the documents, not from their text.
_ON_DAY = "strftime({}, '%d-%m-%Y')"


def _scan_result() -> str:
    has_pickup = f"not (o_orderstatus = 'O' and {M} = 12)"
    delivered = f"o_orderstatus = 'F' and {M} <> 8"
    returned = f"o_orderstatus = 'P' and {M} <= 6 and {M} <> 2"
    early = star._day("o_orderdate", 2)
    pickup = f"case when {M} <= 3 then {early} when {has_pickup} then {PICKUP} end"
    day = _ON_DAY.format
    return f"""
      select {AWB} as awb_num,
        case when o_orderpriority = '5-LOW' then 'Booked'
          when {delivered} then 'Delivered' when {returned} then 'RTO Delivered'
          when o_orderstatus = 'P' then 'RTO ReturnInitiated'
          when {M} <= 3 or {has_pickup} then 'PickupDone' else 'InTransit' end as status,
        case when o_orderpriority <> '5-LOW' then {day(pickup)} end as pickup_date,
        case when o_orderpriority <> '5-LOW' and {delivered} then {day(DELIVERY)} end
          as delivery_date,
        case when o_orderpriority <> '5-LOW' and o_orderstatus = 'P' then {day(RETURN)} end
          as rto_initiated_date,
        case when o_orderpriority <> '5-LOW' and {returned} then {day(RETURNED)} end
          as rto_delivered_date,
        case when o_orderpriority <> '5-LOW' and ({delivered} or {returned})
          then 'status_completed' else 'active' end as mapped_status,
        '{AS_OF_TEXT}' as updated_at
      from orders where not (o_orderpriority = '5-LOW' and o_orderstatus = 'P')"""


def _shipment_list_result() -> str:
    day = _ON_DAY.format
    back = f"(o_orderstatus = 'P' and {M} <= 9)"
    scanned = f"({M} <= 4 or {M} >= 7)"
    scan = star._day("o_orderdate", 14)
    return f"""
      select t.*, coalesce(c.b, 'no_mapping_avl') as mapped_status from (
        select {AWB} as awb_number,
          case when {back} then 'RTO SHIPMENT DELIVERED'
            when o_orderstatus = 'F' then 'SHIPMENT DELIVERED' else 'SHIPMENT ARRIVED' end
            as status,
          case o_orderstatus when 'P' then 'RT' when 'F' then 'DL' else 'UD' end as status_type,
          {day(PICKUP)} as pickup_date,
          case when {back} then (case when {scanned} then {day(scan)} end) else {day(RETURN)} end
            as last_status_date,
          case when o_orderstatus = 'F' then {day(RETURN)} end as delivery_date,
          case when o_orderstatus = 'P' then {day(RETURN)} end as rto_initiation_date,
          case when {back} and {M} <= 4 then {day(RETURNED)} end as rto_delivered_date,
          '{AS_OF_TEXT}' as updated_at
        from orders where {M} <> 12) t
      left join {_values(STATUS_C)} c(a, b) on t.status = c.a"""


def _package_result() -> str:
    day = _ON_DAY.format
    closed = f"(o_orderstatus = 'F' or (o_orderstatus = 'P' and {M} <= 6))"
    return f"""
      select {AWB} as awb_number,
        case o_orderstatus when 'F' then 'Delivered' when 'O' then 'In Transit' else 'RTO' end
          as status,
        case when {closed} then 'DL' else 'UD' end as status_type,
        case when not (o_orderstatus = 'O' and {M} = 12) then {day(PICKUP)} end as pickup_date,
        case when o_orderstatus = 'F' and {M} <> 8 then {day(DELIVERY)} end as delivery_date,
        case when o_orderstatus = 'P' then {day(RETURN)} end as rto_initiation_date,
        case when o_orderstatus = 'P' and {M} <= 6 and {M} <> 2 then {day(RETURNED)} end
          as rto_delivered_date,
        '{AS_OF_TEXT}' as updated_at,
        case when {closed} then 'status_completed' else 'active' end as mapped_status
      from orders"""


_SALES_VIEW = """suborder_no, order_date, order_number, sku, combine_id, combine_id_mp,
  suborder_quantity, selling_price, tracking_number, order_status, shipping_status, manifested_at,
  cancelled_at, shipping_status_new, cancelled_status, delivered, batch_id"""
_SALES_CHECK = """suborder_no, mp_name, order_date, order_number, nullif(trim(sku), '') as sku,
  suborder_quantity, selling_price, nullif(trim(tracking_number), '') as tracking_number,
  nullif(trim(shipping_status), '') as shipping_status,
  cast(manifested_at as timestamp) as manifested_at, batch_id"""
_EXPORT_DAYS = f"""
  case when not (o_orderstatus = 'O' and {M} = 12) then {_ON_DAY.format(PICKUP)} end"""

_RECENT = f"""order_date >= date '{star.RECENT_AS_OF}' - interval 30 day
  and order_date < date '{star.RECENT_AS_OF}'"""


def _recent_lines(carrier: str, column: str, mark: str) -> str:
    return f"""select '{carrier}' as carrier, cast(order_date as date) as order_date,
      replace(order_number, '`', '') as order_number, courier_name,
      replace(tracking_number, '`', '') as tracking_number, sku, order_status, shipping_status,
      {_r("coalesce(selling_price, 0)")} as selling_price,
      coalesce(suborder_quantity, 0) as suborder_quantity
      from sales where {column} = '{mark}' and {_RECENT}"""


_LATE = star.OUTBOX_AS_OF

QUERIES: dict[str, str] = {
    "prepare_sales_retail": f"select {_SALES_VIEW} from cleaned where {_is_segment('retail')}",
    "prepare_sales_corporate":
        f"select {_SALES_VIEW} from cleaned where {_is_segment('corporate')}",
    "prepare_sales_offline": f"select {_SALES_VIEW} from cleaned where lower(mp_name) = 'offline'",
    "prepare_sales_segments": " union all ".join(
        f"""select '{kind}' as segment, suborder_no, order_number,
          split_part(order_number, '_', 1) as clean_id,
          split_part(order_number, '_', 1) || '_' || sku as clean_id_sku_comb, delivered
        from cleaned where {_is_segment(kind)}"""
        for kind in _SEGMENTS
    ),
    "recent_carrier_lines": " union all ".join(
        [
            _recent_lines("air", "courier_name", "BLUEDART"),
            _recent_lines("marketplace", "courier_name", "ATS"),
            _recent_lines("packages", "courier_aggregator_name", "Delhivery"),
        ]
    ),
    "unify_shipments": "select * from ships",
    "clean_export_a": f"""
      select distinct e.status, 'Carrier A' as courier_company, {AWB} as awb_code,
        {_EXPORT_DAYS} as order_picked_up_date,
        case when o_orderstatus = 'F' and {M} <> 8 then {_ON_DAY.format(DELIVERY)} end
          as order_delivered_date,
        case when o_orderstatus = 'P' and {M} <= 6 and {M} <> 2
          then {_ON_DAY.format(RETURNED)} end as rto_delivered_date,
        '' as cod_remittance_date, coalesce(c.b, 'no_mapping_avl') as mapped_status,
        e.cod_charges, '20' as freight_total_amount, '{AS_OF_TEXT}' as updated_at
      from orders join export_a e on e.awb_code = {AWB}
        left join {_values(STATUS_A)} c(a, b) on e.status = c.a""",
    "clean_export_b": f"""
      select e.awb_no, e.status, coalesce(c.b, 'no_mapping_avl') as mapped_status,
        {_ON_DAY.format(PICKUP)} as status_ts, strftime(o_orderdate, '%d-%m-%Y') as order_date,
        {_EXPORT_DAYS} as actual_pickup_date,
        case when o_orderstatus = 'F' and {M} <> 8 then {_ON_DAY.format(DELIVERY)} end
          as delivery_date,
        case when o_orderstatus = 'P' and {M} <= 6 and {M} <> 2
          then {_ON_DAY.format(RETURNED)} end as rto_delivery_date,
        '{AS_OF_TEXT}' as updated_at
      from orders join export_b e on e.awb_no = {AWB}
        left join {_values(STATUS_B)} c(a, b) on e.status = c.a
      where e.status not in ('Z', 'ZFM', 'ZLM')""",
    "status_map_lookup": f"""
      select awb_number, status, coalesce(c.b, 'no_mapping_avl') as mapped_status
      from carrier_c left join {_values(STATUS_C)} c(a, b) on status = c.a""",
    "status_class_counts": f"""
      select status, coalesce(c.b, 'no_mapping_avl') as mapped_status, count(*) as n_rows
      from export_a left join {_values(STATUS_A)} c(a, b) on status = c.a group by 1, 2""",
    "dedupe_charges":
        "select distinct awb_code, cod_charges, freight_total_amount from export_a",
    "duplicate_key_check": """
      select cast(l_orderkey as string) as awb_code, count(*) as n_rows
      from (select distinct l_orderkey, l_quantity, l_linenumber from lineitem)
      group by 1 having count(*) > 1""",
    "classify_orders": """
      select suborder_no, order_number, tracking_number, awb_no, status, mapped_status,
        pickup_date, delivered_date, final_status from classified""",
    "status_summary": f"""
      select final_status, count(*) as n_lines, cast(sum(suborder_quantity) as bigint) as units,
        {_sum("coalesce(selling_price, 0)")} as value from classified group by 1""",
    "status_fallback": """
      select suborder_no, tracking_number, final_status, total_charges, total_charges_reason
      from flowing""",
    "status_fallback_segments": """
      select final_status, total_charges_reason, count(*) as n_lines from unspoken group by 1, 2""",
    "attach_cost": f"""
      select suborder_no, order_number, sku, suborder_quantity,
        {_num("unit_cost")} * suborder_quantity as pd_cost,
        case when unit_cost is null then 'no_cost_avl' end as pd_cost_reason, tax_rate
      from cleaned left join sku_costs on nullif(sku, '') = cost_sku""",
    "allocate_shipping_tax": """
      select suborder_no, order_number, sku, selling_price, tax_rate, order_fee, pd_taxable_value,
        pd_taxable_value_reason, pd_tax, pd_tax_reason, shipping_value, shipping_value_reason,
        shipping_tax, shipping_tax_reason from allocated""",
    "split_courier_charge": f"""
      select suborder_no, tracking_number,
        case when tracking_number is null then {_r("total_charges")}
          else {_r("total_charges / count(*) over (partition by tracking_number)")} end
          as total_charges, total_charges_reason from flowing""",
    "date_missing_flags": """
      select final_status, mapped_status, date_missing, count(*) as n_lines
      from timed group by 1, 2, 3""",
    "sla_metrics": """
      select suborder_no, final_status, date_missing, o2s, o2s_reason, o2ns, o2ns_reason, s2d,
        s2d_reason, s2nd, s2nd_reason, o2c, o2c_reason, o2d, o2d_reason from timed""",
    "last_wins_lookup": """
      select c.suborder_no, combine_id, rs_suborder_no
      from cleaned c left join last_links on combine_id = clean_id_sku_comb""",
    "apply_corrections": f"""
      select suborder_no, order_number, order_date, manifested_at, pickup_date, selling_price,
        final_status, total_charges, total_charges_reason, forced_closure_date
      from ({_fixed("flowing")})""",
    "unmatched_corrections": """
      select suborder_id, count(*) as n_corrections from corrections
      where suborder_id not in (select suborder_no from sales) group by 1""",
    "upsert_replace": """
      select * from history where awb_no is null
      union all
      select h.* from history h anti join asked_keys a on h.awb_no = a.awb_no
        where h.awb_no is not null
      union all select * from refresh""",
    "upsert_freeze_completed": "select * from upserted",
    "published_refresh": "select * from upserted",
    "history_refresh": "select * from upserted",
    "streamed_refresh": "select * from upserted",
    "tracking_worklist": """
      select awb_no from recent_keys
      union select awb_no from ships where mapped_status = 'active'""",
    "tracking_worklist_open": """
      select awb_no from recent_keys where awb_no not in (
        select awb_no from ships where mapped_status = 'status_completed')
      union select awb_no from ships where mapped_status = 'active'""",
    "worklist_counts": """
      select n_window, n_common, n_common_active, n_common_completed, n_new, n_overlap,
        n_common_active + n_new as n_final
      from (select count(*) as n_window, count(*) filter (s.awb_no is null
            or s.mapped_status not in ('active', 'status_completed')) as n_new
          from recent_keys r left join ships s on r.awb_no = s.awb_no),
        (select count(*) as n_common,
           count(*) filter (mapped_status = 'active') as n_common_active,
           count(distinct awb_no) filter (mapped_status = 'active') as n_overlap,
           count(*) filter (mapped_status = 'status_completed') as n_common_completed
         from ships where awb_no in (select awb_no from recent_keys))""",
    "request_batches": f"""
      select mode, chunk, count(*) as n_keys, string_agg(awb_no, ',' order by n) as awbs
      from (select *, (n - 1) // 50 as chunk from (
        select {_MODE} as mode, awb_no, row_number() over (partition by {_MODE}
          order by md5(awb_no), awb_no) as n
        from (select distinct awb_no from ships))) group by 1, 2""",
    "request_mode_counts": f"""
      select {_MODE} as mode, count(distinct awb_no) as n_keys from ships group by 1""",
    "scan_rollup": f"""
      select awb as awb_num, case when back then 'RTO ' else '' end || last as status,
        strftime(pickup, '%d-%m-%Y') as pickup_date,
        case when not back then strftime(arrived, '%d-%m-%Y') end as delivery_date,
        strftime(rto, '%d-%m-%Y') as rto_initiated_date,
        case when back then strftime(arrived, '%d-%m-%Y') end as rto_delivered_date,
        case when arrived is not null then 'status_completed' else 'active' end as mapped_status,
        '{star.EVENTS_AS_OF.strftime("%d-%m-%Y")}' as updated_at
      from (select awb, arg_max(status, time) as last, bool_or(status = 'ReturnInitiated') as back,
          min(time) filter (status = 'PickupDone') as pickup,
          min(time) filter (status = 'ReturnInitiated') as rto,
          max(time) filter (status = 'Delivered') as arrived from scans group by awb)""",
    "scan_history_json": _scan_result(),
    "flatten_shipment_lists": _shipment_list_result(),
    "flatten_packages": _package_result(),
    "dead_letters": f"""
      select {AWB} as awb from orders where o_orderpriority = '5-LOW' and o_orderstatus = 'P'
      union all select {AWB} from orders where {M} = 12""",
    "ledger_main": "select * exclude (shipping_state, warehouse) from main_entries",
    "ledger_reship": """
      select date, date_reason, order_id, suborder_no, sku, tagging, value, value_reason
      from reship_entries""",
    "ledger_cogs_only": """
      select date, order_id, suborder_no, sku, tagging, value, warehouse from cogs_entries""",
    "ledger_refunds": "select date, order_id, sku, tagging, value from refund_entries",
    "ledger_totals": f"""
      select tagging, count(*) as n_entries, {_sum("value")} as value,
        {_sum("product_tax")} as product_tax, count(date_reason) as n_without_date
      from all_entries group by 1""",
    "ledger_enriched": """
      select date, order_id, suborder_no, l.sku, tagging, value, category_name, plant, pot, color,
        units, weight_actual_in_gms
      from all_entries l left join category c on l.sku = c.sku""",
    "batch_enrich": "select * exclude (message) from batch_lines",
    "batch_shipped_summary": """
      select client_location, mp_name, week, new_wh_name, new_mp_name, batch_id, batch_id_reason,
        order_date, batch_date, count(*) as n_suborders, count(distinct order_number) as n_orders,
        cast(sum(suborder_quantity) as bigint) as units
      from batch_lines where tagging = 'Shipped' group by all""",
    "batch_pending": """
      select suborder_no, tagging, batch_id, batch_id_reason, batch_date, week, days_diff
      from batch_lines where tagging <> 'Shipped'""",
    "delayed_outbox": f"""
      select arg_min(shipping_customer_name, suborder_no) as cust_name,
        '+91' || right(trim(arg_min(mobile_no, suborder_no)), 10) as mob_no,
        order_number as order_no,
        coalesce(string_agg('🌱' || product_name, ', ' order by suborder_no, product_name), '')
          as product_list,
        'pending' as msg_status, '{_LATE.strftime("%d/%m/%Y")}' as msg_send_date
      from classified c left join products p on c.sku = p.sku
      where order_date = date '{_LATE}' - interval 3 day and manifested_at is null
        and final_status = 'Not Shipped'
      group by order_number""",
    "order_flow_month": f"""
      select suborder_no, rs_suborder_no, client_location, order_date, order_number, sku,
        marketplace_sku, combine_id, combine_id_mp, suborder_quantity, selling_price,
        courier_aggregator_name, courier_name, tracking_number, order_status, shipping_status,
        status, final_status, payment_mode, payment_transaction_id, manifested_at, cancelled_at,
        pickup_date, delivered_date, rto_initiation_date, rto_delivered_date,
        forced_closure_date, mapped_status, updated_at, total_charges, total_charges_reason,
        pd_cost, pd_cost_reason, date_missing, o2s, o2s_reason, o2ns, o2ns_reason, s2d,
        s2d_reason, s2nd, s2nd_reason, o2c, o2c_reason, o2d, o2d_reason, pd_taxable_value,
        pd_taxable_value_reason, pd_tax, pd_tax_reason, shipping_value, shipping_value_reason,
        shipping_tax, shipping_tax_reason, batch_id, shipping_state, shipping_zip_code, message
      from month_flow
      union all by name
      select suborder_no, cast(order_date as date) as order_date, 'Active' as final_status
      from sales where {_is_segment("retail")} and order_date >= date '{star.STORED_DAYS[0]}'
        and order_date < date '{star.STORED_DAYS[1]}' + interval 1 day
        and suborder_no not in (select suborder_no from month_flow)""",
    "outbox_counts": f"""
      select 'pending' as msg_status, count(*) as n_messages from (
        select distinct order_date, order_number from classified
        where order_date between date '{_LATE}' - interval 3 day and date '{_LATE}' - interval 2 day
          and manifested_at is null and final_status = 'Not Shipped' and order_number is not null)
      having count(*) > 0""",
    "segment_flow_reship": _segment_flow("reship", _SEGMENTS["reship"]),
    "segment_flow_replace": _segment_flow("replace", _SEGMENTS["replace"]),
    "segment_flow_missing": _segment_flow("missing", _SEGMENTS["missing"]),
    "segment_flow_corporate": _segment_flow("corporate", "_Corp", ("selling_price", "o2d", "o2ns")),
    "batch_refresh": """
      select suborder_no, tagging, batch_id, batch_id_reason, batch_date, week, days_diff
      from batch_lines
      union all by name
      select suborder_no, 'Stored' as tagging from (
        select case when length(sku) % 2 = 0 then 'old-' else '' end || suborder_no as suborder_no
        from sales where order_date < date '1996-01-01') h
      where suborder_no not in (select suborder_no from batch_lines)""",
    "csv_roundtrip": f"select {_SALES_CHECK} from sales",
    "zipped_csv": f"select {_SALES_CHECK} from sales",
    "text_table": """
      select suborder_no, mp_name, nullif(trim(sku), '') as sku,
        cast(suborder_quantity as varchar) as suborder_quantity, client_location from sales""",
    "run_log": f"""
      select distinct mp_name as script, '{star.AS_OF} 00:00:00' as updated_at from sales""",
    "month_partitions": """
      select suborder_no, order_date, sku, strftime(order_date, '%Y-%m') as order_month
      from cleaned where order_date >= date '1998-04-01' and order_date < date '1999-01-01'""",
    "export_sentinels": """
      select coalesce(total_charges_reason, 'value or blank') as shown, count(*) as n_lines
      from flowing group by 1""",
}


def _freeze(old: str, new: str, key: str, columns: str, distinct: str = "") -> str:
    """Upsert by EXISTS tests over two sources; the keys have no nulls here."""
    is_open = f"""select {key} from stored_rows where mapped_status <> 'status_completed'"""
    return f"""
      with fresh_rows as (select {columns} from ({new})),
        stored_rows as (select {columns} from {old})
      select {distinct} * from (
        select * from stored_rows where {key} not in (
          select {key} from fresh_rows where {key} in ({is_open}))
        union all
        select * from fresh_rows where {key} in ({is_open})
          or {key} not in (select {key} from stored_rows))"""


_C = """awb_number, status, status_type, pickup_date, last_status_date, delivery_date,
  rto_initiation_date, rto_delivered_date, updated_at, mapped_status"""
_D = """awb_num, status, pickup_date, delivery_date, rto_initiated_date, rto_delivered_date,
  mapped_status, updated_at"""
_E = """awb_number, status, status_type, pickup_date, delivery_date, rto_initiation_date,
  rto_delivered_date, updated_at, mapped_status"""
QUERIES.update(
    {
        "refresh_carrier_a": _freeze(
            "carrier_a",
            QUERIES["clean_export_a"],
            "awb_code",
            """status, courier_company, awb_code, order_picked_up_date, order_delivered_date,
              rto_delivered_date, cod_remittance_date, mapped_status, cod_charges,
              freight_total_amount, updated_at""",
            "distinct",
        ),
        "refresh_carrier_b": _freeze(
            "(select * from carrier_b where status not in ('Z', 'ZFM', 'ZLM'))",
            QUERIES["clean_export_b"],
            "awb_no",
            "awb_no, status, mapped_status, actual_pickup_date, delivery_date",
        ),
        "refresh_carrier_c": _freeze(
            "carrier_c", QUERIES["flatten_shipment_lists"], "awb_number", _C
        ),
        "refresh_carrier_d": _freeze("carrier_d", QUERIES["scan_history_json"], "awb_num", _D),
        "refresh_carrier_e": f"""
          with fresh_rows as (select {_E} from ({QUERIES["flatten_packages"]}))
          select {_E} from carrier_e
            where awb_number not in (select awb_number from fresh_rows)
          union all select * from fresh_rows""",
        "unanswered_keys": f"""
          select awb_no from ({QUERIES["tracking_worklist"]})
          where awb_no not in (select awb_num from ({QUERIES["scan_history_json"]}))""",
        "month_window": """
          select suborder_no, order_date from sales
          where order_date >= date '2001-07-01' and order_date < date '2001-07-31'""",
        "batch_window": f"""
          select suborder_no, order_date from sales
          where order_date >= date '{star.RECENT_AS_OF}' - interval 2 month - interval 28 day
            and order_date < date '{star.RECENT_AS_OF}' + interval 1 day""",
    }
)


_EXTRA_ENTRY = "contains(final_status, 'forced_closure')"
CTES["stored_flow"] = f"""
  select * from timed_retail where {_KEPT}
    and order_date >= date '{star.FLOW_YEAR}-{star.FLOW_MONTH - 1:02d}-01'
    and order_date < date '{star.FLOW_YEAR}-{star.FLOW_MONTH + 2:02d}-01'"""
# All months, each line with the corrections of its own month.
CTES["own_fixes"] = CTES["month_fixes"].replace("by suborder_id", "by cast(parent_order_month as int), suborder_id").replace(
    f" where cast(parent_order_month as int) = {star.FLOW_MONTH}", ""
)
CTES["every_fix"] = (
    CTES["fixes"]
    .replace("select suborder_id,", "select suborder_id, cast(parent_order_month as int) as fixed_month,")
    .replace("from month_fixes group by suborder_id", "from own_fixes group by 1, 2")
)
CTES["fixed_every"] = _fixed("retail_split").replace(
    "join fixes on suborder_no = suborder_id",
    "join every_fix on suborder_no = suborder_id and fixed_month = month(order_date)",
)
CTES["timed_every"] = _sla(_parsed("fixed_every"))
CTES["booked_fact"] = f"""
  select * replace (case when final_status = 'RTO' and order_status = 'Cancelled'
    and pickup_date is null then 'Cancelled' else final_status end as final_status)
  from timed_every where {_KEPT}"""
for _kind, _tag in [("reship", "rs_cogs"), ("replace", "rp_cogs"), ("missing", "ms_cogs")]:
    CTES[f"stored_{_kind}"] = f"""
      select *, suborder_quantity + 0.5 as {_tag} from ({_segment(_kind)}) where {_KEPT}"""
CTES["booked_entries"] = (
    CTES["main_entries"].replace("ledger_fact", "booked_fact")
    + " union all "
    + _entry("booked_fact", "final_status", _stored("forced_closure_date"), "selling_price", _EXTRA_ENTRY, True)
    + " union all "
    + CTES["reship_entries"].replace("reship_fact", "stored_reship")
    + " union all "
    + CTES["cogs_entries"].replace("replace_fact", "stored_replace").replace("missing_fact", "stored_missing")
    + " union all by name select * from refund_entries"
)
CTES["stored_statuses"] = """
  select suborder_no, final_status from stored_flow
  union all select suborder_no, final_status from stored_reship
  union all select suborder_no, final_status from stored_replace"""
CTES["stored_batched"] = CTES["batched"].replace("join statuses st", "join stored_statuses st")
CTES["stored_batch_lines"] = CTES["batch_lines"].replace("from batched", "from stored_batched")
_LIST_OK = "o_custkey % 17 <> 0 and o_custkey % 19 <> 0 and o_custkey % 23 <> 0"
_POLLS = ", ".join(f"(date '{day}')" for day in star.POLL_DAYS)
_LETTERS = f"""
  select cast(o_custkey as string) as awb, cast(null as int) as place,
    case when o_custkey % 17 = 0 then 'not_json' when o_custkey % 19 = 0 then 'empty' else 'no_data' end as reason
  from (select distinct o_custkey from orders) where not ({_LIST_OK})
  union all
  select cast(o_custkey as string), cast(place as int), 'no_key'
  from (select *, row_number() over (partition by o_custkey order by o_orderkey) - 1 as place from orders)
  where {_LIST_OK} and o_orderkey % 29 = 0"""
_SENT = f"""
  select case when o_orderstatus = 'F' then 'n_sent' when o_orderstatus = 'O' then 'n_not_sent' else 'n_pending' end as metric
  from ({QUERIES["delayed_outbox"]}) left join orders on order_no = 'K-' || cast(o_orderkey as string)"""


def _counted(script: str, rows: str, names: list[str]) -> str:
    listed = ", ".join(f"('{n}')" for n in names)
    return f"""
      select '{script}' as script, '{star.AS_OF} 00:00:00' as updated_at, m as metric,
        (select count(*) from ({rows}) where m in ('n_rows', metric)) as value
      from (values ('n_rows'), {listed}) t(m)"""


QUERIES.update(
    {
        "scan_state_refresh": QUERIES["scan_rollup"],
        "package_answers": f"""
          select {AWB} as awb_number,
            case o_orderstatus when 'F' then 'Delivered' when 'O' then 'In Transit' else 'RTO' end as status,
            case when {CLOSED} then 'DL' else 'UD' end as status_type,
            case when o_orderkey % 31 <> 0 and not (o_orderstatus = 'O' and {M} = 12)
              then {_ON_DAY.format(PICKUP)} end as pickup_date,
            case when o_orderstatus = 'F' and {M} <> 8 then {_ON_DAY.format(DELIVERY)} end as delivery_date,
            '{AS_OF_TEXT}' as updated_at,
            case when {CLOSED} then 'status_completed' else 'active' end as mapped_status,
            case when o_orderkey % 31 = 0 then 'pickup_date' else '' end as unreadable,
            case when o_orderkey % 3 = 0 then {M} end as zone
          from orders where {_LIST_OK} and o_orderkey % 29 <> 0""",
        "answer_dead_letters": _LETTERS,
        "streamed_worklist": f"""
          with polls as (select * from (values {_POLLS}) t(poll_day)), poll_lines as (
            select nullif(trim(replace(tracking_number, '`', '')), '') as awb_no, order_date from sales)
          select awb_no, poll_day from polls join poll_lines on order_date >= poll_day - interval 30 day and order_date < poll_day
            where awb_no is not null
          union
          select {AWB}, poll_day from polls join orders on o_orderdate + interval 1 day < poll_day
            and not ({CLOSED} and o_orderdate + interval 9 day < poll_day)""",
        "outbox_chunks": f"""
          select order_no, chunk, count(*) as n_products,
            string_agg('🌱' || product_name, ', ' order by n) as product_list
          from (select order_number as order_no, product_name, n, n // 2 as chunk from (
            select order_number, product_name, row_number() over (
              partition by order_number order by suborder_no, product_name) - 1 as n
            from classified c join products p on c.sku = p.sku
            where order_date = date '{_LATE}' - interval 3 day and manifested_at is null
              and final_status = 'Not Shipped' and product_name is not null and order_number is not null))
          group by 1, 2""",
        "run_counts": _counted("messages", _SENT, ["n_sent", "n_not_sent", "n_pending"])
        + " union all "
        + _counted(
            "tracking",
            f"select 'n_' || reason as metric from ({_LETTERS})",
            ["n_empty", "n_not_json", "n_no_data", "n_no_key"],
        ),
        "classify_stored": QUERIES["classify_orders"],
        "poll_round": _freeze(
            "carrier_e",
            f"""{_package_result()} where cast(substring({AWB}, 3) as bigint) % 7 <> 0 and {AWB} in (
              select awb_no from recent_keys
              union select awb_number from carrier_e where mapped_status = 'active')""",
            "awb_number",
            _E,
        ),
        "ledger_stored": "select * exclude (shipping_state, warehouse) from booked_entries",
        "batch_stored_flows": "select * exclude (message) from stored_batch_lines",
        "preview": "select least(10, count(*)) as n_shown, least(10, count(*)) as n_known from sales",
    }
)


def _with(text: str) -> str:
    """The query with the CTEs it needs, each after those it uses."""
    done: dict[str, str] = {}

    def need(body: str) -> None:
        for name, cte in CTES.items():
            if name not in done and re.search(rf"\b(from|join) {name}\b", body):
                need(cte)
                done[name] = cte

    need(text)
    ctes = ",\n".join(f"{n} as ({t})" for n, t in done.items())
    if not ctes:
        return text
    text = text.strip()
    if text.startswith("with "):
        return f"with {ctes},\n{text[5:]}"
    return f"with {ctes}\n{text}"


ORACLE: dict[str, str] = {name: _with(text) for name, text in QUERIES.items()}
