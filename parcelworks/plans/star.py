"""The given tables in the roles of the order business.

Each role is a query in the common subset of Spark SQL and ANSI SQL, written over
``{table}`` placeholders, so that a reference database can derive the very same
inputs. The rules only spread the values the operators branch on over all rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

AS_OF = dt.date(2001, 12, 31)
EVENTS_AS_OF = dt.date(2024, 2, 1)
HOUSE_BRAND = "Brand#2"
FLOW_YEAR, FLOW_MONTH = 1997, 5
STORED_DAYS = (dt.date(1997, 5, 10), dt.date(1997, 6, 9))
REFRESH_SINCE = "1998-07-01"
RECENT_AS_OF = dt.date(2001, 7, 31)
POLL_DAYS = [dt.date(2001, 5, 31), dt.date(2001, 6, 30), dt.date(2001, 7, 30)]
OUTBOX_AS_OF = dt.date(1997, 5, 28)
WAREHOUSES = {
    "AFRICA": "Warehouse South",
    "AMERICA": "Warehouse West",
    "ASIA": "Warehouse East",
    "EUROPE": "Warehouse's North",
}


def _day(column: str, plus: int) -> str:
    return f"cast(cast({column} as date) + interval '{plus}' day as date)"


def dmy(day: str) -> str:
    text = f"cast({day} as string)"
    return (
        f"(substring({text}, 9, 2) || '-' || substring({text}, 6, 2) || '-' || "
        f"substring({text}, 1, 4))"
    )


def _slashed(day: str) -> str:
    return f"replace({dmy(day)}, '-', '/')"


def thousands(number: str) -> str:
    """A whole number below a million as text with a thousands comma."""
    return (
        f"case when {number} >= 1000 then cast({number} // 1000 as string) || ',' || "
        f"lpad(cast({number} % 1000 as string), 3, '0') else cast({number} as string) end"
    ).replace(f"{number} // 1000", f"cast(floor({number} / 1000.0) as bigint)")


M = "month(o_orderdate)"
PICKUP, DELIVERY = _day("o_orderdate", 3), _day("o_orderdate", 9)
RETURN, RETURNED = _day("o_orderdate", 6), _day("o_orderdate", 15)

AWB = """(case o_orderpriority
      when '1-URGENT' then '71' when '2-HIGH' then '52'
      when '3-MEDIUM' then (case o_orderstatus when 'O' then '35' when 'F' then '34'
                                               else '36' end)
      when '4-NOT SPECIFIED' then 'SR' else 'BC' end || cast(o_orderkey as string))"""

CLOSED = f"(o_orderstatus = 'F' or (o_orderstatus = 'P' and {M} <= 6))"
CLASS = f"case when {CLOSED} then 'status_completed' else 'active' end"
_HAS_PICKUP = f"not (o_orderstatus = 'O' and {M} = 12)"
_HAS_DELIVERY = f"o_orderstatus = 'F' and {M} <> 8"
_HAS_RETURN = "o_orderstatus = 'P'"
_HAS_RETURNED = f"o_orderstatus = 'P' and {M} <= 6 and {M} <> 2"
_UNITS = "cast(floor(o_totalprice / 100) as bigint)"
_CHARGE = f"case when o_orderstatus = 'P' and {M} = 5 then '' else cast({_UNITS} as string) end"


def _if(test: str, value: str) -> str:
    return f"case when {test} then {value} else '' end"


_STATUS_A = f"""case
      when o_orderstatus = 'F' then (case when {M} <= 8 then 'DELIVERED' when {M} = 9
        then 'CANCELED' when {M} = 10 then 'DESTROYED' else 'UNTRACEABLE' end)
      when o_orderstatus = 'O' then (case when {M} <= 4 then 'IN TRANSIT' when {M} <= 8
        then 'OUT FOR DELIVERY' when {M} = 9 then 'LOST' when {M} = 10 then ''
        else 'HELD AT HUB' end)
      when {M} <= 6 then 'RTO DELIVERED' else 'RTO IN TRANSIT' end"""
_STATUS_B = f"""case
      when o_orderstatus = 'F' then (case when {M} <= 9 then 'Delivered' else 'Cancelled' end)
      when o_orderstatus = 'O' then (case when {M} <= 6 then 'In Transit' when {M} <= 8
        then 'Damaged' when {M} = 9 then 'Z' else 'Pickup Scheduled' end)
      when {M} <= 6 then 'RTO Delivered' else 'RTO In Transit' end"""
_STATUS_C = f"""case
      when o_orderstatus = 'F' then (case when {M} <= 8 then 'SHIPMENT DELIVERED'
        when {M} <= 10 then 'PICKUP CANCELLED BY CALL' else 'CONTACT CUSTOMER SERVICE' end)
      when o_orderstatus = 'O' then (case when {M} <= 6 then 'SHIPMENT ARRIVED' when {M} <= 9
        then 'PICKUP EMPLOYEE IS OUT TO P/U SHIPMENT' else '' end)
      when {M} <= 4 then 'DELIVERED BACK TO SHIPPER' when {M} <= 8
        then 'RTO SHIPMENT DELIVERED' when {M} <= 10 then 'RETURN TO SHIPPER'
      else 'RTO NETWORK ISSUES' end"""
_STATUS_D = f"""case
      when o_orderstatus = 'F' then (case when {M} <= 10 then 'Delivered'
        else 'PickupCancelled' end)
      when o_orderstatus = 'O' then (case when {M} <= 9 then 'InTransit'
        else 'Shipment lost' end)
      when {M} <= 6 then 'RTO Delivered' else 'RTO InTransit' end"""
_STATUS_E = "case o_orderstatus when 'F' then 'Delivered' when 'O' then 'In Transit' else 'RTO' end"

_MP_NAME = """case c_mktsegment
      when 'AUTOMOBILE' then 'Shopify' when 'BUILDING' then 'Offline' when 'FURNITURE' then 'B2B'
      when 'MACHINERY' then 'Amazon.in'
      else (case n_regionkey when 0 then 'Vendor Central Dropship'
        when 1 then 'Vendor Central Dropship 2' when 2 then 'Shopify13'
        when 3 then 'Myntra PPMP' else 'SHOPIFY' end) end"""
_ORDER_MARK = """case
      when c_mktsegment = 'BUILDING' then (case o_orderpriority when '1-URGENT' then '_RS'
        when '2-HIGH' then '_RP' when '3-MEDIUM' then '_MS' when '4-NOT SPECIFIED' then '_Corp'
        else '_SAMP' end)
      when c_mktsegment = 'FURNITURE' then (case o_orderpriority when '4-NOT SPECIFIED'
        then '_CORP' when '5-LOW' then '_Samp' else '' end)
      else '' end"""
_SKU = "case when p_size = 50 then '' else 'SKU-' || cast(p_partkey as string) end"
_SUBORDER = """(cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' ||
      cast(l_partkey as string) || '-' || cast(l_suppkey as string) ||
      case when l_returnflag = 'R' and l_quantity = 50 then '-Cancelled' else '' end)"""
_ORDER_STATUS = """case
      when l_returnflag = 'N' and l_linestatus = 'O' and o_orderstatus = 'P' then 'Pending'
      when l_returnflag = 'N' and l_linestatus = 'F' and o_orderstatus = 'O' then 'Cancelled'
      when l_returnflag = 'R' and l_linestatus = 'O' and o_orderstatus = 'F' then 'CANCELLED'
      when o_orderstatus = 'F' then 'Shipped' else 'Ready to dispatch' end"""

_LINE_COLUMNS = f"""l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
        l_returnflag, l_linestatus, l_shipdate, o_orderkey, o_custkey, o_orderstatus,
        o_totalprice, o_orderdate, o_orderpriority, c_name, c_mktsegment, n_name, n_regionkey,
        r_name, p_partkey, p_brand, p_size, p_type, {_SKU} as sku, {_SUBORDER} as suborder_no"""

ROLES: dict[str, str] = {
    "lines": f"""
      select {_LINE_COLUMNS}
      from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
        join {{customer}} on o_custkey = c_custkey
        join {{nation}} on c_nationkey = n_nationkey
        join {{region}} on n_regionkey = r_regionkey
        join {{part}} on l_partkey = p_partkey""",
    "sales": f"""
      select suborder_no, {_MP_NAME} as mp_name, p_brand as brand, r_name as client_location,
        o_orderdate as order_date,
        '`K-' || cast(o_orderkey as string) || {_ORDER_MARK} as order_number, sku,
        case when p_type <> 'PROMO' then p_brand || '-' || cast(p_partkey as string) end
          as marketplace_sku,
        cast(l_quantity as int) as suborder_quantity,
        case when not (p_type = 'SMALL' and l_returnflag = 'N') then l_extendedprice end
          as selling_price,
        case when o_orderpriority = '3-MEDIUM' then 'Delhivery' else 'Other' end
          as courier_aggregator_name,
        case o_orderpriority when '1-URGENT' then 'ATS' when '2-HIGH' then 'BLUEDART'
          else 'Surface' end as courier_name,
        case when l_returnflag = 'N' and l_linestatus = 'O' then cast(null as string)
          when l_returnflag = 'N' and l_linenumber = 1 then ''
          when l_linenumber = 7 then {AWB} || 'X' else '`' || {AWB} end as tracking_number,
        {_ORDER_STATUS} as order_status,
        case when l_returnflag = 'N' and l_linestatus = 'O' then cast(null as string)
          when l_returnflag = 'N' then (case when o_orderstatus = 'O' then 'Cancelled'
            when l_linenumber = 1 then '' else 'Shipment Created' end)
          when l_returnflag = 'R' and l_linestatus = 'F' then 'Delivered To Origin'
          when l_returnflag = 'R' then 'RTO In-Transit'
          when l_linestatus = 'F' then 'Delivered' else 'In Transit' end as shipping_status,
        case when l_linestatus = 'O' then 'COD' else 'Prepaid' end as payment_mode,
        cast(null as string) as payment_transaction_id,
        case when not (l_returnflag = 'N' and l_linestatus = 'O') and l_linenumber <> 2
          then {_day("o_orderdate", 1)} end as manifested_at,
        case when {_ORDER_STATUS} in ('Cancelled', 'CANCELLED') and l_linenumber <> 3
          then {_day("o_orderdate", 2)} end as cancelled_at,
        l_shipdate as delivered_at,
        case when o_orderstatus <> 'P' then cast(o_custkey as string)
          when o_orderpriority = '1-URGENT' then 'MANUAL' end as batch_id,
        n_name as shipping_state, r_name as shipping_city, n_name as shipping_zip_code,
        cast(null as string) as message, c_name as shipping_customer_name,
        ' 0' || lpad(cast(o_custkey as string), 10, '9') as mobile_no
      from {{lines}}""",
    "carrier_a": f"""
      select {_STATUS_A} as status, 'Carrier A' as courier_company, {AWB} as awb_code,
        {_if(_HAS_PICKUP, dmy(PICKUP))} as order_picked_up_date,
        {_if(_HAS_DELIVERY, dmy(DELIVERY))} as order_delivered_date,
        {_if(_HAS_RETURNED, dmy(RETURNED))} as rto_delivered_date,
        '' as cod_remittance_date, {CLASS} as mapped_status,
        {thousands(_UNITS)} as cod_charges,
        {thousands("cast(floor(o_totalprice / 200) as bigint)")} as freight_total_amount,
        '31-12-2001' as updated_at
      from {{orders}} where o_orderpriority = '4-NOT SPECIFIED'""",
    "carrier_b": f"""
      select cast(o_orderkey as string) as order_no, '' as delivery_name, '' as delivery_no,
        cast({_UNITS} as string) as invoice_amount, '1' as item_count, 'Carrier B' as gr_provider,
        {AWB} as awb_no, {_STATUS_B} as status, {CLASS} as mapped_status,
        {dmy(PICKUP)} as status_ts, {dmy("cast(o_orderdate as date)")} as order_date,
        cast({_UNITS} as string) as cod_charges, '' as cod_payout_amount,
        '35.5' as shipping_charges, '0' as rto_cod_charges,
        {_if(_HAS_RETURN, "'12.25'").replace("else ''", "else '0'")} as rto_charges,
        {_if(_HAS_PICKUP, dmy(PICKUP))} as actual_pickup_date,
        {_if(_HAS_DELIVERY, dmy(DELIVERY))} as delivery_date,
        {_if(_HAS_RETURNED, dmy(RETURNED))} as rto_delivery_date, '31-12-2001' as updated_at
      from {{orders}} where o_orderpriority = '5-LOW'""",
    "carrier_c": f"""
      select {AWB} as awb_number, {_STATUS_C} as status, 'UD' as status_type,
        {_if(_HAS_PICKUP, dmy(PICKUP))} as pickup_date, {dmy(PICKUP)} as last_status_date,
        {_if(_HAS_DELIVERY, dmy(DELIVERY))} as delivery_date,
        {_if(_HAS_RETURN, dmy(RETURN))} as rto_initiation_date,
        {_if(_HAS_RETURNED, dmy(RETURNED))} as rto_delivered_date, '31-12-2001' as updated_at,
        {CLASS} as mapped_status, {_CHARGE} as total_charges
      from {{orders}} where o_orderpriority = '2-HIGH'""",
    "carrier_d": f"""
      select {AWB} as awb_num, {_STATUS_D} as status,
        {_if(_HAS_PICKUP, dmy(PICKUP))} as pickup_date,
        {_if(_HAS_DELIVERY, dmy(DELIVERY))} as delivery_date,
        {_if(_HAS_RETURN, dmy(RETURN))} as rto_initiated_date,
        {_if(_HAS_RETURNED, dmy(RETURNED))} as rto_delivered_date,
        {CLASS} as mapped_status, '31-12-2001' as updated_at, {_CHARGE} as total_charges
      from {{orders}} where o_orderpriority = '1-URGENT'""",
    "carrier_e": f"""
      select {AWB} as awb_number, {_STATUS_E} as status,
        case when {CLOSED} then 'DL' when o_orderstatus = 'P' then 'RT' else 'UD' end
          as status_type,
        {_if(_HAS_PICKUP, dmy(PICKUP))} as pickup_date,
        {_if(_HAS_DELIVERY, dmy(DELIVERY))} as delivery_date,
        {_if(_HAS_RETURN, dmy(RETURN))} as rto_initiation_date,
        {_if(_HAS_RETURNED, dmy(RETURNED))} as rto_delivered_date,
        '31-12-2001' as updated_at, {CLASS} as mapped_status, {_CHARGE} as total_charges
      from {{orders}} where o_orderpriority = '3-MEDIUM'""",
    "export_a": f"""
      select {_STATUS_A} as status, 'Carrier A' as courier_company, {AWB} as awb_code,
        {_if(_HAS_PICKUP, dmy(PICKUP))} as order_picked_up_date,
        {_if(_HAS_DELIVERY, "cast(" + DELIVERY + " as string) || ' 10:15:00'")}
          as order_delivered_date,
        {_if(_HAS_RETURNED, _slashed(RETURNED))} as rto_delivered_date,
        '' as cod_remittance_date, {thousands(_UNITS)} as cod_charges, '20' as freight_total_amount
      from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
    "export_b": f"""
      select cast(o_orderkey as string) as order_no, '' as delivery_name, '' as delivery_no,
        cast({_UNITS} as string) as invoice_amount, '1' as item_count, 'Carrier B' as gr_provider,
        {AWB} as awb_no, {_STATUS_B} as status,
        cast({PICKUP} as string) || ' 08:30:00' as status_ts,
        cast(cast(o_orderdate as date) as string) as order_date,
        cast({_UNITS} as string) as cod_charges, '' as cod_payout_amount,
        '35.5' as shipping_charges, '0' as rto_cod_charges, '0' as rto_charges,
        {_if(_HAS_PICKUP, f"substring(cast({PICKUP} as string), 6, 2) || '/' || "
             f"substring(cast({PICKUP} as string), 9, 2) || '/' || "
             f"substring(cast({PICKUP} as string), 1, 4)")} as actual_pickup_date,
        {_if(_HAS_DELIVERY, f"substring(cast({DELIVERY} as string), 6, 2) || '-' || "
             f"substring(cast({DELIVERY} as string), 9, 2) || '-' || "
             f"substring(cast({DELIVERY} as string), 1, 4) || ' 17:05'")} as delivery_date,
        {_if(_HAS_RETURNED, "cast(" + RETURNED + " as string)")} as rto_delivery_date
      from {{orders}}""",
    "bundle_costs": f"""
      select 'SKU-' || cast(p_partkey as string) as sku,
        {thousands("cast(floor(p_retailprice) as bigint)")} as total_b2c_cost_with_tax,
        case when p_type = 'MEDIUM' then '' when p_size <= 20 then '0.05'
          when p_size <= 35 then '0.12' else '0.18' end as tax_rate,
        case when p_size <= 40 then 'cost_avl' else 'cost_pending' end as b2c_other
      from {{part}} where p_type in ('PROMO', 'LARGE') or p_size = 7""",
    "single_costs": f"""
      select case when p_size = 50 then '' else 'SKU-' || cast(p_partkey as string) end as sku,
        {thousands("cast(floor(p_retailprice / 2) as bigint)")} as total_b2c_cost_with_tax,
        case when p_type = 'MEDIUM' then '' when p_size <= 20 then '0.05'
          when p_size <= 35 then '0.12' else '0.18' end as tax_rate,
        case when p_size <= 45 then 'all_completed' else 'pending' end as tagging
      from {{part}} where p_type not in ('PROMO', 'LARGE')""",
    "fees": f"""
      select 'K-' || cast(o_orderkey as string) as order_id,
        case when o_orderstatus = 'P' and {M} = 3 then ''
          else cast(cast(floor(o_totalprice / 1000) as bigint) as string) || '.25' end as shipping
      from {{orders}} where {M} <> 11""",
    "corrections": f"""
      select cast({M} as string) as parent_order_month, {_SUBORDER} as suborder_id,
        'final_status' as column_name, 'forced_closure_lost' as change_value_to,
        l_orderkey * 10 + 3 as row_no
      from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey where l_quantity in (13, 21, 34)
      union all
      select cast({M} as string), {_SUBORDER}, 'pickup_date', {dmy(_day("o_orderdate", 4))},
        l_orderkey * 10 + l_linenumber
      from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey where l_quantity = 13
      union all
      select cast({M} as string), {_SUBORDER}, 'final_status', 'Delivered', l_orderkey * 10 + 8
      from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey where l_quantity = 13 and l_linestatus = 'F'
      union all
      select cast({M} as string), {_SUBORDER}, 'Selling Price', '1,099.5', l_orderkey * 10 + 1
      from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey where l_quantity = 14
      union all
      select cast({M} as string), {_SUBORDER}, 'total_charges', 'no_cost_avl', l_orderkey * 10 + 2
      from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey where l_quantity = 14 and l_returnflag = 'A'
      union all
      select cast({M} as string), 'X' || {_SUBORDER}, 'final_status', 'RTO', l_orderkey * 10 + 1
      from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey where l_quantity = 15""",
    "reship_table": f"""
      select 'K-' || cast(l_orderkey as string) || '_' || {_SKU} as clean_id_sku_comb,
        'RS-' || {_SUBORDER} as suborder_no, l_suppkey * 10 + l_linenumber as row_no
      from {{lineitem}} join {{part}} on l_partkey = p_partkey where l_returnflag = 'R'""",
    "refunds": f"""
      select cast(o_orderdate as date) as date, cast(o_orderkey as string) as order_id, {_SKU} as sku,
        case when l_linenumber = 1 then '' when l_linenumber = 2 then '0'
          else {thousands("cast(floor(l_extendedprice) as bigint)")} end as amount,
        case when l_linestatus = 'F' then 'Damaged Plant' when o_orderpriority = '1-URGENT'
          then 'Other' else 'Damaged Replacement' end as refund_reason,
        case when o_orderstatus = 'O' then 'No' else 'Yes' end as approval
      from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
        join {{part}} on l_partkey = p_partkey
      where l_returnflag = 'R'""",
    "category": """
      select 'SKU-' || cast(p_partkey as string) as sku, p_type as category_name, p_name as plant,
        p_brand as pot, split_part(p_name, ' ', 1) as color, p_size as units,
        p_size * 10 as weight_actual_in_gms
      from {part} where p_size <> 33""",
    "products": """
      select 'SKU-' || cast(p_partkey as string) as sku,
        case when p_size <> 49 then p_name end as product_name
      from {part}""",
    # History and refresh of one key per order: some keys only in one, some in both.
    "history": f"""
      select {AWB} as awb_no, 'old' as status, {CLASS} as mapped_status, o_totalprice as amount
      from {{orders}} where o_orderdate < timestamp '1999-07-01 00:00:00'
      union all
      select {AWB}, 'older', 'active', o_totalprice
      from {{orders}} where o_orderdate < timestamp '1996-01-01 00:00:00'
        and o_orderpriority = '1-URGENT'
      union all
      select cast(null as string), 'old', 'active', o_totalprice
      from {{orders}} where o_orderdate < timestamp '1995-02-01 00:00:00'""",
    "refresh": f"""
      select {AWB} as awb_no, 'new' as status, 'status_completed' as mapped_status,
        l_extendedprice as amount
      from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
      where o_orderdate >= timestamp '{REFRESH_SINCE} 00:00:00' and l_returnflag = 'R'
      union all
      select cast(null as string), 'new', 'active', o_totalprice
      from {{orders}} where o_orderdate >= timestamp '2001-07-01 00:00:00'""",
    "scans": """
      select cast(user_id as string) || '/' || cast(cast(ts as date) as string) as awb,
        case event_type when 'signup' then 'PickupDone' when 'error' then 'ReturnInitiated'
          when 'purchase' then 'Delivered' when 'click' then 'OutForDelivery'
          else 'InTransit' end as status, ts as time, event_id
      from {events}""",
}

# Roles only the Spark side builds: answers as JSON text, out of one row each.
DOCUMENTS: dict[str, str] = {
    "scan_documents": f"""
      select {AWB} as awb, case
        when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then '{{{{"data": []}}}}'
        else to_json(named_struct('data', array(named_struct(
          'awbNumber', {AWB}, 'orderStatus', 'Booked',
          'shippingHistory', case when o_orderpriority = '5-LOW' then '' else to_json(
            filter(array(
              named_struct('status', 'InTransit', 'time', cast({_day("o_orderdate", 5)} as string)),
              case when {_HAS_PICKUP} then named_struct('status', 'PickupDone',
                'time', cast({PICKUP} as string)) end,
              case when {M} <= 3 then named_struct('status', 'PickupDone',
                'time', cast({_day("o_orderdate", 2)} as string)) end,
              case when {_HAS_RETURN} then named_struct('status', 'ReturnInitiated',
                'time', cast({RETURN} as string)) end,
              case when {_HAS_DELIVERY} then named_struct('status', 'Delivered',
                'time', cast({DELIVERY} as string)) end,
              case when {_HAS_RETURNED} then named_struct('status', 'Delivered',
                'time', cast({RETURNED} as string)) end
            ), s -> s is not null)) end)))) end as body
      from {{orders}}""",
    "shipment_documents": f"""
      select {AWB} as awb, case
        when {M} = 12 then '{{{{"error": "unknown"}}}}'
        else to_json(named_struct('ShipmentData', named_struct('Shipment', filter(array(
          named_struct(
            'StatusType', case o_orderstatus when 'P' then 'RT' when 'F' then 'DL' else 'UD' end,
            'StatusDate', cast({RETURN} as string), 'PickUpDate', cast({PICKUP} as string),
            'WaybillNo', {AWB},
            'Status', case o_orderstatus when 'F' then 'SHIPMENT DELIVERED'
              else 'SHIPMENT ARRIVED' end,
            'Scans', cast(array() as array<struct<ScanDetail: struct<ScanDate: string>>>)),
          case when o_orderstatus = 'P' and {M} <= 9 then named_struct(
            'StatusType', case when {M} <= 6 then 'DL' else 'UD' end,
            'StatusDate', cast({RETURNED} as string), 'PickUpDate', cast(null as string),
            'WaybillNo', cast(null as string), 'Status', 'SHIPMENT DELIVERED',
            'Scans', case when {M} <= 4 or {M} >= 7 then array(named_struct('ScanDetail',
              named_struct('ScanDate', cast({_day("o_orderdate", 14)} as string)))) end) end
        ), s -> s is not null)))) end as body
      from {{orders}}""",
    "package_documents": f"""
      select {AWB} as awb, to_json(named_struct('ShipmentData', array(named_struct('Shipment',
        named_struct('AWB', {AWB},
          'Status', named_struct('Status', {_STATUS_E},
            'StatusType', case when {CLOSED} then 'DL' else 'UD' end),
          'PickedupDate', case when {_HAS_PICKUP} then cast({PICKUP} as string) || 'T09:00:00' end,
          'DeliveryDate', case when {_HAS_DELIVERY} then cast({DELIVERY} as string) end,
          'RTOStartedDate', case when {_HAS_RETURN} then cast({RETURN} as string) end,
          'ReturnedDate', case when {_HAS_RETURNED} then cast({RETURNED} as string) end))))) as body
      from {{orders}}""",
}
DOCUMENTS["package_lists"] = f"""
      select awb, case when n % 17 = 0 then left(body, length(body) - 7) when n % 19 = 0 then ' '
          when n % 23 = 0 then '{{{{"error": "unknown"}}}}' else body end as body
      from (
        select cast(o_custkey as string) as awb, o_custkey as n, to_json(named_struct('ShipmentData',
          transform(array_sort(collect_list(struct(o_orderkey, named_struct(
            'AWB', case when o_orderkey % 29 <> 0 then {AWB} end,
            'Status', named_struct('Status', {_STATUS_E},
              'StatusType', case when {CLOSED} then 'DL' else 'UD' end),
            'PickedupDate', case when o_orderkey % 31 = 0 then 'soon'
              when {_HAS_PICKUP} then cast({PICKUP} as string) || 'T09:00:00' end,
            'DeliveryDate', case when {_HAS_DELIVERY} then cast({DELIVERY} as string) end,
            'Extra', case when o_orderkey % 3 = 0 then named_struct('Zone', {M}) end) as p))),
            x -> named_struct('Shipment', x.p)))) as body
        from {{orders}} group by o_custkey)"""
# The same rows by joins in another order: what hangs on an order joins the orders, what hangs on
# a part the bare lines, so that the many lines are shuffled twice at most, and once while narrow.
SPARK_ROLES: dict[str, str] = {
    "lines": f"""
      select {_LINE_COLUMNS}
      from ({{lineitem}} join {{part}} on l_partkey = p_partkey)
        join ({{orders}} join {{customer}} on o_custkey = c_custkey
          join {{nation}} on c_nationkey = n_nationkey
          join {{region}} on n_regionkey = r_regionkey)
        on l_orderkey = o_orderkey""",
    # The cells are made once per order, below the join that repeats them for its lines.
    "export_a": "select status, courier_company, awb_code, order_picked_up_date, order_delivered_date, "
    "rto_delivered_date, cod_remittance_date, cod_charges, freight_total_amount from {lineitem} join ("
    + ROLES["export_a"].replace("from {lineitem} join {orders} on l_orderkey = o_orderkey", ", o_orderkey from {orders}")
    + ") on l_orderkey = o_orderkey",
}
BASE_TABLES = ["lineitem", "orders", "customer", "nation", "region", "part", "events"]


# Schemas of the folders seen so far, so that a session reads each footer once.
_SCHEMAS: dict[str, StructType] = {}


class Star:
    """The roles over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            path = f"{self.folder}/{name}.parquet"
            if path not in _SCHEMAS:
                _SCHEMAS[path] = self.spark.read.parquet(path).schema
            self._tables[name] = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        return self._tables[name]

    def role(self, name: str) -> DataFrame:
        text = {**ROLES, **DOCUMENTS, **SPARK_ROLES}[name]
        used = {
            n: self.role(n) if n in ROLES else self.table(n)
            for n in [*ROLES, *BASE_TABLES]
            if "{" + n + "}" in text
        }
        return self.spark.sql(text, **used)
