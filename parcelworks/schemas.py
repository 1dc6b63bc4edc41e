"""Names and types of the tables that enter and leave.

Inside, columns have plain snake-case names; files and sheets keep their headers.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Headers of the sales export.
SALES_HEADERS = {
    "Suborder No": "suborder_no",
    "MP Name": "mp_name",
    "Brand": "brand",
    "Client Location": "client_location",
    "Order Date": "order_date",
    "Order Number": "order_number",
    "SKU": "sku",
    "Marketplace Sku": "marketplace_sku",
    "Suborder Quantity": "suborder_quantity",
    "Selling Price": "selling_price",
    "Courier Aggregator Name": "courier_aggregator_name",
    "Courier Name": "courier_name",
    "Tracking Number": "tracking_number",
    "Order Status": "order_status",
    "Shipping Status": "shipping_status",
    "Payment Mode": "payment_mode",
    "Payment Transaction ID": "payment_transaction_id",
    "Manifested At": "manifested_at",
    "Cancelled At": "cancelled_at",
    "Delivered At": "delivered_at",
    "Batch ID": "batch_id",
    "Shipping State": "shipping_state",
    "Shipping City": "shipping_city",
    "Shipping Zip Code": "shipping_zip_code",
    "Message": "message",
    "Shipping Customer Name": "shipping_customer_name",
    "Mobile No": "mobile_no",
}

SALES_TIMES = ["order_date", "manifested_at", "cancelled_at", "delivered_at"]

# Headers of the other tables.
CARRIER_A_HEADERS = {
    "Status": "status",
    "Courier Company": "courier_company",
    "AWB Code": "awb_code",
    "Order Picked Up Date": "order_picked_up_date",
    "Order Delivered Date": "order_delivered_date",
    "RTO Delivered Date": "rto_delivered_date",
    "COD Remittance Date": "cod_remittance_date",
    "mapped_status": "mapped_status",
    "COD Charges": "cod_charges",
    "Freight Total Amount": "freight_total_amount",
    "updated_at": "updated_at",
}
CARRIER_B_HEADERS = {
    "Order No": "order_no",
    "Delivery Name": "delivery_name",
    "Delivery No": "delivery_no",
    "Invoice Amount": "invoice_amount",
    "Item Count": "item_count",
    "Gr Provider": "gr_provider",
    "Awb No": "awb_no",
    "Status": "status",
    "mapped_status": "mapped_status",
    "Status Ts": "status_ts",
    "Order Date": "order_date",
    "Cod Charges": "cod_charges",
    "Cod Payout Amount": "cod_payout_amount",
    "Shipping Charges": "shipping_charges",
    "Rto Cod Charges": "rto_cod_charges",
    "Rto Charges": "rto_charges",
    "Actual Pickup Date": "actual_pickup_date",
    "Delivery Date": "delivery_date",
    "Rto Delivery Date": "rto_delivery_date",
    "updated_at": "updated_at",
}
CARRIER_C_HEADERS = {
    "AWB Number": "awb_number",
    "Status": "status",
    "Status Type": "status_type",
    "Pickup Date": "pickup_date",
    "Last Status Date": "last_status_date",
    "Delivery Date": "delivery_date",
    "RTO Initiation Date": "rto_initiation_date",
    "RTO Delivered Date": "rto_delivered_date",
    "Updated at": "updated_at",
    "mapped_status": "mapped_status",
    "total_charges": "total_charges",
}
COST_HEADERS = {
    "sku": "sku",
    "TOTAL_B2C_COST_WITH_TAX": "total_b2c_cost_with_tax",
    "tax_rate": "tax_rate",
    "b2c_other": "b2c_other",
    "tagging": "tagging",
}
FEE_HEADERS = {"Order ID": "order_id", "Shipping": "shipping"}
CORRECTION_HEADERS = {
    "PARENT_ORDER_MONTH": "parent_order_month",
    "SUBORDER_ID": "suborder_id",
    "COLUMN_NAME": "column_name",
    "CHANGE_VALUE_TO": "change_value_to",
}
REFUND_HEADERS = {
    "Date": "date",
    "ORDER ID": "order_id",
    "SKU NO. AS PER SHOPIFY": "sku",
    "Amount": "amount",
    "REFUND REASON": "refund_reason",
    "APRROVAL": "approval",
}
CATEGORY_HEADERS = {
    "sku": "sku",
    "category_name": "category_name",
    "Plant": "plant",
    "Pot": "pot",
    "Color": "color",
    "units (units_cx_will_receive)": "units",
    "weight_actual_in_gms": "weight_actual_in_gms",
}
LEDGER_HEADERS = {
    "Date": "date",
    "Order ID": "order_id",
    "Suborder No": "suborder_no",
    "SKU": "sku",
    "Tagging": "tagging",
    "Value": "value",
    "Product Taxable Value": "product_taxable_value",
    "Product Tax": "product_tax",
    "Shipping Value": "shipping_value",
    "Shipping Tax": "shipping_tax",
    "Shipping State": "shipping_state",
    "Warehouse": "warehouse",
}
BATCH_HEADERS = {
    "Client Location": "client_location",
    "MP Name": "mp_name",
    "Tagging": "tagging",
    "Week": "week",
    "days_diff": "days_diff",
    "NEW_WH_NAME": "new_wh_name",
    "NEW_MP_NAME": "new_mp_name",
    "Batch ID": "batch_id",
    "Batch Date": "batch_date",
    "Order Date": "order_date",
    "Order Number": "order_number",
    "Suborder No": "suborder_no",
    "Suborder Quantity": "suborder_quantity",
}

# Headers of the order flow that differ from its column names.
HEADERS = {
    **SALES_HEADERS,
    "O2S": "o2s",
    "O2NS": "o2ns",
    "S2D": "s2d",
    "S2ND": "s2nd",
    "O2C": "o2c",
    "O2D": "o2d",
}

# Columns of the order flow, in export order; the contacts are held apart.
FLOW_COLUMNS = [
    "suborder_no", "rs_suborder_no", "client_location", "order_date", "order_number", "sku",
    "marketplace_sku", "combine_id", "combine_id_mp", "suborder_quantity", "selling_price",
    "courier_aggregator_name", "courier_name", "tracking_number", "order_status",
    "shipping_status", "status", "final_status", "payment_mode", "payment_transaction_id",
    "manifested_at", "cancelled_at", "pickup_date", "delivered_date", "rto_initiation_date",
    "rto_delivered_date", "forced_closure_date", "mapped_status", "updated_at", "total_charges",
    "pd_cost", "date_missing", "o2s", "o2ns", "s2d", "s2nd", "o2c", "o2d", "pd_taxable_value",
    "pd_tax", "shipping_value", "shipping_tax", "batch_id", "shipping_state",
    "shipping_zip_code", "message",
]
CONTACT_COLUMNS = ["shipping_customer_name", "mobile_no"]
CORPORATE_COLUMNS = [
    c
    for c in FLOW_COLUMNS
    if c
    not in {
        "rs_suborder_no", "forced_closure_date", "pd_taxable_value", "pd_tax", "shipping_value",
        "shipping_tax", "batch_id", "shipping_state", "shipping_zip_code", "message",
    }
]

SCAN_DOCUMENT = "data array<struct<awbNumber:string,orderStatus:string,shippingHistory:string>>"
SCAN_HISTORY = "array<struct<status:string,time:string>>"
SHIPMENT_LIST = (
    "ShipmentData struct<Shipment:array<struct<StatusType:string,StatusDate:string,"
    "PickUpDate:string,WaybillNo:string,Status:string,"
    "Scans:array<struct<ScanDetail:struct<ScanDate:string>>>>>>"
)
PACKAGE_LIST = (
    "ShipmentData array<struct<Shipment:struct<AWB:string,"
    "Status:struct<Status:string,StatusType:string>,PickedupDate:string,DeliveryDate:string,"
    "RTOStartedDate:string,ReturnedDate:string>>>"
)


def text_schema(headers: dict[str, str] | list[str]) -> T.StructType:
    """Every cell as text, as sheets deliver them."""
    return T.StructType([T.StructField(h, T.StringType()) for h in headers])
