"""Declared schemas. Raw files are read with these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
AMOUNT = T.DecimalType(18, 2)


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BOOLEAN": T.BooleanType(),
    "MONEY": MONEY,
}


def _struct(spec: str) -> T.StructType:
    fields = (field.split() for field in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


SALES_RAW = _struct(
    "transaction_id STRING, timestamp STRING, customer_id STRING, product_id STRING, "
    "store_id STRING, quantity INT, unit_price MONEY, payment_method STRING, channel STRING"
)
CUSTOMERS_RAW = _struct(
    "customer_id STRING, first_name STRING, last_name STRING, email STRING, phone STRING, "
    "signup_date STRING, loyalty_tier STRING, city STRING, web_sessions_count INT, "
    "opt_in_marketing BOOLEAN"
)
INVENTORY_RAW = _struct(
    "product_id STRING, store_id STRING, stock_on_hand INT, reorder_point INT, "
    "safety_stock INT, last_restock_date STRING"
)
PRODUCTS_RAW = _struct(
    "product_id STRING, product_name STRING, category STRING, unit_cost MONEY, "
    "suggested_retail_price MONEY, supplier STRING"
)
STORES_RAW = _struct(
    "store_id STRING, store_name STRING, city STRING, state STRING, region STRING, "
    "square_feet INT, opened_year INT"
)
RETAIL_LINES = _struct(
    "InvoiceNo STRING, StockCode STRING, Description STRING, Quantity STRING, "
    "InvoiceDate STRING, UnitPrice STRING, CustomerID STRING, Country STRING"
)

# Workbook sheet -> (bronze table, schema)
WORKBOOK_SHEETS = {
    "Inventory_Levels": ("bronze_inventory_raw", INVENTORY_RAW),
    "Products_Master": ("bronze_products_raw", PRODUCTS_RAW),
    "Stores_Master": ("bronze_stores_raw", STORES_RAW),
}

BRONZE_TABLES = (
    "bronze_sales_raw",
    "bronze_customers_raw",
    "bronze_inventory_raw",
    "bronze_products_raw",
    "bronze_stores_raw",
)
SILVER_TABLES = (
    "silver_sales",
    "silver_customers",
    "silver_products",
    "silver_stores",
    "silver_inventory",
)
GOLD_TABLES = (
    "dim_customers",
    "dim_products",
    "dim_stores",
    "dim_date",
    "fact_sales",
    "fact_inventory_snapshot",
    "gold_daily_sales_summary",
    "gold_category_performance",
)

# Column sets of the gold tables.
DIM_CUSTOMERS = (
    "customer_id", "first_name", "last_name", "email", "loyalty_tier", "city", "total_orders",
    "total_spend", "avg_order_value", "last_purchase_date", "days_since_last_purchase", "rfm_segment",
)
DIM_PRODUCTS = (
    "product_id", "product_name", "category", "unit_cost", "suggested_retail_price",
    "profit_margin_pct", "supplier",
)
DIM_STORES = ("store_id", "store_name", "city", "state", "region", "square_feet", "opened_year")
FACT_SALES = (
    "transaction_id", "timestamp", "transaction_date", "transaction_hour", "customer_id",
    "product_id", "store_id", "quantity", "unit_price", "unit_cost", "gross_amount", "cogs",
    "net_profit", "profit_margin_pct", "payment_method", "channel",
)
FACT_INVENTORY = (
    "product_id", "store_id", "stock_on_hand", "reorder_point", "safety_stock", "reorder_status",
    "unit_cost", "inventory_valuation",
)
VALIDATION_LOG = (
    "batch_id", "seq", "timestamp", "layer", "dataset", "rule", "severity", "affected_records", "details",
)

# The star's many-to-one relations: (fact, dimension, key).
RELATIONS = (
    ("fact_sales", "dim_customers", "customer_id"),
    ("fact_sales", "dim_products", "product_id"),
    ("fact_sales", "dim_stores", "store_id"),
    ("fact_inventory_snapshot", "dim_products", "product_id"),
    ("fact_inventory_snapshot", "dim_stores", "store_id"),
)
