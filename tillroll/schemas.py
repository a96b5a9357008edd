"""Declared schemas of every table, text lengths and required columns.

Bronze and gold are fixed by declaration; silver follows from its query.
The VARCHAR lengths are kept so overlong text can be checked (Q5) the way a
typed store would reject it.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Table names, column names and order, column types, declared
# text lengths and NOT NULL columns of the original warehouse's tables.
# ---------------------------------------------------------------------------

# --- bronze -----------------------------------------------------------------

ORDERS_COLUMNS = [
    "row_id", "order_id", "order_date", "ship_date", "ship_mode",
    "customer_id", "customer_name", "segment", "country_region",
    "city", "state", "postal_code", "region", "product_id",
    "category", "sub_category", "product_name",
    "sales", "quantity", "discount", "profit",
]

# The 20 columns that define an exact duplicate (all but row_id).
ORDERS_DEDUP_COLUMNS = ORDERS_COLUMNS[1:]

BRONZE_ORDERS = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("ship_date", T.DateType()),
    T.StructField("ship_mode", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("country_region", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("postal_code", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("sub_category", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("sales", T.DecimalType(10, 4)),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("discount", T.DecimalType(5, 4)),
    T.StructField("profit", T.DecimalType(10, 4)),
])

BRONZE_PEOPLE = T.StructType([
    T.StructField("person_name", T.StringType()),
    T.StructField("region", T.StringType()),
])

BRONZE_RETURNS = T.StructType([
    T.StructField("returned", T.StringType()),
    T.StructField("order_id", T.StringType()),
])

BRONZE = {
    "orders": BRONZE_ORDERS,
    "people": BRONZE_PEOPLE,
    "returns_order": BRONZE_RETURNS,
}

# Declared VARCHAR lengths of the landing tables.
TEXT_LENGTHS = {
    "orders": {
        "order_id": 50, "ship_mode": 50, "customer_id": 50, "customer_name": 100,
        "segment": 50, "country_region": 50, "city": 100, "state": 50,
        "postal_code": 50, "region": 50, "product_id": 50, "category": 50,
        "sub_category": 50, "product_name": 255,
    },
    "people": {"person_name": 50, "region": 50},
    "returns_order": {"returned": 3, "order_id": 20},
}

# --- gold -------------------------------------------------------------------

DIM_DATE_COLUMNS = [
    "date_key", "full_date", "year", "quarter_name", "month", "month_name",
    "month_short", "month_year_label", "week_of_year", "day_of_month",
    "day_of_week", "day_name", "day_short", "is_weekend", "is_business_day",
    "season",
]

FACT_COLUMNS = [
    "fact_key", "order_date_key", "ship_date_key", "customer_key", "product_key",
    "location_key", "ship_mode_key", "sales_person_key", "order_id",
    "sales", "quantity", "discount", "profit",
    "unit_price", "profit_margin", "days_to_ship", "is_returned",
]

# Fact keys that must be present (declared NOT NULL).  ship_date_key,
# ship_mode_key and sales_person_key may be NULL.
FACT_REQUIRED_KEYS = ["order_date_key", "customer_key", "product_key", "location_key"]
# All declared NOT NULL fact columns: the keys above and the order id.
FACT_NOT_NULL = [*FACT_REQUIRED_KEYS, "order_id"]

# Natural keys the dimensions are joined on, and their declared required columns.
DIMENSIONS = {
    "dim_customer": {
        "key": "customer_key",
        "columns": ["customer_id", "customer_name", "segment"],
        "join_on": ["customer_id"],
        "required": ["customer_id"],
    },
    "dim_product": {
        "key": "product_key",
        "columns": ["product_id", "product_name", "category", "sub_category"],
        "join_on": ["product_id", "product_name"],
        "required": ["product_id", "product_name"],
    },
    "dim_location": {
        "key": "location_key",
        "columns": ["city", "state", "postal_code", "region"],
        "join_on": ["city", "state", "postal_code"],
        "required": [],
    },
    "dim_ship_mode": {
        "key": "ship_mode_key",
        "columns": ["ship_mode"],
        "join_on": ["ship_mode"],
        "required": ["ship_mode"],
    },
    "dim_sales_person": {
        "key": "sales_person_key",
        "columns": ["person_name", "region"],
        "join_on": ["region"],
        "required": [],
    },
}
