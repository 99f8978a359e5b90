"""Column names and types of every layer.

Names are fixed values: users' own queries refer to them. Money is wider than
the 10-digit types of a single-store file, so that sums over very large tables
stay exact.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
PROFIT = T.DecimalType(18, 5)
RATE = T.DecimalType(5, 4)
FACT_RATE = T.DecimalType(6, 5)  # one digit before the point, so a 100 % discount fits
TEXT = T.StringType()

TEXT_COLUMNS = [
    "order_id", "ship_mode", "customer_name", "segment", "state", "country", "market", "region",
    "product_id", "category", "sub_category", "product_name", "order_priority",
]
CODE_COLUMNS = ["order_id", "product_id", "market", "region"]
NAME_COLUMNS = [c for c in TEXT_COLUMNS if c not in CODE_COLUMNS]
DATE_COLUMNS = ["order_date", "ship_date"]
NUMBER_COLUMNS = ["sales", "profit", "discount", "quantity", "shipping_cost"]
MEASURES = ["sales", "quantity", "discount", "profit", "shipping_cost"]


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


STAGING = _struct(
    ("order_id", TEXT), ("order_date", T.DateType()), ("ship_date", T.DateType()),
    ("ship_mode", TEXT), ("customer_name", TEXT), ("segment", TEXT), ("state", TEXT),
    ("country", TEXT), ("market", TEXT), ("region", TEXT), ("product_id", TEXT),
    ("category", TEXT), ("sub_category", TEXT), ("product_name", TEXT), ("sales", MONEY),
    ("quantity", T.IntegerType()), ("discount", RATE), ("profit", PROFIT),
    ("shipping_cost", MONEY), ("order_priority", TEXT),
)

# The file carries one more column than staging keeps.
RAW = _struct(*[(name, TEXT) for name in [*STAGING.names, "year"]])

# Longest value each staging text column may hold.
TEXT_LENGTHS = {
    "order_id": 50, "ship_mode": 50, "customer_name": 100, "segment": 50, "state": 100,
    "country": 100, "market": 50, "region": 50, "product_id": 50, "category": 50,
    "sub_category": 50, "product_name": 200, "order_priority": 50,
}

# Two rows that agree on these are the same sale entered twice.
DUPLICATE_KEY = [
    "order_id", "order_date", "product_id", "product_name", "customer_name", "state", "country",
    "market", "region", "sales", "quantity", "discount", "profit", "shipping_cost",
]

LONG = T.LongType()
INT = T.IntegerType()
DATE = T.DateType()

TABLES: dict[str, T.StructType] = {
    "staging_sales": STAGING,
    "dim_date": _struct(
        ("date_id", DATE), ("year", INT), ("quarter", INT), ("month", INT), ("month_name", TEXT),
        ("day", INT), ("day_of_week", TEXT), ("week_of_year", INT), ("is_weekend", INT)),
    "dim_customer": _struct(("customer_id", LONG), ("customer_name", TEXT), ("segment", TEXT)),
    "dim_market": _struct(("market_id", LONG), ("market_name", TEXT)),
    "dim_region": _struct(("region_id", LONG), ("region_name", TEXT), ("market_id", LONG)),
    "dim_country": _struct(("country_id", LONG), ("country_name", TEXT), ("region_id", LONG)),
    "dim_state": _struct(("state_id", LONG), ("state_name", TEXT), ("country_id", LONG)),
    "dim_category": _struct(("category_id", LONG), ("category_name", TEXT)),
    "dim_sub_category": _struct(
        ("sub_category_id", LONG), ("sub_category_name", TEXT), ("category_id", LONG)),
    "dim_product": _struct(
        ("product_id", LONG), ("raw_product_id", TEXT), ("product_name", TEXT),
        ("sub_category_id", LONG)),
    "fact_sales": _struct(
        ("sales_id", LONG), ("order_id", TEXT), ("order_date_id", DATE), ("ship_date_id", DATE),
        ("ship_mode", TEXT), ("customer_id", LONG), ("state_id", LONG), ("product_id", LONG),
        ("sales", MONEY), ("quantity", INT), ("discount", FACT_RATE), ("profit", PROFIT),
        ("shipping_cost", MONEY), ("order_priority", TEXT)),
}

VIEW_COLUMNS = [
    "sales_id", "order_id", "order_date_id", "order_year", "order_quarter", "order_month",
    "order_month_name", "ship_date_id", "ship_year", "ship_quarter", "ship_month",
    "ship_month_name", "shipping_days", "ship_mode", "customer_id", "customer_name", "segment",
    "state_id", "state_name", "country_id", "country_name", "region_id", "region_name",
    "market_id", "market_name", "product_id", "raw_product_id", "product_name",
    "sub_category_id", "sub_category_name", "category_id", "category_name", "sales", "quantity",
    "discount", "profit", "shipping_cost", "order_priority",
]
SUMMARY_KEYS = [
    "year", "quarter", "month", "month_name", "segment", "state_name", "region_name",
    "market_name", "category_name", "sub_category_name",
]
