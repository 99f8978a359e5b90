"""The fact load and the two views over it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions.numbers import ratio
from salesloom.operators.numbering import file_line, number_rows
from salesloom.schemas import FACT_RATE, SUMMARY_KEYS, TABLES, VIEW_COLUMNS
from salesloom.sources.storage import pass_on

Tables = Mapping[str, DataFrame]

GEOGRAPHY = ["market", "region", "country", "state"]

# The order that fixes fact keys: dates first, so that files hold narrow date ranges.
FACT_ORDER = [
    "order_date_id", "order_id", "product_id", "customer_id", "state_id", "ship_date_id",
    "ship_mode", "sales", "quantity", "discount", "profit", "shipping_cost", "order_priority",
]


def join_geography(tables: Tables) -> DataFrame:
    """State key with the names and keys of its whole path."""
    return (
        tables["dim_state"]
        .join(tables["dim_country"], "country_id")
        .join(tables["dim_region"], "region_id")
        .join(tables["dim_market"], "market_id")
    )


def join_products(tables: Tables) -> DataFrame:
    """Product key with its sub-category and category."""
    return (
        tables["dim_product"]
        .join(tables["dim_sub_category"], "sub_category_id")
        .join(tables["dim_category"], "category_id")
    )


def geography(tables: Tables) -> DataFrame:
    """The joined geography, from its written table if there is one.

    Spark knows the size of a written table and so broadcasts it when it is
    small; its estimate for a join of four tables is their product, which would
    make it shuffle the fact by state.
    """
    return tables["flat_geography"] if "flat_geography" in tables else join_geography(tables)


def product_path(tables: Tables) -> DataFrame:
    """The joined products, from their written table if there is one."""
    return tables["flat_product"] if "flat_product" in tables else join_products(tables)


def load_fact(staging: DataFrame, tables: Tables, first: str, last: str) -> DataFrame:
    """Fact rows without key: staging rows whose date is in range and whose members all exist.

    One join per dimension on its full natural key; the four geography levels
    are one join because a state is identified by its whole path.
    """
    states = geography(tables).select(
        "state_id",
        *[F.col(f"{level}_name").alias(level) for level in GEOGRAPHY],
    )
    products = tables["dim_product"].select(
        F.col("product_id").alias("_product_key"),
        F.col("raw_product_id").alias("product_id"),
        "product_name",
    )
    return (
        staging.where(F.col("order_date").between(F.lit(first), F.lit(last)))
        .join(states, GEOGRAPHY)
        .join(tables["dim_customer"], ["customer_name", "segment"])
        .join(products, ["product_id", "product_name"])
        .select(
            "order_id",
            F.col("order_date").alias("order_date_id"),
            F.col("ship_date").alias("ship_date_id"),
            "ship_mode",
            "customer_id",
            "state_id",
            F.col("_product_key").alias("product_id"),
            "sales",
            "quantity",
            F.col("discount").cast(FACT_RATE).alias("discount"),
            "profit",
            "shipping_cost",
            "order_priority",
        )
    )


def key_fact(loaded: DataFrame, start: int = 1) -> DataFrame:
    """Number the fact rows in ``FACT_ORDER``; equal rows are spread by their file position.

    They are written first. So the shuffles of their joins are off the disk before they are sorted, and
    the sort, which looks at its input twice, doesn't join it twice.
    """
    lines = file_line(pass_on(loaded, "loaded"))
    keyed = number_rows(lines, FACT_ORDER, "sales_id", start=start, spread_by=["_line"])
    return keyed.select(TABLES["fact_sales"].names)


def sales_full(tables: Tables) -> DataFrame:
    """Fact grain, 38 columns; left joins, so no fact row is lost."""
    states = geography(tables)
    products = product_path(tables)

    def dates(role: str) -> DataFrame:
        return tables["dim_date"].select(
            F.col("date_id").alias(f"{role}_date_id"),
            F.col("year").alias(f"{role}_year"),
            F.col("quarter").alias(f"{role}_quarter"),
            F.col("month").alias(f"{role}_month"),
            F.col("month_name").alias(f"{role}_month_name"),
        )

    return (
        tables["fact_sales"]
        # The tables that may be too large to broadcast come first, while the rows that they shuffle are narrow.
        .join(tables["dim_customer"], "customer_id", "left")
        .join(products, "product_id", "left")
        .join(states, "state_id", "left")
        .join(dates("order"), "order_date_id", "left")
        .join(dates("ship"), "ship_date_id", "left")
        .withColumn("shipping_days", F.datediff("ship_date_id", "order_date_id"))
        .select(VIEW_COLUMNS)
    )


def sales_joined(tables: Tables) -> DataFrame:
    """Fact rows with every dimension name; inner joins, so orphans drop out."""
    days = tables["dim_date"].withColumnRenamed("date_id", "order_date_id")
    return (
        tables["fact_sales"]
        # As in sales_full, the rows are narrow while they are shuffled.
        .join(tables["dim_customer"], "customer_id")
        .join(product_path(tables), "product_id")
        .join(geography(tables), "state_id")
        .join(days, "order_date_id")
    )


def sales_summary(tables: Tables, with_sketch: bool = False, view: DataFrame | None = None) -> DataFrame:
    """Ten keys and five measures.

    ``order_count`` is distinct within a group only. ``with_sketch`` adds a
    mergeable sketch of the order ids, from which any roll-up can estimate its
    own distinct orders. Given the written rows of ``sales_full`` as ``view``, it joins nothing.
    """
    if view is not None:
        return summary_of_view(view, with_sketch)
    return _summarised(sales_joined(tables), with_sketch)


def summary_of_view(view: DataFrame, with_sketch: bool = False) -> DataFrame:
    """``sales_summary`` from the rows of a written ``sales_full``, which hold all names already.

    A fact row that lacks a date or member is in the view but not in the summary.
    """
    named = {f"order_{c}": c for c in ("year", "quarter", "month", "month_name")}
    known = view.na.drop(subset=["order_year", "customer_name", "state_name", "raw_product_id"])
    return _summarised(known.withColumnsRenamed(named), with_sketch)


def _summarised(joined: DataFrame, with_sketch: bool = False) -> DataFrame:
    measures = [
        F.sum("sales").alias("total_sales"),
        F.sum("quantity").alias("total_qty"),
        F.sum("profit").alias("total_profit"),
        F.count_distinct("order_id").alias("order_count"),
        ratio(F.sum("profit"), F.sum("sales"), 4).alias("true_margin"),
    ]
    if with_sketch:
        measures.append(F.hll_sketch_agg("order_id").alias("order_sketch"))
    return joined.groupBy(SUMMARY_KEYS).agg(*measures)
