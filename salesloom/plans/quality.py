"""Checks between the layers of the warehouse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.numbers import money
from salesloom.operators import bitmaps
from salesloom.operators.reconcile import (
    differing_counts, digest_tree, missing_from, repeat_rows, side_counts,
)
from salesloom.schemas import MEASURES

Tables = Mapping[str, DataFrame]

COMPARED = ["order_id", "raw_product_id", "product_name", *MEASURES]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- staging against fact -------------------------------------------------


DAY = "order_day"


def staging_lines(tables: Tables, *more: Column) -> DataFrame:
    return (
        tables["staging_sales"]
        .withColumnRenamed("product_id", "raw_product_id")
        .withColumn("discount", F.col("discount").cast("decimal(6,5)"))
        .select(*more, *COMPARED)
    )


def fact_lines(tables: Tables, *more: Column) -> DataFrame:
    """Fact rows with the natural product key; rows of unknown products drop out."""
    return tables["fact_sales"].join(tables["dim_product"], "product_id").select(*more, *COMPARED)


def _dated_lines(tables: Tables) -> tuple[DataFrame, DataFrame]:
    staging = staging_lines(tables, F.col("order_date").alias(DAY))
    return staging, fact_lines(tables, F.col("order_date_id").alias(DAY))


def _line_counts(tables: Tables, by_digest: bool) -> DataFrame:
    """Rows of staging (left) and fact (right); by digest, only of lines that may differ."""
    if by_digest:
        return differing_counts(*_dated_lines(tables), COMPARED, DAY)
    return side_counts(staging_lines(tables), fact_lines(tables), COMPARED)


def layer_digests(tables: Tables) -> DataFrame:
    """Checksums of staging and fact from the whole down to the days, and in how many leaves they differ."""
    return digest_tree(*_dated_lines(tables), COMPARED, DAY).orderBy("level", "period")


def _product_key(tables: Tables, name: str) -> DataFrame:
    return tables["dim_product"].select(
        F.col("product_id").alias(name), "raw_product_id", "product_name"
    )


def loading_gaps(tables: Tables, null_safe: bool = False, by_digest: bool = False) -> DataFrame:
    """Staging rows of known products that no fact row equals in order, product and measures.

    ``by_digest``, here and below, compares checksums of both layers first and moves only rows of
    those parts of a day that differ: where the layers agree, none.
    """
    gaps = missing_from(_line_counts(tables, by_digest), "left_rows", "right_rows", COMPARED, null_safe)
    keyed = gaps.join(_product_key(tables, "dim_product_id"), ["raw_product_id", "product_name"])
    columns = ["order_id", "raw_product_id", "product_name", "dim_product_id", *MEASURES]
    return repeat_rows(keyed.select(*columns, "left_rows"), "left_rows")


def phantom_rows(tables: Tables, null_safe: bool = False, by_digest: bool = False) -> DataFrame:
    """Fact rows of known products that no staging row equals."""
    extra = missing_from(_line_counts(tables, by_digest), "right_rows", "left_rows", COMPARED, null_safe)
    keyed = extra.join(_product_key(tables, "product_id"), ["raw_product_id", "product_name"])
    columns = ["order_id", "product_id", "raw_product_id", "product_name", *MEASURES]
    return repeat_rows(keyed.select(*columns, "right_rows"), "right_rows")


def multiset_difference(tables: Tables, by_digest: bool = False) -> DataFrame:
    """Rows the two layers hold a different number of times; sees lost copies of equal rows."""
    return (
        _line_counts(tables, by_digest)
        .where("left_rows <> right_rows")
        .withColumnsRenamed({"left_rows": "staging_rows", "right_rows": "fact_rows"})
        .withColumn("delta", F.col("staging_rows") - F.col("fact_rows"))
    )


# --- totals per layer -----------------------------------------------------

TOTALS = ["row_count", "total_sales", "total_quantity", "total_profit", "order_products"]


def layer_total(df: DataFrame, source: str, product_column: str) -> DataFrame:
    """Totals of one layer; distinct order-product pairs are counted as pairs, not as joined text."""
    return df.agg(
        F.lit(source).alias("source"),
        F.count("*").alias("row_count"),
        F.sum("sales").alias("total_sales"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("profit").alias("total_profit"),
        F.count_distinct("order_id", product_column).alias("order_products"),
    )


def with_differences(
    layers: DataFrame, measures: Sequence[str], differences: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """Add (label, a, b) rows = layer a minus layer b; layer and difference rows in that order.

    ``layers`` has one row per layer. Each layer contributes plus or minus itself
    to the differences it takes part in, so nothing is computed twice. Where a
    layer has no value, as an empty one has no sum, its differences have none.
    """
    roles: list[Column] = [F.struct(F.col("source").alias("label"), F.lit(1).alias("sign"))]
    for label, a, b in differences:
        sign = F.when(F.col("source") == a, 1).when(F.col("source") == b, -1)
        roles.append(F.struct(F.lit(label).alias("label"), sign.alias("sign")))
    placed = layers.select("*", F.explode(F.array(*roles)).alias("role")).where(
        "role.sign is not null"
    )
    return placed.groupBy(F.col("role.label").alias("source")).agg(
        *[
            F.when(F.count(m) == F.count("*"), F.sum(F.col(m) * F.col("role.sign"))).alias(m)
            for m in measures
        ]
    )


def in_listed_order(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """Sort by the position of ``column`` in a list."""
    listed = F.array(*[F.lit(v) for v in order])
    return df.orderBy(F.array_position(listed, F.col(column)))


def layer_totals(tables: Tables) -> DataFrame:
    """Staging, fact and view totals with both differences; every layer is read once."""
    fact = tables["fact_sales"].join(
        tables["dim_product"].select("product_id", "raw_product_id"), "product_id"
    )
    layers = union_all(
        [
            layer_total(tables["staging_sales"], "staging_sales", "product_id"),
            layer_total(fact, "fact_sales", "raw_product_id"),
            layer_total(tables["vw_sales_full"], "vw_sales_full", "raw_product_id"),
        ]
    )
    differences = [
        ("difference (staging - fact)", "staging_sales", "fact_sales"),
        ("difference (staging - view)", "staging_sales", "vw_sales_full"),
    ]
    result = with_differences(layers, TOTALS, differences).select(
        "source",
        "row_count",
        money(F.col("total_sales")).alias("total_sales"),
        "total_quantity",
        money(F.col("total_profit"), 5).alias("total_profit"),
        "order_products",
    )
    order = ["staging_sales", "fact_sales", "vw_sales_full", *[d[0] for d in differences]]
    return in_listed_order(result, "source", order)


DISTINCT_MEASURES = [
    "sales_id", "order_id", "order_date_id", "ship_date_id", "ship_mode", "customer_id",
    "state_id", "product_id", "order_priority",
]


def distinct_profile(df: DataFrame, source: str, approximate: bool = False) -> DataFrame:
    """Row count and nine distinct counts, exact from bitmaps and groupings of one column each."""
    if approximate:
        counts = [F.approx_count_distinct(c).alias(f"uniq_{c}") for c in DISTINCT_MEASURES]
        return df.agg(F.lit(source).alias("source"), F.count("*").alias("total_rows"), *counts)
    rows = df.agg(F.lit("*").alias("column"), F.count("*").alias("distinct_count"))
    found = bitmaps.distinct_counts(df, DISTINCT_MEASURES).unionAll(rows)
    of = lambda c: F.max(F.when(F.col("column") == c, F.col("distinct_count")))
    counts = [of(c).alias(f"uniq_{c}") for c in DISTINCT_MEASURES]
    return found.agg(F.lit(source).alias("source"), of("*").alias("total_rows"), *counts)


def distinct_comparison(tables: Tables, approximate: bool = False) -> DataFrame:
    layers = union_all(
        [
            distinct_profile(tables[name], name, approximate)
            for name in ("fact_sales", "vw_sales_full")
        ]
    )
    label = "difference (fact - view)"
    result = with_differences(
        layers, layers.columns[1:], [(label, "fact_sales", "vw_sales_full")]
    )
    return in_listed_order(result, "source", ["fact_sales", "vw_sales_full", label])


# --- counts ---------------------------------------------------------------


def row_counts(tables: Tables, names: Sequence[str]) -> DataFrame:
    return union_all(
        [
            tables[name].agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
            for name in names
        ]
    )


def load_overview(tables: Tables) -> DataFrame:
    """Rows of staging and fact and their difference, of three dimensions, and the calendar range."""
    layers = row_counts(tables, ["staging_sales", "fact_sales"]).withColumnRenamed(
        "table_name", "source"
    )
    total = with_differences(
        layers, ["row_count"], [("staging - fact", "staging_sales", "fact_sales")]
    ).select(
        F.lit("overview").alias("report"), F.col("source").alias("item"), "row_count"
    )
    dims = row_counts(tables, ["dim_customer", "dim_state", "dim_product"]).select(
        F.lit("dimensions").alias("report"), F.col("table_name").alias("item"), "row_count"
    )
    days = tables["dim_date"].agg(
        F.lit("date range").alias("report"),
        F.concat(
            F.min("date_id").cast("string"), F.lit(" ~ "), F.max("date_id").cast("string")
        ).alias("item"),
        F.count("*").alias("row_count"),
    )
    return union_all([total, dims, days])


def key_orphans(tables: Tables) -> DataFrame:
    """Fact rows per foreign key that no dimension row answers.

    Each key column is first reduced to its distinct values with counts, so a
    key that fills a third of the fact joins as a single row.
    """
    checks = [
        ("order_date", "order_date_id", "dim_date", "date_id"),
        ("ship_date", "ship_date_id", "dim_date", "date_id"),
        ("customer", "customer_id", "dim_customer", "customer_id"),
        ("state", "state_id", "dim_state", "state_id"),
        ("product", "product_id", "dim_product", "product_id"),
    ]
    found = []
    for name, column, dimension, key in checks:
        used = tables["fact_sales"].groupBy(F.col(column).alias(key)).agg(F.count("*").alias("n"))
        orphans = used.join(tables[dimension].select(key), key, "left_anti")
        found.append(
            orphans.agg(
                F.lit(f"{name} orphans").alias("check_name"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_cnt"),
            )
        )
    return union_all(found)


# --- products -------------------------------------------------------------


def _names_per_id(tables: Tables) -> DataFrame:
    return (
        tables["dim_product"]
        .groupBy("raw_product_id")
        .agg(F.count_distinct("product_name").alias("name_count"))
        .where("name_count > 1")
    )


def product_conflict_summary(tables: Tables) -> DataFrame:
    return _names_per_id(tables).agg(
        F.count("raw_product_id").alias("conflicting_ids"),
        F.coalesce(F.sum(F.col("name_count") - 1), F.lit(0)).alias("extra_names"),
        F.count("*").alias("ids_with_conflict"),
    )


def product_conflicts(tables: Tables) -> DataFrame:
    """Conflicts between product ids, names and the fact, in four directions."""
    products = tables["dim_product"]
    ids_per_name = (
        products.groupBy("product_name")
        .agg(F.count_distinct("raw_product_id").alias("n"))
        .where("n > 1")
    )
    pairs = (
        products.groupBy("raw_product_id", "product_name").agg(F.count("*").alias("n")).where("n > 1")
    )
    unknown = (
        tables["fact_sales"]
        .groupBy("product_id")
        .agg(F.count("*").alias("n"))
        .join(products.select("product_id"), "product_id", "left_anti")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("problems"))
    )

    def counted(label: str, df: DataFrame) -> DataFrame:
        return df.agg(F.lit(label).alias("check_name"), F.count("*").alias("problems"))

    return union_all(
        [
            counted("1 id with several names", _names_per_id(tables)),
            counted("2 name with several ids", ids_per_name),
            counted("3 repeated id and name pair", pairs),
            unknown.select(F.lit("4 fact without product").alias("check_name"), "problems"),
        ]
    ).orderBy("check_name")


# --- orders ---------------------------------------------------------------


def order_match(tables: Tables) -> DataFrame:
    """Share of distinct staging orders that reached the fact, from one grouping of both layers."""
    staging = tables["staging_sales"].select("order_id", F.lit(False).alias("loaded"))
    fact = tables["fact_sales"].select("order_id", F.lit(True).alias("loaded"))
    orders = (
        staging.unionByName(fact)
        .where("order_id is not null")
        .groupBy("order_id")
        .agg(F.bool_or("loaded").alias("in_fact"), F.bool_or(~F.col("loaded")).alias("in_staging"))
        .where("in_staging")
    )
    counts = orders.agg(F.count("*").alias("total"), F.count_if("in_fact").alias("matched"))
    share = F.round(F.col("matched") * F.expr("100.0BD") / F.nullif("total", F.lit(0)), 2)
    return counts.select(
        F.concat(share.cast("decimal(5,2)").cast("string"), F.lit("%")).alias("match_rate"),
        F.col("matched").alias("matched_orders"),
        F.col("total").alias("staging_orders"),
        (F.col("total") - F.col("matched")).alias("unmatched_orders"),
    )


LINE_KEY = ["order_id", "product_id", "order_date_id", "ship_date_id", "ship_mode", "shipping_cost"]


def repeated_lines(fact: DataFrame) -> DataFrame:
    """Order lines entered more than once. ``ship_modes`` lists one mode, as the key holds it."""
    return (
        fact.groupBy(*LINE_KEY)
        .agg(
            F.count("*").alias("line_count"),
            F.sum("sales").alias("total_sales"),
            F.sum("quantity").alias("total_quantity"),
            F.first("ship_mode").alias("ship_modes"),
        )
        .where("line_count > 1")
    )


def repeated_lines_report(fact: DataFrame, rows: int = 100) -> DataFrame:
    return repeated_lines(fact).orderBy(*LINE_KEY).limit(rows)


# --- hierarchies and headline numbers --------------------------------------


def geography_chain(tables: Tables, rows: int = 20) -> DataFrame:
    columns = ["market_name", "region_name", "country_name", "state_name"]
    return (
        tables["dim_market"]
        .join(tables["dim_region"], "market_id")
        .join(tables["dim_country"], "region_id")
        .join(tables["dim_state"], "country_id")
        .select(columns)
        .orderBy(columns)
        .limit(rows)
    )


def product_chain(tables: Tables, rows: int = 20) -> DataFrame:
    return (
        tables["dim_category"]
        .join(tables["dim_sub_category"], "category_id")
        .join(tables["dim_product"], "sub_category_id")
        .select(
            "category_name", "sub_category_name", "product_id", "raw_product_id", "product_name"
        )
        .orderBy("category_name", "sub_category_name", "product_id")
        .limit(rows)
    )


def fact_kpis(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.min("order_date_id").alias("earliest_order"),
        F.max("order_date_id").alias("latest_order"),
        F.count("*").alias("total_rows"),
        F.count_distinct("order_id").alias("unique_orders"),
        money(F.sum("sales"), 0).alias("total_sales"),
        money(F.sum("profit"), 0).alias("total_profit"),
    )
