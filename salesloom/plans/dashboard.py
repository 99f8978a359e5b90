"""The dashboard measures: growth, share, ranking, drill-down and risk."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.functions.numbers import money, ratio
from salesloom.plans.analytics import discount_band

DIMENSIONS = {
    "total": None,
    "market": "market_name",
    "segment": "segment",
    "category": "category_name",
    "sub_category": "sub_category_name",
    "product": "product",
}


def of_year(view: DataFrame, year: int | None) -> DataFrame:
    """The rows of one year, or all of them; the filter reaches the scan."""
    return view if year is None else view.where(F.col("order_year") == year)


def yearly(view: DataFrame, dimensions: Sequence[str] = tuple(DIMENSIONS)) -> DataFrame:
    """(dimension, member, year, sales, profit) for several dimensions.

    A product is an id with a name, since ids are shared by several names. Each
    dimension is grouped on its own, from its own narrow scan: a market or a
    segment shrinks to a few rows before anything is shuffled.
    """
    named = view.withColumn("product", F.concat_ws(" ", "raw_product_id", "product_name"))
    parts = []
    for d in dimensions:
        member = F.col(DIMENSIONS[d]) if DIMENSIONS[d] else F.lit("all")
        totals = named.groupBy(member.alias("member"), F.col("order_year").alias("year")).agg(
            F.sum("sales").alias("sales"), F.sum("profit").alias("profit")
        )
        parts.append(totals.select(F.lit(d).alias("dimension"), "member", "year", "sales", "profit"))
    return reduce(DataFrame.union, parts)


def _with_previous_year(years: DataFrame) -> DataFrame:
    """Previous-year values, only where the year before is present. A member has few years."""
    past = Window.partitionBy("dimension", "member").orderBy("year")
    adjacent = F.lag("year").over(past) == F.col("year") - 1

    def previous(column: str) -> Column:
        return F.when(adjacent, F.lag(column).over(past)).alias(f"prev_{column}")

    return years.select("*", previous("sales"), previous("profit"))


def _change(column: str) -> list[Column]:
    now, before = F.col(column), F.col(f"prev_{column}")
    return [
        money(now - before).alias(f"{column}_change"),
        ratio(now - before, before, 2, 100).alias(f"{column}_yoy_pct"),
    ]


def year_over_year(view: DataFrame, dimensions: Sequence[str] = tuple(DIMENSIONS)) -> DataFrame:
    return _with_previous_year(yearly(view, dimensions)).select(
        "dimension",
        "member",
        "year",
        money(F.col("sales")).alias("sales"),
        money(F.col("profit")).alias("profit"),
        ratio(F.col("profit"), F.col("sales"), 2, 100).alias("margin_pct"),
        *_change("sales"),
        *_change("profit"),
    )


def monthly_trend(view: DataFrame) -> DataFrame:
    return (
        view.groupBy("order_year", "order_month")
        .agg(
            money(F.sum("sales")).alias("total_sales"), money(F.sum("profit")).alias("total_profit")
        )
        .orderBy("order_year", "order_month")
    )


def category_share(view: DataFrame, year: int | None = None) -> DataFrame:
    """Contribution of each category to sales and profit; the whole is a scalar subquery."""
    totals = of_year(view, year).groupBy("category_name").agg(
        F.sum("sales").alias("sales"), F.sum("profit").alias("profit")
    )

    def share(column: str) -> Column:
        whole = totals.agg(F.sum(column)).scalar()
        return ratio(F.col(column), whole, 2, 100).alias(f"{column}_share_pct")

    return totals.select(
        "category_name",
        money(F.col("sales")).alias("total_sales"),
        money(F.col("profit")).alias("total_profit"),
        share("sales"),
        share("profit"),
    )


def top_members(view: DataFrame, keys: Sequence[str], rows: int = 10) -> DataFrame:
    """The ``rows`` members with the largest sales; ties by name."""
    totals = view.groupBy(*keys).agg(F.sum("sales").alias("s"), F.sum("profit").alias("p"))
    return (
        totals.orderBy(F.desc("s"), *keys)
        .limit(rows)
        .select(*keys, money(F.col("s")).alias("total_sales"), money(F.col("p")).alias("total_profit"))
    )


def top_products_and_customers(
    view: DataFrame, rows: int = 10, year: int | None = None
) -> DataFrame:
    view = of_year(view, year)
    products = top_members(view, ["product_name"], rows)
    customers = top_members(view, ["customer_name"], rows)

    def labelled(df: DataFrame, kind: str, name: str) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"), F.col(name).alias("member"), "total_sales", "total_profit"
        )

    return labelled(products, "product", "product_name").unionByName(
        labelled(customers, "customer", "customer_name")
    )


def largest_gains(view: DataFrame, year: int, rows: int = 10) -> DataFrame:
    """The ``rows`` products and the ``rows`` markets with the largest absolute sales gain in ``year``."""
    two_years = view.where(F.col("order_year").isin(year - 1, year))
    grown = _with_previous_year(yearly(two_years, ["market", "product"])).where(
        (F.col("year") == year) & F.col("prev_sales").isNotNull()
    )
    grown = grown.withColumn("gain", F.col("sales") - F.col("prev_sales"))
    place = F.row_number().over(Window.partitionBy("dimension").orderBy(F.desc("gain"), "member"))
    return (
        grown.withColumn("place", place)
        .where(F.col("place") <= rows)
        .select("dimension", "member", "year", money(F.col("sales")).alias("sales"),
                money(F.col("gain")).alias("sales_gain"))
    )


def drill_down(view: DataFrame, year: int | None = None) -> DataFrame:
    """Sales and profit at every level from all markets down to the customer.

    The view is grouped to the lowest level first, so the roll-up expands
    customers, not order lines.
    """
    levels = ["market_name", "region_name", "country_name", "customer_name"]
    base = of_year(view, year).groupBy(levels).agg(F.sum("sales").alias("s"), F.sum("profit").alias("p"))
    return base.rollup(*levels).agg(
        F.grouping_id().cast("int").alias("level_mask"),
        money(F.sum("s")).alias("total_sales"),
        money(F.sum("p")).alias("total_profit"),
    )


def roll_up(fact: DataFrame, closure: DataFrame, leaf: str) -> DataFrame:
    """Sales and profit of every member of every level, by one join with the hierarchy's closure.

    The fact is grouped to its leaves first, so a line is read once and no leaf is joined twice.
    """
    base = fact.groupBy(F.col(leaf).alias("leaf_id")).agg(F.sum("sales").alias("s"), F.sum("profit").alias("p"))
    return base.join(closure, "leaf_id").groupBy("depth", "level", "ancestor_id", "ancestor_name").agg(
        money(F.sum("s")).alias("total_sales"), money(F.sum("p")).alias("total_profit")
    )


def high_discount_losses(view: DataFrame, year: int | None = None) -> DataFrame:
    """Products sold at a loss in the highest discount band."""
    high = of_year(view, year).where(discount_band(F.col("discount")) == "High (>30%)")
    return (
        high.groupBy("sub_category_name", "raw_product_id", "product_name")
        .agg(
            money(F.avg("discount"), 4).alias("avg_discount"),
            money(F.sum("sales")).alias("total_sales"),
            money(F.sum("profit")).alias("total_profit"),
            ratio(F.sum("profit"), F.sum("sales"), 2, 100).alias("margin_pct"),
        )
        .where("total_profit < 0")
    )


def growth_risk(view: DataFrame) -> DataFrame:
    """Sub-categories and products whose sales rose while the year made a loss."""
    grown = _with_previous_year(yearly(view, ["sub_category", "product"]))
    return grown.where("sales > prev_sales and profit < 0").select(
        "dimension",
        "member",
        "year",
        money(F.col("sales")).alias("sales"),
        money(F.col("profit")).alias("profit"),
        ratio(F.col("sales") - F.col("prev_sales"), F.col("prev_sales"), 2, 100).alias(
            "sales_yoy_pct"
        ),
    )


def segment_analysis(view: DataFrame) -> DataFrame:
    """Segment sales per year with share of the year and growth."""
    years = _with_previous_year(yearly(view, ["segment"]))
    same_year = Window.partitionBy("year")
    return years.select(
        F.col("member").alias("segment"),
        "year",
        money(F.col("sales")).alias("sales"),
        ratio(F.col("sales"), F.sum("sales").over(same_year), 2, 100).alias("share_pct"),
        _change("sales")[1],
        _change("profit")[1],
    )
