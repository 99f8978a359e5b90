"""Retail order lines derived from the order-processing test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.schemas import MONEY, PROFIT, RATE, RAW, STAGING


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line with its order, customer, place and product.

    Lines are dealt by order first, into as many parts as any shuffle has: a file of
    one row group would otherwise keep everything up to the written table in one task.
    Orders find their customers before the lines do and then meet them by the same
    dealing; the hint keeps Spark, whose estimate for the joined orders is far too
    large, from broadcasting the lines instead. So lines are shuffled for orders and,
    where parts are too many to broadcast, for these; names of places come last.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = _read(spark, sf_dir, "orders").join(
        _read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return (
        _read(spark, sf_dir, "lineitem")
        .repartition(parts, "l_orderkey")
        .join(placed.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(_read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def _label(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _mapped(lines: DataFrame) -> DataFrame:
    """Order lines plus the staging columns, test-table columns kept."""
    price = F.col("l_extendedprice").cast(MONEY)
    discount = (F.col("l_discount") * 5).cast(RATE)
    keep = F.lit(1).cast(RATE) - discount
    cost = F.col("l_quantity").cast("int") * F.col("p_retailprice").cast(MONEY) * F.expr("0.7BD")
    tax = F.abs("l_tax").cast(RATE)
    mode = (
        F.when(F.col("l_returnflag") == "A", "Standard Class")
        .when(F.col("l_returnflag") == "N", "Second Class")
        .otherwise("First Class")
    )
    return lines.withColumns(
        {
            "order_id": _label("O-", F.col("o_orderkey")),
            "order_date": F.col("o_orderdate").cast("date"),
            "ship_date": F.col("l_shipdate").cast("date"),
            "ship_mode": mode,
            "customer_name": F.col("c_name"),
            "segment": F.col("c_mktsegment"),
            "state": _label("STATE_", F.col("c_custkey") % 10),
            "country": F.col("n_name"),
            "market": F.col("r_name"),
            "region": _label("ZONE_", F.col("n_nationkey") % 3),
            "product_id": _label("PRD-", F.expr("p_partkey div 2")),
            "category": F.col("p_type"),
            "sub_category": F.col("p_brand"),
            "product_name": F.col("p_name"),
            "sales": price,
            "quantity": F.col("l_quantity").cast("int"),
            "discount": discount,
            "profit": (price * keep - cost).cast(PROFIT),
            "shipping_cost": F.round(price * tax * F.expr("0.1BD"), 2).cast(MONEY),
            "order_priority": F.col("o_orderpriority"),
        }
    )


def staging_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed staging table."""
    return _mapped(order_lines(spark, sf_dir)).select(STAGING.names)


def with_repeated_lines(staging: DataFrame, market: str = "ASIA") -> DataFrame:
    """Staging in which the lines of one market were entered a second time."""
    return staging.unionByName(staging.where(F.col("market") == market))


def _pick(number: Column, *choices: Column) -> Column:
    """The choice at ``number`` modulo their count."""
    chosen = choices[-1]
    for i, choice in reversed(list(enumerate(choices[:-1]))):
        chosen = F.when(number % len(choices) == i, choice).otherwise(chosen)
    return chosen


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging rows as an uncleaned all-text file would hold them.

    Mixed date forms, thousands commas, currency signs, accounting parentheses,
    stray blanks and line breaks, accents, mixed case, missing and unreadable
    values, each chosen by a key of the row.
    """
    order, part, supplier = F.col("o_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    customer, line = F.col("c_custkey"), F.col("l_linenumber")

    def day(column: str, pattern: str) -> Column:
        return F.date_format(column, pattern)

    def text(column: str) -> Column:
        return F.col(column).cast("string")

    order_date = (
        F.when(order % 97 == 0, F.lit(None))
        .when(order % 89 == 0, day("order_date", "yyyy-MM-dd"))
        .otherwise(
            _pick(
                order,
                day("order_date", "d/M/yyyy"),
                day("order_date", "dd-MM-yyyy"),
                F.concat(F.lit(" "), day("order_date", "d.M.yyyy"), F.lit(" ")),
                day("order_date", "dd/MM/yyyy"),
            )
        )
    )
    ship_date = F.when(supplier % 71 == 0, day("ship_date", "MM/dd/yyyy")).otherwise(
        _pick(
            line,
            day("ship_date", "d-M-yyyy"),
            day("ship_date", "dd.MM.yyyy"),
            day("ship_date", "d/M/yyyy"),
        )
    )
    sales = (
        F.when(part % 211 == 0, "n/a")
        .when(part % 223 == 0, "1e3")
        .when(part % 227 == 0, F.concat(text("sales"), F.lit("5")))
        .otherwise(
            _pick(
                supplier,
                F.format_number("sales", 2),
                F.concat(F.lit("$"), text("sales")),
                F.concat(F.lit(" "), text("sales"), F.lit(" ")),
                text("sales"),
            )
        )
    )
    in_parentheses = F.concat(F.lit("("), F.abs("profit").cast("string"), F.lit(")"))
    raw = {
        "order_id": _pick(
            order,
            F.lower("order_id"),
            F.concat(F.lit("  "), "order_id"),
            F.concat("order_id", F.lit(" ")),
        ),
        "order_date": order_date,
        "ship_date": ship_date,
        "ship_mode": _pick(
            line, F.upper("ship_mode"), F.regexp_replace(F.lower("ship_mode"), " ", "  ")
        ),
        "customer_name": F.when(customer % 7 == 0, F.concat(F.lit("søren "), "c_name"))
        .when(customer % 5 == 0, F.concat(F.lit("josé  "), F.lower("c_name")))
        .otherwise(F.upper("c_name")),
        "segment": F.lower("segment"),
        "state": _pick(
            customer,
            F.concat(F.lit("são paulo "), text("state")),
            F.concat(F.lit("côte d'azur "), F.lower("state")),
        ),
        "country": F.concat("country", F.lit(" ")),
        "market": F.lower("market"),
        "region": F.initcap("region"),
        "product_id": F.lower("product_id"),
        "category": F.lower("category"),
        "sub_category": F.upper("sub_category"),
        "product_name": _pick(
            part,
            F.upper("product_name"),
            F.regexp_replace("product_name", " ", "\r\n"),
            F.regexp_replace("product_name", " ", "\t"),
            F.concat(F.lit("oﬃce "), "product_name"),
            F.concat("product_name", F.lit(', 8.5 x 11 "wide"')),
        ),
        "sales": sales,
        "quantity": F.when(supplier % 61 == 0, "").otherwise(text("quantity")),
        "discount": F.when((order + line) % 31 == 0, F.lit(None))
        .when((order + line) % 53 == 0, "50")
        .otherwise(text("discount")),
        "profit": F.when((line % 2 == 0) & (F.col("profit") < 0), in_parentheses).otherwise(
            text("profit")
        ),
        "shipping_cost": F.when((order + line) % 37 == 0, F.lit(None))
        .when((order + line) % 41 == 0, "free")
        .otherwise(text("shipping_cost")),
        "order_priority": F.lower("order_priority"),
        "year": F.year("order_date").cast("string"),
    }
    mapped = _mapped(order_lines(spark, sf_dir))
    return mapped.select(*[raw[name].cast("string").alias(name) for name in RAW.names])
