"""One named query per operator, each over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.functions.dates import calendar_columns
from salesloom.functions.numbers import money, ratio, whole_number_text
from salesloom.functions.text import collapse_blanks, fold_accents, is_ascii, proper_case
from salesloom.operators import cleaning as B
from salesloom.operators import hierarchy as H
from salesloom.operators import profiling as C
from salesloom.operators import sketches as S
from salesloom.plans import analytics as K
from salesloom.plans import dashboard as L
from salesloom.plans import quality as J
from salesloom.plans import views as V
from salesloom.plans.store import Store
from salesloom.plans.warehouse import Warehouse, short_warehouse, warehouse
from salesloom.schemas import (
    CODE_COLUMNS, DUPLICATE_KEY, NAME_COLUMNS, NUMBER_COLUMNS, STAGING, SUMMARY_KEYS, TABLES,
    TEXT_COLUMNS, VIEW_COLUMNS,
)
from salesloom.sources import csv_files, tables
from salesloom.sources.storage import fresh_path, materialize
from salesloom.sources.testdata import with_repeated_lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STORED = ["staging_sales", *[name for name in TABLES if name.startswith("dim_")], "fact_sales"]


def shown(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the way a report prints them."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Register ``build`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(build(warehouse(spark, sf_dir)))

    QUERIES[build.__name__] = run
    return build


def query_with_short_calendar(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Register ``build`` and, as ``<name>_planted``, the same on a load that lacks some days."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(build(short_warehouse(spark, sf_dir)))

    QUERIES[f"{build.__name__}_planted"] = run
    return query(build)


def query_on_documents(build: Callable[[DataFrame], DataFrame]) -> Callable:
    """Register a query that reads the documents table only."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(
        spark.read.parquet(f"{sf_dir}/documents.parquet")
    )
    return build


# --- A. sources, sinks, tables --------------------------------------------


@query
def a_csv_roundtrip(w):
    path = fresh_path(w.spark, "raw_csv")
    csv_files.write_csv(w["raw_sales"], path)
    return csv_files.read_raw_csv(w.spark, path, multi_line=True)


def _broken_lines(w: Warehouse, path: str) -> None:
    """A file with the clean file's header, and a short and a long line for each market."""
    names = B.clean(w["raw_sales"]).columns  # the plan knows them; no row is cleaned for a header
    short = w["dim_market"].select(F.concat_ws(",", "market_name", "market_id").alias("line"))
    long = w["dim_market"].select(F.concat_ws(",", *["market_name"] * (len(names) + 2)).alias("line"))
    # In one file, so that the header comes first; there are as many lines as markets, twice.
    header = w.spark.range(1).select(F.lit(",".join(names)).alias("line"))
    header.union(short).union(long).coalesce(1).write.text(path)


def _clean_csv(w: Warehouse) -> DataFrame:
    """The clean file, compressed, with broken lines among its files, as read back."""
    paths = [fresh_path(w.spark, "clean_csv"), fresh_path(w.spark, "broken_csv")]
    _broken_lines(w, paths[1])  # first, as the tables behind it are shuffled
    csv_files.write_csv(w["clean_sales"], paths[0], compression="gzip")
    return csv_files.read_raw_csv(w.spark, paths, keep_malformed=True)


@query
def a_typed_load(w):
    return csv_files.load_typed(_clean_csv(w))


@query
def a_load_diagnostics(w):
    return csv_files.load_diagnostics(_clean_csv(w))


@query
def a_report_tables(w):
    sheets = C.audit_report(w["staging_sales"], STAGING.names)
    written = csv_files.write_report(sheets, fresh_path(w.spark, "audit"))
    return J.union_all(
        [
            w.spark.read.parquet(path).agg(
                F.lit(name).alias("sheet"), F.count("*").alias("row_count")
            )
            for name, path in written.items()
        ]
    )


@contextmanager
def _new_table(w: Warehouse, base: str, schema: T.StructType) -> Iterator[tuple[str, str]]:
    """Name and folder of a new empty table that leaves the catalog afterwards; its files stay."""
    name, path = f"{base}_{uuid.uuid4().hex}", fresh_path(w.spark, base)
    tables.create_table(w.spark, name, schema, path)
    try:
        yield name, path
    finally:
        w.spark.sql(f"DROP TABLE IF EXISTS {name}")


@query
def a_append(w):
    early = F.col("order_date") < "1998-01-01"
    with _new_table(w, "staging_sales", STAGING) as (name, path):
        tables.append(w["staging_sales"].where(early), name)
        tables.append(w["staging_sales"].where(~early), name)
    return w.spark.read.schema(STAGING).parquet(path)


@query
def a_insert_ignore(w):
    schema = TABLES["dim_customer"]
    early = w["staging_sales"].where(F.col("order_date") < "1996-01-01")
    with _new_table(w, "dim_customer", schema) as (name, path):
        for batch in (early, w["staging_sales"], w["staging_sales"]):
            tables.append_new_members(batch, name, ["customer_name", "segment"], "customer_id")
    return w.spark.read.schema(schema).parquet(path)


@query
def a_load_warnings(w):
    """How often each bad cell occurs in the uncleaned file and among the broken lines."""
    paths = [fresh_path(w.spark, "raw_csv"), fresh_path(w.spark, "broken_csv")]
    csv_files.write_csv(w["raw_sales"], paths[0])
    _broken_lines(w, paths[1])
    raw = csv_files.read_raw_csv(w.spark, paths[0], multi_line=True, keep_place=True)
    broken = csv_files.read_raw_csv(w.spark, paths[1], keep_malformed=True, keep_place=True)
    found = csv_files.load_warnings(raw).unionByName(csv_files.load_warnings(broken))
    return found.groupBy("column", "raw", "reason").agg(F.count("*").alias("warnings"))


_stores: dict[tuple[str, int], Store] = {}


def _in_batches(w: Warehouse) -> Store:
    """A store, loaded once per application in batches of days: the second overlaps the first and comes twice."""
    key = (w.spark.sparkContext.applicationId, id(w))
    if key not in _stores:
        store = Store(w.spark, fresh_path(w.spark, "store"))
        day = F.col("order_date")
        second = day.between("1997-07-01", "1999-06-30")
        for batch in (day < "1998-01-01", second, second, day > "1999-06-30"):
            store.load(w["staging_sales"].where(batch))
        _stores[key] = store
    return _stores[key]


@query
def a_durable_load(w):
    """The summary, from the files alone: another store object knows nothing but the folder."""
    return Store(w.spark, _in_batches(w).root).open()["vw_sales_summary"]


@query
def a_incremental_load(w):
    dated = ("order_id", "order_date_id", "ship_date_id", "raw_product_id")
    keys = [c for c in VIEW_COLUMNS if c.endswith("_id") and c not in dated]
    return _in_batches(w).open()["vw_sales_full"].drop(*keys)


@query
def a_catalog_views(w):
    store = _in_batches(w)
    database = f"salesloom_{uuid.uuid4().hex}"
    store.register(database, 1)
    store.register(database)  # the views turn to the newest version
    found = w.spark.sql(
        f"SELECT category_name, count(*) AS row_count, sum(quantity) AS total_quantity "
        f"FROM {database}.vw_sales_full GROUP BY category_name"
    )
    found = materialize(found, "catalog_views")
    w.spark.sql(f"DROP DATABASE {database} CASCADE")  # of external tables, whose files stay
    return found


@query
def a_view(w):
    tables.create_view(w["vw_sales_full"], "vw_sales_full")
    return w.spark.sql(
        "SELECT market_name, count(*) AS row_count FROM vw_sales_full GROUP BY market_name"
    )


@query
def a_table_shape(w):
    return tables.table_shape(w["staging_sales"])


@query
def a_data_dictionary(w):
    return tables.data_dictionary({name: w[name] for name in STORED})


# --- B. cleaning ----------------------------------------------------------


@query
def b_dates(w):
    kept = {f"{c}_raw": F.col(c) for c in ("order_date", "ship_date")}
    return B.clean_dates(w["raw_sales"].withColumns(kept)).select(
        "order_id", "order_date_raw", "order_date", "ship_date_raw", "ship_date"
    )


@query
def b_date_nulls(w):
    return B.null_date_counts(w["raw_sales"])


@query
def b_numbers(w):
    kept = {f"{c}_raw": F.col(c) for c in NUMBER_COLUMNS}
    return B.clean_numbers(w["raw_sales"].withColumns(kept)).select(
        "order_id", *[x for c in NUMBER_COLUMNS for x in (f"{c}_raw", c)]
    )


@query
def b_number_errors(w):
    return B.number_error_counts(w["raw_sales"])


@query
def b_invalid_report(w):
    return B.invalid_numbers(w["raw_sales"])


@query
def b_whitespace(w):
    columns = [c for c in B.text_columns(w["raw_sales"]) if c in TEXT_COLUMNS]
    return w["raw_sales"].select(*[collapse_blanks(F.col(c)).alias(c) for c in columns])


@query_on_documents
def b_accent_fold(documents):
    texts = documents.select("doc_id", F.col("text").alias("folded"))
    return fold_accents(texts, ["folded"])


@query_on_documents
def b_is_ascii(documents):
    return documents.groupBy("lang").agg(
        F.count_if(is_ascii(F.col("text"))).alias("ascii_rows"),
        F.count_if(~is_ascii(F.col("text"))).alias("other_rows"),
    )


@query
def b_upper_codes(w):
    tidied = B.tidy_text(w["raw_sales"].select(CODE_COLUMNS), CODE_COLUMNS)
    return tidied.select(*[F.upper(c).alias(c) for c in CODE_COLUMNS])


@query
def b_proper_case(w):
    tidied = B.tidy_text(w["raw_sales"].select(NAME_COLUMNS), NAME_COLUMNS)
    return tidied.select(*[proper_case(F.col(c)).alias(c) for c in NAME_COLUMNS])


@query
def b_change_counts(w):
    return B.change_counts(w["raw_sales"].drop("year"))


@query
def b_drop_null_dates(w):
    return B.undated_share(w["raw_sales"])


@query
def b_fill_zero(w):
    return B.filled_counts(w["raw_sales"])


@query
def b_clean(w):
    return B.clean(w["raw_sales"])


# --- C. profiling ---------------------------------------------------------


@query
def c_describe(w):
    profile = C.describe(w["staging_sales"])
    return profile.select(
        "column", "count", "unique", "top", "freq",
        *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")],
    )


@query
def c_merged_profiles(w):
    """Profiles stored per market and merged: exact counts and sums, and whether estimates keep their bounds."""
    rows = w["staging_sales"]
    stored = materialize(S.profile(rows, ["market"]), "profiles")
    merged = S.estimates(S.merged(stored), [0.5])
    exact = C.distinct_counts(rows).withColumnRenamed("unique", "exact")
    numbers = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.NumericType)]
    middle = rows.select(*[F.col(c).cast("double").alias(c) for c in numbers]).unpivot([], numbers, "column", "value")
    ranked = middle.join(merged.select("column", F.col("q50").alias("q")), "column").groupBy("column").agg(
        F.avg((F.col("value") < F.col("q")).cast("int")).alias("below"),
        F.avg((F.col("value") <= F.col("q")).cast("int")).alias("reached"),
    )
    near = (F.col("below") <= 0.5 + S.RANK_ERROR) & (F.col("reached") >= 0.5 - S.RANK_ERROR)
    found = merged.join(exact, "column").join(ranked.select("column", near.alias("median_within")), "column", "left")
    within = F.abs(F.col("distinct") - F.col("exact")) <= F.col("exact") * S.DISTINCT_ERROR
    return found.select(
        "column", "rows", "missing", money(F.col("total"), 2).alias("total"), within.alias("distinct_within"), "median_within"
    )


@query
def c_missing(w):
    return C.missing(w["raw_sales"])


@query
def c_nunique(w):
    return C.distinct_counts(w["raw_sales"])


@query
def c_dtypes(w):
    return C.data_types(w["staging_sales"])


@query
def c_preview(w):
    return C.preview(w["staging_sales"], STAGING.names)


@query
def c_sample(w):
    return C.seeded_sample(w["staging_sales"], STAGING.names)


@query
def c_unique_text(w):
    return C.unique_texts(w["raw_sales"], TEXT_COLUMNS)


@query
def c_unique_text_counts(w):
    return C.unique_text_counts(w["raw_sales"], TEXT_COLUMNS)


@query
def c_digit_profile(w):
    return C.digit_profile(B.clean_numbers(w["raw_sales"].select(NUMBER_COLUMNS)), NUMBER_COLUMNS)


@query
def c_id_name_conflicts(w):
    return C.id_name_conflicts(w["raw_sales"])


@query
def c_audit_compare(w):
    return C.compare_audits(w["raw_sales"], w["clean_sales"])


@query
def c_row_order_counts(w):
    return C.row_and_order_counts(w["staging_sales"])


@query
def c_exact_duplicates(w):
    return C.exact_duplicates(with_repeated_lines(w["staging_sales"]), DUPLICATE_KEY)


# --- D. dimensional model -------------------------------------------------


@query
def d_series(w):
    days = H.day_span(w["staging_sales"], ["order_date", "ship_date"])
    first = w["staging_sales"].agg(F.least(F.min("order_date"), F.min("ship_date"))).scalar()
    return days.select(F.datediff("date_id", first).alias("n"), "date_id")


@query
def d_calendar(w):
    return w["dim_date"]


@query
def d_customer(w):
    return w["dim_customer"]


@query
def d_market(w):
    return w["dim_market"]


@query
def d_category(w):
    return w["dim_category"]


@query
def d_region(w):
    return w["dim_region"]


@query
def d_country(w):
    return w["dim_country"]


@query
def d_state(w):
    return w["dim_state"]


@query
def d_sub_category(w):
    return w["dim_sub_category"]


@query
def d_geography_closure(w):
    return H.closure(w["flat_geography"], V.GEOGRAPHY)


@query
def d_product_closure(w):
    return H.closure(w["flat_product"], ["category", "sub_category", "product"])


@query
def d_product(w):
    return w["dim_product"]


@query
def d_fact(w):
    return w["fact_sales"]


@query
def d_keys(w):
    return w["fact_sales"].agg(
        F.count("*").alias("rows"),
        F.min("sales_id").alias("first_key"),
        F.max("sales_id").alias("last_key"),
        F.count_distinct("sales_id").alias("distinct_keys"),
    )


@query
def d_fanout_audit(w):
    paths = materialize(
        w["staging_sales"].select(V.GEOGRAPHY).na.drop().distinct(), "geography_paths"
    )
    return H.false_children(paths, V.GEOGRAPHY)


# --- E. joins -------------------------------------------------------------


@query
def e_inner(w):
    return (
        w["fact_sales"]
        .join(w["dim_customer"], "customer_id")
        .select("sales_id", "order_id", "customer_name", "sales")
    )


@query
def e_composite_chain(w):
    """Each dimension joined on its natural name plus parent key, one join per level."""
    return (
        w["staging_sales"]
        .join(w["dim_market"].withColumnRenamed("market_name", "market"), "market")
        .join(w["dim_region"].withColumnRenamed("region_name", "region"), ["region", "market_id"])
        .join(w["dim_country"].withColumnRenamed("country_name", "country"),
              ["country", "region_id"])
        .join(w["dim_state"].withColumnRenamed("state_name", "state"), ["state", "country_id"])
        .join(w["dim_customer"], ["customer_name", "segment"])
        .join(
            w["dim_product"].select(
                F.col("product_id").alias("product_key"),
                F.col("raw_product_id").alias("product_id"),
                "product_name",
            ),
            ["product_id", "product_name"],
        )
        .select("order_id", "state_id", "customer_id", "product_key", "sales")
    )


@query
def e_left_chain(w):
    """The row-level view joined afresh from its base tables."""
    return V.sales_full(w).select(
        "sales_id", "order_year", "ship_year", "customer_name", "state_name", "country_name",
        "region_name", "market_name", "product_name", "sub_category_name", "category_name",
    )


@query
def e_role_playing(w):
    days = w["dim_date"]
    ordered = days.select(F.col("date_id").alias("order_date_id"), F.col("year").alias("order_year"))
    shipped = days.select(F.col("date_id").alias("ship_date_id"), F.col("year").alias("ship_year"))
    return (
        w["fact_sales"]
        .join(ordered, "order_date_id", "left")
        .join(shipped, "ship_date_id", "left")
        .groupBy("order_year", "ship_year")
        .agg(F.count("*").alias("row_count"))
    )


@query
def e_snowflake_agg(w):
    return (
        V.sales_joined(w)
        .groupBy("market_name", "category_name")
        .agg(F.count("*").alias("row_count"), money(F.sum("sales")).alias("total_sales"))
    )


@query_with_short_calendar
def e_anti(w):
    """Staging rows without an equal fact row; both sides reduced to distinct rows first."""
    staging = J.staging_lines(w).groupBy(J.COMPARED).agg(F.count("*").alias("row_count"))
    return staging.join(J.fact_lines(w).distinct(), J.COMPARED, "left_anti")


@query_with_short_calendar
def e_left_null(w):
    used = w["fact_sales"].groupBy("ship_date_id").agg(F.count("*").alias("row_count"))
    days = w["dim_date"].select(F.col("date_id").alias("ship_date_id"), "year")
    return used.join(days, "ship_date_id", "left").where("year is null").drop("year")


@query_with_short_calendar
def e_match_rate(w):
    """Orders per year with how many of them reached the fact."""
    placed = w["staging_sales"].select("order_id", F.year("order_date").alias("year")).distinct()
    loaded = w["fact_sales"].select("order_id", F.lit(1).alias("hit")).distinct()
    return (
        placed.join(loaded, "order_id", "left")
        .groupBy("year")
        .agg(F.count("*").alias("orders"), F.count("hit").alias("matched"))
    )


@query_with_short_calendar
def e_cross_one_row(w):
    """Two one-row aggregates set against each other."""
    layers = J.union_all(
        [
            w[name].agg(
                F.lit(name).alias("source"),
                F.count("*").alias("row_count"),
                F.sum("sales").alias("total_sales"),
            )
            for name in ("staging_sales", "fact_sales")
        ]
    )
    difference = [("staging - fact", "staging_sales", "fact_sales")]
    return J.with_differences(layers, ["row_count", "total_sales"], difference)


@query
def e_semi(w):
    return C.id_name_conflicts(w["staging_sales"])


# --- F. aggregations ------------------------------------------------------


@query
def f_count(w):
    return w["fact_sales"].groupBy("ship_mode").agg(F.count("*").alias("row_count"))


@query
def f_count_distinct(w):
    return J.distinct_profile(w["fact_sales"], "fact_sales")


@query
def f_distinct_concat(w):
    joined = F.concat("order_id", F.lit("-"), "raw_product_id")
    return w["vw_sales_full"].agg(
        F.count_distinct(joined).alias("joined_text"),
        F.count_distinct("order_id", "raw_product_id").alias("pairs"),
    )


@query
def f_distinct_case(w):
    discounted = F.when(F.col("discount") > 0, F.col("order_id"))
    return w["vw_sales_full"].groupBy("segment").agg(
        F.count_distinct(discounted).alias("discounted_orders")
    )


@query
def f_sum(w):
    return w["vw_sales_full"].groupBy("market_name", "order_year").agg(
        money(F.sum("sales")).alias("total_sales"),
        F.sum("quantity").alias("total_quantity"),
        money(F.sum("profit"), 5).alias("total_profit"),
        money(F.sum("shipping_cost")).alias("total_shipping_cost"),
    )


@query
def f_sum_case(w):
    return w["vw_sales_full"].groupBy("market_name").agg(
        F.count_if(F.col("profit") < 0).alias("loss_rows"),
        F.count_if(F.col("ship_year").isNull()).alias("no_ship_year"),
    )


@query
def f_min_max(w):
    return w["vw_sales_full"].groupBy("market_name").agg(
        F.min("order_date_id").alias("first_order"),
        F.max("order_date_id").alias("last_order"),
        F.min("sales").alias("min_sales"),
        F.max("sales").alias("max_sales"),
    )


@query
def f_avg(w):
    return w["vw_sales_full"].groupBy("segment").agg(
        ratio(F.sum("sales"), F.count("sales"), 4).alias("avg_sales"),
        F.round(F.avg(F.col("quantity").cast("double")), 4).alias("avg_quantity"),
    )


@query
def f_group_concat(w):
    return w["fact_sales"].groupBy("order_id").agg(
        F.expr("listagg(DISTINCT ship_mode, ',') WITHIN GROUP (ORDER BY ship_mode)").alias(
            "ship_modes"
        )
    )


_clustered: dict[tuple[str, int, str], str] = {}


def _by_order(w: Warehouse, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Rows stored in buckets of orders, once per warehouse and application."""
    key = (w.spark.sparkContext.applicationId, id(w), label)
    if key not in _clustered:
        name = f"{label}_{uuid.uuid4().hex}"
        buckets = int(w.spark.conf.get("spark.sql.shuffle.partitions"))
        tables.create_clustered(build(), name, "order_id", buckets, fresh_path(w.spark, name))
        _clustered[key] = name
    return w.spark.table(_clustered[key])


def _fact_by_order(w: Warehouse) -> DataFrame:
    return _by_order(w, "fact_by_order", lambda: w["fact_sales"])


@query
def f_group_concat_clustered(w):
    return _fact_by_order(w).groupBy("order_id").agg(
        F.array_join(F.array_sort(F.collect_set("ship_mode")), ",").alias("ship_modes")
    )


@query
def f_two_level_clustered(w):
    lines = _fact_by_order(w).groupBy("order_id").agg(F.count("*").alias("lines"))
    return lines.groupBy("lines").agg(F.count("*").alias("orders"))


@query
def j11_repeated_lines_clustered(w):
    loaded = lambda: V.load_fact(with_repeated_lines(w["staging_sales"]), w, *w.calendar)
    return J.repeated_lines(_by_order(w, "repeated_by_order", loaded))


@query
def f_reaggregate_sketch(w):
    """Distinct orders per category, exact, and whether the stored sketches' estimate is within 5 %."""
    exact = K.distinct_orders(w["vw_sales_full"], ["category_name"])
    estimate = K.distinct_orders_from_sketch(w["summary_sketches"], ["category_name"])
    both = exact.join(estimate.withColumnRenamed("distinct_orders", "estimate"), "category_name")
    within = F.abs(F.col("estimate") - F.col("distinct_orders")) <= F.col("distinct_orders") * 0.05
    return both.select("category_name", "distinct_orders", within.alias("within"))


@query
def f_many_keys(w):
    return V.sales_joined(w).groupBy(SUMMARY_KEYS).agg(
        F.count("*").alias("row_count"), F.sum("quantity").alias("total_quantity")
    )


@query
def f_alias_key(w):
    banded = w["fact_sales"].withColumn("band", K.discount_band(F.col("discount")))
    return banded.groupBy("band").agg(F.count("*").alias("row_count"))


@query
def f_having(w):
    return (
        w["vw_sales_full"]
        .groupBy("raw_product_id")
        .agg(F.count("*").alias("row_count"), F.sum("quantity").alias("total_quantity"))
        .where("row_count > 25 and total_quantity > 600")
    )


@query
def f_two_level(w):
    """How many orders have one line, two lines and so on."""
    lines = w["fact_sales"].groupBy("order_id").agg(F.count("*").alias("lines"))
    return lines.groupBy("lines").agg(F.count("*").alias("orders"))


@query
def f_ratio(w):
    return w["vw_sales_full"].groupBy("segment", "order_year").agg(
        ratio(F.sum("profit"), F.sum("sales"), 4).alias("margin")
    )


@query
def f_agg_arith(w):
    lines = w["vw_sales_full"].groupBy("market_name", "order_id").agg(F.count("*").alias("n"))
    return lines.groupBy("market_name").agg(
        F.sum(F.col("n") - 1).alias("extra_lines"),
        (F.max("n") - F.min("n")).alias("line_spread"),
    )


@query
def f_reaggregate(w):
    """The added-up order count beside the true one."""
    added = w["vw_sales_summary"].groupBy("category_name").agg(
        F.sum("order_count").alias("summed_orders")
    )
    return added.join(K.distinct_orders(w["vw_sales_full"], ["category_name"]), "category_name")


@query
def f_dedup(w):
    pairs = w["staging_sales"].select("product_id", "product_name").dropDuplicates()
    return pairs.groupBy("product_name").agg(
        F.count("*").alias("pairs"), F.count_distinct("product_id").alias("ids")
    )


# --- G. scalar functions --------------------------------------------------


@query
def g_date_parts(w):
    days = w["staging_sales"].groupBy("order_date").agg(F.max("ship_date").alias("last_ship"))
    return days.select(
        "order_date",
        *calendar_columns(F.col("order_date")),
        F.dayofweek("order_date").alias("dow"),
        F.date_add("order_date", 30).alias("due"),
        F.datediff("last_ship", "order_date").alias("longest_days"),
    )


@query
def g_math(w):
    saved = F.col("sales") * F.col("discount")
    return w["fact_sales"].select(
        "sales_id",
        F.round(saved, 2).alias("saved"),
        F.round(F.col("sales") - F.col("shipping_cost"), 0).alias("net"),
        F.round(F.col("profit"), 1).alias("profit_1"),
    )


@query
def g_null(w):
    return w["raw_sales"].groupBy("order_priority").agg(
        F.count_if(F.col("discount").isNull()).alias("no_discount"),
        F.count(F.nullif("quantity", F.lit(""))).alias("with_quantity"),
        F.count_if(F.coalesce("shipping_cost", F.lit("0")) == "0").alias("zero_or_missing_cost"),
    )


@query
def g_case(w):
    size = F.when(F.col("quantity") <= 10, "small").when(F.col("quantity") <= 30, "medium")
    return w["fact_sales"].groupBy(size.otherwise("large").alias("order_size")).agg(
        F.count("*").alias("row_count"),
        F.sum(F.when(F.col("profit") < 0, 1).otherwise(0)).alias("loss_rows"),
    )


@query
def g_string(w):
    return w["vw_sales_full"].groupBy("market_name", "segment").agg(
        whole_number_text(F.sum("sales")).alias("sales_text"),
    ).select(
        F.concat("market_name", F.lit(" - "), "segment").alias("label"),
        F.upper("segment").alias("upper"),
        F.length("segment").alias("length"),
        F.split_part("segment", F.lit("U"), F.lit(1)).alias("head"),
        "sales_text",
    )


@query
def g_field_order(w):
    listed = F.array(F.lit("Second Class"), F.lit("First Class"))
    return (
        w["fact_sales"]
        .groupBy("ship_mode")
        .agg(F.count("*").alias("row_count"))
        .withColumn("position", F.array_position(listed, F.col("ship_mode")))
    )


@query
def g_predicates(w):
    is_mode = F.col("ship_mode").isin("First Class", "Second Class")
    return w["vw_sales_full"].groupBy("market_name").agg(
        F.count_if(F.col("order_date_id").between("1997-01-01", "1998-12-31")).alias("in_range"),
        F.count_if(is_mode & (F.col("quantity") <= 25)).alias("few_and_fast"),
        F.count_if(F.col("ship_year").isNull() | (F.col("discount") == 0)).alias("either"),
    )


@query
def g_subqueries(w):
    """Products that sell more than the average product, from an uncorrelated scalar subquery."""
    sold = w["vw_sales_full"].groupBy("raw_product_id").agg(F.sum("sales").alias("total_sales"))
    average = sold.agg(F.sum("total_sales").cast("double") / F.count("*")).scalar()
    return sold.where(F.col("total_sales").cast("double") > average)


# --- H. sort, limit, set operations ---------------------------------------


@query
def h_order(w):
    return (
        w["vw_sales_full"]
        .groupBy("market_name", "country_name")
        .agg(money(F.sum("sales")).alias("total_sales"))
        .orderBy("market_name", "country_name")
    )


@query
def h_order_alias(w):
    return (
        w["vw_sales_full"]
        .groupBy("country_name")
        .agg(money(F.sum("profit")).alias("total_profit"))
        .orderBy(F.desc("total_profit"))
    )


@query
def h_custom_order(w):
    counts = w["fact_sales"].groupBy("order_priority").agg(F.count("*").alias("row_count"))
    order = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return J.in_listed_order(counts, "order_priority", order)


@query
def h_limit(w):
    return w["fact_sales"].orderBy("sales_id").limit(10)


@query
def h_top_k(w):
    return L.top_members(w["vw_sales_full"], ["sub_category_name"], 5)


@query
def h_union_all(w):
    return J.row_counts(w, STORED)


@query
def h_union_distinct(w):
    early = w["staging_sales"].where("order_date < '1999-01-01'").select("customer_name", "segment")
    late = w["staging_sales"].where("order_date >= '1997-01-01'").select("customer_name", "segment")
    return early.union(late).distinct()


# --- J. quality -----------------------------------------------------------


def _with(w: Warehouse, **changed: DataFrame) -> dict[str, DataFrame]:
    names = [*STORED, "flat_geography", "flat_product", "vw_sales_full", "vw_sales_summary"]
    return {name: changed[name] if name in changed else w[name] for name in names}


def _one_market_short(w: Warehouse) -> dict[str, DataFrame]:
    """The warehouse after one market's staging rows were lost."""
    return _with(w, staging_sales=w["staging_sales"].where("market <> 'AFRICA'"))


def _one_market_twice(w: Warehouse) -> dict[str, DataFrame]:
    return _with(w, staging_sales=with_repeated_lines(w["staging_sales"]))


@query_with_short_calendar
def j01_loading_gaps(w):
    return J.loading_gaps(w)


@query_with_short_calendar
def j01_loading_gaps_by_digest(w):
    return J.loading_gaps(w, by_digest=True)


@query
def j02_phantom_rows_by_digest(w):
    return J.phantom_rows(w, by_digest=True)


@query
def j02_phantom_rows_by_digest_planted(w):
    return J.phantom_rows(_one_market_short(w), by_digest=True)


@query
def j03_multiset_difference_by_digest(w):
    return J.multiset_difference(w, by_digest=True)


@query
def j03_multiset_difference_by_digest_planted(w):
    return J.multiset_difference(_one_market_twice(w), by_digest=True)


@query_with_short_calendar
def j03_layer_digests(w):
    found = J.layer_digests(w)
    # The number of differing leaves depends on the hash; that there are some does not.
    return found.select("level", "period", "left_rows", "right_rows", (F.col("differing") > 0).alias("differs"))


@query
def j02_phantom_rows(w):
    return J.phantom_rows(w)


@query
def j02_phantom_rows_planted(w):
    return J.phantom_rows(_one_market_short(w))


@query
def j03_multiset_difference(w):
    return J.multiset_difference(w)


@query
def j03_multiset_difference_planted(w):
    return J.multiset_difference(_one_market_twice(w))


@query_with_short_calendar
def j04_layer_totals(w):
    return J.layer_totals(w)


@query
def j05_distinct_comparison(w):
    return J.distinct_comparison(w)


@query_with_short_calendar
def j06_load_overview(w):
    return J.load_overview(w)


@query_with_short_calendar
def j07_key_orphans(w):
    return J.key_orphans(w)


@query
def j08_product_conflict_summary(w):
    return J.product_conflict_summary(w)


@query
def j09_product_conflicts(w):
    return J.product_conflicts(w)


@query_with_short_calendar
def j10_order_match(w):
    return J.order_match(w)


@query
def j11_repeated_lines(w):
    loaded = V.load_fact(with_repeated_lines(w["staging_sales"]), w, *w.calendar)
    return J.repeated_lines_report(loaded)


@query
def j11_repeated_lines_all(w):
    loaded = V.load_fact(with_repeated_lines(w["staging_sales"]), w, *w.calendar)
    return J.repeated_lines(loaded)


@query
def j12_geography_chain(w):
    return J.geography_chain(w)


@query
def j12_product_chain(w):
    return J.product_chain(w)


@query
def j13_fact_kpis(w):
    return J.fact_kpis(w["fact_sales"])


@query
def j14_view_counts(w):
    return J.row_counts(w, ["vw_sales_full", "vw_sales_summary"])


# --- K. views and analyst queries -----------------------------------------


@query
def k01_sales_full(w):
    return w["vw_sales_full"]


@query
def k02_sales_summary(w):
    return w["vw_sales_summary"]


@query
def k03_product_by_month(w):
    return K.product_by_month(w["vw_sales_full"])


@query
def k04_product_by_year(w):
    return K.product_by_year(w["vw_sales_full"])


@query
def k05_product_totals(w):
    return K.product_totals(w["vw_sales_full"])


@query
def k06_geography_by_category(w):
    return K.geography_by_category(w["vw_sales_full"])


@query
def k07_category_margin(w):
    return K.category_margin(w["vw_sales_summary"])


@query
def k08_discount_bands(w):
    return K.discount_bands(w["vw_sales_full"])


@query
def k09_category_check(w):
    return K.category_check(w["vw_sales_summary"])


@query
def k10_kpi_cards(w):
    return K.kpi_cards(w["vw_sales_summary"])


# --- L. dashboard ---------------------------------------------------------


def last_year(w: Warehouse) -> int:
    """The year the dashboard shows: the latest one with orders."""
    return w["vw_sales_full"].agg(F.max("order_year").alias("y")).first()["y"]


@query
def l1_year_over_year(w):
    return L.year_over_year(w["vw_sales_full"])


@query
def l2_monthly_trend(w):
    return L.monthly_trend(w["vw_sales_full"])


@query
def l3_category_share(w):
    return L.category_share(w["vw_sales_full"])


@query
def l3_category_share_of_year(w):
    return L.category_share(w["vw_sales_full"], year=last_year(w))


@query
def l4_top_products_and_customers(w):
    return L.top_products_and_customers(w["vw_sales_full"])


@query
def l4_top_products_and_customers_of_year(w):
    return L.top_products_and_customers(w["vw_sales_full"], year=last_year(w))


@query
def l5_largest_gains(w):
    return L.largest_gains(w["vw_sales_full"], last_year(w))


@query
def l6_drill_down(w):
    return L.drill_down(w["vw_sales_full"])


@query
def l6_roll_up_by_closure(w):
    return L.roll_up(w["fact_sales"], H.closure(w["flat_geography"], V.GEOGRAPHY), "state_id")


@query
def l6_drill_down_of_year(w):
    return L.drill_down(w["vw_sales_full"], year=last_year(w))


@query
def l7_high_discount_losses(w):
    return L.high_discount_losses(w["vw_sales_full"])


@query
def l7_high_discount_losses_of_year(w):
    return L.high_discount_losses(w["vw_sales_full"], year=last_year(w))


@query
def l8_growth_risk(w):
    return L.growth_risk(w["vw_sales_full"])


@query
def l9_segment_analysis(w):
    return L.segment_analysis(w["vw_sales_full"])
