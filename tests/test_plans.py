"""Physical plans: what is read, what is shuffled, what is broadcast."""

import pytest
from conftest import SF_DIR as SF
from pyspark.sql import functions as F

from salesloom.operators import profiling
from salesloom.plans import analytics, dashboard, quality, views
from salesloom.plans.warehouse import warehouse


@pytest.fixture(scope="module")
def w(spark, sf_dir):
    return warehouse(spark, sf_dir)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("build", [views.sales_full, views.sales_summary])
def test_small_dimensions_do_not_shuffle_the_fact(w, build):
    plan = physical(build(w))
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_dimensions_too_large_to_broadcast_are_joined_by_shuffle(spark, w):
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
        plan = physical(views.sales_full(w))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_results_do_not_depend_on_the_join_strategy(spark, w):
    def rows():
        return sorted(map(str, views.sales_summary(w).collect()))

    broadcast = rows()
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        shuffled = rows()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert broadcast == shuffled


def test_discount_bands_read_three_columns(w):
    plan = physical(analytics.discount_bands(w["vw_sales_full"]))
    assert "ReadSchema: struct<sales:decimal(18,2),discount:decimal(6,5),profit:decimal(18,5)>" in plan


def test_reconciliation_shuffles_once_before_the_report(w):
    plan = physical(quality.multiset_difference(w))
    assert plan.count("Exchange hashpartitioning") == 1


def test_date_filter_reaches_the_scan(w):
    plan = physical(views.load_fact(w["staging_sales"], w, *w.calendar))
    assert f"GreaterThanOrEqual(order_date,{w.calendar[0]})" in plan


def test_cleaning_needs_no_shuffle(w):
    from salesloom.operators.cleaning import clean

    plan = physical(clean(w["raw_sales"]))
    assert "Exchange" not in plan and "Python" not in plan


def test_the_year_of_a_dashboard_reaches_the_scan(w):
    view = w["vw_sales_full"]
    year = view.agg({"order_year": "max"}).first()[0]
    for df in (dashboard.category_share(view, year), dashboard.drill_down(view, year)):
        assert "PartitionFilters: [isnotnull(order_year" in physical(df) and f"= {year})" in physical(df)
    assert "order_year" in physical(dashboard.largest_gains(view, year)).split("PartitionFilters: [")[1].split("]")[0]


def test_fact_holds_every_staging_row(w):
    assert w["fact_sales"].count() == w["staging_sales"].count()


def test_exact_duplicates_sort_by_more_than_their_count(w):
    plan = physical(profiling.exact_duplicates(w["staging_sales"], ["order_id", "product_id"]))
    assert "rangepartitioning(cnt" in plan and "order_id" in plan.split("rangepartitioning(")[1].split(")")[0]


def test_distinct_counts_multiply_no_rows(w):
    plan = physical(quality.distinct_comparison(w))
    assert "Expand" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_cleaning_is_done_by_many_tasks(w):
    from salesloom.operators.cleaning import clean

    assert clean(w["raw_sales"]).rdd.getNumPartitions() > 1 and w["staging_sales"].rdd.getNumPartitions() > 1


def test_orders_in_buckets_are_grouped_without_a_shuffle(w):
    from salesloom import queries

    lines = queries._fact_by_order(w).groupBy("order_id").count()
    assert "Exchange" not in physical(lines)
    assert "Exchange" not in physical(queries.QUERIES["f_group_concat_clustered"](w.spark, SF))
    assert "Exchange" not in physical(queries.QUERIES["j11_repeated_lines_clustered"](w.spark, SF))


def below(df, join: str) -> str:
    """The part of the optimized plan under the join on a column."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    top = next(i for i, line in enumerate(lines) if "Join" in line and join in line)
    end = next((i for i in range(top + 1, len(lines)) if depth(lines[i]) <= depth(lines[top])), len(lines))
    return "\n".join(lines[top:end])


def test_the_view_shuffles_fact_rows_before_they_grow(w):
    assert "order_month_name" not in below(views.sales_full(w), "LeftOuter, (customer_id#")
    assert "order_month_name" not in below(views.sales_full(w), "LeftOuter, (product_id#")


def test_summary_of_the_written_view_equals_that_of_the_fact(w):
    summary, view = views.sales_summary(w), views.summary_of_view(w["vw_sales_full"])
    assert summary.exceptAll(view).isEmpty() and view.exceptAll(summary).isEmpty()
    nowhere = w["vw_sales_full"].withColumn("state_name", F.lit(None).cast("string"))
    assert views.summary_of_view(nowhere).isEmpty()
