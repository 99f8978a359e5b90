"""A small sound warehouse, then one fault at a time."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from salesloom.functions.text import ignore_case_and_accents
from salesloom.plans import analytics, quality, views
from salesloom.plans.warehouse import Warehouse
from salesloom.schemas import STAGING

D = decimal.Decimal
NAMES = ["staging_sales", "dim_date", "dim_customer", "dim_market", "dim_region", "dim_country",
         "dim_state", "dim_category", "dim_sub_category", "dim_product", "fact_sales"]


def line(order, day, product="P1", name="pen", sales="10", profit="2", **other):
    row = {"order_id": order, "order_date": datetime.date(2012, 1, day),
           "ship_date": datetime.date(2012, 1, day + 2), "ship_mode": "First Class",
           "customer_name": "Al", "segment": "Consumer", "state": "S1", "country": "C1",
           "market": "M1", "region": "NORTH", "product_id": product, "category": "Office",
           "sub_category": "Paper", "product_name": name, "sales": D(sales), "quantity": 2,
           "discount": D("0.1"), "profit": None if profit is None else D(profit),
           "shipping_cost": D("1"), "order_priority": "Low"} | other
    return tuple(row[c] for c in STAGING.names)


LINES = [line("O1", 1), line("O1", 1), line("O2", 2, "P1", "ink"), line("O3", 3, "P2", "pen"),
         line("O4", 4, profit="-5", market="M2", country="C2")]


@pytest.fixture(scope="module")
def sound(spark):
    w = Warehouse(spark, lambda: spark.createDataFrame(LINES, STAGING), ("2011-01-01", "2020-12-31"))
    return {name: w[name] for name in [*NAMES, "vw_sales_full", "vw_sales_summary"]}


def changed_fact(tables, fact):
    changed = tables | {"fact_sales": fact}
    return changed | {"vw_sales_full": views.sales_full(changed),
                      "vw_sales_summary": views.sales_summary(changed)}


def by_key(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_sound_load_is_clean(sound):
    assert quality.loading_gaps(sound).count() == 0
    assert quality.phantom_rows(sound).count() == 0
    assert quality.multiset_difference(sound).count() == 0
    totals = by_key(quality.layer_totals(sound))
    assert totals["difference (staging - fact)"] == (0, 0.0, 0, 0.0, 0)
    assert totals["difference (staging - view)"] == (0, 0.0, 0, 0.0, 0)
    assert set(by_key(quality.distinct_comparison(sound))["difference (fact - view)"]) == {0}
    assert all(n == (0,) for n in by_key(quality.key_orphans(sound)).values())
    assert [tuple(r)[1:] for r in quality.order_match(sound).collect()] == [(4, 4, 0)]


def test_report_order(sound):
    assert [r["source"] for r in quality.layer_totals(sound).collect()] == [
        "staging_sales", "fact_sales", "vw_sales_full", "difference (staging - fact)",
        "difference (staging - view)"]


def test_lost_row(sound):
    broken = changed_fact(sound, sound["fact_sales"].where("order_id <> 'O2'"))
    assert [r["order_id"] for r in quality.loading_gaps(broken).collect()] == ["O2"]
    assert by_key(quality.layer_totals(broken))["difference (staging - fact)"][0] == 1
    assert quality.order_match(broken).first()["match_rate"] == "75.00%"


def test_changed_measure_shows_on_both_sides(sound):
    wrong = F.when(F.col("order_id") == "O2", F.col("sales") + 1).otherwise(F.col("sales"))
    broken = changed_fact(sound, sound["fact_sales"].withColumn("sales", wrong.cast("decimal(18,2)")))
    assert quality.loading_gaps(broken).count() == 1
    assert quality.phantom_rows(broken).count() == 1


def test_lost_copy_is_seen_by_counts_only(sound):
    broken = changed_fact(sound, sound["fact_sales"].where("sales_id <> 1"))
    assert quality.loading_gaps(broken).count() == 0
    assert [r["delta"] for r in quality.multiset_difference(broken).collect()] == [1]


def test_gap_keeps_every_copy(sound):
    broken = changed_fact(sound, sound["fact_sales"].where("order_id <> 'O1'"))
    assert quality.loading_gaps(broken).count() == 2


def test_unknown_keys(sound):
    stray = sound["fact_sales"].where("order_id = 'O3'").withColumns(
        {"customer_id": F.lit(99).cast("long"), "product_id": F.lit(98).cast("long"),
         "state_id": F.lit(97).cast("long"),
         "ship_date_id": F.lit("2031-01-01").cast("date"), "sales_id": F.lit(6).cast("long")})
    broken = changed_fact(sound, sound["fact_sales"].unionByName(stray))
    assert by_key(quality.key_orphans(broken)) == {
        "order_date orphans": (0,), "ship_date orphans": (1,), "customer orphans": (1,),
        "state orphans": (1,), "product orphans": (1,)}
    assert by_key(quality.product_conflicts(broken))["4 fact without product"] == (1,)
    assert broken["vw_sales_full"].count() == 6
    assert broken["vw_sales_summary"].agg(F.sum("total_qty")).first()[0] == 10


def test_null_measure_under_both_equalities(spark):
    rows = [line("O1", 1, profit=None)]
    w = Warehouse(spark, lambda: spark.createDataFrame(rows, STAGING), ("2011-01-01", "2020-12-31"))
    assert quality.loading_gaps(w).count() == 1 and quality.phantom_rows(w).count() == 1
    assert quality.loading_gaps(w, null_safe=True).count() == 0
    assert quality.phantom_rows(w, null_safe=True).count() == 0


def test_date_outside_the_calendar_is_a_gap(spark):
    rows = [line("O1", 1), line("O9", 1, order_date=datetime.date(2021, 1, 1))]
    w = Warehouse(spark, lambda: spark.createDataFrame(rows, STAGING), ("2011-01-01", "2020-12-31"))
    assert [r["order_id"] for r in quality.loading_gaps(w).collect()] == ["O9"]
    overview = {r["item"]: r["row_count"] for r in quality.load_overview(w).collect()}
    assert overview["staging - fact"] == 1 and overview["2011-01-01 ~ 2020-12-31"] == 3653


def test_conflicts(sound):
    assert tuple(quality.product_conflict_summary(sound).first()) == (1, 1, 1)
    assert by_key(quality.product_conflicts(sound)) == {
        "1 id with several names": (1,), "2 name with several ids": (1,),
        "3 repeated id and name pair": (0,), "4 fact without product": (0,)}


def test_repeated_lines(sound):
    row = quality.repeated_lines(sound["fact_sales"]).first()
    assert (row["order_id"], row["line_count"], row["total_sales"]) == ("O1", 2, D("20.00"))


def test_same_region_name_in_two_markets_stays_two_members(sound):
    assert sound["dim_region"].count() == 2 and sound["dim_state"].count() == 2


def test_missing_discount_counts_as_high(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.3,), (0.31,), (None,)], "d double")
    bands = [r[0] for r in df.select(
        analytics.discount_band(F.col("d").cast("decimal(6,5)")).alias("b")).collect()]
    assert bands == ["No Discount", "Low (0–10%)", "Medium (11–30%)", "High (>30%)", "High (>30%)"]


def test_sketch_counts_orders_across_groups(sound):
    summary = views.sales_summary(sound, with_sketch=True)
    merged = by_key(analytics.distinct_orders_from_sketch(summary, ["category_name"]))
    assert merged == by_key(analytics.distinct_orders(sound["vw_sales_full"], ["category_name"]))


def test_tables_are_read_back_without_lineage(sound):
    plan = sound["fact_sales"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("\n") <= 1 and "parquet" in plan


def test_spellings_can_be_one_member(spark):
    rows = [line("O1", 1), line("O2", 2, customer_name="ÁL"), line("O3", 3, customer_name="al")]
    staging = spark.createDataFrame(rows, STAGING)
    exact = Warehouse(spark, lambda: staging, ("2011-01-01", "2020-12-31"))
    assert exact["dim_customer"].count() == 3
    loose = Warehouse(
        spark,
        lambda: ignore_case_and_accents(staging, ["customer_name"]),
        ("2011-01-01", "2020-12-31"),
    )
    assert loose["dim_customer"].count() == 1 and loose["fact_sales"].count() == 3


FAULTS = {
    "sound": lambda t: t,
    "lost row": lambda t: t | {"fact_sales": t["fact_sales"].where("order_id <> 'O2'")},
    "lost copy": lambda t: t | {"fact_sales": t["fact_sales"].where("sales_id <> 1")},
    "changed measure": lambda t: t | {"fact_sales": t["fact_sales"].withColumn("quantity", F.expr("if(order_id = 'O3', 9, quantity)"))},
    "moved to another day": lambda t: t | {"fact_sales": t["fact_sales"].withColumn(
        "order_date_id", F.expr("if(sales_id = 1, date'2012-01-09', order_date_id)"))},
    "equal on one day, lost on another": lambda t: t | {"staging_sales": t["staging_sales"].unionAll(
        t["staging_sales"].where("order_id = 'O2'").withColumn("order_date", F.expr("date'2012-01-20'")))},
    "NULL on both sides": lambda t: t | {
        "fact_sales": t["fact_sales"].withColumn("profit", F.expr("if(order_id = 'O4', null, profit)")),
        "staging_sales": t["staging_sales"].withColumn("profit", F.expr("if(order_id = 'O4', null, profit)"))},
    "NULL day": lambda t: t | {"staging_sales": t["staging_sales"].withColumn(
        "order_date", F.expr("if(order_id = 'O2', null, order_date)"))},
    "NULL in another column": lambda t: t | {
        "fact_sales": t["fact_sales"].withColumn("sales", F.expr("if(order_id = 'O3', null, sales)")).withColumn(
            "shipping_cost", F.lit(10).cast("decimal(18,2)")),
        "staging_sales": t["staging_sales"].withColumn("shipping_cost", F.expr("if(order_id = 'O3', null, sales)"))},
}


@pytest.mark.parametrize("fault", FAULTS)
def test_digests_find_what_comparing_all_rows_finds(sound, fault):
    tables = FAULTS[fault](sound)
    rows = lambda df: sorted(map(str, df.collect()))
    for report in (quality.loading_gaps, quality.phantom_rows):
        for null_safe in (False, True) if "NULL on" in fault else (False,):
            assert rows(report(tables, null_safe, by_digest=True)) == rows(report(tables, null_safe))
    assert rows(quality.multiset_difference(tables, by_digest=True)) == rows(quality.multiset_difference(tables))


def test_equal_layers_move_no_row(sound):
    from salesloom.operators.reconcile import differing_counts

    counts = differing_counts(*quality._dated_lines(sound), quality.COMPARED, quality.DAY)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    read = [part.split(">")[0] for part in plan.split("ReadSchema: ")[1:]]
    assert read and not any("order_date" in r for r in read)  # only rows with a NULL are looked for
    assert counts.count() == 0
    tree = {(r["level"], r["period"]): tuple(r)[2:] for r in quality.layer_digests(sound).collect()}
    assert tree[1, "all"] == (5, 5, 0) and tree[2, "2012"] == (5, 5, 0) and tree[4, "2012-01-01"] == (2, 2, 0)


def test_digests_show_where_layers_differ(sound):
    tree = quality.layer_digests(FAULTS["changed measure"](sound)).collect()
    assert {(r["level"], r["period"]) for r in tree if r["differing"]} == {(1, "all"), (2, "2012"), (3, "2012-01"), (4, "2012-01-03")}
