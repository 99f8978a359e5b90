"""What the load leaves undone at size: no cleaning for a header, no shuffle for a lookup, no method too long."""

import os
import time

import pytest
from conftest import SF_DIR as SF
from pyspark.sql import functions as F
from test_plans import below, physical

from salesloom import queries
from salesloom.functions.numbers import number_text
from salesloom.operators import numbering
from salesloom.plans import views
from salesloom.plans.store import Store
from salesloom.plans.warehouse import Warehouse
from salesloom.schemas import STAGING
from salesloom.sources import csv_files, storage
from salesloom.sources.testdata import order_lines, raw_sales, staging_sales


@pytest.fixture
def shuffled(spark):
    """Nothing is small enough to broadcast unless it is asked for."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def few_parts(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_broken_lines_need_no_clean_table(spark, tmp_path):
    w = Warehouse(spark, lambda: staging_sales(spark, SF), raw=lambda: raw_sales(spark, SF))
    queries._broken_lines(w, str(tmp_path / "broken"))
    assert "clean_sales" not in w._ready
    assert spark.read.text(str(tmp_path / "broken")).first()[0] == ",".join(w["raw_sales"].columns)


def test_bad_lines_are_not_shuffled_to_find_their_rows(spark, tmp_path, shuffled):
    (tmp_path / "a.csv").write_text("order_id,sales\nO1,x\nO2,1\n")
    text = csv_files.read_raw_csv(spark, str(tmp_path / "a.csv"), keep_malformed=True, keep_place=True)
    found = csv_files.load_warnings(text)
    assert "SortMergeJoin" not in physical(found)
    assert [(r["row"], r["raw"]) for r in found.collect()] == [(1, "x")]


def test_lines_are_not_shuffled_by_customer(spark, shuffled):
    plan = physical(order_lines(spark, SF)).splitlines()
    at = next(i for i, text in enumerate(plan) if "hashpartitioning(o_custkey" in text)
    depth = [len(text) - len(text.lstrip(" :+-")) for text in plan]
    below = next((i for i in range(at + 1, len(plan)) if depth[i] <= depth[at]), len(plan))
    assert "l_orderkey" not in "".join(plan[at:below])


def test_the_load_keeps_methods_short_enough_to_compile(spark):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        for asked, kept in (("65535", "8000"), ("5000", "5000")):
            spark.conf.set("spark.sql.codegen.hugeMethodLimit", asked)
            Warehouse(spark, lambda: None)
            assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == kept
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)


def test_number_texts_are_only_stripped_for_parentheses(spark):
    cells = [" 1,234.50 ", "( 5,000.1 )\t", "(7", "$-3", "()", "x(2)", "1e3", "　(8)　", "", None]
    rows = spark.createDataFrame([(c,) for c in cells], "x string").select(number_text(F.col("x")))
    assert [r[0] for r in rows.collect()] == ["1234.50", "-5000.1", "7", "-3", "", "2", "13", "-8", "", None]
    tested = physical(spark.range(1).select(F.col("id").cast("string").alias("x")).select(number_text(F.col("x"))))
    assert tested.lower().index("contains(") < tested.index("trim(")


def lines(spark, days=3, each=40):
    """Staging rows of a few days, every tenth of them there twice."""
    made = []
    for i in range(days * each):
        row = dict.fromkeys(STAGING.names, "x") | {
            "order_id": f"O{i // 2}", "order_date": f"2020-01-{1 + i % days:02d}", "ship_date": f"2020-02-{1 + i % days:02d}",
            "customer_name": f"c{i % 7}", "product_id": f"p{i % 5}", "sales": str(i), "quantity": "1", "discount": "0",
            "profit": "1", "shipping_cost": "1",
        }
        made += [tuple(row[n] for n in STAGING.names)] * (2 if i % 10 == 0 else 1)
    df = spark.createDataFrame(made, ", ".join(f"{n} string" for n in STAGING.names))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in STAGING.fields]).repartition(4)


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = (name for d in manager.localDirs() for _, _, names in os.walk(d.toString()) for name in names)
    return {name for name in found if name.startswith("shuffle_") and name.endswith(".data")}


def freed(spark, before):
    """No shuffle file has come since; they go a moment after the write that needed them."""
    until = time.time() + 10
    while (new := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return not new


def scratch(spark, label):
    folder = os.path.dirname(storage.fresh_path(spark, "x"))
    return {name for name in os.listdir(folder) if name.startswith(f"{label}-")} if os.path.isdir(folder) else set()


def test_a_written_table_leaves_no_shuffle_files(spark, shuffled, tmp_path):
    before = shuffle_files(spark)
    grouped = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    stored = storage.materialize(grouped, "grouped")
    csv_files.write_csv(grouped, str(tmp_path / "grouped"))
    assert freed(spark, before)
    assert stored.count() == grouped.count() == 10  # both can still be read


def test_a_load_leaves_neither_shuffles_nor_steps_behind(spark, shuffled, few_parts):
    before = shuffle_files(spark)
    steps = {label: scratch(spark, label) for label in ("placed", "loaded", "geography_paths", "category_paths")}
    w = Warehouse(spark, lambda: lines(spark), ("2020-01-01", "2020-12-31"))  # given, so that nothing but writes is run
    keys = [r["sales_id"] for r in w["fact_sales"].select("sales_id").collect()]
    assert sorted(keys) == list(range(1, 133))
    assert freed(spark, before)
    assert steps == {label: scratch(spark, label) for label in steps}


def test_a_store_keeps_its_own_files_only(spark, few_parts, tmp_path):
    labels = ("batch", "fresh", "placed", "loaded", "paths", "products", "changed-days", "flat_product")
    steps = {label: scratch(spark, label) for label in labels}
    store = Store(spark, str(tmp_path / "store"))
    store.load(lines(spark, 2))
    store.load(lines(spark, 3))
    version = store.open()
    assert version["fact_sales"].count() == version["vw_sales_full"].count() == 132
    assert version["fact_sales"].select("sales_id").distinct().count() == 132
    assert steps == {label: scratch(spark, label) for label in labels}


def test_equal_rows_are_spread_by_short_places(spark):
    stored = storage.materialize(spark.range(5000).select(F.lit(1).alias("a")), "equal")
    assert dict(numbering.file_line(stored).dtypes)["_line"] == "int"
    keyed = numbering.number_rows(numbering.file_line(stored), ["a"], "k", spread_by=["_line"])
    assert sorted(r["k"] for r in keyed.collect()) == list(range(1, 5001))


def test_the_summary_shuffles_fact_rows_before_they_grow(spark, shuffled):
    w = Warehouse(spark, lambda: lines(spark))
    for dimension in ("customer_id", "product_id"):
        plan = below(views.sales_summary(w), f"Inner, ({dimension}#")
        assert "month_name" not in plan and "market_name" not in plan


def test_the_summary_of_a_written_view_joins_nothing(spark):
    w = Warehouse(spark, lambda: lines(spark))
    joined = w._builders["vw_sales_summary"]()
    assert "Join" in physical(joined)
    w["vw_sales_full"]
    again = w._builders["vw_sales_summary"]()
    assert "Join" not in physical(again)
    assert sorted(map(str, again.collect())) == sorted(map(str, joined.collect()))


def test_a_compressed_csv_holds_the_same_rows(spark, tmp_path):
    rows = [(f"O{i}", f" a,b \"{i}\" ") for i in range(100)]
    df = spark.createDataFrame(rows, "order_id string, product_name string")
    csv_files.write_csv(df, str(tmp_path / "z"), compression="gzip")
    assert any(name.endswith(".csv.gz") for name in os.listdir(tmp_path / "z"))
    found = csv_files.read_raw_csv(spark, str(tmp_path / "z"), df.schema, keep_malformed=True)
    assert csv_files.load_diagnostics(found, df.schema).first()["malformed_lines"] == 0
    assert sorted(tuple(r)[:2] for r in found.collect()) == sorted(rows)
