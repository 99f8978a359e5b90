"""Numbering, quantiles, hierarchies and stored tables on small frames."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.operators import hierarchy, numbering, profiling, reconcile
from salesloom.operators.quantiles import exact_quantiles
from salesloom.schemas import TABLES
from salesloom.sources import csv_files, storage, tables


@pytest.fixture
def no_coalescing(spark):
    """Keep every range partition, however small, apart."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_range_numbering_equals_the_window(spark, no_coalescing):
    rows = [(random.Random(i).randrange(10**6), f"n{i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "a long, b string").repartition(7)
    ranged = numbering.number_rows(df, ["a", "b"], "k").collect()
    ordered = sorted((a, b) for a, b in rows)
    assert sorted(map(tuple, ranged)) == [(a, b, i) for i, (a, b) in enumerate(ordered, 1)]
    assert sorted(r["k"] for r in ranged) == list(range(1, 5001))


def test_equal_rows_are_spread_over_partitions(spark, no_coalescing):
    """A third of the rows are copies of one; their file position splits them."""
    rows = [(7, "hot")] * 4000 + [(i, "cold") for i in range(8000)]
    stored = storage.materialize(spark.createDataFrame(rows, "a long, b string"), "hot")
    with_line = numbering.file_line(stored)
    placed = numbering.place_rows(with_line, ["b", "a"], ["_line"])
    sizes = {r["_part"]: r["count"] for r in placed.groupBy("_part").count().collect()}
    assert max(sizes.values()) < 4000
    numbered = numbering.number_rows(with_line, ["b", "a"], "k", start=11, spread_by=["_line"])
    got = sorted((r["k"], r["b"], r["a"]) for r in numbered.collect())
    want = sorted((b, a) for a, b in rows)
    assert [g[0] for g in got] == list(range(11, 11 + len(rows)))
    assert [(b, a) for _, b, a in got] == want


@pytest.mark.parametrize("skew", [False, True])
def test_quantiles_equal_numpy(spark, no_coalescing, skew):
    rng = np.random.default_rng(3)
    columns = {"x": rng.normal(size=999).round(3), "y": rng.integers(0, 9, 500).astype(float),
               "one": np.array([4.0])}
    if skew:
        columns["x"] = np.concatenate([columns["x"], np.full(700, 0.5)])
    rows = []
    for name, values in columns.items():
        found, n = np.unique(values, return_counts=True)
        rows += [(name, float(v), int(c)) for v, c in zip(found, n, strict=True)]
    df = spark.createDataFrame(rows, "column string, x double, n long")
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r["column"], r["p"]): r["quantile"]
           for r in exact_quantiles(df, probabilities).collect()}
    for name, values in columns.items():
        for p in probabilities:
            assert got[(name, p)] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_describe_small(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 3.0), ("b", None), ("a", 2.0), (None, 2.0)],
                               "t string, v double")
    got = {r["column"]: r.asDict() for r in profiling.describe(df).collect()}
    assert (got["t"]["count"], got["t"]["unique"], got["t"]["top"], got["t"]["freq"]) == (4, 2, "a", 2)
    assert (got["v"]["count"], got["v"]["mean"], got["v"]["q50"], got["v"]["max"]) == (4, 2.0, 2.0, 3.0)


def test_report_of_fewer_rows_than_the_sample(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "t string, v int")
    sheets = profiling.audit_report(df, ["t"])
    assert sheets["sample"].count() == 2 and sheets["preview"].count() == 2


def test_approximate_counts_are_close(spark):
    df = spark.range(20000).select((F.col("id") % 700).alias("a"))
    got = profiling.distinct_counts(df, approximate=True).first()["unique"]
    assert abs(got - 700) < 70


def test_region_shared_by_two_markets_fans_out(spark):
    paths = spark.createDataFrame(
        [("M1", "NORTH", "A", "s1"), ("M2", "NORTH", "B", "s2"), ("M2", "SOUTH", "C", "s1")],
        "market string, region string, country string, state string")
    levels = paths.columns
    found = {tuple(r) for r in hierarchy.false_children(paths, levels).collect()}
    assert found == {
        ("country", "M2", "NORTH", "A", None), ("country", "M1", "NORTH", "B", None),
        ("state", "M2", "NORTH", "A", "s1"), ("state", "M1", "NORTH", "B", "s2")}
    keyed = hierarchy.keyed_hierarchy(paths, levels)
    assert hierarchy.level_table(keyed, "region", "market").count() == 3
    assert hierarchy.level_table(keyed, "country", "region").count() == 3


def test_product_clash_takes_the_smallest_path(spark):
    df = spark.createDataFrame(
        [("P1", "pen", "Z", "a"), ("P1", "pen", "B", "z"), ("P1", "ink", "Z", "a")],
        "product_id string, product_name string, category string, sub_category string")
    got = {tuple(r) for r in hierarchy.first_product(df).collect()}
    assert got == {("P1", "pen", "B", "z"), ("P1", "ink", "Z", "a")}


def test_calendar_head(spark):
    days = hierarchy.calendar(hierarchy.date_series(spark, "2011-01-01", "2020-12-31"))
    assert days.count() == 3653
    head = [tuple(r)[1:] for r in days.orderBy("date_id").limit(3).collect()]
    assert head == [
        (2011, 1, 1, "January", 1, "Saturday", 52, 1), (2011, 1, 1, "January", 2, "Sunday", 52, 1),
        (2011, 1, 1, "January", 3, "Monday", 1, 0)]


def test_member_load_is_repeatable(spark):
    name = "dim_customer_test"
    tables.create_table(spark, name, TABLES["dim_customer"], storage.fresh_path(spark, name))
    tables.create_table(spark, name, TABLES["dim_customer"], storage.fresh_path(spark, name))
    first = spark.createDataFrame([("Bo", "S"), ("Al", "S"), (None, "S")],
                                  "customer_name string, segment string")
    second = spark.createDataFrame([("Al", "S"), ("Al", "T"), ("Aa", "S")],
                                   "customer_name string, segment string")
    for batch in (first, first, second, second):
        tables.append_new_members(batch, name, ["customer_name", "segment"], "customer_id")
    assert sorted(map(tuple, spark.table(name).collect())) == [
        (1, "Al", "S"), (2, "Bo", "S"), (3, "Aa", "S"), (4, "Al", "T")]


def test_repeat_rows_restores_every_copy(spark):
    df = spark.createDataFrame([("a", 250_001), ("b", 1)], "t string, n long")
    got = {r["t"]: r["count"] for r in reconcile.repeat_rows(df, "n").groupBy("t").count().collect()}
    assert got == {"a": 250_001, "b": 1}


def test_load_diagnostics(spark):
    columns = csv_files.STAGING.names
    good = {c: "x" for c in columns} | {"order_date": "2011-01-01", "ship_date": "2011-01-02",
            "sales": "1.5", "quantity": "2", "discount": "0.1", "profit": "1", "shipping_cost": "2"}
    bad = good | {"quantity": "two", "order_date": "1/1/2011", "order_id": "y" * 51}
    df = spark.createDataFrame([[r[c] for c in columns] for r in (good, bad)],
                               ",".join(f"{c} string" for c in columns))
    got = {r["column"]: (r["rows_loaded"], r["bad_casts"], r["too_long"])
           for r in csv_files.load_diagnostics(df).collect()}
    assert got["quantity"] == (2, 1, 0) and got["order_date"] == (2, 1, 0)
    assert got["order_id"] == (2, 0, 1) and got["sales"] == (2, 0, 0)


def test_shared_folder_comes_from_the_session(spark):
    assert storage.fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def _csv(tmp_path, name, text):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "a.csv").write_text(text)
    return str(folder)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("order_id", "order_date", "state")])
    path = _csv(tmp_path, "swapped", "order_date,more,order_id\n2011-01-02,x,O-1\n")
    assert [tuple(r) for r in csv_files.read_raw_csv(spark, path, schema).collect()] == [("O-1", "2011-01-02", None)]


def test_short_and_long_lines_are_counted_and_dropped(spark, tmp_path):
    schema = T.StructType([T.StructField("order_id", T.StringType()), T.StructField("quantity", T.IntegerType())])
    path = _csv(tmp_path, "broken", 'order_id,quantity\nO-1,1\nO-2\nO-3,3,3\n"O,4",x\n')
    text = csv_files.read_raw_csv(spark, path, schema, keep_malformed=True)
    assert sorted(map(tuple, csv_files.load_typed(text, schema).collect())) == [("O,4", None), ("O-1", 1)]
    found = {r["column"]: tuple(r)[1:] for r in csv_files.load_diagnostics(text, schema).collect()}
    assert found == {"order_id": (2, 2, 0, 0), "quantity": (2, 2, 1, 0)}


def test_large_files_are_split_unless_lines_may_break(spark, tmp_path):
    path = _csv(tmp_path, "large", "order_id,state\n" + "O-1,somewhere\n" * 20000)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        plain = csv_files.read_raw_csv(spark, path).select(F.spark_partition_id().alias("p")).distinct().count()
        broken = csv_files.read_raw_csv(spark, path, multi_line=True).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert plain > 1 and broken == 1


def test_bitmaps_count_distinct_values_exactly(spark):
    import datetime
    import random

    from salesloom.operators import bitmaps

    draw = random.Random(3)
    day = datetime.date(1969, 12, 1)
    rows = [
        (draw.choice("ab"), draw.choice([None, draw.randint(-70_000, 140_000)]), day + datetime.timedelta(draw.randint(0, 90)), draw.choice([None, "x", "y"]), None)
        for _ in range(3000)
    ]
    df = spark.createDataFrame(rows, "k string, i long, d date, s string, n int").repartition(5)
    expected = {c: len({r[j] for r in rows} - {None}) for j, c in enumerate(df.columns)}
    assert {r["column"]: r["distinct_count"] for r in bitmaps.distinct_counts(df, df.columns).collect()} == expected
    stored = bitmaps.bitmaps(df, "i", ["k"]).unionAll(bitmaps.bitmaps(df, "d", ["k"]))
    by_key = {(r["k"], r["column"]): r["distinct_count"] for r in bitmaps.counts(stored, ["k"]).collect()}
    assert by_key["a", "i"] == len({r[1] for r in rows if r[0] == "a"} - {None})
    assert {r["column"]: r["distinct_count"] for r in bitmaps.counts(stored).collect()} == {c: expected[c] for c in "id"}
    with pytest.raises(TypeError):
        bitmaps.bitmaps(df, "s")
    assert {r["distinct_count"] for r in bitmaps.distinct_counts(df.limit(0), df.columns).collect()} == {0}


def test_merged_profiles_equal_one_profile_within_their_bounds(spark):
    from salesloom.operators import sketches

    draw = random.Random(8)
    rows = [(draw.choice("pqr"), draw.choice([None, draw.gauss(0, 50)]), f"v{int(draw.expovariate(0.05))}", i) for i in range(40_000)]
    df = spark.createDataFrame(rows, "part string, x double, s string, i long").repartition(6)
    stored = sketches.profile(df, ["part"])
    assert stored.count() == 9
    found = {r["column"]: r for r in sketches.estimates(sketches.merged(stored)).collect()}
    for j, c in ((1, "x"), (2, "s"), (3, "i")):
        values = [r[j] for r in rows if r[j] is not None]
        assert (found[c]["rows"], found[c]["missing"]) == (len(rows), len(rows) - len(values))
        assert abs(found[c]["distinct"] / len(set(values)) - 1) <= sketches.DISTINCT_ERROR
        if c != "s":
            for q in (25, 50, 75):
                rank = np.mean(np.array(values) <= found[c][f"q{q}"])
                assert abs(rank - q / 100) <= sketches.RANK_ERROR
            assert (found[c]["least"], found[c]["most"]) == (min(values), max(values))
    assert found["s"]["q50"] is None and found["i"]["total"] == sum(range(40_000))
    true = {}
    for r in rows:
        true[r[2]] = true.get(r[2], 0) + 1
    for item, count in found["s"]["top"]:
        assert true[item] <= count <= true[item] + sketches.FREQUENCY_ERROR * len(rows)


def test_closure_holds_every_ancestor_of_every_leaf(spark):
    keyed = spark.createDataFrame([(1, "a", 1, "n", 1, "s"), (1, "a", 2, "m", 2, "s"), (2, "b", 3, "n", 3, None)],
                                  "x_id long, x_name string, y_id long, y_name string, z_id long, z_name string")
    found = {tuple(r) for r in hierarchy.closure(keyed, ["x", "y", "z"]).collect()}
    assert found == {
        (0, "all", 0, None, 1), (0, "all", 0, None, 2), (0, "all", 0, None, 3), (1, "x", 1, "a", 1), (1, "x", 1, "a", 2), (1, "x", 2, "b", 3),
        (2, "y", 1, "n", 1), (2, "y", 2, "m", 2), (2, "y", 3, "n", 3), (3, "z", 1, "s", 1), (3, "z", 2, "s", 2), (3, "z", 3, None, 3),
    }


def test_load_warnings_name_file_row_and_reason(spark, tmp_path):
    header = "order_id,order_date,sales,quantity,ship_mode"
    lines = [f"O{i},2020-01-0{1 + i % 9},{i}.50,{i},air" for i in range(2000)]
    lines[3] = "O3,5/1/2020,x,3,air"
    lines[1500] = f"O1500,2020-01-01,1,many,{'long' * 20}"
    lines[1700] = "O1700,2020-01-01"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join([header, *lines]) + "\n")
    (tmp_path / "in" / "b.csv").write_text(f"{header}\nP1,2020-01-01,1,2,sea\nP2,,,2.5.1,sea\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
        text = csv_files.read_raw_csv(spark, str(tmp_path / "in"), keep_malformed=True, keep_place=True)
        assert text.rdd.getNumPartitions() > 3
        found = {(r["file"].rsplit("/", 1)[1], r["row"], r["column"], r["raw"], r["reason"]) for r in csv_files.load_warnings(text).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {
        ("a.csv", 4, "order_date", "5/1/2020", "not date"), ("a.csv", 4, "sales", "x", "not decimal(18,2)"),
        ("a.csv", 1501, "quantity", "many", "not int"), ("a.csv", 1501, "ship_mode", "long" * 20, "longer than 50"),
        ("a.csv", 1701, None, "O1700,2020-01-01", "malformed line"), ("b.csv", 2, "quantity", "2.5.1", "not int"),
    }
    assert text.columns[-1] == csv_files.PLACE


def test_values_with_line_breaks_are_read_by_many_tasks(spark, tmp_path):
    rows = [(f"O{i}", f"two\nlines of \"{i}\"") for i in range(1000)]
    path = str(tmp_path / "out")
    csv_files.write_csv(spark.createDataFrame(rows, "order_id string, product_name string").coalesce(1), path, rows_per_file=100)
    schema = T.StructType([T.StructField("order_id", T.StringType()), T.StructField("product_name", T.StringType())])
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "4m")  # a file a task, however small
        text = csv_files.read_raw_csv(spark, path, schema, multi_line=True)
        assert text.rdd.getNumPartitions() >= 10
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert sorted(map(tuple, text.collect())) == sorted(rows)
