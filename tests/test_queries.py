"""Every registered query against its SQL counterpart, on whole tables."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry
from salesloom.oracle import ORACLE
from salesloom.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None


def test_sample_is_repeatable(spark, sf_dir):
    first = QUERIES["c_sample"](spark, sf_dir).collect()
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        again = QUERIES["c_sample"](spark, sf_dir).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(first) == 100 and first == again


def test_entry(spark):
    assert entry(spark).count() == 4
