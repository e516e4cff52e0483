"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from screenmeld.plans import QUERIES

SF_DIR = "/root/testdata/sf0.001"
NAMES = list(QUERIES)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    verdict, rows = compare(spark, con, entry.queries()[name], entry.oracle_sql().get(name), SF_DIR)
    assert verdict == "ok" and rows > 0, verdict


@pytest.mark.parametrize("name", ["ecr_rerank", "ranking_metrics", "grid_metrics", "completed_from_log"])
def test_query_with_split_groups(spark, con, name):
    spark.conf.set("spark.screenmeld.rowsPerTask", "400")
    try:
        verdict, _ = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    finally:
        spark.conf.unset("spark.screenmeld.rowsPerTask")
    assert verdict == "ok", verdict


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_do_the_full_size():
    from screenmeld.plans import resampling, validation
    points = [p for p in validation.GRID if p.kind == "grid"]
    assert resampling.REPLICATES == 1000
    assert len(points) == 792 and len(validation.GRID) == 792 + 12
