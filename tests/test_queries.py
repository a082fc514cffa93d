"""Every core query against its SQL, and the entry point, over the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from recordmill.plans import catalog

from .oracle import connected, rows_of, sql_rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    got = rows_of(catalog.QUERIES[name](spark, SF))
    if name in catalog.ORACLES:
        assert got == sql_rows(connected(SF), catalog.ORACLES[name])
    else:
        assert got[0]


def test_samples_of_all_categories(spark):
    """Every category that has failures has samples, up to ten, also those of container events and coverage."""
    facts = {r.category: r.n for r in catalog.QUERIES["failure_facts"](spark, SF).groupBy("category").agg(F.count("*").alias("n")).collect()}
    kinds = {r.kind for r in catalog.QUERIES["failure_facts"](spark, SF).select("kind").distinct().collect()}
    got = catalog.QUERIES["failure_samples_all"](spark, SF).collect()
    assert {c: sum(r.category == c for r in got) for c in facts} == {c: min(10, n) for c, n in facts.items()}
    assert len(kinds) > 1 and {r.kind for r in got} == kinds


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["source", "n", "least", "p50", "p90", "p95", "p99", "most", "mean"] and df.count() > 0


def test_sql_is_of_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
