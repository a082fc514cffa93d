"""The queries of this subpackage over the smallest tables, and over tables without rows."""

import os

import pytest

from recordmill.llm import queries

from ..oracle import connected, rows_of, sql_rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
COLUMNS = {
    "p1_found": ["pos_a", "pos_b"], "p2_found": ["pos", "field"], "p3_found": ["pos_a", "pos_b"], "p4_found": ["pos", "field"],
    "p5_found": ["pos", "group_key"], "p6_ids": ["doc_id", "ids"], "p7_found": ["doc_id", "item_id"], "p8_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    if name == "p6_ids" and not os.path.exists(queries.encoding.VOCABULARY):
        pytest.skip("no vocabulary here")
    df = queries.QUERIES[name](spark, SF)
    if name in COLUMNS:
        assert sorted(df.columns) == sorted(COLUMNS[name])
    got = rows_of(df)
    if name in queries.ORACLES:
        assert got == sql_rows(connected(SF), queries.ORACLES[name])
    if name.endswith("_found") and "pos_a" in df.columns:
        assert all(int(a) < int(b) for a, b in got[1])
    assert len(got[1]) == len(set(got[1]))


@pytest.fixture(scope="module")
def no_rows(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("none")
    for name in ("tool_records", "split_members", "documents", "heldout_items"):
        spark.read.parquet(f"{SF}/{name}.parquet").where("false").write.parquet(str(d / f"{name}.parquet"))
    return str(d)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_without_rows(spark, no_rows, name):
    if name == "p6_ids" and not os.path.exists(queries.encoding.VOCABULARY):
        pytest.skip("no vocabulary here")
    rows = queries.QUERIES[name](spark, no_rows).collect()
    assert rows == [] or name == "p2_validation"


@pytest.fixture(scope="module")
def nulls(spark, tmp_path_factory):
    """Tables with rows that are null in every column but the keys, some repeated."""
    d = tmp_path_factory.mktemp("nulls")
    for name, key in (("tool_records", "pos"), ("split_members", "pos"), ("documents", "doc_id"), ("heldout_items", "item_id")):
        full = spark.read.parquet(f"{SF}/{name}.parquet")
        empty = spark.createDataFrame([(k,) for k in (10**6, 10**6 + 1, 10**6 + 1)], f"{key} long").select(*[key if c == key else full.schema[c].dataType and _null(c, full) for c in full.columns])
        full.limit(20).unionByName(empty).write.parquet(str(d / f"{name}.parquet"))
    return str(d)


def _null(c, df):
    from pyspark.sql import functions as F

    return F.lit(None).cast(df.schema[c].dataType).alias(c)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_with_nulls(spark, nulls, name):
    if name == "p6_ids" and not os.path.exists(queries.encoding.VOCABULARY):
        pytest.skip("no vocabulary here")
    queries.QUERIES[name](spark, nulls).collect()
