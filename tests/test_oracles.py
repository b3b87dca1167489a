"""Every catalogue query against its SQL twin, on the small tables."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, duckdb_result, spark_result
from hearthwatt.plans.catalogue import QUERIES
from hearthwatt.plans.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.01"
MODELS = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    columns, rows = spark_result(QUERIES[name](spark, SF_DIR))
    expected_columns, expected_rows = duckdb_result(duck, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected_rows


@pytest.mark.parametrize("name", MODELS)
def test_model_queries_give_rows(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert rows
    for row in rows:
        if "prediction" in row:
            assert row["prediction"] is not None


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert [r["total_consumption"] for r in rows] == sorted(
        (r["total_consumption"] for r in rows), reverse=True
    )
