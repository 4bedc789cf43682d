"""Every bound query against its SQL, and plan checks."""

import os
import sys

import duckdb
import pytest
from helpers import plan

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as contract  # noqa: E402
from verify import TABLES, compare  # noqa: E402

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return connection


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, db, name):
    df = QUERIES[name](spark, sf)
    if name in SQL:
        assert compare(df, db.sql(SQL[name])).startswith("ok"), name
    else:
        assert df.count() > 0


@pytest.mark.parametrize("name", [
    "make_clean", "psi_all", "stratified_split", "kfold_assign", "drift_inject", "histogram", "category_counts",
    "classification_report", "validation_errors", "box_stats", "minimal_preprocess", "model_ranking",
])
def test_plans_stay_on_the_jvm(spark, sf, name):
    shown = plan(QUERIES[name](spark, sf))
    assert "Python" not in shown and "CartesianProduct" not in shown and "BroadcastNestedLoopJoin" not in shown


def test_filters_and_columns_reach_the_scan(spark, sf):
    from lodestat.bindings.registry import baseline_current
    from lodestat.operators.drift import psi

    shown = plan(psi(*baseline_current(spark, sf), ["o_orderpriority"]))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in shown
    scans = [line for line in shown.splitlines() if "orders.parquet" in line]
    assert scans and all("o_totalprice" not in line for line in scans)
