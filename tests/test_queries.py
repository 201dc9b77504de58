"""Every registered query against DuckDB on the smallest tables."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry_module
from tiffin.plans import workload, workload_sql

# The training-data operators have their own tests.
QUERIES = {k: v for k, v in entry_module.queries().items() if k in workload.QUERIES}
SQL = {k: v for k, v in entry_module.oracle_sql().items() if k in workload_sql.SQL}

# Plans that are finished before a frame is returned; the rest is inspected.
EAGER = {
    "csv_load", "csv_split_load", "daily_run", "daily_two_days", "embed_reviews", "enrichment_batch", "enrichment_success", "fact_orders_lookback", "fact_orders_skipping", "ingestion_runs",
    "lineage_runs", "review_retrieval", "stream_control", "stream_load", "torn_load",
    "vector_upsert",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, sf_dir, name):
    difference = oracle.compare(QUERIES[name](spark, sf_dir), con, SQL[name])
    assert difference is None, difference


def test_entry(spark):
    assert entry_module.entry(spark).columns == [
        "order_date", "city", "orders", "delivered_orders", "cancel_rate", "gross_merchandise_value",
        "average_order_value",
    ]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
