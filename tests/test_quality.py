from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tiffin.operators import quality as q


@pytest.fixture
def tables(spark):
    child = [(1, 10, "x", 5), (2, 11, "y", -1), (2, None, None, None), (None, 99, "z", 0)]
    return {
        "child": spark.createDataFrame(child, "id int, fk int, state string, amount int"),
        "parent": spark.createDataFrame([(10,), (11,), (12,)], "pk int"),
    }


CHECKS = [
    q.Check("child", "id", "unique"),
    q.Check("child", "id", "not_null"),
    q.Check("child", "state", "accepted_values", values=("x", "y")),
    q.Check("child", "fk", "relationships", parent="parent", parent_column="pk"),
    q.Check("child", "amount", "expression", q.WARN, expression=">= 0"),
    q.row_rule("child", "amount >= 0 or fk = 11", "rule_of_two"),
    q.Check("parent", "pk", "unique"),
]


def test_run_checks(tables):
    got = {(r.column_name, r.check_name): (r.failures, r.status) for r in q.run_checks(tables, CHECKS).collect()}
    assert got == {
        ("id", "unique"): (1, "fail"), ("id", "not_null"): (1, "fail"), ("state", "accepted_values"): (1, "fail"),
        ("fk", "relationships"): (1, "fail"), ("amount", "expression"): (1, "warn"),
        ("rule_of_two", "rule"): (0, "pass"), ("pk", "unique"): (0, "pass"),
    }


@pytest.mark.parametrize("check", CHECKS)
def test_failing_rows_agree_with_counts(tables, check):
    count = q.run_checks(tables, [check]).first().failures
    assert q.failing_rows(tables[check.table], check, tables).count() == count


def test_gate(tables):
    with pytest.raises(q.QualityGateFailed, match="child.id unique: 1"):
        q.gate(q.run_checks(tables, CHECKS))
    assert q.gate(q.run_checks(tables, [CHECKS[4]])) == "warned"
    assert q.gate(q.run_checks(tables, [CHECKS[6]])) == "passed"


def test_row_checks_share_one_scan(tables):
    rows = [c for c in CHECKS if c.kind in q.ROW_KINDS]
    plan = q.run_checks(tables, rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


@pytest.mark.parametrize(
    ("hour", "status"), [(24, "pass"), (25, "warn"), (48, "warn"), (49, "fail")]
)
def test_freshness(spark, hour, status):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string").select(F.to_timestamp("t").alias("t"))
    now = datetime(2024, 1, 1 + hour // 24, hour % 24)
    result = q.freshness(df, "x", "t", now)
    assert result.first().status == status
    if status == "fail":
        with pytest.raises(q.QualityGateFailed):
            q.freshness_gate(result)


def test_an_empty_table_is_stale(spark):
    df = spark.createDataFrame([], "t timestamp")
    assert q.freshness(df, "x", "t", datetime(2024, 1, 1)).first().status == "fail"


def test_old_orders_only_warn(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string")
    orders = df.select(F.col("t").cast("timestamp_ntz").alias("order_timestamp"))
    assert q.freshness_gate(q.stale_orders(orders, datetime(2024, 1, 2, 2))) == "passed"
    assert q.freshness_gate(q.stale_orders(orders, datetime(2025, 1, 1))) == "warned"


def test_parity(spark):
    a, b = spark.range(5), spark.range(4)
    same = q.row_parity({"v": (a, a)})
    assert same.first().failures == 0
    q.parity_gate(same)
    with pytest.raises(q.QualityGateFailed):
        q.parity_gate(q.row_parity({"v": (a, a), "w": (a, b)}))


def log(spark, failed, succeeded):
    rows = [("b", "FAILED")] * failed + [("b", "SUCCEEDED")] * succeeded + [("other", "FAILED")]
    return spark.createDataFrame(rows, "batch_id string, status string")


def test_failure_share_gate(spark):
    assert q.check_failure_share(log(spark, 1, 4), "b")["failure_rate"] == 0.2  # exactly the limit passes
    with pytest.raises(q.QualityGateFailed):
        q.check_failure_share(log(spark, 21, 79), "b")
    assert q.check_failure_share(log(spark, 0, 0), "b") == {
        "batch_id": "b", "succeeded": 0, "failed": 0, "failure_rate": 0.0,
    }


def test_contracts(spark):
    runs = spark.createDataFrame(
        [("r1", "d", 1, 2, "SUCCESS", 1, "passed", 0, 0), ("r2", "d", 2, 1, "DONE", 1, "passed", 0, None)],
        "run_id string, dag_run_id string, started_at int, finished_at int, status string, rows_ingested int, "
        "dq_status string, ai_success_count int, ai_fail_count int",
    )
    contract = q.CONTRACTS["pipeline_runs"]
    results = q.run_checks({"pipeline_runs": runs}, contract.checks()).filter("failures > 0").collect()
    assert {r.column_name for r in results} == {"status", "finished_after_start", "ai_fail_count"}
    assert q.contract_breaches([contract], {"pipeline_runs": runs.drop("status")}) == {"pipeline_runs": ["status"]}
    assert q.contract_breaches([contract], {"pipeline_runs": runs}) == {}


def test_success_is_terminal(spark):
    enriched = spark.createDataFrame([("b", 1, 5), ("b", 2, 5)], "batch_id string, review_id int, processed_at int")
    log_df = spark.createDataFrame(
        [("b", 1, "FAILED", 4), ("b", 2, "FAILED", 6), ("c", 1, "FAILED", 9)],
        "batch_id string, review_id int, status string, processed_at int",
    )
    assert [r.review_id for r in q.success_is_terminal(enriched, log_df).collect()] == [2]
