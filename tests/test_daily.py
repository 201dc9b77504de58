"""The whole run on landing files, twice, and with gates that fail."""

from __future__ import annotations

import pytest

from tiffin.operators import quality
from tiffin.plans import daily
from tiffin.sources import control
from tiffin.sources.control import LoadGateFailed

FILES = {
    "restaurants": "h\n0,1,One,\"Old Town, Pune\",4.2,500+ ratings,200 for two,thai,L1,,,\n0,2,Two,Agra,--,Too Few,,,L2,,,\n",
    "users": "h\n0,7,Ann,A@X.CO,pw,30,,,,,,2\n0,8,Bob,B@X.CO,pw,,,,,,,\n",
    "food": "h\n0,f1,Soup,non-veg\n",
    "menu": "h\n0,m1,1,f1,thai,12.50\n",
    "orders": "h\n"
    "1,2024-03-01 10:00:00,2024-03-01,7,1,\"Area, Pune\",thai,1,1,10,0,1,1,12.00,INR,card,Delivered,5,40\n"
    "2,2024-03-01 11:00:00,2024-03-01,8,2,Agra,thai,1,1,10,0,1,1,20.00,INR,card,Cancelled,,\n",
    "order_items": "h\n11,1,1,f1,12.50,1,12.50\n12,2,2,f1,12.50,1,12.50\n",
    "reviews": "h\n100,1,7,1,5,\"Great food, fast\",2024-03-02\n101,2,8,2,1,late and cold,2024-03-02\n102,2,8,2,1,,2024-03-02\n",
}


def put(base, name, body, file="1.csv"):
    path = base / "landing" / name / file
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(body)


@pytest.fixture
def base(tmp_path):
    for name, body in FILES.items():
        put(tmp_path, name, body)
    return tmp_path


def config(base, run_id, **kw):
    return daily.DailyConfig(str(base / "landing"), str(base / "warehouse"), run_id, **kw)


def summary(spark, base):
    rows = control.pipeline_runs(spark, str(base / "warehouse")).read().collect()
    return {r.run_id: (r.status, r.dq_status, r.rows_ingested, r.ai_success_count, r.ai_fail_count) for r in rows}


def test_two_days(spark, base):
    result = daily.run(spark, config(base, "d1"))
    assert result["status"] == "SUCCESS" and result["dq_status"] == "passed"
    assert summary(spark, base) == {"d1": ("SUCCESS", "passed", 13, 2, 0)}
    revenue = {r.city: r for r in spark.table("sem_revenue_daily").collect()}
    assert float(revenue["Pune"].gross_merchandise_value) == 12.0 and revenue["Agra"].cancel_rate == 1
    insights = daily.table(spark, config(base, "d1"), "marts", "mart_review_insights").read().collect()
    assert {(r.city, r.topic, r.sentiment_label) for r in insights} == {
        ("Pune", "food quality", "positive"), ("Agra", "delivery", "negative"),
    }

    put(base, "orders", "h\n"
        "3,2024-03-02 09:00:00,2024-03-02,7,1,Pune,thai,1,1,10,0,1,1,-5.00,INR,card,Delivered,4,50\n"
        "4,2024-03-02 09:30:00,2024-03-02,7,1,Pune,thai,1,1,10,0,1,1,50.00,INR,card,Delivered,4,50\n"
        "2,2024-03-01 11:00:00,2024-03-01,8,2,Agra,thai,1,1,10,0,1,1,20.00,INR,card,Delivered,,\n", "2.csv")
    result = daily.run(spark, config(base, "d2", lookback="1 day"))
    assert result["dq_status"] == "warned" and result["rows_ingested"] == 3 and result["ai_success_count"] == 0
    orders = {r.order_id: r for r in spark.table("sem_orders").collect()}
    assert len(orders) == 4 and orders[2].order_status == "Delivered"
    assert [orders[i].age_segment for i in (1, 2)] == ["Millennial", "Unknown"]


def test_a_blocking_check_stops_the_run(spark, base):
    put(base, "orders", "h\n9,2024-03-05 09:00:00,2024-03-05,7,1,Pune,thai,1,1,1,1,1,1,5.00,INR,card,Lost,4,5\n", "2.csv")
    with pytest.raises(quality.QualityGateFailed, match="stg_orders.order_status"):
        daily.run(spark, config(base, "d1"))
    assert summary(spark, base) == {"d1": ("FAILED", "failed", 14, 0, 0)}
    assert not daily.table(spark, config(base, "d1"), "marts", "fact_orders").exists()


def test_a_failed_load_stops_the_run(spark, base):
    (base / "landing" / "food" / "bad.csv.gz").write_bytes(b"no gzip")
    with pytest.raises(LoadGateFailed, match="food"):
        daily.run(spark, config(base, "d1"))
    assert summary(spark, base)["d1"][:2] == ("FAILED", "failed")
    (base / "landing" / "food" / "bad.csv.gz").unlink()
    daily.run(spark, config(base, "d2"))
    assert summary(spark, base)["d2"] == ("SUCCESS", "passed", 0, 2, 0)


def test_a_poor_batch_stops_before_publishing(spark, base):
    broken = lambda: (lambda comment: ("not json", "m"))
    with pytest.raises(quality.QualityGateFailed, match="2 of 2 reviews failed"):
        daily.run(spark, config(base, "d1", make_client=broken))
    assert not daily.table(spark, config(base, "d1"), "marts", "mart_review_insights").exists()


def test_command_line(spark, base, capsys):
    from tiffin.__main__ import main

    where = ["--warehouse", str(base / "warehouse")]
    landing = ["--landing", str(base / "landing")]
    assert main(["load", *where, *landing, "--source", "food", "--run-id", "c1"], spark) == 0
    assert "total_rows=1" in capsys.readouterr().out
    (base / "landing" / "menu" / "bad.csv.gz").write_bytes(b"no gzip")
    assert main(["load", *where, *landing, "--run-id", "c2"], spark) == 1
    assert main(["daily", *where, *landing, "--run-id", "c3"], spark) == 1
    (base / "landing" / "menu" / "bad.csv.gz").unlink()
    assert main(["daily", *where, *landing, "--run-id", "c4"], spark) == 0
    assert main(["check-batch", *where, "--batch-id", "c4"], spark) == 0
    assert main(["enrich", *where, "--batch-id", "c5"], spark) == 0
    with pytest.raises(SystemExit):
        main(["load", *where, *landing, "--source", "unknown"], spark)
