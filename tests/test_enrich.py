from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tiffin.operators import enrich
from tiffin.sources.tables import LayerTable

GOOD = {"sentiment_label": "negative", "sentiment_score": -0.8, "topic": "delivery", "key_issue": "late delivery"}


def validated(spark, replies):
    rows = [(i, r if r is None or isinstance(r, str) else json.dumps(r)) for i, r in enumerate(replies)]
    df = spark.createDataFrame(rows, "i int, reply string").withColumns(
        {"model_version": F.lit("m"), "call_error": F.lit(None).cast("string")}
    )
    return enrich.validate_replies(df).orderBy("i").collect()


def test_accepted_replies(spark):
    got = validated(spark, [
        GOOD, GOOD | {"key_issue": None}, {k: v for k, v in GOOD.items() if k != "key_issue"},
        GOOD | {"sentiment_score": "0.5"}, GOOD | {"sentiment_score": 1}, GOOD | {"key_issue": " NULL "},
        GOOD | {"extra": {"a": [1]}},
    ])
    assert [r.status for r in got] == ["SUCCEEDED"] * 7
    assert [r.sentiment_score for r in got] == [-0.8, -0.8, -0.8, 0.5, 1.0, -0.8, -0.8]
    assert [r.key_issue for r in got] == ["late delivery", None, None, "late delivery", "late delivery", None,
                                          "late delivery"]


def test_refused_replies(spark):
    got = validated(spark, [
        GOOD | {"sentiment_score": -5.0}, GOOD | {"topic": "not-a-real-topic"}, GOOD | {"sentiment_label": "very positive"},
        GOOD | {"sentiment_score": "high"}, GOOD | {"sentiment_score": "NaN"}, {"topic": "delivery"}, "no json", "[]", "",
        None,
    ])
    assert [r.status for r in got] == ["FAILED"] * 10
    assert all(r.error_message for r in got)
    assert "sentiment_score" in got[0].error_message and "topic" in got[1].error_message


def test_long_errors_are_clipped(spark):
    (row,) = validated(spark, ["x" * 5000])
    assert len(row.error_message) == 2000


def reviews(spark, comments):
    return spark.createDataFrame(list(enumerate(comments, 1)), "review_id bigint, comment string")


def ids(df):
    return sorted(r.review_id for r in df.collect())


def test_pending(spark):
    all_reviews = reviews(spark, ["a", "b", "c", "d"])
    enriched = spark.createDataFrame([(1,)], "review_id bigint")
    log = spark.createDataFrame(
        [(1, "SUCCEEDED", 1), (2, "FAILED", 1), (2, "FAILED", 2)], "review_id bigint, status string, attempt_number int"
    )
    assert ids(enrich.pending_reviews(all_reviews, enriched, log)) == [3, 4]
    assert ids(enrich.pending_reviews(all_reviews, enriched, log, reprocess_failed=True)) == [2, 3, 4]
    assert ids(enrich.pending_reviews(all_reviews, enriched, log, batch_size=1, reprocess_failed=True)) == [2]
    numbered = enrich.with_attempt_number(all_reviews, log).collect()
    assert {r.review_id: r.attempt_number for r in numbered} == {1: 2, 2: 3, 3: 1, 4: 1}


def test_rules(spark):
    df = reviews(spark, ["The delivery was late and the box leaked", "Delicious, FRESH food!", "ok", "latest goodness"])
    got = enrich.validate_replies(enrich.classify_by_rules(df, "comment")).orderBy("review_id").collect()
    assert [(r.sentiment_label, r.sentiment_score, r.topic, r.key_issue) for r in got] == [
        ("negative", -0.4, "delivery", "late"), ("positive", 0.4, "food quality", None), ("neutral", 0.0, "other", None),
        ("neutral", 0.0, "other", None),
    ]


def make_flaky():
    """A client that loses its first connection per comment, and fails on some."""
    seen = set()

    def client(comment):
        if "down" in comment:
            raise ConnectionError("no route")
        if "odd" in comment:
            raise ValueError("odd comment")
        if comment not in seen:
            seen.add(comment)
            raise TimeoutError
        return json.dumps(GOOD), "model-2024"

    return client


def test_client_errors_stay_with_their_row(spark):
    df = reviews(spark, ["fine", "line down", "odd", "good"])
    out = enrich.classify(df, make_flaky, "comment", max_tries=2, parallelism=2, wait_seconds=(0, 0))
    got = {r.comment: r for r in enrich.validate_replies(out).collect()}
    assert (got["fine"].status, got["fine"].model_version) == ("SUCCEEDED", "model-2024")
    assert (got["line down"].status, got["line down"].error_message) == ("FAILED", "no route")
    assert got["odd"].error_message == "odd comment"
    once = enrich.classify(df, make_flaky, "comment", max_tries=1, wait_seconds=(0, 0))
    assert {r.status for r in enrich.validate_replies(once).collect()} == {"FAILED"}


def echo_client():
    """Shows what reached the client in the stored issue."""
    return lambda comment: (json.dumps(GOOD | {"key_issue": comment}), "m-1")


def run(spark, base, df, batch, **kw):
    return enrich.run_batch(spark, base, df, batch, processed_at=datetime(2024, 1, 1), **kw)


def test_batches_are_idempotent_and_logged(spark, tmp_path):
    base = str(tmp_path)
    df = reviews(spark, ["mail me a@b.co", "good", "bad", "late"])
    first = run(spark, base, df, "b1", make_client=echo_client, model_name="m", batch_size=3)
    assert first == {"batch_id": "b1", "succeeded": 3, "failed": 0, "failure_rate": 0.0, "pii_redacted_count": 1,
                     "left_over": 1}
    enriched = enrich.review_enriched(spark, base).read()
    row = enriched.filter("review_id = 1").first()
    assert (row.key_issue, row.pii_redacted_count) == ("mail me [REDACTED_EMAIL]", 1)
    assert (row.model_name, row.model_version, row.prompt_version, row.batch_id) == ("m", "m-1", "v1", "b1")
    assert run(spark, base, df, "b1", make_client=echo_client)["succeeded"] == 3  # a rerun adds nothing
    assert run(spark, base, df, "b2", make_client=echo_client)["succeeded"] == 1
    assert run(spark, base, df, "b3", make_client=echo_client)["succeeded"] == 0
    assert ids(enrich.review_enriched(spark, base).read()) == [1, 2, 3, 4]
    assert enrich.enrichment_log(spark, base).read().count() == 4


def test_failed_reviews_wait_until_asked_for(spark, tmp_path):
    base = str(tmp_path)
    df = reviews(spark, ["odd", "good"])
    assert run(spark, base, df, "b1", make_client=make_flaky, max_tries=2)["failed"] == 1
    assert run(spark, base, df, "b2", make_client=echo_client)["succeeded"] == 0
    assert run(spark, base, df, "b3", make_client=echo_client, reprocess_failed=True)["succeeded"] == 1
    log = enrich.enrichment_log(spark, base).read().filter("review_id = 1").orderBy("attempt_number").collect()
    assert [(r.attempt_number, r.status, r.model_version) for r in log] == [(1, "FAILED", None), (2, "SUCCEEDED", "m-1")]


def test_a_batch_that_stopped_between_its_tables_is_finished(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    df = reviews(spark, ["good", "bad"])
    whole = LayerTable.append

    def stop_at_enriched(self, *args, **kw):
        if self.root.endswith("review_enriched"):
            raise RuntimeError("killed")
        return whole(self, *args, **kw)

    with monkeypatch.context() as m:
        m.setattr(LayerTable, "append", stop_at_enriched)
        with pytest.raises(RuntimeError):
            run(spark, base, df, "b1", make_client=echo_client)
    assert enrich.enrichment_log(spark, base).read().count() == 2
    run(spark, base, df, "b1", make_client=lambda: (lambda c: 1 / 0))  # the client is not asked again
    assert ids(enrich.review_enriched(spark, base).read()) == [1, 2]
    assert enrich.enrichment_log(spark, base).read().count() == 2


def test_success_filter_does_not_repeat_the_work(spark):
    df = enrich.classify_by_rules(reviews(spark, ["a"]), "comment")
    once = enrich.validate_replies(df).filter("status = 'SUCCEEDED'")
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("StructsToJson") + plan.count("to_json") <= 2
