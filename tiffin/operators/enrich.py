"""Batch classification of reviews with a full attempt log."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.functions.text import clip, scrub_pii
from tiffin.operators.quality import LABELS, TOPICS
from tiffin.sources.tables import LayerTable

ENRICHMENT_LOG = (
    "batch_id string, review_id bigint, attempt_number int, status string, error_message string, model_name string, "
    "model_version string, prompt_version string, pii_redacted_count int, processed_at timestamp"
)
REVIEW_ENRICHED = (
    "review_id bigint, sentiment_label string, sentiment_score double, topic string, key_issue string, "
    "model_name string, model_version string, prompt_version string, batch_id string, pii_redacted_count int, "
    "processed_at timestamp"
)
BATCH_SIZE = None  # all pending reviews; a limit only where a caller asks for one
MAX_TRIES = 3

# A client takes a comment and returns (JSON reply, model version).
Client = Callable[[str], tuple[str, str]]


def enrichment_log(spark: SparkSession, warehouse: str) -> LayerTable:
    return LayerTable(spark, f"{warehouse}/ai/enrichment_log", ENRICHMENT_LOG)


def review_enriched(spark: SparkSession, warehouse: str) -> LayerTable:
    return LayerTable(spark, f"{warehouse}/ai/review_enriched", REVIEW_ENRICHED)


# --- which reviews, which attempt --------------------------------------------


def pending_reviews(
    reviews: DataFrame,
    enriched: DataFrame,
    log: DataFrame,
    batch_size: int | None = BATCH_SIZE,
    reprocess_failed: bool = False,
) -> DataFrame:
    """Reviews without a success, lowest ids first. Reviews with a failed attempt
    are left out unless asked for. With a ``batch_size`` the ids are put in order
    first and only the chosen ones meet their comments."""
    todo = reviews.select("review_id", "comment").join(enriched.select("review_id"), "review_id", "left_anti")
    if not reprocess_failed:
        failed = log.filter("status = 'FAILED'").select("review_id").distinct()
        todo = todo.join(failed, "review_id", "left_anti")
    if batch_size is None:
        return todo
    chosen = todo.select("review_id").orderBy("review_id").limit(batch_size)
    return todo.join(chosen, "review_id", "left_semi")


def with_attempt_number(pending: DataFrame, log: DataFrame) -> DataFrame:
    last = log.groupBy("review_id").agg(F.max("attempt_number").alias("_last"))
    return pending.join(last, "review_id", "left").select(
        *pending.columns, (F.coalesce("_last", F.lit(0)) + 1).cast("int").alias("attempt_number")
    )


# --- classification -----------------------------------------------------------


@dataclass(frozen=True)
class Rules:
    """Words that decide label and topic; lower-case letters a-z only."""

    positive: tuple[str, ...] = ("amazing", "delicious", "excellent", "fast", "fresh", "friendly", "good", "great",
                                 "love", "perfect", "polite", "quick", "tasty", "wonderful")
    negative: tuple[str, ...] = ("awful", "bad", "burnt", "cold", "damaged", "expensive", "horrible", "late",
                                 "leaked", "missing", "overpriced", "rude", "slow", "soggy", "spilled", "stale",
                                 "terrible", "worst", "wrong")
    topics: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "delivery": ("courier", "delivery", "driver", "late", "rider"),
        "packaging": ("box", "container", "damaged", "leaked", "packaging", "spilled"),
        "pricing": ("cheap", "expensive", "overpriced", "price", "pricey", "refund"),
        "service": ("polite", "rude", "service", "staff", "support"),
        "food quality": ("burnt", "cold", "delicious", "food", "fresh", "soggy", "stale", "taste", "tasty"),
    })


def classify_by_rules(df: DataFrame, text: str = "scrubbed", rules: Rules | None = None) -> DataFrame:
    """Replies in the classifier's JSON format, from listed words alone: each
    positive word adds 0.2 to the score, each negative one takes 0.2 off.

    One pass over the text finds the listed words; the rest looks at those.
    """
    rules = rules or Rules()
    listed = sorted({*rules.positive, *rules.negative, *(w for ws in rules.topics.values() for w in ws)})
    pattern = f"(?<![a-z])({'|'.join(listed)})(?![a-z])"
    found = df.withColumn("_found", F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1)))
    among = lambda words: F.filter("_found", lambda w: w.isin(list(words)))
    found = found.withColumn("_bad", among(rules.negative))
    steps = F.greatest(F.lit(-5), F.least(F.lit(5), F.size(among(rules.positive)) - F.size("_bad")))
    found = found.withColumn("_steps", steps)
    topic = F.when(F.lit(False), F.lit(None))
    for name, words in rules.topics.items():
        topic = topic.when(F.arrays_overlap("_found", F.array(*[F.lit(w) for w in words])), name)
    up, down = F.col("_steps") > 0, F.col("_steps") < 0
    reply = F.struct(
        F.when(up, "positive").when(down, "negative").otherwise("neutral").alias("sentiment_label"),
        (F.col("_steps") / 5.0).alias("sentiment_score"),
        topic.otherwise("other").alias("topic"),
        F.when(down, F.get("_bad", F.lit(0))).alias("key_issue"),
    )
    return found.select(
        *df.columns,
        F.to_json(reply).alias("reply"),
        F.lit("rules").alias("model_version"),
        F.lit(None).cast("string").alias("call_error"),
    )


def classify(
    df: DataFrame,
    make_client: Callable[[], Client],
    text: str = "scrubbed",
    max_tries: int = MAX_TRIES,
    parallelism: int | None = None,
    wait_seconds: tuple[float, float] = (1, 20),
) -> DataFrame:
    """Ask a client for each row: adds reply, model_version and call_error.

    One client is made per task. Timeouts and lost connections are tried again
    with growing waits; any other error stays with its row. ``parallelism``
    spreads a small batch over that many tasks.
    """
    if parallelism:
        df = df.repartition(parallelism)
    shortest, longest = wait_seconds

    def ask(client: Client, comment: str) -> tuple[str | None, str | None, str | None]:
        for attempt in range(max_tries):
            try:
                return (*client(comment), None)
            except (TimeoutError, ConnectionError) as exc:
                error = str(exc) or type(exc).__name__
                if attempt + 1 < max_tries:
                    time.sleep(min(longest, shortest * 2**attempt))
            except Exception as exc:
                return None, None, str(exc) or type(exc).__name__
        return None, None, error

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for frame in frames:
            answers = [ask(client, c) for c in frame[text]]
            out = frame.copy()
            for i, name in enumerate(("reply", "model_version", "call_error")):
                out[name] = pd.Series([a[i] for a in answers], index=frame.index, dtype="object")
            yield out

    answers = [T.StructField(c, T.StringType()) for c in ("reply", "model_version", "call_error")]
    return df.mapInPandas(run, T.StructType([*df.schema.fields, *answers]))


# --- validation ---------------------------------------------------------------


def validate_replies(df: DataFrame) -> DataFrame:
    """Read the JSON replies and check label, score and topic. Adds the parsed
    fields, ``error_message`` and ``status``; failures stay as rows.

    Fields are read as text and cast, so a score given as ``"0.5"`` is accepted.
    The text ``null`` is no issue. The outcome leaves through ``inline``: a
    filter on it stays above, where pushed below it would repeat the whole
    classification inside the filter.
    """
    fields = "sentiment_label string, sentiment_score string, topic string, key_issue string"
    label, score, topic, issue = (
        F.col(f"_p.{c}") for c in ("sentiment_label", "sentiment_score", "topic", "key_issue")
    )
    score = score.try_cast("double")
    known = lambda c, values: F.coalesce(c.isin(list(values)), F.lit(False))
    problem = (
        F.when(F.col("call_error").isNotNull(), F.col("call_error"))
        .when(F.col("reply").isNull(), "no reply")
        .when(~known(label, LABELS), F.concat(F.lit("bad sentiment_label in "), "reply"))
        .when(~F.coalesce(score.between(-1, 1), F.lit(False)), F.concat(F.lit("bad sentiment_score in "), "reply"))
        .when(~known(topic, TOPICS), F.concat(F.lit("bad topic in "), "reply"))
    )
    outcome = F.struct(
        label.alias("sentiment_label"),
        score.alias("sentiment_score"),
        topic.alias("topic"),
        F.when(F.lower(F.trim(issue)) != "null", issue).alias("key_issue"),
        clip(problem).alias("error_message"),
    )
    parsed = df.withColumn("_p", F.from_json("reply", fields))
    checked = parsed.select(*df.columns, F.inline(F.array(outcome)))
    return checked.withColumn("status", F.when(F.col("error_message").isNull(), "SUCCEEDED").otherwise("FAILED"))


def enrichment_rows(
    attempts: DataFrame, batch_id: str, model_name: str, prompt_version: str, processed_at: datetime | Column
) -> DataFrame:
    """Validated replies as attempt rows that carry the classification too."""
    at = processed_at if isinstance(processed_at, Column) else F.lit(processed_at)
    ok = F.col("status") == "SUCCEEDED"
    return attempts.select(
        F.lit(batch_id).alias("batch_id"),
        "review_id",
        "attempt_number",
        "status",
        "error_message",
        F.lit(model_name).alias("model_name"),
        F.when(ok, F.col("model_version")).alias("model_version"),
        F.lit(prompt_version).alias("prompt_version"),
        "pii_redacted_count",
        at.cast("timestamp").alias("processed_at"),
        *[F.when(ok, F.col(c)).alias(c) for c in ("sentiment_label", "sentiment_score", "topic", "key_issue")],
    )


def log_rows(rows: DataFrame) -> DataFrame:
    return rows.select(*[c.strip().split(" ")[0] for c in ENRICHMENT_LOG.split(",")])


def success_rows(rows: DataFrame) -> DataFrame:
    ok = rows.filter("status = 'SUCCEEDED'")
    return ok.select(*[c.strip().split(" ")[0] for c in REVIEW_ENRICHED.split(",")])


def batch_summary(rows: DataFrame) -> DataFrame:
    """Succeeded, failed, failure rate and redactions per batch."""
    total = F.count(F.lit(1)).cast("decimal(20,0)")
    failed = F.count_if(F.col("status") == "FAILED")
    return rows.groupBy("batch_id").agg(
        F.count_if(F.col("status") == "SUCCEEDED").alias("succeeded"),
        failed.alias("failed"),
        F.round(F.try_divide(failed.cast("decimal(20,0)"), total), 3).cast("double").alias("failure_rate"),
        F.sum("pii_redacted_count").alias("pii_redacted_count"),
    )


def run_batch(
    spark: SparkSession,
    warehouse: str,
    reviews: DataFrame,
    batch_id: str,
    *,
    make_client: Callable[[], Client] | None = None,
    rules: Rules | None = None,
    model_name: str = "rules",
    prompt_version: str = "v1",
    batch_size: int | None = BATCH_SIZE,
    reprocess_failed: bool = False,
    max_tries: int = MAX_TRIES,
    parallelism: int | None = None,
    processed_at: datetime | None = None,
) -> dict:
    """Classify the pending reviews and record every attempt.

    The classified rows are written out once and both tables are filled from
    that copy, log first: a lost executor does not ask the client twice, and a
    batch that stopped in between is finished from the copy by a rerun. With a
    ``batch_size`` the result's ``left_over`` counts the reviews still pending.
    """
    log, enriched = enrichment_log(spark, warehouse), review_enriched(spark, warehouse)
    done = LayerTable(spark, f"{warehouse}/ai/batches/{batch_id}")
    if not done.exists():
        todo = pending_reviews(reviews, enriched.read(), log.read(), batch_size, reprocess_failed)
        todo = scrub_pii(with_attempt_number(todo, log.read()), "comment")
        todo = todo.select("review_id", "attempt_number", "scrubbed", F.col("pii_redacted_count").cast("int"))
        if make_client is None:
            answered = classify_by_rules(todo, rules=rules)
        else:
            # The client is the slow part: every core of the cluster gets a share.
            spread = parallelism or spark.sparkContext.defaultParallelism
            answered = classify(todo, make_client, max_tries=max_tries, parallelism=spread)
        rows = enrichment_rows(
            validate_replies(answered), batch_id, model_name, prompt_version, processed_at or datetime.now(UTC)
        )
        done.append(rows)
    rows = done.read()
    logged = log.read().filter(F.col("batch_id") == batch_id).select("review_id", "attempt_number")
    log.append(log_rows(rows.join(logged, ["review_id", "attempt_number"], "left_anti")))
    written = enriched.read().select("review_id")
    enriched.append(success_rows(rows).join(written, "review_id", "left_anti"))
    summary = batch_summary(rows).first()
    if summary is None:
        empty = {"batch_id": batch_id, "succeeded": 0, "failed": 0, "failure_rate": 0.0, "pii_redacted_count": 0}
        return {**empty, "left_over": 0}
    left = 0
    if batch_size is not None:
        left = pending_reviews(reviews, enriched.read(), log.read(), None, reprocess_failed).count()
    return {**summary.asDict(), "left_over": left}
