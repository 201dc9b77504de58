"""Registered queries: the engine's models and operators on the trade tables.

Each takes (spark, folder of the tables) and returns a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.functions import metrics as m
from tiffin.functions.cleaning import title_case, to_number
from tiffin.functions.text import content_hash, scrub_pii
from tiffin.functions.vectors import cosine
from tiffin.operators import enrich, ivf, quality, retrieve, sketches
from tiffin.operators.percentiles import exact_percentiles, null_safe_left_join
from tiffin.operators.topk import cosine_topk
from tiffin.operators.windows import Windows
from tiffin.plans import catalog, daily, governed, marts, semantic, staging, trade
from tiffin.session import scratch_dir, settings
from tiffin.sources import control
from tiffin.sources.landing import SOURCE_COLUMNS, list_files, load_listed, load_sources, raw_table
from tiffin.sources.tables import LayerTable, in_slices, merged, newer_than, newest_time, slices_for, stored_bytes
from tiffin.streaming.landing_stream import stream_source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its name; decimals leave as doubles."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        return df.select(
            *[
                F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name
                for f in df.schema.fields
            ]
        )

    QUERIES[fn.__name__] = run
    return fn


# --- staging ----------------------------------------------------------------


@query
def stg_restaurants(spark, sf_dir):
    return staging.stg_restaurants(trade.raw_restaurants(spark, sf_dir))


@query
def stg_users(spark, sf_dir):
    return staging.stg_users(trade.raw_users(spark, sf_dir))


@query
def stg_food(spark, sf_dir):
    return staging.stg_food(trade.raw_food(spark, sf_dir))


@query
def stg_menu(spark, sf_dir):
    return staging.stg_menu(trade.raw_menu(spark, sf_dir))


@query
def stg_orders(spark, sf_dir):
    return staging.stg_orders(trade.raw_orders(spark, sf_dir))


@query
def stg_order_items(spark, sf_dir):
    return staging.stg_order_items(trade.raw_order_items(spark, sf_dir))


@query
def stg_reviews(spark, sf_dir):
    restaurants = staging.stg_restaurants(trade.raw_restaurants(spark, sf_dir))
    return staging.stg_reviews(trade.raw_reviews(spark, sf_dir), restaurants)


@query
def title_case_texts(spark, sf_dir):
    """Title casing of every text, as a fingerprint."""
    docs = trade.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(title_case("text")).alias("fingerprint"))


# --- dimensions and facts ---------------------------------------------------


@query
def dim_customer(spark, sf_dir):
    return marts.dim_customer(staging.stg_users(trade.raw_users(spark, sf_dir)))


@query
def dim_restaurants(spark, sf_dir):
    return marts.dim_restaurants(staging.stg_restaurants(trade.raw_restaurants(spark, sf_dir)))


@query
def dim_food(spark, sf_dir):
    return marts.dim_food(staging.stg_food(trade.raw_food(spark, sf_dir)))


@query
def dim_date_orders(spark, sf_dir):
    """The calendar over the span of the orders, with the orders of each day."""
    per_day = (
        trade.table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date_day"))
        .agg(F.count("*").alias("orders"))
    )
    first, last = per_day.agg(F.min("date_day"), F.max("date_day")).first()
    calendar = marts.dim_date(spark, str(first), str(last))
    return calendar.join(per_day, "date_day", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query
def fact_orders(spark, sf_dir):
    return marts.fact_orders(trade.orders_typed(spark, sf_dir))


@query
def fact_order_items(spark, sf_dir):
    items = staging.stg_order_items(trade.raw_order_items(spark, sf_dir))
    return marts.fact_order_items(items, trade.order_heads(spark, sf_dir))


# --- marts ------------------------------------------------------------------


@query
def mart_daily_city_revenue(spark, sf_dir):
    return marts.mart_daily_city_revenue(trade.order_heads(spark, sf_dir))


@query
def mart_restaurant_performance(spark, sf_dir):
    return marts.mart_restaurant_performance(
        trade.orders_typed(spark, sf_dir), trade.restaurants_typed(spark, sf_dir)
    )


@query
def mart_delivery_sla(spark, sf_dir):
    return marts.mart_delivery_sla(trade.orders_typed(spark, sf_dir))


@query
def event_hourly_sla(spark, sf_dir):
    """The delivery-time measures on event values, a wide domain of doubles."""
    events = trade.table(spark, sf_dir, "events").withColumn("event_hour", F.hour("ts"))
    keys = ["event_type", "event_hour"]
    rates = events.groupBy(*keys).agg(
        F.count("*").alias("n_events"), m.late_rate("value").alias("late_rate")
    )
    times = exact_percentiles(events, keys, "value", {"p50_value": 0.5, "p90_value": 0.9})
    return null_safe_left_join(rates, times, keys).withColumns(
        {"p50_value": F.round("p50_value", 6), "p90_value": F.round("p90_value", 6)}
    )


# --- semantic views ---------------------------------------------------------


def semantic_views(spark, sf_dir) -> dict[str, DataFrame]:
    orders = trade.orders_typed(spark, sf_dir)
    heads = trade.order_heads(spark, sf_dir)
    return semantic.build_semantic(
        orders=orders,
        customers=marts.dim_customer(staging.stg_users(trade.raw_users(spark, sf_dir))),
        revenue=marts.mart_daily_city_revenue(heads),
        restaurants=marts.mart_restaurant_performance(orders, trade.restaurants_typed(spark, sf_dir)),
        sla=marts.mart_delivery_sla(orders),
        reviews=trade.reviews_typed(spark, sf_dir),
    )


@query
def sem_orders(spark, sf_dir):
    return semantic_views(spark, sf_dir)["sem_orders"]


@query
def sem_revenue_daily(spark, sf_dir):
    return semantic_views(spark, sf_dir)["sem_revenue_daily"]


@query
def sem_restaurant_performance(spark, sf_dir):
    return semantic_views(spark, sf_dir)["sem_restaurant_performance"]


@query
def sem_delivery_sla(spark, sf_dir):
    return semantic_views(spark, sf_dir)["sem_delivery_sla"]


@query
def sem_reviews(spark, sf_dir):
    return semantic_views(spark, sf_dir)["sem_reviews"]


# --- facts that grow --------------------------------------------------------

# The first drop of orders ends on this day; low-priority orders come late.
FIRST_DROP_ENDS = "1998-06-30"


def _first_drop(heads: DataFrame) -> DataFrame:
    return heads.filter((F.col("order_date") <= F.lit(FIRST_DROP_ENDS).cast("date")) & (F.col("cuisine") != "5-LOW"))


FACT_COLUMNS = ["order_id", "order_timestamp", "order_date", "customer_id", "city", "order_status", "sales_amount"]


@query
def fact_orders_incremental(spark, sf_dir):
    """A second run takes only orders newer than the first drop's newest."""
    heads = trade.order_heads(spark, sf_dir)
    base = _first_drop(heads).select(*FACT_COLUMNS)
    batch = newer_than(heads.select(*FACT_COLUMNS), "order_timestamp", newest_time(base, "order_timestamp"))
    return merged(base, batch, ["order_id"])


@query
def fact_orders_lookback(spark, sf_dir):
    """The same through stored tables, reaching back a year: orders of that year
    get their new status and late ones come in."""
    heads = trade.order_heads(spark, sf_dir)
    target = LayerTable(spark, scratch_dir(spark, "fact_orders"))
    base = _first_drop(heads).withColumn("order_status", F.lit("Placed")).select(*FACT_COLUMNS)
    daily.merge_fact(target, base, "order_id", "order_timestamp")
    daily.merge_fact(target, heads.select(*FACT_COLUMNS), "order_id", "order_timestamp", "365 days")
    return target.read()


@query
def fact_orders_skipping(spark, sf_dir):
    """The lookback merge into a table that keeps statistics of its keys: months
    whose directories cannot hold an order of the batch are not read."""
    heads = trade.order_heads(spark, sf_dir)
    target = LayerTable(spark, scratch_dir(spark, "fact_orders"), keys=["order_id"])
    base = _first_drop(heads).withColumn("order_status", F.lit("Placed")).select(*FACT_COLUMNS)
    daily.merge_fact(target, base, "order_id", "order_timestamp")
    daily.merge_fact(target, heads.select(*FACT_COLUMNS), "order_id", "order_timestamp", "365 days")
    return target.read()


@query
def sla_sketch(spark, sf_dir):
    """Delivery minutes sketched per day and city and merged per city: whether the true ranks of the median and of the
    90th percentile found lie within the stated error."""
    orders = trade.orders_typed(spark, sf_dir).select("order_date", "city", F.col("delivery_time_min").cast("double").alias("minutes"))
    daily_sketches = sketches.quantile_sketches(orders, ["order_date", "city"], "minutes")
    found = sketches.merged_quantiles(daily_sketches, ["city"], {"p50": 0.5, "p90": 0.9})
    rows = orders.filter("minutes is not null").join(found, "city")
    checks = {}
    for name, rank in (("p50", 0.5), ("p90", 0.9)):
        low, high = (F.count_if(condition) / F.count("*") for condition in (F.col("minutes") < F.col(name), F.col("minutes") <= F.col(name)))
        checks[f"{name}_within"] = (low <= rank + sketches.RANK_ERROR) & (high >= rank - sketches.RANK_ERROR)
    return rows.groupBy("city").agg(F.max("n").alias("n"), *[c.alias(name) for name, c in checks.items()])


@query
def customers_rolling(spark, sf_dir):
    """Distinct customers of the 30 days up to each day, and of each quarter those who came in the one before, by
    sketches; whether each is within the stated error of the exact count."""
    heads = trade.order_heads(spark, sf_dir).select("order_date", "customer_id")
    quarter = (F.year("order_date") * 4 + F.quarter("order_date")).alias("quarter")
    by_day = sketches.rolling_distinct(sketches.distinct_sketches(heads, ["order_date"], "customer_id"), "order_date", 30)
    exact = sketches.exact_rolling_distinct(heads, "order_date", "customer_id", 30).withColumnRenamed("distinct", "exact")
    near = lambda c: F.abs(F.col(c) - F.col("exact")) <= 2 + sketches.COUNT_ERROR * F.col("exact")
    rolling = by_day.join(exact, "order_date").select(
        F.lit("rolling").alias("kind"), F.col("order_date").cast("string").alias("period"), "exact", near("distinct").alias("within")
    )
    quarters = heads.select(quarter, "customer_id").distinct()
    before = quarters.select((F.col("quarter") + 1).alias("quarter"), "customer_id")
    back = quarters.join(before, ["quarter", "customer_id"]).groupBy("quarter").agg(F.count("*").alias("exact"))
    found = sketches.returning(sketches.period_sketches(quarters, ["quarter"], "customer_id"), "quarter")
    returned = found.join(back, "quarter", "left").withColumn("exact", F.coalesce("exact", F.lit(0))).select(
        F.lit("returning").alias("kind"), F.col("quarter").cast("string").alias("period"), "exact", near("returning").alias("within")
    )
    return rolling.unionByName(returned)


# --- metrics and governed SQL -----------------------------------------------


@query
def metric_customer_count(spark, sf_dir):
    return catalog.metric_value(trade.order_heads(spark, sf_dir), "customer_count")


@query
def metric_restaurant_revenue(spark, sf_dir):
    return catalog.metric_value(trade.orders_typed(spark, sf_dir), "restaurant_revenue")


@query
def metric_aov_by_city(spark, sf_dir):
    return catalog.metric_value(trade.order_heads(spark, sf_dir), "aov", by=("city",))


@query
def metric_lookup_gmv(spark, sf_dir):
    return catalog.metric_rows(semantic_views(spark, sf_dir), "gmv", limit=999_999)


@query
def governed_query(spark, sf_dir):
    semantic.register_views(semantic_views(spark, sf_dir))
    return governed.governed_sql(
        spark,
        """
        WITH busy AS (SELECT city, order_date, orders, gross_merchandise_value FROM semantic.sem_revenue_daily
                      WHERE orders > 1)
        SELECT city, year(order_date) AS order_year, sum(orders) AS n_orders, sum(gross_merchandise_value) AS gmv
        FROM busy GROUP BY city, year(order_date) ORDER BY gmv DESC, city, order_year
        """,
        row_limit=50,
    )


@query
def governed_union(spark, sf_dir):
    semantic.register_views(semantic_views(spark, sf_dir))
    return governed.governed_sql(
        spark,
        "SELECT city FROM sem_orders WHERE is_delivered UNION SELECT city FROM sem_reviews ORDER BY city LIMIT 30",
    )


# --- data checks --------------------------------------------------------------


def _models(spark, sf_dir) -> dict[str, DataFrame]:
    orders = trade.orders_typed(spark, sf_dir)
    staged = staging.build_staging(trade.raw_tables(spark, sf_dir))
    return staged | {
        "fact_orders": orders,
        "fact_order_items": marts.fact_order_items(staged["stg_order_items"], trade.order_heads(spark, sf_dir)),
        "dim_customer": marts.dim_customer(staged["stg_users"]),
        "dim_restaurants": marts.dim_restaurants(staged["stg_restaurants"]),
        "dim_food": marts.dim_food(staged["stg_food"]),
        "dim_date": marts.dim_date(spark),
        "mart_daily_city_revenue": marts.mart_daily_city_revenue(trade.order_heads(spark, sf_dir)),
        "mart_restaurant_performance": marts.mart_restaurant_performance(
            orders, trade.restaurants_typed(spark, sf_dir)
        ),
    }


@query
def dq_staging(spark, sf_dir):
    return quality.run_checks(_models(spark, sf_dir), quality.STAGING_CHECKS)


@query
def dq_marts(spark, sf_dir):
    return quality.run_checks(_models(spark, sf_dir), quality.MART_CHECKS)


@query
def dq_semantic(spark, sf_dir):
    return quality.run_checks(semantic_views(spark, sf_dir), quality.SEMANTIC_CHECKS)


@query
def dq_contract_fact_orders(spark, sf_dir):
    return quality.run_checks(_models(spark, sf_dir), quality.CONTRACTS["fact_orders"].checks())


@query
def dq_unique(spark, sf_dir):
    """Order and line numbers that come more than once."""
    lines = trade.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id")
    )
    return quality.failing_rows(lines, quality.Check("lineitem", "order_item_id", "unique"))


@query
def dq_not_null(spark, sf_dir):
    orders = trade.orders_typed(spark, sf_dir).select("order_id", "restaurant_id", "city")
    return quality.failing_rows(orders, quality.Check("fact_orders", "restaurant_id", "not_null"))


@query
def dq_accepted_values(spark, sf_dir):
    orders = trade.order_heads(spark, sf_dir).select("order_id", "order_status")
    check = quality.Check("fact_orders", "order_status", "accepted_values", values=("Delivered", "Cancelled"))
    return quality.failing_rows(orders, check)


@query
def dq_relationships(spark, sf_dir):
    """Orders without any line."""
    orders = trade.order_heads(spark, sf_dir).select("order_id", "city")
    check = quality.Check("fact_orders", "order_id", "relationships", parent="lineitem", parent_column="l_orderkey")
    return quality.failing_rows(orders, check, {"lineitem": trade.table(spark, sf_dir, "lineitem")})


@query
def dq_expression(spark, sf_dir):
    customers = trade.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return quality.failing_rows(customers, quality.Check("customer", "c_acctbal", "expression", expression=">= 0"))


@query
def dq_freshness(spark, sf_dir):
    """Freshness of the events, seen half an hour after their day's end."""
    events = trade.table(spark, sf_dir, "events")
    now = F.lit("2024-02-02 00:30:00").cast("timestamp_ntz")
    return quality.freshness(events, "events", "ts", now).select(
        "table_name", F.round("age_hours", 6).alias("age_hours"), "status"
    )


@query
def dq_freshness_loads(spark, sf_dir):
    """Freshness from control rows: events as load results, a source per kind of event, whose errors bring no rows."""
    runs = trade.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"),
        F.when(F.col("event_type") == "error", control.FAILED).otherwise(control.SUCCEEDED).alias("status"),
        F.when(F.col("event_type") != "view", 1).otherwise(0).alias("row_count"),
        F.col("ts").alias("ingestion_timestamp"),
    )
    newest = control.newest_loads(runs).select(F.col("source").alias("table_name"), F.col("newest").cast("timestamp"))
    return quality.freshness_of(newest, F.lit("2024-02-02 00:30:00").cast("timestamp")).select(
        "table_name", F.round("age_hours", 6).alias("age_hours"), "status"
    )


@query
def dq_parity(spark, sf_dir):
    heads = trade.order_heads(spark, sf_dir)
    views = semantic_views(spark, sf_dir)
    gold = {
        "sem_orders": heads,
        "sem_revenue_daily": marts.mart_daily_city_revenue(heads),
        "sem_reviews": trade.table(spark, sf_dir, "documents"),
    }
    return quality.row_parity({v: (df, views[v]) for v, df in gold.items()})


# --- reviews: redaction, classification, insights ----------------------------

# The sample texts are invented prose, so the lexicon is made of its words.
SAMPLE_RULES = enrich.Rules(
    positive=("the", "le", "der", "el", "with"),
    negative=("of", "de", "die", "que", "this"),
    topics={
        "delivery": ("license", "permission"),
        "packaging": ("thing", "ouan"),
        "pricing": ("des", "und"),
        "service": ("from", "est"),
        "food quality": ("that", "les"),
    },
)


@query
def pii_scrub(spark, sf_dir):
    """Redactions of every text, with a fingerprint of the scrubbed text in which
    each character beyond ASCII stands as ``a``."""
    docs = scrub_pii(trade.table(spark, sf_dir, "documents"), "text")
    plain = F.regexp_replace("scrubbed", r"[^\x00-\x7F]", "a")
    return docs.select(
        "doc_id", "pii_redacted_count", F.length("scrubbed").alias("n_scrubbed"), F.md5(plain).alias("fingerprint")
    )


def _labelled(spark, sf_dir) -> DataFrame:
    return trade.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("review_id"), "quality", "toxic")


def _past_batches(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(enriched, log): good labelled texts succeeded, the others failed twice."""
    past = _labelled(spark, sf_dir)
    enriched = past.filter("quality = 1").select("review_id")
    tries = F.when(F.col("quality") == 1, F.sequence(F.lit(1), F.lit(1))).otherwise(F.sequence(F.lit(1), F.lit(2)))
    log = past.select(
        "review_id",
        F.explode(tries).alias("attempt_number"),
        F.when(F.col("quality") == 1, "SUCCEEDED").otherwise("FAILED").alias("status"),
    )
    return enriched, log


@query
def review_pending(spark, sf_dir):
    reviews = trade.reviews_typed(spark, sf_dir)
    return enrich.pending_reviews(reviews, *_past_batches(spark, sf_dir), batch_size=None).select("review_id")


@query
def review_pending_batch(spark, sf_dir):
    reviews = trade.reviews_typed(spark, sf_dir)
    pending = enrich.pending_reviews(reviews, *_past_batches(spark, sf_dir), batch_size=50, reprocess_failed=True)
    return pending.select("review_id")


@query
def review_attempts(spark, sf_dir):
    reviews = trade.reviews_typed(spark, sf_dir).select("review_id")
    return enrich.with_attempt_number(reviews, _past_batches(spark, sf_dir)[1])


def _classified(spark, sf_dir) -> DataFrame:
    """All reviews scrubbed, classified by rules and validated."""
    reviews = scrub_pii(trade.reviews_typed(spark, sf_dir).select("review_id", "comment"), "comment")
    first = reviews.withColumn("attempt_number", F.lit(1))
    return enrich.validate_replies(enrich.classify_by_rules(first, rules=SAMPLE_RULES))


@query
def review_classified(spark, sf_dir):
    return _classified(spark, sf_dir).select(
        "review_id", "status", "sentiment_label", "sentiment_score", "topic", "key_issue", "pii_redacted_count"
    )


@query
def review_insights(spark, sf_dir):
    at = F.lit("2024-01-01 00:00:00")
    rows = enrich.enrichment_rows(_classified(spark, sf_dir), "batch", "rules", "v1", at)
    return marts.mart_review_insights(enrich.success_rows(rows), trade.reviews_typed(spark, sf_dir))


def _replies(spark, sf_dir) -> DataFrame:
    """Model replies of mixed quality, one per labelled text."""
    score = F.when(F.col("toxic") == 1, F.lit("-1.5")).otherwise(F.lit('"0.5"'))
    label = F.when(F.col("quality") == 1, "positive").otherwise("very positive")
    valid = F.concat(
        F.lit('{"sentiment_label": "'), label, F.lit('", "sentiment_score": '), score,
        F.lit(', "topic": "food quality", "key_issue": "null", "extra": [1]}'),
    )
    docs = trade.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("review_id"), "source")
    return docs.join(_labelled(spark, sf_dir), "review_id", "left").select(
        "review_id",
        "source",
        F.when(F.col("quality").isNull(), F.concat(F.lit("I think "), "source")).otherwise(valid).alias("reply"),
        F.lit("m-1").alias("model_version"),
        F.lit(None).cast("string").alias("call_error"),
    )


@query
def reply_validation(spark, sf_dir):
    return enrich.validate_replies(_replies(spark, sf_dir)).select(
        "review_id", "status", F.regexp_extract("error_message", "^bad [a-z_]+", 0).alias("error_kind"),
        "sentiment_score", "key_issue",
    )


@query
def enrichment_gate(spark, sf_dir):
    """Failed share per batch, a batch being the reviews of one source."""
    log = enrich.validate_replies(_replies(spark, sf_dir)).withColumn("batch_id", F.col("source"))
    return quality.failure_share(log).select(
        "batch_id", "succeeded", "failed", F.round("failure_rate", 3).alias("failure_rate"),
        (F.col("failure_rate") > F.lit(0.2).cast("decimal(2,1)")).alias("blocked"),
    )


@query
def enrichment_summary(spark, sf_dir):
    """Outcome and redactions per batch, a batch being the reviews of one city."""
    reviews = trade.reviews_typed(spark, sf_dir).select("review_id", "comment", F.col("city").alias("batch_id"))
    answered = enrich.classify_by_rules(scrub_pii(reviews, "comment"), rules=SAMPLE_RULES)
    return enrich.batch_summary(enrich.validate_replies(answered))


def sample_client() -> enrich.Client:
    """Stands for a model: calm about everything, but it refuses licence texts."""

    def answer(comment: str) -> tuple[str, str]:
        if "license" in comment:
            raise ValueError("refused")
        return '{"sentiment_label": "neutral", "sentiment_score": 0, "topic": "other", "key_issue": null}', "m-1"

    return answer


@query
def enrichment_batch(spark, sf_dir):
    """All reviews sent to a client, then the failed ones once more; the log."""
    base = scratch_dir(spark, "enrichment")
    reviews = trade.reviews_typed(spark, sf_dir)
    for batch in ("b-1", "b-2"):
        enrich.run_batch(
            spark, base, reviews, batch, make_client=sample_client, model_name="m",
            reprocess_failed=True,
        )
    return enrich.enrichment_log(spark, base).read().drop("processed_at")


@query
def enrichment_success(spark, sf_dir):
    """The success table after two batches of which the second asks again for what failed."""
    base = scratch_dir(spark, "enrichment-success")
    reviews = trade.reviews_typed(spark, sf_dir)
    for batch in ("b-1", "b-2"):
        enrich.run_batch(
            spark, base, reviews, batch, make_client=sample_client, model_name="m", prompt_version="v2",
            reprocess_failed=True,
        )
    return enrich.review_enriched(spark, base).read().drop("processed_at", "pii_redacted_count")


# --- retrieval ----------------------------------------------------------------


def _centroids(spark, sf_dir) -> DataFrame:
    """The mean vector of every label, as queries."""
    numbers = trade.table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = numbers.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    # One list entry per vector position.
    ordered = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return means.groupBy(F.col("label").alias("query_id")).agg(F.transform(ordered, lambda p: p["x"]).alias("vector"))


def _nearest(spark, sf_dir) -> DataFrame:
    store = trade.table(spark, sf_dir, "embeddings")
    return cosine_topk(store, _centroids(spark, sf_dir), 5, item_id="vec_id", item_vector="embedding")


@query
def embedding_topk(spark, sf_dir):
    return _nearest(spark, sf_dir).withColumn("score", F.round("score", 6))


@query
def embedding_ivf(spark, sf_dir):
    """Every fiftieth vector asked of an inverted file: the answer of all cells, which is exact, and whether three
    quarters of the cells find nine tenths of it (the vectors given have no clusters)."""
    store = trade.table(spark, sf_dir, "embeddings")
    asked = store.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    index = ivf.build_index(store, item_id="vec_id", item_vector="embedding")
    cells = len(index.centroids)
    path = scratch_dir(spark, "ivf-whole")  # asked of twice and returned
    ivf.search(index, asked, 5, probes=cells).write.parquet(path)
    whole = spark.read.parquet(path)
    near = ivf.search(index, asked, 5, probes=-(-3 * cells // 4))
    reached = ivf.recall(near, whole, item_id="vec_id") >= 0.9
    return whole.select("query_id", "vec_id", F.round("score", 6).alias("score"), "rank", F.lit(reached).alias("recall_reached"))


@query
def centroid_similarity(spark, sf_dir):
    """Every vector against the centroid of its own label."""
    e = trade.table(spark, sf_dir, "embeddings").withColumnRenamed("label", "query_id")
    both = e.join(_centroids(spark, sf_dir), "query_id")
    return both.select("vec_id", F.round(cosine("embedding", "vector"), 6).alias("similarity"))


@query
def context_assembly(spark, sf_dir):
    hits = _nearest(spark, sf_dir).withColumn("chunk_id", F.col("vec_id").cast("string"))
    store = retrieve.chunks(retrieve.documents(trade.reviews_typed(spark, sf_dir), sample_size=None))
    return retrieve.context(hits.join(store, "chunk_id"))


WINDOWS = Windows(size=400, overlap=120, slack=100)


@query
def chunk_windows(spark, sf_dir):
    """Every document in overlapping windows cut at sentence ends, with the characters each holds."""
    docs = trade.table(spark, sf_dir, "documents").withColumn("metadata", F.create_map(F.lit("lang"), F.col("lang")))
    pieces = retrieve.chunks(docs, WINDOWS)
    return pieces.select(
        "chunk_id", "doc_id", F.element_at("metadata", "chars").alias("chars"), content_hash("text").alias("content_hash")
    )


@query
def review_sample(spark, sf_dir):
    return retrieve.documents(trade.reviews_typed(spark, sf_dir), sample_size=500, seed=7).select(
        "doc_id", F.element_at("metadata", "review_date").alias("review_date")
    )


@query
def embed_cache_misses(spark, sf_dir):
    """Distinct texts yet to be embedded when English is already cached."""
    docs = trade.table(spark, sf_dir, "documents")
    cache = docs.filter("lang = 'en'").select(content_hash("text").alias("content_hash")).distinct()
    return retrieve.unseen_texts(docs, cache).select("content_hash", F.length("text").alias("n_chars"))


@query
def embed_reviews(spark, sf_dir):
    """All reviews embedded through an empty cache; copies share one vector."""
    base = scratch_dir(spark, "embed")
    pieces = retrieve.chunks(retrieve.documents(trade.reviews_typed(spark, sf_dir), sample_size=None))
    cache = retrieve.embedding_cache(spark, base)
    embedded = retrieve.embed_with_cache(pieces, cache, retrieve.letter_embedder)
    numbers = F.array_join(F.transform("vector", lambda x: x.cast("int").cast("string")), " ")
    return embedded.select("chunk_id", numbers.alias("numbers"), content_hash("text").alias("content_hash"))


@query
def review_retrieval(spark, sf_dir):
    """All reviews indexed, and the context for two questions."""
    base = scratch_dir(spark, "retrieval")
    reviews = trade.reviews_typed(spark, sf_dir)
    store = retrieve.index_reviews(spark, base, reviews, retrieve.letter_embedder)
    questions = ["license and permission", "who is it for"]
    return retrieve.context(retrieve.retrieve(spark, store.read(), questions, retrieve.letter_embedder))


@query
def vector_upsert(spark, sf_dir):
    """Two batches into a stored table, the first with every chunk twice: of a
    chunk the last write stays, within a batch and across batches."""
    e = trade.table(spark, sf_dir, "embeddings")
    row = lambda batch, position, text: e.select(
        F.col("vec_id").cast("string").alias("chunk_id"), F.lit(text).alias("text"), "label",
        F.lit(batch).alias("batch"), F.lit(position).alias("position"),
    )
    store = LayerTable(spark, f"{scratch_dir(spark, 'vectors')}/store", "chunk_id string, text string, label int")
    batches = [row(0, 0, "draft").unionByName(row(0, 1, "first")), row(1, 0, "second").filter("label >= 5")]
    for batch in batches:
        store.upsert(retrieve.last_write_wins(batch), ["chunk_id"])
    return store.read().select("chunk_id", "text", "label")


# --- loads --------------------------------------------------------------------


# Rows of a compressed landing file, which is read by one task.
PACKED_ROWS, PACKED_REVIEWS = 100_000, 5_000


def _landing_writer(rows: DataFrame, source: str, packed: bool) -> DataFrameWriter:
    writer = rows.write.option("header", True).option("escape", '"').option("nullValue", "").option("emptyValue", '""')
    if not packed:
        return writer
    most = PACKED_REVIEWS if source == "reviews" else PACKED_ROWS
    return writer.options(compression="gzip", maxRecordsPerFile=most).option("zlib.compress.level", "BEST_SPEED")


def export_landing(
    spark, sf_dir, landing: str, sources: list[str], files: int | None = None, raw: dict[str, DataFrame] | None = None,
    packed: bool = False,
) -> None:
    """Write the text tables of the sources side by side as landing files, of a given number or as many as Spark likes;
    ``packed``: as compressed files of bounded size."""
    raw = raw or trade.raw_tables(spark, sf_dir)

    def write(source: str) -> None:
        rows = raw[source].select(*SOURCE_COLUMNS[source])
        rows = rows.repartition(files) if files else rows
        _landing_writer(rows, source, packed).csv(f"{landing}/{source}")

    with ThreadPoolExecutor(max(1, len(sources))) as pool:
        for done in [pool.submit(write, source) for source in sources]:
            done.result()


@query
def record_hash_items(spark, sf_dir):
    return trade.raw_order_items(spark, sf_dir).select("order_item_id", "_record_hash")


@query
def new_files(spark, sf_dir):
    """Documents as landing files, labels as what past runs recorded of them."""
    files = trade.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("file_name"), "source")
    runs = trade.table(spark, sf_dir, "labels").select(
        F.lit("documents").alias("source"),
        F.col("doc_id").cast("string").alias("file_name"),
        F.when(F.col("quality") == 1, control.SUCCEEDED).otherwise(control.FAILED).alias("status"),
    )
    new, _ = control.split_new_files(files, runs, "documents")
    return new


@query
def load_gate(spark, sf_dir):
    """Events as load results: a run per hour, a source per user."""
    runs = trade.table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd HH").alias("run_id"),
        F.concat(F.lit("s"), "user_id").alias("source"),
        F.when(F.col("event_type") != "view", 1).alias("row_count"),
        F.when(F.col("event_type") == "error", control.FAILED).otherwise(control.SUCCEEDED).alias("status"),
    )
    return control.load_summary(runs)


@query
def csv_load(spark, sf_dir):
    """Reviews written as CSV files, whole texts with line breaks and quotes, and
    loaded into the raw table."""
    base = scratch_dir(spark, "csv_load")
    export_landing(spark, sf_dir, f"{base}/landing", ["reviews"])
    load_sources(spark, f"{base}/landing", f"{base}/warehouse", "run-1", ["reviews"])
    return raw_table(spark, f"{base}/warehouse", "reviews").read().select(
        "review_id", "rating", "review_date", F.md5("comment").alias("comment_md5"), "_batch_id", "_record_hash"
    )


@query
def csv_split_load(spark, sf_dir):
    """The same load from few files in many blocks, so that fields run over the ends of blocks."""
    base = scratch_dir(spark, "csv_split_load")
    export_landing(spark, sf_dir, f"{base}/landing", ["reviews"], files=2)
    # A task takes several blocks, as every task sends its measures to the driver.
    blocks = {"spark.sql.files.maxPartitionBytes": "64KB", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.maxPartitionNum": "256"}
    with settings(spark, blocks):
        load_sources(spark, f"{base}/landing", f"{base}/warehouse", "run-1", ["reviews"])
    return raw_table(spark, f"{base}/warehouse", "reviews").read().select(
        "review_id", "rating", "review_date", F.md5("comment").alias("comment_md5"), "_batch_id", "_record_hash"
    )


@query
def ingestion_runs(spark, sf_dir):
    """Three sources loaded by two runs: the second one finds nothing new."""
    base = scratch_dir(spark, "ingestion_runs")
    sources = ["food", "menu", "users"]
    export_landing(spark, sf_dir, f"{base}/landing", sources)
    for run in ("run-1", "run-2"):
        load_sources(spark, f"{base}/landing", f"{base}/warehouse", run, sources)
    runs = control.ingestion_runs(spark, f"{base}/warehouse").read()
    return runs.groupBy("run_id", "source", "status").agg(F.sum("row_count").alias("row_count"))


TORN_FILES = 4


@query
def torn_load(spark, sf_dir):
    """Whole files beside files whose quoted fields are never closed, loaded twice:
    the torn files fail with no rows, both times, and the others load once."""
    base = scratch_dir(spark, "torn_load")
    export_landing(spark, sf_dir, f"{base}/landing", ["food"])
    torn = trade.table(spark, sf_dir, "part").select(F.format_string('0,fd%d,"%s,veg', "p_partkey", "p_name").alias("value"))
    torn.repartition(TORN_FILES, "value").write.mode("append").text(f"{base}/landing/food")
    for run in ("run-1", "run-2"):
        load_sources(spark, f"{base}/landing", f"{base}/warehouse", run, ["food"])
    runs = control.ingestion_runs(spark, f"{base}/warehouse").read()
    return runs.groupBy("run_id", "status").agg(
        F.sum("row_count").alias("row_count"),
        F.count_if(F.col("status") == control.FAILED).alias("failed_files"),
        F.max("error_message").alias("error_message"),
    )


@query
def lineage_runs(spark, sf_dir):
    base = scratch_dir(spark, "lineage")
    export_landing(spark, sf_dir, f"{base}/landing", ["restaurants", "food"])
    load_sources(spark, f"{base}/landing", f"{base}/warehouse", "run-1", ["restaurants", "food"])
    lineage = control.lineage_runs(spark, f"{base}/warehouse").read()
    return lineage.select("run_id", "source", "output_table", "state", "row_count")


@query
def stream_load(spark, sf_dir):
    """The same files as a stream that stops when it has caught up; started
    twice, it loads each file once."""
    base = scratch_dir(spark, "stream_load")
    export_landing(spark, sf_dir, f"{base}/landing", ["food"])
    for run in ("run-1", "run-2"):
        stream_source(spark, f"{base}/landing", f"{base}/warehouse", "food", run).awaitTermination()
    return raw_table(spark, f"{base}/warehouse", "food").read().select("f_id", "item", "_batch_id", "_record_hash")


@query
def stream_control(spark, sf_dir):
    """Whole and torn files as a stream of small batches, then all files once more under another run, as a batch
    that is played again: what the control table and the lineage say of both."""
    base = scratch_dir(spark, "stream_control")
    landing, warehouse = f"{base}/landing", f"{base}/warehouse"
    export_landing(spark, sf_dir, landing, ["food"], files=3)
    torn = trade.table(spark, sf_dir, "part").select(F.format_string('0,fd%d,"%s,veg', "p_partkey", "p_name").alias("value"))
    torn.repartition(TORN_FILES, "value").write.mode("append").text(f"{landing}/food")
    stream_source(spark, landing, warehouse, "food", "run-1", files_per_batch=4).awaitTermination()
    load_listed(spark, warehouse, "food", list_files(spark, landing, "food"), "run-2")
    runs = control.ingestion_runs(spark, warehouse).read().groupBy("run_id", "status").agg(
        F.sum("row_count").alias("row_count"),
        F.count_if(F.col("status") == control.FAILED).alias("failed_files"),
    )
    lineage = control.lineage_runs(spark, warehouse).read().select(
        "run_id", "state", F.col("row_count").alias("run_rows")
    )
    loaded = raw_table(spark, warehouse, "food").read().groupBy(F.col("_batch_id").alias("run_id")).agg(
        F.count("*").alias("stored_rows")
    )
    return runs.join(lineage, "run_id").join(loaded, "run_id", "left")


@query
def daily_run(spark, sf_dir):
    """All sources from CSV files to published marts; the summary row of the run."""
    base = scratch_dir(spark, "daily_run")
    export_landing(spark, sf_dir, f"{base}/landing", list(SOURCE_COLUMNS), packed=True)
    config = daily.DailyConfig(f"{base}/landing", f"{base}/warehouse", "run-1", rules=SAMPLE_RULES)
    daily.run(spark, config)
    summary = control.pipeline_runs(spark, config.warehouse).read()
    return summary.select("run_id", "status", "rows_ingested", "dq_status", "ai_success_count", "ai_fail_count")


# Bytes that orders take as text, for one of the typed table.
TEXT_SIZE = 8


def _two_days(spark, sf_dir, base: str) -> daily.DailyConfig:
    """Two days of files: most orders with their first status, then all that changed and the rest."""
    raw = trade.raw_tables(spark, sf_dir)
    first = F.pmod(F.xxhash64("order_id"), F.lit(10)) < 8
    again = first & (F.pmod(F.xxhash64("order_id"), F.lit(3)) == 0)
    held = slices_for(TEXT_SIZE * stored_bytes(spark, f"{sf_dir}/orders.parquet"))
    orders = [staging.latest_good_orders(rows) for rows in in_slices(raw["orders"], [to_number("order_id")], held)]
    status = F.when(again, F.lit("Cancelled")).otherwise(F.col("order_status"))
    days = [[o.filter(first).withColumn("order_status", status) for o in orders], [o.filter(~first | again) for o in orders]]
    config = daily.DailyConfig(f"{base}/landing", f"{base}/warehouse", "day-1", lookback="36500 days")
    export_landing(spark, sf_dir, config.landing, [s for s in SOURCE_COLUMNS if s != "orders"], raw=raw, packed=True)
    for number, slices in enumerate(days, 1):
        for rows in slices:
            written = rows.select(*SOURCE_COLUMNS["orders"])
            _landing_writer(written, "orders", packed=True).mode("append").csv(f"{config.landing}/orders")
        config.run_id = f"day-{number}"
        state = daily.RunState()
        daily.load(spark, config, state)
        daily.build_marts(spark, config, daily.stage(spark, config), state)
    return config


@query
def daily_two_days(spark, sf_dir):
    """Staging, facts and the revenue mart after a second day that was merged in: what the mart says of each day and
    city, and what the facts hold of it."""
    config = _two_days(spark, sf_dir, scratch_dir(spark, "two_days"))
    mart, facts = (daily.table(spark, config, "marts", n).read() for n in ("mart_daily_city_revenue", "fact_orders"))
    held = facts.groupBy("order_date", "city").agg(
        F.count("*").alias("fact_rows"), F.count_if("is_delivered").alias("fact_delivered")
    )
    return mart.join(held, ["order_date", "city"], "left")
