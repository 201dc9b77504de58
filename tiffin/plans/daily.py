"""The daily run: load, gates, staging, marts, views, enrichment, publish.

Nine stages in order; a gate that fails ends the run, and either way one
summary row is written. Tables are Parquet, one folder per layer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.operators import enrich, quality
from tiffin.plans import catalog, changes, marts, semantic, staging
from tiffin.sources import control
from tiffin.sources.landing import SOURCE_COLUMNS, load_sources, raw_table
from tiffin.sources.tables import Change, LayerTable, incremental_rows


MARTS = [
    "dim_customer", "dim_restaurants", "dim_food", "dim_date", "fact_orders", "fact_order_items",
    "mart_daily_city_revenue", "mart_restaurant_performance", "mart_delivery_sla",
]


@dataclass
class DailyConfig:
    landing: str
    warehouse: str
    run_id: str
    now: datetime | None = None  # clock of the run; the present time if not set
    lookback: str | None = None  # how far back late orders are still merged
    late_after_minutes: float = 45
    batch_size: int | None = enrich.BATCH_SIZE
    make_client: Callable[[], enrich.Client] | None = None
    rules: enrich.Rules | None = None
    model_name: str = "rules"
    prompt_version: str = "v1"
    failure_limit: float = 0.2
    max_order_age_hours: float | None = None  # warn when the newest order is older
    writers: int = 4  # tables written at the same time
    one_line_sources: tuple[str, ...] = ()  # sources without line breaks in fields; their files are split


@dataclass
class RunState:
    rows_ingested: int = 0
    warned: bool = False
    enrichment: dict = field(default_factory=dict)

    def note(self, status: str) -> None:
        self.warned = self.warned or status == "warned"


def run(spark: SparkSession, config: DailyConfig) -> dict:
    """Run all stages; returns the summary that was recorded."""
    started = config.now or datetime.now(UTC)
    summary = control.pipeline_runs(spark, config.warehouse)
    state = RunState()
    try:
        load(spark, config, state)
        staged = stage(spark, config)
        check_staging(spark, config, staged, state)
        gold = build_marts(spark, config, staged, state)
        views = build_views(gold, staged, state)
        enrich_reviews(spark, config, staged, state)
        publish(spark, config, staged)
    except Exception:
        control.record_failure(summary, config.run_id, started, state.rows_ingested)
        raise
    semantic.register_views(views)
    result = {
        "status": "SUCCESS",
        "rows_ingested": state.rows_ingested,
        "dq_status": "warned" if state.warned else "passed",
        "ai_success_count": state.enrichment["succeeded"],
        "ai_fail_count": state.enrichment["failed"],
    }
    control.record_pipeline_run(summary, run_id=config.run_id, started_at=started, finished_at=config.now, **result)
    of_run = summary.read().filter(F.col("run_id") == config.run_id)
    quality.gate(quality.run_checks({"pipeline_runs": of_run}, quality.CONTRACTS["pipeline_runs"].checks()))
    tidy(spark, config)
    return result


def tidy(spark: SparkSession, config: DailyConfig) -> None:
    """Delete what only snapshots before the last two use, so that tables do not
    grow by the number of runs. Readers of the run before still find their files."""
    names = {"staging": [f"stg_{s}" for s in SOURCE_COLUMNS], "marts": [*MARTS, "mart_review_insights"]}
    names["marts"].append("sums_daily_city_revenue")
    names["raw"] = list(SOURCE_COLUMNS)
    names["control"] = [f"staged_{s}" for s in SOURCE_COLUMNS]
    names["control"] += ["views_applied", "ingestion_runs", "lineage_runs", "recorded_writes", "pipeline_runs"]
    for layer, tables in names.items():
        for name in tables:
            table(spark, config, layer, name).expire(keep=2)


def table(spark: SparkSession, config: DailyConfig, layer: str, name: str, keys: Sequence[str] = ()) -> LayerTable:
    return LayerTable(spark, f"{config.warehouse}/{layer}/{name}", keys=keys)


def _write_all(config: DailyConfig, jobs: list[Callable[[], None]]) -> None:
    """Independent tables are written side by side; the first error is raised."""
    with ThreadPoolExecutor(config.writers) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def _release(change: Change | None) -> None:
    """Nobody asks for the rows of this change any more."""
    if change is not None:
        change.release()


def load(spark: SparkSession, config: DailyConfig, state: RunState) -> None:
    load_sources(
        spark,
        config.landing,
        config.warehouse,
        config.run_id,
        loaded_at=config.now,
        one_line_sources=config.one_line_sources,
    )
    runs = control.ingestion_runs(spark, config.warehouse).read()
    state.rows_ingested = control.check_load(runs, config.run_id)["total_rows"]


def stage(spark: SparkSession, config: DailyConfig) -> dict[str, DataFrame]:
    """Staging tables, brought up to date from the raw rows of this run and written: checks, marts and the
    enrichment all read them."""
    first = [s for s in SOURCE_COLUMNS if s not in ("restaurants", "reviews")]
    found: dict[str, Change | None] = {}

    def restaurants_then_reviews() -> None:  # reviews look up the city of their restaurant in the written table
        found["restaurants"] = changes.stage_source(spark, config.warehouse, "restaurants")
        _release(changes.stage_source(spark, config.warehouse, "reviews", found["restaurants"]))
        _release(found["restaurants"])

    one = [lambda s=s: _release(changes.stage_source(spark, config.warehouse, s)) for s in first]
    _write_all(config, [restaurants_then_reviews, *one])
    return {f"stg_{s}": changes.staging_table(spark, config.warehouse, s).read() for s in SOURCE_COLUMNS}


def check_staging(spark: SparkSession, config: DailyConfig, staged: dict[str, DataFrame], state: RunState) -> None:
    # The control rows know when a source last gained rows; no raw table is read for it. A source that has a table
    # but never gained a row is as stale as one can be.
    present = [(s,) for s in SOURCE_COLUMNS if raw_table(spark, config.warehouse, s).exists()]
    if present:
        newest = control.newest_loads(control.ingestion_runs(spark, config.warehouse).read())
        tables = spark.createDataFrame(present, "source string").join(newest, "source", "left")
        ages = quality.freshness_of(tables.withColumnRenamed("source", "table_name"), config.now or datetime.now(UTC))
        state.note(quality.freshness_gate(ages))
    declared = dict.fromkeys([*quality.STAGING_CHECKS, *quality.CONTRACTS["stg_reviews"].checks()])
    state.note(quality.gate(quality.run_checks(staged, declared)))


def merge_fact(
    target: LayerTable, rows: DataFrame, key: str, time_column: str, lookback: str | None = None
) -> Change | None:
    """First run: everything, and None. Later runs: rows newer than the target, by key, and what they changed.
    Facts are kept by month, so a merge rewrites only months it has to."""
    month = F.date_format(time_column, "yyyy-MM")
    if not target.exists():
        target.replace(rows, part_by=month)
        return None
    return target.upsert(incremental_rows(rows, target, time_column, lookback), [key], part_by=month)


def build_marts(
    spark: SparkSession, config: DailyConfig, staged: dict[str, DataFrame], state: RunState
) -> dict[str, DataFrame]:
    def gold(name: str, keys: Sequence[str] = ()) -> LayerTable:
        return table(spark, config, "marts", name, keys)

    orders, items = staged["stg_orders"], staged["stg_order_items"]
    order_facts = gold("fact_orders", ["order_id"])
    version = order_facts.version()
    merged: dict[str, Change | None] = {}

    def merge_orders() -> None:
        rows = marts.fact_orders(orders)
        merged["orders"] = merge_fact(order_facts, rows, "order_id", "order_timestamp", config.lookback)

    def merge_items() -> None:
        target, rows = gold("fact_order_items", ["order_item_id"]), marts.fact_order_items(items, orders)
        _release(merge_fact(target, rows, "order_item_id", "order_ts", config.lookback))

    _write_all(
        config,
        [
            lambda: gold("dim_customer").replace(marts.dim_customer(staged["stg_users"])),
            lambda: gold("dim_restaurants").replace(marts.dim_restaurants(staged["stg_restaurants"])),
            lambda: gold("dim_food").replace(marts.dim_food(staged["stg_food"])),
            lambda: gold("dim_date").replace(marts.dim_date(spark)),
            merge_orders,
            merge_items,
        ],
    )
    facts, restaurants = gold("fact_orders").read(), gold("dim_restaurants").read()
    late = config.late_after_minutes
    _write_all(
        config,
        [
            lambda: changes.refresh_revenue(spark, config.warehouse, order_facts, merged["orders"], version),
            lambda: gold("mart_restaurant_performance").replace(marts.mart_restaurant_performance(facts, restaurants)),
            lambda: gold("mart_delivery_sla").replace(marts.mart_delivery_sla(facts, late)),
        ],
    )
    _release(merged["orders"])
    built = {n: gold(n).read() for n in MARTS}
    contracts = [quality.CONTRACTS[n].checks() for n in ("fact_orders", "dim_customer")]
    declared = dict.fromkeys([*quality.MART_CHECKS, *[c for group in contracts for c in group]])
    state.note(quality.gate(quality.run_checks(built, declared)))
    if config.max_order_age_hours is not None:
        age = quality.stale_orders(facts, config.now or datetime.now(UTC), config.max_order_age_hours)
        state.note(quality.freshness_gate(age))
    return built


def build_views(gold: dict[str, DataFrame], staged: dict[str, DataFrame], state: RunState) -> dict[str, DataFrame]:
    views = semantic.build_semantic(
        orders=gold["fact_orders"],
        customers=gold["dim_customer"],
        revenue=gold["mart_daily_city_revenue"],
        restaurants=gold["mart_restaurant_performance"],
        sla=gold["mart_delivery_sla"],
        reviews=staged["stg_reviews"],
    )
    wrapped = {
        "sem_orders": gold["fact_orders"],
        "sem_revenue_daily": gold["mart_daily_city_revenue"],
        "sem_restaurant_performance": gold["mart_restaurant_performance"],
        "sem_delivery_sla": gold["mart_delivery_sla"],
        "sem_reviews": staged["stg_reviews"],
    }
    errors = catalog.dictionary_errors(views)
    if errors:
        raise quality.QualityGateFailed("; ".join(errors))
    quality.parity_gate(quality.row_parity({v: (wrapped[v], df) for v, df in views.items()}))
    state.note(quality.gate(quality.run_checks(views, quality.SEMANTIC_CHECKS)))
    return views


def enrich_reviews(spark: SparkSession, config: DailyConfig, staged: dict[str, DataFrame], state: RunState) -> None:
    enrich.run_batch(
        spark,
        config.warehouse,
        staged["stg_reviews"],
        config.run_id,
        make_client=config.make_client,
        rules=config.rules,
        model_name=config.model_name,
        prompt_version=config.prompt_version,
        batch_size=config.batch_size,
        processed_at=config.now,
    )
    log = enrich.enrichment_log(spark, config.warehouse).read()
    state.enrichment = quality.check_failure_share(log, config.run_id, config.failure_limit)
    enriched = enrich.review_enriched(spark, config.warehouse).read()
    declared = dict.fromkeys([*quality.ENRICHED_CHECKS, *quality.CONTRACTS["review_enriched"].checks()])
    state.note(quality.gate(quality.run_checks({"review_enriched": enriched}, declared)))
    if not quality.success_is_terminal(enriched, log).isEmpty():
        raise quality.QualityGateFailed("a review failed after it had succeeded in the same batch")


def publish(spark: SparkSession, config: DailyConfig, staged: dict[str, DataFrame]) -> None:
    enriched = enrich.review_enriched(spark, config.warehouse).read()
    insights = marts.mart_review_insights(enriched, staged["stg_reviews"])
    table(spark, config, "marts", "mart_review_insights").replace(insights)
