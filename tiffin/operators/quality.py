"""Data checks with block / warn severity, freshness, parity and gates."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.sources.tables import union_all

ERROR, WARN = "error", "warn"


class QualityGateFailed(Exception):
    """A blocking check found rows, or a failure share is too high."""


@dataclass(frozen=True)
class Check:
    """One declared check. ``kind`` is unique, not_null, accepted_values,
    relationships or expression; NULL passes all but not_null."""

    table: str
    column: str
    kind: str
    severity: str = ERROR
    values: tuple[str, ...] = ()
    expression: str = ""  # continues the column: ">= 0", "between 1 and 5"
    parent: str = ""
    parent_column: str = ""

    def bad_row(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "accepted_values":
            return c.isNotNull() & ~c.isin(list(self.values))
        if self.kind == "expression":
            return ~F.expr(f"({self.column} {self.expression})")
        raise ValueError(f"{self.kind} is not a check of single rows")


def row_rule(table: str, rule: str, name: str, severity: str = ERROR) -> Check:
    """A rule over several columns of a row, such as ``finished_at >= started_at``."""
    return Check(table, name, "rule", severity, expression=rule)


ROW_KINDS = ("not_null", "accepted_values", "expression", "rule")


def failing_rows(df: DataFrame, check: Check, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows a check complains about; for unique, the values that repeat."""
    if check.kind == "unique":
        seen = df.filter(F.col(check.column).isNotNull()).groupBy(check.column).agg(F.count("*").alias("n_rows"))
        return seen.filter("n_rows > 1")
    if check.kind == "relationships":
        parent = _parent_keys(parents[check.parent], check)
        return df.filter(F.col(check.column).isNotNull()).join(parent, check.column, "left_anti")
    return df.filter(_bad(check))


def _parent_keys(parent: DataFrame, check: Check) -> DataFrame:
    return parent.select(F.col(check.parent_column).alias(check.column)).distinct()


def _bad(check: Check) -> Column:
    return ~F.expr(check.expression) if check.kind == "rule" else check.bad_row()


def _entry(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
    )


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check: table, column, check, severity, failures, status.

    A table is read once for its first key and all its checks of single rows:
    the rows are counted per key, bad ones too, and then summed. A reference is
    checked against the distinct keys of the child, so a parent with very many
    children is looked up once.
    """
    by_table: dict[str, list[Check]] = defaultdict(list)
    for check in checks:
        by_table[check.table].append(check)
    results: list[DataFrame] = []
    for table, group in by_table.items():
        df = tables[table]
        rows = [c for c in group if c.kind in ROW_KINDS]
        keys = [c for c in group if c.kind == "unique"]
        counted = [F.count_if(_bad(c)).alias(f"c{i}") for i, c in enumerate(rows)]
        if keys:
            key = keys[0].column
            per_key = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"), *counted)
            repeated = F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1)).alias("_repeated")
            sums = [F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(rows))]
            totals = per_key.agg(repeated, *sums)
            entries = [_entry(keys[0], F.col("_repeated"))]
        else:
            totals, entries = (df.agg(*counted) if counted else None), []
        entries += [_entry(c, F.col(f"c{i}")) for i, c in enumerate(rows)]
        if entries:
            results.append(totals.select(F.inline(F.array(*entries))))
        for check in keys[1:]:
            count = failing_rows(df, check).agg(F.count("*").alias("n"))
            results.append(count.select(F.inline(F.array(_entry(check, F.col("n"))))))
        for check in (c for c in group if c.kind == "relationships"):
            c = check.column
            children = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n_rows"))
            lost = children.join(_parent_keys(tables[check.parent], check), c, "left_anti")
            count = lost.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
            results.append(count.select(F.inline(F.array(_entry(check, F.col("n"))))))
    status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == WARN, "warn").otherwise("fail")
    return union_all(results).withColumn("status", status)


def gate(results: DataFrame) -> str:
    """``passed`` or ``warned``; raises when a blocking check failed."""
    bad = results.filter("status <> 'pass'").orderBy("table_name", "column_name", "check_name").collect()
    blocking = [r for r in bad if r["status"] == "fail"]
    if blocking:
        names = [f"{r['table_name']}.{r['column_name']} {r['check_name']}: {r['failures']}" for r in blocking]
        raise QualityGateFailed("; ".join(names))
    return "warned" if bad else "passed"


def freshness(
    df: DataFrame, table: str, time_column: str, now: datetime | Column, warn_hours: float = 24, error_hours: float = 48
) -> DataFrame:
    """Hours since the newest row, and whether that is too long."""
    newest = df.agg(F.max(F.col(time_column).cast("timestamp")).alias("newest"))
    return freshness_of(newest.select(F.lit(table).alias("table_name"), "newest"), now, warn_hours, error_hours)


def freshness_of(
    newest: DataFrame, now: datetime | Column, warn_hours: float = 24, error_hours: float = 48
) -> DataFrame:
    """The same for (table_name, newest), one row a table."""
    at = now if isinstance(now, Column) else F.lit(now)
    seconds = F.unix_micros(at.cast("timestamp")) - F.unix_micros(F.col("newest"))
    age = F.col("age_hours")
    return (
        newest.withColumn("age_hours", seconds / F.lit(3_600_000_000.0))
        .select(
            "table_name",
            F.col("newest").alias("max_loaded_at"),
            "age_hours",
            F.when(age.isNull() | (age > error_hours), "fail").when(age > warn_hours, "warn").otherwise("pass").alias(
                "status"
            ),
        )
    )


def freshness_gate(results: DataFrame) -> str:
    worst = {r["status"]: r["table_name"] for r in results.collect()}
    if "fail" in worst:
        raise QualityGateFailed(f"stale: {worst['fail']}")
    return "warned" if "warn" in worst else "passed"


def row_parity(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of views against the tables they wrap; ``failures`` is 1 where
    they differ. The counts of a pair meet in one grouped row, without a join."""
    sides = []
    for name, (gold, view) in pairs.items():
        for df, side in ((gold, "gold"), (view, "semantic")):
            n = df.agg(F.count("*").alias("n"))
            sides.append(n.select(F.lit(name).alias("view_name"), F.lit(side).alias("side"), "n"))
    count = lambda side: F.sum(F.when(F.col("side") == side, F.col("n")))
    return (
        union_all(sides)
        .groupBy("view_name")
        .agg(count("gold").alias("gold_row_count"), count("semantic").alias("semantic_row_count"))
        .withColumn("failures", F.when(F.col("gold_row_count") == F.col("semantic_row_count"), 0).otherwise(1))
    )


def parity_gate(results: DataFrame) -> None:
    bad = [r["view_name"] for r in results.filter("failures > 0").collect()]
    if bad:
        raise QualityGateFailed(f"rows lost between gold and {bad}")


@dataclass(frozen=True)
class Contract:
    """What a table promises to its readers."""

    table: str
    primary_key: str
    required: tuple[str, ...] = ()
    allowed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    rules: tuple[tuple[str, str], ...] = ()  # name, boolean expression
    warnings: tuple[tuple[str, str], ...] = ()

    def checks(self) -> list[Check]:
        t = self.table
        out = [Check(t, self.primary_key, "unique")]
        out += [Check(t, c, "not_null") for c in dict.fromkeys((self.primary_key, *self.required))]
        out += [Check(t, c, "accepted_values", values=v) for c, v in self.allowed]
        out += [row_rule(t, rule, name) for name, rule in self.rules]
        out += [row_rule(t, rule, name, WARN) for name, rule in self.warnings]
        return out

    def missing_columns(self, df: DataFrame) -> list[str]:
        wanted = {self.primary_key, *self.required, *(c for c, _ in self.allowed)}
        return sorted(wanted - set(df.columns))


def _keys(table: str, column: str) -> list[Check]:
    return [Check(table, column, "unique"), Check(table, column, "not_null")]


# Order states, age segments, labels and topics that may occur.
ORDER_STATES = ("Delivered", "Cancelled", "Refunded")
SEGMENTS = ("Gen Z", "Millennial", "Gen X", "Boomer", "Unknown")
LABELS = ("positive", "neutral", "negative")
TOPICS = ("food quality", "delivery", "service", "packaging", "pricing", "other")

STAGING_CHECKS: list[Check] = [
    *_keys("stg_restaurants", "restaurant_id"),
    *_keys("stg_users", "customer_id"),
    *_keys("stg_food", "f_id"),
    *_keys("stg_menu", "menu_id"),
    Check("stg_menu", "restaurant_id", "not_null"),
    *_keys("stg_orders", "order_id"),
    Check("stg_orders", "customer_id", "not_null"),
    Check("stg_orders", "restaurant_id", "not_null"),
    Check("stg_orders", "order_status", "accepted_values", values=ORDER_STATES),
    Check("stg_orders", "sales_amount", "expression", WARN, expression=">= 0"),
    *_keys("stg_order_items", "order_item_id"),
    Check("stg_order_items", "order_id", "not_null"),
    *_keys("stg_reviews", "review_id"),
    Check("stg_reviews", "comment", "not_null"),
    Check("stg_reviews", "rating", "expression", WARN, expression="between 1 and 5"),
]

MART_CHECKS: list[Check] = [
    *_keys("fact_orders", "order_id"),
    Check("fact_orders", "customer_id", "not_null"),
    Check("fact_orders", "customer_id", "relationships", parent="dim_customer", parent_column="customer_id"),
    Check("fact_orders", "restaurant_id", "not_null"),
    Check("fact_orders", "restaurant_id", "relationships", parent="dim_restaurants", parent_column="restaurant_id"),
    Check("fact_orders", "order_status", "accepted_values", values=ORDER_STATES),
    Check("fact_orders", "sales_amount", "expression", WARN, expression=">= 0"),
    *_keys("fact_order_items", "order_item_id"),
    Check("fact_order_items", "order_id", "not_null"),
    *_keys("dim_customer", "customer_id"),
    Check("dim_customer", "age_segment", "accepted_values", values=SEGMENTS),
    *_keys("dim_restaurants", "restaurant_id"),
    *_keys("dim_food", "f_id"),
    *_keys("dim_date", "date_day"),
    Check("mart_daily_city_revenue", "order_date", "not_null"),
    Check("mart_restaurant_performance", "restaurant_id", "not_null"),
]

SEMANTIC_CHECKS: list[Check] = [
    *_keys("sem_orders", "order_id"),
    Check("sem_revenue_daily", "order_date", "not_null"),
    *_keys("sem_restaurant_performance", "restaurant_id"),
    *_keys("sem_reviews", "review_id"),
    row_rule("sem_revenue_daily", "gross_merchandise_value >= 0", "no_negative_revenue"),
]

ENRICHED_CHECKS: list[Check] = [
    *_keys("review_enriched", "review_id"),
    Check("review_enriched", "sentiment_label", "accepted_values", values=LABELS),
]

CONTRACTS: dict[str, Contract] = {
    c.table: c
    for c in (
        Contract(
            "fact_orders",
            "order_id",
            ("order_timestamp", "customer_id", "restaurant_id", "order_status", "sales_amount"),
            (("order_status", ORDER_STATES),),
            warnings=(("sales_amount_not_negative", "sales_amount >= 0"),),
        ),
        Contract("dim_customer", "customer_id", ("age_segment",), (("age_segment", SEGMENTS),)),
        Contract("stg_reviews", "review_id", ("comment",), warnings=(("rating_range", "rating between 1 and 5"),)),
        Contract(
            "review_enriched",
            "review_id",
            ("sentiment_label", "sentiment_score", "topic", "model_name", "model_version", "prompt_version",
             "processed_at", "batch_id", "pii_redacted_count"),
            (("sentiment_label", LABELS), ("topic", TOPICS)),
            rules=(("score_range", "sentiment_score between -1 and 1"),),
        ),
        Contract(
            "pipeline_runs",
            "run_id",
            ("dag_run_id", "started_at", "finished_at", "status", "rows_ingested", "dq_status", "ai_success_count",
             "ai_fail_count"),
            (("status", ("SUCCESS", "FAILED", "PARTIAL")), ("dq_status", ("passed", "warned", "failed"))),
            rules=(("finished_after_start", "finished_at >= started_at"),),
        ),
    )
}

# Fixed value: hours after which the newest order is too old for a daily run.
FACT_ORDERS_MAX_AGE_HOURS = 26


def stale_orders(orders: DataFrame, now: datetime | Column, max_hours: float = FACT_ORDERS_MAX_AGE_HOURS) -> DataFrame:
    """Age of the newest order against the promise of fact_orders, as a warning."""
    return freshness(orders, "fact_orders", "order_timestamp", now, max_hours, float("inf"))


def success_is_terminal(enriched: DataFrame, log: DataFrame) -> DataFrame:
    """Reviews that both succeeded and have a failed attempt later in the same
    batch; there should be none."""
    last_failed = (
        log.filter("status = 'FAILED'")
        .groupBy("batch_id", "review_id")
        .agg(F.max("processed_at").alias("failed_at"))
    )
    return enriched.select("batch_id", "review_id", "processed_at").join(
        last_failed, ["batch_id", "review_id"]
    ).filter("failed_at > processed_at")


def failure_share(log: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Per batch: succeeded, failed, and the failed share (0 for none)."""
    rows = log if batch_id is None else log.filter(F.col("batch_id") == batch_id)
    ok = F.count_if(F.col("status") == "SUCCEEDED")
    bad = F.count_if(F.col("status") == "FAILED")
    total = (ok + bad).cast("decimal(20,0)")
    share = F.when(total == 0, F.lit(0)).otherwise(F.try_divide(bad.cast("decimal(20,0)"), total))
    return rows.groupBy("batch_id").agg(ok.alias("succeeded"), bad.alias("failed"), share.alias("failure_rate"))


def check_failure_share(log: DataFrame, batch_id: str, limit: float = 0.2) -> dict:
    """Gate of an enrichment batch. An empty batch passes; exactly the limit too."""
    row = failure_share(log, batch_id).first()
    if row is None:
        return {"batch_id": batch_id, "succeeded": 0, "failed": 0, "failure_rate": 0.0}
    succeeded, failed = row["succeeded"], row["failed"]
    if failed > limit * (succeeded + failed):
        raise QualityGateFailed(f"batch {batch_id}: {failed} of {succeeded + failed} reviews failed")
    return {"batch_id": batch_id, "succeeded": succeeded, "failed": failed,
            "failure_rate": round(float(row["failure_rate"]), 3)}


def contract_breaches(contracts: Sequence[Contract], tables: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    """Tables that lack promised columns."""
    return {c.table: gone for c in contracts if (gone := c.missing_columns(tables[c.table]))}
