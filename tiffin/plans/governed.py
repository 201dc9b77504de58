"""Read-only SQL over the curated views, with a row cap and a time cap.

Spark's own parser turns a statement into a plan without running anything. The
plan is accepted only if every node, table and function in it is allowed.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterable

import pandas as pd
from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from tiffin.plans.catalog import ROW_LIMIT
from tiffin.plans.semantic import VIEWS

SCHEMA = "semantic"
TIMEOUT_SECONDS = 30

# Plan nodes a query may consist of. Anything else - commands,
# writes, table functions, scripts, file scans - is refused.
QUERY_NODES = {
    "Aggregate", "Distinct", "Except", "Filter", "Generate", "GlobalLimit", "Intersect", "Join", "LocalLimit",
    "LocalRelation", "Offset", "OneRowRelation", "Pivot", "Project", "Sample", "Sort", "SubqueryAlias", "Union",
    "Unpivot", "UnresolvedHaving", "UnresolvedInlineTable", "UnresolvedRelation", "UnresolvedSubqueryColumnAliases",
    "UnresolvedWith", "WithWindowDefinition",
}
# What the outermost operation may be once sorting and limits are taken off.
ROOT_NODES = {"Project", "Aggregate", "UnresolvedHaving", "Distinct", "Union"}
WRAPPERS = {"GlobalLimit", "LocalLimit", "Offset", "Sort", "WithWindowDefinition"}

# Built-in functions that reach outside the data.
REFUSED_FUNCTIONS = {
    "assert_true", "from_avro", "from_protobuf", "schema_of_avro", "to_avro", "to_protobuf", "current_catalog", "current_database", "current_schema", "current_user", "input_file_block_length",
    "input_file_block_start", "input_file_name", "java_method", "raise_error", "reflect", "session_user",
    "try_reflect", "user", "version",
}

# Expressions that make arrays or texts of any length from nothing.
UNBOUNDED = {"ArrayRepeat", "Sequence", "StringRepeat", "StringSpace"}
# Joins that return no more rows than their left side.
FILTERING_JOINS = {"LeftSemi", "LeftAnti"}


class RefusedQuery(Exception):
    """The statement is not an allowed query; the message says why."""


def governed_sql(
    spark: SparkSession,
    sql: str,
    views: Iterable[str] = tuple(VIEWS),
    row_limit: int = ROW_LIMIT,
    max_scan_bytes: int | None = None,
) -> DataFrame:
    """Check a statement and return it as a lazy, row-capped DataFrame. A smaller
    limit in the statement keeps its effect under the outer one."""
    return _resolved(spark, runnable(spark, sql, views), max_scan_bytes).limit(row_limit)


def _resolved(spark: SparkSession, executed: str, max_scan_bytes: int | None) -> DataFrame:
    """The checked statement with names resolved, refused if it could do work without a bound or costs too much.

    The same rows must come out each time, nothing but the views may make rows,
    joins need a condition (after the optimizer has moved filters into them),
    and the tables to be read may not be larger than ``max_scan_bytes``.
    """
    df = spark.sql(executed)
    execution = df._jdf.queryExecution()
    _check_expressions(execution.analyzed())
    optimized = execution.optimizedPlan()
    for node in _below(optimized):
        if _name(node) == "Join" and node.condition().isEmpty() and node.joinType().toString() not in FILTERING_JOINS:
            raise RefusedQuery("a join without a condition pairs all rows")
    price = scan_bytes(df)
    if max_scan_bytes is not None and price > max_scan_bytes:
        raise RefusedQuery(f"the statement reads {price} bytes, allowed are {max_scan_bytes}")
    return df


def scan_bytes(df: DataFrame) -> int:
    """Size of the files and rows that the optimized plan reads, as Spark estimates it; unknown sizes count as none."""
    leaves = _items(df._jdf.queryExecution().optimizedPlan().collectLeaves())
    sizes = [int(str(leaf.stats().sizeInBytes())) for leaf in leaves]
    return sum(n for n in sizes if n < 1 << 62)


def _below(plan) -> Iterable:
    yield plan
    for child in _items(plan.children()):
        yield from _below(child)


def _check_expressions(plan) -> None:
    """What the statement itself computes, down to the views."""
    if _name(plan) == "View":
        return
    for expression in _items(plan.expressions()):
        if not expression.deterministic():
            raise RefusedQuery(f"{expression.sql()} gives another result each time")
        _check_bounds(expression)
    for child in _items(plan.children()):
        _check_expressions(child)


def _check_bounds(expression) -> None:
    if _name(expression) in UNBOUNDED:
        raise RefusedQuery(f"{expression.sql()} has no bound on its size")
    for child in _items(expression.children()):
        _check_bounds(child)


def runnable(spark: SparkSession, sql: str, views: Iterable[str]) -> str:
    """The checked statement as it will be run.

    The curated views are temporary views, which have no schema: the allowed
    schema name is taken off where the parser saw one. The parser counts code
    points, as Python does.
    """
    for start in sorted(check_query(spark, sql, views), reverse=True):
        sql = sql[:start] + re.sub(rf"^`?{SCHEMA}`?\s*\.\s*", "", sql[start:], count=1, flags=re.IGNORECASE)
    return sql


def check_query(spark: SparkSession, sql: str, views: Iterable[str]) -> list[int]:
    """Raise RefusedQuery, or return where schema-qualified view names start."""
    # Spark would put settings and environment variables in for these before it parses.
    if "${" in sql:
        raise RefusedQuery("references of the form ${...} are not resolved here")
    parser = spark._jsparkSession.sessionState().sqlParser()
    try:
        plan = parser.parsePlan(sql)
    except ParseException as exc:
        if "extra input" in str(exc) or ";" in sql.strip().rstrip(";"):
            raise RefusedQuery("several statements in one text") from exc
        raise RefusedQuery(f"not readable as SQL: {exc}") from exc
    _check_root(plan)
    check = _PlanCheck(spark, {v.lower() for v in views})
    check.plan(plan, frozenset())
    return check.prefixes


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _name(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _check_root(plan) -> None:
    node = plan
    while _name(node) == "UnresolvedWith" or _name(node) in WRAPPERS:
        node = node.child()
    if _name(node) not in ROOT_NODES:
        raise RefusedQuery(f"{_name(node)} does not read rows: a query is needed")


class _PlanCheck:
    def __init__(self, spark: SparkSession, views: set[str]) -> None:
        self.views = views
        self.prefixes: list[int] = []
        catalyst = spark._jvm.org.apache.spark.sql.catalyst
        self._builtins = catalyst.analysis.FunctionRegistry.builtin()
        self._identifier = catalyst.FunctionIdentifier
        forName = spark._jvm.java.lang.Class.forName
        self._subquery = forName("org.apache.spark.sql.catalyst.expressions.PlanExpression")

    def plan(self, node, ctes: frozenset[str]) -> None:
        kind = _name(node)
        if kind not in QUERY_NODES:
            raise RefusedQuery(f"a query may not contain {kind}")
        if kind == "UnresolvedWith":
            # A name is visible to the definitions after it and to the body.
            for entry in _items(node.cteRelations()):
                name, definition = entry.productElement(0).lower(), entry.productElement(1)
                self.plan(definition, ctes | {name} if node.allowRecursion() else ctes)
                ctes = ctes | {name}
            self.plan(node.child(), ctes)
            return
        if kind == "UnresolvedRelation":
            self.relation(node, ctes)
            return
        for expression in _items(node.expressions()):
            self.expression(expression, ctes)
        for child in _items(node.children()):
            self.plan(child, ctes)

    def relation(self, node, ctes: frozenset[str]) -> None:
        *schema, name = [p.lower() for p in _items(node.multipartIdentifier())]
        if not schema and name in ctes:
            return
        if schema and schema != [SCHEMA]:
            raise RefusedQuery(f"{'.'.join([*schema, name])} lies outside {SCHEMA}")
        if name not in self.views:
            raise RefusedQuery(f"{SCHEMA} has no {name}; it has {', '.join(sorted(self.views))}")
        if schema:
            self.prefixes.append(node.origin().startIndex().get())

    def expression(self, node, ctes: frozenset[str]) -> None:
        kind = _name(node)
        if kind == "UnresolvedFunction":
            self.function([p.lower() for p in _items(node.nameParts())])
        elif kind == "UnresolvedGenerator":
            self.function([node.name().funcName().lower()])
        elif kind == "UnresolvedAttribute":
            # Some functions are called by a bare name.
            parts = [p.lower() for p in _items(node.nameParts())]
            if len(parts) == 1 and parts[0] in REFUSED_FUNCTIONS:
                raise RefusedQuery(f"{parts[0]} is not available")
        if self._subquery.isInstance(node):
            self.plan(node.plan(), ctes)
        for child in _items(node.children()):
            self.expression(child, ctes)

    def function(self, parts: list[str]) -> None:
        known = len(parts) == 1 and self._builtins.functionExists(self._identifier(parts[0]))
        if not known or parts[0] in REFUSED_FUNCTIONS:
            raise RefusedQuery(f"{'.'.join(parts)}() is not available")


def run_governed(
    spark: SparkSession,
    sql: str,
    views: Iterable[str] = tuple(VIEWS),
    row_limit: int = ROW_LIMIT,
    timeout_seconds: float = TIMEOUT_SECONDS,
    max_scan_bytes: int | None = None,
) -> pd.DataFrame:
    """Check and run a statement; its jobs are cancelled after the time cap. The
    row cap bounds what comes back to the client.

    ``attrs`` of the result hold the given and the executed statement, and
    whether the row cap left rows out (``truncated``).
    """
    executed = runnable(spark, sql, views)
    tag = f"governed-{uuid.uuid4().hex}"
    context = spark.sparkContext
    timer = threading.Timer(timeout_seconds, lambda: context.cancelJobsWithTag(tag))
    context.addJobTag(tag)
    timer.start()
    try:
        rows = _resolved(spark, executed, max_scan_bytes).limit(row_limit + 1).toPandas()
    finally:
        timer.cancel()
        context.removeJobTag(tag)
    out = rows.iloc[:row_limit].copy()
    out.attrs = {"given": sql, "executed": executed, "truncated": len(rows) > row_limit}
    return out
