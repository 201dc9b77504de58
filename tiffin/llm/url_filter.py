"""URL rules by a sorted sweep over reversed-host keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import stored

# (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DEFAULT = "allow"
OPEN, VISIT, CLOSE = 0, 1, 2


def _lower_ascii(c: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(c, upper, upper.lower())


def host_key(host: Column) -> Column:
    """Labels in reverse, each ended by a zero character: a host's key is a prefix of its subdomains' keys only.

    The characters that end keys (zero, and one for the end of an interval) are
    spelled with a leading two where a host holds them.
    """
    for plain, spelled in (("\x02", "\x02\x05"), ("\x00", "\x02\x03"), ("\x01", "\x02\x04")):
        host = F.replace(host, F.lit(plain), F.lit(spelled))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "\x00"), F.lit("\x00"))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return _lower_ascii(host), path


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """Rule and verdict of every page: page_id, host, path, rule, verdict.

    ``rules`` has verdict, host, path. A rule's reversed host opens an interval
    of keys that holds the host and its subdomains, and intervals nest. One
    sorted sweep over rule openings, page keys and rule endings carries the
    stack of the intervals that are open: an opening puts the rule's stack (its
    own rules on those of its enclosing hosts) in force, an ending that of the
    enclosing host. Of the stack's rules whose path starts the page's, the
    longest (host and path together, then the longer host) wins.

    The sweep is cut into ranges of (key, kind, id), so one host or url with a
    third of all pages spreads over many ranges, each of which starts with the
    stack that the earlier ones left. A missing url, or one without ``://``, has
    empty host and path, meets no rule and gets ``default``; repeated pages give
    repeated rows; without rules everything gets ``default``. Repeated rules
    count once; of equal host and path, ``block`` wins. Columns other than
    page_id and url are ignored.
    """
    host, path = url_parts(F.col("url"))
    visits = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("key", host_key(F.col("host")))
    none = "array<struct<size:int,host_size:int,path:string,rule:string,verdict:string>>"
    events = _rule_events(rules)
    kind_key = ["key", "kind", "page_id", "path"]
    sweep = visits.select(
        "key", F.lit(VISIT).alias("kind"), "page_id", "host", "path", F.lit(None).cast(none).alias("stack")
    ).unionByName(
        events.select(
            "key", "kind", F.lit(None).cast(pages.schema["page_id"].dataType).alias("page_id"),
            F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"), "stack",
        )
    )
    ranged = stored(
        sweep.repartitionByRange(*kind_key).withColumn("block", F.spark_partition_id()), "url-sweep"
    )
    # One row per block: the stack it leaves, and so the one the next block finds.
    # A page between two events never changes it.
    left = ranged.filter(F.col("kind") != VISIT).groupBy("block").agg(
        F.max_by("stack", F.struct("key", "kind")).alias("left")
    )
    blocks = ranged.select("block").distinct().join(left, "block", "left")
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("block", F.last("left", ignorenulls=True).over(earlier).alias("start"))
    sofar = Window.partitionBy("block").orderBy(*kind_key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    active = F.coalesce(F.last("stack", ignorenulls=True).over(sofar), F.col("start"))
    fits = F.filter(F.col("active"), lambda r: F.startswith(F.col("path"), r["path"]))
    return (
        ranged.join(starts, "block")
        .withColumn("active", active)
        .filter(F.col("kind") == VISIT)
        .withColumn("best", F.array_max(fits))
        .select(
            "page_id", "host", "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        )
    )


def _rule_events(rules: DataFrame) -> DataFrame:
    """Openings and endings of the rules' host intervals, each with the stack it leaves."""
    clean = rules.select(
        _lower_ascii(F.coalesce("host", F.lit(""))).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    ).filter("host != ''")
    own = (
        clean.groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .groupBy("host")
        .agg(
            F.collect_list(
                F.struct(
                    (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"), "path",
                    F.concat("host", "path").alias("rule"), "verdict",
                )
            ).alias("own")
        )
    )
    # Every host looks its ancestors up by name, at most one per label.
    labels = F.split("host", r"\.")
    ups = own.select("host", F.explode(F.sequence(F.lit(1), F.size(labels))).alias("up")).withColumn(
        "ancestor", F.array_join(F.slice(labels, F.col("up"), F.size(labels)), ".")
    )
    found = ups.join(own.select(F.col("host").alias("ancestor"), "own"), "ancestor")
    stacks = found.groupBy("host").agg(
        F.flatten(F.collect_list("own")).alias("stack"),
        F.flatten(F.collect_list(F.when(F.col("up") > 1, F.col("own")))).alias("outer"),
    )
    key = host_key(F.col("host"))
    opened = stacks.select(key.alias("key"), F.lit(OPEN).alias("kind"), "stack")
    # Past the zero that ends the key, so after every subdomain.
    ending = F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("\x01"))
    closed = stacks.withColumn("key", key).select(
        ending.alias("key"), F.lit(CLOSE).alias("kind"), F.col("outer").alias("stack")
    )
    return opened.unionByName(closed)
