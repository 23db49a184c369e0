"""URL filter by a sort-merge range join of canonical keys with nested rule intervals.

A rule (host, path) fits a url whose host is the rule's or below it and whose path
starts with the rule's. The canonical key is the host with its labels reversed,
then the path: all paths below a rule's path lie in one interval of keys, and two
such intervals are nested or disjoint. A url asks once for each level of its host
(``a.b.c`` asks as ``a.b.c``, ``b.c`` and ``c``), so a rule also covers subdomains.

Sweep: interval starts and ends are rows among the urls' keys in sorted order. Each
carries the stack of rules that are active after it, innermost last; a url
takes the stack of the nearest such row before it. The longest rule of all levels
wins, on equal length the one with more of it in the host.

The sort is within (top label, slice): the rules of a top label are repeated in
each of its ``slices``, the urls are dealt over them, so a host that holds a third
of all rows is spread. No Python, no broadcast and no cross join takes part.

A url that is null or has no ``://`` has an empty host and path. Of equal rules that
contradict each other block wins. Repeated rows are judged once and returned as often.
"""

from __future__ import annotations

from collections.abc import Iterable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rules (verdict, host, path) of the registered query.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DEFAULT_VERDICT = "allow"
SEPARATOR = "\u0001"


#: Rows of one top label in a slice at most, and the fewest slices.
SLICE_ROWS, LEAST_SLICES = 250_000, 64


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(tail, "^[^?#]*", 0)
    return F.translate(host, ascii_uppercase, ascii_lowercase), path


def rules_frame(spark, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    """The rules as a frame (verdict, host, path) of literals."""
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("verdict", "host", "path"), rule)]) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def url_filter(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    slices: int | None = None,
) -> DataFrame:
    """id, ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` of every row.

    A top label's urls are swept in ``slices``, each with all the rules' bounds; by default as
    many as leave ``SLICE_ROWS`` rows in each if all urls have one top label."""
    if slices is None:
        slices = max(LEAST_SLICES, -(-pages.count() // SLICE_ROWS))
    host, path = split_url(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    urls = urls.groupBy("id", "host", "path").agg(F.count(F.lit(1)).alias("rows"))
    labels = urls.withColumn("labels", F.reverse(F.split("host", "\\.")))
    level = F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("level")
    asked = labels.select("id", "host", "path", "rows", "labels", level).select(
        "id", "host", "path", "rows",
        F.col("labels")[0].alias("top"),
        F.pmod(F.xxhash64("id", "host", "path"), F.lit(slices)).alias("slice"),
        _key(F.array_join(F.slice("labels", 1, F.col("level")), "."), F.col("path")).alias("key"),
        F.lit(1).alias("kind"),
        F.lit(None).cast(_STACK).alias("stack"),
    )
    bounds = _bounds(rules).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
    none = F.lit(None)
    swept = asked.unionByName(
        bounds.select(
            none.cast(urls.schema["id"].dataType).alias("id"), none.cast("string").alias("host"),
            none.cast("string").alias("path"), none.cast("long").alias("rows"),
            "top", "slice", "key", "kind", "stack",
        )
    )
    # A boundary sorts before a url of the same key: an interval holds its start.
    order = Window.partitionBy("top", "slice").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    innermost = F.try_element_at(F.last("stack", ignorenulls=True).over(order), F.lit(-1))
    found = swept.withColumn("rule", innermost).filter("kind = 1")
    longest = found.groupBy("id", "host", "path").agg(F.max("rule").alias("rule"), F.first("rows").alias("rows"))
    return longest.select(
        F.col("id").alias(id_col), "host", "path",
        F.col("rule.rule").alias("rule"),
        F.coalesce("rule.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("copy"),
    ).drop("copy")


#: Compared in this order: longest rule, then the longest host.
_RULE = "struct<length:int,host_length:int,rule:string,verdict:string>"
_STACK = f"array<{_RULE}>"


def _key(reversed_host: Column, path: Column) -> Column:
    return F.concat(reversed_host, F.lit(SEPARATOR), path).cast("binary")


def _bounds(rules: DataFrame) -> DataFrame:
    """Start and end of each rule's interval with the stack of active rules after it."""
    lowered = F.translate("host", ascii_uppercase, ascii_lowercase)
    rules = rules.filter("host is not null and path is not null").select(lowered.alias("host"), "path", "verdict")
    rules = rules.groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("blocks")).select(
        "host", "path",
        F.struct(
            F.length(F.concat("host", "path")).alias("length"), F.length("host").alias("host_length"),
            F.concat("host", "path").alias("rule"), F.when(F.col("blocks"), "block").otherwise("allow").alias("verdict"),
        ).alias("entry"),
    )
    # The rules around a rule have a prefix of its path and the same host.
    prefixes = rules.select("host", "path", F.explode(F.sequence(F.lit(0), F.length("path"))).alias("n"))
    prefixes = prefixes.select("host", "path", F.expr("substring(path, 1, n)").alias("prefix"))
    around = rules.select("host", F.col("path").alias("prefix"), "entry")
    nested = prefixes.join(around, ["host", "prefix"]).groupBy("host", "path").agg(F.array_sort(F.collect_list("entry")).alias("stack"))
    reversed_labels = F.reverse(F.split("host", "\\."))
    start = _key(F.array_join(reversed_labels, "."), F.col("path"))
    outer = F.slice("stack", 1, F.size("stack") - 1)
    return nested.select(
        reversed_labels[0].alias("top"),
        F.explode(
            F.array(
                F.struct(start.alias("key"), F.col("stack").cast(_STACK).alias("stack")),
                # the byte FF sorts after all UTF-8
                F.struct(F.concat(start, F.lit(b"\xff")).alias("key"), outer.cast(_STACK).alias("stack")),
            )
        ).alias("bound"),
        F.lit(0).alias("kind"),
    ).select("top", "kind", "bound.*")
