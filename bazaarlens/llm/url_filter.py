"""Allow and block rules over urls, looked up by host suffix and path prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.text import ascii_lower, without
from bazaarlens.session import cut_lineage

#: Hexadecimal digits of a digest that the join compares first.
SHORT = 8


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def with_host_and_path(df: DataFrame, url_column: str = "url") -> DataFrame:
    """Adds ``host`` (after the first ``://``, A-Z lower-cased) and ``path`` (up to ``?`` or ``#``)."""
    rest = df.withColumn("__rest", F.coalesce(_after(F.col(url_column)), F.lit("")))
    host = F.regexp_extract("__rest", r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(F.col("__rest"), F.length(host) + 1, F.length("__rest")), r"^[^?#]*", 0)
    return rest.withColumns({"host": ascii_lower(host), "path": path}).drop("__rest")


def _labels(host: Column) -> Column:
    return F.split(host, r"\.", -1)


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow", url_column: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, the ``rule`` that decides and its ``verdict``.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all
    hosts below it, for urls whose path starts with the rule's path. The longest text
    of host and path decides; where one text both allows and blocks, block does. With no
    rule, ``rule`` is null and ``default`` the verdict.

    Each distinct pair of host and path is expanded into the host suffixes and path
    prefixes of the lengths that occur among the rules, each joined by the first digits
    of its digest, then held against the whole digest. Nothing is compared with all
    rules, and a hot url is looked up once.

    Null urls and those without ``://`` have an empty host and path and fit no rule.
    Repeated rows stay repeated. Empty tables of pages or rules are fine. Columns
    named as the added ones are replaced.
    """
    listed = rules.select(
        F.concat(ascii_lower(F.col("host")), F.col("path")).alias("rule"),
        F.size(_labels(F.col("host"))).alias("labels"),
        F.length("path").alias("chars"),
        F.col("verdict"),
    ).where(F.col("rule").isNotNull() & (F.col("host") != ""))
    # One row for each shape of rule: as many as lengths of hosts times lengths of paths.
    shapes = [(r["labels"], r["chars"]) for r in listed.select("labels", "chars").distinct().collect()]
    known = (
        listed.groupBy("rule")
        .agg(F.max(F.when(F.col("verdict") == "block", "block").otherwise("allow")).alias("verdict"))
        .withColumn("digest", F.sha2("rule", 256))
        .select(F.substring("digest", 1, SHORT).alias("short"), "digest", "rule", "verdict")
    )
    judged = with_host_and_path(without(pages, "host", "path", "rule", "verdict"), url_column)
    places = judged.select("host", "path").where(F.col("host") != "").distinct()
    labels = _labels(F.col("host"))
    shapes_column = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(m).alias("chars")) for n, m in shapes])
    if not shapes:
        shapes_column = F.expr("cast(array() as array<struct<labels:int,chars:int>>)")
    expressions = (
        places.withColumn("shape", F.explode(shapes_column))
        .where((F.size(labels) >= F.col("shape.labels")) & (F.length("path") >= F.col("shape.chars")))
        .withColumn(
            "digest",
            F.sha2(
                F.concat(
                    F.array_join(F.slice(labels, F.size(labels) - F.col("shape.labels") + 1, F.col("shape.labels")), "."),
                    F.substring(F.col("path"), F.lit(1), F.col("shape.chars")),
                ),
                256,
            ),
        )
        .select("host", "path", "digest", F.substring("digest", 1, SHORT).alias("short"))
    )
    fitting = expressions.join(known.withColumnRenamed("digest", "whole"), "short").where(F.col("digest") == F.col("whole"))
    # Written, so that the join below deals both sides anew and can split a hot url.
    best = cut_lineage(
        fitting.groupBy("host", "path").agg(
            F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "rule")).alias("best")
        )
    )
    return judged.join(best, ["host", "path"], "left").select(
        *judged.columns,
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )
