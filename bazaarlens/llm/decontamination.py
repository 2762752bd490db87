"""Passages of benchmark items in documents, found by a prefix-filtered set join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.text import KEY, row_key, without, words
from bazaarlens.session import cut_lineage

WINDOW = 10
SHINGLE = 5
#: Benchmarks of up to so many bytes of windows are sent to every executor; larger ones
#: are shuffled by shingle, with the same result.
BROADCAST_BYTES = 32_000_000


def _shingles(tokens: Column, size: int) -> Column:
    """Start and digest of every run of ``size`` tokens."""
    starts = F.when(F.size(tokens) >= size, F.sequence(F.lit(0), F.size(tokens) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda at: F.struct(at.alias("at"), F.xxhash64(F.slice(tokens, at + 1, size)).alias("shingle")))


def _windows(benchmark: DataFrame, window: int, item_column: str, text_column: str) -> DataFrame:
    """Every distinct window of an item: its digest, its words and the item."""
    items = benchmark.select(F.col(item_column).cast("string").alias("item"), words(F.col(text_column)).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(window))
    return (
        items.select("item", "w", F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("at"))
        .select("item", F.slice("w", F.col("at"), size).alias("w"))
        .select("item", "w", F.md5(F.concat_ws(" ", "w").cast("binary")).alias("window"))
        .distinct()
    )


def _bytes(windows: DataFrame) -> int:
    """About what the windows take in memory, with their shingles and items."""
    own = F.length(F.concat_ws(" ", "w")) + F.length("item") + 24 * F.size("w") + 64
    return windows.agg(F.coalesce(F.sum(own), F.lit(0))).first()[0]


def _covered(starts: Column) -> Column:
    """Positions inside any of the spans (start, end), which are in order."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
    return F.aggregate(
        starts,
        zero,
        lambda done, x: F.struct(
            (done["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], done["to"]))).alias("n"),
            F.greatest(done["to"], x["end"]).alias("to"),
        ),
        lambda done: done["n"],
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``items`` and ``contaminated``.

    An item's windows are its runs of ``window`` words, or all its words if it has
    fewer. A document holds a window only if it holds every shingle of it, so one
    shingle is a sufficient prefix: the one that is rarest in all documents. Documents
    meet the benchmark on that shingle alone. Its place fixes where the window would
    have to start (positional bound: not before the first word) and to end (length bound:
    not after the last); what is left is compared word by word in the document.

    ``items`` are the ids of items with a window in the document, sorted as strings.
    ``n_hit`` counts the document words inside any window found.

    Null and empty texts have no words and are clean; items without words have no
    windows. Rows equal in id and text share their result. An empty
    benchmark leaves all documents clean. Columns named as the added ones are replaced.
    """
    windows = cut_lineage(_windows(benchmark, window, item_column, item_text_column))
    sizes = [r[0] for r in windows.select(F.least(F.size("w"), F.lit(shingle))).distinct().collect()] or [shingle]
    small = _bytes(windows) <= BROADCAST_BYTES
    inside = F.concat(*[F.when(F.least(F.size("w"), F.lit(shingle)) == k, _shingles(F.col("w"), k)).otherwise(
        F.array().cast("array<struct<at:int,shingle:bigint>>")) for k in sizes])
    parts = cut_lineage(
        windows.groupBy("window").agg(F.first("w").alias("w"), F.collect_set("item").alias("items"))
        .select("window", "w", "items", F.explode(inside).alias("x"))
        .select("window", "w", "items", F.col("x.at").alias("offset"), "x.shingle")
    )
    rows = row_key(without(docs, "n_words", "n_hit", "n_items", "items", "contaminated"), id_column, text_column)
    tokens = rows.withColumn("__words", words(F.col(text_column)))
    # Every place of any benchmark shingle: what rarity is counted from and candidates are made of.
    wanted = parts.select("shingle").distinct()
    places = cut_lineage(
        tokens.select(KEY, F.size("__words").alias("n"), F.explode(F.concat(*[_shingles(F.col("__words"), k) for k in sizes])).alias("x"))
        .select(KEY, "n", F.col("x.at").alias("at"), "x.shingle")
        .join(F.broadcast(wanted) if small else wanted, "shingle", "left_semi")
    )
    rarity = places.groupBy("shingle").agg(F.count(F.lit(1)).alias("n_places"))
    prefix = (
        parts.join(rarity, "shingle", "left")
        .groupBy("window")
        .agg(
            F.min(F.struct(F.coalesce("n_places", F.lit(0)).alias("n_places"), "shingle", "offset")).alias("x"),
            F.first("w").alias("w"),
            F.first("items").alias("items"),
        )
        .where(F.col("x.n_places") > 0)
        .select(F.col("x.shingle").alias("shingle"), F.col("x.offset").alias("offset"), "w", "items")
    )
    start = F.col("at") - F.col("offset")
    candidates = (
        places.join(F.broadcast(prefix) if small else prefix, "shingle")
        .where((start >= 0) & (start + F.size("w") <= F.col("n")))
        .groupBy(KEY)
        .agg(F.collect_set(F.struct(start.alias("start"), (start + F.size("w")).alias("end"), "w", "items")).alias("__candidates"))
    )
    none = F.array().cast("array<struct<start:int,end:int,w:array<string>,items:array<string>>>")
    true = F.filter(
        F.coalesce("__candidates", none),
        lambda x: F.slice(F.col("__words"), x["start"] + 1, F.size(x["w"])) == x["w"],
    )
    verified = tokens.join(candidates, KEY, "left").withColumn("__true", true)
    n_hit = _covered(F.sort_array(F.transform("__true", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))))
    return (
        verified.withColumns(
            {
                "n_words": F.size("__words").cast("long"),
                "n_hit": n_hit.cast("long"),
                "items": F.sort_array(F.array_distinct(F.flatten(F.col("__true.items")))),
            }
        )
        .withColumns({"n_items": F.size("items").cast("long"), "contaminated": F.col("n_hit") > 0})
        .drop(KEY, "__words", "__candidates", "__true")
    )
